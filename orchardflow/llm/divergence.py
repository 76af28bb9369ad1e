"""Source divergence audit: how far the word use of each source lies from its language's, and from every other source's.

Terms are counted by (lang, source); a language keeps the terms of at least ``min_docs`` of its documents. A group's probability of a term is
smoothed and in whole billionths, so that every sum is exact.

* Terms in which a group exceeds its language: upper-bound search. A group's terms fall in buckets of equal count, whose probability is one number;
  the least probability in the language among them bounds what any of them can exceed. Buckets are evaluated best first until the bounds of the rest
  are strictly below the k-th value found. A group's terms are dealt over all tasks by term, so a group of any size is searched in parts; the parts'
  best meet in a last ranking.
* Distances of all pairs of sources: a term that neither has adds the difference of two constants, a term that one has is read off that group's
  count buckets, and only terms that both have are visited, through the postings of each term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orchardflow.llm._common import map_batches, slices, stored
from orchardflow.llm._words import HELD, Counted, blocks, found

SCALE, SMOOTH = 1_000_000_000, 5
#: Rows of postings that one array operation handles.
CHUNK = 400_000
#: A to Z lower-cased; what is in no term becomes a blank. Every byte of a character beyond ASCII is in terms.
TERMS = bytes(x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 128 else 32 for x in range(256))


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, df), summed within tasks: occurrences and documents of each term, in several rows from several tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        held = Counted()
        for batch in slices(batches, 512):
            own = np.fromiter((groups.setdefault(x, len(groups)) for x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)), np.int64, batch.num_rows)
            texts = [x.encode().translate(TERMS) for x in batch.column(2).to_pylist()]
            long, at = Counted(), -1
            for which, parts in blocks(texts):
                if len(long.parts) and which != [at]:
                    held.fold(long)
                    long = Counted()
                data, starts, ends, part = found(parts)
                text_no = np.array(which, np.int64)[part]
                into = held
                if len(which) == 1:  # perhaps a part of a long text, whose other parts follow
                    into, at = long, which[0]
                into.add(data, starts, ends, text_no, own[text_no])
            held.fold(long)
            if held.size > HELD:
                yield sent(held, groups)
                held.clear()
        yield sent(held, groups)

    def sent(held: Counted, groups: dict[tuple[str, str], int]) -> pa.RecordBatch:
        n, df, group, words = held.merged()
        names = list(groups)
        langs, sources = (pa.array([x[i] for x in names], pa.string()).take(pa.array(group)) for i in (0, 1))
        return pa.RecordBatch.from_arrays([langs, sources, words.cast(pa.string()), pa.array(n), pa.array(df)], ["lang", "source", "term", "n", "df"])

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return map_batches(docs.select(empty(lang), empty(source), empty(text)), run, "lang string, source string, term string, n long, df long")


def _share(count: Column, total: Column, kept: Column) -> Column:
    """A smoothed probability in billionths: 1 + floor(SCALE (count + 5) / (total + 5 V)), exact; null where nothing is kept."""
    top = (count.cast("decimal(20,0)") + SMOOTH) * F.lit(SCALE).cast("decimal(11,0)")
    below = total.cast("decimal(20,0)") + kept.cast("decimal(17,0)") * SMOOTH
    return F.when(kept > 0, 1 + F.call_function("div", top, below))


def searched(p: np.ndarray, q: np.ndarray, n: np.ndarray, terms: list[str], most: int, best: list[tuple[int, bytes]]) -> tuple[list[tuple[int, bytes]], int]:
    """The ``most`` terms of one group with the largest p - q above 0, as (q - p, term in UTF-8) in order, starting from ``best``; and how many were evaluated.

    Buckets of equal count ``n`` have one p. Their least q bounds them; the search ends when the next bound is strictly below the last place.
    """
    order = np.argsort(n, kind="stable")
    heads = np.flatnonzero(np.append(True, n[order][1:] != n[order][:-1]))
    ends = np.append(heads[1:], len(order))
    bounds = p[order[heads]] - np.minimum.reduceat(q[order], heads)
    evaluated = 0
    for i in np.argsort(-bounds, kind="stable").tolist():
        least = -best[-1][0] if len(best) == most else 1
        if bounds[i] < least or bounds[i] <= 0:
            break
        rows = order[heads[i] : ends[i]]
        evaluated += len(rows)
        f = p[rows] - q[rows]
        good = f >= least
        best = sorted([*best, *((-x, terms[r].encode()) for x, r in zip(f[good].tolist(), rows[good].tolist(), strict=True))])[:most]
    return best, evaluated


def shared_terms(term: np.ndarray, g: np.ndarray, p: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over terms (numbers, in runs) that two groups both have: by how much |p - p'| differs from what the two groups' buckets add for it, summed by pair."""
    a_all, b_all, v_all = ([np.zeros(0, np.int64)] for _ in range(3))
    left, step, size = np.arange(len(term)), 1, 0

    def summed() -> tuple[np.ndarray, ...]:
        x, y, v = (np.concatenate(z) for z in (a_all, b_all, v_all))
        if not len(x):
            return x, y, v
        order = np.lexsort((y, x))
        x, y, v = x[order], y[order], v[order]
        heads = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
        return x[heads], y[heads], np.add.reduceat(v, heads)

    while True:
        left = left[left + step < len(term)]
        left = left[term[left] == term[left + step]]
        if not len(left):
            return summed()
        i, j = left, left + step
        a_all.append(np.minimum(g[i], g[j]))
        b_all.append(np.maximum(g[i], g[j]))
        v_all.append(np.abs(p[i] - p[j]) - np.abs(p[i] - b[j]) - np.abs(b[i] - p[j]) + np.abs(b[i] - b[j]))
        size += len(left)
        if size > 2 * CHUNK:
            a_all, b_all, v_all = ([x] for x in summed())
            size = len(a_all[0])
        step += 1


def _walk(postings: DataFrame, most: int) -> DataFrame:
    """(a, b, v, term) from postings (lang, term, g, n, p, q, b): sums of pairs, with null ``term``, and each part's best terms of group ``a``, with null ``b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, bytes]]] = {}
        rest: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("t").to_numpy()
            cut = int(np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))[-1])  # where the last term begins
            if size + cut > CHUNK and (cut or last != ids[0]):
                yield chunk(pa.Table.from_batches([*rest, batch.slice(0, cut)]), best)
                rest, size = [], 0
                batch = batch.slice(cut)
            rest.append(batch)
            size += batch.num_rows
            last = ids[-1]
        if rest:
            yield chunk(pa.Table.from_batches(rest), best)
        rows = [(g, -f, t.decode()) for g, found_ in best.items() for f, t in found_]
        g, v, t = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.nulls(len(g), pa.int64()), pa.array(v, pa.int64()), pa.array(t, pa.string())], names)

    def chunk(table: pa.Table, best: dict[int, list[tuple[int, bytes]]]) -> pa.RecordBatch:
        t, g, n, p, q, b = (table.column(x).to_numpy() for x in ("t", "g", "n", "p", "q", "b"))
        terms = table.column("term").to_pylist()
        order = np.argsort(g, kind="stable")
        heads = np.flatnonzero(np.append(True, g[order][1:] != g[order][:-1]))
        for lo, hi in zip(heads.tolist(), [*heads[1:].tolist(), len(order)], strict=True):
            rows = order[lo:hi]
            own = int(g[rows[0]])
            best[own] = searched(p[rows], q[rows], n[rows], [terms[r] for r in rows.tolist()], most, best.get(own, []))[0]
        x, y, v = shared_terms(t, g, p, b)
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(v), pa.nulls(len(x), pa.string())], names)

    names = ["a", "b", "v", "term"]
    # a term's number only has to tell neighbours apart in the order by (lang, term); it is its hash
    rows = postings.withColumn("t", F.xxhash64("lang", "term"))
    return map_batches(rows.repartition("lang", "term").sortWithinPartitions("lang", "term").select("t", "term", "g", "n", "p", "q", "b"), run, "a long, b long, v long, term string")


def _apart(groups: DataFrame, buckets: DataFrame) -> DataFrame:
    """(a, b, v): of each pair of a language's groups what the terms add that at most one has, from one group's count buckets and constants.

    A row holds a group's buckets (as many as it has different counts) and the constants of its language's groups, as many as there are rows of the result for it.
    """
    own = buckets.groupBy("g").agg(F.collect_list("p").alias("ps"), F.collect_list("k").alias("ks"))
    others = groups.groupBy("lang").agg(F.collect_list(F.struct("g", "b", "m")).alias("others"))
    rows = groups.join(own, "g", "left").join(others, "lang").select("g", "b", "m", "kept", "ps", "ks", F.col("others.g").alias("og"), F.col("others.b").alias("ob"), F.col("others.m").alias("om"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            a_all, b_all, v_all = ([np.zeros(0, np.int64)] for _ in range(3))
            for row in batch.to_pylist():
                g, b, m = row["g"], row["b"], row["m"]
                og, ob, om = (np.array(row[x], np.int64) for x in ("og", "ob", "om"))
                ps, ks = (np.array(row[x] or [], np.int64) for x in ("ps", "ks"))
                order = np.argsort(ps)
                ps, ks = ps[order], ks[order]
                count, mass = (np.concatenate([[0], np.cumsum(x)]) for x in (ks, ps * ks))
                at = np.searchsorted(ps, ob)
                v = ob * count[at] - mass[at] + (mass[-1] - mass[at]) - ob * (count[-1] - count[at])
                v += np.where(og > g, (row["kept"] - m - om) * np.abs(ob - b), 0)
                ok = og != g
                a_all.append(np.minimum(og, g)[ok])
                b_all.append(np.maximum(og, g)[ok])
                v_all.append(v[ok])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a_all, b_all, v_all)], ["a", "b", "v"])

    return map_batches(rows, run, "a long, b long, v long")


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 30, most: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): for each (lang, source) group its distance from each other source of its language (part ``pair``),
    and the ``most`` terms whose share in the group exceeds that in the language by most (part ``term``).

    A term is a run of letters: bytes A to Z, lower-cased, a to z, and any character beyond ASCII. Each language keeps the terms that occur in at
    least ``min_docs`` of its documents. With V kept terms, a group with ``count`` occurrences of a term and N of all has p = 1 + floor(10^9 (count + 5) / (N + 5 V)),
    and the language q likewise. ``value`` is |p - p'| summed over all kept terms, or p - q; ranks go by value, ties by the UTF-8 bytes of ``item``.

    Null text, lang and source are empty strings. Each row is a document, repeated rows too. Groups without text or terms take part; where a language
    keeps no term, distances are 0. An empty table gives an empty result. Extra columns are ignored. The result has all pairs of a language's sources, so
    their number is taken to be moderate: a term's postings, one entry a source, are one row.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    counted = term_counts(docs, lang, source, text).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    by_term = counted.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("c"), F.collect_list(F.struct("source", "n")).alias("list")).where(F.col("df") >= min_docs)
    kept = stored(by_term.select("lang", "term", "c", "list"), "postings")
    postings = kept.select("lang", "term", "c", F.inline("list"))
    of_groups = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("m"))
    of_langs = kept.groupBy("lang").agg(F.sum("c").alias("lang_total"), F.count("*").alias("kept"))
    groups = docs.select(empty(lang).alias("lang"), empty(source).alias("source")).distinct().join(of_groups, ["lang", "source"], "left").join(of_langs, "lang", "left")
    groups = groups.fillna(0, ["total", "m", "lang_total", "kept"]).withColumn("g", F.monotonically_increasing_id())
    groups = stored(groups.withColumn("b", F.coalesce(_share(F.lit(0), F.col("total"), F.col("kept")), F.lit(0))), "groups")

    shares = postings.join(groups, ["lang", "source"]).select("lang", "term", "g", "n", "b", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), _share(F.col("c"), F.col("lang_total"), F.col("kept")).alias("q"))
    walked = stored(_walk(shares, most), "walked")
    buckets = shares.groupBy("g", "n").agg(F.first("p").alias("p"), F.count("*").alias("k"))
    sums = _apart(groups, buckets).unionByName(walked.where("term is null").select("a", "b", "v")).groupBy("a", "b").agg(F.sum("v").alias("value"))
    both = sums.select(F.inline(F.array(F.struct(F.col("a").alias("g"), F.col("b").alias("h")), F.struct(F.col("b").alias("g"), F.col("a").alias("h")))), "value")
    names = groups.select("g", "lang", "source")
    pairs = both.join(names, "g").join(names.select(F.col("g").alias("h"), F.col("source").alias("item")), "h").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = walked.where("term is not null").select(F.col("a").alias("g"), F.col("term").alias("item"), F.col("v").alias("value"))
    ranked = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("value"), "item"))
    terms = terms.withColumn("rank", ranked).where(F.col("rank") <= most).join(names, "g").select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    return pairs.unionByName(terms)
