"""Spelling variants: words at one edit from one another, found by a trie self-join with active-node sets over a partitioned vocabulary.

Two words at one edit agree before it and after it. The places of a word are cut in two segments; words that agree outside a segment share a partition,
so that the edit lies within the segment, and the trie there is that of what the words have in it. In a partition's trie each node has a set
of active nodes: those whose strings are at one edit from its own. The sets pass down from parents to children, level by level; a terminal node
with a terminal node in its set gives a pair. A partition with too many words is cut again: its segment is halved as often as it takes; where one place
is left, the words of a partition differ in that place only and cannot be more than there are letters.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchardflow.llm._common import map_batches, slices, stored
from orchardflow.llm._words import HELD, Counted, blocks, found

#: In Latin-1: A to Z lower-cased, letters and U+00C0 to U+00FF kept, all else blank.
LETTERS = bytes(x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 192 else 32 for x in range(256))
#: Words in a partition, and bytes of them, beyond which it is cut again.
GROUP, GROUP_BYTES = 4096, 1 << 20
#: Bytes of padded words that one trie is built of, if its partitions are not larger.
BLOCK = 1 << 21


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, slip: int | None = 199) -> DataFrame:
    """(word, n), summed within tasks: the runs of letters of ``least`` code points or more.

    With ``slip``, a run of which the crc32 of ``<id>:<run>`` is divisible by it loses its code point at crc32 modulo its length, before it is measured.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counted()
        for batch in slices(batches, 512):
            ids = [zlib.crc32(f"{x}:".encode()) for x in batch.column(0).to_pylist()]
            texts = [x.encode("latin-1", "replace").translate(LETTERS) for x in batch.column(1).to_pylist()]
            for which, parts in blocks(texts):
                data, starts, ends, part = found(parts)
                long = ends - starts >= least
                starts, ends, part = starts[long], ends[long], part[long]
                if slip is not None:
                    starts, ends, part = slipped(held, data, starts, ends, part, [ids[i] for i in which])
                held.add(data, starts, ends, part)
            if held.size > HELD:
                yield sent(held)
                held.clear()
        yield sent(held)

    def slipped(held: Counted, data: bytes, starts: np.ndarray, ends: np.ndarray, part: np.ndarray, ids: list[int]) -> tuple[np.ndarray, ...]:
        high = np.concatenate([[0], np.cumsum(np.frombuffer(data, np.uint8) >= 192, dtype=np.int64)])
        wide = (high[ends] > high[starts]).tolist()
        rows = zip(starts.tolist(), ends.tolist(), part.tolist(), wide, strict=True)
        h = np.fromiter((zlib.crc32(data[a:b].decode("latin-1").encode() if w else data[a:b], ids[i]) for a, b, i, w in rows), np.int64, len(starts))
        hit = h % slip == 0
        cut = []
        for a, b, x in zip(starts[hit].tolist(), ends[hit].tolist(), h[hit].tolist(), strict=True):
            at = a + x % (b - a)
            if b - a > least:
                cut.append(data[a:at] + data[at + 1 : b])
        if cut:
            changed, first, last, one = found(cut)
            held.add(changed, first, last, one)
        return starts[~hit], ends[~hit], part[~hit]

    def sent(held: Counted) -> pa.RecordBatch:
        n, _, _, words = held.merged()
        return pa.RecordBatch.from_arrays([pa.array([x.decode("latin-1") for x in words.to_pylist()], pa.string()), pa.array(n)], ["word", "n"])

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return map_batches(rows, run, "word string, n long")


def active_pairs(group: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of words at exactly one edit in the same group, each pair both ways; rows are sorted by group and word, and words differ in a group.

    One trie for each group, in arrays: nodes in order of depth, and within a depth of their words. No level looks at words, only at the active sets
    of the level above, the children of a node and the child of a node by a letter.
    """
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    width = int(sizes.max(initial=0))
    letters = np.zeros((n, width), np.uint8)
    letters[np.repeat(np.arange(n), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.frombuffer(b"".join(words), np.uint8)
    common = np.full(n, -1)  # letters shared with the row before, -1 where a group begins
    if n > 1 and width:
        differs = letters[1:] != letters[:-1]
        common[1:] = np.where(group[1:] == group[:-1], np.where(differs.any(axis=1), differs.argmax(axis=1), width), -1)
    parents, chars, ends, opens = [], [], [], [0]
    above = None
    for d in range(width + 1):
        first = np.flatnonzero((common < d) & (sizes >= d))
        if not len(first):
            break
        own = np.zeros(n, np.int64)
        own[first] = 1
        own = opens[-1] + np.cumsum(own) - 1
        parents.append(above[first] if d else np.full(len(first), -1))
        chars.append(letters[first, d - 1].astype(np.int64) if d else np.zeros(len(first), np.int64))
        ends.append(np.where(sizes[first] == d, first, -1))
        opens.append(opens[-1] + len(first))
        above = own
    parent, char, end = np.concatenate(parents), np.concatenate(chars), np.concatenate(ends)
    roots, total = opens[1], opens[-1]
    edge = parent[roots:] * 256 + char[roots:]  # rising; entry i is node roots + i
    child = roots + np.searchsorted(parent[roots:], np.arange(total + 1))
    width_of = np.diff(child)
    u_all, v_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def level(d: int) -> np.ndarray:
        return np.arange(opens[d], opens[d + 1]) if d + 1 < len(opens) else np.zeros(0, np.int64)

    below = level(1)
    u, v = parent[below], below  # a root's active nodes: its children
    for d in range(len(opens) - 1):
        both = (end[u] >= 0) & (end[v] >= 0)
        u_all.append(end[u[both]])
        v_all.append(end[v[both]])
        nodes = level(d + 1)
        if not len(nodes):
            break
        live = (width_of[u] > 0) & (width_of[v] > 0)
        u, v = u[live], v[live]
        times = width_of[u]
        c = np.repeat(child[u] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        sought = np.repeat(v, times) * 256 + char[c]
        at = np.minimum(np.searchsorted(edge, sought), len(edge) - 1)
        hit = edge[at] == sought
        c, m = c[hit], roots + at[hit]  # both go on by the same letter
        fresh = (m != parent[c]) & (parent[m] != c)
        u_new, v_new = [c[fresh], nodes], [m[fresh], parent[nodes]]  # and the letter deleted
        below = level(d + 2)
        u_new.append(parent[below])  # a letter inserted
        v_new.append(below)
        left, step = nodes, 1
        while len(left):  # the letter replaced
            left = left[left + step < opens[d + 2]]
            left = left[parent[left] == parent[left + step]]
            u_new += [left, left + step]
            v_new += [left + step, left]
            step += 1
        u, v = np.concatenate(u_new), np.concatenate(v_new)
    return np.concatenate(u_all), np.concatenate(v_all)


def _cut(segment: Column) -> DataFrame:
    """For a word and a segment (m, a, b): what it has in the segment, and the partition's key of 128 bits."""
    word, m, a, b = F.col("word"), segment["m"], segment["a"], segment["b"]
    behind = m - b
    prefix, suffix = F.substring(word, F.lit(1), a), F.substring(word, F.length(word) - behind + 1, behind)
    part = F.substring(word, a + 1, F.length(word) - behind - a)
    keys = [F.xxhash64(F.lit(seed), m, a, b, prefix, suffix).alias(k) for seed, k in ((1, "k1"), (7, "k2"))]
    return [segment.alias("segment"), part.alias("part"), *keys]


def _dealt(words: DataFrame, group: int, group_bytes: int) -> list[DataFrame]:
    """Frames (word, n, part, k1, k2): each word in the partitions of its segments. A pair whose longer word has m code points is looked for at m."""

    def segment(m: Column, a: Column, b: Column) -> Column:
        return F.struct(m.cast("int").alias("m"), a.cast("int").alias("a"), b.cast("int").alias("b"))

    size = F.length("word")
    every = [segment(m, a, b) for m in (size, size + 1) for a, b in ((F.lit(0), F.floor(m / 2)), (F.floor(m / 2), m))]
    now = words.select("word", "n", F.explode(F.array(*every)).alias("s")).select("word", "n", *_cut(F.col("s")))
    ready = []
    while True:
        now = stored(now, "segments")
        sizes = now.groupBy("k1", "k2").agg(F.count("*").alias("rows"), F.sum(F.length("part")).alias("bytes"), F.first("segment").alias("s"))
        large = stored(sizes.where(((F.col("rows") > group) | ((F.col("bytes") > group_bytes) & (F.col("rows") > 1))) & (F.col("s.b") - F.col("s.a") > 1)).select("k1", "k2"), "large")
        if large.isEmpty():
            return [*ready, now]
        ready.append(now.join(large, ["k1", "k2"], "left_anti"))
        s = F.col("segment")
        middle = F.floor((s["a"] + s["b"]) / 2)
        halves = F.array(segment(s["m"], s["a"], middle), segment(s["m"], middle, s["b"]))
        now = now.join(large, ["k1", "k2"]).select("word", "n", F.explode(halves).alias("s")).select("word", "n", *_cut(F.col("s")))


def near_words(words: DataFrame, group: int | None = None, group_bytes: int | None = None) -> DataFrame:
    """(word, near, near_n): all pairs of different ``words`` (word, n) at exactly one inserted, deleted or replaced code point, both ways, from U+0001 to U+00FF."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size, width, rest = 0, 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            k1, k2 = (rest.column(c).to_numpy() for c in ("k1", "k2"))
            if not len(k1):
                continue
            heads = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))
            cut = int(heads[-1])
            several = np.repeat(np.diff(np.append(heads, len(k1))) > 1, np.diff(np.append(heads, len(k1))))[:cut]
            ready, rest = rest.slice(0, cut).filter(pa.array(several)), rest.slice(cut)
            for some in parted(ready):
                most = max(map(len, some.column("part").to_pylist()), default=0)
                if held and (size + some.num_rows) * max(width, most) > BLOCK:
                    yield block(held)
                    held, size, width = [], 0, 0
                held.append(some)
                size, width = size + some.num_rows, max(width, most)
        if rest is not None and rest.num_rows > 1:
            held.append(rest)
        if held:
            yield block(held)

    def parted(table: pa.Table) -> Iterator[pa.Table]:
        """Whole partitions, long parts apart from short ones."""
        if not table.num_rows:
            return
        k1 = table.column("k1").to_numpy()
        heads = np.flatnonzero(np.append(True, k1[1:] != k1[:-1]))
        sizes = np.fromiter(map(len, table.column("part").to_pylist()), np.int64, table.num_rows)
        long = np.maximum.reduceat(sizes, heads) > 64
        where = np.repeat(long, np.diff(np.append(heads, table.num_rows)))
        if not where.all():
            yield table.filter(pa.array(~where))
        for i in np.flatnonzero(long).tolist():
            yield table.slice(heads[i], (heads[i + 1] if i + 1 < len(heads) else table.num_rows) - heads[i])

    def block(held: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(held).combine_chunks()
        k1, k2 = (table.column(c).to_numpy() for c in ("k1", "k2"))
        group = np.cumsum(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))
        i, j = active_pairs(group, [x.encode("latin-1") for x in table.column("part").to_pylist()])
        word, n = (table.column(c).combine_chunks() for c in ("word", "n"))
        return pa.RecordBatch.from_arrays([word.take(pa.array(i)), word.take(pa.array(j)), n.take(pa.array(j))], ["word", "near", "near_n"])

    out = None
    for rows in _dealt(words, group or GROUP, group_bytes or GROUP_BYTES):
        chosen = rows.select("k1", "k2", "part", "word", "n").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "part")
        pairs = map_batches(chosen, run, "word string, near string, near_n long")
        out = pairs if out is None else out.unionByName(pairs)
    # a pair can be found in more than one segment; both group-bys use one exchange
    return out.repartition("word").groupBy("word", "near").agg(F.first("near_n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, by doubling the step; forms must not go round."""
    now = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        now = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, times: int = 5, factor: int = 5, slip: int | None = 199) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word of ``least`` code points or more that occurs at least ``times`` times in all texts.

    Words are runs of A to Z (lower-cased), a to z and U+00C0 to U+00FF; ``slip`` plants misspellings as in :func:`word_counts`. ``n_near`` counts
    the words at one edit. ``form`` is the commonest of them (ties: the first in code-point order), if it is at least ``factor`` (2 or more) times as common as the word; else
    null. ``root`` is where the forms lead. Null texts have no words; a null id is as an empty one; repeated rows count each; an empty table gives
    an empty result. Extra columns are ignored.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more: else forms may go round")
    words = stored(word_counts(docs, id_col, text_col, least, slip).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times), "words")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("x"), "near")).alias("best"))
    found_ = stored(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.x")).alias("near_n")), "near")
    good = F.col("near_n") >= factor * F.col("n")
    told = found_.select("word", "n", "n_near", F.when(good, F.col("near")).alias("form"), F.when(good, F.col("near_n")).alias("form_n"))
    return told.join(roots(told.where("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word"))
