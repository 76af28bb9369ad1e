"""Removal of long byte strings that occur more than once, by blockwise suffix sorting with a difference cover.

1. Equal texts are one text with a count. The distinct texts are written once, bucketed by their key.
2. Every 400-byte window of a text is owned by its least 64-byte gram (by hash, the leftmost of equals). Equal windows have equal
   owners, so a suffix bucket is all windows of one owner hash; windows whose owner occurs nowhere else cannot repeat. Runs of
   windows of one owner are a region; regions with the same bytes are one class with a weight.
3. Each task sorts the suffixes of its buckets block by block: first by their first and last 32 bytes, then ties by the
   ranks of a difference-cover sample (every two suffixes have an offset below 31 at which both are in the sample), so
   that a comparison costs one look-up however long the common prefix is, and memory is bounded by the block.
4. The repeating windows go back to the texts, whose bytes under them are cut.

A string can only repeat where every shorter string in it does. So where both shorter passages and longer strings are asked for, the
longer ones are searched within the runs of the shorter.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orchardflow.llm._common import discard, map_batches, scratch, shuffles_go, slices, stored

#: A difference cover modulo 31: every difference of residues is one of two members.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
GRAM = 64
HEAD = 32
#: Bytes of text handled by one array operation; bounds a worker's memory.
BLOCK = 1 << 21
#: Places hashed by one array operation, so that its arrays stay in a core's cache.
CHUNK = 1 << 15
#: A passage: a repeated run of so many bytes at least, and of more than so many words. 51 words of prose are longer than this in any language.
PASSAGE, WORDS = 240, 50
MIX = np.uint64(0x9E3779B97F4A7C15)
FOLD = np.uint64(0xC2B2AE3D27D4EB4F)
LOW = np.uint64(0xFFFFFF)


def _meeting() -> np.ndarray:
    """For each two residues the least offset that brings both into the cover."""
    found = np.zeros((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            found[a, b] = next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER)
    return found


MEETING = _meeting()


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as a number, the first of them the lowest."""
    return np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,)).astype(np.uint64)


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes (a power of two, 8 at least) at each place."""
    places = len(data) - size + 1
    out = np.empty(places, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, places, CHUNK):
            x = _words(data[at : at + CHUNK + size - 1])
            step = 8
            while step < size:
                y = x[:-step] * MIX
                y ^= x[step:] >> np.uint64(29)
                y ^= x[step:] * FOLD
                x = y
                step *= 2
            x ^= x >> np.uint64(31)
            x *= MIX
            x ^= x >> np.uint64(29)
            out[at : at + CHUNK] = x
    return out


def owners(data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Regions of the texts that lie end to end in ``data``: (text, first start, last start, owner's hash).

    Each start of a window of ``length`` bytes within a text is in exactly one region.
    """
    ends = np.cumsum(sizes)
    starts = ends - sizes
    grams, places = length - GRAM + 1, len(data) - length + 1
    found, hashes, before = [], [], None
    for at in range(0, places, CHUNK):
        x = _hashes(data[at : at + CHUNK + length - 1], GRAM)
        least, span = (x & ~LOW) | np.arange(at, at + len(x), dtype=np.uint64), 1
        while span * 2 <= grams:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < grams:
            least = np.minimum(least[: len(least) - (grams - span)], least[grams - span :])
        opens = np.append(before is None or least[0] != before, least[1:] != least[:-1])
        opens[starts[np.searchsorted(starts, at) : np.searchsorted(starts, at + len(least))] - at] = True
        opens = np.flatnonzero(opens)
        found.append(opens + at)
        hashes.append(x[(least[opens] & LOW).astype(np.int64) - at])
        before = least[-1]
    cuts, owner = np.concatenate(found), np.concatenate(hashes)
    text = np.searchsorted(ends, cuts, side="right")
    last = np.minimum(np.append(cuts[1:], places) - 1, ends[text] - length)
    ok = cuts <= last
    text, first, last = text[ok], cuts[ok], last[ok]
    return text, first - starts[text], last - starts[text], owner[ok]


def _segments(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """Texts (k1, k2, copies, base, data) in groups of about BLOCK bytes; longer texts are cut, overlapping so that every window is in one cut."""
    keys: list[tuple] = []
    parts: list[bytes] = []
    held = 0
    for batch in slices(batches, 64):
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for a, b, copies, base, text in zip(*columns, strict=True):
            data = text.encode() if isinstance(text, str) else bytes(text)
            for start in range(0, len(data) - length + 1, BLOCK):
                keys.append((a, b, copies, base + start))
                parts.append(data[start : start + BLOCK + length - 1])
                held += len(parts[-1])
                if held >= BLOCK:
                    yield keys, parts
                    keys, parts, held = [], [], 0
    if parts:
        yield keys, parts


def regions(texts: DataFrame, length: int) -> DataFrame:
    """(owner, region, k1, k2, first, windows, times, copies) of each region; ``region`` is the hash of its bytes.

    Equal regions that follow one another, as in periodic text, are one row with their number in ``times``; ``copies`` counts those of all
    copies of the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, parts in _segments(batches, length):
            text, first, last, owner = owners(np.frombuffer(b"".join(parts), np.uint8), np.array(list(map(len, parts)), np.int64), length)
            digest = xxhash.xxh64_intdigest
            same = np.fromiter((digest(parts[t][a:b]) for t, a, b in zip(text.tolist(), first.tolist(), (last + length).tolist(), strict=True)), np.uint64, len(text))
            again = (text[1:] == text[:-1]) & (owner[1:] == owner[:-1]) & (same[1:] == same[:-1]) & (first[1:] == last[:-1] + 1)
            heads = np.flatnonzero(np.append(True, ~again)) if len(text) else np.zeros(0, np.int64)
            times = np.diff(np.append(heads, len(text)))
            text, first, last, owner, same = (x[heads] for x in (text, first, last, owner, same))
            k = np.array(keys, np.int64).reshape(-1, 4)[text]
            columns = [owner.view(np.int64), same.view(np.int64), k[:, 0], k[:, 1], (first + k[:, 3]).astype(np.int64), (last - first + 1).astype(np.int32), times.astype(np.int64), k[:, 2] * times]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["owner", "region", "k1", "k2", "first", "windows", "times", "copies"])

    return map_batches(texts.select("k1", "k2", "copies", "base", F.col("data").cast("binary")), run, "owner long, region long, k1 long, k2 long, first long, windows int, times long, copies long")


def owner_counts(rows: DataFrame) -> DataFrame:
    """(owner, n): how many regions of all copies each owner hash has; summed within a task first, so that common owners send few rows."""
    return rows.groupBy("owner").agg(F.sum("copies").alias("n"))


def repeated(rows: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The regions whose owner occurs again, and their classes: (owner, region, weight, classes, k1, k2, first, windows).

    ``weight`` is how often a class of equal regions occurs, ``classes`` how many classes its owner has; k1 to windows tell one of its regions. An
    owner's rows meet in joins and aggregates only, which Spark combines before the shuffle or splits, so a common owner needs no task of its own.
    """
    members = stored(rows.join(counts.where("n > 1").select("owner"), "owner"), "regions")
    classes = members.groupBy("owner", "region").agg(F.sum("copies").alias("weight"), F.min(F.struct("k1", "k2", "first", "windows")).alias("head"))
    several = classes.groupBy("owner").agg(F.count("*").alias("classes"))
    return members, classes.join(several, "owner").select("owner", "region", "weight", "classes", "head.*")


def _grouped(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the pairs (a, b), and the rank of each one's pair in that order."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, place = int(b.max()).bit_length(), len(a).bit_length()
    key = (a << np.uint64(low)) | b
    if int(a.max()).bit_length() + low + place <= 64:  # with their places in one number: sorted far faster than by an index
        key = np.sort((key << np.uint64(place)) | np.arange(len(a), dtype=np.uint64))
        order = (key & np.uint64((1 << place) - 1)).astype(np.int64)
        key >>= np.uint64(place)
    else:
        order = np.argsort(key)
        key = key[order]
    return order, np.append(False, key[1:] != key[:-1]).cumsum()


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    order, group = _grouped(a, b)
    rank = np.empty(len(a), np.uint64)
    rank[order] = group
    return rank


def repeating(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes at each of the ``starts`` are also at another of them."""
    if len(starts) < 2:
        return np.zeros(len(starts), bool)
    n = len(data)
    words = _words(np.concatenate([data, np.zeros(length + HEAD, np.uint8)])).byteswap()
    rank = _pair(words >> np.uint64(24), np.zeros(len(words), np.uint64))
    for step in (5, 10, 12):
        rank = _pair(rank[:-step], rank[step:])
    head = rank  # of the 32 bytes at each place
    tail = length - HEAD
    order, group = _grouped(head[starts], head[starts + tail])
    sizes = np.bincount(group)
    live = sizes[group] > 1
    order, group = order[live], group[live]
    found = np.zeros(len(starts), bool)
    if not len(order):
        return found
    # ranks of the cover sample to ``tail`` bytes; in arrays over all places, but only the sample's are set
    sample = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
    stride = 2 * PERIOD
    slot = np.zeros(n + length, np.int64)
    slot[sample] = np.arange(len(sample))

    def beyond(ranks: np.ndarray, d: int) -> np.ndarray:
        return np.where(sample + d < n, ranks[slot[np.minimum(sample + d, n - 1)]], 0)

    def at(d: int) -> np.ndarray:
        return head[np.minimum(sample + d, len(head) - 1)]

    first = _pair(at(0), at(stride - HEAD))
    deep, depth = first, stride
    while depth * 2 <= tail - HEAD:
        deep = _pair(deep, beyond(deep, depth))
        depth *= 2
    while depth + stride <= tail:
        deep = _pair(deep, beyond(first, depth))
        depth += stride
    while depth < tail:
        step = min(depth, tail - HEAD)
        deep = _pair(deep, at(step))
        depth = step + HEAD
    while len(order):  # each round parts every group by one of its members: less, equal, greater
        edges = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        sizes = np.diff(np.append(edges, len(group)))
        pivot = starts[np.repeat(order[edges + sizes // 2], sizes)]
        own = starts[order]
        d = MEETING[own % PERIOD, pivot % PERIOD]
        a, b = deep[slot[own + d]], deep[slot[pivot + d]]
        equal = a == b
        n_equal = np.repeat(np.add.reduceat(equal.astype(np.int64), edges), sizes)
        found[order[equal & (n_equal > 1)]] = True
        part = 2 * group[~equal] + (a > b)[~equal]
        order = order[~equal]
        by = np.argsort(part, kind="stable")
        order, part = order[by], part[by]
        if not len(order):
            break
        group = np.cumsum(np.append(True, part[1:] != part[:-1])) - 1
        live = np.bincount(group)[group] > 1
        order, group = order[live], group[live]
        if len(group):
            group = np.cumsum(np.append(True, group[1:] != group[:-1])) - 1
    return found


def ends_shared(parts: list[bytes], length: int) -> np.ndarray:
    """Of all windows of the parts, whether another has the same first and last HEAD bytes; handles about BLOCK bytes at a time."""
    keys, at = [], 0
    while at < len(parts):
        top, size = at, 0
        while top < len(parts) and (size < BLOCK or top == at):
            size += len(parts[top])
            top += 1
        sizes = np.array(list(map(len, parts[at:top])), np.int64)
        windows = sizes - length + 1
        starts = np.arange(windows.sum()) + np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(windows) - windows), windows)
        x = _hashes(np.frombuffer(b"".join(parts[at:top]), np.uint8), HEAD)
        with np.errstate(over="ignore"):
            keys.append(x[starts] * MIX ^ x[starts + length - HEAD])
        at = top
    every = np.concatenate([np.zeros(0, np.uint64), *keys])
    place = np.uint64(len(every).bit_length())  # gives way to the window's number; windows whose hashes then agree are only sorted too
    ordered = np.sort((every >> place << place) | np.arange(len(every), dtype=np.uint64))
    same = ordered[1:] >> place == ordered[:-1] >> place
    found = np.zeros(len(every), bool)
    found[(ordered[np.append(same, False) | np.append(False, same)] & ((np.uint64(1) << place) - np.uint64(1))).astype(np.int64)] = True
    return found


def sorted_buckets(classes: DataFrame, length: int) -> DataFrame:
    """(owner, region, low, high): the runs of windows of each class that occur in another class of its owner, or twice by weight.

    Whole buckets are sorted together while a block has room; a bucket larger than a block makes one of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in slices(batches, 512):
            owner = batch.column("owner").to_numpy()
            cuts = [0, *(np.flatnonzero(owner[1:] != owner[:-1]) + 1).tolist(), len(owner)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if size > BLOCK and owner[a] != last:
                    yield block(held)
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size += sum(map(len, held[-1].column("data").to_pylist()))
                last = owner[a]
        if held:
            yield block(held)

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        parts = table.column("data").to_pylist()
        sizes = np.array(list(map(len, parts)), np.int64)
        windows = sizes - length + 1
        which = np.repeat(np.arange(len(parts)), windows)
        within = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
        # only what shares its first and last bytes with something else is sorted
        found = np.zeros(len(which), bool)
        left = np.flatnonzero(ends_shared(parts, length))
        some, place = np.unique(which[left], return_inverse=True)
        ends = np.cumsum(sizes[some])
        found[left] = repeating(np.frombuffer(b"".join(parts[i] for i in some.tolist()), np.uint8), (ends - sizes[some])[place] + within[left], length)
        found |= (table.column("weight").to_numpy() > 1)[which]
        padded = np.concatenate([[False], found, [False]])
        same = np.concatenate([[False], which[1:] == which[:-1], [False]])
        low = np.flatnonzero(found & ~(padded[:-2] & same[:-1]))
        high = np.flatnonzero(found & ~(padded[2:] & same[1:]))
        return pa.RecordBatch.from_arrays(
            [*(table.column(x).combine_chunks().take(pa.array(which[low])) for x in ("owner", "region")), pa.array(within[low]), pa.array(within[high])], ["owner", "region", "low", "high"]
        )

    return map_batches(classes.repartition("owner").sortWithinPartitions("owner"), run, "owner long, region long, low long, high long")


def _text_keys(text):
    """A 128-bit key of a text in two longs."""
    return F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")


def distinct_texts(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """(k1, k2, copies, data) of the different texts of ``length`` bytes or more, bucketed by their key.

    A table of random name over files in the shared folder, which its owner clears as a whole; the result reads it, so it is not dropped here.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    distinct = (
        docs.select(F.col(text_col).cast("string").alias("data"))
        .where(F.octet_length("data") >= length)
        .select(*_text_keys(F.col("data")), "data")
        .groupBy("k1", "k2")
        .agg(F.count("*").alias("copies"), F.first("data").alias("data"))
        .repartition(n, "k1", "k2")
    )
    with shuffles_go(spark):
        distinct.write.option("path", scratch(spark, "texts")).option("compression", "zstd").bucketBy(n, "k1", "k2").sortBy("k1", "k2").saveAsTable(name)
    return spark.table(name)


def _piece(start, size):
    """Bytes of a text: from ``start``, ``size`` of them."""
    return F.substring(F.col("data").cast("binary"), (start + 1).cast("int"), size.cast("int"))


def runs(texts: DataFrame, length: int, within: DataFrame | None = None) -> DataFrame:
    """(k1, k2, a, b): the maximal runs of bytes, from a up to b, that lie in strings of ``length`` bytes which start anywhere else too.

    ``within`` has the runs (k1, k2, a, b) of a smaller length, beyond which nothing is searched.
    """
    segments = texts.withColumn("base", F.lit(0).cast("long"))
    if within is not None:
        segments = texts.join(within.where(F.col("b") - F.col("a") >= length), ["k1", "k2"]).select("k1", "k2", "copies", F.col("a").alias("base"), _piece(F.col("a"), F.col("b") - F.col("a")).alias("data"))
    rows = stored(regions(segments, length), "windows")
    members, classes = repeated(rows, owner_counts(rows))
    discard(rows)
    shipped = classes.where("classes > 1").join(texts.select("k1", "k2", "data"), ["k1", "k2"])
    shipped = shipped.select("owner", "region", "weight", _piece(F.col("first"), F.col("windows") + (length - 1)).alias("data"))
    whole = classes.where("classes = 1").select("owner", "region", F.lit(0).cast("long").alias("low"), (F.col("windows") - 1).cast("long").alias("high"))
    found = sorted_buckets(shipped, length).unionByName(whole)
    start, stop = F.col("first") + F.col("low"), F.col("first") + F.col("high") + length
    single = members.where("times = 1").join(found, ["owner", "region"]).select("k1", "k2", start.alias("a"), stop.alias("b"))
    # regions that repeat at once repeat as wholes
    several = members.where("times > 1").select("k1", "k2", F.col("first").alias("a"), (F.col("first") + F.col("times") * F.col("windows") + (length - 1)).alias("b"))
    return _joined(single.unionByName(several))


def _joined(spans: DataFrame) -> DataFrame:
    """Spans of each text that overlap or touch as one; a text's spans are ordered together, and their number is bounded by its length."""
    order = Window.partitionBy("k1", "k2").orderBy("a", "b")
    before = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("opens", F.coalesce((F.col("a") > before).cast("int"), F.lit(1)))
    numbered = opened.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("k1", "k2", "run").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("run")


def cut_texts(texts: DataFrame, found: DataFrame, passages: DataFrame | None = None, over_words: int | None = None) -> DataFrame:
    """(k1, k2, n_removed, n_spans, kept_sha256, kept) for each of ``texts`` of which the runs ``found`` are removed.

    With ``over_words`` only runs of more words are. With ``passages``, other runs, also n_passage_bytes and ``text``, what is left without
    those passages that have more than ``over_words`` words; ``found`` is then cut whatever its words.
    """
    several = passages is not None
    marks = found.withColumn("of", F.lit(0))
    if several:
        marks = marks.unionByName(passages.withColumn("of", F.lit(1)))
    marks = marks.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("of", "a", "b"))).alias("marks"))

    def wordy(raw: bytes, a: int, b: int) -> bool:
        return over_words is None or len(raw[a:b].split()) > over_words

    def without(raw: bytes, cuts: list[tuple[int, int]]) -> bytes:
        rest, at = [], 0
        for a, b in cuts:
            rest.append(raw[at:a])
            at = b
        return b"".join([*rest, raw[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for k1, k2, data, all_marks in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                raw = data.encode()
                cuts = [(m["a"], m["b"]) for m in all_marks if m["of"] == 0 and (several or wordy(raw, m["a"], m["b"]))]
                kept = without(raw, cuts)
                row = [k1, k2, len(raw) - len(kept), len(cuts), hashlib.sha256(kept).hexdigest(), kept]
                if several:
                    gone = [(m["a"], m["b"]) for m in all_marks if m["of"] == 1 and wordy(raw, m["a"], m["b"])]
                    row += [sum(b - a for a, b in gone), without(raw, gone).decode("utf-8", "ignore")]
                rows.append(row)
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=False)], names)

    names = ["k1", "k2", "n_removed", "n_spans", "kept_sha256", "kept", *["n_passage_bytes", "text"] * several]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string()]
    schema = "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, kept binary" + ", n_passage_bytes long, text string" * several
    return map_batches(texts.select("k1", "k2", "data").join(marks, ["k1", "k2"]), run, schema)


def _at_least(length: int) -> None:
    if length < 4 * HEAD + GRAM:
        raise ValueError(f"length must be at least {4 * HEAD + GRAM}")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, keep_text: bool = True, passage: int | None = None, over_words: int = WORDS) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256) for each row; with ``keep_text`` also ``kept`` (binary); with ``passage`` also n_passage_bytes and ``text``.

    Texts are UTF-8 bytes (null: empty). A byte is removed if it lies in a string of ``length`` bytes that also starts anywhere
    else, in the same text or another; overlaps count; strings are judged on the input. Texts shorter than ``length`` lose
    nothing. Repeated rows are occurrences of their own: if long enough, all lose everything. Null ids stay. An empty table gives
    an empty result. Extra columns are ignored.

    ``text`` is the whole text without its repeated passages: the runs of strings of ``passage`` bytes (less than ``length``) that start anywhere
    else too, where a run has more than ``over_words`` words. A character cut in part goes whole.
    """
    _at_least(passage or length)
    if passage and passage >= length:
        raise ValueError("passage must be less than length")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = distinct_texts(docs, text_col, passage or length)
    short = stored(runs(texts, passage), "runs") if passage else None
    found = stored(runs(texts, length, short), "runs")
    cut = cut_texts(texts, found, short, over_words if passage else None)
    whole = keep_text or passage
    rows = docs.select(F.col(id_col).alias("id"), text.alias("data")).select(
        "id",
        *_text_keys(F.col("data")),
        F.octet_length("data").cast("long").alias("n_bytes"),
        F.sha2(F.col("data").cast("binary"), 256).alias("own"),
        *([F.when(F.octet_length("data") < (passage or length), F.col("data")).alias("short")] if whole else []),
    )
    out = rows.join(cut if keep_text else cut.drop("kept"), ["k1", "k2"], "left")
    if whole:  # long texts come from the bucketed table: the rows' side of the join is narrow
        out = out.join(texts.select("k1", "k2", "data"), ["k1", "k2"], "left").withColumn("data", F.coalesce("data", "short"))
    return out.select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "own").alias("kept_sha256"),
        *([F.coalesce("kept", F.col("data").cast("binary")).alias("kept")] if keep_text else []),
        *([F.coalesce("n_passage_bytes", F.lit(0)).cast("long").alias("n_passage_bytes"), F.coalesce("text", "data").alias("text")] if passage else []),
    )


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = PASSAGE, over_words: int | None = WORDS, count_col: str = "n_chars") -> DataFrame:
    """``docs`` with repeated passages cut from its texts; ``count_col``, if there, becomes the new number of characters.

    A passage is a run of strings of ``length`` bytes that also start anywhere else, if the run has more than ``over_words`` words (None: any). A
    character of which some bytes go, goes whole. Null texts stay null, rows and other columns stay as they are. The cases of :func:`dedup` hold.
    """
    _at_least(length)
    texts = distinct_texts(docs, text_col, length)
    kept = cut_texts(texts, stored(runs(texts, length), "runs"), over_words=over_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [x.decode("utf-8", "ignore") for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.string())], ["_k1", "_k2", "_kept"])

    cut = map_batches(kept.where("n_removed > 0").select("k1", "k2", "kept"), run, "_k1 long, _k2 long, _kept string")
    text = F.col(text_col).cast("string")
    keys = [F.coalesce(k, F.lit(0)) for k in (F.xxhash64(text), F.xxhash64(F.lit(7), text))]
    out = docs.withColumn("_a", keys[0]).withColumn("_b", keys[1]).join(cut, (F.col("_a") == F.col("_k1")) & (F.col("_b") == F.col("_k2")), "left")
    new = F.coalesce("_kept", F.col(text_col))
    return out.select(*(new.alias(c) if c == text_col else F.coalesce(F.length("_kept").cast(docs.schema[c].dataType), F.col(c)).alias(c) if c == count_col else F.col(c) for c in docs.columns))
