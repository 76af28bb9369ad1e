"""SimHash near-duplicates linked through segment popcounts.

A fingerprint is embedded as the bit counts of its 16 four-bit segments. The Manhattan distance of two embeddings never
exceeds the Hamming distance of the fingerprints, so links of at most two bits lie within Manhattan distance two. Two grid
points that close share a grid point at distance one or less of both; each fingerprint is therefore entered at its own
point and the at most 32 points beside it, and only fingerprints that meet at a point are compared, exactly, by XOR.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchardflow.llm._common import components, discard, groups, map_batches, slices, stored

SEED = 42
SEGMENTS = 16
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: From so many fingerprints at a grid point, a second grid over other segments deals them again before pairs are compared.
DENSE = 128


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; 0 for a text without words or null.

    >>> fingerprint(None), fingerprint(" \\t")
    (0, 0)
    """
    parts = (text or "").encode().translate(LOWER).split()
    if not parts:
        return 0
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(b" ".join(parts), SEED)
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    counts = np.zeros(64, np.int64)
    n = len(parts) - words + 1
    for at in range(0, n, 1 << 16):
        top = min(n, at + (1 << 16))
        starts, stops = (ends - sizes)[at:top].tolist(), ends[at + words - 1 : top + words - 1].tolist()
        found = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64, top - at)
        counts += np.unpackbits(found.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp): one row for each row of ``docs``, fp the fingerprint as a signed long. Other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = np.fromiter((fingerprint(x, words) for x in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], ["id", "fp"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), run, "id long, fp long")


def grid_points(fp: Column) -> Column:
    """The fingerprint's grid point (a long, one nibble for each segment's bit count) and the points beside it."""
    own = sum((F.shiftrightunsigned(fp, i).bitwiseAND(F.lit(0x1111111111111111)) for i in range(1, 4)), fp.bitwiseAND(F.lit(0x1111111111111111)))
    beside = []
    for i in range(SEGMENTS):
        count = F.shiftrightunsigned(own, 4 * i).bitwiseAND(F.lit(7))
        beside += [F.when(count < 4, own + F.lit(1 << 4 * i)), F.when(count > 0, own - F.lit(1 << 4 * i))]
    return F.array_compact(F.array(own, *beside))


def _join(found: np.ndarray, root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)


def _roots(root: np.ndarray) -> np.ndarray:
    while (root[root] != root).any():
        root = root[root]
    return root


def _second_grid(found: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bit counts of 16 other segments (every sixteenth bit), as a point, and what is added to it for the points beside; 0 where there is none."""
    bits = np.unpackbits(found.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = bits.reshape(-1, 4, SEGMENTS).sum(axis=1).astype(np.uint64)
    places = np.uint64(4) * np.arange(SEGMENTS, dtype=np.uint64)
    beside = []
    with np.errstate(over="ignore"):
        for i in range(SEGMENTS):
            one = np.uint64(1) << places[i]
            beside += [np.where(counts[:, i] < 4, one, np.uint64(0)), np.where(counts[:, i] > 0, np.uint64(0) - one, np.uint64(0))]
    return (counts << places).sum(axis=1, dtype=np.uint64), beside


def _met(found: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Fingerprints that meet at a point of the second grid: their places, sorted by point, and the points; in parts, for memory."""
    own, beside = _second_grid(found)
    parts = 1 + 33 * len(found) // 4_000_000
    mixed = np.uint64(0x9E3779B97F4A7C15)
    for part in range(parts):
        places, points = [], []
        for add in [np.zeros(len(found), np.uint64), *beside]:
            with np.errstate(over="ignore"):
                at = own + add
                mine = ((at * mixed) >> np.uint64(33)) % np.uint64(parts) == part
            mine &= (add != 0) if len(points) else True
            places.append(np.flatnonzero(mine))
            points.append(at[mine])
        place, point = np.concatenate(places), np.concatenate(points)
        order = np.argsort(point, kind="stable")
        yield place[order], point[order]


def linked(found: np.ndarray, bits: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (at most ``bits`` differing bits) among distinct fingerprints, as two arrays.

    Where very many share a point, their bit counts over other segments part them once more; those that meet there too are compared by XOR.
    """
    root = np.arange(len(found))
    if len(found) < DENSE:
        for at in range(0, len(found), 256):
            near = np.bitwise_count(found[at : at + 256, None] ^ found[None, at:]) <= bits
            a, b = near.nonzero()
            _join(found, root, (a + at)[b > a], (b + at)[b > a])
    else:
        for place, point in _met(found):
            left, step = np.arange(len(place)), 1
            while len(left):  # each with the one ``step`` places on at its point
                left = left[left + step < len(place)]
                left = left[point[left] == point[left + step]]
                root = _roots(root)
                a, b = place[left], place[left + step]
                fresh = root[a] != root[b]  # what is tied already needs no comparison
                a, b = a[fresh], b[fresh]
                near = np.bitwise_count(found[a] ^ found[b]) <= bits
                _join(found, root, a[near], b[near])
                step += 1
    root = _roots(root)
    far = np.flatnonzero(root != np.arange(len(found)))
    return found[far], found[root[far]]


def links(distinct: DataFrame, bits: int = 2) -> DataFrame:
    """(a, b): links among the distinct ``fp`` that keep every component whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_all: list[np.ndarray] = []
        b_all: list[np.ndarray] = []
        for batch in groups(batches, "point"):
            if batch.num_rows > 1:
                found = np.unique(batch.column("fp").to_numpy()).view(np.uint64)
                if len(found) == 2:
                    if (int(found[0]) ^ int(found[1])).bit_count() <= bits:
                        a_all.append(found[:1])
                        b_all.append(found[1:])
                else:
                    a, b = linked(found, bits)
                    a_all.append(a)
                    b_all.append(b)
            if len(a_all) > 5000:
                yield _edges(a_all, b_all)
                a_all, b_all = [], []
        yield _edges(a_all, b_all)

    if bits > 2:
        raise ValueError("grid points beside each other find links of at most two bits")
    placed = distinct.select("fp", F.explode(grid_points(F.col("fp"))).alias("point"))
    return map_batches(placed.repartition("point").sortWithinPartitions("point"), run, "a long, b long").distinct()


def _edges(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    empty = np.zeros(0, np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([empty, *x]).view(np.int64)) for x in (a, b)], ["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 2) -> DataFrame:
    """(id_col, fingerprint, component_id): each row's component of fingerprints linked at ``bits`` or fewer differing bits.

    Null and empty texts and texts of white space have fingerprint zero and are linked like any others. Each row gives a
    row; rows that repeat share a component. A null id takes part in links but never names a component unless no member has an id.
    An empty table gives an empty result. Extra columns are ignored, whatever their names.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least"))
    found = components(links(distinct, bits))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: By how many standard deviations the sketches of similar sets may miss, when pairs are tried by them before the exact comparison.
SLACK = 5
TWIST, TWIST_2 = np.uint64(0x9C8F2D35A7E1B643), np.uint64(0xD6E8FEB86659FD93)
#: Shingle sets smaller than this together are too small for a sketch's bits to be near normal; they are not tried by them.
FEW = 128
#: A set of at most so many shingles has parities in place of the second sketch.
SHORT = 80
#: Sampled texts for the order of the shingles (so many, or this share of all, whichever is more), and the commoner shingles that it holds.
ORDER_TEXTS, ORDER_SHARE, ORDER_SHINGLES = 20_000, 1 / 2000, 262_144
#: Texts in a bucket whose pairs are tried one by one; in a larger bucket all are candidates.
BUCKET = 20_000
#: Candidates whose sets one task compares; a larger group is dealt in blocks.
GROUP = 1024
#: Shingles in several sets up to which sets are compared by a product of matrices; beyond, one set after another. The result is the same.
COLUMNS = 4096
#: Rows of such a product that are held as doubles at once.
ROWS = 128


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """The hashes of a text's different word shingles, in order; of a shorter text the hash of all its words."""
    parts = (text or "").encode().translate(LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([digest(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts, stops = (ends - sizes)[: 1 - words].tolist(), ends[words - 1 :].tolist()
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts)))


def sketch(found: np.ndarray, twist: np.uint64 = TWIST) -> int:
    """The 64-bit SimHash of a shingle set; 0 for an empty one."""
    n = len(found)
    if not n:
        return 0
    with np.errstate(over="ignore"):
        x = found * twist
        x ^= x >> np.uint64(32)
        x *= twist
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 255):
        counts += np.unpackbits(x[at : at + 255].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def parities(found: np.ndarray) -> int:
    """Whether an odd number of a set's shingles falls on each of 64 bits. The bits of two sets differ at no more places than the sets have shingles not in common."""
    with np.errstate(over="ignore"):
        place = found * TWIST_2 >> np.uint64(58)
    return int(np.bitwise_xor.reduce(np.uint64(1) << place, initial=np.uint64(0)))


def second(found: np.ndarray) -> int:
    """What tells a set from others besides its sketch: its parities if it is short, else a second sketch."""
    return parities(found) if len(found) <= SHORT else sketch(found, TWIST_2)


def may_be_alike(marks: np.ndarray, more: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the sets at ``a`` and ``b`` may have a Jaccard similarity of ``similarity``, by their sketches ``marks`` and by ``more`` (:func:`second`).

    Bit counts first: their difference never exceeds the Hamming distance, so pairs beyond it are out before any XOR. Parities miss no similar pair.
    """
    n, m = size[a].astype(np.float64), size[b].astype(np.float64)
    short = (n <= SHORT).astype(np.int8) + (m <= SHORT)
    share = np.minimum(1, similarity / (1 + similarity) * (n + m) / np.sqrt(n * m))  # the cosine that it takes
    differ = np.arccos(share) / np.pi

    def most(bits: int) -> np.ndarray:
        return differ * bits + SLACK * np.sqrt(np.maximum(1, differ * (1 - differ) * bits))

    def within(words: np.ndarray, most: np.ndarray, tried: np.ndarray) -> None:
        counts = np.bitwise_count(words).astype(np.int64)
        ok[tried] = np.abs(counts[a[tried]] - counts[b[tried]]) <= most[tried]
        tried = tried[ok[tried]]
        ok[tried] = np.bitwise_count(words[a[tried]] ^ words[b[tried]]) <= most[tried]

    ok = np.ones(len(n), bool)
    within(more, (n + m) * (1 - similarity) / (1 + similarity) + 1e-6, np.flatnonzero(short == 2))
    within(marks, most(64), np.flatnonzero(ok & (n + m >= FEW)))
    both = np.flatnonzero(ok & (short == 0))
    ok[both] = np.bitwise_count(marks[a[both]] ^ marks[b[both]]) + np.bitwise_count(more[a[both]] ^ more[b[both]]).astype(np.int64) <= most(128)[both]
    return ok


def _common_shingles(texts: DataFrame, words: int) -> np.ndarray:
    """Hashes of shingles that many texts hold, the rarer first. Any list gives the same result; a good one gives few pairs to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            found, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *(shingles(x, words) for x in batch.column(0).to_pylist())]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["s", "c"])

    some = texts.sample(min(1.0, max(ORDER_SHARE, ORDER_TEXTS / max(1, texts.count()))), 7).select("data")
    counted = map_batches(some, run, "s long, c long").groupBy("s").agg(F.sum("c").alias("c")).where("c > 2")
    rows = counted.orderBy(F.desc("c"), "s").limit(ORDER_SHINGLES).select("s").toArrow()  # bounded
    return rows.column("s").to_numpy()[::-1].astype(np.int64).view(np.uint64)


def _prefix(found: np.ndarray, similarity: float, by_hash: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles in a common order, the common ones last: two sets alike by ``similarity`` share one of them at least."""
    n = len(found)
    if not n:
        return found
    size = min(n, n - int(np.ceil(similarity * n - 1e-9)) + 1)
    if not len(by_hash):
        return found[:size]
    at = np.minimum(np.searchsorted(by_hash, found), len(by_hash) - 1)
    return found[np.argsort(np.where(by_hash[at] == found, rank[at] + 1, 0), kind="stable")[:size]]


def _meet(bucket: np.ndarray, node: np.ndarray, marks: np.ndarray, more: np.ndarray, size: np.ndarray, place: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidate links among the texts of sorted buckets, as two arrays of nodes: enough to join what could be alike.

    ``size`` is that of a text's set, ``place`` that of the bucket's shingle in it. Where two sets have their first common shingle, they share no more
    than what is left of either from there on; a pair for which that is too little here is no candidate here.
    """

    def ok(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n, m = size[a], size[b]
        good = (node[a] != node[b]) & (np.minimum(n - place[a], m - place[b]) * (1 + similarity) >= similarity * (n + m) - 1e-6)
        some = np.flatnonzero(good)
        good[some] = may_be_alike(marks, more, size, a[some], b[some], similarity)
        return good

    opens = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    sizes = np.diff(np.append(opens, len(bucket)))
    left = np.flatnonzero(np.repeat(sizes <= 32, sizes))
    a_all, b_all = [], []
    step = 1
    while len(left):  # in all small buckets at once: each text with the one ``step`` places on
        left = left[left + step < len(bucket)]
        left = left[bucket[left] == bucket[left + step]]
        good = ok(left, left + step)
        a_all.append(left[good])
        b_all.append(left[good] + step)
        step += 1
    for start, stop in zip(opens[sizes > 32].tolist(), (opens + sizes)[sizes > 32].tolist(), strict=True):
        places = start + np.unique(node[start:stop], return_index=True)[1]
        root, n = np.arange(len(places)), len(places)
        rows = max(1, 500_000 // n)
        for at in range(0, n, rows):
            a, b = (x.ravel() for x in np.meshgrid(np.arange(at, min(n, at + rows)), np.arange(at, n), indexing="ij"))
            fresh = (a < b) & (root[a] != root[b])  # what is tied already needs no comparison
            a, b = a[fresh], b[fresh]
            good = ok(places[a], places[b])
            _join(places, root, a[good], b[good])
            root = _roots(root)
        far = np.flatnonzero(root != np.arange(n))
        a_all.append(places[far])
        b_all.append(places[root[far]])
    a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a_all, b_all))
    pairs = np.unique(np.stack([np.minimum(node[a], node[b]), np.maximum(node[a], node[b])], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _alike(ids: np.ndarray, sizes: np.ndarray, shared: np.ndarray, similarity: float, side: np.ndarray | None) -> np.ndarray:
    """Which two sets are alike, as a matrix: their common shingles counted by a product of matrices over the shingles that are in several sets."""
    column = np.cumsum(shared) - 1
    held = np.zeros((len(sizes), int(shared.sum())), np.float32)
    row, some = np.repeat(np.arange(len(sizes)), sizes), shared[ids]
    held[row[some], column[ids[some]]] = 1
    near = np.empty((len(sizes), len(sizes)), bool)
    with np.errstate(invalid="ignore"):
        for at in range(0, len(sizes), ROWS):
            both = (held[at : at + ROWS] @ held.T).astype(np.float64)  # whole numbers below 2^24 are exact
            near[at : at + ROWS] = both / (sizes[at : at + ROWS, None] + sizes[None, :] - both) >= similarity
    return near if side is None else near & (side[:, None] != side[None, :])


def _tied(near: np.ndarray, root: np.ndarray) -> np.ndarray:
    """The least member of each one's component by the matrix ``near`` and by equal ``root`` (a member's place)."""
    label = root.copy()
    while True:
        met = [np.where(near[at : at + ROWS], label[None, :], len(label)).min(axis=1, initial=len(label)) for at in range(0, len(label), ROWS)]
        least = np.minimum(np.concatenate([np.zeros(0, np.int64), *met]), label)
        np.minimum.at(least, root, least.copy())
        least = least[root]
        least = np.minimum(least, least[least])
        if (least == label).all():
            return label
        label = least


def settled(sets: list[np.ndarray], similarity: float, tied: np.ndarray | None = None, side: np.ndarray | None = None) -> np.ndarray:
    """For each shingle set the place of the first of its component of sets whose exact Jaccard similarity is ``similarity`` or more.

    Sets with equal ``tied`` belong together from the start; with ``side`` (0 or 1), only pairs of different sides are compared.
    """
    sizes = np.array(list(map(len, sets)), np.int64)
    by_size = np.argsort(sizes, kind="stable")
    sets, sizes = [sets[i] for i in by_size], sizes[by_size]
    side = None if side is None else side[by_size]
    _, ids = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)
    root = np.arange(len(sets))
    if tied is not None:
        _, first, which = np.unique(tied[by_size], return_index=True, return_inverse=True)
        root = first[which]
    several = np.bincount(ids, minlength=1) > 1
    if several.sum() <= COLUMNS and len(sets) <= 4 * GROUP:
        root = _tied(_alike(ids, sizes, several, similarity, side), root)
    else:
        root = _one_by_one(sets, sizes, ids, similarity, root, side)
    least = np.full(len(sets), len(sets))
    np.minimum.at(least, root, by_size)
    out = np.zeros(len(sets), np.int64)
    out[by_size] = least[root]
    return out


def _one_by_one(sets: list[np.ndarray], sizes: np.ndarray, ids: np.ndarray, similarity: float, root: np.ndarray, side: np.ndarray | None) -> np.ndarray:
    """Roots after each set was compared with those of a fitting size that are not tied to it yet; sets are in order of size."""
    ends = np.cumsum(sizes)
    held = np.zeros(len(ids) + 1, bool)
    for i in range(len(sets)) if side is None else np.flatnonzero(side == 0).tolist():
        root = _roots(root)
        least = i + 1 if side is None else int(np.searchsorted(sizes, sizes[i] * similarity - 1e-6))
        last = int(np.searchsorted(sizes, sizes[i] / similarity + 1e-6, side="right"))  # other sets cannot be alike
        others = np.arange(least, last)
        others = others[(root[others] != root[i]) & (True if side is None else side[others] == 1)]
        if not len(others):
            continue
        held[ids[ends[i] - sizes[i] : ends[i]]] = True
        for at in range(0, len(others), 1024):
            some = others[at : at + 1024]
            places = np.concatenate([ids[ends[j] - sizes[j] : ends[j]] for j in some.tolist()])
            shared = np.add.reduceat(held[places].astype(np.int64), np.cumsum(sizes[some]) - sizes[some])
            near = some[shared / (sizes[i] + sizes[some] - shared) >= similarity]
            _join(sizes, root, np.full(len(near), i), near)
        held[ids[ends[i] - sizes[i] : ends[i]]] = False
    return _roots(root)


def _keys(text: Column) -> list[Column]:
    """A 128-bit key of a text in two longs; null is as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(text), F.xxhash64(F.lit(7), text)]


def _candidates(made: DataFrame, similarity: float, linked_already: DataFrame | None = None) -> DataFrame:
    """(node, root): groups of the shingle sets of ``made`` (node, mark, more, size, first) outside of which nothing is alike.

    Joined by ``linked_already`` (a, b), and where sets meet at a shingle of their prefixes.
    """
    met = _by_prefix(made, similarity)
    return components(met if linked_already is None else linked_already.unionByName(met))


def _by_grid(made: DataFrame) -> DataFrame:
    """(a, b): sets whose fingerprints are equal or linked in the grid of segment bit counts (:func:`links`), by the least node of each fingerprint."""
    least = stored(made.groupBy("fp").agg(F.min("node").alias("n")), "fingerprints")
    ends = [least.select(F.col("fp").alias(x), F.col("n").alias(f"of_{x}")) for x in ("a", "b")]
    linked_ = links(least.select("fp")).join(ends[0], "a").join(ends[1], "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    return linked_.unionByName(made.join(least, "fp").where("node <> n").select(F.col("node").alias("a"), F.col("n").alias("b")))


def _by_prefix(made: DataFrame, similarity: float) -> DataFrame:
    """(a, b): candidate links of sets that share a shingle of their prefixes, as those more than two bits apart need."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rest, size, anchor = None, 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if anchor is not None:  # a bucket that is too large to compare goes on
                lead = int(np.searchsorted(table.column("s").to_numpy(), anchor[0], side="right"))
                yield tied(table.slice(0, lead), anchor[1])
                table = table.slice(lead)
                anchor = anchor if not table.num_rows else None
            s = table.column("s").to_numpy()
            cut = int(np.searchsorted(s, s[-1])) if len(s) else 0
            rest = table.slice(cut)
            same = s[1:cut] == s[: max(0, cut - 1)]
            several = np.append(same, False) | np.append(False, same) if cut else np.zeros(0, bool)
            if several.any():  # a bucket with one text only has no pairs
                held.append(table.slice(0, cut).filter(pa.array(several)))
                size += held[-1].num_rows
            if size > 50_000:
                yield links(held)
                held, size = [], 0
            if rest.num_rows > BUCKET:
                anchor = s[-1], rest.column("node").to_numpy()[0]
                yield tied(rest, anchor[1])
                rest = rest.slice(0, 0)
        if rest is not None and rest.num_rows > 1:
            held.append(rest)
        if held:
            yield links(held)

    def tied(table: pa.Table, to: int) -> pa.RecordBatch:
        node = np.unique(table.column("node").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.full(len(node), to))], ["a", "b"])

    def links(held: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(held)
        a, b = _meet(*(table.column(c).to_numpy() for c in ("s", "node")), *(table.column(c).to_numpy().view(np.uint64) for c in ("mark", "more")), *(table.column(c).to_numpy() for c in ("size", "place")), similarity)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    more = F.col("more") if "more" in made.columns else F.lit(0).cast("long")  # without it, it rules nothing out
    placed = made.select(F.posexplode("first").alias("place", "s"), "node", "mark", more.alias("more"), "size").select("s", "node", "mark", "more", "size", "place")
    return map_batches(placed.repartition("s").sortWithinPartitions("s"), meet, "a long, b long")


def _exact(members: DataFrame, words: int, similarity: float, group: int | None = None) -> DataFrame:
    """(node, component): the members (root, node, data) of each candidate group by exact similarity of their sets.

    One task compares ``group`` sets, or twice as many of two blocks. A larger group's sets are made once and dealt in blocks at random, three times; near copies are
    mostly tied then. What is not in a group's largest part is then compared, each pair once, among itself by pairs of blocks and with every block of that part.
    """
    group = group or GROUP
    sized = members.join(members.groupBy("root").agg(F.count("*").alias("n")), "root")

    def compare(rows: DataFrame) -> DataFrame:
        """(a, b): each node with the first of its component among the sets of one ``at``, of texts or, with ``sub`` and ``side``, of two blocks."""
        across, made = "side" in rows.columns, "sets" in rows.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in groups(batches, "at"):
                node, data = table.column("node").to_numpy(), table.column(2).to_pylist()
                sets = [np.frombuffer(x, np.uint64) if made else shingles(x, words) for x in data]
                side = table.column("side").to_numpy() if across else None
                side = None if side is None or (side < 0).all() else side
                first = settled(sets, similarity, table.column("sub").to_numpy() if across else None, side)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[first])], ["a", "b"])

        chosen = rows.select("at", "node", "sets" if made else "data", *(["sub", "side"] if across else []))
        return map_batches(chosen.repartition("at").sortWithinPartitions("at", "node"), run, "a long, b long")

    def as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = pa.array([shingles(x, words).tobytes() for x in batch.column("data").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("root"), batch.column("node"), batch.column("n"), made], ["root", "node", "n", "sets"])

    def block(seed: int, blocks: Column) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(seed)), blocks).cast("int")

    largest = sized.agg(F.max("n")).first()[0] or 0
    final = compare(sized.where(F.col("n") <= group).withColumn("at", F.col("root")))
    if largest > group:
        large = stored(map_batches(sized.where(F.col("n") > group).select("root", "node", "n", "data"), as_sets, "root long, node long, n long, sets binary"), "large")
        dealt = [compare(large.withColumn("at", F.xxhash64("root", block(seed, F.ceil(F.col("n") / group))))) for seed in (1, 2, 3)]
        ties = stored(dealt[0].unionByName(dealt[1]).unionByName(dealt[2]).where("a <> b"), "ties")
        parts = components(ties).withColumnRenamed("root", "sub")
        now = stored(large.join(parts, "node", "left").withColumn("sub", F.coalesce("sub", "node")), "parts")
        weights = now.groupBy("root", "sub").agg(F.count("*").alias("m"))
        split = weights.groupBy("root").agg(F.max(F.struct("m", "sub")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("root", F.col("main.sub").alias("main"), F.col("main.m").alias("m"))
        left = now.join(split, "root").withColumns({"others": F.ceil((F.col("n") - F.col("m")) / group).cast("int"), "mains": F.ceil(F.col("m") / group).cast("int")})
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        asking, main = left.where("sub <> main").withColumn("i", block(5, F.col("others"))), left.where("sub = main").withColumn("j", block(4, F.col("mains")))
        i, j = F.col("i"), F.col("j")
        among = asking.withColumn("j", every("others")).withColumns({"side": F.when(i == j, -1).otherwise((i > j).cast("int")), "x": F.least(i, j), "y": F.greatest(i, j), "kind": F.lit(0)})
        asked = asking.withColumn("j", every("mains")).withColumns({"side": F.lit(0), "x": i, "y": j, "kind": F.lit(1)})
        asked_of = main.withColumn("i", every("others")).withColumns({"side": F.lit(1), "x": i, "y": j, "kind": F.lit(1)})
        cells = [df.select(F.xxhash64("root", "x", "y", "kind").alias("at"), "node", "sets", "sub", "side") for df in (among, asked, asked_of)]
        more = stored(compare(cells[0].unionByName(cells[1]).unionByName(cells[2])).where("a <> b"), "ties")
        joined = components(ties.unionByName(more))
        whole = large.select("node").join(joined, "node", "left").select(F.col("node").alias("a"), F.coalesce("root", "node").alias("b"))
        final = final.unionByName(whole)
    return final.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _rows(docs: DataFrame, id_col: str, text_col: str, words: int, similarity: float) -> DataFrame:
    """(id, k1, k2, component): for each row of ``docs`` its text's key and a number of its component of near copies; written."""
    k1, k2 = _keys(F.col("data"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("data")).select("id", k1.alias("k1"), k2.alias("k2"), "data")
    common = _common_shingles(texts, words)
    by_hash = np.argsort(common)
    order = docs.sparkSession.sparkContext.broadcast((common[by_hash], by_hash))  # bounded by ORDER_SHINGLES

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # copies of a text need no second row from a task
        for batch in slices(batches):
            if len(seen) > 500_000:
                seen.clear()
            fresh = []
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if key not in seen:
                    seen.add(key)
                    fresh.append(i)
            batch = batch.take(pa.array(fresh, pa.int64()))
            sets = [shingles(x, words) for x in batch.column(2).to_pylist()]
            node = np.fromiter((xxhash.xxh3_64_intdigest(x.tobytes()) for x in sets), np.uint64, len(sets)).view(np.int64)
            bits = [sketch(x) for x in sets]
            prints = np.array(bits, np.uint64).view(np.int64)
            more = np.fromiter(map(second, sets), np.uint64, len(sets)).view(np.int64)
            first = [_prefix(x, similarity, *order.value).view(np.int64) for x in sets]
            sizes = np.fromiter(map(len, sets), np.int32, len(sets))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(node), pa.array(prints), pa.array(more), pa.array(sizes), pa.array(first, pa.list_(pa.int64()))], ["k1", "k2", "node", "mark", "more", "size", "first"])

    made = stored(map_batches(texts.select("k1", "k2", "data"), make, "k1 long, k2 long, node long, mark long, more long, size int, first array<long>"), "prefixes")
    keyed = stored(made.select("k1", "k2", "node").distinct(), "keyed")
    grid = stored(_by_grid(made.withColumnRenamed("mark", "fp")), "grid")  # its shuffle files go before those of the prefixes come
    members = keyed.join(_candidates(made, similarity, grid), "node").groupBy("root", "node").agg(F.min(F.struct("k1", "k2")).alias("k")).select("root", "node", "k.k1", "k.k2")
    members = stored(texts.select("k1", "k2", "data").join(members, ["k1", "k2"]).groupBy("root", "node").agg(F.first("data").alias("data")), "members")
    discard(made)
    discard(grid)
    found = keyed.join(_exact(members, words, similarity), "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("component"))
    rows = stored(texts.select("id", "k1", "k2").join(found, ["k1", "k2"]), "near")
    discard(members)
    discard(keyed)
    return rows


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id_col, component_id): components of documents whose shingle sets have a Jaccard similarity of ``similarity`` or more, exactly.

    Two bits of one fingerprint show near-equality only. Texts meet at the shingles of their prefixes, in an order common to all, so that no pair
    at the threshold stays apart. Where they meet, sizes, bit counts and XOR of SimHash sketches, with a cut-off looser by 5 standard
    deviations, and of short sets parities, leave candidates only; the shingle sets of what candidates join are compared. Equal hashes of 64 bits are taken for equal
    shingles. Null and empty texts are alike; rows without an id link but have a null component.
    """
    rows = _rows(docs, id_col, text_col, words, similarity)
    named = rows.groupBy("component").agg(F.min("id").alias("component_id"))
    return rows.join(named, "component").select(F.col("id").alias(id_col), F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their component of :func:`near_copies`: the row with its least id.

    Rows that repeat an id and a text are one; different texts of one id are judged each. A row without an id stays only if no row of its
    component has one. Null and empty texts are one component.
    """
    rows = _rows(docs, id_col, text_col, words, similarity)
    key = ["_n", "_i", "_a", "_b"]  # of a row: id is null, id, key of the text
    identity = [F.col("id").isNull().alias("_n"), F.coalesce("id", F.lit(0)).cast("long").alias("_i"), F.col("k1").alias("_a"), F.col("k2").alias("_b")]
    stays = rows.select("component", F.struct(*identity).alias("row")).groupBy("component").agg(F.min("row").alias("row")).select("row.*")
    a, b = _keys(F.col(text_col))
    named = docs.withColumns({"_n": F.col(id_col).isNull(), "_i": F.coalesce(F.col(id_col).cast("long"), F.lit(0)), "_a": a, "_b": b})
    return named.join(stays, key, "left_semi").dropDuplicates(key).select(*docs.columns)
