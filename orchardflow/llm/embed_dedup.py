"""Near-duplicate embeddings by rotated binary codes with correction factors.

Unit vectors are rotated at random; a vector's code is the signs of its rotated components, and its factor the inner product of the
vector and its code. From one vector's components and another's code, divided by its factor, comes an unbiased estimate of their cosine. The
factor also is the cosine of a vector's angle to its code, so a pair at the threshold has no larger angle between one's components and the
other's code than both angles together: pairs beyond are done, the others' cosines are computed exactly, and none is missed.
A label is dealt in blocks and every two blocks meet, whatever its size. Only a caller that allows missed pairs gets sign hashes: pairs are then
formed between vectors that share a bucket of one of several. Equal vectors of a label are one class with a count, so that a common vector costs no pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchardflow.llm._common import components, groups, map_batches, stored
from orchardflow.llm._vectors import common_size, components_of, matrix, rotation, usable

#: Vectors in a block, fewer if they have more components than fit; with missed pairs allowed, vectors of a label up to which it is not hashed.
BLOCK, BUCKET = 16_384, 16_384
#: Components in a block, and components of the pairs whose cosines are computed together; both bound a worker's memory.
FLOATS = 1 << 21
#: Pairs that can be tried in the time that it takes to send a vector to a block.
PAIRS = 200


def plan(largest: int, threshold: float, missed: float) -> tuple[int, int]:
    """Bits and number of hash tables so that a pair at the threshold shares no bucket with probability ``missed`` at most; the cheapest ones. None without ``missed``."""
    if not missed or largest <= BUCKET:
        return 0, 1
    found = []
    for bits in range(1, 40):
        together = (1 - math.acos(threshold) / math.pi) ** bits
        tables = math.ceil(math.log(missed) / math.log(1 - together))
        bucket = largest / 2**bits
        found.append((tables * (max(1.0, bucket / BLOCK) + bucket / 2 / PAIRS), bits, tables))
    return min(found)[1:]


def codes(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated components, their signs scaled to unit length, and the factors."""
    turned = unit @ turn
    signs = np.where(turned >= 0, 1.0, -1.0) / math.sqrt(unit.shape[1])
    return turned, signs, (turned * signs).sum(axis=1)


def close_pairs(x: np.ndarray, turn: np.ndarray, a: np.ndarray, b: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places (from ``a``, from ``b``) with cosine of at least ``threshold``; each once if ``same``."""
    norm = np.sqrt((x * x).sum(axis=1))
    turned, signs, factor = codes(x / norm[:, None], turn)
    turned, signs = turned[a].astype(np.float32), signs[b].astype(np.float32).T.copy()
    # the slack covers what single precision rounds
    most = np.cos(np.minimum(math.pi, np.arccos(np.clip(factor[b], -1, 1)) + math.acos(threshold))) - 4 * x.shape[1] * np.finfo(np.float32).eps
    most = most.astype(np.float32)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rows, piece = max(1, FLOATS // max(1, len(b))), max(1, FLOATS // x.shape[1])
    for start in range(0, len(a), rows):
        first = start if same else 0
        near = np.flatnonzero(turned[start : start + rows] @ signs[:, first:] >= most[first:])
        for at in range(0, len(near), piece):
            i, j = np.divmod(near[at : at + piece], len(b) - first)
            i, j = a[start + i], b[first + j]
            if same:
                i, j = i[i < j], j[i < j]
            close = np.einsum("ij,ij->i", x[i], x[j]) / (norm[i] * norm[j]) >= threshold
            left.append(i[close])
            right.append(j[close])
    return np.concatenate(left), np.concatenate(right)


def classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame, int]:
    """(id, k1, k2) of all rows, the key null where the vector links with nothing; (k1, label, v, n, least) of the classes of equal vectors of a label; the size of a vector.

    ``n`` counts a class's different ids, ``least`` is the smallest of them. Both are combined before they are shuffled.
    """
    size = common_size(vectors, vector_col)
    good = usable(F.col(vector_col), size) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
    label, v = F.col(label_col).cast("string"), components_of(vectors, vector_col)
    keys = [F.when(good, x).alias(k) for x, k in ((F.xxhash64(label, v), "k1"), (F.xxhash64(F.lit(7), label, v), "k2"))]
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), *keys, F.xxhash64(label).alias("label"), v.alias("v"))
    held = rows.where("k1 is not null")
    ids = held.select("k1", "k2", "id").distinct().groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    different = held.groupBy("k1", "k2").agg(F.first("label").alias("label"), F.first("v").alias("v"))
    return rows.select("id", "k1", "k2"), different.join(ids, ["k1", "k2"]), size


def links(held: DataFrame, size: int, threshold: float = 0.93, missed: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """The classes, hashed and written; and (a, b, n): for each class a met in a group, the ids of the classes linked to it there, and a b that ties it to the group's component or null."""
    largest = held.groupBy("label").count().agg(F.max("count").alias("n")).first().n or 0
    bits, tables = plan(largest, threshold, missed)
    size = size or 1
    kind = held.schema["v"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.concatenate([rotation(size, 100 + i) for i in range(-(-tables * max(1, bits) // size))], axis=1)[:, : tables * bits]
        for batch in batches:
            v = matrix(batch.column("v"), size)
            unit = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
            keys = ((unit @ planes >= 0).reshape(len(v), tables, bits) * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.tolist(), pa.list_(pa.int64()))], [*batch.schema.names, "keys"])

    coded = stored(map_batches(held.select("k1", "k2", "label", "n", "least", "v"), hashed, f"k1 long, k2 long, label long, n long, least long, v {kind}, keys array<long>"), "classes")
    # buckets and blocks are settled on narrow rows; a vector is sent once to its list of meetings, and from there to each
    narrow = coded.select("k1", "label", F.posexplode("keys").alias("table", "key")).select("k1", "table", F.xxhash64("label", "table", "key").alias("bucket"))
    counts = narrow.groupBy("bucket").count().where("count > 1")
    dealt = narrow.join(counts, "bucket").withColumn("parts", F.ceil(F.col("count") / min(BLOCK, max(1, FLOATS // size))).cast("int")).withColumn("block", F.pmod(F.xxhash64("k1"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    meeting = F.struct(F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("met"), "block", "table")
    meetings = dealt.groupBy("k1").agg(F.collect_list(meeting).alias("m"))
    sent = coded.drop("k2", "least").join(meetings, "k1").withColumn("m", F.explode("m")).select("k1", "label", "n", "v", "keys", "m.*")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(size, 17)
        for table in groups(batches, "met"):
            if table.num_rows < 2:
                continue
            own, block, label, number, weight = (table.column(x).to_numpy() for x in ("k1", "block", "label", "table", "n"))
            v = matrix(table.column("v"), size)
            keys = matrix(table.column("keys"), tables)
            pieces = np.unique(block)
            a, b = np.flatnonzero(block == pieces[0]), np.flatnonzero(block == pieces[-1])
            i, j = close_pairs(v, turn, a, b, len(pieces) == 1, threshold)
            t = number[0]
            fresh = (label[i] == label[j]) & (number[i] == number[j]) & (own[i] != own[j])
            if t:  # a pair counts in the first table that brings it together
                fresh &= ~(keys[i, :t] == keys[j, :t]).any(axis=1)
            i, j = i[fresh], j[fresh]
            if not len(i):
                continue
            n = np.bincount(i, weights=weight[j], minlength=len(own)) + np.bincount(j, weights=weight[i], minlength=len(own))
            root = np.arange(len(own))
            while True:  # the least place of each component, by halving
                low = np.minimum(root[i], root[j])
                before = root.copy()
                np.minimum.at(root, root[i], low)
                np.minimum.at(root, root[j], low)
                root = root[root]
                if (before == root).all():
                    break
            some = np.flatnonzero(n)
            tie = pa.array(own[root[some]], mask=root[some] == some)
            yield pa.RecordBatch.from_arrays([pa.array(own[some]), tie, pa.array(n[some].astype(np.int64))], ["a", "b", "n"])

    return coded, map_batches(sent.repartition("met").sortWithinPartitions("met"), work, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, missed: float = 0.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id_col, n_links, component_id, kept) for each row: links within its label at cosine ``threshold`` or more, its component, whether it stays.

    Vectors that are null, zero, of another size than most, or that hold null or non-finite components, and rows with a null label or id,
    link with nothing and stay. Rows that repeat an id, label and vector are one vector: they share its results and are no links to each other. An id
    with several vectors or labels has as many vectors, each judged for itself. Every pair of a label is tried, so the work grows with the square of
    the largest label. With ``missed``, a large label is hashed instead, and a pair at the threshold missed with that probability at most, closer ones
    less; what is linked was computed exactly. An empty table gives an empty result.
    """
    rows, held, size = classes(vectors, id_col, vector_col, label_col)
    coded, met = links(held, size, threshold, missed)
    found = stored(met, "links")
    counted = found.groupBy("a").agg(F.sum("n").alias("others"))
    rooted = components(found.select("a", "b")).select(F.col("node").alias("a"), "root")
    one = coded.select("k1", "k2", "n", "least").join(counted, F.col("k1") == counted["a"], "left").drop("a").join(rooted, F.col("k1") == rooted["a"], "left").withColumn("root", F.coalesce("root", "k1"))
    named = one.groupBy("root").agg(F.min("least").alias("component_id"))
    told = one.join(named, "root").select("k1", "k2", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.join(told, ["k1", "k2"], "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
