"""Approximate nearest neighbours by largest inner product: inverted lists with an adaptive dimension scan.

Vectors get one more component that makes their lengths equal, so that the largest inner product is the least distance. They are
rotated at random and kept in lists by nearest centre. A query scans its probed lists in blocks of dimensions: after each
block, the distance so far, scaled to all dimensions, is tested against the query's threshold, and candidates for which the test
rejects that they are near enough are abandoned. Survivors get their exact inner product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orchardflow.llm._common import groups, map_batches, stored
from orchardflow.llm._vectors import common_size, components_of, matrix, rotation, usable

#: Dimensions in a block, and the factor of the test: a larger one abandons fewer true neighbours.
COLUMNS, FACTOR = 16, 2.1
#: Vectors of a list that one task scans; longer lists are dealt over several.
LIST_PART = 1024
#: Bytes of the sample, which every task gets.
SAMPLE_BYTES = 64 << 20


@dataclass(frozen=True)
class Index:
    """Centres of the lists (rotated, with the added component), and how many lists a query probes. Fitted on a bounded sample."""

    size: int
    longest: float
    turn: np.ndarray
    centres: np.ndarray
    probes: int
    sample_ids: np.ndarray
    sample: np.ndarray
    sample_lists: np.ndarray
    firsts: np.ndarray

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Candidates: rotated, with the component that makes lengths equal."""
        more = np.sqrt(np.maximum(0.0, self.longest - (x * x).sum(axis=1)))
        return np.concatenate([x, more[:, None]], axis=1) @ self.turn

    def lift_query(self, q: np.ndarray) -> np.ndarray:
        return np.concatenate([q, np.zeros((len(q), 1))], axis=1) @ self.turn

    def nearest_list(self, lifted: np.ndarray) -> np.ndarray:
        return np.argmin((self.centres**2).sum(axis=1)[None, :] - 2 * lifted @ self.centres.T, axis=1)

    def probed(self, lifted: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
        """Whether each query probes each list: the ``probes`` nearest, and on until they hold more than ``least`` vectors."""
        far = (self.centres**2).sum(axis=1)[None, :] - 2 * lifted @ self.centres.T
        order = np.argsort(far, axis=1)
        before = np.cumsum(sizes[order], axis=1) - sizes[order]
        taken = np.zeros(far.shape, bool)
        np.put_along_axis(taken, order, (np.arange(far.shape[1]) < self.probes)[None, :] | (before <= least), axis=1)
        return taken

    def threshold(self, ids: np.ndarray, q: np.ndarray, taken: np.ndarray, k: int) -> np.ndarray:
        """An inner product that 2 ``k`` different sample ids in each query's lists reach, its own apart; -inf where there are fewer.

        Twice ``k``, so that the scan finds ``k`` though its test should reject some of them.
        """
        score = q @ self.sample.T
        score[(ids[:, None] == self.sample_ids[None, :]) | ~self.firsts[None, :] | ~taken[:, self.sample_lists]] = -np.inf
        if score.shape[1] < 2 * k:
            return np.full(len(ids), -np.inf)
        return np.partition(score, score.shape[1] - 2 * k, axis=1)[:, score.shape[1] - 2 * k]

    def sample_best(self, ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and inner products of each query's best in the sample, its own id apart; -inf where there are fewer."""
        score = q @ self.sample.T
        score[ids[:, None] == self.sample_ids[None, :]] = -np.inf
        n = min(k, score.shape[1])
        best = np.argpartition(-score, n - 1, axis=1)[:, :n]
        return self.sample_ids[best], np.take_along_axis(score, best, axis=1)


def _centres(x: np.ndarray, n: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(3)
    found = x[rng.choice(len(x), n, replace=False)].copy()
    for _ in range(rounds):
        own = np.argmin((found**2).sum(axis=1)[None, :] - 2 * x @ found.T, axis=1)
        total = np.zeros_like(found)
        np.add.at(total, own, x)
        count = np.bincount(own, minlength=n)
        found = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], x[rng.choice(len(x), n)])
    return found


def fit(vectors: DataFrame, k: int = 20, most: int = 20_000, recall: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding") -> Index | None:
    """An index for usable ``vectors``; None without any.

    Centres, the number of probed lists and the starting thresholds (but no results) come from at most ``most`` rows, and SAMPLE_BYTES of them, chosen by a hash of the id. The number
    of probes is what finds the share ``recall`` of the sample's own nearest neighbours. All rows are counted for the number of lists and the longest length.
    """
    size = common_size(vectors, vector_col)
    if not size:
        return None
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    good = vectors.where(usable(F.col(vector_col), size) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), x.alias("v"))
    total = good.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, v: a + v * v)).alias("longest")).first()
    if not total.n:
        return None
    sample = good.orderBy(F.xxhash64("id"), "id", "v").limit(max(1, min(most, SAMPLE_BYTES // (8 * size)))).toArrow()  # bounded in rows and bytes
    ids, rows = sample.column("id").to_numpy(), matrix(sample.column("v"), size)
    lists = int(np.clip(round(np.sqrt(total.n) / 2), 1, max(1, len(rows) // 4)))
    firsts = np.zeros(len(ids), bool)
    firsts[np.unique(ids, return_index=True)[1]] = True
    index = Index(size, total.longest * (1 + 1e-12), rotation(size + 1, 11), np.zeros((0, 0)), 1, ids, rows, np.zeros(0, np.int64), firsts)
    lifted = index.lift(rows)
    centres = _centres(lifted, lists)
    index = replace(index, centres=centres)
    tested = np.random.default_rng(5).permutation(len(rows))[:400]
    own = index.nearest_list(lifted)
    far = (centres**2).sum(axis=1)[None, :] - 2 * index.lift_query(rows[tested]) @ centres.T
    rank = np.argsort(np.argsort(far, axis=1), axis=1)
    found, _ = index.sample_best(ids[tested], rows[tested], k)
    place = {int(i): p for p, i in enumerate(ids)}
    needed = np.array([rank[q, own[place[int(i)]]] for q in range(len(tested)) for i in found[q]])
    probes = int(np.quantile(needed, recall)) + 2 if len(needed) else 1
    return replace(index, probes=min(lists, probes), sample_lists=own)


def scan(index: Index, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, vector id, inner product): each query's at most ``k`` best of the vectors ``x``, from ``least`` up, by the adaptive scan."""
    a, b = index.lift(x), index.lift_query(q)
    dims = a.shape[1]
    # distances, from inner products: |a|^2 is the same for all
    limit = (b * b).sum(axis=1) + index.longest - 2 * least
    block = b[:, :COLUMNS]
    part = (block * block).sum(axis=1)[:, None] + (a[:, :COLUMNS] ** 2).sum(axis=1)[None, :] - 2 * block @ a[:, :COLUMNS].T
    at = min(COLUMNS, dims)
    keep = part * (dims / at) <= (limit * (1 + FACTOR / np.sqrt(at)) ** 2)[:, None]
    keep &= query_ids[:, None] != ids[None, :]
    i, j = keep.nonzero()
    so_far = part[i, j]
    while at < dims and len(i):
        top = min(at + COLUMNS, dims)
        so_far = so_far + ((b[i, at:top] - a[j, at:top]) ** 2).sum(axis=1)
        at = top
        bound = limit[i] * (1 + FACTOR / np.sqrt(at)) ** 2 if at < dims else limit[i] * (1 + 1e-9) + 1e-9
        ok = so_far * (dims / at) <= bound
        i, j, so_far = i[ok], j[ok], so_far[ok]
    score = np.einsum("ij,ij->i", q[i], x[j])
    order = np.lexsort((-score, ids[j], i))  # rows that repeat an id are one candidate, the nearer
    i, j, score = i[order], j[order], score[order]
    first = np.append(True, (i[1:] != i[:-1]) | (ids[j][1:] != ids[j][:-1]))[: len(i)]
    i, j, score = i[first], j[first], score[first]
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    first = np.searchsorted(i, i)
    best = np.arange(len(i)) - first < k
    return i[best], ids[j[best]], score[best]


def dealt(placed: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``placed`` with ``part``: rows of a list longer than LIST_PART are dealt over several tasks. ``sizes`` are as many as lists."""
    spark = placed.sparkSession
    parts = spark.createDataFrame([(int(i), -(-int(n) // LIST_PART)) for i, n in sizes.items()], "list int, parts int")
    return placed.join(F.broadcast(parts), "list").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")


def search(vectors: DataFrame, is_query: Column, k: int = 20, most: int = 20_000, recall: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` admits, its ``k`` nearest found among all other rows.

    Nearness is the largest inner product, in doubles on the original vectors; ties go to the smaller id. Vectors that are null, zero,
    of another size than most, or that hold a null or non-finite component take no part, nor do null ids. Rows that repeat an id
    are one candidate, the nearer. An empty table gives no rows. Extra columns are ignored.
    """
    spark = vectors.sparkSession
    index = fit(vectors, k, most, recall, id_col, vector_col)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(index)  # bounded: the sample and its centres
    x = components_of(vectors, vector_col)
    good = vectors.where(usable(F.col(vector_col), index.size) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), x.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    kind = good.schema["v"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = shared.value.nearest_list(shared.value.lift(matrix(batch.column("v"), shared.value.size)))
            yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), batch.column("id"), batch.column("v")], ["list", "id", "v"])

    placed = stored(map_batches(good, place, f"list int, id long, v {kind}"), "placed")  # read twice: for the sizes of the lists, and to be scanned
    sizes = {r["list"]: r["count"] for r in placed.groupBy("list").count().collect()}  # as many rows as lists
    held = spark.sparkContext.broadcast(np.array([sizes.get(i, 0) for i in range(len(index.centres))], np.int64))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                ids, q = piece.column("id").to_numpy(), matrix(piece.column("v"), shared.value.size)
                taken = shared.value.probed(shared.value.lift_query(q), held.value, 2 * k)
                least = shared.value.threshold(ids, q, taken, k)
                rows = [(i, int(c), p) for i, c in zip(*taken.nonzero(), strict=True) for p in range(-(-int(held.value[c]) // LIST_PART))]
                who = np.array([i for i, _, _ in rows], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([c for _, c, _ in rows], pa.int32()), pa.array([p for _, _, p in rows], pa.int32()), pa.array(ids[who]), piece.column("v").take(pa.array(who)), pa.array(least[who])], ["list", "part", "id", "v", "least"])

    asked = map_batches(good.where("asks").select("id", "v"), probe, f"list int, part int, id long, v {kind}, least double")
    candidates = dealt(placed, sizes).select("list", "part", "id", "v", F.lit(None).cast("double").alias("least"))
    rows = candidates.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1)))
    rows = rows.withColumn("at", F.xxhash64("list", "part", F.lit(0)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, "at"):
            kind = table.column("kind").to_numpy()
            mine, asks = table.filter(pa.array(kind == 0)), table.filter(pa.array(kind == 1))
            if not mine.num_rows or not asks.num_rows:
                continue
            ids, x = mine.column("id").to_numpy(), matrix(mine.column("v"), shared.value.size)
            for start in range(0, asks.num_rows, 128):
                piece = asks.slice(start, 128)
                query_ids, q = piece.column("id").to_numpy(), matrix(piece.column("v"), shared.value.size)
                i, found, score = scan(shared.value, ids, x, query_ids, q, piece.column("least").to_numpy(), k)
                yield out(pa.array(query_ids[i]), pa.array(found), pa.array(score))

    def out(a: pa.Array, b: pa.Array, c: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([a, b, c], ["query_id", "vec_id", "score"])

    met = map_batches(rows.repartition("at").sortWithinPartitions("at"), work, "query_id long, vec_id long, score double")
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
