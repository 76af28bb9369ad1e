"""Helpers shared by the operators: shared storage, Arrow batches of texts, connected components."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whether shuffle files go when the query that wrote them ends, and not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Files of a stored table for each core, and the least number of them: each costs its executor processes that set permissions, besides a task.
FILES, LEAST_FILES = 8, 32
#: Texts handled together inside one Arrow batch; bounds a worker's memory.
SLICE = 256


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); where it is unset, one of our own if all runs in this process, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="orchardflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries run within leave no shuffle files, so that the disk holds those of one step at a time."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before or "false")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, so a lost executor costs no recomputation; its shuffle files go.

    The last step's tasks are joined to a few for each core, so that many small partitions leave no more files than the cores need.
    """
    path = scratch(df.sparkSession, name)
    files = max(LEAST_FILES, FILES * df.sparkSession.sparkContext.defaultParallelism)
    with shuffles_go(df.sparkSession):
        df.coalesce(files).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame from :func:`stored` that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def labelled(labels: DataFrame, id_col: str, label_col: str, most: int, allowed: Column | None = None) -> DataFrame:
    """(id, label): at most ``most`` ids, chosen by a hash, whose labels are all 0 or all 1. Null ids and labels count as absent."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    known = (known if allowed is None else known.where(allowed)).groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    return known.select("id", "label").orderBy(F.xxhash64("id"), "id").limit(most)


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that no piece has more than ``size`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` of a partition sorted by it, whole although they may cross batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def give_back() -> None:
    """Memory that this process has freed, but that Arrow's pool and the C library hold for later, goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of some systems lacks it
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function`` over the Arrow batches of each partition; the worker, which later tasks use again, keeps no freed memory after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a long, b long) as (node, root), root the smallest node; nodes without edges are absent.

    Alternates the large-star and small-star steps, each a group-by and an equi-join, until the edges are a forest
    of stars. Each round is written to the shared folder. Nulls and self-loops are ignored.
    """
    current = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that both sides of the join come from a shuffle and Spark can split a hub's rows
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .where("a <> b")
            .distinct()
        )
        following = stored(small, "edges")
        size = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        done = following.agg(size).first() == current.agg(size).first()
        discard(current)
        discard(least)
        current = following
        if done:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
