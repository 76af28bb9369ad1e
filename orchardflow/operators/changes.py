"""Change against the previous run's snapshot of key and content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classify(products: DataFrame, state: DataFrame | None, key: str = "key", digest: str = "content_hash") -> DataFrame:
    """``products`` with ``change``: ``unknown`` without a snapshot, else ``new``, ``unchanged`` or ``changed``.

    An equi-join on the key; Spark broadcasts the snapshot only where its size allows.
    """
    if state is None:
        return products.withColumn("change", F.lit("unknown"))
    known = state.select(F.col("key").alias("_key"), F.col("content_hash").alias("_before"))
    change = F.when(F.col("_key").isNull(), "new").when(F.col("_before") == F.col(digest), "unchanged").otherwise("changed")
    return products.join(known, F.col(key) == F.col("_key"), "left").withColumn("change", change).drop("_key", "_before")


def only_changed(products: DataFrame) -> DataFrame:
    return products.where(F.col("change").isin("new", "changed"))


def removed(products: DataFrame, state: DataFrame, key: str = "key") -> DataFrame:
    """Keys of the snapshot that this run did not see."""
    return state.join(products.select(F.col(key).alias("key")), "key", "left_anti")


def change_counts(products: DataFrame) -> DataFrame:
    return products.groupBy("change").agg(F.count("*").alias("n"))


def merged_state(products: DataFrame, state: DataFrame | None, sources_run: list[str] | None = None) -> DataFrame:
    """The next snapshot (key, content_hash, source_id): this run's survivors and, if ``sources_run`` is a part of the
    sources, the snapshot's rows of the others."""
    new = products.select("key", "content_hash", "source_id")
    if state is None or sources_run is None:
        return new
    rest = state.where(~F.col("source_id").isin(*sources_run)).join(new.select("key"), "key", "left_anti")
    return new.unionByName(rest.select("key", "content_hash", "source_id"))
