"""Keyed duplicates in order.

``keep_first`` compares every later record of a key with its first, ``keep_last`` each with the one before it. Survivors stand at their
key's first place either way. The order is an explicit struct column; nothing depends on the order of rows.

No key needs one task for all its records. ``keep_first``: the survivor is an aggregate, combined before the shuffle, and later records meet it in a join whose
skewed partitions can be split. ``keep_last``: records of a key are ordered by windows, but a key with very many is dealt in ranges of its order, and the last record
of each range is carried to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orchardflow.functions.records import differing_fields, values_of
from orchardflow.schemas import COMPARED
from orchardflow.sources.shared import stored


#: Records of a key beyond which ``keep_last`` deals them in ranges.
MANY = 100_000


def pair_up(products: DataFrame, policy: str = "keep_first", key: str = "key", order: str = "seq", many: int | None = None) -> DataFrame:
    """``products`` with ``other`` (the record each is compared with, null for a key's first), ``first_seq`` and ``survives``.

    ``keep_last`` counts the records by key first; keys with more than ``many`` are dealt in ranges.
    """
    record = F.struct(*COMPARED, "source_id")
    if policy == "keep_first":
        first = products.groupBy(key).agg(F.min(F.struct(F.col(order), record.alias("record"))).alias("first"))
        joined = products.join(first, key)
        mine = F.col(order) == F.col("first")[order]
        return joined.select(*products.columns, F.when(~mine, F.col("first.record")).alias("other"), F.col("first")[order].alias("first_seq"), mine.alias("survives"))
    if policy != "keep_last":
        raise ValueError(f"unknown policy {policy!r}")
    common = stored(products.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > (MANY if many is None else many)).select(key), "common")
    if common.isEmpty():
        return _in_order(products, record, key, order)
    few = _in_order(products.join(common, key, "left_anti"), record, key, order)
    return few.unionByName(_in_ranges(products.join(common, key, "left_semi"), record, key, order))


def _in_order(products: DataFrame, record: Column, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    last = F.lead(F.lit(1)).over(w).isNull()
    return products.select("*", F.lag(record).over(w).alias("other"), F.first(order).over(w).alias("first_seq"), last.alias("survives"))


def _in_ranges(products: DataFrame, record: Column, key: str, order: str) -> DataFrame:
    """As :func:`_in_order`, for keys of any size: within a range by a window, at a range's first record from the range before.

    The ranges are Spark's own, by key and order, and are written before they are used twice. A key has at most as many ranges as there are partitions.
    """
    ranged = stored(products.repartitionByRange(key, order).withColumn("_range", F.spark_partition_id()), "ranges")
    w = Window.partitionBy(key, "_range").orderBy(order)
    within = ranged.select("*", F.lag(record).over(w).alias("_before"), (F.row_number().over(w) == 1).alias("_opens"))
    ends = ranged.groupBy(key, "_range").agg(F.min(order).alias("_low"), F.max(F.struct(F.col(order), record.alias("record"))).alias("_end"))
    by_range = Window.partitionBy(key).orderBy("_range")
    whole = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = ends.select(key, "_range", F.lag("_end.record").over(by_range).alias("_carried"), F.min("_low").over(whole).alias("first_seq"), F.max(F.col("_end")[order]).over(whole).alias("_last"))
    joined = within.join(carried, [key, "_range"])
    other = F.when(F.col("_opens"), F.col("_carried")).otherwise(F.col("_before"))
    return joined.select(*products.columns, other.alias("other"), "first_seq", (F.col(order) == F.col("_last")).alias("survives"))


def survivors(paired: DataFrame) -> DataFrame:
    """The surviving record of each key; sort by ``first_seq`` for the order in which keys were first seen."""
    return paired.where("survives").drop("other", "survives")


def duplicates(paired: DataFrame, policy: str = "keep_first") -> DataFrame:
    """A row for each record that met an earlier one of its key.

    ``source_id`` is the incoming record's; kept and dropped follow the policy, and ``dropped_source_id`` is that of the dropped record.
    """
    mine = F.struct(*COMPARED, "source_id")
    kept, dropped = (mine, F.col("other")) if policy == "keep_last" else (F.col("other"), mine)
    rows = paired.where(F.col("other").isNotNull()).select("key", "seq", "source_id", kept.alias("kept"), dropped.alias("dropped"))
    rows = rows.withColumn("differing_fields", differing_fields(F.col("kept"), F.col("dropped")))
    return rows.select(
        "source_id",
        "key",
        "seq",
        F.when(F.size("differing_fields") == 0, "identical").otherwise("conflicting").alias("kind"),
        F.col("kept.source_id").alias("kept_source_id"),
        F.col("kept.url").alias("kept_url"),
        F.col("dropped.source_id").alias("dropped_source_id"),
        F.col("dropped.url").alias("dropped_url"),
        "differing_fields",
        values_of(F.col("kept"), F.col("differing_fields")).alias("kept_values"),
        values_of(F.col("dropped"), F.col("differing_fields")).alias("dropped_values"),
    )
