"""Counters of a run, and the check that they reconcile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTERS = ("pages_fetched", "pages_failed", "records_found", "valid", "rejected", "duplicates_identical", "duplicates_conflicting")
MOST_WARNINGS = 50


class Unreconciled(AssertionError):
    """Counters contradict each other; nothing was published."""


def source_counters(sources: DataFrame, events: DataFrame) -> DataFrame:
    """A row for each source with all counters, from ``events`` (source_id, counter, n); sources without events have zeros."""
    sums = events.groupBy("source_id").agg(*(F.sum(F.when(F.col("counter") == c, F.col("n"))).alias(c) for c in COUNTERS))
    return sources.join(sums, "source_id", "left").select(*sources.columns, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTERS))


def with_total(counters: DataFrame) -> DataFrame:
    """The counters by source and in all (source_id null), in one pass."""
    return counters.rollup("source_id").agg(*(F.sum(c).alias(c) for c in COUNTERS))


def unbalanced(counters: DataFrame) -> DataFrame:
    """Sources whose records found are not those valid, rejected and duplicate."""
    return counters.where(F.col("records_found") != F.col("valid") + F.col("rejected") + F.col("duplicates_identical") + F.col("duplicates_conflicting"))


def at_most(warnings: list[str]) -> list[str]:
    """The first warnings, and a last line if there are more."""
    return warnings if len(warnings) <= MOST_WARNINGS else [*warnings[:MOST_WARNINGS], f"and more than these {MOST_WARNINGS}"]


def capped_warnings(warnings: DataFrame, order: str = "seq") -> list[str]:
    """The first warnings in order, and a last line if there are more."""
    return at_most([r[0] for r in warnings.orderBy(order).select("warning").limit(MOST_WARNINGS + 1).collect()])
