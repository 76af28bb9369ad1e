"""A run: a table of fetched pages to products, rejected records, duplicates, failures and a report that reconciles."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchardflow.functions.records import content_hash, dedupe_key
from orchardflow.operators import changes, dedupe, report
from orchardflow.operators.extract import read_pages
from orchardflow.operators.extract import records as records_of
from orchardflow.operators.normalize import normalize, reason_counts, rejected, settings, valid
from orchardflow.sources.config import Config, Source


@dataclass
class RunResult:
    """Lazy tables, and the report as a plain mapping."""

    products: DataFrame
    rejected: DataFrame
    duplicates: DataFrame
    failures: DataFrame
    state: DataFrame
    report: dict
    kept: list[DataFrame] = field(default_factory=list)

    def release(self) -> None:
        for df in self.kept:
            df.unpersist()


def pages_of(pages: DataFrame, config: Config) -> DataFrame:
    """The pages of the config's sources, by a list that reaches the scan's filters."""
    return pages.where(F.col("source_id").isin(*(s.id for s in config.sources)))


def run(spark: SparkSession, config: Config, pages: DataFrame, now: datetime, state: DataFrame | None = None, only_changed: bool = False) -> RunResult:
    """``pages`` has the columns of ``schemas.PAGES``, a row for each page fetched or failed; ``now`` has a time zone.

    ``state`` is the last run's (key, content_hash), or None if changes are not tracked. The counters are reconciled before anything is returned.
    """
    began, run_id = time.monotonic(), uuid.uuid4().hex[:12]
    pages = pages_of(pages, config)
    order = F.broadcast(settings(spark, config).select("source_id", "at"))  # as many rows as sources
    # the parsed pages feed four tables and the report; they spill to disk, and are computed again if an executor goes
    read = read_pages(pages, config).persist(StorageLevel.MEMORY_AND_DISK)
    ordered = normalize(records_of(read), config, now).join(order, "source_id")
    rows = ordered.withColumn("seq", F.struct(F.col("at").alias("source"), F.col("page_no").alias("page"), F.col("record_no").alias("record"))).drop("at")
    # keys and hashes are made once, with the rows; so are the pairs, which the counters, duplicates and survivors are taken from
    kept = F.size("reasons") == 0
    rows = rows.withColumn("key", F.when(kept, dedupe_key(config.dedupe.key_fields))).withColumn("content_hash", F.when(kept, content_hash())).persist(StorageLevel.MEMORY_AND_DISK)
    paired = dedupe.pair_up(valid(rows), config.dedupe.on_conflict).persist(StorageLevel.MEMORY_AND_DISK)
    same = dedupe.duplicates(paired, config.dedupe.on_conflict)
    survived = changes.classify(dedupe.survivors(paired), state).persist(StorageLevel.MEMORY_AND_DISK)
    products = changes.only_changed(survived) if only_changed else survived

    counted = read.select("source_id", "page_no", "page_url", F.size("records").alias("n"))
    firsts = counted.groupBy("source_id").agg(F.min(F.struct("page_no", "page_url", "n")).alias("first"))
    empty = firsts.where("first.n = 0").select("source_id", "first.page_no", "first.page_url")
    broken = pages.where(F.col("error_kind").isNotNull()).select("source_id", F.coalesce("requested_url", "url").alias("url"), "page_no", F.col("error_kind").alias("kind"), "attempts", F.col("error_message").alias("message"))
    nothing = empty.select("source_id", F.col("page_url").alias("url"), "page_no", F.lit("no_records").alias("kind"), F.lit(1).alias("attempts"), F.lit("no record on the first page: record_selector may no longer fit").alias("message"))
    failures = broken.unionByName(nothing)

    told = _told(spark, config, pages, read, rows, paired, same, survived, failures)
    by_source, total = told["counters"], {c: sum(r[c] for r in told["counters"]) for c in report.COUNTERS}
    histogram, rejections = told["change"], told["reason"]
    exported, survivors = (sum(n for c, n in histogram.items() if not only_changed or c in ("new", "changed"))), sum(histogram.values())
    wrong = [r["source_id"] for r in by_source if r["records_found"] != r["valid"] + r["rejected"] + r["duplicates_identical"] + r["duplicates_conflicting"]]
    if wrong or survivors != total["valid"]:
        raise report.Unreconciled(f"counters contradict each other: {', '.join(wrong) or 'more or fewer survivors than valid records'}")
    warnings = report.at_most(told["warning"])
    if not exported:
        warnings.append("nothing was exported: see the failures and the rejected records")
    found = {
        "run_id": run_id,
        "started_at": now.isoformat(),
        "duration_seconds": round(time.monotonic() - began, 3),
        "config_path": config.path,
        "config_sha256": config.sha256,
        "state_file": config.run.state_file,
        "sources": [{"source_id": r["source_id"], "kind": r["kind"], **{c: r[c] for c in report.COUNTERS}, "stopped_because": told["stopped"].get(r["source_id"], "not_started")} for r in by_source],
        "totals": total,
        "rejections_by_reason": dict(sorted(rejections.items())),
        "changes": histogram | {"filtered_out": survivors - exported},
        "warnings": warnings,
        "exported": exported,
        "exit_code": int(bool(total["pages_failed"]) or not exported),
    }
    return RunResult(products.orderBy("first_seq"), rejected(rows), same, failures, survived.select("key", "content_hash", "source_id"), found, [read, rows, paired, survived])


def _told(spark: SparkSession, config: Config, pages: DataFrame, read: DataFrame, rows: DataFrame, paired: DataFrame, same: DataFrame, survived: DataFrame, failures: DataFrame) -> dict:
    """All that the report needs, by one action over the tables of the run: counters and the end of each source's pages, changes, reasons, first warnings.

    Every part is an aggregate, or a limit, bounded by the sources of the config or a closed vocabulary; they come as rows of (what, name, told as JSON).
    """
    one = F.lit(1).cast("long")
    named = lambda df, name: df.select("source_id", (F.lit(name) if isinstance(name, str) else name).alias("counter"), one.alias("n"))
    events = [
        named(read, "pages_fetched"),
        named(failures, "pages_failed"),
        named(rows, "records_found"),
        named(paired.where("other is null"), "valid"),
        named(rejected(rows), "rejected"),
        named(same, F.concat(F.lit("duplicates_"), F.col("kind"))),
    ]
    declared = spark.createDataFrame([(s.id, s.kind, i) for i, s in enumerate(config.sources)], "source_id string, kind string, at int")
    counters = report.source_counters(declared, reduce(DataFrame.unionByName, events))

    seen = pages.select("source_id", F.struct("page_no", "error_kind", "stopped_because").alias("page"), F.lit(None).cast("struct<page_no:int,n:int>").alias("read"))
    fetched = read.select("source_id", F.lit(None).cast("struct<page_no:int,error_kind:string,stopped_because:string>").alias("page"), F.struct("page_no", F.size("records").alias("n")).alias("read"))
    ends = seen.unionByName(fetched).groupBy("source_id").agg(F.max("page").alias("page"), F.max("read").alias("read"), F.count_if(F.col("read.n") > 0).alias("full"))

    as_rows = lambda df, what, name: df.select(F.lit(what).alias("what"), F.col(name).cast("string").alias("name"), F.to_json(F.struct(*(c for c in df.columns if c != name)), {"ignoreNullFields": "false"}).alias("told"))
    first = rows.where("warning is not null").select("seq", "warning").orderBy("seq").limit(report.MOST_WARNINGS + 1)
    parts = [
        as_rows(counters, "counters", "source_id"),
        as_rows(ends, "ends", "source_id"),
        as_rows(changes.change_counts(survived), "change", "change"),
        as_rows(reason_counts(rejected(rows)), "reason", "reason"),
        as_rows(first, "warning", "warning"),
    ]
    found: dict[str, list[tuple[str, dict]]] = {x: [] for x in ("counters", "ends", "change", "reason", "warning")}
    for r in reduce(DataFrame.unionByName, parts).collect():
        found[r.what].append((r.name, json.loads(r.told)))
    by_source = sorted((dict(t, source_id=name) for name, t in found["counters"]), key=lambda r: r["at"])
    warnings = sorted(found["warning"], key=lambda w: tuple(w[1]["seq"].values()))
    return {
        "counters": by_source,
        "change": {name: t["n"] for name, t in found["change"]},
        "reason": {name: t["n"] for name, t in found["reason"]},
        "warning": [name for name, _ in warnings],
        "stopped": {name: _stopped(config.source(name), t) for name, t in found["ends"]},
    }


def _stopped(source: Source, ends: dict) -> str:
    """Why a source's pagination ended: as the crawl says, else from its last page."""
    last, read, full = ends["page"], ends["read"], ends["full"]
    if last["error_kind"]:
        return "page_failed"
    if read and read["page_no"] == last["page_no"] and read["n"] == 0:
        return "empty_page" if full else "no_records"
    if last["stopped_because"]:
        return last["stopped_because"]
    if source.pagination.strategy == "none":
        return "single_page"
    return "max_pages" if full and full >= source.pagination.max_pages else "no_next_link"
