"""Change against all earlier batches, with the last content of each key in the stream's own state store.

``incremental`` runs every micro-batch against a snapshot that it reads, joins and replaces whole. Here the state of a key is one row of the store, partitioned
by key and changed only for the keys that a batch brings, however many there are. A stopped stream goes on from its checkpoint. The store can begin
with the snapshot of a batch run, and can be read as one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from orchardflow.functions.records import content_hash, dedupe_key
from orchardflow.operators.extract import read_pages
from orchardflow.operators.extract import records as records_of
from orchardflow.operators.normalize import normalize, rejected, settings, valid
from orchardflow.sources.config import Config
from orchardflow.sources.sinks import failure_rows, product_rows, rejected_rows

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOLD = "key string, change string, identical long, conflicting long, record string"
KEPT = "content_hash string, source_id string"


class LastContent(StatefulProcessor):
    """Of the records of a key in a batch one survives; its content is compared with the stored one and replaces it."""

    def __init__(self, policy: str = "keep_first", forget_after_ms: int | None = None) -> None:
        self.policy, self.forget_after_ms = policy, forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", KEPT, self.forget_after_ms)

    def handleInputRows(self, key, rows, timer) -> Iterator[Row]:
        # whole records are held only of the survivor so far; besides, keep_first counts hashes, keep_last holds places and hashes of all
        first_kept = self.policy == "keep_first"
        counts: Counter[str] = Counter()
        seen: list[tuple[str, str]] = []
        best = lead = None
        for row in rows:
            told = row.place, row.content_hash
            if first_kept:
                counts[row.content_hash] += 1
                lead = told if lead is None or told < lead else lead
            else:
                seen.append(told)
            if best is None or (row.place < best.place if first_kept else row.place > best.place):
                best = row
        seen.sort()
        n = counts.total() if first_kept else len(seen)
        same = counts[lead[1]] - 1 if first_kept else sum(a[1] == b[1] for a, b in pairwise(seen))
        before = self.last.get()[0] if self.last.exists() else None
        change = "new" if before is None else "unchanged" if before == best.content_hash else "changed"
        self.last.update((best.content_hash, best.source_id))
        yield Row(key=key[0], change=change, identical=same, conflicting=n - 1 - same, record=best.record)

    def handleInitialState(self, key, initial, timer) -> None:
        self.last.update((initial.content_hash, initial.source_id))

    def close(self) -> None:
        pass


def classify(products: DataFrame, policy: str = "keep_first", initial: DataFrame | None = None, forget_after_ms: int | None = None) -> DataFrame:
    """A stream of ``products`` (key, content_hash, source_id, seq and more) to each key's survivor of each batch, with ``change``, ``identical`` and ``conflicting``.

    ``seq`` is a struct of whole numbers that orders a batch's records; ``keep_first`` and ``keep_last`` choose by it as in a batch run. ``identical`` and ``conflicting`` count
    the survivor's duplicates in the batch: records that equal the one they are compared with, and others. ``initial`` (key, content_hash, source_id) is what is known
    before the first batch. A key not met for ``forget_after_ms`` counts as new again.
    """
    if policy not in ("keep_first", "keep_last"):
        raise ValueError(f"unknown policy {policy!r}")
    spark = products.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    place = F.concat_ws("/", *(F.lpad(F.col("seq")[f.name].cast("string"), 19, "0") for f in products.schema["seq"].dataType.fields))
    packed = F.to_json(F.struct(*products.columns), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    rows = products.select("key", place.alias("place"), "content_hash", "source_id", packed.alias("record"))
    seed = None if initial is None else initial.select("key", "content_hash", "source_id").groupBy("key")
    timed = "none" if forget_after_ms is None else "processingTime"
    told = rows.groupBy("key").transformWithState(LastContent(policy, forget_after_ms), TOLD, "Append", timed, seed)
    schema = StructType(products.schema.fields)
    whole = F.from_json("record", schema, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return told.select(whole.alias("record"), "change", "identical", "conflicting").select("record.*", "change", "identical", "conflicting")


def products_of(pages: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """(products with key, content_hash and seq, rejected rows) of a stream of pages; the run's time is each batch's."""
    order = F.broadcast(settings(pages.sparkSession, config).select("source_id", "at"))  # as many rows as sources
    rows = normalize(records_of(read_pages(pages, config)), config, None).join(order, "source_id")
    rows = rows.withColumn("seq", F.struct(F.col("at").alias("source"), F.col("page_no").alias("page"), F.col("record_no").alias("record"))).drop("at")
    good = valid(rows).withColumn("key", dedupe_key(config.dedupe.key_fields)).withColumn("content_hash", content_hash())
    return good, rejected(rows)


def start(pages: DataFrame, config: Config, output: str, checkpoint: str, once: bool = False, initial: DataFrame | None = None, forget_after_ms: int | None = None) -> list[StreamingQuery]:
    """Start the streams of products, rejected records and failed pages as JSON lines under ``output``; each file sink takes a batch exactly once.

    Three streams read the pages, each with its own place under ``checkpoint``; only that of products has state.
    """
    good, bad = products_of(pages, config)
    broken = pages.where(F.col("error_kind").isNotNull()).select("source_id", F.coalesce("requested_url", "url").alias("url"), "page_no", F.col("error_kind").alias("kind"), "attempts", F.col("error_message").alias("message"))
    survived = classify(good, config.dedupe.on_conflict, initial, forget_after_ms)
    parts = {
        "products": product_rows(survived),
        "rejected": rejected_rows(bad),
        "failures": failure_rows(broken),
    }
    started = []
    for name, rows in parts.items():
        writer = rows.writeStream.queryName(name).format("json").option("path", f"{output}/{name}").option("ignoreNullFields", "false").option("checkpointLocation", f"{checkpoint}/{name}").outputMode("append")
        started.append((writer.trigger(availableNow=True) if once else writer).start())
    return started


def snapshot(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(key, content_hash, source_id) of all keys in the state of a stream's checkpoint, as a batch run takes it; the store is read by partition."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    found = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    return found.select("key.key", "value.content_hash", "value.source_id")
