"""Continuous runs: pages arrive as a stream, each micro-batch is a run of its own against the snapshot so far."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from orchardflow.operators.changes import merged_state
from orchardflow.plans.run import run
from orchardflow.sources.config import Config
from orchardflow.sources.sinks import write_tables
from orchardflow.sources.state import read_state, write_state


def start(pages: DataFrame, config: Config, output: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Start the stream. Batch n's datasets go to ``output/batch=n``, written over if the batch is tried again; the snapshot is
    replaced after the datasets, so a batch that fails between is classified anew against the same snapshot."""

    def batch(part: DataFrame, n: int) -> None:
        spark, now = part.sparkSession, datetime.now(UTC)
        state = read_state(spark, config.run.state_file)
        result = run(spark, config, part.persist(), now, state)
        write_tables(result, f"{output}/batch={n}", config.run.formats)
        if config.run.state_file and result.report["totals"]["valid"]:
            before = state.join(result.state.select("key"), "key", "left_anti").select("key", "content_hash", "source_id")
            write_state(spark, config.run.state_file, merged_state(result.state.unionByName(before), None), now)
        result.release()
        part.unpersist()

    writer = pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
