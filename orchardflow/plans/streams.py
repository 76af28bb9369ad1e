"""Queries of streams over the driver's tables, each with SQL over the same rows at rest."""

from __future__ import annotations

from pyspark.sql import functions as F

from orchardflow.plans.queries import _table, query
from orchardflow.sources.shared import fresh
from orchardflow.streaming import keyed


def _in_two_batches(spark, sf_dir: str):
    """Events as records of their users: even numbers arrive first, odd ones after the stream was stopped."""
    folder, out, checkpoint = (fresh(spark, x) for x in ("events", "changes", "checkpoint"))
    events = _table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"), F.sha2("event_type", 256).alias("content_hash"), F.lit("s").alias("source_id"), F.struct(F.col("event_id").alias("n")).alias("seq"), "event_id", (F.col("event_id") % 2).cast("int").alias("batch")
    )
    schema = events.schema
    for batch in (0, 1):
        events.where(F.col("batch") == batch).write.mode("append").parquet(f"{folder}/{batch}")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/*")
        told = keyed.classify(stream).select("batch", "key", "event_id", "change", "identical", "conflicting")
        told.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return out, checkpoint


FIRSTS = """
select batch, user_id, event_id, kind, count(*) as n, count(*) filter (event_type = kind) as same from (
    select event_id % 2 as batch, user_id, event_type, min(event_id) over w as event_id, first_value(event_type) over w as kind
    from events window w as (partition by event_id % 2, user_id order by events.event_id rows between unbounded preceding and unbounded following)
) group by all
"""


@query(
    f"""with firsts as ({FIRSTS})
select cast(a.batch as integer) as batch, cast(a.user_id as varchar) as key, a.event_id, case when b.kind is null then 'new' when b.kind = a.kind then 'unchanged' else 'changed' end as change, a.same - 1 as identical, a.n - a.same as conflicting
from firsts a left join firsts b on a.batch = 1 and b.batch = 0 and a.user_id = b.user_id"""
)
def stream_changes(spark, sf_dir):
    """Each user's first event of a batch against the last batch that had one, by keyed state; the stream is stopped between the batches."""
    return spark.read.parquet(_in_two_batches(spark, sf_dir)[0])


@query("select cast(user_id as varchar) as key, sha256(arg_min(event_type, event_id)) as content_hash from (select *, max(event_id % 2) over (partition by user_id) as last from events) where event_id % 2 = last group by user_id")
def stream_snapshot(spark, sf_dir):
    """The state that the stream leaves, read as a snapshot."""
    return keyed.snapshot(spark, _in_two_batches(spark, sf_dir)[1]).select("key", "content_hash")
