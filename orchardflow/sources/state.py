"""Snapshots of keys and content hashes between runs: read with checks, replaced whole.

A snapshot is a folder of records and a numbered small file that names it, which appears by one rename to a name that was never used. The highest number
counts, so at every moment a whole snapshot is there: the old one or the new. The one before is kept for runs that still read it; older ones are removed.

Records are bucketed and sorted by key, so that a run that compares its products with them shuffles its products only.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from orchardflow.schemas import STATE
from orchardflow.sources.config import ConfigError

VERSION = 1
COLUMNS = "key string, content_hash string, source_id string"
META = re.compile(r"meta(?:-(\d+))?\.json")


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def read_state(spark: SparkSession, path: str | None) -> DataFrame | None:
    """None if no path is given: changes are not tracked. Empty if there is no snapshot yet. A broken or unknown one is an error."""
    if not path:
        return None
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return spark.createDataFrame([], COLUMNS)
    try:
        metas = _metas(spark, path)
        meta = json.loads("\n".join(r.value for r in spark.read.text(f"{path}/{metas[-1][1]}").collect()))  # one small file
        if meta["version"] != VERSION:
            raise ConfigError(f"{path}: snapshot version {meta['version']} is not supported")
        found = _records(spark, f"{path}/{meta['records']}", meta.get("buckets"))
        if not set(STATE.names) <= set(found.columns):
            raise ConfigError(f"{path}: the snapshot lacks columns")
        return found
    except ConfigError:
        raise
    except Exception as wrong:
        raise ConfigError(f"{path} is not a readable snapshot: {wrong}") from wrong


def _records(spark: SparkSession, path: str, buckets: int | None) -> DataFrame:
    """Records with what is known of their buckets. Only a table can state that; its name is dropped at once, the frame and the files stay."""
    if not buckets:
        return spark.read.parquet(path)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    name, where = f"snapshot_{uuid.uuid4().hex}", _absolute(spark, path).replace("'", "\\'")
    spark.sql(f"create table {name} ({fields}) using parquet clustered by (key) sorted by (key) into {buckets} buckets location '{where}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"drop table {name}")


def _metas(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, name) of the files that name snapshots, in order; one without a number comes first."""
    fs, where = _fs(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []
    return sorted((int(m[1] or 0), name) for name in names if (m := META.fullmatch(name)))


def write_state(spark: SparkSession, path: str, state: DataFrame, now: datetime, buckets: int | None = None) -> None:
    """Write a new snapshot beside the old one, then name it: a reader of the old one, this run included, is never cut off.

    ``buckets``: as many as a shuffle has partitions, unless given; with as many, a run's join with the snapshot needs no exchange on its side.
    """
    before = _metas(spark, path)
    name, table = f"records-{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}", f"snapshot_{uuid.uuid4().hex}"
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    state.repartition(n, "key").write.bucketBy(n, "key").sortBy("key").option("path", _absolute(spark, f"{path}/{name}")).saveAsTable(table)
    spark.sql(f"drop table {table}")  # the files are not the table's own and stay
    number = before[-1][0] + 1 if before else 1
    _publish(spark, path, f"meta-{number:08d}.json", {"version": VERSION, "updated_at": now.isoformat(), "records": name, "buckets": n})
    _prune(spark, path)


def _absolute(spark: SparkSession, path: str) -> str:
    """A path as it stands whatever the warehouse: relative ones count from the working folder."""
    fs, where = _fs(spark, path)
    return fs.makeQualified(where).toString()


def _publish(spark: SparkSession, path: str, name: str, meta: dict) -> None:
    fs, new = _fs(spark, f"{path}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(new, False)
    out.write(bytearray(json.dumps(meta).encode()))
    out.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    if fs.exists(target) or not fs.rename(new, target):
        fs.delete(new, False)
        raise ConfigError(f"{path}: another run has written {name} meanwhile; the snapshot stays as it was")


def _prune(spark: SparkSession, path: str) -> None:
    """Remove all but the last two snapshots, and records of the day before or earlier that no snapshot names, left by a run that broke off."""
    fs, where = _fs(spark, path)
    metas = [m for _, m in _metas(spark, path)]
    named = {m: json.loads("\n".join(r.value for r in spark.read.text(f"{path}/{m}").collect()))["records"] for m in metas}
    kept = {*metas[-2:], *(named[m] for m in metas[-2:])}
    for f in fs.listStatus(where):
        name = f.getPath().getName()
        left_over = name.startswith("records-") and f.getModificationTime() < (time.time() - 86_400) * 1000
        if name not in kept and (name in named or name in named.values() or left_over):
            fs.delete(f.getPath(), True)
