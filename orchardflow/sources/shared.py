"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder of our own if everything runs in this process, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="orchardflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read from there: its lineage ends, and a lost executor costs no recomputation."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder in any store; whether it was there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame from :func:`stored` that nothing reads any more."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        remove(df.sparkSession, path)
