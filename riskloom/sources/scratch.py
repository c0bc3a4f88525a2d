"""Materialisation between stages: written tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder of our own, if tasks run in this process (an error on a cluster)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="riskloom-")
    return _OWN[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{folder(spark)}/riskloom/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write and read again: later stages take many statistics over the rows, and their plans start here.

    Unlike cached blocks the files outlive any executor, and unlike a cache they cut the logical plan, whose
    analysis would otherwise dominate.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
