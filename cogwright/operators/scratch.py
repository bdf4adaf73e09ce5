"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; only a local session without that setting gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _OWN.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="spark-scratch-")
        _OWN[spark.sparkContext.applicationId] = root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to scratch and read back: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
