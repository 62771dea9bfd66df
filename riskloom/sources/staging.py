"""Intermediate tables in the shared folder the cluster names in ``spark.checkpoint.dir``.

A staged table is plain Parquet: it cuts lineage, survives lost executors, and later passes read
only the columns they need.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """``<spark.checkpoint.dir>/<application id>``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the staging root."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once, by the session's compression or the given one, and return a scan of the written table."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
