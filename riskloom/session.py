"""A session for local runs and tests; on a cluster the session comes from spark-submit."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(name: str = "riskloom", cores: str | None = None, shuffle: int = 8) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Driver and tasks are one process here, so a folder of its own is a shared one.
        .config("spark.checkpoint.dir", os.environ.get("RISKLOOM_SHARED_DIR") or tempfile.mkdtemp())
        .getOrCreate()
    )
