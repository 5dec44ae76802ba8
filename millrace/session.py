"""Session settings for local runs and tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "millrace", cpus: int | str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS") or 8
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
