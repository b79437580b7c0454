"""Session settings the jobs assume. A cluster's own settings win where they are set."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the JVM does not compile methods beyond 8000 bytes; let Spark split those instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # partitioned writes keep a few files open instead of sorting every row first
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hitledger")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
