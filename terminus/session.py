"""Session settings shared by the entry points, the benchmark and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", partitions: int = 8, app: str = "terminus") -> SparkSession:
    """A session with adaptive execution, Arrow transfer and a fixed time zone."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
