"""Intermediate tables that several results are made from."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session gets one of its own where that is unset."""
    there = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if there:
        return there.rstrip("/")
    if not (own := getattr(spark.sparkContext, "_terminus_staging", None)):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        own = spark.sparkContext._terminus_staging = f"file://{tempfile.mkdtemp(prefix='terminus-')}"
    return own


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, computed once: a table in the shared folder, so that no lost executor makes them again. What was shuffled for them goes."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._terminus_path = path
    freed(df.sparkSession)
    return out


def freed(spark: SparkSession) -> None:
    """Shuffle files that no frame needs any more go: Spark removes them when the driver's garbage is collected, which a driver with memory to spare seldom does.
    What the last job shuffled is let go by the first collection and found by the second."""
    for _ in range(2):
        spark._jvm.System.gc()
        time.sleep(0.2)


def dropped(*frames: DataFrame) -> None:
    """Delete the tables of staged frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(df._terminus_path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
