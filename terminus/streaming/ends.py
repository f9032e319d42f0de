"""Read ends as a stream: alignments arrive as files of text, ends are appended, counts per position are kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terminus.operators import assign, sites
from terminus.sources import tables


def alignments(spark: SparkSession, folder: str, oriented: bool = False) -> DataFrame:
    """Alignments of SAM files that appear in a folder."""
    return tables.sam(spark.readStream.text(folder)).withColumn("oriented", F.lit(oriented))


def append_ends(stream: DataFrame, chains: DataFrame, singles: DataFrame, terminal: DataFrame, folder: str, checkpoint: str, min_mapq: int = 1, least: float = 0.5):
    """Assign each micro-batch and append its read ends; a batch that runs again replaces what it wrote."""

    def one(batch: DataFrame, number: int) -> None:
        ends = assign.assign(batch, chains, singles, terminal, min_mapq, least)
        ends.groupBy("transcript_id", "read_end").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def collected(spark: SparkSession, folder: str) -> DataFrame:
    """All read ends that were appended, one row for each read."""
    n = spark.read.parquet(folder).groupBy("transcript_id", "read_end").agg(F.sum("n").alias("n"))
    return n.select("transcript_id", "read_end", F.explode(F.array_repeat(F.lit(1), F.col("n").cast("int")))).drop("col")


def call_sites(spark: SparkSession, folder: str, **options) -> DataFrame:
    return sites.call_sites(collected(spark, folder), **options)


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Events (ts, user_id) per window of time and user, with a bound on how late they may come."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "user_id").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "user_id", "n")
