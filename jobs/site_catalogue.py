"""Incremental job: a catalogue of sites that takes up new files of site rows.

    python -m jobs.site_catalogue --sites incoming --output catalogue --checkpoint state --config jobs/site_catalogue.json

A file stream (availableNow) takes the files that its checkpoint hasn't seen. Each batch adds its reads per position and sample to the kept evidence and
segments again only the buckets of genes that it touched; their partitions of the catalogue are replaced, the others stay. A batch that runs again
replaces what it wrote before, so a job that was stopped anywhere ends with the same catalogue.

    output/evidence/batch=N/bucket=B   reads per gene, position, transcript and sample of batch N
    output/catalogue/bucket=B          a row for each position with its cluster and the cluster's representative
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import command, config, log
from terminus.operators import unify

EVIDENCE = "chromosome string, effective_gene_id string, strand string, site_position int, transcript_id string, sample_id string, site_count double, batch int, bucket int"
KEYS = [*unify.JOIN_KEY, "transcript_id", "sample_id"]


def bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(*unify.GENE_KEY), F.lit(buckets)).cast("int"))


def catalogue(rows: DataFrame, segmentation: dict, representative: dict) -> DataFrame:
    """Positions with cluster and representative, from reads per position, transcript and sample."""
    numbered = unify.evidence(rows).join(unify.segment(rows, **segmentation), unify.JOIN_KEY)
    return unify.cluster_map(numbered, **representative)


def take(batch: DataFrame, number: int, output: str, o: dict) -> None:
    """A batch of site rows into the evidence, and its genes' buckets of the catalogue made anew."""
    spark, buckets = batch.sparkSession, int(o["buckets"])
    own = bucketed(batch.selectExpr(*o["select"]).groupBy(*KEYS).agg(F.sum("site_count").alias("site_count")), buckets)
    own.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{output}/evidence/batch={number}")
    kept = spark.read.schema(EVIDENCE).option("basePath", f"{output}/evidence").parquet(f"{output}/evidence")
    touched = [r["bucket"] for r in kept.where(F.col("batch") == number).select("bucket").distinct().collect()]  # as many as the config has buckets, at most
    rows = kept.where(F.col("bucket").isin(touched)).groupBy(*KEYS).agg(F.sum("site_count").alias("site_count"))
    out = bucketed(catalogue(rows, o["segmentation"], o["representative"]), buckets)
    out.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{output}/catalogue")
    log("site_catalogue").info("batch %s: %s of %s buckets made anew in %s", number, len(touched), buckets, output)


def run(spark: SparkSession, sites: str, output: str, checkpoint: str, config_path: str) -> DataFrame:
    """The job; returns the catalogue as it stands. sites: a folder or a pattern of Parquet files with one schema.

    Files without rows leave the catalogue as it is; without any file yet it is empty."""
    o = config(spark, config_path)
    stream = spark.readStream.schema(spark.read.parquet(sites).schema).option("maxFilesPerTrigger", o["files_per_batch"]).parquet(sites)
    query = stream.writeStream.foreachBatch(lambda batch, number: take(batch, number, output, o)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log("site_catalogue").info("read %s new rows of %s in %s batches", sum(p["numInputRows"] for p in query.recentProgress), sites, sum(p["numInputRows"] > 0 for p in query.recentProgress))
    return read(spark, output)


def read(spark: SparkSession, output: str) -> DataFrame:
    schema = catalogue_schema(spark)
    try:
        return spark.read.schema(schema).parquet(f"{output}/catalogue").select(*schema.names).drop("bucket")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema).drop("bucket")


def catalogue_schema(spark: SparkSession):
    none = spark.createDataFrame([], EVIDENCE).drop("batch", "bucket")
    numbered = unify.evidence(none).withColumn("cluster_number", F.lit(0).cast("long"))
    return bucketed(unify.cluster_map(numbered), 1).schema


if __name__ == "__main__":
    command(
        "site_catalogue",
        "a catalogue of sites that takes up new files",
        {"sites": "folder of Parquet files with site rows", "output": "folder of evidence and catalogue", "checkpoint": "folder of the stream's checkpoint", "config": "JSON file"},
        lambda spark, sites, output, checkpoint, config: run(spark, sites, output, checkpoint, config),
    )
