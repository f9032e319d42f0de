"""Batch job: motif contexts of candidate sites in a table of sequences held as text, under several lineages' models.

    python -m jobs.motif_scan --sequences documents.parquet --output motifs --config jobs/motif_scan.json

Reads (id, text) rows, takes their letters as bases, places candidate sites, scans the context of each with every model of the config and writes
Parquet partitioned by motif_model and motif_support. A sequence and its sites stay in their row, so nothing is shuffled but the
rows on their way to the files of a partition. The output is replaced as a whole; a rerun gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs.common import command, config, log
from terminus.functions import sequence
from terminus.operators import annotate


def sequences(table: DataFrame, o: dict) -> DataFrame:
    """(chromosome, sequence) of the rows that have letters: each letter is the base that the config gives it. A null text has none.

    Whether a text has a letter that is not left out is asked of the text, else its letters would be taken twice: for the question and for the row."""
    source, target = o["bases"]
    kept = "".join(c for c in map(chr, range(65, 91)) if source.find(c) < len(target))
    text = F.coalesce(F.col(o["text"]).cast("string"), F.lit(""))
    letters = F.upper(F.regexp_replace(text, "[^A-Za-z]+", ""))
    own = table.where(text.rlike(f"[{kept}{kept.lower()}]") if kept else F.lit(False))
    return own.select(F.concat(F.lit(o["prefix"]), F.col(o["id"]).cast("string")).alias("chromosome"), F.translate(letters, source, target).alias("sequence"))


def sites(own: DataFrame, parts: list[int]) -> DataFrame:
    """(chromosome, sequence, k, site_position, strand): for each part p a site that many parts into the sequence, 0 for its last base; strands alternate."""
    n = F.length("sequence")
    place = F.get(F.array(*[(F.floor(n / p) + 1 if p else n).cast("int") for p in parts]), F.col("k"))
    own = own.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(len(parts) - 1))))
    return own.select("chromosome", "sequence", "k", place.alias("site_position"), F.when((n + F.col("k")) % 2 == 0, "+").otherwise("-").alias("strand"))


def scanned(placed: DataFrame, models: list[str]) -> DataFrame:
    context, start = sequence.oriented_context(F.col("sequence"), F.col("site_position"), F.col("strand"))
    own = placed.select("chromosome", "k", "site_position", "strand", context.alias("context"), start.alias("start"))
    found = F.array(*[F.struct(F.lit(m.lower()).alias("motif_model"), annotate.motif(F.col("context"), F.col("start"), m).alias("m")) for m in models])
    own = own.select("chromosome", "k", "site_position", "strand", F.explode(found).alias("f"))
    return own.select("chromosome", "k", "site_position", "strand", "f.motif_model", "f.m.*")


def run(spark: SparkSession, sequences_path: str, output: str, config_path: str) -> DataFrame:
    """The job; returns the table that it wrote, read back."""
    o = config(spark, config_path)
    read, wrote = Observation("read"), Observation("wrote")
    own = spark.read.parquet(sequences_path).observe(read, F.count(F.lit(1)).alias("rows"))
    out = scanned(sites(sequences(own, o), o["parts"]), o["models"]).observe(wrote, F.count(F.lit(1)).alias("rows"))
    out.repartition("motif_model", "motif_support", F.pmod(F.xxhash64("chromosome"), F.lit(o["files"]))).write.mode("overwrite").partitionBy("motif_model", "motif_support").parquet(output)
    log("motif_scan").info("read %s rows of %s, wrote %s sites under %s models to %s", read.get["rows"], sequences_path, wrote.get["rows"], len(o["models"]), output)
    schema = ", ".join(f"{n} {t}" for n, t in out.dtypes if n not in ("motif_model", "motif_support")) + ", motif_model string, motif_support string"
    return spark.read.schema(schema).parquet(output)


if __name__ == "__main__":
    command("motif_scan", "motif contexts of candidate sites in sequences held as text", {"sequences": "table of sequences", "output": "folder to write", "config": "JSON file"}, lambda spark, sequences, output, config: run(spark, sequences, output, config))
