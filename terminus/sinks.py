"""Text outputs: tables with tabs, BED lines, reports; a result becomes visible when it is whole."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terminus.functions.numeric import fixed4

# Columns of the site tables of a sample.
SITE_COLUMNS = ("transcript_id", "gene_id", "gene_name", "chromosome", "strand", "ID", "site_position", "site_count", "site_abundance", "transcript_biotype")


def files(spark: SparkSession, path: str):
    """The file system of a path and the path in it, through the session's own configuration."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = files(spark, path)
    return bool(fs.exists(p))


def guard(output: str, inputs: list[str]) -> None:
    """An output that is one of the inputs is an error."""
    if output in inputs:
        raise ValueError(f"the output is an input: {output}")


def one_file(df: DataFrame, path: str, header: str | None = None) -> str:
    """Lines (column `line`) as one file: written aside by as many tasks as the frame has, then joined in the frame's order and renamed.

    The parts pass through the driver as a stream of bytes; `table` leaves them as they are, for catalogues that no one reads as one file."""
    spark = df.sparkSession
    aside = f"{path}.{uuid.uuid4().hex}"
    df.select("line").write.option("lineSep", "\n").text(aside)
    fs, target = files(spark, path)
    parts = sorted((f.getPath() for f in fs.listStatus(files(spark, aside)[1]) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    out = fs.create(files(spark, f"{aside}/whole")[1], True)
    if header is not None:
        out.write(bytearray((header + "\n").encode()))
    for p in parts:
        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(fs.open(p), out, spark._jsc.hadoopConfiguration(), False)
    out.close()
    fs.delete(target, False)
    fs.rename(files(spark, f"{aside}/whole")[1], target)
    fs.delete(files(spark, aside)[1], True)
    return path


def tsv(df: DataFrame, path: str, columns: tuple | list | None = None, parts: bool = False) -> str:
    """A table with a header in one file, or as a folder of parts; null is empty. The rows' order is the frame's."""
    columns = columns or df.columns
    if parts:
        return table(df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]), path)
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return one_file(df.select(line.alias("line")), path, "\t".join(columns))


def table(df: DataFrame, folder: str) -> str:
    """A table of any size as a folder of parts with tabs."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(folder)
    return folder


def with_models(sites: DataFrame, models: DataFrame) -> DataFrame:
    """Sites with their transcript's columns; sites of unknown transcripts are left out."""
    own = models.select("transcript_id", "gene_id", "gene_name", "chromosome", "strand", "transcript_biotype")
    return sites.join(own, "transcript_id").withColumn("ID", F.concat_ws(":", "chromosome", F.col("site_position").cast("string"), "strand"))


def sites(df: DataFrame, path: str) -> str:
    """Site table of a sample, shares with four decimals: one file, since a unification finds samples by the names of their files."""
    more = ["a_content"] if "a_content" in df.columns else []
    own = df.orderBy("transcript_id", "site_rank").withColumns({c: fixed4(F.col(c)) for c in ("site_abundance", *more)})
    return tsv(own, path, [*SITE_COLUMNS, *more])


def report(df: DataFrame, path: str, title: str = "Summary") -> str:
    """Totals and the distribution of sites per transcript; df: (n_sites, n_transcripts, total, several, percent_several), a few rows."""
    rows = sorted(df.collect())
    total, several, percent = (rows[0][2:5] if rows else (0, 0, 0.0))
    lines = [title, "=" * 50, f"Total transcripts analyzed: {total}", f"Transcripts with several sites: {several}", f"Percentage with several sites: {percent:.2f}%", "", "Distribution of sites per transcript:", *[f"  {r[0]} sites: {r[1]} transcripts" for r in rows]]
    spark = df.sparkSession
    fs, p = files(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(p, True)
    out.write(bytearray(("\n".join(lines) + "\n").encode()))
    out.close()
    target = files(spark, path)[1]
    fs.delete(target, False)
    fs.rename(p, target)
    return path


def save_cache(df: DataFrame, folder: str, identity: dict) -> str:
    """Read ends with what they were made from; the note is written last, so a broken save is no cache."""
    spark = df.sparkSession
    fs, note = files(spark, f"{folder}/identity.json")
    fs.delete(note, False)
    df.write.mode("overwrite").parquet(f"{folder}/ends")
    out = fs.create(note, True)
    out.write(bytearray(json.dumps(identity, sort_keys=True).encode()))
    out.close()
    return folder


def load_cache(spark: SparkSession, folder: str, identity: dict) -> DataFrame | None:
    """Saved read ends, or None if there are none or they can't be read; ends made from something else are an error."""
    fs, note = files(spark, f"{folder}/identity.json")
    if not fs.exists(note):
        return None
    try:
        found = json.loads("\n".join(r.value for r in spark.read.text(f"{folder}/identity.json").collect()))
        ends = spark.read.parquet(f"{folder}/ends")
    except Exception:
        return None
    if found != json.loads(json.dumps(identity)):
        raise ValueError(f"{folder} was made from other inputs or settings")
    return ends
