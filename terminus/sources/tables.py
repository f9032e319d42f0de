"""Text sources besides annotation: manifests, alignments, sequences, site tables, motif tables."""

from __future__ import annotations

import csv
import io
import os
import shlex
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terminus.staging import staged

# What counts as missing in a site table; columns of a site table; accessions of mitochondria.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
PAS_COLUMNS = ("transcript_id", "gene_id", "gene_name", "chromosome", "strand", "site_position", "site_count", "site_abundance", "transcript_biotype")
MITOCHONDRIA = ("NC_012920.1", "NC_005089.1")
BIOTYPES = ("mRNA", "lncRNA", "lnc_RNA", "protein_coding", "")
UNIFIED_MARK = "cluster_key"

# Platform labels and the aligner's preset, strand and k-mer length for each; labels that count as none.
PROFILES = {
    "unspecified": ("splice", "b", 15),
    "drna": ("splice", "f", 14),
    "pcr-cdna": ("splice", "b", 15),
    "dcdna": ("splice", "b", 15),
    "pacbio": ("splice:hq", "b", 15),
}
NO_PLATFORM = ("", "-", ".", "na", "n/a", "unknown", "not reported", "unspecified")
MAX_INTRON = 500_000

#: A genome tile's length, and how far it reaches into the next.
TILE, OVERLAP = 4096, 256


def manifest(text: str, folder: str, exists=None) -> list[tuple[str, str]]:
    """(path, platform label) of each line of a manifest.

    Blank lines and # are skipped; fields are split by tab if there is one, else by spaces with double quotes; a first line of
    the two header words is dropped; relative paths belong to the manifest's folder; a repeated or missing file is an error.
    """
    out: list[tuple[str, str]] = []
    first = True
    for line in text.removeprefix("﻿").splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        fields = next(csv.reader(io.StringIO(line), delimiter="\t")) if "\t" in line else shlex.split(line)
        fields = [f.strip() for f in fields]
        if not 1 <= len(fields) <= 2 or not fields[0]:
            raise ValueError(f"a manifest line has one or two fields: {line!r}")
        if first and len(fields) == 2 and fields[0].lower() in ("fastq", "fastq_path") and fields[1].lower() in ("platform", "library_type"):
            first = False
            continue
        first = False
        path = fields[0] if fields[0].startswith("/") or "://" in fields[0] else str(PurePosixPath(folder) / fields[0])
        if any(path == p for p, _ in out):
            raise ValueError(f"repeated input: {path}")
        if exists is not None and not exists(path):
            raise FileNotFoundError(path)
        out.append((path, fields[1] if len(fields) > 1 else ""))
    return out


def platform(label: Column) -> Column:
    """A library label in its normal form; an unknown one is an error."""
    own = F.lower(F.trim(F.coalesce(label, F.lit(""))))
    own = F.when(own.isin(*NO_PLATFORM), F.lit("unspecified")).otherwise(own)
    return F.when(own.isin(*PROFILES), own).otherwise(F.raise_error(F.concat(F.lit("unknown platform: "), own)))


def profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, *v, MAX_INTRON) for k, v in PROFILES.items()], "platform string, preset string, splice_strand string, kmer int, max_intron int")


def sam(raw: DataFrame) -> DataFrame:
    """Alignments of SAM lines (value); header lines are dropped."""
    f = F.split("value", "\t")
    own = raw.where(~F.col("value").startswith("@")).withColumn("f", f).where(F.size("f") >= 11)
    return own.select(
        F.get("f", F.lit(0)).alias("read_id"), F.get("f", F.lit(1)).cast("int").alias("flag"), F.get("f", F.lit(2)).alias("rname"), (F.get("f", F.lit(3)).cast("int") - 1).alias("pos0"),
        F.get("f", F.lit(4)).cast("int").alias("mapq"), F.get("f", F.lit(5)).alias("cigar"), F.exists(F.slice("f", 12, 1000), lambda t: t.startswith("SA:")).alias("has_sa"),
    )


def fasta_files(spark: SparkSession, path: str) -> DataFrame:
    """Chromosomes of FASTA files: records are cut at their marks by the reader, so a file splits over tasks."""
    raw = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    return raw.select(F.regexp_extract("value", r"^\s*(\S*)", 1).alias("chromosome"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s+", "").alias("sequence"))


def fasta_faults(raw: DataFrame) -> DataFrame:
    """(chromosome, fault) of sequences that are unnamed, repeated, empty or hold other than nucleotide codes."""
    n = raw.groupBy("chromosome").agg(F.count(F.lit(1)).alias("n"), F.min(F.length("sequence")).alias("least"), F.bool_or(F.col("sequence").rlike("[^ACGTURYSWKMBDHVNacgturyswkmbdhvn]")).alias("odd"))
    fault = F.when(F.col("chromosome") == "", "unnamed").when(F.col("n") > 1, "repeated").when(F.col("least") == 0, "empty").when(F.col("odd"), "not nucleotides")
    return n.select("chromosome", fault.alias("fault")).where("fault IS NOT NULL")


def wrapping_faults(spark: SparkSession, path: str) -> DataFrame:
    """Records of FASTA files whose lines are not all as long as their first, the last one excepted, or that have a blank line."""
    raw = spark.read.option("lineSep", ">").text(path).where(F.trim("value") != "")
    own = raw.withColumn("rows", F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")).withColumn("sizes", F.transform(F.slice("rows", 2, 1_000_000_000), lambda x: F.length(x)))
    first, n = F.try_element_at("sizes", F.lit(1)), F.size("sizes")
    odd = F.exists(F.slice("sizes", 1, F.greatest(n - 1, F.lit(0))), lambda x: x != first) | (F.try_element_at("sizes", F.lit(-1)) > first) | F.exists("sizes", lambda x: x == 0)
    return own.where(odd).select(F.regexp_extract("value", r"^\s*(\S*)", 1).alias("chromosome"), F.lit("uneven lines").alias("fault"))


def genome_size(raw: DataFrame) -> DataFrame:
    return raw.where(~F.col("value").startswith(">")).agg(F.sum(F.length(F.trim("value"))).alias("genome_size"))


def tiles(chromosomes: DataFrame, tile: int = TILE, overlap: int = OVERLAP) -> DataFrame:
    """Overlapping pieces of the chromosomes: any stretch of up to `overlap` bases lies in the tile that it starts in."""
    n = F.length("sequence")
    own = chromosomes.where(n > 0).withColumn("length", n).withColumn("tile", F.explode(F.sequence(F.lit(0), ((n - 1) / tile).cast("int"))))
    return own.select("chromosome", "length", "tile", F.substring("sequence", F.col("tile") * tile + 1, F.lit(tile + overlap)).alias("seq"))


def alias_key(chromosome: Column) -> Column:
    """Chromosome names with and without chr in front meet under this key."""
    return F.regexp_replace(chromosome, "^chr", "")


def fetch(regions: DataFrame, genome_tiles: DataFrame, first: str = "first", last: str = "last", tile: int = TILE, alias: bool = True) -> DataFrame:
    """regions (chromosome, first, last: 0-based, half-open) with `piece` and the chromosome's `length`; null where there is none.

    One equi-join on chromosome and tile; the exact name wins over the one with or without chr."""
    key = alias_key if alias else (lambda c: c)
    own = genome_tiles.select(key(F.col("chromosome")).alias("t_key"), F.col("chromosome").alias("t_chromosome"), F.col("length").alias("t_length"), F.col("tile").alias("t_tile"), "seq")
    asked = regions.withColumn("_row", F.monotonically_increasing_id()) if "_row" not in regions.columns else regions
    left = asked.withColumn("_tile", F.floor(F.greatest(F.col(first), F.lit(0)) / tile).cast("int")).withColumn("_key", key(F.col("chromosome")))
    got = left.join(own, (F.col("_key") == F.col("t_key")) & (F.col("_tile") == F.col("t_tile")), "left")
    a = F.greatest(F.col(first), F.lit(0))
    piece = F.substring("seq", (a - F.col("t_tile") * tile + 1).cast("int"), F.greatest(F.lit(0), F.least(F.col(last), F.col("t_length")) - a).cast("int"))
    return got.withColumn("piece", piece).withColumnRenamed("t_length", "length").drop("_tile", "_key", "t_key", "t_chromosome", "t_tile", "seq", "_row")


def sample_identity(path: Column, base: str = "") -> list[Column]:
    """sample_attribute, sample and sample_id of a path relative to the base folder: its first folder, its own folder (of a rerun
    the one above), the path. A file of the base folder itself has the attribute `sample` and that folder's name."""
    parts = F.split(path, "/")
    n = F.size(parts)
    own = F.when(n > 1, F.get(parts, n - 2)).otherwise(F.lit(base))
    own = F.when((n > 2) & own.contains(RERUN), F.get(parts, n - 3)).otherwise(own)
    return [F.when(n > 1, parts[0]).otherwise(F.lit("sample")).alias("sample_attribute"), own.alias("sample"), path.alias("sample_id")]


#: Folders of repeated runs have this in their name; their parent names the sample.
RERUN = "_rerun"


def missing(c: Column) -> Column:
    return F.when(c.isin(*NA_TOKENS), F.lit(None)).otherwise(c)


def _lines(spark: SparkSession, base: str, pattern: str) -> DataFrame:
    """(file, block, row, value): lines of the text files under a folder that hold anything, with their file's path as Spark encodes it."""
    own = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(base)
    return own.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value").where("value != ''")


def _real(path: str) -> str:
    """Where a path of a local file system leads; of other stores the path."""
    return f"file:{os.path.realpath(path.removeprefix('file:'))}" if path.startswith("file:") else path


def site_headers(spark: SparkSession, base: str, pattern: str = "*apa_sites.txt") -> DataFrame:
    """(file, path, head, names, lack, unified, kept) of each site table under a folder: its own header, the columns that it lacks, whether it is the result of a
    unification, and whether it is an input: no such result, and the first of the paths that lead to one file. What is known of a path is made once a file, not a line."""
    # Strings in buffers make Spark sort all lines by file, unless an aggregate beside them keeps objects: then it hashes, and this one keeps nothing.
    hashed = F.size(F.collect_set(F.lit(None).cast("int")))
    first = _lines(spark, base, pattern).where("block = 0").groupBy("file").agg(F.min_by("value", "row").alias("head"), hashed.alias("_hashed")).where("_hashed = 0")
    first = first.select("file", F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("path"), "head")
    names = F.transform(F.split(F.regexp_replace("head", "^\ufeff", ""), "\t"), lambda c: F.regexp_replace(c, '^"(.*)"$', "$1"))
    own = first.withColumn("names", names).withColumn("unified", F.array_contains("names", "unified_ID") & F.array_contains("names", "original_site_position"))
    own = own.withColumn("lack", F.array_sort(F.array_except(F.array(*[F.lit(c) for c in PAS_COLUMNS]), "names"))).withColumn("real", F.udf(_real, "string")("path"))
    leads = own.groupBy("real").agg(F.min(F.split("path", "/")).alias("least"))
    own = own.join(leads, "real").withColumn("kept", ~F.col("unified") & (F.split("path", "/") == F.col("least")))
    return own.select("file", "path", "head", "names", "lack", "unified", "kept")


def pas_files(spark: SparkSession, base: str, pattern: str = "*apa_sites.txt") -> DataFrame:
    """Site tables under a folder, all columns as text, with what their path says of the sample and the order of rows.

    Each table's columns are found by its own header, so tables may order them differently and have further ones. A table that is the result of a unification and
    a second path to one file are left out; a table that lacks a column, a row with more fields than its header, and a folder without tables are errors. A row
    with fewer fields lacks the last ones. A line equal to its table's header is a header wherever it stands. Headers are a row a file, lines are read twice."""
    heads = staged(site_headers(spark, base, pattern), "headers").where("kept")
    if faults := heads.where(F.size("lack") > 0).orderBy("path").limit(5).collect():
        raise ValueError("missing columns: " + "; ".join(f"{r['path']}: {', '.join(r['lack'])}" for r in faults))
    width = heads.agg(F.max(F.size("names"))).first()[0]
    if width is None:
        raise ValueError(f"no site tables under {base}; unified tables are none")
    inside = F.regexp_replace("path", "^.*?\\Q" + base.split(":", 1)[-1].strip("/") + "\\E/+", "")
    places = F.struct(*[(F.array_position("names", c) - 1).cast("int").alias(c) for c in PAS_COLUMNS])
    heads = heads.withColumn("_path", inside).select("file", "path", "head", F.size("names").alias("n"), places.alias("at"), F.split("path", "/").alias("steps"), *sample_identity(F.col("_path"), PurePosixPath(base).name))
    own = _lines(spark, base, pattern).join(heads, "file").where(F.col("value") != F.col("head"))
    # A column of its own, which is parsed once: each field of an expression would be parsed for itself.
    own = own.withColumn("parsed", F.from_csv("value", F.lit(", ".join(f"_{i} string" for i in range(width + 1))), {"sep": "\t", "escape": '"'}))
    own = own.withColumn("cells", F.array(*[F.col(f"parsed._{i}") for i in range(width + 1)]))
    own = own.withColumn("cells", F.when(F.exists(F.slice("cells", F.col("n") + 1, F.lit(width + 1)), lambda c: c.isNotNull()), F.raise_error(F.concat(F.lit("more fields than columns: "), "path"))).otherwise(F.col("cells")))
    order = F.struct(F.col("steps").alias("file"), "block", "row")
    return own.select(*[missing(F.get("cells", F.col(f"at.{c}"))).alias(c) for c in PAS_COLUMNS], order.alias("ingest_seq"), "sample_attribute", "sample", "sample_id")


def read_unified(spark: SparkSession, path: str) -> DataFrame:
    """A detailed table of a unification; a row with other than the header's fields ends the job."""
    head = spark.read.option("sep", "\t").option("header", True).csv(path)
    need = {"cluster_key", "chromosome", "strand", "original_site_position", "mode_site_position"} - set(head.columns)
    if need or not {"sample_id", "sample"} & set(head.columns):
        raise ValueError(f"missing columns: {sorted(need) or 'sample_id'}")
    own = spark.read.option("sep", "\t").option("header", True).option("mode", "FAILFAST").schema(head.schema).csv(path)
    return own.withColumns({c: F.col(c).cast("int") for c in ("original_site_position", "mode_site_position")})


def motif_families(table: DataFrame) -> dict[str, list[str]]:
    """Auxiliary families in the table's order (motif_dna, motif_family and a row number, at most some hundred rows)."""
    names = {"UAG-containing": "UAG", "GUA-containing": "GUA", "GUA-UAG-containing": "GUA_UAG"}
    out: dict[str, list[str]] = {n: [] for n in names.values()}
    for r in table.orderBy("row").collect():
        family = (r["motif_family"] or "").strip()
        if family not in names:
            raise ValueError(f"unknown motif family: {family}")
        if (r["motif_dna"] or "").strip():
            out[names[family]].append(r["motif_dna"].strip().upper())
    if empty := [k for k, v in out.items() if not v]:
        raise ValueError(f"empty motif families: {empty}")
    return out


def species_key(path: str) -> str:
    """The species that a unified table's name or folder says."""
    p = PurePosixPath(path)
    for end in ("_dp_segment_unified_apa_sites", "_unified_apa_sites"):
        if p.suffix in (".txt", ".tsv") and p.stem.endswith(end):
            return "_".join(p.stem.removesuffix(end).split())
    return "_".join(p.parent.name.split())


def species_models(table: DataFrame) -> DataFrame:
    """species_key to motif model; only supported groups are assessed. Repeated or empty keys are an error."""
    supported = (F.trim("model_status") == "reference_supported") & F.trim("motif_model_group").isin("MAMMALIAN", "LAND_PLANT", "BUDDING_YEAST", "FISSION_YEAST")
    own = table.select(F.trim("species_key").alias("species_key"), F.when(supported, F.trim("motif_model_group")).otherwise("NOT_ASSESSED").alias("model"))
    own = own.groupBy("species_key").agg(F.first("model").alias("model"), F.count(F.lit(1)).alias("n"))
    fault = F.when(F.col("species_key") == "", F.raise_error(F.lit("empty species key"))).when(F.col("n") > 1, F.raise_error(F.concat(F.lit("repeated species: "), "species_key"))).otherwise(F.col("model"))
    return own.select("species_key", fault.alias("model"))
