"""The three commands over text files: call sites of a sample, unify samples, annotate a catalogue."""

from __future__ import annotations

import argparse
import math
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terminus import sinks
from terminus.functions.sequence import reverse_complement
from terminus.operators import annotate, assign, sites, unify
from terminus.sources import annotation, tables


def downstream_of(site_rows: DataFrame, genome: DataFrame, width: int = 20) -> DataFrame:
    """Sites (chromosome, strand, site_position) with the bases after them in transcript direction, from tiles of exact names."""
    p, plus = F.col("site_position"), F.col("strand") == "+"
    own = site_rows.withColumn("first", F.when(plus, p).otherwise(F.greatest(F.lit(0), p - width - 1))).withColumn("last", F.when(plus, p + width).otherwise(F.greatest(F.lit(0), p - 1)))
    got = tables.fetch(own, genome, alias=False)
    return got.withColumn("downstream", F.when(plus, F.upper("piece")).otherwise(F.upper(reverse_complement(F.col("piece"))))).drop("first", "last", "piece", "length")


def call(spark: SparkSession, gtf: str, fasta: str, sam: list[tuple[str, str]], output: str, prefix: str = "polyA", splice_strand: str | None = None, min_mapq: int = 1, min_overlap: float = 0.5, min_reads: int = 10, filter_priming: bool = True, priming_window: int = 20, priming_threshold: float = 0.5, **calling) -> dict[str, str]:
    """sam: (path of alignments as text, platform label). Returns the paths of what was written.

    Read ends are kept in the output folder and used again if inputs and settings are the same."""
    identity = {"gtf": gtf, "sam": sam, "splice_strand": splice_strand, "min_mapq": min_mapq, "min_overlap": min_overlap}
    m = annotation.derived(annotation.models(spark, gtf))
    ends = sinks.load_cache(spark, f"{output}/{prefix}.cache", identity)
    if ends is None:
        labels = spark.createDataFrame(sam, "path string, label string").select("path", tables.platform(F.col("label")).alias("platform"))
        known = {r["path"]: (splice_strand or r["splice_strand"]) for r in labels.join(tables.profiles(spark), "platform").collect()}  # a row for each input file
        reads = None
        for i, (path, _) in enumerate(sam):
            own = tables.sam(spark.read.text(path)).withColumn("oriented", F.lit(known[path] == "f")).withColumn("read_id", F.concat(F.lit(f"{i}:"), "read_id"))
            reads = own if reads is None else reads.unionByName(own)
        found = assign.assign(reads, annotation.chain_index(m.select(*MODEL)), annotation.single_index(m.select(*MODEL)), annotation.terminal_exons(m.select(*MODEL)), min_mapq, min_overlap)
        sinks.save_cache(found, f"{output}/{prefix}.cache", identity)
        ends = sinks.load_cache(spark, f"{output}/{prefix}.cache", identity)
    called = sites.call_sites(ends, min_reads, **calling)
    paths = {"bed": sinks.one_file(annotation.bed12(m.select(*MODEL)), f"{output}/{prefix}.bed")}
    if filter_priming:
        genome = tables.tiles(tables.fasta_files(spark, fasta), overlap=max(tables.OVERLAP, priming_window + 1))
        placed = called.join(m.select("transcript_id", "chromosome", "strand"), "transcript_id", "left")
        called, removed = sites.split_primed(sites.priming(downstream_of(placed, genome, priming_window), priming_threshold).drop("chromosome", "strand", "downstream"))
        paths["removed"] = sinks.sites(sinks.with_models(removed, m), f"{output}/{prefix}.internal_priming_removed.txt")
    paths["sites"] = sinks.sites(sinks.with_models(called, m), f"{output}/{prefix}.apa_sites.txt")
    paths["summary"] = sinks.report(sites.report(called), f"{output}/{prefix}.summary.txt")
    return paths


MODEL = ("file_ord", "transcript_id", "gene_name", "chromosome", "strand", "exons", "ncbi_gene_id", "transcript_biotype", "reference_gene_id")


def check_unify(o: dict) -> None:
    """Settings of a unification that make no sense are an error."""
    for name in ("penalty", "compactness", "strong_abundance"):
        if not math.isfinite(o[name]) or o[name] < 0:
            raise ValueError(f"{name} must be a finite number from 0")
    for name in ("max_cluster_width", "max_internal_gap", "min_observation_count", "min_supported_observations", "min_cluster_samples", "min_single_transcript_count", "min_multi_transcript_count", "min_supported_transcripts"):
        if o[name] < 1:
            raise ValueError(f"{name} must be 1 or more")
    if o["strong_abundance"] > 1:
        raise ValueError("strong_abundance is a share")
    if not o["pattern"] or o["pattern"].startswith("/") or ".." in PurePosixPath(o["pattern"]).parts:
        raise ValueError("pattern must stay in the folder")


def weights(a: float, b: float) -> tuple[float, float]:
    """Two weights that sum to 1."""
    if min(a, b) < 0 or not math.isfinite(a + b) or a + b == 0:
        raise ValueError("weights are finite, from 0, and not both 0")
    return a / (a + b), b / (a + b)


def unify_folder(spark: SparkSession, base: str, output: str, prefix: str | None = None, pattern: str = "*apa_sites.txt", biotypes: str = ",".join(unify.BIOTYPES), strategy: str = "observations", strong_count: int | str = 50, write_unfiltered: bool = False, skip_summary: bool = False, parts: bool = True, sample_weight: float = 0.7, count_weight: float = 0.3, mode_sample_weight: float = 0.8, mode_count_weight: float = 0.2, mode_support_window: int = 15, exclude_predicted: bool = False, keep_scaffolds: bool = False, keep_mitochondrial: bool = False, **options) -> dict[str, str]:
    """Catalogue of all samples under a folder; returns the paths of what was written, each a folder of parts or, without `parts`, a file that passes through the driver."""
    cut = {k: options.pop(k) for k in ("max_cluster_width", "max_internal_gap", "penalty", "compactness", "absorb") if k in options}
    check_unify(unify.FILTERS | unify.SEGMENT | {"pattern": pattern} | cut | options)
    sample_weight, count_weight = weights(sample_weight, count_weight)
    mode_sample_weight, mode_count_weight = weights(mode_sample_weight, mode_count_weight)
    if mode_support_window < 0:
        raise ValueError("mode_support_window must be 0 or more")
    representative = {"reach": mode_support_window, "mode_sample_weight": mode_sample_weight, "mode_count_weight": mode_count_weight}
    rows = unify.normalized(unify.strict(tables.pas_files(spark, base, pattern)))
    kept = tuple(b.strip() for b in biotypes.split(","))
    rows = rows.where(unify.drop_reason(kept, exclude_predicted, keep_scaffolds, keep_mitochondrial).isNull())
    out = unify.unify(rows, strategy, strong_count, segmentation=cut | {"sample_weight": sample_weight, "count_weight": count_weight}, representative=representative, **options)
    name = f"{output}/{prefix or PurePosixPath(base).name}"
    columns = ["transcript_id", "gene_id", "gene_name", "effective_gene_id", "chromosome", "strand", "cluster_key", "unified_ID", "original_site_position", "cluster_start", "cluster_end", "cluster_width", *unify.MODE, "n_unique_positions", "site_count", "transcript_biotype", "sample_attribute", "sample", "sample_id", "cluster_relative_abundance"]
    order = ("chromosome", "cluster_start", "cluster_end", "strand", "effective_gene_id", "original_site_position", "transcript_id", "sample_id")
    paths = {"sites": sinks.tsv(out["detailed"].orderBy(*order), f"{name}_unified_apa_sites.txt", columns, parts)}
    if not skip_summary:
        by = ("chromosome", "cluster_start", "cluster_end", "strand", "effective_gene_id")
        paths["summary"] = sinks.tsv(out["summary"].orderBy(*by), f"{name}_unified_apa_summary.txt", parts=parts)
        paths["filtered_out"] = sinks.tsv(out["filtered_out"].orderBy(*by), f"{name}_unified_apa_filtered_out.txt", parts=parts)
    if write_unfiltered:
        paths["unfiltered"] = sinks.tsv(out["unfiltered"].orderBy(*order), f"{name}_unified_apa_sites.unfiltered.txt", columns, parts)
    return paths


def annotate_file(spark: SparkSession, unified: str, fasta: str, output: str, model: str | None = None, species: str | None = None, species_table: DataFrame | None = None, families: dict | None = None, parts: bool = True) -> str:
    """Annotated clusters of a detailed table, as a folder of parts or a file; the model is given or the species'."""
    sinks.guard(output, [unified, fasta])
    if model is None:
        key = species or tables.species_key(unified)
        found = tables.species_models(species_table).where(F.col("species_key") == key).collect() if species_table is not None else []
        if not found:
            raise ValueError(f"no motif model for species {key!r}")
        model = found[0]["model"]
    faults = tables.fasta_faults(tables.fasta_files(spark, fasta)).unionByName(tables.wrapping_faults(spark, fasta)).limit(5).collect()
    if faults:
        raise ValueError(f"faulty sequences: {[tuple(f) for f in faults]}")
    out = annotate.annotate(tables.read_unified(spark, unified), tables.tiles(tables.fasta_files(spark, fasta)), model, families)
    return sinks.tsv(out.orderBy("chromosome", "cluster_start", "cluster_key"), output, parts=parts)


def main(argv: list[str] | None = None) -> int:
    from terminus.session import session

    top = argparse.ArgumentParser(prog="terminus")
    sub = top.add_subparsers(dest="command", required=True)
    c = sub.add_parser("call")
    c.add_argument("-g", "--gtf", required=True)
    c.add_argument("-f", "--fasta", required=True)
    c.add_argument("-i", "--input", required=True, help="manifest of alignment files")
    c.add_argument("-o", "--output", default="results")
    c.add_argument("-p", "--prefix", default="polyA")
    c.add_argument("--splice-strand", choices=("f", "b"))
    c.add_argument("--min-mapq", type=int, default=1)
    c.add_argument("--min-overlap", type=float, default=0.5)
    c.add_argument("--min-reads", type=int, default=10)
    c.add_argument("--no-filter-priming", action="store_true")
    c.add_argument("--priming-window", type=int, default=20)
    c.add_argument("--priming-a-threshold", type=float, default=0.5)
    for name, kind in (("min-cluster-size", int), ("max-k", int), ("min-distance", int), ("min-relative-dominance", float), ("min-sharpness", float)):
        c.add_argument(f"--{name}", type=kind, default=sites.DEFAULTS[name.replace("-", "_")])
    u = sub.add_parser("unify")
    u.add_argument("base")
    u.add_argument("-o", "--output", required=True)
    u.add_argument("-p", "--prefix")
    u.add_argument("--pattern", default="*apa_sites.txt")
    u.add_argument("--strategy", choices=("observations", "transcript-totals", "none"), default="observations")
    u.add_argument("--strong-count", default="50")
    u.add_argument("--biotypes", default=",".join(unify.BIOTYPES))
    for name in ("write-unfiltered", "skip-summary", "exclude-predicted", "keep-scaffolds", "keep-mitochondrial"):
        u.add_argument(f"--{name}", action="store_true")
    for name, value in (unify.SEGMENT | unify.FILTERS).items():
        if name not in ("absorb", "strong_count"):
            u.add_argument(f"--{name.replace('_', '-')}", type=type(value), default=value)
    for name, value in unify.WEIGHTS.items():
        u.add_argument(f"--{name.replace('_', '-')}", type=float, default=value)
    u.add_argument("--mode-support-window", type=int, default=15)
    u.add_argument("--one-file", dest="parts", action="store_false", help="one file for each table instead of a folder of parts")
    u.add_argument("--no-absorb", dest="absorb", action="store_false")
    a = sub.add_parser("annotate")
    a.add_argument("--unified", required=True)
    a.add_argument("--fasta", required=True)
    a.add_argument("--output", required=True)
    a.add_argument("--model", choices=annotate.MODELS)
    a.add_argument("--species")
    a.add_argument("--one-file", dest="parts", action="store_false", help="one file instead of a folder of parts")
    a.add_argument("--species-table")
    o = vars(top.parse_args(argv))
    command = o.pop("command")
    spark = session()
    if command == "call":
        path = o.pop("input")
        text = "\n".join(r.value for r in spark.read.text(path).collect())  # one line for each input file
        o["sam"] = tables.manifest(text, str(PurePosixPath(path).parent), lambda p: sinks.exists(spark, p))
        o["filter_priming"] = not o.pop("no_filter_priming")
        o["priming_threshold"] = o.pop("priming_a_threshold")
        print(call(spark, **o))
    elif command == "unify":
        o["strong_count"] = unify.resolve_cutoff(o["strong_count"], 1) if o["strong_count"] != "auto" else "auto"
        print(unify_folder(spark, **o))
    else:
        table = o.pop("species_table")
        o["species_table"] = spark.read.option("sep", "\t").option("header", True).csv(table) if table else None
        print(annotate_file(spark, **o))
    return 0
