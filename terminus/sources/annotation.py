"""Gene annotation as text lines: GTF and GFF3 to transcript models.

Lines come as (line_no, value); the number carries the file's order, on which the rules for repeated attributes depend.
A model is (file_ord, transcript_id, gene_name, chromosome, strand, exons, ncbi_gene_id, transcript_biotype, reference_gene_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terminus.staging import staged

# Prefixes of identifiers that are not part of a transcript's name; features above and beside transcripts.
ID_PREFIX = "^(transcript:|rna-|rna:|mrna:|mRNA:)"
GENE_FEATURES = ("gene", "pseudogene")
NO_TRANSCRIPTS = (
    "cds", "intron", "five_prime_utr", "three_prime_utr", "start_codon", "stop_codon", "region", "match", "cdna_match",
    "protein_match", "nucleotide_match", "sequence_feature", "repeat_region", "origin_of_replication",
)
LINEAGE = 5
MODEL = ["file_ord", "transcript_id", "gene_name", "chromosome", "strand", "exons", "ncbi_gene_id", "transcript_biotype", "reference_gene_id"]


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their order: the block of the file and the row in it, so files split over many tasks."""
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select(order.alias("line_no"), "value").where(F.trim("value") != "")


def _fields(raw: DataFrame) -> DataFrame:
    own = raw.where(~F.col("value").startswith("#") & (F.trim("value") != "")).withColumn("f", F.split(F.trim("value"), "\t"))
    own = own.where(F.size("f") == 9)
    return own.select(
        "line_no",
        F.get("f", F.lit(0)).alias("seqname"),
        F.get("f", F.lit(2)).alias("feature"),
        F.expr("try_cast(get(f, 3) AS INT)").alias("start"),
        F.expr("try_cast(get(f, 4) AS INT)").alias("end"),
        F.get("f", F.lit(6)).alias("strand"),
        F.get("f", F.lit(8)).alias("attributes"),
    ).where("start IS NOT NULL AND end IS NOT NULL AND start <= end")


def _last_wins(pairs: Column) -> Column:
    """A map of (key, value) structs in which the last value of a key stays."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"])))


def gtf_attributes(text: Column) -> Column:
    """Map of the quoted attributes. A reference to a gene database becomes ncbi_gene_id; other references are dropped."""
    items = F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: x.contains(' "') & x.endswith('"'))
    pairs = F.transform(items, lambda x: F.struct(F.substring_index(x, ' "', 1).alias("k"), F.regexp_replace(F.substring(x, F.locate(' "', x) + 2, F.length(x)), '"+$', "").alias("v")))
    gene = F.filter(pairs, lambda p: (p["k"] == "db_xref") & p["v"].startswith("GeneID:"))
    rest = F.filter(pairs, lambda p: p["k"] != "db_xref")
    named = F.transform(gene, lambda p: F.struct(F.lit("ncbi_gene_id").alias("k"), F.substring(p["v"], 8, 1_000_000).alias("v")))
    return _last_wins(F.concat(rest, named))


def gtf_attribute(text: Column, name: str) -> Column:
    """One attribute of `gtf_attributes`, null where it is missing or empty: a single regular expression that ends at the last item of that name, where a map of
    all items is made by functions over arrays."""
    last = lambda begin: r'(?s)\A(?:.*;)? *' + begin + r'([^;]*?)"*(?<=") *(?:;|\z)'
    value = F.regexp_extract(text, last(f'{name} "'), 1)
    if name == "ncbi_gene_id":
        gene = last('db_xref "GeneID:')
        value = F.when(text.rlike(gene), F.regexp_extract(text, gene, 1)).otherwise(value)
    return blank(value)


def gff_attributes(text: Column) -> Column:
    """Map of key=value attributes, percent-decoded; a plus stays a plus."""
    items = F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: x.contains("="))
    decode = lambda v: F.try_url_decode(F.replace(v, F.lit("+"), F.lit("%2B")))
    pairs = F.transform(items, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("k"), decode(F.trim(F.substring(x, F.locate("=", x) + 1, F.length(x)))).alias("v")))
    return _last_wins(pairs)


def blank(c: Column) -> Column:
    return F.when(c == "", F.lit(None)).otherwise(c)


def _models(meta: DataFrame, exons: DataFrame) -> DataFrame:
    """Join metadata to exons grouped by transcript; transcripts without exons are dropped."""
    grouped = exons.groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("exons"))
    return meta.join(grouped, "transcript_id").select(*MODEL)


def gtf_models(raw: DataFrame) -> DataFrame:
    """Models of GTF lines. A transcript row sets chromosome and strand; of each attribute the first non-empty value of exon
    rows stands unless a transcript row has one, of which the last non-empty counts. Repeated exon rows stay; transcripts without exons are dropped. Lines are
    read once."""
    own = _fields(raw).where(F.col("feature").isin("transcript", "mRNA", "exon"))
    get = lambda k: gtf_attribute(F.col("attributes"), k)
    own = own.select(
        "line_no", "seqname", "start", "end", "strand", (F.col("feature") != "exon").alias("top"), get("transcript_id").alias("transcript_id"),
        get("gene_name").alias("gene_name"), get("ncbi_gene_id").alias("ncbi_gene_id"), get("transcript_biotype").alias("transcript_biotype"), get("gene_id").alias("reference_gene_id"),
    ).where("transcript_id IS NOT NULL")
    pick = lambda c: F.coalesce(F.max_by(c, F.when(F.col("top") & F.col(c).isNotNull(), F.col("line_no"))), F.min_by(c, F.when(F.col(c).isNotNull(), F.col("line_no"))), F.lit("")).alias(c)
    place = lambda c, n: F.coalesce(F.max_by(c, F.when(F.col("top"), F.col("line_no"))), F.min_by(c, "line_no")).alias(n)
    named = F.col("gene_name").isNotNull()
    later = F.when(F.col("top"), F.coalesce("gene_name", "reference_gene_id")).otherwise(F.col("gene_name"))
    name = F.coalesce(
        F.max_by("gene_name", F.when(F.col("top") & named, F.col("line_no"))), F.min_by(F.coalesce("gene_name", "reference_gene_id"), "line_no"),
        F.min_by(later, F.when(later.isNotNull(), F.col("line_no"))), F.lit(""),
    )
    exons = F.array_sort(F.collect_list(F.when(~F.col("top"), F.struct("start", "end"))))
    own = own.groupBy("transcript_id").agg(F.min("line_no").alias("file_ord"), place("seqname", "chromosome"), place("strand", "strand"), name.alias("gene_name"), *[pick(c) for c in ("ncbi_gene_id", "transcript_biotype", "reference_gene_id")], exons.alias("exons"))
    return own.where(F.size("exons") > 0).select(*MODEL)


def clean_id(c: Column) -> Column:
    return F.regexp_replace(c, ID_PREFIX, "")


def ncbi_gene(a: str) -> Column:
    """Gene database number of a map of GFF3 attributes."""
    refs = F.coalesce(*[F.try_element_at(F.col(a), F.lit(k)) for k in ("Dbxref", "db_xref", "dbxref")], F.lit(""))
    hit = F.try_element_at(F.filter(F.transform(F.split(refs, ","), lambda x: F.trim(x)), lambda r: r.startswith("GeneID:")), F.lit(1))
    return F.coalesce(F.try_element_at(F.col(a), F.lit("ncbi_gene_id")), F.substring(hit, 8, 1_000_000), F.lit(""))


def gff_models(raw: DataFrame) -> DataFrame:
    """Models of GFF3 lines: any identified feature that an exon points to, with what its nearest gene at most LINEAGE levels up
    has. Parents are found by cleaned identifier first, by the raw one second; exons of several parents count for each."""
    own = _fields(raw).withColumn("a", gff_attributes(F.col("attributes"))).drop("attributes")
    own = staged(own, "features")  # parsed once for all joins below
    get = lambda k: F.coalesce(F.try_element_at("a", F.lit(k)), F.lit(""))
    own = own.withColumn("id", get("ID")).withColumn("parents", F.when(get("Parent") == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(get("Parent"), ","), lambda x: F.trim(x))))
    kind = F.lower("feature")
    last = Window.partitionBy("id").orderBy(F.desc("line_no"))
    genes = own.where(kind.isin(*GENE_FEATURES) & (F.col("id") != "")).withColumn("r", F.row_number().over(last)).where("r = 1")
    genes = genes.select(F.col("id").alias("gene"), F.coalesce(blank(get("Name")), F.col("id")).alias("g_name"), F.coalesce(blank(get("gene_id")), F.col("id")).alias("g_ref"), ncbi_gene("a").alias("g_ncbi"), F.coalesce(blank(get("biotype")), get("gene_biotype")).alias("g_biotype"))
    found = own.where(~kind.isin(*GENE_FEATURES, "exon", *NO_TRANSCRIPTS) & (F.col("id") != "")).withColumn("transcript_id", clean_id(F.col("id")))
    found = found.withColumn("r", F.row_number().over(Window.partitionBy("transcript_id").orderBy(F.desc("line_no")))).where("r = 1")
    exons = own.where(kind == "exon").select("line_no", "start", "end", F.explode("parents").alias("parent"))
    ids = found.select("transcript_id", F.col("id").alias("raw_id"))
    by_clean = exons.withColumn("transcript_id", clean_id(F.col("parent"))).join(ids.select("transcript_id", F.lit(True).alias("ok")), "transcript_id", "left")
    by_raw = by_clean.where("ok IS NULL").drop("transcript_id", "ok").join(ids, F.col("parent") == F.col("raw_id")).select("line_no", "start", "end", "transcript_id")
    exons = by_clean.where("ok").select("line_no", "start", "end", "transcript_id").union(by_raw)
    # One level at a time: parents that are genes end a lineage, parents that are transcripts lead on.
    found = found.join(exons.select("transcript_id").distinct(), "transcript_id", "left_semi")
    front = found.select("transcript_id", F.posexplode("parents").alias("place", "parent")).withColumn("order", F.array("place"))
    reached = None
    up = staged(found.select(F.col("transcript_id").alias("up"), F.col("parents").alias("more")), "lineage")
    for level in range(LINEAGE):
        if level > 1 and front.isEmpty():
            break
        hit = front.join(genes, F.col("parent") == F.col("gene")).select("transcript_id", F.struct(F.lit(level), "order").alias("at"), "gene")
        reached = hit if reached is None else reached.union(hit)
        front = front.join(up, clean_id(F.col("parent")) == F.col("up")).select("transcript_id", "order", F.posexplode("more").alias("place", "parent")).withColumn("order", F.concat("order", F.array("place")))
    lineage = reached.groupBy("transcript_id").agg(F.min_by("gene", "at").alias("gene")).join(genes, "gene")
    meta = found.join(lineage, "transcript_id", "left")
    g = lambda c: blank(F.coalesce(F.col(c), F.lit("")))
    first_parent = F.when(F.size("parents") == 1, F.col("parents")[0])
    meta = meta.select(
        F.col("line_no").alias("file_ord"), "transcript_id", F.col("seqname").alias("chromosome"), "strand",
        F.coalesce(g("g_name"), blank(get("Name")), blank(get("gene")), F.col("id")).alias("gene_name"),
        F.coalesce(blank(ncbi_gene("a")), g("g_ncbi"), F.lit("")).alias("ncbi_gene_id"),
        F.coalesce(blank(get("biotype")), blank(get("transcript_biotype")), g("g_biotype"), F.lit("")).alias("transcript_biotype"),
        F.coalesce(blank(get("gene_id")), g("g_ref"), first_parent, F.lit("")).alias("reference_gene_id"),
    )
    return _models(meta, exons)


def models(spark: SparkSession, path: str) -> DataFrame:
    """Models of a file by its extension; a file without any is an error."""
    low = path.lower()
    found = (gff_models if low.endswith((".gff", ".gff3")) else gtf_models)(lines(spark, path))
    if found.isEmpty():
        raise ValueError(f"no transcript model in {path}")
    return found


def derived(m: DataFrame) -> DataFrame:
    """A model's span, intron chain and gene identifier."""
    flat = F.flatten(F.transform("exons", lambda e: F.array(e["start"], e["end"])))
    return m.select(
        "*",
        (F.size("exons") > 1).alias("is_multi_exon"),
        F.col("exons")[0]["start"].alias("tx_start"),
        F.element_at("exons", -1)["end"].alias("tx_end"),
        F.when(F.size("exons") > 1, F.slice(flat, 2, F.size(flat) - 2)).alias("junctions"),
        F.coalesce(blank(F.col("ncbi_gene_id")), F.col("reference_gene_id")).alias("gene_id"),
    )


def chain_index(m: DataFrame) -> DataFrame:
    """Intron chain per chromosome to transcript; of models with one chain the last in the file stays, on either strand."""
    own = derived(m).where("is_multi_exon")
    return own.groupBy("chromosome", "junctions").agg(F.max_by(F.struct("transcript_id", "strand", "tx_start", "tx_end"), "file_ord").alias("m")).select("chromosome", "junctions", "m.*")


def single_index(m: DataFrame) -> DataFrame:
    return derived(m).where("NOT is_multi_exon").select("chromosome", "strand", "tx_start", "tx_end", "transcript_id")


def terminal_exons(m: DataFrame) -> DataFrame:
    """Last exon in transcript direction of every model with several."""
    e = F.element_at("exons", F.when(F.col("strand") == "+", -1).otherwise(1))
    return derived(m).where("is_multi_exon").select("chromosome", "strand", "transcript_id", e["start"].alias("ex_start"), e["end"].alias("ex_end"))


def bed12(m: DataFrame) -> DataFrame:
    """The models as lines of twelve columns, in order of chromosome, start and name."""
    own = derived(m).withColumn("s", F.col("tx_start") - 1)
    sizes = F.concat(F.array_join(F.transform("exons", lambda e: (e["end"] - e["start"] + 1).cast("string")), ","), F.lit(","))
    starts = F.concat(F.array_join(F.transform("exons", lambda e: (e["start"] - 1 - F.col("s")).cast("string")), ","), F.lit(","))
    return own.orderBy("chromosome", "tx_start", "transcript_id").select(
        F.concat_ws("\t", "chromosome", F.col("s").cast("string"), F.col("tx_end").cast("string"), "transcript_id", F.lit("0"), "strand", F.col("s").cast("string"), F.col("tx_end").cast("string"), F.lit("0"), F.size("exons").cast("string"), sizes, starts).alias("line")
    )
