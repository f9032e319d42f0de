"""All queries of the library by name, with the DuckDB SQL that gives the same rows.

Names begin with the operator's handle in the inventory. Queries run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terminus.functions import cigar, numeric, sequence
from terminus.operators import annotate, assign, sites, unify
from terminus.plans import bindings as B
from terminus.sources import annotation, tables
from terminus.staging import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "AGG18_cluster_summary"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def r4(x: str) -> str:
    return f"round_even(({x}) * 1e4::DOUBLE, 0) / 1e4::DOUBLE"


# ---- sources ----

_GTF_WANT = f"""WITH g AS (SELECT *, p_partkey % 11 <> 0 AS top FROM part), e AS (SELECT p_partkey, string_agg(concat(p_partkey * 10 + k * 100, '-', p_partkey * 10 + k * 100 + p_size), ',' ORDER BY k) AS exons FROM part, range(0, 4) r(k) WHERE k <= p_partkey % 4 GROUP BY 1)
SELECT concat('M', p_partkey) AS transcript_id, CASE WHEN top AND p_size % 3 = 0 THEN p_name ELSE concat('G', p_partkey % 50) END AS gene_name, concat('c', p_size % 5) AS chromosome, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, exons,
 CASE WHEN top THEN concat(p_size, '') ELSE '' END AS ncbi_gene_id, CASE WHEN p_size % 2 = 0 THEN 'mRNA' ELSE '' END AS transcript_biotype, concat('G', p_partkey % 50) AS reference_gene_id FROM g JOIN e USING (p_partkey)"""


def _flat_exons(m: DataFrame) -> DataFrame:
    return m.drop("file_ord").withColumn("exons", F.array_join(F.transform("exons", lambda e: F.concat_ws("-", e["start"].cast("string"), e["end"].cast("string"))), ","))


@query("SRC05_gtf_models", _GTF_WANT)
def src05(spark, sf):
    return _flat_exons(annotation.gtf_models(B.gtf_lines(spark, sf)))


@query("SRC06_gtf_attributes", "SELECT k.line_no, k.gene_id, k.transcript_id, k.ncbi_gene_id FROM (SELECT p_partkey * 10 AS line_no, concat('G', p_partkey % 50) AS gene_id, concat('M', p_partkey) AS transcript_id, concat(p_size, '') AS ncbi_gene_id FROM part WHERE p_partkey % 11 <> 0 UNION ALL SELECT p_partkey * 10 + r.k + 1, concat('G', p_partkey % 50), concat('M', p_partkey), NULL FROM part, range(0, 4) r(k) WHERE r.k <= p_partkey % 4) k")
def src06(spark, sf):
    own = B.gtf_lines(spark, sf).where(~F.col("value").startswith("#")).withColumn("a", annotation.gtf_attributes(F.split("value", "\t")[8]))
    return own.select("line_no", *[F.try_element_at("a", F.lit(k)).alias(k) for k in ("gene_id", "transcript_id", "ncbi_gene_id")])


_GFF_WANT = """WITH e AS (SELECT p_partkey, string_agg(concat(p_partkey * 10 + k * 100, '-', p_partkey * 10 + k * 100 + p_size), ',' ORDER BY k) AS exons, concat(p_partkey * 10, '-', p_partkey * 10 + any_value(p_size)) AS one FROM part, range(0, 4) r(k) WHERE k <= p_partkey % 4 GROUP BY 1),
m AS (SELECT concat('M', p_partkey) AS transcript_id, exons, * EXCLUDE (exons) FROM part JOIN e USING (p_partkey) UNION ALL SELECT concat('sub', p_partkey), one, * EXCLUDE (exons) FROM part JOIN e USING (p_partkey))
SELECT transcript_id, concat('a;b+', p_size) AS gene_name, concat('c', p_size % 5) AS chromosome, '+' AS strand, exons, concat(p_size, '') AS ncbi_gene_id, 'mRNA' AS transcript_biotype, concat('gene-', p_partkey) AS reference_gene_id FROM m"""


@query("SRC07_gff3_models", _GFF_WANT)
def src07(spark, sf):
    return _flat_exons(annotation.gff_models(B.gff_lines(spark, sf)))


@query("REL07_gff3_gene_lineage", "SELECT concat('sub', p_partkey) AS transcript_id, concat('gene-', p_partkey) AS gene FROM part")
def rel07(spark, sf):
    m = annotation.gff_models(B.gff_lines(spark, sf))
    return m.where("transcript_id LIKE 'sub%'").select("transcript_id", F.col("reference_gene_id").alias("gene"))


@query("SRC08_gff3_attributes", "SELECT p_partkey * 10 AS line_no, concat('gene-', p_partkey) AS id, concat('a;b+', p_size) AS name, concat(p_size, '') AS ncbi_gene_id FROM part")
def src08(spark, sf):
    own = B.gff_lines(spark, sf).where(F.split("value", "\t")[2] == "gene").withColumn("a", annotation.gff_attributes(F.split("value", "\t")[8]))
    return own.select("line_no", F.try_element_at("a", F.lit("ID")).alias("id"), F.try_element_at("a", F.lit("Name")).alias("name"), annotation.ncbi_gene("a").alias("ncbi_gene_id"))


@query("SRC03_sam_scan", f"WITH {B.ALN} SELECT read_id, flag, rname, pos0, mapq, cigar, has_sa FROM aln")
def src03(spark, sf):
    a = B.alignments(spark, sf)
    line = F.concat_ws("\t", "read_id", F.col("flag").cast("string"), "rname", (F.col("pos0") + 1).cast("string"), F.col("mapq").cast("string"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"), F.when(F.col("has_sa"), "SA:Z:c1,1,+,5M,1,0;").otherwise("NM:i:0"))
    return tables.sam(a.select(line.alias("value")).union(spark.createDataFrame([("@HD\tVN:1.6",)], "value string")))


@query("SRC04_genome_size", f"WITH {B.DNA} SELECT CAST(sum(length(sequence)) AS BIGINT) AS genome_size FROM dna")
def src04(spark, sf):
    own = B.chromosomes(spark, sf)
    return tables.genome_size(own.select(F.explode(F.array(F.concat(F.lit(">"), "chromosome"), "sequence")).alias("value")))


@query("SRC12_region_fetch", f"WITH {B.DNA}, {B.POINTS} SELECT chromosome, k, substr(sequence, greatest(pos - 100, 0) + 1, least(pos + 100, length(sequence)) - greatest(pos - 100, 0)) AS piece, length(sequence) AS length FROM points")
def src12(spark, sf):
    own = B.points(spark, sf).select(F.regexp_replace("chromosome", "^chr", "").alias("chromosome"), "k", (F.col("pos") - 100).alias("first"), (F.col("pos") + 100).alias("last"))
    got = tables.fetch(own, tables.tiles(B.chromosomes(spark, sf)))
    return got.select(F.concat(F.lit("chr"), "chromosome").alias("chromosome"), "k", "piece", F.col("length").cast("long").alias("length"))


@query("SRC14_sample_identity", "SELECT DISTINCT concat('tissue/s', l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN '/x_rerun1' ELSE '' END, '/a.txt') AS sample_id, 'tissue' AS sample_attribute, concat('s', l_linenumber) AS sample FROM lineitem")
def src14(spark, sf):
    own = B.table(spark, sf, "lineitem").select(F.concat(F.lit("tissue/s"), F.col("l_linenumber").cast("string"), F.when(F.col("l_linenumber") % 2 == 0, "/x_rerun1").otherwise(""), F.lit("/a.txt")).alias("p")).distinct()
    return own.select(*tables.sample_identity(F.col("p")))


@query("SRC17_species_models", "SELECT n_name AS species_key, CASE WHEN n_regionkey % 2 = 0 AND n_nationkey % 5 < 4 THEN ['MAMMALIAN', 'LAND_PLANT', 'BUDDING_YEAST', 'FISSION_YEAST'][n_nationkey % 5 + 1] ELSE 'NOT_ASSESSED' END AS model FROM nation")
def src17(spark, sf):
    group = F.element_at(F.array(*map(F.lit, ("MAMMALIAN", "LAND_PLANT", "BUDDING_YEAST", "FISSION_YEAST", "ARTHROPOD"))), (F.col("n_nationkey") % 5 + 1).cast("int"))
    own = B.table(spark, sf, "nation").select(F.concat(F.lit(" "), "n_name").alias("species_key"), group.alias("motif_model_group"), F.when(F.col("n_regionkey") % 2 == 0, "reference_supported").otherwise("validation_required").alias("model_status"))
    return tables.species_models(own)


@query("REL15_species_lookup", "SELECT c_custkey, CASE WHEN n_regionkey % 2 = 0 AND n_nationkey % 5 < 4 THEN ['MAMMALIAN', 'LAND_PLANT', 'BUDDING_YEAST', 'FISSION_YEAST'][n_nationkey % 5 + 1] ELSE 'NOT_ASSESSED' END AS model FROM customer JOIN nation ON c_nationkey = n_nationkey")
def rel15(spark, sf):
    named = B.table(spark, sf, "customer").join(B.table(spark, sf, "nation").select("n_nationkey", F.trim("n_name").alias("species_key")), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.join(src17(spark, sf), "species_key").select("c_custkey", "model")


# ---- projections over models and alignments ----


@query("PRJ01_platform_labels", "SELECT DISTINCT l_linenumber, CASE l_linenumber WHEN 1 THEN 'drna' WHEN 2 THEN 'pacbio' WHEN 3 THEN 'pcr-cdna' ELSE 'unspecified' END AS platform FROM lineitem")
def prj01(spark, sf):
    label = F.element_at(F.array(F.lit(" dRNA"), F.lit("PacBio"), F.lit("pcr-cDNA "), F.lit("N/A"), F.lit("-"), F.lit(""), F.lit("Unknown")), F.col("l_linenumber"))
    return B.table(spark, sf, "lineitem").select("l_linenumber", tables.platform(label).alias("platform")).distinct()


@query("PRJ02_profiles", "SELECT DISTINCT l_linenumber, CASE l_linenumber WHEN 2 THEN 'splice:hq' ELSE 'splice' END AS preset, CASE WHEN l_linenumber % 2 = 0 THEN 'f' WHEN l_linenumber = 1 THEN 'f' ELSE 'b' END AS splice_strand, CASE l_linenumber WHEN 1 THEN 14 ELSE 15 END AS kmer, 500000 AS max_intron FROM lineitem")
def prj02(spark, sf):
    own = prj01(spark, sf).withColumn("override", F.when(F.col("l_linenumber") % 2 == 0, "f"))
    return own.join(F.broadcast(tables.profiles(spark)), "platform").select("l_linenumber", "preset", F.coalesce("override", "splice_strand").alias("splice_strand"), "kmer", "max_intron")


@query("PRJ03_junction_chain", f"WITH {B.ALN}, {B.LOCATED} SELECT read_id, CASE WHEN spliced THEN concat(junctions[1], ',', junctions[2]) END AS chain, end0 FROM located")
def prj03(spark, sf):
    own = B.alignments(spark, sf)
    chain = F.array_join(F.transform(cigar.junction_chain(F.col("cigar"), F.col("pos0")), lambda x: x.cast("string")), ",")
    return own.select("read_id", chain.alias("chain"), (F.col("pos0") + cigar.reference_length(F.col("cigar"))).alias("end0"))


@query("PRJ04_read_end", f"WITH {B.ALN}, {B.LOCATED} SELECT read_id, strand, CASE WHEN strand = '+' THEN end0 ELSE pos0 + 1 END AS read_end FROM located")
def prj04(spark, sf):
    return assign.located(B.alignments(spark, sf)).select("read_id", "strand", assign.read_end(F.col("strand")).alias("read_end"))


@query("PRJ05_model_columns", f"WITH {B.MODEL} SELECT transcript_id, multi AS is_multi_exon, pos0 + 1 AS tx_start, CASE WHEN multi THEN pos0 + n1 + n2 + width ELSE pos0 + width END AS tx_end, CASE WHEN multi THEN concat(pos0 + n1, ',', pos0 + n1 + n2 + 1) END AS junctions FROM model")
def prj05(spark, sf):
    own = annotation.derived(B.models(spark, sf))
    return own.select("transcript_id", "is_multi_exon", "tx_start", "tx_end", F.array_join(F.transform("junctions", lambda x: x.cast("string")), ",").alias("junctions"))


@query("SNK01_bed12_lines", f"WITH {B.MODEL} SELECT concat_ws(chr(9), chromosome, pos0, CASE WHEN multi THEN pos0 + n1 + n2 + width ELSE pos0 + width END, transcript_id, '0', strand, pos0, CASE WHEN multi THEN pos0 + n1 + n2 + width ELSE pos0 + width END, '0', CASE WHEN multi THEN 2 ELSE 1 END, CASE WHEN multi THEN concat(n1, ',', width, ',') ELSE concat(width, ',') END, CASE WHEN multi THEN concat('0,', n1 + n2, ',') ELSE '0,' END) AS line FROM model")
def snk01(spark, sf):
    return annotation.bed12(B.models(spark, sf))


@query("CTL05_terminal_exons", f"WITH {B.MODEL}, {B.TERMINAL} SELECT * FROM terminal")
def ctl05(spark, sf):
    return annotation.terminal_exons(B.models(spark, sf))


@query("AGG24_chain_index", f"WITH {B.MODEL}, {B.CHAINS} SELECT chromosome, concat(junctions[1], ',', junctions[2]) AS junctions, transcript_id, tx_strand AS strand FROM chains")
def agg24(spark, sf):
    own = annotation.chain_index(B.models(spark, sf))
    return own.select("chromosome", F.array_join(F.transform("junctions", lambda x: x.cast("string")), ",").alias("junctions"), "transcript_id", "strand")


@query("PRJ18_clean_ids", "SELECT p_partkey, concat(CASE p_partkey % 6 WHEN 5 THEN 'gene:' ELSE '' END, CASE p_partkey % 6 WHEN 4 THEN 'rna:' ELSE '' END, 'x', p_partkey) AS id FROM part")
def prj18(spark, sf):
    prefix = F.element_at(F.array(*map(F.lit, ("transcript:", "rna-", "rna:", "mRNA:", "mrna:rna:", "gene:"))), (F.col("p_partkey") % 6 + 1).cast("int"))
    return B.table(spark, sf, "part").select("p_partkey", annotation.clean_id(F.concat(prefix, F.lit("x"), F.col("p_partkey").cast("string"))).alias("id"))


# ---- assignment ----

_CLASS = "CASE WHEN flag & (4 | 256 | 2048) <> 0 THEN 'filtered_alignments' WHEN mapq < 1 THEN 'low_mapq' WHEN has_sa THEN 'sa_tagged_primary' ELSE 'accepted' END"


@query("FLT01_alignment_cascade", f"WITH {B.ALN} SELECT {_CLASS} AS class, count(*) AS n FROM aln GROUP BY 1")
def flt01(spark, sf):
    return B.alignments(spark, sf).groupBy(assign.alignment_class().alias("class")).agg(F.count(F.lit(1)).alias("n"))


_BASE = f"WITH {B.ALN}, {B.LOCATED}, {B.ACCEPTED}, {B.MODEL}, {B.CHAINS}, {B.SINGLES}, {B.TERMINAL}"
_CANDS = "cands AS (SELECT read_id, chromosome, pos0, end0, pos0 + 1 AS r_start, end0 AS r_end, s.s AS tx_strand FROM accepted, (VALUES ('+'), ('-')) s(s) WHERE NOT spliced AND (NOT oriented OR s.s = strand))"
_HITS = "hits AS (SELECT c.*, s.transcript_id, s.tx_start, s.tx_end, greatest(0, least(r_end, tx_end) - greatest(r_start, tx_start) + 1) AS shared, tx_end - tx_start + 1 AS size FROM cands c JOIN singles s ON c.chromosome = s.chromosome AND c.tx_strand = s.tx_strand AND r_start <= tx_end AND tx_start <= r_end)"
_BEST = "best AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY read_id, tx_strand ORDER BY shared::DOUBLE / size DESC, tx_start, tx_end, transcript_id) AS r FROM hits) WHERE r = 1 AND shared::DOUBLE / size >= 0.5)"
_ONE = "one AS (SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY read_id) AS n FROM best) WHERE n = 1)"
_FREE = "free AS (SELECT * FROM one o WHERE NOT EXISTS (SELECT 1 FROM cands c JOIN terminal t ON c.chromosome = t.chromosome AND c.tx_strand = t.strand WHERE c.read_id = o.read_id AND t.ex_start <= o.r_end AND o.r_start <= t.ex_end AND greatest(0, least(o.r_end, t.ex_end) - greatest(o.r_start, t.ex_start) + 1)::BIGINT * o.size >= o.shared::BIGINT * (t.ex_end - t.ex_start + 1)))"


def _reads(spark, sf):
    return assign.located(B.alignments(spark, sf).where(assign.alignment_class() == "accepted")).withColumn("chromosome", F.col("rname"))


@query("REL01_chain_lookup", f"{_BASE} SELECT read_id, transcript_id, tx_strand FROM accepted a LEFT JOIN chains c ON a.chromosome = c.chromosome AND a.junctions = c.junctions WHERE spliced")
def rel01(spark, sf):
    return assign.chain_lookup(_reads(spark, sf), annotation.chain_index(B.models(spark, sf))).select("read_id", "transcript_id", "tx_strand")


@query("REL02_best_overlap", f"{_BASE}, {_CANDS}, {_HITS}, {_BEST} SELECT read_id, tx_strand, transcript_id, shared, size FROM best")
def rel02(spark, sf):
    reads = _reads(spark, sf)
    best = assign.best_overlap(assign.candidates(assign.places(reads)), annotation.single_index(B.models(spark, sf)))
    return assign.of_reads(reads, best).select("read_id", "tx_strand", "transcript_id", "shared", "size")


@query("REL03_one_strand", f"{_BASE}, {_CANDS}, {_HITS}, {_BEST}, {_ONE} SELECT read_id, tx_strand, transcript_id FROM one")
def rel03(spark, sf):
    reads = _reads(spark, sf)
    one = assign.one_strand(assign.best_overlap(assign.candidates(assign.places(reads)), annotation.single_index(B.models(spark, sf))))
    return assign.of_reads(reads, one).select("read_id", "tx_strand", "transcript_id")


@query("REL04_terminal_exclusion", f"{_BASE}, {_CANDS}, {_HITS}, {_BEST}, {_ONE}, {_FREE} SELECT read_id, tx_strand, transcript_id FROM free")
def rel04(spark, sf):
    m, reads = B.models(spark, sf), _reads(spark, sf)
    c = assign.candidates(assign.places(reads))
    free = assign.not_terminal(assign.one_strand(assign.best_overlap(c, annotation.single_index(m))), annotation.terminal_exons(m), c)
    return assign.of_reads(reads, free).select("read_id", "tx_strand", "transcript_id")


_ASSIGNED = f"{_BASE}, {_CANDS}, {_HITS}, {_BEST}, {_ONE}, {_FREE}, assigned AS (SELECT transcript_id, CASE WHEN tx_strand = '+' THEN end0 ELSE pos0 + 1 END AS read_end FROM free UNION ALL SELECT c.transcript_id, CASE WHEN c.tx_strand = '+' THEN end0 ELSE pos0 + 1 END FROM accepted a JOIN chains c ON a.chromosome = c.chromosome AND a.junctions = c.junctions WHERE spliced)"


def _assigned(spark, sf):
    m = B.models(spark, sf)
    return assign.assign(B.alignments(spark, sf), annotation.chain_index(m), annotation.single_index(m), annotation.terminal_exons(m))


@query("ALG16_assignment", f"{_ASSIGNED} SELECT transcript_id, read_end, count(*) AS n FROM assigned GROUP BY ALL")
def alg16(spark, sf):
    return _assigned(spark, sf).groupBy("transcript_id", "read_end").agg(F.count(F.lit(1)).alias("n"))


@query("AGG01_collected_ends", f"{_ASSIGNED} SELECT transcript_id, string_agg(read_end, ',' ORDER BY read_end) AS ends FROM assigned GROUP BY 1")
def agg01(spark, sf):
    return _assigned(spark, sf).groupBy("transcript_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("read_end")), lambda x: x.cast("string")), ",").alias("ends"))


@query("AGG20_assignment_counters", f"""{_BASE}, {_CANDS}, {_HITS}, {_BEST}, {_ONE}, {_FREE}, s AS (SELECT CAST(count(*) FILTER (c.transcript_id IS NOT NULL) AS BIGINT) AS yes, CAST(count(*) FILTER (c.transcript_id IS NULL) AS BIGINT) AS no FROM accepted a LEFT JOIN chains c ON a.chromosome = c.chromosome AND a.junctions = c.junctions WHERE spliced)
SELECT (SELECT count(*) FROM aln) AS alignment_records, (SELECT count(*) FROM accepted) AS total_reads_processed, s.yes AS multi_exon_assigned, s.no AS multi_exon_no_match, (SELECT count(*) FROM free) AS single_exon_assigned, (SELECT count(*) FROM one) - (SELECT count(*) FROM free) AS single_exon_terminal_overlap,
 (SELECT count(DISTINCT read_id) FROM best) - (SELECT count(*) FROM one) AS single_exon_ambiguous_strand, (SELECT count(*) FROM accepted WHERE NOT spliced) - (SELECT count(DISTINCT read_id) FROM best) AS single_exon_no_overlap FROM s""")
def agg20(spark, sf):
    m = B.models(spark, sf)
    records, reads = B.alignments(spark, sf), _reads(spark, sf)
    own = staged(assign.places(reads).drop("junctions"), "places").withColumn("junctions", F.lit(None))
    c = assign.candidates(own)
    best = staged(assign.best_overlap(c, annotation.single_index(m)), "best")
    one = staged(assign.one_strand(best), "one")
    free = assign.not_terminal(one, annotation.terminal_exons(m), c)
    of_places = lambda df, name: df.select("read_id").distinct().join(own, "read_id").agg(F.coalesce(F.sum("n_reads"), F.lit(0)).alias(name))
    accepted = assign.alignment_class() == "accepted"
    spliced = assign.chain_lookup(reads, annotation.chain_index(m)).agg(F.count("transcript_id").alias("multi_exon_assigned"), F.count_if(F.col("transcript_id").isNull()).alias("multi_exon_no_match"))
    counts = records.agg(F.count(F.lit(1)).alias("alignment_records"), F.count_if(accepted).alias("total_reads_processed")).crossJoin(spliced)
    counts = counts.crossJoin(own.agg(F.coalesce(F.sum("n_reads"), F.lit(0)).alias("_single")))
    for part in (of_places(best, "_best"), of_places(one, "_one"), of_places(free, "single_exon_assigned")):  # a row each
        counts = counts.crossJoin(part)
    return counts.select("alignment_records", "total_reads_processed", "multi_exon_assigned", "multi_exon_no_match", "single_exon_assigned", (F.col("_one") - F.col("single_exon_assigned")).alias("single_exon_terminal_overlap"), (F.col("_best") - F.col("_one")).alias("single_exon_ambiguous_strand"), (F.col("_single") - F.col("_best")).alias("single_exon_no_overlap"))


# ---- sites of a transcript ----

_COUNTS = f"WITH {B.ENDS}, n AS (SELECT transcript_id, read_end, count(*) AS n FROM ends GROUP BY ALL), m AS (SELECT transcript_id, arg_min(read_end, (-n, read_end)) AS mode_position, max(n) AS mode_count, CAST(sum(n) AS BIGINT) AS n_reads FROM n GROUP BY 1)"


@query("AGG02_mode_smallest", f"{_COUNTS} SELECT * FROM m")
def agg02(spark, sf):
    return sites.modes(B.ends(spark, sf), "transcript_id")


@query("FLT02_min_reads", f"{_COUNTS} SELECT transcript_id, n_reads FROM m WHERE n_reads >= 30")
def flt02(spark, sf):
    return B.ends(spark, sf).groupBy("transcript_id").agg(F.count(F.lit(1)).alias("n_reads")).where("n_reads >= 30")


@query("FLT11_peak_sharpness", f"""{_COUNTS}, near AS (SELECT e.transcript_id, mode_position, read_end FROM ends e JOIN m USING (transcript_id) WHERE abs(read_end - mode_position) <= 300),
q AS (SELECT transcript_id, mode_position, count(*) AS n_near, 1 - (quantile_cont(read_end::DOUBLE, 0.75) - quantile_cont(read_end::DOUBLE, 0.25)) / 600 AS sharpness FROM near GROUP BY ALL)
SELECT transcript_id, mode_position, n_near, round(sharpness, 9) AS sharpness, n_near >= 5 AND sharpness >= 0.5 AS is_sharp FROM q""")
def flt11(spark, sf):
    return sites.sharpness(B.ends(spark, sf), min_distance=600, least=5).withColumn("sharpness", F.round("sharpness", 9))


@query("WIN04_near_reads", f"{_COUNTS} SELECT transcript_id, read_end, CAST(sum(n) OVER (PARTITION BY transcript_id ORDER BY read_end RANGE BETWEEN 25 PRECEDING AND 25 FOLLOWING) AS BIGINT) AS near FROM n")
def win04(spark, sf):
    n = B.ends(spark, sf).groupBy("transcript_id", "read_end").agg(F.count(F.lit(1)).alias("n"))
    return n.select("transcript_id", "read_end", F.sum("n").over(Window.partitionBy("transcript_id").orderBy("read_end").rangeBetween(-25, 25)).alias("near"))


_YEARS = f"WITH {B.ENDS}, s AS (SELECT transcript_id, read_end // 365 AS site_position, count(*) AS site_count FROM ends GROUP BY ALL), a AS (SELECT *, site_count / sum(site_count) OVER (PARTITION BY transcript_id) AS site_abundance, row_number() OVER (PARTITION BY transcript_id ORDER BY site_count DESC, site_position) AS site_rank FROM s)"


def _years(spark, sf):
    return sites.with_abundance(B.ends(spark, sf).groupBy("transcript_id", F.floor(F.col("read_end") / 365).cast("int").alias("site_position")).agg(F.count(F.lit(1)).alias("site_count")))


@query("AGG04_site_abundance", f"{_YEARS} SELECT transcript_id, site_position, site_count, {r4('site_abundance::DOUBLE')} AS site_abundance FROM a")
def agg04(spark, sf):
    return _years(spark, sf).select("transcript_id", "site_position", "site_count", numeric.round_even(F.col("site_abundance"), 4).alias("site_abundance"))


@query("WIN05_site_rank", f"{_YEARS} SELECT transcript_id, site_position, site_rank FROM a")
def win05(spark, sf):
    return _years(spark, sf).select("transcript_id", "site_position", "site_rank")


@query("AGG05_site_report", f"{_YEARS}, c AS (SELECT transcript_id, count(*) AS n_sites FROM a GROUP BY 1), h AS (SELECT n_sites, count(*) AS n_transcripts FROM c GROUP BY 1) SELECT n_sites, n_transcripts, CAST(sum(n_transcripts) OVER () AS BIGINT) AS total, CAST(sum(CASE WHEN n_sites > 1 THEN n_transcripts ELSE 0 END) OVER () AS BIGINT) AS several, {r4('100::DOUBLE * sum(CASE WHEN n_sites > 1 THEN n_transcripts ELSE 0 END) OVER () / sum(n_transcripts) OVER ()')} AS percent_several FROM h")
def agg05(spark, sf):
    return sites.report(_years(spark, sf)).withColumn("percent_several", numeric.round_even(F.col("percent_several"), 4))


@query("ALG01_mixture_sites")
def alg01(spark, sf):
    """Seeded mixtures choose the number of components; SQL has no such fit, tests hold it against a published example."""
    return sites.call_sites(B.ends(spark, sf))


# ---- internal priming ----

_DOWN = "down AS (SELECT chromosome, k, strand, CASE WHEN strand = '+' THEN substr(sequence, pos + 1, 20) ELSE reverse(translate(substr(sequence, greatest(0, pos - 21) + 1, greatest(0, pos - 1) - greatest(0, pos - 21)), 'ACGT', 'TGCA')) END AS d FROM points)"
_PRIMED = f"WITH {B.DNA}, {B.POINTS}, {_DOWN}, p AS (SELECT chromosome, k, CASE WHEN length(d) > 0 THEN (length(d) - length(replace(d, 'A', '')))::DOUBLE / length(d) ELSE 0 END AS share, contains(d, 'AAAAAA') AS has_run, row_number() OVER (PARTITION BY chromosome ORDER BY k) AS site_rank FROM down)"


def _primed(spark, sf):
    own = B.points(spark, sf).withColumn("downstream", sites.downstream(F.col("sequence"), F.col("pos"), F.col("strand"))).withColumn("site_rank", F.row_number().over(Window.partitionBy("chromosome").orderBy("k")))
    return sites.priming(own)


@query("FLT10_priming_metrics", f"{_PRIMED} SELECT chromosome, k, {r4('share')} AS a_content, has_run FROM p")
def flt10(spark, sf):
    return _primed(spark, sf).select("chromosome", "k", numeric.round_even(F.col("a_content"), 4).alias("a_content"), "has_run")


@query("ALG09_priming_filter", f"{_PRIMED} SELECT chromosome, k, site_rank > 1 AND (share > 0.5 OR has_run) AS is_removed FROM p")
def alg09(spark, sf):
    return _primed(spark, sf).select("chromosome", "k", "is_removed")


# ---- unification ----

_NUM = lambda c: f"(TRY_CAST({c} AS DOUBLE) IS NULL OR TRY_CAST({c} AS DOUBLE) <= 0 OR TRY_CAST({c} AS DOUBLE) % 1 <> 0)"
_FAULT = f"CASE WHEN {_NUM('site_position')} THEN 'site_position' WHEN {_NUM('site_count')} THEN 'site_count' WHEN strand NOT IN ('+', '-') THEN 'strand' WHEN trim(coalesce(chromosome, '')) = '' THEN 'chromosome' WHEN trim(coalesce(transcript_id, '')) = '' THEN 'transcript_id' END"
_NORM = f"raw2 AS (SELECT *, {_FAULT} AS fault FROM raw_rows), norm AS (SELECT * EXCLUDE (gene_id, gene_name, transcript_biotype), coalesce(gene_id, '') AS gene_id, coalesce(gene_name, '') AS gene_name, CASE coalesce(transcript_biotype, '') WHEN 'lnc_RNA' THEN 'lncRNA' ELSE coalesce(transcript_biotype, '') END AS transcript_biotype, CASE WHEN coalesce(gene_id, '') <> '' THEN gene_id ELSE coalesce(gene_name, '') END AS effective_gene_id FROM raw2 WHERE fault IS NULL)"


@query("FLT04_FLT05_row_faults", f"WITH {B.RAW} SELECT ingest_seq, {_FAULT} AS fault FROM raw_rows")
def flt04(spark, sf):
    return B.raw_rows(spark, sf).select("ingest_seq", unify.row_fault().alias("fault"))


def _normal(spark, sf):
    return unify.normalized(unify.strict(B.raw_rows(spark, sf).where(unify.row_fault().isNull())))


@query("PRJ07_PRJ08_normalized", f"WITH {B.RAW}, {_NORM} SELECT ingest_seq, transcript_biotype, effective_gene_id, TRY_CAST(site_position AS INT) AS site_position FROM norm WHERE effective_gene_id <> ''")
def prj07(spark, sf):
    return _normal(spark, sf).select("ingest_seq", "transcript_biotype", "effective_gene_id", "site_position")


@query("FLT06_FLT09_input_filters", f"WITH {B.RAW}, {_NORM} SELECT CASE WHEN transcript_biotype NOT IN ('mRNA', 'lncRNA', 'protein_coding', '') THEN 'biotype' WHEN starts_with(accession, 'XM_') THEN 'predicted' WHEN NOT starts_with(chromosome, 'NC_') THEN 'scaffold' WHEN chromosome IN ('NC_012920.1', 'NC_005089.1') THEN 'mitochondrial' ELSE 'kept' END AS reason, count(*) AS n FROM norm WHERE effective_gene_id <> '' GROUP BY 1")
def flt06(spark, sf):
    own = _normal(spark, sf).withColumn("transcript_id", F.col("accession"))
    return own.groupBy(F.coalesce(unify.drop_reason(exclude_predicted=True), F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("AGG22_sample_counts", f"WITH {B.PAS} SELECT sample_id, sample, count(*) AS n FROM pas GROUP BY ALL")
def agg22(spark, sf):
    return B.pas(spark, sf).groupBy("sample_id", "sample").agg(F.count(F.lit(1)).alias("n"))


_K = "chromosome, effective_gene_id, strand"
_EV = f"ev AS (SELECT {_K}, site_position, list_sort(list(DISTINCT sample_id)) AS samples, count(DISTINCT sample_id) AS n_samples, sum(site_count) AS total_count FROM pas GROUP BY ALL)"
_GAP = f"g0 AS (SELECT *, CASE WHEN site_position - lag(site_position) OVER (PARTITION BY {_K} ORDER BY site_position) > 24 THEN 1 ELSE 0 END AS new FROM ev), gap AS (SELECT * EXCLUDE (new), CAST(sum(new) OVER (PARTITION BY {_K} ORDER BY site_position) AS BIGINT) AS cluster_number FROM g0)"
_LOCAL = f"local AS (SELECT *, CAST(len(list_distinct(flatten(list(samples) OVER w))) AS BIGINT) AS local_n_samples, sum(total_count) OVER w AS local_total_count FROM gap WINDOW w AS (PARTITION BY {_K}, cluster_number ORDER BY site_position RANGE BETWEEN 15 PRECEDING AND 15 FOLLOWING))"
#: The same local support by a join of positions with the samples near them, which ends sooner than lists over a window.
_NEARBY = f"""near AS (SELECT a.{_K.replace(', ', ', a.')}, a.cluster_number, a.site_position, CAST(count(DISTINCT s.sample) AS BIGINT) AS local_n_samples FROM gap a JOIN (SELECT {_K}, cluster_number, site_position AS at, unnest(samples) AS sample FROM gap) s
 ON a.chromosome = s.chromosome AND a.effective_gene_id = s.effective_gene_id AND a.strand = s.strand AND a.cluster_number = s.cluster_number AND s.at BETWEEN a.site_position - 15 AND a.site_position + 15 GROUP BY ALL),
local AS (SELECT gap.*, local_n_samples, sum(total_count) OVER (PARTITION BY {_K}, cluster_number ORDER BY site_position RANGE BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS local_total_count FROM gap JOIN near USING ({_K}, cluster_number, site_position))"""
_CW = f"(PARTITION BY {_K}, cluster_number)"
_MAP = f"""scored AS (SELECT *, 0.7::DOUBLE * local_n_samples / max(local_n_samples) OVER {_CW} + 0.3::DOUBLE * local_total_count / max(local_total_count) OVER {_CW} AS ls, 0.8::DOUBLE * n_samples / max(n_samples) OVER {_CW} + 0.2::DOUBLE * total_count / max(total_count) OVER {_CW} AS ms,
 -abs(site_position - sum(site_position * total_count) OVER {_CW} / sum(total_count) OVER {_CW}) AS away FROM local),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {_K}, cluster_number ORDER BY ms DESC, n_samples DESC, total_count DESC, ls DESC, local_n_samples DESC, local_total_count DESC, away DESC, site_position) AS r, min(site_position) OVER {_CW} AS cluster_start, max(site_position) OVER {_CW} AS cluster_end, count(*) OVER {_CW} AS n_unique_positions FROM scored),
head AS (SELECT {_K}, cluster_number, concat_ws('|', {_K}, cluster_number) AS cluster_key, concat(chromosome, ':', cluster_start, '-', cluster_end, ':', strand) AS unified_ID, cluster_start, cluster_end, cluster_end - cluster_start + 1 AS cluster_width, n_unique_positions, site_position AS mode_site_position, {r4('ms')} AS mode_score, local_n_samples AS mode_local_n_samples, local_total_count AS mode_local_total_site_count, n_samples AS mode_exact_n_samples, total_count AS mode_exact_total_site_count FROM ranked WHERE r = 1),
cmap AS (SELECT gap.site_position, head.* EXCLUDE (cluster_number) FROM gap JOIN head USING ({_K}, cluster_number))"""
_DET = f"""det0 AS (SELECT pas.*, c.* EXCLUDE ({_K}, site_position) FROM pas JOIN cmap c USING ({_K}, site_position)), det AS (SELECT * RENAME (site_position AS original_site_position), {r4('sum(site_count) OVER (PARTITION BY transcript_id, sample_id, cluster_key) / sum(site_count) OVER (PARTITION BY transcript_id, sample_id)')} AS prefilter FROM det0)"""
_ALL = f"WITH {B.PAS}, {_EV}, {_GAP}, {_LOCAL}, {_MAP}, {_DET}"


@query("AGG06_position_evidence", f"WITH {B.PAS}, {_EV} SELECT {_K}, site_position, array_to_string(samples, ',') AS samples, n_samples, total_count FROM ev")
def agg06(spark, sf):
    return unify.evidence(B.pas(spark, sf)).withColumn("samples", F.array_join("samples", ","))


@query("AGG09_dp_weights", f"WITH {B.PAS}, {_EV} SELECT {_K}, site_position, round(greatest(0.7::DOUBLE * n_samples / max(n_samples) OVER (PARTITION BY {_K}) + 0.3::DOUBLE * ln(1 + total_count) / max(ln(1 + total_count)) OVER (PARTITION BY {_K}), 1e-6), 9) AS dp_weight FROM ev")
def agg09(spark, sf):
    return unify.dp_weights(unify.evidence(B.pas(spark, sf))).select(*unify.JOIN_KEY, F.round("dp_weight", 9).alias("dp_weight"))


def _gaps(spark, sf):
    return unify.gap_clusters(unify.evidence(B.pas(spark, sf)))


@query("WIN02_gap_clusters", f"WITH {B.PAS}, {_EV}, {_GAP} SELECT {_K}, site_position, cluster_number FROM gap")
def win02(spark, sf):
    return _gaps(spark, sf).select(*unify.JOIN_KEY, "cluster_number")


@query("AGG07_interval_stats", f"WITH {B.PAS}, {_EV}, {_GAP} SELECT {_K}, cluster_number, CAST(len(list_distinct(flatten(list(samples)))) AS BIGINT) AS n_samples, sum(total_count) AS total_count FROM gap GROUP BY ALL")
def agg07(spark, sf):
    own = B.pas(spark, sf).join(_gaps(spark, sf).select(*unify.JOIN_KEY, "cluster_number"), unify.JOIN_KEY)
    return own.groupBy(*unify.GENE_KEY, "cluster_number").agg(F.count_distinct("sample_id").alias("n_samples"), F.sum("site_count").alias("total_count"))


@query("AGG08_local_support", f"WITH {B.PAS}, {_EV}, {_GAP}, {_LOCAL} SELECT {_K}, site_position, local_n_samples, local_total_count FROM local")
def agg08(spark, sf):
    return unify.local_support(_gaps(spark, sf)).select(*unify.JOIN_KEY, "local_n_samples", "local_total_count")


@query("ALG06_cluster_map", f"WITH {B.PAS}, {_EV}, {_GAP}, {_NEARBY}, {_MAP} SELECT {_K}, site_position, cluster_key, unified_ID, cluster_start, cluster_end, cluster_width, n_unique_positions, mode_site_position, mode_score, mode_local_n_samples, mode_local_total_site_count, mode_exact_n_samples, mode_exact_total_site_count FROM cmap")
def alg06(spark, sf):
    return unify.cluster_map(_gaps(spark, sf))


def _detailed(spark, sf):
    return unify.shares(unify.placed(B.pas(spark, sf), _gaps(spark, sf)), "prefilter_cluster_relative_abundance")


@query("REL09_detailed_join", f"{_ALL} SELECT ingest_seq, cluster_key, original_site_position, mode_site_position FROM det")
def rel09(spark, sf):
    return _detailed(spark, sf).select("ingest_seq", "cluster_key", "original_site_position", "mode_site_position")


@query("AGG14_relative_abundance", f"{_ALL} SELECT DISTINCT transcript_id, sample_id, cluster_key, prefilter AS cluster_relative_abundance FROM det")
def agg14(spark, sf):
    return _detailed(spark, sf).select("transcript_id", "sample_id", "cluster_key", F.col("prefilter_cluster_relative_abundance").alias("cluster_relative_abundance")).distinct()


_REASON = "fewer_than_2_transcript_sample_observations_with_count_ge_30_and_max_observation_lt_50_or_relative_abundance_lt_0.25"
_OBS = f"""obs AS (SELECT cluster_key, transcript_id, sample_id, sum(site_count) AS n, max(prefilter) AS share FROM det GROUP BY ALL),
st AS (SELECT cluster_key, count(DISTINCT sample_id) AS n_samples, count(*) FILTER (n >= 30) AS sup, max(n) AS top, coalesce(max(share) FILTER (n >= 50), 0) AS ss FROM obs GROUP BY 1),
ver AS (SELECT cluster_key, n_samples >= 2 AND (sup >= 2 OR top >= 50 AND ss >= 0.25) AS filter_passed, CASE WHEN n_samples < 2 THEN '' WHEN sup >= 2 THEN 'supported_transcript_sample_observations' WHEN top >= 50 AND ss >= 0.25 THEN 'strong_single_transcript_sample_observation_with_abundance' ELSE '' END AS filter_pass_rule,
 CASE WHEN n_samples < 2 THEN 'n_samples_lt_2' WHEN NOT (sup >= 2 OR top >= 50 AND ss >= 0.25) THEN '{_REASON}' ELSE '' END AS filter_reason FROM st)"""
_RULES = {"min_observation_count": 30, "min_cluster_samples": 2}


@query("AGG15_observation_verdicts", f"{_ALL}, {_OBS} SELECT * FROM ver")
def agg15(spark, sf):
    return unify.observation_verdicts(_detailed(spark, sf), **_RULES)


@query("AGG16_transcript_verdicts", f"""{_ALL}, per AS (SELECT cluster_key, transcript_id, sum(site_count) AS n FROM det GROUP BY ALL), s AS (SELECT cluster_key, count(DISTINCT sample_id) AS n_samples FROM det GROUP BY 1), t AS (SELECT cluster_key, count(*) AS k, max(n) AS top, count(*) FILTER (n >= 40) AS sup FROM per GROUP BY 1),
u AS (SELECT *, CASE WHEN k = 1 THEN top >= 25 ELSE sup >= 2 END AS ok FROM t JOIN s USING (cluster_key))
SELECT cluster_key, n_samples >= 1 AND ok AS filter_passed, CASE WHEN NOT ok THEN '' WHEN k = 1 THEN 'single_transcript_count' ELSE 'multi_transcript_count' END AS filter_pass_rule, CASE WHEN ok THEN '' WHEN k = 1 THEN 'single_transcript_count_lt_25' ELSE 'fewer_than_2_transcripts_with_count_ge_40' END AS filter_reason FROM u""")
def agg16(spark, sf):
    return unify.transcript_verdicts(_detailed(spark, sf), min_single_transcript_count=25, min_multi_transcript_count=40)


@query("AGG17_no_filter", f"{_ALL} SELECT DISTINCT cluster_key, true AS filter_passed, 'no_filter' AS filter_pass_rule, '' AS filter_reason FROM det")
def agg17(spark, sf):
    return unify.no_filter(_detailed(spark, sf))


@query("REL13_passed_rows", f"{_ALL}, {_OBS} SELECT ingest_seq, cluster_key IN (SELECT cluster_key FROM ver WHERE filter_passed) AS passed FROM det")
def rel13(spark, sf):
    own = _detailed(spark, sf)
    ok = unify.observation_verdicts(own, **_RULES).where("filter_passed").select("cluster_key")
    return own.join(ok, "cluster_key", "left_semi").select("ingest_seq", F.lit(True).alias("passed")).union(own.join(ok, "cluster_key", "left_anti").select("ingest_seq", F.lit(False)))


_NEW = f"names AS (SELECT cluster_key, concat_ws('|', {_K}, row_number() OVER (PARTITION BY {_K} ORDER BY cluster_start, cluster_end, cluster_key)) AS new_key FROM (SELECT DISTINCT cluster_key, {_K}, cluster_start, cluster_end FROM det WHERE cluster_key IN (SELECT cluster_key FROM ver WHERE filter_passed)))"


@query("WIN01_renumbered", f"{_ALL}, {_OBS}, {_NEW} SELECT * FROM names")
def win01(spark, sf):
    own = _detailed(spark, sf)
    ok = unify.observation_verdicts(own, **_RULES).where("filter_passed").select("cluster_key")
    return unify.renumbered(own.join(ok, "cluster_key", "left_semi"))


_FMT = lambda x: f"CASE WHEN abs({x} - round_even({x}, 0)) < 1e-9 THEN concat(CAST(round_even({x}, 0) AS BIGINT), '') ELSE regexp_replace(regexp_replace(printf('%.4f', {r4(x)}), '0+$', ''), '\\.$', '') END"
_SUM = f"""kept AS (SELECT det.* EXCLUDE (cluster_key, sample), new_key AS cluster_key, CASE WHEN sample_attribute = 'tissue' THEN concat(upper(substr(sample, 1, 1)), substr(sample, 2)) ELSE sample END AS sample FROM det JOIN names USING (cluster_key)),
rel AS (SELECT *, {r4('sum(site_count) OVER (PARTITION BY transcript_id, sample_id, cluster_key) / sum(site_count) OVER (PARTITION BY transcript_id, sample_id)')} AS share FROM kept),
pos AS (SELECT cluster_key, original_site_position AS x, sum(site_count) AS n FROM kept GROUP BY ALL),
run AS (SELECT *, sum(n) OVER (PARTITION BY cluster_key ORDER BY x) AS run, sum(n) OVER (PARTITION BY cluster_key) AS total, sum(x * n) OVER (PARTITION BY cluster_key) / sum(n) OVER (PARTITION BY cluster_key) AS mean FROM pos),
wp AS (SELECT cluster_key, max(mean) AS mean, sqrt(sum(n * (x - mean) * (x - mean)) / sum(n)) AS sd, min(x) FILTER (run >= 0.75::DOUBLE * total) - min(x) FILTER (run >= 0.25::DOUBLE * total) AS iqr FROM run GROUP BY 1),
tc AS (SELECT cluster_key, string_agg(concat(transcript_id, ':', CAST(n AS BIGINT)), ',' ORDER BY n DESC, transcript_id) AS transcript_cluster_counts, count(*) AS n_transcripts, sum(n) AS total FROM (SELECT cluster_key, transcript_id, sum(site_count) AS n FROM kept GROUP BY ALL) GROUP BY 1),
agg AS (SELECT cluster_key, array_to_string(list_sort(list(DISTINCT transcript_id)), ',') AS transcript_ids, array_to_string(list_sort(list(DISTINCT sample)), ',') AS sample_list, array_to_string(list_sort(list(DISTINCT transcript_biotype)), ',') AS transcript_biotype, count(DISTINCT sample_id) AS n_samples, count(DISTINCT sample_id) FILTER (sample_attribute = 'tissue') AS n_tissues, count(DISTINCT sample_id) FILTER (sample_attribute = 'cell_culture') AS n_cell_cultures, {r4('median(share)')} AS median_cluster_relative_abundance,
 arg_min(gene_id, ingest_seq) AS gene_id, arg_min(gene_name, ingest_seq) AS gene_name FROM rel GROUP BY 1),
one AS (SELECT DISTINCT cluster_key, unified_ID, {_K}, cluster_start, cluster_end, cluster_width, mode_site_position, mode_score, mode_local_n_samples, mode_local_total_site_count, mode_exact_n_samples, mode_exact_total_site_count, n_unique_positions FROM kept)"""


_KEPT = f"{_NEW}, {_SUM}"


_SUMMARY = """SELECT one.cluster_key, unified_ID, gene_id, gene_name, effective_gene_id, chromosome, strand, cluster_start, cluster_end, cluster_width, mode_site_position, mode_score, mode_local_n_samples, concat(CAST(mode_local_total_site_count AS BIGINT), '') AS mode_local_total_site_count, mode_exact_n_samples, concat(CAST(mode_exact_total_site_count AS BIGINT), '') AS mode_exact_total_site_count, n_unique_positions,
 round_even(mean * 1e2::DOUBLE, 0) / 1e2::DOUBLE AS weighted_mean_position, round_even(sd * 1e2::DOUBLE, 0) / 1e2::DOUBLE AS weighted_position_sd, concat(CAST(iqr AS BIGINT), '') AS position_iqr, n_transcripts, transcript_ids, transcript_cluster_counts, concat(CAST(total AS BIGINT), '') AS total_site_count, n_samples, n_tissues, n_cell_cultures, sample_list, transcript_biotype, median_cluster_relative_abundance, filter_pass_rule, filter_reason
FROM one JOIN agg USING (cluster_key) JOIN wp USING (cluster_key) JOIN tc USING (cluster_key) JOIN names ON new_key = one.cluster_key JOIN ver ON ver.cluster_key = names.cluster_key"""


@query("AGG18_cluster_summary", f"{_ALL}, {_OBS}, {_NEW}, {_SUM} {_SUMMARY}")
def agg18(spark, sf):
    rows = B.pas(spark, sf)
    return unify.unify(rows, numbered=_gaps(spark, sf), **_RULES)["summary"]


@query("AGG10_AGG11_weighted_positions", f"{_ALL}, {_OBS}, {_NEW}, {_SUM} SELECT cluster_key, round(mean, 6) AS weighted_mean, round(sd, 6) AS weighted_sd, iqr FROM wp")
def agg10(spark, sf):
    own = unify.kept(B.pas(spark, sf), _gaps(spark, sf), **_RULES)["positions"]
    return own.select("cluster_key", F.round("weighted_mean", 6).alias("weighted_mean"), F.round("weighted_sd", 6).alias("weighted_sd"), (F.col("q75") - F.col("q25")).alias("iqr"))


@query("AGG12_observation_counts", f"{_ALL} SELECT cluster_key, transcript_id, sample_id, sum(site_count) AS n FROM det GROUP BY ALL")
def agg12(spark, sf):
    return _detailed(spark, sf).groupBy("cluster_key", "transcript_id", "sample_id").agg(F.sum("site_count").alias("n"))


@query("AGG18b_transcript_counts", f"{_ALL}, {_OBS}, {_NEW}, {_SUM} SELECT cluster_key, transcript_cluster_counts, n_transcripts, total FROM tc")
def agg18b(spark, sf):
    return unify.kept(B.pas(spark, sf), _gaps(spark, sf), **_RULES)["transcripts"].drop("transcript_ids")


@query("AGG23_shared_coordinates", f"{_ALL} SELECT unified_ID, count(DISTINCT effective_gene_id) AS n_genes FROM det GROUP BY 1 HAVING count(DISTINCT effective_gene_id) > 1")
def agg23(spark, sf):
    return unify.shared_names(_detailed(spark, sf))


@query("PRJ09_plain_numbers", f"SELECT o_orderkey, {_FMT('v')} AS t FROM (SELECT o_orderkey, o_orderkey % 7 + (o_orderkey % 5) / 8::DOUBLE AS v FROM orders)")
def prj09(spark, sf):
    return B.table(spark, sf, "orders").select("o_orderkey", numeric.plain_number(F.col("o_orderkey") % 7 + (F.col("o_orderkey") % 5) / 8.0).alias("t"))


@query("PRJ10_tissue_names", f"WITH {B.PAS} SELECT ingest_seq, CASE WHEN sample_attribute = 'tissue' THEN concat(upper(substr(sample, 1, 1)), substr(sample, 2)) ELSE sample END AS sample FROM pas")
def prj10(spark, sf):
    return unify.tissue_names(B.pas(spark, sf)).select("ingest_seq", "sample")


@query("PRJ13_rescue_cutoff", f"WITH {B.PAS} SELECT least(10 * count(DISTINCT sample_id), 50) AS cutoff FROM pas")
def prj13(spark, sf):
    return B.pas(spark, sf).agg(F.least(10 * F.count_distinct("sample_id"), F.lit(50)).cast("long").alias("cutoff"))


@query("ORD04_detailed_order", f"{_ALL} SELECT ingest_seq, chromosome, cluster_start, original_site_position, row_number() OVER (ORDER BY chromosome, cluster_start, cluster_end, strand, effective_gene_id, original_site_position, transcript_id, sample_id, ingest_seq) AS place FROM det")
def ord04(spark, sf):
    """Rows in report order with their place: counts per range of the order give each range its first place, so no task sorts all."""
    own = _detailed(spark, sf)
    keys = ["chromosome", "cluster_start", "cluster_end", "strand", "effective_gene_id", "original_site_position", "transcript_id", "sample_id", "ingest_seq"]
    before = own.groupBy("chromosome", "cluster_start").agg(F.count(F.lit(1)).alias("n"))
    first = before.withColumn("_n", F.sum("n").over(Window.partitionBy("chromosome").orderBy("cluster_start")) - F.col("n"))
    whole = before.groupBy("chromosome").agg(F.sum("n").alias("c"))
    whole = whole.withColumn("_c", F.sum("c").over(Window.orderBy("chromosome")) - F.col("c")).select("chromosome", "_c")
    ranked = own.withColumn("_r", F.row_number().over(Window.partitionBy("chromosome", "cluster_start").orderBy(*keys)))
    got = ranked.join(first.select("chromosome", "cluster_start", "_n"), ["chromosome", "cluster_start"]).join(whole, "chromosome")
    return got.select("ingest_seq", "chromosome", "cluster_start", "original_site_position", (F.col("_c") + F.col("_n") + F.col("_r")).cast("long").alias("place"))


# The same recursion in SQL: intervals with their weighted variance, the least cost of each prefix, then the cuts from the last one back.
_DP = f"""WITH RECURSIVE {B.PAS}, {_EV}, wt AS (SELECT {_K}, site_position AS x, greatest(0.7::DOUBLE * n_samples / max(n_samples) OVER (PARTITION BY {_K}) + 0.3::DOUBLE * ln(1 + total_count) / max(ln(1 + total_count)) OVER (PARTITION BY {_K}), 1e-6) AS w FROM ev),
pos AS (SELECT concat_ws('|', {_K}) AS gene, *, row_number() OVER (PARTITION BY {_K} ORDER BY x) AS i, x - lag(x) OVER (PARTITION BY {_K} ORDER BY x) AS step FROM wt),
run AS (SELECT a.gene, a.i AS s, c.i AS e, sum(c.w) OVER r AS sw, sum(c.w * (c.x - a.x)) OVER r AS s1, sum(c.w * (c.x - a.x) * (c.x - a.x)) OVER r AS s2, max(CASE WHEN c.i > a.i THEN c.step ELSE 0 END) OVER r AS far FROM pos a JOIN pos c ON a.gene = c.gene AND c.x BETWEEN a.x AND a.x + 39 WINDOW r AS (PARTITION BY a.gene, a.i ORDER BY c.i)),
iv AS MATERIALIZED (SELECT gene, s, e, 225 + greatest(s2 / sw - (s1 / sw) * (s1 / sw), 0) AS price FROM run WHERE far <= 24),
dp AS (SELECT DISTINCT gene, 0::BIGINT AS n, [0::DOUBLE] AS cost, [0::BIGINT] AS parts, []::BIGINT[] AS back FROM pos UNION ALL
 SELECT gene, n + 1, list_append(cost, m.x), list_append(parts, m.p), list_append(back, m.s) FROM (SELECT d.gene, d.n, any_value(d.cost) AS cost, any_value(d.parts) AS parts, any_value(d.back) AS back, min({{'c': round(d.cost[iv.s] + price, 8), 'p': d.parts[iv.s] + 1, 's': iv.s, 'x': d.cost[iv.s] + price}}) AS m FROM dp d JOIN iv ON iv.gene = d.gene AND iv.e = d.n + 1 GROUP BY d.gene, d.n)),
last AS (SELECT gene, max(n) AS n, arg_max(back, n) AS back FROM dp GROUP BY gene),
cut AS (SELECT gene, back, n AS e, back[n] AS s FROM last UNION ALL SELECT gene, back, s - 1, back[s - 1] FROM cut WHERE s > 1),
numbered AS (SELECT gene, s, e, row_number() OVER (PARTITION BY gene ORDER BY s) - 1 AS cluster_number FROM cut)"""


@query("ALG04_dp_segmentation", f"{_DP} SELECT {_K}, x AS site_position, cluster_number FROM pos JOIN numbered c ON pos.gene = c.gene AND pos.i BETWEEN c.s AND c.e")
def alg04(spark, sf):
    return unify.segment(B.pas(spark, sf), absorb=False)


# Absorption in SQL: every island's clusters as a list that is gone through, merged and stepped back in, one action a round of the recursion.
_ABSORB = f"""{_DP}, island AS (SELECT gene, i, x, sum(CASE WHEN step > 24 THEN 1 ELSE 0 END) OVER (PARTITION BY gene ORDER BY i) AS isl FROM pos),
obs AS (SELECT pos.gene, pos.i, transcript_id AS t, sample_id AS k, sum(site_count) AS n FROM pas JOIN pos ON {' AND '.join(f'pas.{k} = pos.{k}' for k in _K.split(', '))} AND site_position = x GROUP BY ALL),
tot AS (SELECT gene, t, k, sum(n) AS whole FROM obs GROUP BY ALL),
part AS (SELECT iv.gene, s, e, t, k, sum(n) AS n FROM iv JOIN obs ON obs.gene = iv.gene AND obs.i BETWEEN s AND e GROUP BY ALL),
sup AS MATERIALIZED (SELECT part.gene, s, e, CAST(count(*) FILTER (n >= 5) AS BIGINT) AS good, max(n) AS top, count(*) FILTER (n >= 5) >= 2 OR bool_or(n >= 50 AND n / whole >= 0.25) AS ok FROM part JOIN tot USING (gene, t, k) GROUP BY ALL),
c0 AS (SELECT a.gene, a.isl, list({{'s': c.s, 'e': c.e, 'lo': a.x, 'hi': b.x, 'good': good, 'top': top, 'ok': ok}} ORDER BY c.s) AS cs FROM numbered c JOIN island a ON a.gene = c.gene AND a.i = c.s JOIN island b ON b.gene = c.gene AND b.i = c.e JOIN sup ON sup.gene = c.gene AND sup.s = c.s AND sup.e = c.e GROUP BY ALL),
st AS (SELECT gene, isl, cs, 1::BIGINT AS i, false AS moved, false AS done FROM c0 UNION ALL
 SELECT d.gene, d.isl, CASE WHEN m IS NULL THEN cs ELSE list_concat(cs[1:m.j - 1], [{{'s': m.s, 'e': m.e, 'lo': m.lo, 'hi': m.hi, 'good': sup.good, 'top': sup.top, 'ok': sup.ok}}], cs[m.j + 2:]) END,
  CASE WHEN m IS NOT NULL THEN greatest(1, m.j - 1) WHEN i > len(cs) THEN 1 ELSE i + 1 END, CASE WHEN m IS NOT NULL THEN true WHEN i > len(cs) THEN false ELSE moved END, i > len(cs) AND NOT moved
 FROM (SELECT *, CASE WHEN i <= len(cs) AND cs[i].s = cs[i].e AND cs[i].top < 5 THEN list_min(list_filter(list_transform(
   [{{'j': i - 1, 'n': cs[i - 1], 'a': cs[i - 1], 'b': cs[i]}}, {{'j': i, 'n': cs[i + 1], 'a': cs[i], 'b': cs[i + 1]}}],
   lambda o: CASE WHEN o.j >= 1 AND o.b IS NOT NULL AND o.n.ok AND o.b.hi - o.a.lo + 1 <= 40 AND o.b.lo - o.a.hi <= 24 THEN {{'d': least(abs(cs[i].lo - o.n.lo), abs(cs[i].lo - o.n.hi)), 'g': -o.n.good, 't': -o.n.top, 'j': o.j, 's': o.a.s, 'e': o.b.e, 'lo': o.a.lo, 'hi': o.b.hi}} END),
   lambda o: o IS NOT NULL)) END AS m FROM st WHERE NOT done) d LEFT JOIN sup ON sup.gene = d.gene AND sup.s = m.s AND sup.e = m.e),
absorbed AS (SELECT gene, c.s AS s, c.e AS e, row_number() OVER (PARTITION BY gene ORDER BY c.s) - 1 AS cluster_number FROM (SELECT gene, unnest(cs) AS c FROM st WHERE done))"""


@query("ALG05_absorbed_segmentation", f"{_ABSORB} SELECT {_K}, x AS site_position, cluster_number FROM pos JOIN absorbed c ON pos.gene = c.gene AND pos.i BETWEEN c.s AND c.e")
def alg05(spark, sf):
    return unify.segment(B.pas(spark, sf))


#: The rules of AGG15 with the default numbers.
_OBS_DEFAULT = _OBS.replace("n >= 30", "n >= 5").replace("count_ge_30", "count_ge_5").replace("n_samples >= 2 AND", "n_samples >= 1 AND").replace("n_samples < 2", "n_samples < 1").replace("n_samples_lt_2", "n_samples_lt_1")
_CATALOGUE = f"WITH {B.PAS}, {_EV}, seg AS ({_ABSORB} SELECT {_K}, x AS site_position, cluster_number FROM pos JOIN absorbed c ON pos.gene = c.gene AND pos.i BETWEEN c.s AND c.e), gap AS (SELECT ev.*, cluster_number FROM ev JOIN seg USING ({_K}, site_position)), {_NEARBY}, {_MAP}, {_DET}, {_OBS_DEFAULT}, {_NEW}, {_SUM} {_SUMMARY}"


@query("ALG07_dp_catalogue", _CATALOGUE)
def alg07(spark, sf):
    """The catalogue with segmentation by dynamic programming and absorption."""
    return unify.unify(B.pas(spark, sf))["summary"]


# ---- annotation of clusters ----


@query("ALG13_oriented_context", f"WITH {B.DNA}, {B.POINTS}, {B.CONTEXTS} SELECT chromosome, k, s AS context, c AS context_start FROM contexts")
def alg13(spark, sf):
    own = B.points(spark, sf)
    s, c = sequence.oriented_context(F.col("sequence"), F.col("pos"), F.col("strand"))
    return own.select("chromosome", "k", s.alias("context"), c.alias("context_start"))


@query("REL08_tiled_context", f"WITH {B.DNA}, {B.POINTS}, {B.CONTEXTS} SELECT chromosome, k, s AS context, c AS context_start FROM contexts")
def rel08(spark, sf):
    own = B.points(spark, sf).select("chromosome", "strand", F.col("pos").alias("mode_site_position"), "k")
    return annotate.contexts(own, tables.tiles(B.chromosomes(spark, sf))).select("chromosome", "k", "context", "context_start")


def _win(a: int, b: int) -> tuple[str, str]:
    """Text and first base of a window of the context, in SQL."""
    return f"CASE WHEN least(c + length(s), {b}) > greatest(c, {a}) THEN substr(s, greatest(c, {a}) - c + 1, least(c + length(s), {b}) - greatest(c, {a})) ELSE '' END", f"greatest(c, {a})"


def _hit(a: int, b: int, motifs: list[str], kinds) -> str:
    w, first = _win(a, b)
    tail = "".join(f", {n}: '{k}'" for n, k in zip("tls", kinds))
    return "coalesce(" + ", ".join(f"CASE WHEN instr({w}, '{m}') > 0 THEN {{m: '{m}', p: {first} + instr({w}, '{m}') - 1{tail}}} END" for m in motifs) + ")"


def _rich(a: int, b: int, kinds) -> str:
    w, first = _win(a, b)
    tail = "".join(f", {n}: '{k}'" for n, k in zip("tls", kinds))
    one = f"list_min(list_filter(list_transform(range(0, greatest(length({w}) - 5, 0)), lambda i: (length(replace(substr({w}, i + 1, 6), 'T', '')) - 6, abs({first} + i), {first} + i, substr({w}, i + 1, 6))), lambda h: h[1] <= -5))"
    return f"CASE WHEN {one} IS NOT NULL THEN {{m: ({one})[4], p: ({one})[3]{tail}}} END"


def _motif_sql(model: str, more: str = "") -> str:
    steps = annotate.STEPS[model]
    hits = [_rich(a, b, k) if m is None else _hit(a, b, m, k) for a, b, m, *k in steps]
    if model == "BUDDING_YEAST":
        pos, eff = _hit(*steps[0][:3], annotate.BOTH), _hit(*steps[1][:3], annotate.BOTH)
        hits.insert(0, f"CASE WHEN {eff} IS NOT NULL THEN {pos} END")
    u = _win(-10, 16)[0]
    share = r4(f"(length({u}) - length(replace({u}, 'T', '')))::DOUBLE / length({u})") if model == "LAND_PLANT" else "NULL::DOUBLE"
    found = f"m AS (SELECT *, coalesce({', '.join(hits)}, {{m: NULL, p: NULL, t: 'none', l: 'none', s: 'none'}}) AS h FROM contexts)"
    return f"WITH {B.DNA}, {B.POINTS}, {B.CONTEXTS}, {found} SELECT chromosome, k, {more + ', ' if more else ''}h.m AS motif, CAST(h.p AS INT) AS position, h.t AS motif_type, h.l AS search_level, h.s AS motif_support, {_win(-1, 1)[0]} AS cleavage_context, CASE WHEN length({u}) > 0 THEN {share} END AS u_rich_fraction FROM m"


def _motifs(model: str):
    def run(spark, sf):
        own = alg13(spark, sf)
        return own.select("chromosome", "k", annotate.motif(F.col("context"), F.col("context_start"), model).alias("m")).select("chromosome", "k", "m.*")

    return run


for _model in annotate.STEPS:
    query(f"ALG10_motif_{_model.lower()}", _motif_sql(_model))(_motifs(_model))


@query("ALG11_first_motif", f"WITH {B.DNA}, {B.POINTS}, {B.CONTEXTS}, h AS (SELECT *, {_hit(-40, 0, annotate.CANONICAL, ())} AS h FROM contexts) SELECT chromosome, k, h.m AS motif, CAST(h.p AS INT) AS position FROM h")
def alg11(spark, sf):
    own = alg13(spark, sf).withColumn("h", sequence.first_motif(F.col("context"), F.col("context_start"), -40, 0, annotate.CANONICAL))
    return own.select("chromosome", "k", F.col("h.motif").alias("motif"), F.col("h.position").cast("int").alias("position"))


@query("ALG12_rich_hexamer", f"WITH {B.DNA}, {B.POINTS}, {B.CONTEXTS}, h AS (SELECT *, {_rich(-20, 21, ())} AS h FROM contexts) SELECT chromosome, k, h.m AS motif, CAST(h.p AS INT) AS position FROM h")
def alg12(spark, sf):
    own = alg13(spark, sf).withColumn("h", sequence.rich_hexamer(F.col("context"), F.col("context_start"), -20, 21))
    return own.select("chromosome", "k", F.col("h.motif").alias("motif"), F.col("h.position").cast("int").alias("position"))


@query("ALG14_display_window", f"WITH {B.DNA}, {B.POINTS}, {B.CONTEXTS} SELECT chromosome, k, {_win(-50, 51)[0]} AS shown FROM contexts")
def alg14(spark, sf):
    return alg13(spark, sf).select("chromosome", "k", sequence.display(F.col("context"), F.col("context_start")).alias("shown"))


@query("ALG15_context_metrics", f"WITH {B.DNA}, {B.POINTS}, {B.CONTEXTS} SELECT chromosome, k, {_win(-1, 1)[0]} AS cleavage, CASE WHEN length({_win(-10, 16)[0]}) > 0 THEN {r4(f'(length({_win(-10, 16)[0]}) - length(replace({_win(-10, 16)[0]}, {chr(39)}T{chr(39)}, {chr(39)}{chr(39)})))::DOUBLE / length({_win(-10, 16)[0]})')} END AS t_fraction FROM contexts")
def alg15(spark, sf):
    own = alg13(spark, sf)
    s, c = F.col("context"), F.col("context_start")
    return own.select("chromosome", "k", sequence.window(s, c, -1, 1)[0].alias("cleavage"), numeric.round_even(sequence.fraction(sequence.window(s, c, -10, 16)[0], "T"), 4).alias("t_fraction"))


@query("PRJ15_sample_key", "SELECT c_custkey, trim(regexp_replace(replace(lower(concat(' ', c_name, '__', c_mktsegment)), '_', ' '), '\\s+', ' ', 'g')) AS key FROM customer")
def prj15(spark, sf):
    return B.table(spark, sf, "customer").select("c_custkey", annotate.sample_key(F.concat(F.lit(" "), "c_name", F.lit("__"), "c_mktsegment")).alias("key"))


@query("PRJ16_evidence_level", "SELECT p_partkey, CASE WHEN p_size % 3 >= 2 AND p_partkey % 2 = 0 THEN 'PAS-L1' WHEN p_size % 3 >= 2 OR p_partkey % 2 = 0 THEN 'PAS-L2' ELSE 'PAS-L3' END AS pa_level, CASE WHEN p_size % 3 >= 2 AND p_partkey % 2 = 0 THEN 'recurrence_and_motif' WHEN p_size % 3 >= 2 THEN 'recurrence_only' WHEN p_partkey % 2 = 0 THEN 'motif_only' ELSE 'baseline_call' END AS pa_level_basis FROM part")
def prj16(spark, sf):
    a, b = annotate.level(F.col("p_size") % 3, F.when(F.col("p_partkey") % 2 == 0, "primary").otherwise("auxiliary"))
    return B.table(spark, sf, "part").select("p_partkey", a.alias("pa_level"), b.alias("pa_level_basis"))


@query("AGG19_cluster_extent", f"{_ALL} SELECT cluster_key, any_value(unified_ID) AS unified_ID, any_value(chromosome) AS chromosome, any_value(strand) AS strand, any_value(mode_site_position) AS mode_site_position, min(original_site_position) AS cluster_start, max(original_site_position) AS cluster_end, count(DISTINCT sample_id) AS n_samples FROM det GROUP BY 1")
def agg19(spark, sf):
    return annotate.clusters(_detailed(spark, sf))


# ---- fixture-side operators ----


@query("FIX02_region_crop", f"WITH {B.MODEL}, r AS (SELECT chromosome, greatest(0, min(pos0) - 50) AS first, max(CASE WHEN multi THEN pos0 + n1 + n2 + width ELSE pos0 + width END) + 50 AS last FROM model GROUP BY 1) SELECT transcript_id, pos0 + 1 - first AS shifted FROM model JOIN r USING (chromosome)")
def fix02(spark, sf):
    own = annotation.derived(B.models(spark, sf))
    region = own.groupBy("chromosome").agg(F.greatest(F.lit(0), F.min("tx_start") - 51).alias("first"), (F.max("tx_end") + 50).alias("last"))
    return own.join(region, "chromosome").select("transcript_id", (F.col("tx_start") - F.col("first")).alias("shifted"))


@query("FIX04_hash_ranked_top", f"WITH {B.ENDS} SELECT transcript_id, name FROM (SELECT transcript_id, concat(read_end, '') AS name, row_number() OVER (PARTITION BY transcript_id ORDER BY sha256(concat_ws('|', 42, transcript_id, read_end)), concat(read_end, '')) AS r FROM (SELECT DISTINCT * FROM ends)) WHERE r <= 3")
def fix04(spark, sf):
    own = B.ends(spark, sf).distinct().select("transcript_id", F.col("read_end").cast("string").alias("name"))
    rank = F.row_number().over(Window.partitionBy("transcript_id").orderBy(F.sha2(F.concat_ws("|", F.lit("42"), "transcript_id", "name"), 256), "name"))
    return own.withColumn("r", rank).where("r <= 3").select("transcript_id", "name")
