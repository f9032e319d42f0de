"""The driver's tables seen as genomic tables, for Spark and as DuckDB's common table expressions.

Each view is deterministic and takes whole tables. Spark's version is built by select expressions, DuckDB's is text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


DAY = "CAST(datediff(CAST(l_shipdate AS DATE), DATE '1992-01-01') AS INT)"
DUCK_DAY = "CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS INT)"

_PAS = """concat('T', l_partkey % 20) AS transcript_id, concat('G', l_suppkey) AS gene_id, concat('N', l_suppkey) AS gene_name, concat('NC_', l_returnflag) AS chromosome,
 CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, {day} AS site_position, CAST(l_quantity AS DOUBLE) AS site_count,
 CASE l_linenumber % 3 WHEN 0 THEN 'mRNA' WHEN 1 THEN 'lncRNA' ELSE '' END AS transcript_biotype, CASE WHEN l_linenumber <= 4 THEN 'tissue' ELSE 'cell_culture' END AS sample_attribute,
 concat('s', l_linenumber) AS sample, concat('x/s', l_linenumber) AS sample_id, l_orderkey * 8 + l_linenumber AS ingest_seq, concat('G', l_suppkey) AS effective_gene_id"""


def pas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site rows of seven samples, about six hundred genes and strands a hundred suppliers."""
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("_lineitem")
    return spark.sql(f"SELECT {_PAS.format(day=DAY)} FROM _lineitem")


PAS = f"pas AS (SELECT {_PAS.format(day=DUCK_DAY)} FROM lineitem)"

# Raw site rows as text, some of them broken.
_RAW = """CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN '' ELSE concat('T', l_partkey % 20) END AS transcript_id,
 CASE WHEN l_suppkey % 7 = 0 THEN '' ELSE concat('G', l_suppkey) END AS gene_id, CASE WHEN l_suppkey % 21 = 0 THEN NULL ELSE concat('N', l_suppkey) END AS gene_name,
 CASE WHEN l_orderkey % 83 = 0 THEN ' ' WHEN l_partkey % 11 = 0 THEN 'NW_1' WHEN l_partkey % 13 = 0 THEN 'NC_012920.1' ELSE concat('NC_', l_returnflag) END AS chromosome,
 CASE WHEN l_orderkey % 79 = 0 THEN '.' WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
 CASE WHEN l_orderkey % 73 = 0 THEN '12.5' WHEN l_orderkey % 71 = 0 THEN 'x' WHEN l_orderkey % 67 = 0 THEN '-3' ELSE concat({day}, '') END AS site_position,
 CASE WHEN l_orderkey % 61 = 0 THEN '0' WHEN l_orderkey % 59 = 0 THEN NULL ELSE concat(CAST(l_quantity AS INT), '') END AS site_count,
 CASE l_linenumber WHEN 1 THEN 'mRNA' WHEN 2 THEN 'lnc_RNA' WHEN 3 THEN NULL WHEN 4 THEN 'tRNA' ELSE 'protein_coding' END AS transcript_biotype, l_orderkey * 8 + l_linenumber AS ingest_seq,
 CASE WHEN l_partkey % 17 = 0 THEN concat('XM_', l_partkey) ELSE concat('NM_', l_partkey) END AS accession"""


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("_lineitem")
    return spark.sql(f"SELECT {_RAW.format(day=DAY)} FROM _lineitem")


RAW = f"raw_rows AS (SELECT {_RAW.format(day=DUCK_DAY)} FROM lineitem)"


def ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read ends of a transcript a part."""
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("_lineitem")
    return spark.sql(f"SELECT concat('T', l_partkey) AS transcript_id, {DAY} AS read_end FROM _lineitem")


ENDS = f"ends AS (SELECT concat('T', l_partkey) AS transcript_id, {DUCK_DAY} AS read_end FROM lineitem)"

_LABELLED = "concat('T', l_partkey) AS transcript_id, l_linenumber % 3 AS component, {day} % 500 AS site_position"


def labelled_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read ends of a transcript a part, within 500 bases, in three components."""
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("_lineitem")
    return spark.sql(f"SELECT {_LABELLED.format(day=DAY)} FROM _lineitem")


ENDS_LABELLED = f"labelled AS (SELECT {_LABELLED.format(day=DUCK_DAY)} FROM lineitem)"

# Alignments: spliced ones follow a chain of their order's models, unspliced ones lie among single-exon models.
_ALN = """concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS read_id,
 CASE WHEN l_partkey % 29 = 0 THEN 4 WHEN l_partkey % 31 = 0 THEN 256 WHEN l_partkey % 37 = 0 THEN 2048 WHEN l_linestatus = 'O' THEN 0 ELSE 16 END AS flag,
 concat('c', l_suppkey % 5) AS rname, CAST(l_partkey % 400 * 25 AS INT) AS pos0, CAST(l_linenumber - 1 AS INT) AS mapq,
 CASE WHEN l_linenumber % 2 = 0 THEN concat(CAST(20 + l_partkey % 3 AS INT), 'M', CAST(100 + l_suppkey % 2 AS INT), 'N5I', CAST(l_quantity AS INT), 'M2D', 10, 'M3S') ELSE concat('2S', CAST(l_quantity * 3 AS INT), 'M1D', 4, '=') END AS cigar,
 l_orderkey % 41 = 0 AS has_sa, l_suppkey % 3 = 0 AS oriented, CAST(20 + l_partkey % 3 AS INT) AS n1, CAST(100 + l_suppkey % 2 AS INT) AS n2, CAST(l_quantity AS INT) AS q, l_linenumber % 2 = 0 AS spliced"""


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("_lineitem")
    return spark.sql(f"SELECT {_ALN} FROM _lineitem")


ALN = f"aln AS (SELECT {_ALN} FROM lineitem)"
#: The same alignments as numbers: strand, end and the two places of the only intron, without reading the string.
LOCATED = """located AS (SELECT *, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand, pos0 + CASE WHEN spliced THEN n1 + n2 + q + 12 ELSE q * 3 + 5 END AS end0,
 CASE WHEN spliced THEN [pos0 + n1, pos0 + n1 + n2 + 1] END AS junctions, rname AS chromosome FROM aln)"""
ACCEPTED = "accepted AS (SELECT * FROM located WHERE flag & (4 | 256 | 2048) = 0 AND mapq >= 1 AND NOT has_sa)"

# Models: every third part has two exons (a chain that reads may have), the rest have one.
_MODEL = """concat('M', p_partkey) AS transcript_id, concat('c', p_size % 5) AS chromosome, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, p_partkey AS file_ord,
 CAST(p_partkey % 400 * 25 AS INT) AS pos0, CAST(20 + p_partkey % 3 AS INT) AS n1, CAST(100 + p_size % 2 AS INT) AS n2, p_partkey % 3 = 0 AS multi, CAST(40 + p_size AS INT) AS width"""


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "part").createOrReplaceTempView("_part")
    own = spark.sql(f"SELECT {_MODEL} FROM _part")
    exons = F.expr("CASE WHEN multi THEN array(named_struct('start', pos0 + 1, 'end', pos0 + n1), named_struct('start', pos0 + n1 + n2 + 1, 'end', pos0 + n1 + n2 + width)) ELSE array(named_struct('start', pos0 + 1, 'end', pos0 + width)) END")
    return own.select("file_ord", "transcript_id", F.lit("").alias("gene_name"), "chromosome", "strand", exons.alias("exons"), F.lit("").alias("ncbi_gene_id"), F.lit("").alias("transcript_biotype"), F.lit("").alias("reference_gene_id"))


MODEL = f"model AS (SELECT {_MODEL} FROM part)"
CHAINS = """chains AS (SELECT chromosome, [pos0 + n1, pos0 + n1 + n2 + 1] AS junctions, arg_max(transcript_id, file_ord) AS transcript_id, arg_max(strand, file_ord) AS tx_strand FROM model WHERE multi GROUP BY ALL)"""
SINGLES = "singles AS (SELECT chromosome, strand AS tx_strand, pos0 + 1 AS tx_start, pos0 + width AS tx_end, transcript_id FROM model WHERE NOT multi)"
TERMINAL = """terminal AS (SELECT chromosome, strand, transcript_id, CASE WHEN strand = '+' THEN pos0 + n1 + n2 + 1 ELSE pos0 + 1 END AS ex_start, CASE WHEN strand = '+' THEN pos0 + n1 + n2 + width ELSE pos0 + n1 END AS ex_end FROM model WHERE multi)"""

# Annotation lines made of parts: a transcript and one to four exons each.
_GTF_TX = """concat_ws(chr(9), concat('c', p_size % 5), 'made', 'transcript', p_partkey * 10, p_partkey * 10 + 4000, '.', CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END, '.',
 concat('gene_id "G', p_partkey % 50, '"; transcript_id "M', p_partkey, '";', CASE WHEN p_size % 3 = 0 THEN concat(' gene_name "', p_name, '";') ELSE '' END, ' db_xref "X:1"; db_xref "GeneID:', p_size, '";'))"""
_GTF_EX = """concat_ws(chr(9), concat('c', p_size % 5), 'made', 'exon', p_partkey * 10 + k * 100, p_partkey * 10 + k * 100 + p_size, '.', CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END, '.',
 concat('gene_id "G', p_partkey % 50, '"; transcript_id "M', p_partkey, '"; transcript_biotype "', CASE WHEN p_size % 2 = 0 THEN 'mRNA' ELSE '' END, '";'))"""


def spread_parts(spark: SparkSession, sf_dir: str) -> None:
    """The view `_part` over as many tasks as the session shuffles to: a part is some bytes, but its lines are long to read, and a file of parts is few splits."""
    table(spark, sf_dir, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey").createOrReplaceTempView("_part")


def gtf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread_parts(spark, sf_dir)
    return spark.sql(
        f"SELECT p_partkey * 10 AS line_no, {_GTF_TX} AS value FROM _part WHERE p_partkey % 11 <> 0"
        f" UNION ALL SELECT p_partkey * 10 + k + 1, {_GTF_EX} FROM (SELECT *, explode(sequence(0, CAST(p_partkey % 4 AS INT))) AS k FROM _part)"
        " UNION ALL SELECT p_partkey * 10 + 9, concat('# ', p_name) FROM _part"
    )


_GFF_GENE = "concat_ws(chr(9), concat('c', p_size % 5), 'made', 'gene', p_partkey * 10, p_partkey * 10 + 4000, '.', '+', '.', concat('ID=gene-', p_partkey, ';Name=a%3Bb+', p_size, ';Dbxref=Y:1,GeneID:', p_size, ';gene_biotype=mRNA'))"
_GFF_TX = "concat_ws(chr(9), concat('c', p_size % 5), 'made', CASE WHEN p_size % 2 = 0 THEN 'mRNA' ELSE 'lnc_RNA' END, p_partkey * 10, p_partkey * 10 + 4000, '.', '+', '.', concat('ID=rna-M', p_partkey, ';Parent=gene-', p_partkey))"
_GFF_SUB = "concat_ws(chr(9), concat('c', p_size % 5), 'made', 'miRNA', p_partkey * 10, p_partkey * 10 + 40, '.', '+', '.', concat('ID=sub', p_partkey, ';Parent=rna-M', p_partkey))"
_GFF_EX = "concat_ws(chr(9), concat('c', p_size % 5), 'made', 'exon', p_partkey * 10 + k * 100, p_partkey * 10 + k * 100 + p_size, '.', '+', '.', concat('ID=e', p_partkey, '-', k, ';Parent=rna-M', p_partkey, CASE WHEN k = 0 THEN concat(',sub', p_partkey) ELSE '' END))"


def gff_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread_parts(spark, sf_dir)
    return spark.sql(
        f"SELECT p_partkey * 10 AS line_no, {_GFF_GENE} AS value FROM _part UNION ALL SELECT p_partkey * 10 + 1, {_GFF_TX} FROM _part UNION ALL SELECT p_partkey * 10 + 2, {_GFF_SUB} FROM _part"
        f" UNION ALL SELECT p_partkey * 10 + 3 + k, {_GFF_EX} FROM (SELECT *, explode(sequence(0, CAST(p_partkey % 4 AS INT))) AS k FROM _part)"
    )


# Sequences: documents' letters on four bases; sites spread over them.
_DNA = "translate(upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', ''{g})), 'BDEFHIJKLMNOPQRSUVWXYZ', 'ACGTACTAAAAACTGTTTACGA')"


def chromosomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "documents").createOrReplaceTempView("_documents")
    return spark.sql(f"SELECT concat('chr', doc_id) AS chromosome, {_DNA.format(g='')} AS sequence FROM _documents")


DNA = f"dna AS (SELECT concat('chr', doc_id) AS chromosome, doc_id, {_DNA.format(g=chr(44) + ' ' + repr('g'))} AS sequence FROM documents)"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sites a sequence that has bases: a third in, and at its end."""
    own = chromosomes(spark, sf_dir).where(F.length("sequence") > 0).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
    pos = F.when(F.col("k") == 0, F.floor(F.length("sequence") / 3) + 1).otherwise(F.length("sequence")).cast("int")
    return own.select("chromosome", "sequence", pos.alias("pos"), F.when((F.length("sequence") + F.col("k")) % 2 == 0, "+").otherwise("-").alias("strand"), "k")


POINTS = """points AS (SELECT chromosome, sequence, CAST(CASE WHEN k = 0 THEN length(sequence) // 3 + 1 ELSE length(sequence) END AS INT) AS pos, CASE WHEN (length(sequence) + k) % 2 = 0 THEN '+' ELSE '-' END AS strand, k
 FROM dna, (VALUES (0), (1)) v(k) WHERE length(sequence) > 0)"""
#: The oriented context of each of them.
CONTEXTS = """bounds AS (SELECT *, greatest(0, CASE WHEN strand = '+' THEN pos - 151 ELSE pos - 61 END) AS a, least(length(sequence), CASE WHEN strand = '+' THEN pos + 60 ELSE pos + 150 END) AS b FROM points),
contexts AS (SELECT chromosome, k, pos, strand, CASE WHEN strand = '+' THEN substr(sequence, a + 1, b - a) ELSE reverse(translate(substr(sequence, a + 1, b - a), 'ACGT', 'TGCA')) END AS s, CASE WHEN strand = '+' THEN a - pos + 1 ELSE pos - b END AS c FROM bounds)"""
