from pyspark.sql import functions as F

from terminus.plans import bindings as B
from terminus.sources import annotation

# Repeated, empty, unfinished, spaced and nested attributes.
TEXTS = [
    'gene_id "G1"; transcript_id "T1"; gene_name "a b";', 'gene_id "G1"; gene_id "G2"', 'gene_id "G1"; gene_id "', 'gene_id "G1";gene_id "x" y;', '  gene_id "G""" ; gene_name ""',
    'xgene_id "no"; gene_id  "two"; my gene_id "no"', 'db_xref "GeneID:5"; db_xref "X:1"; ncbi_gene_id "7"', 'ncbi_gene_id "7"; db_xref "GeneID:"', 'ncbi_gene_id "7"; db_xref "MGI:1"', "", ";;", 'gene_id "a"b"; transcript_id T1',
    'gene_id "a\nb"; transcript_id "T\n"', 'gene_name "gene_id "x""; transcript_id "q" ',
]
NAMES = ["gene_id", "transcript_id", "gene_name", "ncbi_gene_id", "transcript_biotype"]


def test_one_attribute_is_that_of_the_map(spark):
    own = spark.createDataFrame([(t,) for t in TEXTS], "text string").withColumn("a", annotation.gtf_attributes(F.col("text")))
    both = own.select("text", *[F.struct(annotation.gtf_attribute(F.col("text"), n).alias("one"), annotation.blank(F.try_element_at("a", F.lit(n))).alias("of_map")).alias(n) for n in NAMES])
    for r in both.collect():
        for n in NAMES:
            assert r[n].one == r[n].of_map, (r.text, n)


def test_lines_are_read_once(spark):
    plan = annotation.gtf_models(B.gtf_lines(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3 and "lambda" not in plan.split("collect_list", 1)[1]
