import pytest

from terminus.functions import cigar
from terminus.operators import assign
from terminus.sources import annotation

MODELS = "file_ord int, transcript_id string, gene_name string, chromosome string, strand string, exons array<struct<start:int,end:int>>, ncbi_gene_id string, transcript_biotype string, reference_gene_id string"
READS = "read_id string, flag int, rname string, pos0 int, mapq int, cigar string, has_sa boolean, oriented boolean"


@pytest.fixture
def compared(monkeypatch):
    """Rows of both sides of each interval join."""
    seen, plain = [], assign.interval_join

    def counted(left, right, *rest):
        seen.append((left.count(), right.count()))
        return plain(left, right, *rest)

    monkeypatch.setattr(assign, "interval_join", counted)
    return seen


def test_reads_of_a_place_and_models_of_an_interval_are_compared_once(spark, compared):
    models = [(i, f"M{i:03}", "", "c", "+", [(1, 100)], "", "", "") for i in range(60)] + [(60 + i, f"X{i}", "", "c", "-", [(500, 540), (600, 640)], "", "", "") for i in range(40)]
    m = spark.createDataFrame(models, MODELS)
    reads = spark.createDataFrame([(f"r{i}", 0, "c", 9, 60, "80M", False, i % 2 == 0) for i in range(80)] + [(f"z{i}", 16, "c", 605, 60, "20M", False, True) for i in range(30)], READS)
    got = [tuple(r) for r in assign.assign(reads, annotation.chain_index(m), annotation.single_index(m), annotation.terminal_exons(m)).collect()]
    assert sorted(got) == [("M000", 89)] * 80
    assert compared == [(4, 1), (3, 1)]  # two places on one strand each and one on both, that is four candidates


def test_decisions_reach_every_read_of_their_place(spark):
    m = spark.createDataFrame([(0, "A", "", "c|1", "+", [(1, 100)], "", "", "")], MODELS)
    rows = assign.located(spark.createDataFrame([("a", 0, "c|1", 0, 60, "90M", False, True), ("b", 0, "c|1", 0, 60, "2S90M", False, True), ("c", 16, "c|1", 0, 60, "90M", False, True), ("d", 16, "c|1", 0, 60, "90M", False, False), ("e", 0, "c|1", 0, 60, "40M5N50M", False, True)], READS)).withColumnRenamed("rname", "chromosome")
    best = assign.of_reads(rows, assign.best_overlap(assign.candidates(assign.places(rows)), annotation.single_index(m)))
    assert sorted((r["read_id"], r["tx_strand"], r["transcript_id"], r["shared"]) for r in best.collect()) == [("a", "+", "A", 90), ("b", "+", "A", 90), ("d", "+", "A", 90)]


def test_alignment_strings_without_an_intron_have_no_chain(spark):
    got = spark.createDataFrame([("5S10M2D3I4=", 0), ("3M2N4M1D1X7N1M", 10), ("*", 0)], "c string, p int")
    assert [tuple(r) for r in got.select(cigar.junction_chain(got.c, got.p), cigar.reference_length(got.c)).collect()] == [(None, 16), ([13, 16, 21, 29], 19), (None, 0)]


def test_pairs_of_stacked_intervals_are_compared_once_and_all_given(spark, compared, monkeypatch):
    monkeypatch.setattr(assign, "BLOCK", 4)
    left = spark.createDataFrame([("c", f"l{i}", 1, 50) for i in range(9)] + [("c", "far", 4000, 4001)], "k string, l string, a1 int, a2 int")
    right = spark.createDataFrame([("c", f"r{i}", 40, 2000) for i in range(11)] + [("d", "other", 1, 2)], "k string, r string, b1 int, b2 int")
    got = [(x["l"], x["r"]) for x in assign.interval_pairs(left, right, ["k"], ("a1", "a2"), ("b1", "b2"), ("l", "r")).collect()]
    assert sorted(got) == sorted((f"l{i}", f"r{j}") for i in range(9) for j in range(11))
    assert compared == [(2, 2)]
