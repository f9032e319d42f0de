import random

import pytest
from pyspark.sql import functions as F

from terminus.functions import cigar, sequence
from terminus.operators import annotate, assign
from terminus.plans import commands
from terminus.sources import annotation, tables


def motif(spark, model, context, start=-150, **more):
    own = spark.createDataFrame([(context, start)], "s string, c int")
    return own.select(annotate.motif(F.col("s"), F.col("c"), model, **more).alias("m")).first().m


def at(**places):
    """A context of C from -150 to 60 with motifs at places relative to the site."""
    s = ["C"] * 211
    for m, p in places.items():
        m = m.rstrip("_")
        s[p + 150 : p + 150 + len(m)] = m
    return "".join(s)


def test_steps_of_each_model(spark):
    def got(model, **places):
        r = motif(spark, model, at(**places))
        return r.motif, r.position, r.motif_type, r.motif_support

    assert got("MAMMALIAN", ATTAAA=-40, AATAAA=-20) == ("AATAAA", -20, "canonical", "primary")
    assert got("MAMMALIAN", AATAAA=-5, AGTAAA=-30) == ("AGTAAA", -30, "variant", "primary")
    assert got("MAMMALIAN", AATAAA=-41, TGTG=1)[2:] == ("downstream", "auxiliary")
    assert got("MAMMALIAN", TATA=-4)[2:] == ("upstream", "auxiliary") and got("MAMMALIAN")[2:] == ("none", "none")
    assert got("LAND_PLANT", AATGAA=-15) == ("AATGAA", -15, "plant_nue", "primary") and got("LAND_PLANT", TTGTT=-34)[2:] == ("plant_fue", "auxiliary")
    assert got("BUDDING_YEAST", TATATA=-60, AAGAA=-20) == ("AAGAA", -20, "yeast_ee_pe", "primary")
    assert got("BUDDING_YEAST", AAGAA=-20)[2:] == ("yeast_positioning", "auxiliary") and got("BUDDING_YEAST", TATATA=-45)[2:] == ("yeast_efficiency", "auxiliary")
    assert got("BUDDING_YEAST", TTTCTT=-3)[:3] == ("TTTCTT", -3, "yeast_u_rich")
    assert got("FISSION_YEAST", TAATAT=-30)[2:] == ("pombe_a_rich", "primary") and got("FISSION_YEAST", AAGTAG=15)[2:] == ("pombe_gua_uag", "auxiliary")
    assert got("FISSION_YEAST", ATTTAG=-80)[2:] == ("pombe_uag", "auxiliary") and got("FISSION_YEAST", GTATTT=30)[2:] == ("pombe_gua", "auxiliary") and got("FISSION_YEAST", TTTTTT=-3)[2:] == ("pombe_u_rich", "auxiliary")
    r = motif(spark, "NOT_ASSESSED", at(AATAAA=-20))
    assert (r.motif_support, r.cleavage_context, r.u_rich_fraction) == ("not_assessed", "", None)
    with pytest.raises(ValueError):
        motif(spark, "OTHER", at())


def test_contexts_on_both_strands(spark):
    rng = random.Random(1)
    seq = "".join(rng.choice("ACGTN") for _ in range(9000))
    comp = str.maketrans("ACGTN", "TGCAN")
    rows = [("1", s, p) for s in "+-" for p in (1, 2, 61, 62, 150, 151, 4090, 4096, 4097, 8999, 9000)]
    tiles = tables.tiles(spark.createDataFrame([("chr1", seq)], "chromosome string, sequence string"))
    got = annotate.contexts(spark.createDataFrame(rows, "chromosome string, strand string, mode_site_position int"), tiles).collect()
    assert len(got) == len(rows)
    for r in got:
        p = r.mode_site_position - 1
        if r.strand == "+":
            a, b = max(0, p - 150), min(9000, p + 61)
            want = seq[a:b], a - p
        else:
            a, b = max(0, p - 60), min(9000, p + 151)
            want = seq[a:b].translate(comp)[::-1], p - (b - 1)
        assert (r.context, r.context_start) == want
    off = annotate.contexts(spark.createDataFrame([("2", "+", 5), ("1", "+", 9001)], "chromosome string, strand string, mode_site_position int"), tiles)
    assert {r.context for r in off.collect()} == {None}


def test_cigars(spark):
    own = spark.createDataFrame([("5M10N3D2I4M", 100), ("10M5I3S", 7), ("3S4=2X1N6M", 0), ("*", 5)], "c string, p int")
    got = [tuple(r) for r in own.select(cigar.junction_chain(F.col("c"), F.col("p")), F.col("p") + cigar.reference_length(F.col("c"))).collect()]
    assert got == [([105, 116], 122), (None, 17), ([6, 8], 13), (None, 5)]


def test_assignment_rules(spark):
    lines = ["c\tx\texon\t101\t200", "c\tx\texon\t301\t400"]
    gtf = [f'{e}\t.\t{s}\t.\ttranscript_id "{t}"; gene_id "g";' for t, s in (("old", "+"), ("new", "-")) for e in lines]
    gtf += [f'c\tx\texon\t{a}\t{b}\t.\t{s}\t.\ttranscript_id "{t}"; gene_id "g";' for t, a, b, s in (("p", 1001, 1100, "+"), ("m", 1001, 1100, "-"), ("q", 2001, 2100, "+"), ("long", 2001, 2300, "+"))]
    gtf += [f'c\tx\texon\t{a}\t{b}\t.\t+\t.\ttranscript_id "end"; gene_id "g";' for a, b in ((5001, 5050), (2051, 2150))][::-1]
    m = annotation.gtf_models(spark.createDataFrame(list(enumerate(gtf)), "line_no long, value string"))
    reads = [("spliced", 0, 150, "50M100N50M", True), ("unmatched", 0, 1000, "50M100N50M", False), ("both", 0, 1000, "100M", False), ("oriented", 16, 1000, "100M", True), ("short", 0, 1000, "49M", True), ("half", 0, 1000, "50M", True), ("near", 0, 2000, "60M", True)]
    aln = spark.createDataFrame([(n, f, "c", p, 60, c, False, o) for n, f, p, c, o in reads], "read_id string, flag int, rname string, pos0 int, mapq int, cigar string, has_sa boolean, oriented boolean")
    got = sorted(map(tuple, assign.assign(aln, annotation.chain_index(m), annotation.single_index(m), annotation.terminal_exons(m)).collect()))
    assert got == [("m", 1001), ("new", 151), ("p", 1050), ("q", 2060)]


def test_gff_lineage_and_quoted_text(spark):
    rows = [
        "c\tx\tgene\t1\t900\t.\t+\t.\tID=gene:g1;Name=N%201;gene_biotype=lncRNA;Dbxref=A:1,GeneID:5",
        "c\tx\tprimary_transcript\t1\t900\t.\t+\t.\tID=rna-p;Parent=gene:g1",
        "c\tx\tmiRNA\t1\t30\t.\t+\t.\tID=mi;Parent=rna-p;Name=a+b",
        "c\tx\tmRNA\t1\t900\t.\t+\t.\tID=transcript:t;Parent=gene:none",
        "c\tx\texon\t1\t30\t.\t+\t.\tParent=mi,rna-p",
        "c\tx\texon\t50\t90\t.\t+\t.\tParent=transcript:t",
        "c\tx\texon\t50\t90\t.\t+\t.\tParent=lost",
        "c\tx\tCDS\t50\t90\t.\t+\t.\tID=cds;Parent=transcript:t",
        "c\tx\tmRNA\tx\t900\t.\t+\t.\tID=broken",
    ]
    got = {r.transcript_id: r for r in annotation.gff_models(spark.createDataFrame(list(enumerate(rows)), "line_no long, value string")).collect()}
    assert set(got) == {"p", "mi", "t"}
    assert (got["mi"].gene_name, got["mi"].ncbi_gene_id, got["mi"].transcript_biotype, got["mi"].reference_gene_id) == ("N 1", "5", "lncRNA", "gene:g1")
    assert (got["t"].gene_name, got["t"].reference_gene_id, got["t"].ncbi_gene_id) == ("transcript:t", "gene:none", "")


def test_tables_and_settings(spark):
    t = spark.createDataFrame([(0, "ATAGTT", "UAG-containing"), (1, "aagtaa", "GUA-containing"), (2, "AAGTAG", "GUA-UAG-containing"), (3, "ATTAGT", "UAG-containing")], "row int, motif_dna string, motif_family string")
    assert tables.motif_families(t) == {"UAG": ["ATAGTT", "ATTAGT"], "GUA": ["AAGTAA"], "GUA_UAG": ["AAGTAG"]}
    with pytest.raises(ValueError):
        tables.motif_families(t.where("row < 2"))
    assert motif(spark, "FISSION_YEAST", at(GGGGGG=-80), families={"UAG": ["GGGGGG"], "GUA": ["G"], "GUA_UAG": ["GA"]}).motif_type == "pombe_uag"
    assert commands.weights(3, 1) == (0.75, 0.25)
    for bad in ((0, 0), (-1, 2), (float("nan"), 1)):
        with pytest.raises(ValueError):
            commands.weights(*bad)
    with pytest.raises(Exception, match="repeated species"):
        tables.species_models(spark.createDataFrame([("a", "X", "y")] * 2, "species_key string, motif_model_group string, model_status string")).collect()
    assert spark.range(1).select(sequence.reverse_complement(F.lit("AcgTRyN"))).first()[0] == "NrYAcgT"
