import csv
import random
from pathlib import Path

import pytest

from terminus import sinks
from terminus.plans import commands
from terminus.sources import annotation, tables
from tests.test_unify import LEAF, ROOT

HEAD = "transcript_id\tgene_id\tgene_name\tchromosome\tstrand\tsite_position\tsite_count\tsite_abundance\ttranscript_biotype"


def rows_of(path):
    if Path(path).is_dir():
        return [r for p in sorted(Path(path).glob("part-*")) for r in rows_of(p)]
    with open(path) as f:
        return list(csv.DictReader(f, delimiter="\t"))


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    base = tmp_path_factory.mktemp("made") / "Demo_species"
    for name, rows in (("leaf", LEAF), ("root", ROOT)):
        (base / "tissue" / name).mkdir(parents=True)
        lines = [f"{t}\t{g}\t{g}\tNC_000001.11\t{s}\t{p}\t{c}\t1.0\tmRNA" for t, g, s, p, c in rows]
        (base / "tissue" / name / f"{name}.apa_sites.txt").write_text("\n".join([HEAD, *lines]) + "\n")
    rng = random.Random(1)
    seq = [rng.choice("CG") for _ in range(4000)]
    for at, m in ((980, "AATAAA"), (1280, "AATAAA"), (2015, "TTTATT")):
        seq[at - 1 : at + 5] = m
    text = "".join(seq)
    (base.parent / "ref.fa").write_text(">NC_000001.11 made\n" + "\n".join(text[i : i + 80] for i in range(0, 4000, 80)) + "\n")
    return base


def test_unify_then_annotate(spark, base):
    out = commands.unify_folder(spark, str(base), str(base.parent / "out"), write_unfiltered=True)
    parts = commands.unify_folder(spark, str(base), str(base.parent / "parts"), parts=True, mode_sample_weight=1, mode_count_weight=3, mode_support_window=3)
    whole = spark.read.option("sep", "\t").option("header", True).csv
    assert whole(parts["sites"]).count() == whole(out["sites"]).count() and whole(parts["sites"]).columns == whole(out["sites"]).columns
    assert len(rows_of(out["sites"])) == 10 and len(rows_of(out["unfiltered"])) == 12
    assert sorted(r["mode_site_position"] for r in rows_of(out["summary"])) == ["1000", "1300", "2000"]
    assert len(rows_of(out["filtered_out"])) == 2
    path = commands.annotate_file(spark, out["sites"], str(base.parent / "ref.fa"), str(base.parent / "anno.txt"), model="LAND_PLANT")
    got = rows_of(path)
    assert len(got) == 3 and len(got[0]) == 19
    assert all((r["pas_motif"], r["pas_position"], r["pas_type"], r["motif_model"], r["n_samples"], r["pa_level"], len(r["sequence"])) == ("AATAAA", "-20", "plant_nue", "land_plant", "2", "PAS-L1", 101) for r in got)
    with pytest.raises(ValueError):
        commands.annotate_file(spark, out["sites"], str(base.parent / "ref.fa"), out["sites"], model="LAND_PLANT")
    with pytest.raises(ValueError):
        commands.unify_folder(spark, str(base), str(base.parent / "o2"), min_cluster_samples=0)
    with pytest.raises(ValueError):
        commands.unify_folder(spark, str(base), str(base.parent / "o2"), pattern="../x")


def test_call(spark, tmp_path):
    rng = random.Random(2)
    (tmp_path / "ref.fa").write_text(">c1\n" + "".join(rng.choice("CGT") for _ in range(3000)) + "\n>c2\n" + "ACGT" * 500 + "\n")
    gtf = ["# made"]
    gtf += ['c1\tx\texon\t101\t200\t.\t+\t.\tgene_id "G1"; transcript_id "T1"; db_xref "GeneID:77"; transcript_biotype "mRNA";', 'c1\tx\texon\t301\t500\t.\t+\t.\tgene_id "G1"; transcript_id "T1";', 'c1\tx\texon\t1001\t1200\t.\t-\t.\tgene_id "G2"; transcript_id "T2";']
    (tmp_path / "a.gtf").write_text("\n".join(gtf) + "\n")
    sam = ["@HD\tVN:1.6"]
    sam += [f"a{i}\t0\tc1\t151\t60\t50M100N200M\t*\t0\t0\t*\t*" for i in range(30)]
    sam += [f"b{i}\t16\tc1\t1001\t60\t190M\t*\t0\t0\t*\t*" for i in range(20)]
    sam += ["x\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*", "y\t256\tc1\t1001\t60\t190M\t*\t0\t0\t*\t*", "z\t0\tc1\t1001\t0\t190M\t*\t0\t0\t*\t*", "w\t0\tc1\t1001\t60\t190M\t*\t0\t0\t*\t*\tSA:Z:c2,1,+,5M,1,0;"]
    (tmp_path / "r.sam").write_text("\n".join(sam) + "\n")
    (tmp_path / "m.tsv").write_text("fastq\tplatform\nr.sam\tdRNA\n")
    inputs = tables.manifest((tmp_path / "m.tsv").read_text(), str(tmp_path), lambda p: sinks.exists(spark, p))
    assert inputs == [(str(tmp_path / "r.sam"), "dRNA")]
    out = commands.call(spark, str(tmp_path / "a.gtf"), str(tmp_path / "ref.fa"), inputs, str(tmp_path / "out"))
    got = {r["transcript_id"]: r for r in rows_of(out["sites"])}
    assert got["T1"]["site_position"] == "500" and got["T1"]["gene_id"] == "77" and got["T1"]["ID"] == "c1:500:+" and got["T1"]["site_count"] == "30"
    assert got["T2"]["site_position"] == "1001" and got["T2"]["site_count"] == "20" and got["T2"]["site_abundance"] == "1.0000"
    assert rows_of(out["removed"]) == [] and "2 transcripts" in open(out["summary"]).read()
    assert open(out["bed"]).read().splitlines() == ["c1\t100\t500\tT1\t0\t+\t100\t500\t0\t2\t100,200,\t0,200,", "c1\t1000\t1200\tT2\t0\t-\t1000\t1200\t0\t1\t200,\t0,"]
    assert commands.call(spark, str(tmp_path / "a.gtf"), str(tmp_path / "ref.fa"), inputs, str(tmp_path / "out")) == out
    with pytest.raises(ValueError):
        commands.call(spark, str(tmp_path / "a.gtf"), str(tmp_path / "ref.fa"), inputs, str(tmp_path / "out"), min_mapq=2)


def test_streamed_ends_equal_batch(spark, tmp_path):
    from terminus.operators import assign
    from terminus.streaming import ends

    m = annotation.gtf_models(spark.createDataFrame([(1, 'c1\tx\texon\t1001\t1200\t.\t-\t.\tgene_id "G2"; transcript_id "T2";'), (2, 'c1\tx\texon\t1\t5\t.\t+\t.\tgene_id "G"; transcript_id "T3";'), (3, 'c1\tx\texon\t8\t9\t.\t+\t.\tgene_id "G"; transcript_id "T3";')], "line_no long, value string"))
    index = annotation.chain_index(m), annotation.single_index(m), annotation.terminal_exons(m)
    (tmp_path / "in").mkdir()
    for part in range(3):
        (tmp_path / "in" / f"{part}.sam").write_text("".join(f"{part}b{i}\t16\tc1\t1001\t60\t190M\t*\t0\t0\t*\t*\n" for i in range(8)))
        ends.append_ends(ends.alignments(spark, str(tmp_path / "in")), *index, str(tmp_path / "ends"), str(tmp_path / "cp")).awaitTermination()
    got = ends.collected(spark, str(tmp_path / "ends"))
    want = assign.assign(tables.sam(spark.read.text(str(tmp_path / "in"))).selectExpr("*", "false AS oriented"), *index)
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count() == 24
    assert [r.site_position for r in ends.call_sites(spark, str(tmp_path / "ends")).collect()] == [1001]


def test_manifests():
    read = lambda t: tables.manifest(t, "/d")
    assert read('﻿# c\n\n"a b.sam" drna\n/x.sam\n') == [("/d/a b.sam", "drna"), ("/x.sam", "")]
    assert read("fastq_path\tlibrary_type\na\t\n") == [("/d/a", "")]
    for bad in ("a b c\n", "a\na\n"):
        with pytest.raises(ValueError):
            read(bad)
    with pytest.raises(FileNotFoundError):
        tables.manifest("a\n", "/d", lambda p: False)


def test_faulty_sequences(spark, tmp_path):
    (tmp_path / "f.fa").write_text(">a\nACGT\nAC\nACGT\n>b\nACGT\nAC\n>b\nAXQ\n>c\n\n>d\nAC\nACGT\n")
    f = tables.fasta_files(spark, str(tmp_path / "f.fa"))
    assert {tuple(r) for r in tables.fasta_faults(f).collect()} >= {("b", "repeated"), ("c", "empty")}
    assert {r[0] for r in tables.wrapping_faults(spark, str(tmp_path / "f.fa")).collect()} >= {"a", "d"}
    assert tables.species_key("/x/Homo_sapiens_unified_apa_sites.txt") == "Homo_sapiens" and tables.species_key("/x/Mus musculus/t.txt") == "Mus_musculus"
