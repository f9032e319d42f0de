import json
import logging
from pathlib import Path

import duckdb
import pytest

import jobs
from jobs import motif_scan, site_catalogue
from terminus.operators import unify
from terminus.plans import bindings as B

SF = "/root/testdata/sf0.001"
CONFIG = {n: Path(jobs.__file__).with_name(f"{n}.json").as_uri() for n in ("motif_scan", "site_catalogue")}


def rows(df):
    names = sorted(df.columns)
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


@pytest.fixture
def settings(spark):
    before = {r["key"]: r["value"] for r in spark.sql("SET").collect()}
    yield
    assert {r["key"]: r["value"] for r in spark.sql("SET").collect()} == before


def test_a_growing_folder_gives_the_catalogue_of_all_its_files(spark, tmp_path, settings, caplog):
    caplog.set_level(logging.INFO, "jobs")
    whole = spark.read.parquet(f"{SF}/lineitem.parquet")
    run = lambda: site_catalogue.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), CONFIG["site_catalogue"])
    add = lambda condition, n: whole.where(condition).repartition(n).write.mode("append").parquet(str(tmp_path / "in"))
    o = json.loads(Path(jobs.__file__).with_name("site_catalogue.json").read_text())
    direct = lambda df: rows(site_catalogue.catalogue(df.selectExpr(*o["select"]), o["segmentation"], o["representative"]))

    add("l_orderkey % 3 = 0", 6)  # two batches of files
    first = rows(run())
    assert first == direct(whole.where("l_orderkey % 3 = 0"))
    assert rows(run()) == first and "read 0 new rows" in caplog.text
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "catalogue").rglob("*.parquet")}
    gene = whole.where("l_orderkey % 3 = 1").select("l_suppkey").first()[0]
    add(f"l_orderkey % 3 = 1 AND l_suppkey = {gene} AND l_returnflag = 'N' AND l_linestatus = 'O'", 1)  # a single gene
    second = rows(run())
    now = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "catalogue").rglob("*.parquet")}
    assert len({p.parent for p in files if now.get(p) != files[p]}) == 1 and second != first
    add(f"l_orderkey % 3 <> 0 AND NOT (l_orderkey % 3 = 1 AND l_suppkey = {gene} AND l_returnflag = 'N' AND l_linestatus = 'O')", 2)
    assert rows(run()) == direct(whole)


def test_a_batch_that_runs_again_replaces_what_it_wrote(spark, tmp_path, settings):
    o = json.loads(Path(jobs.__file__).with_name("site_catalogue.json").read_text())
    whole = spark.read.parquet(f"{SF}/lineitem.parquet")
    out = str(tmp_path / "out")
    for number, part in ((0, "l_orderkey % 2 = 0"), (1, "l_orderkey % 2 = 1"), (1, "l_orderkey % 2 = 1")):
        site_catalogue.take(whole.where(part), number, out, o)
    assert rows(site_catalogue.read(spark, out)) == rows(site_catalogue.catalogue(whole.selectExpr(*o["select"]), o["segmentation"], o["representative"]))


def test_files_without_rows_give_an_empty_catalogue(spark, tmp_path):
    spark.read.parquet(f"{SF}/lineitem.parquet").where("false").write.parquet(str(tmp_path / "in"))
    got = site_catalogue.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), CONFIG["site_catalogue"])
    assert got.count() == 0 and set(got.columns) == set(unify.CLUSTER)


def test_motif_scan_reruns_into_its_folder(spark, tmp_path, settings, caplog):
    caplog.set_level(logging.INFO, "jobs")
    run = lambda table: motif_scan.run(spark, table, str(tmp_path / "out"), CONFIG["motif_scan"])
    first = rows(run(f"{SF}/documents.parquet"))
    assert rows(run(f"{SF}/documents.parquet")) == first and f"wrote {len(first)} sites under 4 models" in caplog.text
    n = duckdb.connect().execute(f"SELECT count(*) FROM '{SF}/documents.parquet' WHERE regexp_matches(text, '[A-Za-z]')").fetchone()[0]
    assert len(first) == 8 * n
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {f"motif_model={m}" for m in ("mammalian", "land_plant", "budding_yeast", "fission_yeast")}
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "123", "x"), (4, "q", "x"), (None, "AATAAA" * 50, "x")], "doc_id long, text string, sequence string")
    odd.write.parquet(str(tmp_path / "odd"))
    assert {r[0] for r in run(str(tmp_path / "odd")).select("chromosome").collect()} == {"chr4", None}


def test_sites_are_those_of_the_view(spark, tmp_path):
    o = json.loads(Path(jobs.__file__).with_name("motif_scan.json").read_text())
    own = motif_scan.sites(motif_scan.sequences(spark.read.parquet(f"{SF}/documents.parquet"), o), o["parts"])
    view = B.points(spark, SF).withColumnRenamed("pos", "site_position")
    assert rows(own) == rows(view.select(*own.columns))


def test_letters_are_taken_once_and_rows_without_any_go(spark):
    from jobs import motif_scan

    rows = spark.createDataFrame([(1, "aB-c 9"), (2, "9 -"), (3, None), (4, "zZ"), (5, "é")], "doc_id long, text string")
    own = motif_scan.sequences(rows, {"id": "doc_id", "text": "text", "prefix": "chr", "bases": ["BZ", "T"]})
    assert sorted(map(tuple, own.collect())) == [("chr1", "ATC")]
    assert own._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
