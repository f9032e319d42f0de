import itertools
import math
import time

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terminus.operators import unify
from terminus.staging import freed, staged

# Two samples of one tissue, a worked example with published results.
LEAF = [("T1", "G1", "+", 1000, 30), ("T1", "G1", "+", 1300, 10), ("T2", "G1", "+", 1003, 20), ("T2", "G1", "+", 1302, 5), ("T3", "G2", "-", 2000, 60), ("T4", "G3", "+", 3000, 12)]
ROOT = [("T1", "G1", "+", 1004, 25), ("T1", "G1", "+", 1303, 5), ("T2", "G1", "+", 1000, 24), ("T2", "G1", "+", 1301, 6), ("T3", "G2", "-", 1995, 20), ("T3", "G2", "-", 2300, 10)]


@pytest.fixture(scope="module")
def rows(spark):
    own = [(t, g, g.replace("G", "Gene"), "NC_000001.11", s, str(p), str(c), "mRNA", "tissue", n, f"tissue/{n}/{n}.txt", i) for i, (n, (t, g, s, p, c)) in enumerate([("leaf", r) for r in LEAF] + [("root", r) for r in ROOT])]
    raw = spark.createDataFrame(own, "transcript_id string, gene_id string, gene_name string, chromosome string, strand string, site_position string, site_count string, transcript_biotype string, sample_attribute string, sample string, sample_id string, ingest_seq long")
    return unify.normalized(unify.strict(raw)).where(unify.drop_reason().isNull())


def test_worked_example(rows):
    out = unify.unify(rows)
    got = {r.cluster_key: r for r in out["summary"].collect()}
    want = {
        "NC_000001.11|G1|+|1": (1000, 1.0, 2, "99", 2, "54", 3, 1001.62, 1.80, "4", "T1:55,T2:44", "99", 0.8, 1000, 1004),
        "NC_000001.11|G1|+|2": (1300, 1.0, 2, "26", 1, "10", 4, 1301.19, 1.14, "2", "T1:15,T2:11", "26", 0.2, 1300, 1303),
        "NC_000001.11|G2|-|1": (2000, 1.0, 2, "80", 1, "60", 2, 1998.75, 2.17, "5", "T3:80", "80", 1.0, 1995, 2000),
    }
    assert set(got) == set(want)
    for k, w in want.items():
        r = got[k]
        assert (r.mode_site_position, r.mode_score, r.mode_local_n_samples, r.mode_local_total_site_count, r.mode_exact_n_samples, r.mode_exact_total_site_count, r.n_unique_positions, r.weighted_mean_position, r.weighted_position_sd, r.position_iqr, r.transcript_cluster_counts, r.total_site_count, r.median_cluster_relative_abundance, r.cluster_start, r.cluster_end) == w
        assert (r.n_samples, r.n_tissues, r.n_cell_cultures, r.sample_list) == (2, 2, 0, "Leaf,Root")
    assert out["detailed"].count() == 10
    gone = {r.cluster_key: r for r in out["filtered_out"].collect()}
    assert set(gone) == {"NC_000001.11|G2|-|1", "NC_000001.11|G3|+|0"}
    assert {r.filter_reason for r in gone.values()} == {"fewer_than_2_transcript_sample_observations_with_count_ge_5_and_max_observation_lt_50_or_relative_abundance_lt_0.25"}
    assert all(r.median_cluster_relative_abundance is None for r in gone.values())
    share = {(r.transcript_id, r["sample"], r.cluster_key[-1]): r.cluster_relative_abundance for r in out["detailed"].collect()}
    assert share[("T1", "Root", "1")] == 0.8333 and share[("T1", "Root", "2")] == 0.1667 and share[("T3", "Root", "1")] == 1.0
    assert out["unfiltered"].count() == 12


def test_only_tables_that_are_asked_for_are_made(rows, monkeypatch):
    made = []
    monkeypatch.setattr(unify, "staged", lambda df, name: made.append(name) or staged(df, name))
    numbered = unify.gap_clusters(unify.evidence(rows))
    assert unify.unify(rows, numbered=numbered)["unfiltered"].count() == 12
    assert made == ["numbered", "detailed", "whole"]
    whole = unify.unify(rows, numbered=numbered)
    whole["summary"], whole["filtered_out"]
    assert made.count("kept") == made.count("verdicts") == 1


def test_evidence_and_tables_of_a_cluster_shuffle_once(rows):
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges(unify.evidence(rows)) == 1
    own = unify.placed(rows, unify.gap_clusters(unify.evidence(rows)))
    assert exchanges(unify.weighted_positions(own)) == exchanges(unify.transcript_counts(own)) == 1


def test_a_gene_in_chunks_is_segmented_alike(spark, rows, monkeypatch):
    rng = np.random.default_rng(4)
    places = np.cumsum(rng.integers(1, 60, 300)).tolist()
    own = [("NC_1", "G", "+", p, f"T{rng.integers(4)}", f"s{rng.integers(3)}", float(rng.integers(1, 80))) for p in places for _ in range(2)]
    many = spark.createDataFrame(own, "chromosome string, effective_gene_id string, strand string, site_position int, transcript_id string, sample_id string, site_count double")
    whole = sorted(map(tuple, unify.segment(many).collect()))
    monkeypatch.setattr(unify, "CHUNK", 5)
    assert sorted(map(tuple, unify.segment(many).collect())) == whole and max(r[4] for r in whole) > 30


def final_plans(monkeypatch) -> list[str]:
    """The plans of staged tables as they were run, filled while tables are staged."""
    plans: list[str] = []

    def watched(df, name):
        df.collect()
        plans.append(f"{name}: {df._jdf.queryExecution().executedPlan().toString().split('== Initial Plan ==')[0]}")
        return staged(df, name)

    monkeypatch.setattr(unify, "staged", watched)
    return plans


def test_segmentation_broadcasts_no_table_of_positions(rows, monkeypatch):
    plans = final_plans(monkeypatch)
    unify.staged(unify.segment(rows, absorb=False), "segments")
    assert len(plans) == 4 and all("isFinalPlan=true" in p for p in plans)
    assert not any("Broadcast" in p for p in plans)


def test_catalogue_broadcasts_only_sums_of_transcripts(rows, monkeypatch):
    plans = final_plans(monkeypatch)
    unify.staged(unify.unify(rows)["summary"], "summary")
    assert {"sums", "cut", "open", "absorbed", "numbered", "detailed", "names", "kept", "summary"} < {p.split(":")[0] for p in plans}
    assert {p.split(":")[0]: p.count("BroadcastHashJoin") for p in plans if "Broadcast" in p} == {"verdicts": 1, "kept": 1}


def test_narrow_tables_are_those_of_the_detailed_table(rows, monkeypatch):
    both = rows.unionByName(rows.where("transcript_id != 'T2'").withColumn("site_count", F.col("site_count") + 1).withColumn("ingest_seq", F.col("ingest_seq") + 100))
    numbered = unify.gap_clusters(unify.evidence(both))
    own = unify.unify(both, numbered=numbered)["detailed"]
    made = {}
    monkeypatch.setattr(unify, "staged", lambda df, name: made.setdefault(name, df.columns) and staged(df, name))
    got = unify.kept(both, numbered, ("ingest_seq", "sample"))
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect())) and a.count() > 0
    assert same(got["rows"], own) and 0 < own.count() < both.count()
    assert same(got["transcripts"], unify.transcript_counts(own)) and same(got["positions"], unify.weighted_positions(own))
    assert made["observations"] == ["cluster_key", "transcript_id", "sample_id", "site_count"] and made["cut"] == [*unify.JOIN_KEY, "cluster_key"]
    assert "detailed" not in made and "kept" not in made and max(map(len, made.values())) <= 8


def test_shuffle_files_of_staged_tables_go(spark):
    statuses = spark._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    freed(spark)
    time.sleep(2)
    before = statuses.size()
    for k in range(4):
        staged(spark.range(1000).selectExpr(f"id % {7 + k} AS k").groupBy("k").count(), "made")
    time.sleep(2)
    assert statuses.size() <= before + 1


def test_weights_reach_the_representative(rows):
    by = lambda **o: {r.cluster_key: r.mode_site_position for r in unify.unify(rows, **o)["summary"].collect()}
    even = by(representative={"mode_sample_weight": 0.0, "mode_count_weight": 1.0, "reach": 0})
    assert by()["NC_000001.11|G1|+|1"] == 1000 and even["NC_000001.11|G1|+|1"] == 1000
    assert {r.mode_local_n_samples for r in unify.unify(rows, representative={"reach": 0})["summary"].collect()} == {1, 2}


def test_other_strategies(rows):
    assert unify.unify(rows, strategy="none")["summary"].count() == 5
    got = {r.cluster_key: (r.filter_passed, r.filter_pass_rule, r.filter_reason) for r in unify.unify(rows, strategy="transcript-totals")["verdicts"].collect()}
    assert got["NC_000001.11|G3|+|0"] == (True, "single_transcript_count", "") and got["NC_000001.11|G1|+|1"] == (True, "multi_transcript_count", "")
    assert unify.unify(rows.limit(0))["summary"].count() == 0
    assert unify.resolve_cutoff("auto", 3) == 30 and unify.resolve_cutoff("auto", 9) == 50 and unify.resolve_cutoff("7", 1) == 7
    for bad in ("-1", "1.5"):
        with pytest.raises(ValueError):
            unify.resolve_cutoff(bad, 1)


def test_bad_rows_end_the_job(spark, rows):
    from pyspark.sql import functions as F

    for column, value in (("site_position", "1.5"), ("site_position", "nan"), ("site_count", "0"), ("strand", "."), ("chromosome", " "), ("transcript_id", None)):
        with pytest.raises(Exception, match=f"invalid {column}"):
            unify.strict(rows.withColumn(column, F.lit(value).cast("string"))).collect()


def cost(x, w, cuts, penalty):
    total = 0.0
    for a, b in zip(cuts, [*cuts[1:], len(x)]):
        m = np.average(x[a:b], weights=w[a:b])
        total += penalty + np.average((x[a:b] - m) ** 2, weights=w[a:b])
    return total


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 90), st.integers(1, 9)), min_size=1, max_size=9, unique_by=lambda t: t[0]), st.sampled_from([5.0, 60.0, 225.0]))
def test_segmentation_is_optimal(points, penalty):
    points.sort()
    x, w = np.array([p for p, _ in points], float), np.array([c for _, c in points], float)
    got = unify.partition(x, w, 40, 24, penalty, 1.0)
    best = math.inf
    for r in range(len(x)):
        for inner in itertools.combinations(range(1, len(x)), r):
            cuts = [0, *inner]
            ok = all(x[b - 1] - x[a] + 1 <= 40 and (np.diff(x[a:b]) <= 24).all() for a, b in zip(cuts, [*inner, len(x)]))
            if ok:
                best = min(best, cost(x, w, cuts, penalty))
    assert got[0] == 0 and cost(x, w, got, penalty) == pytest.approx(best)


def test_absorption():
    obs = pd.DataFrame([("T1", "a", 100, 60.0), ("T1", "b", 100, 60.0), ("T1", "a", 120, 2.0), ("T1", "a", 150, 1.0), ("T1", "a", 190, 9.0)], columns=["transcript_id", "sample_id", "site_position", "site_count"])
    clusters = lambda: [[100], [120], [150], [190]]
    assert unify.absorb(clusters(), obs, 40, 24, 5, 50, 0.25) == [[100, 120], [150], [190]]
    assert unify.absorb(clusters(), obs, 20, 24, 5, 50, 0.25) == clusters()
    assert unify.absorb(clusters(), obs, 40, 10, 5, 50, 0.25) == clusters()
