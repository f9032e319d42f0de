import numpy as np
import pytest

from terminus.functions import cuts
from terminus.operators import unify


@pytest.mark.parametrize("penalty,compactness", [(5.0, 1.0), (225.0, 1.0), (0.0, 0.0)])
def test_chunks_cut_together_are_cut_as_by_the_plain_loop(penalty, compactness):
    rng = np.random.default_rng(3)
    chunks = []
    for n in [1, 1, 2, 3, 7, 40, 255, 256, 257, 600] * 3:
        chunks.append((np.cumsum(rng.integers(1, rng.choice([2, 3, 9, 40]), n)) - 5, rng.choice([1e-6, 0.1, 0.3, 1.0], n)))
    x, w = (np.concatenate(c) for c in zip(*chunks))
    got = cuts.starts(x, w, np.array([len(p) for p, _ in chunks]), 40, 24, penalty, compactness)
    want, before = [], 0
    for p, v in chunks:
        first = unify.partition(p.astype(float), v, 40, 24, penalty, compactness)
        want += [before + a for a, b in zip(first, [*first[1:], len(p)]) for _ in range(a, b)]
        before += len(p)
    assert got.tolist() == want


def test_groups_stay_whole_over_batches():
    import pyarrow as pa

    key = np.repeat(np.arange(9), [1, 5, 2, 30, 1, 1, 4, 8, 3])
    rows = pa.record_batch([pa.array([f"k{k}" for k in key]), pa.array(np.arange(len(key)))], names=["k", "n"])
    got = list(unify.whole((rows.slice(i, 4) for i in range(0, len(key), 4)), 1, 6))
    assert [v for x, _ in got for v in x.column(1).to_pylist()] == list(range(len(key))) and len(got) > 2
    assert [k for x, at in got for k in x.column(0).take(pa.array(at)).to_pylist()] == [f"k{k}" for k in range(9)]
    assert list(unify.whole(iter([]), 1)) == []


def test_only_open_runs_reach_python_and_nothing_is_lost(spark, monkeypatch):
    import pandas as pd

    rng = np.random.default_rng(6)
    names = ["chromosome", "effective_gene_id", "strand", "site_position", "transcript_id", "sample_id", "site_count"]
    rows = []
    for g in range(6):
        for p in np.cumsum(rng.integers(1, rng.choice([4, 26, 60]), 200)).tolist():
            rows += [("NC_1", f"G{g}", "+", p, f"T{rng.integers(3)}", f"s{rng.integers(3)}", float(n)) for n in rng.choice([1, 1, 2, 60], rng.integers(1, 4))]
    frame = pd.DataFrame(rows, columns=names)
    o = unify.SEGMENT | {"penalty": 20.0}
    cut = {(r.effective_gene_id, r.site_position): r.cluster_number for r in unify.segment(spark.createDataFrame(frame), penalty=20.0, absorb=False).collect()}
    want, moved = {}, 0
    for g, obs in frame.groupby("effective_gene_id"):
        obs = obs.groupby(["transcript_id", "sample_id", "site_position"], as_index=False)["site_count"].sum()
        places = sorted(obs["site_position"].unique().tolist())
        clusters = [[p for p in places if cut[g, p] == k] for k in sorted({cut[g, p] for p in places})]
        n = len(clusters)
        clusters = unify.absorb(clusters, obs, o["max_cluster_width"], o["max_internal_gap"], o["min_observation_count"], o["strong_count"], o["strong_abundance"])
        moved += n - len(clusters)
        want |= {(g, p): k for k, c in enumerate(clusters) for p in c}
    sent = []
    real = unify.open_runs
    monkeypatch.setattr(unify, "open_runs", lambda *a: sent.append(real(*a)) or sent[-1])
    got = {(r.effective_gene_id, r.site_position): r.cluster_number for r in unify.segment(spark.createDataFrame(frame), penalty=20.0).collect()}
    assert got == want and moved > 10
    assert sent[0].count() < len(set(cut.items())) / 3
