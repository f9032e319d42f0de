import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terminus.functions import folds
from terminus.operators import sites, unify


@pytest.mark.parametrize("penalty,compactness", [(5.0, 1.0), (225.0, 1.0), (0.0, 0.0)])
def test_the_fold_cuts_as_the_plain_loop_does(spark, penalty, compactness):
    rng, rows = random.Random(3), []
    for k, n in enumerate([1, 1, 2, 3, 7, 40, 255, 256, 257, 600] * 3):
        x = np.cumsum([rng.randint(1, rng.choice([2, 9, 40])) for _ in range(n)]).tolist()
        rows.append((k, [(p, rng.choice([1e-6, 0.1, 0.3, 1.0, rng.random()])) for p in x]))
    df = spark.createDataFrame(rows, "k int, points array<struct<x:int,w:double>>")
    got = {r["k"]: r["s"] for r in df.select("k", folds.starts(F.col("points"), 40, 24, penalty, compactness).alias("s")).collect()}
    for k, points in rows:
        cuts = unify.partition(np.array([float(p) for p, _ in points]), np.array([w for _, w in points]), 40, 24, penalty, compactness)
        assert got[k] == [a for a, b in zip(cuts, [*cuts[1:], len(points)]) for _ in range(a, b)]


def test_a_fold_over_many_items_and_none(spark):
    df = spark.range(1).select(F.sequence(F.lit(1), F.lit(1000)).alias("a"))
    total = lambda items: folds.folded(items, F.lit(0), lambda s, i: (s + i).cast("int"), lambda s: s)
    assert df.select(total(F.col("a")).alias("r")).first()["r"] == np.cumsum(range(1, 1001)).tolist()


def test_greedy_peaks_are_those_of_the_loop(spark):
    rng, rows, want = np.random.default_rng(7), [], set()
    for t in range(40):
        k = int(rng.integers(2, 5))
        x = np.sort(np.concatenate([rng.normal(rng.integers(0, 300), 6, int(rng.integers(5, 60))) for _ in range(k)]).round().astype(int))
        x, w = np.unique(x, return_counts=True)
        mean = np.sort(rng.integers(0, 300, k)).astype(float)
        model = (mean, np.full(k, 50.0), np.full(k, 1 / k))
        label = sites.components(model, x.astype(float))
        rows += [(f"T{t}", int(c), int(p), int(n)) for c, p, n in zip(label, x, w)]
        found = sites.peaks(x, w, model, 10, 50, 0.3, 0.5)
        want |= {(f"T{t}", p, n) for p, n in found}
    got = {tuple(r) for r in sites.greedy_peaks(spark.createDataFrame(rows, "transcript_id string, component int, site_position int, n long")).collect()}
    lone = {t for t in {r[0] for r in rows} if t not in {g[0] for g in got}}  # the loop falls back to the mode where no peak is good
    assert got == {w for w in want if w[0] not in lone} and len(lone) < 20
