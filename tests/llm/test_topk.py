import math
import random

import numpy as np

from terminus.llm import topk
from terminus.llm.topk import best, products, search


def brute(rows):
    own = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(own):
        if i % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(own) if b != a)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:5])]
    return sorted(out)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "SLICE", 16)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) * (1 + i % 7) for _ in range(24)]) for i in range(700)]
    rows += [(i, [0.5] * 24) for i in range(700, 820)] + [(850, [0.0] * 24), (900, [-1.0] * 24), (950, rows[3][1])]
    rows += [(1000, None), (1001, [1.0, None]), (1050, [float("nan")] * 24), (1100, [1.0, 2.0]), (1150, []), (None, [9.0] * 24), (100, rows[100][1]), (100, rows[100][1])]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<double>, norm double")
    assert sorted(map(tuple, search(frame).collect())) == brute(rows)
    assert search(frame.limit(0)).count() == 0
    assert sorted(map(tuple, search(frame.where("vec_id in (0, 7)")).collect())) == brute([r for r in rows if r[0] in (0, 7)])


def test_pruning_keeps_the_best_and_large_numbers_stay_exact():
    rng = np.random.default_rng(2)
    v = np.round(rng.normal(size=(3000, 32)) * np.linspace(200, 1, 32))
    v = v[np.argsort(-np.linalg.norm(v, axis=1))]
    q = np.round(rng.normal(size=(20, 32)) * np.linspace(200, 1, 32))
    hits, _ = best(q, np.arange(20) - 100, np.full(20, -np.inf), v, np.arange(3000), np.arange(3000), np.linalg.svd(v)[2].T)
    score = q @ v.T
    for i in range(20):
        assert [x for j, _, x in hits if j == i] == sorted(score[i], reverse=True)[:5]
    big = np.array([[float(1 << 30), 1.0]])
    assert products(big, big)[0, 0] == (1 << 60) + 1
