import random
import zlib

import numpy as np
import pytest

from terminus.llm.language import BUCKETS, counts, fit, identify, temperature, vector


def test_held_out_accuracy(spark):
    from terminus.llm.common import table

    docs = table(spark, "/root/testdata/sf0.01", "documents")
    truth = {r.doc_id: r for r in docs.collect()}
    got = identify(docs).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id].lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "and"] if i % 2 else ["der", "und"]) for _ in range(20)), "en" if i % 2 else "de", 3) for i in range(60)]
    rows += [(60, None, "en", 1), (61, "", None, 1), (62, "12 3!", "de", 1), (63, "der und", None, 1), (64, "the " * 60000, None, 1), (None, "the and", "en", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in identify(frame).collect()}
    assert len(got) == len(rows)
    assert [got[i].lang_pred for i in (60, 61, 62, 63, 64)] == ["und", "und", "und", "de", "en"]
    assert identify(frame.limit(0)).count() == 0
    assert {r.lang_pred for r in identify(frame.withColumn("lang", frame.lang.substr(9, 1)).where("lang = 'q'")).collect()} == set()


def test_weights_are_sparse_and_temperature_calibrates():
    rng = np.random.default_rng(1)
    x = [vector(counts("".join(rng.choice(list("abc" if i % 2 else "abd"), 40))), np.ones(BUCKETS)) for i in range(200)]
    y = np.arange(200) % 2
    w = fit(x, y, 2)
    assert 0 < (w != 0).mean() < 0.2
    z = rng.normal(size=(4000, 3))
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    lab = np.array([rng.choice(3, p=q) for q in p])
    assert temperature(4 * z, lab) == pytest.approx(4, rel=0.15)
