from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from terminus.llm.common import table


def test_stages_keep_columns_and_decide(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf).cache()
        assert sorted(after.columns) == sorted(docs.columns), name
        assert after.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
        if name != "suffix_array_dedup":
            assert after.exceptAll(before).count() == 0
        else:
            assert after.count() == before.count()
            assert after.where("n_chars != length(text)").count() == 0
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, sf).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in before.collect()}
    full = Counter()
    for r in last:
        full[r.sequence_id] += r.length
    assert max(full.values()) <= 1024
    labels = table(spark, sf, "labels")
    clean = docs.join(labels.where("quality = 1"), "doc_id").where(F.length("text") > 400).select("doc_id")
    first = corpus_pipeline.quality_rules(spark, docs, sf)
    assert clean.join(first, "doc_id", "left_anti").count() <= 0.03 * clean.count()


def test_empty_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs_out = stage(spark, docs, sf)
        assert docs_out.count() == 0


def edges():
    long_ = " ".join(f"word{i}" for i in range(30_000))
    plain = " ".join(f"plain{i % 97}{i % 89} and" for i in range(40))
    return [None, "", "   ", plain, plain, plain + " more", long_, "été " * 3, "\n\n"]


def test_clashing_columns_and_odd_texts_pass_every_stage(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(i if i % 4 else None, t, "en" if i % 2 else None, "s", len(t or ""), *["own"] * 8) for i, t in enumerate(edges() * 2)]
    names = "_own string, _sig string, _kept string, _copies string, kept_id string, __score string, __lang_pred string, __q_n_words string"
    more = " string, ".join(("own", "sig", "kept", "copies", "one", "score", "lang_pred", "q_n_words", "q_kept", "in_0", "first_id", "own_hash", "hash", "node", "name", "row", "part", "raw")) + " string"
    frame = spark.createDataFrame([(*r, *["x"] * 18) for r in rows], f"doc_id long, text string, lang string, source string, n_chars int, {names}, {more}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, sf)
        assert out.columns == frame.columns, name
        got = out.collect()
        assert all(r["_own"] == "own" and r["q_kept"] == "x" and r["raw"] == "x" and r["n_chars"] == len(r["text"] or "") for r in got), name
        if name == "suffix_array_dedup":
            assert len(got) == len(rows)
        if name == "simhash_near_dedup":  # null and blank texts; plain and plain with a word more; the long one; été; by text where doc_id is null
            assert len(got) == 4
    assert corpus_pipeline.STAGES[-1][1](spark, frame, sf).where("piece = 0").count() == len(rows)


def test_session_options_are_as_before(spark):
    sf = "/root/testdata/sf0.001"
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(k) for k in keys]
    corpus_pipeline.run(spark, sf).count()
    assert [spark.conf.get(k) for k in keys] == before
