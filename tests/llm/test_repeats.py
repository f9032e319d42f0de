import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from terminus.llm import repeats
from terminus.llm.repeats import LENGTH, PASSAGE, anchors, deduplicate


def marked(raws, length):
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        yield gone


def brute(texts):
    raws, out = [(t or "").encode() for t in texts], []
    for d, (r, gone, short) in enumerate(zip(raws, marked(raws, LENGTH), marked(raws, PASSAGE))):
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        out.append((d, len(r), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(r, gone) if not g)).hexdigest(), sum(short)))
    return out


def cases(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "été", "of", "中文", "x"]) + str(rng.randint(0, 999))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.choice([35, 51, 60, 90, 200])) for _ in range(7)]
    texts = [None, "", "short", "a" * 399, "a" * 400, "b" * 401, "c" * 2000, "ab" * 700, "abc" * 300 + "d" + "abc" * 300]
    for _ in range(60):
        texts.append(" ".join(x for p in rng.sample(passages, rng.randint(0, 3)) for x in (prose(rng.randint(0, 60)), p, prose(rng.randint(0, 60)))))
    base = prose(300)
    for i in range(6):
        w = base.split()
        w[40 * i] = "changed"
        texts.append(" ".join(w))
    return texts + [base, base, texts[12], "a" * 400]


def test_against_brute_force(spark, docs):
    texts = cases(1)
    assert sorted(map(tuple, deduplicate(docs(texts)).collect())) == brute(texts)
    assert deduplicate(docs([])).count() == 0


def test_frequent_anchors_in_shards(spark, docs, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD", 3)
    monkeypatch.setattr(repeats, "PIECE", 100)
    monkeypatch.setattr(repeats, "ROOM", 5000)
    texts = cases(2)
    assert sorted(map(tuple, deduplicate(docs(texts)).collect())) == brute(texts)


def test_one_hash_for_all_strings(spark, docs, monkeypatch):
    """Where every hash is the same, the bytes decide."""
    monkeypatch.setattr(repeats, "mixed", lambda x: x & repeats.np.uint64(0))
    rng = random.Random(5)
    windows = [rng.randbytes(500), rng.randbytes(450)]
    windows.append(windows[0][:420] + b"x")
    _, _, _, alive, first = repeats.refine(windows, repeats.np.zeros(3, int), LENGTH)
    assert alive.tolist() == [*range(21), *range(950, 971)] and sorted(first.tolist()) == [*range(21)]


def test_segments_leave_no_string_out(monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 1000)
    raw = random.Random(3).randbytes(7777)
    _, a, b, _ = anchors(raw, LENGTH)
    assert a[0] == 0 and b[-1] == len(raw) - LENGTH and (a[1:] == b[:-1] + 1).all()


def test_repeated_rows_and_missing_names(spark):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = [(1, text), (1, text), (None, text[:450] + "x" * 10), (None, "y" + text[100:600]), (2, text[:300])]
    frame = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, sig int")
    got = sorted((tuple(r) for r in deduplicate(frame).collect()), key=lambda r: (r[1], str(r[0])))
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [(2, 300, 0, 0), (None, 460, 450, 1), (None, 501, 500, 1), (1, 900, 900, 1), (1, 900, 900, 1)]
    assert repeats.cleaned(frame.withColumnRenamed("sig", "_kept").withColumn("one", F.lit(7)).withColumn("copies", F.lit("c"))).where("one = 7 and copies = 'c' and _kept = 1").count() == 5
    own = repeats.cleaned(frame)
    assert own.columns == frame.columns and own.where("doc_id = 1").select("text").distinct().collect()[0][0] == "" and own.count() == 5


def test_cleaned_at_the_length_of_a_passage(spark, docs):
    """The stage of the pipeline: every passage of over 50 words that stands in two texts goes, at its own length."""
    texts = [t for t in cases(6)]
    raws = [(t or "").encode() for t in texts]
    want = [None if t is None else bytes(c for c, g in zip(r, gone) if not g).decode("utf-8", "ignore") for t, r, gone in zip(texts, raws, marked(raws, PASSAGE))]
    frame = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    got = sorted(map(tuple, repeats.cleaned(frame, PASSAGE).collect()))
    assert [r[1] for r in got] == want and all(r[2] == len(r[1]) for r in got if r[1] is not None)
