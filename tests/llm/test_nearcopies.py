import random
import time

import corpus_pipeline
from terminus.llm import common, nearcopies, simhash


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    """The index of the first of each group, by every pair."""
    own, root = [sets(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(own[i] & own[j]) >= 4 * len(own[i] | own[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted({find(i) for i in range(len(texts))})


def changed(rng, text, n):
    w = text.split()
    for at in rng.sample(range(len(w)), n):
        w[at] = f"v{rng.randrange(10**9)}"
    return " ".join(w)


def kept(spark, frame):
    return sorted(corpus_pipeline.near_dedup(spark, frame, "").collect(), key=str)


def test_copies_of_similarity_08_or_more(spark, docs):
    rng = random.Random(3)
    texts = ["", "  ", None, "one", "One ", "one two"]
    for _ in range(30):
        t = " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(40, 300)))
        texts.append(t)
        for _ in range(3):
            texts.append(t := changed(rng, t, rng.randint(1, max(1, len(t.split()) // 35))))
    want = brute(texts)
    assert 30 < len(want) < len(texts) - 20
    assert [r.doc_id for r in sorted(kept(spark, docs(texts)), key=lambda r: r.doc_id)] == want


def test_long_lists_are_compared_whole(spark, docs):
    rng = random.Random(4)
    base = " ".join(f"w{i}" for i in range(100))
    texts = [changed(rng, base, rng.choice([1, 2, 3, 4])) for _ in range(120)]
    for _ in range(10):
        texts.append(changed(rng, texts[rng.randrange(120)], 3))
    assert max(len(b) for b in lists(texts).values()) > nearcopies.FEW
    want = brute(texts)
    assert [r.doc_id for r in sorted(kept(spark, docs(texts)), key=lambda r: r.doc_id)] == want


def lists(texts):
    out = {}
    for t in texts:
        for band, key in enumerate(nearcopies.bands(nearcopies.shingles(t))):
            out.setdefault((band, key), set()).add(t)
    return out


def test_rows_without_or_with_repeated_doc_id(spark):
    rows = [(None, "a b c d e f g"), (None, "a  B c d e f g"), (None, "quite another text of some words"), (1, "x y z x y z q"), (1, "other words with the same id"), (1, "x y z x y z q"), (2, "X y z x y z q")]
    got = kept(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(got) == 4 and {(r.doc_id, r.text) for r in got} >= {(None, rows[2][1]), (1, rows[3][1]), (1, rows[4][1])}


def test_a_pair_is_passed_over_only_where_it_cannot_be_alike():
    rng = random.Random(7)
    for _ in range(2000):
        n, m, both = rng.randint(1, 40), rng.randint(1, 40), rng.randint(0, 40)
        both = min(both, n, m)
        own, other = rng.randint(0, n - both), rng.randint(0, m - both)
        if 5 * both >= 4 * (n + m - both):
            assert nearcopies.reachable(nearcopies.np.array([n]), nearcopies.np.array([own]), m, other)[0]


def test_parities_pass_over_no_pair_of_the_least_similarity():
    rng = nearcopies.np.random.default_rng(8)
    met = 0
    for _ in range(500):
        n, both = int(rng.integers(1, 3000)), rng.random()
        shared = rng.integers(0, 1 << 63, max(1, int(n * (0.6 + 0.4 * both))), dtype=nearcopies.np.uint64)
        a, b = (nearcopies.np.unique(nearcopies.np.concatenate([shared, rng.integers(0, 1 << 63, n - min(n, len(shared)), dtype=nearcopies.np.uint64)])) for _ in range(2))
        held = [nearcopies.np.frombuffer(nearcopies.sketch_of(s, nearcopies.minima(s)), nearcopies.np.uint8) for s in (a, b)]
        if nearcopies.alike(a, b):
            met += 1
            assert nearcopies.agreeing(held[0][None], nearcopies.np.array([len(a)]), held[1], len(b))[0] >= nearcopies.MATCHES
    assert met > 50


def test_fingerprints_bring_copies_together_by_themselves(spark, docs, monkeypatch):
    monkeypatch.setattr(nearcopies, "_candidates", lambda batches: iter(()))
    cycle = "a b c d e " * 300
    texts = [cycle, cycle + "u", "quite another text of some words"]
    assert (simhash.fingerprint(texts[0]) ^ simhash.fingerprint(texts[1])).bit_count() <= simhash.BITS and brute(texts) == [0, 2]
    assert sorted(r.doc_id for r in kept(spark, docs(texts))) == [0, 2]


def test_shuffle_files_of_dropped_tables_go(spark):
    statuses = spark._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    spark._jvm.System.gc()
    time.sleep(3)
    made = common.materialize(spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count(), "made")
    before = statuses.size()
    common.dropped(made)
    for _ in range(20):
        if statuses.size() < before:
            break
        time.sleep(0.5)
    assert statuses.size() < before
