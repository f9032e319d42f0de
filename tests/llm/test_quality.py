import random
import re
from collections import Counter

import numpy as np

from terminus.llm.quality import learn, statistics, verdicts


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    c, on = Counter(windows), set()
    for i, w in enumerate(windows):
        if c[w] > 1:
            on.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(on)


def test_counts_against_brute_force():
    rng = random.Random(1)
    for t in [None, "", " \n ", "a b c d e f g h a b c d e f g h", "x " * 50, "a\n\na\nb\na", "  a b \x1c c\x85d"]:
        assert statistics(t)[:5] == brute(t)
    for _ in range(200):
        t = "".join(rng.choice(["a", "b", "éa", "#"]) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.randint(0, 120)))
        assert statistics(t)[:5] == brute(t)


def test_learned_rules_find_planted_thresholds():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 9))
    y = ((x[:, 0] > 0.8) | ((x[:, 3] <= 0.2) & (x[:, 5] > 0.5))).astype(int)
    noisy = np.where(rng.random(3000) < 0.02, 1 - y, y)
    bad = np.zeros(3000, bool)
    for rule in learn(x, noisy):
        on = np.ones(3000, bool)
        for k, side, t in rule:
            on &= x[:, k] > t if side == ">" else x[:, k] <= t
        bad |= on
    assert (bad == y).mean() > 0.97
    assert learn(x[:0], y[:0]) == [] and learn(x, np.zeros(3000, int)) == []


def test_verdicts(spark, docs):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 9) + str(rng.randint(0, 999))
    texts = [None, "", "few words"]
    for i in range(300):
        texts.append(" ".join(word() + ("###" if i % 4 == 0 else "") for _ in range(rng.randint(25, 60))))
    labels = spark.createDataFrame([(i, None if i % 7 == 0 else int((i - 3) % 4 != 0), "x") for i in range(3, 200)], "doc_id long, quality int, text string")
    got = {r.doc_id: r for r in verdicts(docs(texts), labels).collect()}
    assert len(got) == 303 and not any(got[i].kept or not got[i].base_failed for i in range(3))
    assert all(got[i].kept == ((i - 3) % 4 != 0) for i in range(3, 303))
    assert all(tuple(got[i])[1:6] == brute(t) for i, t in enumerate(texts))
    none = verdicts(docs(texts), labels.limit(0))
    assert all(r.kept != r.base_failed for r in none.collect())
    assert verdicts(docs([]), labels).count() == 0
