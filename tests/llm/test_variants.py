import random
import re
from collections import Counter
from zlib import crc32

from terminus.llm import variants


def brute(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(low)
            h = crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[i + (len(a) == len(b)) :] == b[i + 1 :]

    form, count = {}, {}
    for w in n:
        own = [v for v in n if near(w, v)]
        best = min(own, key=lambda v: (-n[v], v), default=None)
        count[w] = len(own)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], count[w], n[form[w]] if form[w] else 0) for w in n)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int, size int")
    got = sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in variants.group(docs).collect())
    assert got == brute([r[:2] for r in rows])
    return got


def wide(rows):
    return [(d, t, "x", 1, 2) for d, t in rows]


def test_random_words_with_edits_against_all_pairs(spark):
    rng = random.Random(5)
    letters = "abcéß÷À"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 10))) for _ in range(40)]
    for w in list(words):
        for _ in range(4):
            i, c = rng.randrange(len(w)), rng.choice(letters)
            words.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w + c]))
    rows = [(d, " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=300))) for d in range(30)]
    got = check(spark, wide(rows))
    assert any(r[1] for r in got) and len(got) > 100


def test_repeated_letters_where_grams_tie(spark):
    words = ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "bababab", "ababababa", "aabaabaa", "abaabaab", "aaaabaaaa", "aaaaabaaaa"]
    check(spark, wide([(1, " ".join(words * 3)), (2, " ".join(words * 2)), (3, "aaaaaaaa " * 90)]))


def test_forms_are_followed_to_the_last(spark):
    got = check(spark, wide([(0, "starting " * 2 + "startinga " * 40 + "startingas " * 900 + "Startingasx " * 9)]))
    assert {r[0]: r[2] for r in got if r[3] < 100} == {"starting": "startingas", "startinga": "startingas", "startingasx": "startingas"}


def test_nulls_long_words_repeated_rows_and_an_empty_table(spark):
    long = "q" * 3000 + "w"
    rows = [(None, None), (1, ""), (1, "short 123 Ābcdefgh"), (None, "overflow Overflow"), (None, "overflow Overflow"), (2, f"{long} {long}e {long} {long}e"), (4, "ÀÉÎÕÜàé ÀÉÎÕÜàé àéîõüàé àéîõüàé")]
    check(spark, wide(rows))
    assert variants.group(spark.createDataFrame([], "doc_id long, text string")).count() == 0
