import random
import re

import duckdb

from terminus.llm.licenses import PHRASES, TEMPLATES, needed, oracle, scan, span


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    find = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", s)
    w = find(low)
    places, base = [], set()
    for p, label in PHRASES:
        p = p.split()
        for i in range(len(w)):
            if w[i : i + len(p)] == p:
                places.append(i)
                base.add(label)
    more, score = set(), 0.0
    for label, t in TEMPLATES:
        own = set(t.split())
        n = max((len(own & set(w[i : i + span(t)])) for i in range(len(w)) if w[i] in own), default=0) if len(own & set(w)) >= needed(t) else 0
        if n >= needed(t):
            more.add(label)
            score = max(score, n / len(own))
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if places else score


def test_against_brute_force_and_sql(spark, docs):
    rng = random.Random(1)
    words = sorted({w for _, t in TEMPLATES for w in t.split()}) + ["x", "É", "K", "GNU", "General", "Public"]
    texts = [None, "", "CC BY cc by", "cc-by.", "all\nRIGHTS reserved general public\tlicense cc", "cc by", "cc by", "\x00cc\x7fby", "Ccby cc  by\n\n"]
    for _ in range(250):
        parts = []
        for _ in range(rng.randint(0, 6)):
            own = rng.choice(TEMPLATES)[1].split()
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            parts.append(" ".join(own).title() if rng.random() < 0.3 else rng.choice([" ", ", "]).join(own))
            parts.append(rng.choice(["\n", " ", " x "]))
        texts.append("".join(parts))
    texts.append("cc by " * 40000)
    frame = docs(texts).withColumnRenamed("component_id", "row")
    got = sorted(map(tuple, scan(frame).collect()))
    assert [g[1:] for g in got] == [brute(t) for t in texts]
    documents = frame.toPandas()
    con = duckdb.connect()
    con.register("documents", documents)
    assert sorted(con.execute(oracle()).fetchall()) == got
    assert scan(docs([])).count() == 0


def test_notices_over_lines_and_words_far_apart(docs):
    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that"
    far = "released " + "x " * 50 + "under the " + "y " * 50 + "mit license"
    texts = [bsd, far, "Released under the Apache License", "Released under\n * the MIT\n * License.", "This work is licensed under a Creative Commons\nAttribution 4.0\nInternational License"]
    assert [r.labels for r in sorted(scan(docs(texts)).collect(), key=lambda r: r.doc_id)] == ["bsd", "", "", "mit", "cc-by"]
