import hashlib
import math
import re
from collections import defaultdict

import pytest
import regex

from terminus.llm import pii

PLAIN = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def counts(kind, value):
    own = re.sub("[^0-9]", "", value)
    if kind == 1:
        return all(int(x) <= 255 for x in value.split("."))
    if kind == 2:
        return 14 <= len(own) <= 19 and sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(own[::-1])) % 10 == 0
    return kind != 3 or 10 <= len(own) <= 15


def base(text):
    return [(m.start(), k, m.end()) for k, e in enumerate(PLAIN) for m in re.finditer(e, text or "") if counts(k, m.group())]


def before(text, start, last):
    line = text[last:start][-pii.REACH :].split("\n")[-1]
    return re.sub("[0-9]+", "#", line.lower()).split()[-pii.WORDS :]


def brute(texts):
    """Spans of each text: base ones, and those of the method by plain loops."""
    edges, wide = {}, []

    def tell(kind, known, value, words):
        for n in range(1, len(words) + 1):
            edges[" ".join(words[-n:]), kind, value] = edges.get((" ".join(words[-n:]), kind, value), False) or known

    for t in texts:
        t = t or ""
        last = defaultdict(int)
        for k, e in enumerate(pii.BASE):
            for m in regex.finditer(e, t):
                if counts(k, m.group()):
                    tell(k, True, m.group(), before(t, m.start(), last[k]))
                last[k] = m.end()
        rest = regex.sub(pii.ANY, lambda m: "\2" * len(m.group()) if any(regex.fullmatch(e, m.group()) and counts(k, m.group()) for k, e in enumerate(pii.BASE)) else m.group(), t)
        own = []
        for k, e in enumerate(pii.WIDE):
            at = 0
            for m in regex.finditer(e, rest):
                own.append((m.start(), k, m.end(), m.group()))
                tell(k, False, m.group(), before(rest, m.start(), at))
                at = m.end()
        wide.append(own)
        other, at = regex.sub("|".join(f"(?:{e})" for e in pii.WIDE), " ", rest), 0
        for m in regex.finditer(pii.TOKEN, other):
            tell(-1, False, m.group(), before(other, m.start(), at))
            at = m.end()
    have = set()
    while True:
        known = {e: v or e[1:] in have for e, v in edges.items()}
        of, every = defaultdict(lambda: [0, 0]), defaultdict(int)
        for (p, k, _), v in known.items():
            of[p, k][0] += v
            of[p, k][1] += 1
            every[p] += 1
        good = {(p, k): c for (p, k), (a, n) in of.items() if k >= 0 and a >= pii.SUPPORT and (c := a / (a + every[p] - n + 1)) >= pii.CONFIDENCE}
        best = defaultdict(dict)
        for (p, k, v), yes in known.items():
            if not yes and (p, k) in good:
                last = p.split(" ")[-1]
                best[k, v][last] = max(best[k, v].get(last, 0), good[p, k])
        new = {kv for kv, w in best.items() if 1 - math.prod(1 - c for c in w.values()) >= pii.ACCEPT - 1e-9}
        if not new:
            break
        have |= new
    out = []
    for t, own in zip(texts, wide):
        b = base(t)
        out.append((b, b + [(a, k, z) for a, k, z, v in own if (k, v) in have and not any(x < z and a < y for x, _, y in b)]))
    return out


def text_of(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{z}" for a, k, z in sorted(spans))


def check(spark, docs, texts):
    got = {r["doc_id"]: r for r in pii.extract(docs(texts)).collect()}
    for i, (b, every) in enumerate(brute(texts)):
        r = got[i]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == n for s in b) for n in range(4)], i
        assert r["base_sha256"] == hashlib.sha256(text_of(b).encode()).hexdigest(), i
        assert r["spans"] == text_of(every), i
    assert len(got) == len(texts)
    return got


EDGES = [
    None, "", "no one", "a@b.c@d.e", "a@b.com_x@y.org z%+@q-.w-", "é@a.b ö4111111111111111ö", "1.2.3.4.5.6.7.8 256.1.1.1 0001.0.0.255 1.2.3", "4111 1111 1111 1111-1 4111-1111-1111-1111",
    "4111  1111 1111 1111 4111111111111112 00000000000000", "+1 (988) 555-2485. +12 3 +1 (2)-+49 170 123 45 67 89 01 2", "+1 234 567 8901.+1.2.3.4 mail+1@x.y.z", "\x01a@b.c\x02d@e.f\x01", "-" * 5000 + "@a.b", "9" * 5000,
    "a" * 8000, "a." * 2000 + "@b" + ".c" * 9000, "1." * 2000, "+" * 5000 + "1" * 12, "1 " * 30_000, "x\ny 10.0.0.1\r\n\t10.0.0.2",
]


def test_base_spans_of_odd_texts(spark, docs):
    check(spark, docs, EDGES)


def test_long_runs_take_linear_time(spark, docs):
    texts = ["a" * 300_000, "9" * 300_000, "a." * 100_000, "1." * 100_000 + "2", "+" * 100_000, "@" * 100_000]
    got = {r["doc_id"]: r for r in pii.extract(docs(texts)).collect()}
    assert [got[i]["n_ip"] for i in range(6)] == [0, 0, 0, 25_000, 0, 0]


def test_many_matches_of_a_text_keep_their_places(spark, docs):
    check(spark, docs, [" ".join(f"u{i}@h{i % 7}.org 10.0.{i % 256}.{i % 99} 4111 1111 1111 1111" for i in range(1500))])


CLEAN = ["It came to 1234567 in 2024 and 20 more.", "version 2.0 of 12 parts", "call 12 times, room 5551234567x"]


def learned():
    seeds = [f"Please call me at +1 (98{i}) 555-248{i} today" for i in range(6)] + [f"write to joe{i}@mail{i}.example.com soon" for i in range(6)] + [f"Card number: 4111 1111 1111 1111, card number: {n}" for n in ("4012888888881881", "5555555555554444", "378282246310005")]
    return seeds + ["You can call me at 988 555 2486 or later", "do write to ann(at)example[dot]org soon", "Card number: 4111 1111 1111 1112", "later 988 555 2486 again", *CLEAN, "they count up to 9885552486123 there"]


def test_patterns_of_seeds_find_other_identifiers(spark, docs):
    texts = learned()
    got = check(spark, docs, texts)
    more = [got[i]["spans"] for i in range(15, 19)]
    assert more == ["phone:19:31", "email:12:34", "card:13:32", "phone:6:18"]
    assert all(got[i]["spans"] == "" for i in range(19, len(texts)))


def test_a_pattern_that_stands_before_anything_finds_nothing(spark, docs):
    texts = [f"the +1 (98{i}) 555-248{i}" for i in range(6)] + [f"the {i}th, the x{i}" for i in range(6)] + ["the 988 555 2486"]
    assert check(spark, docs, texts)[12]["spans"] == ""


def test_found_values_make_further_patterns_good(spark, docs):
    first = [f"call +1 (98{i}) 555-248{i}" for i in range(5)] + [f"call 98{i} 555 111{i}" for i in range(5)]
    second = [f"dial 98{i} 555 111{i}" for i in range(5)] + ["dial 700 800 9001"]
    got = check(spark, docs, first + second)
    assert got[15]["spans"] == "phone:5:17"


@pytest.mark.parametrize("rows", [0, 3])
def test_tables_that_are_empty_or_repeat_rows_or_have_clashing_columns(spark, rows):
    own = spark.createDataFrame([(None, "a@b.co", 1, "r", "s")] * rows, "doc_id long, text string, row int, base string, spans string")
    got = pii.extract(own).collect()
    assert len(got) == rows and all(r["n_email"] == 1 and r["spans"] == "email:0:6" and r["doc_id"] is None for r in got)
