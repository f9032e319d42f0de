"""Quality rules: decision lists learned by sequential covering, as ordered Spark conditional expressions.

From the statistics of labelled texts a list of rules for the rejected class is
learned: a rule is a conjunction of thresholds grown on two thirds of the rows by information gain and pruned
on the other third, rules are added while they pay on rows not covered yet. The list becomes one CASE
expression over the statistics of every whole text.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terminus.llm.common import computed, free, texts

#: Labelled rows that the rules are learned from at most: those with the smallest hash of doc_id.
SAMPLE = 20_000
WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_upper", "n_marks", "n_bars", "n_lines", "n_distinct", "n_digits")
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"


def repeat_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more; windows are told apart exactly, by ranks of doubled length."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    rank, size = ids, 1
    while size < window:
        rank = rank[:-size] * np.int64(len(ids) + 1) + rank[size:]
        size *= 2
        if size == window:
            break
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    _, inverse, count = np.unique(rank, return_inverse=True, return_counts=True)
    again = count[inverse] > 1
    if not again.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """COUNTS of a whole text; a null text has zeros."""
    text = text or ""
    raw = text.encode("utf-8")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    code: dict[bytes, int] = {}
    ids = np.array([code.setdefault(w, len(code)) for w in words], dtype=np.int64)
    less = lambda chars: len(raw) - len(raw.translate(None, chars))
    space = less(b" \t\n\r\x0b\x0c")
    return (
        len(words), len(text) - space, less(SYMBOLS), len(lines) - len(set(lines)), repeat_words(ids) if len(code) < len(words) - WINDOW + 1 or len(words) >= 2 * WINDOW else 0,
        len(text), less(UPPER), less(b"!?"), less(b"|"), len(lines), len(code), less(DIGITS),
    )


def _compute(texts_: list) -> list:
    return list(zip(*map(statistics, texts_))) if texts_ else [[] for _ in COUNTS]


def front(docs: DataFrame) -> str:
    """What computed columns have in front of their names, so that none is the table's own."""
    names = (*COUNTS, *[n for n, *_ in RATIOS], "base_failed", "kept")
    return free(docs.columns, *["q_" + n for n in names])[0].removesuffix(names[0])


def measured(docs: DataFrame, own: str) -> DataFrame:
    """The table with its statistics and ratios beside its own columns, their names with `own` in front."""
    found = computed(docs, [F.col("text").cast("string")], _compute, [(own + c, "bigint", pa.int64()) for c in COUNTS])
    return found.select("*", *[(F.col(own + a) / F.greatest(F.col(own + b), F.lit(1))).alias(own + n) for n, a, b in RATIOS])


#: Ratios that rules may ask about: (name, numerator, denominator).
RATIOS = (("symbols_per_word", "n_symbols", "n_words"), ("chars_per_word", "word_chars", "n_words"), ("upper_per_char", "n_upper", "n_chars"), ("marks_per_word", "n_marks", "n_words"), ("bars_per_word", "n_bars", "n_words"), ("repeats_per_word", "n_repeat_words", "n_words"), ("dup_lines_per_line", "n_dup_lines", "n_lines"), ("distinct_per_word", "n_distinct", "n_words"), ("digits_per_char", "n_digits", "n_chars"))


def base_failed(own: str) -> Column:
    words = F.col(own + "n_words")
    return (words < 20) | (100 * F.col(own + "n_repeat_words") > 30 * words)


def _precision(bad: int, good: int) -> float:
    return (bad + 1) / (bad + good + 2)


def _cover(x: np.ndarray, rule: list[tuple[int, str, float]]) -> np.ndarray:
    on = np.ones(len(x), bool)
    for k, side, t in rule:
        on &= x[:, k] > t if side == ">" else x[:, k] <= t
    return on


def _grow(x: np.ndarray, y: np.ndarray, most: int) -> list[tuple[int, str, float]]:
    rule: list[tuple[int, str, float]] = []
    on = np.ones(len(x), bool)
    while len(rule) < most:
        p, n = int(y[on].sum()), int(on.sum())
        if not p or p == n:
            break
        best, pick = 0.0, None
        info = math.log2(p / n)
        for k in range(x.shape[1]):
            v, lab = x[on, k], y[on]
            order = np.argsort(v, kind="stable")
            v, up = v[order], np.cumsum(lab[order])
            cut = np.flatnonzero(v[1:] > v[:-1])
            if not len(cut):
                continue
            low_p, low_n = up[cut], cut + 1
            for side, pp, nn in (("<=", low_p, low_n), (">", p - low_p, n - low_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(np.maximum(pp, 1) / nn) - info), 0)
                i = int(np.argmax(gain))
                if gain[i] > best + 1e-9:
                    best, pick = float(gain[i]), (k, side, float((v[cut[i]] + v[cut[i] + 1]) / 2))
        if not pick:
            break
        rule.append(pick)
        on &= _cover(x, [pick])
    return rule


def learn(x: np.ndarray, y: np.ndarray, rules: int = 12, conditions: int = 3, least: int = 8, precision: float = 0.9) -> list[list[tuple[int, str, float]]]:
    """Rules for y = 1, in order. A rule stays if on the rows held back for pruning it covers `least` / 3 rows or more and
    its smoothed precision is `precision` or more, over all rows too. No labelled row of either class: no rule."""
    found: list = []
    fold = np.arange(len(x)) % 3 == 2
    left = np.ones(len(x), bool)
    while len(found) < rules and y[left & ~fold].any():
        gx, gy, px, py = x[left & ~fold], y[left & ~fold], x[left & fold], y[left & fold]
        rule = _grow(gx, gy, conditions)
        if not rule:
            break
        worth = []
        for k in range(1, len(rule) + 1):
            on = _cover(px, rule[:k])
            worth.append((py[on].sum() - (~py[on].astype(bool)).sum()) / max(1, on.sum()))
        rule = rule[: int(np.argmax(worth)) + 1]
        on, own = _cover(px, rule), _cover(x, rule) & left
        bad = int(y[own].sum())
        if own.sum() < least or on.sum() < least / 3 or _precision(int(py[on].sum()), int((py[on] == 0).sum())) < precision - 0.1 or _precision(bad, int(own.sum()) - bad) < precision:
            break
        found.append(rule)
        left &= ~own
    return found


def verdict(rules: list[list[tuple[int, str, float]]], own: str) -> Column:
    """True where no rule rejects; the number of conditions follows the rules, not the data."""
    out = None
    for rule in rules:
        test = None
        for k, side, t in rule:
            c = F.col(own + RATIOS[k][0])
            one = c > F.lit(t) if side == ">" else c <= F.lit(t)
            test = one if test is None else test & one
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list:
    """The decision list of the labelled documents (quality: 1 stays, 0 goes; a null is no label).

    At most `sample` labels, those with the smallest hash of doc_id, send their numbers to the driver; of a doc_id that
    many rows repeat, `sample` rows in all."""
    known = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    of = texts(docs).join(F.broadcast(chosen), "doc_id")
    own = front(of)
    of = measured(of, own).where(~base_failed(own))
    rows = sorted(of.select("doc_id", "quality", *[own + n for n, *_ in RATIOS]).limit(sample).collect())
    rows.sort(key=lambda r: zlib.crc32(str(r[0]).encode()))
    x = np.array([r[2:] for r in rows], dtype=float).reshape(len(rows), len(RATIOS))
    y = np.array([r["quality"] == 0 for r in rows], dtype=np.int64)
    return learn(x, y)


def assess(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Every document, as given, with its statistics, base_failed and kept (names with `front` in front).

    Null and empty texts have zero counts and fail the base. A repeated doc_id is measured row by row. Without labels of both
    classes only the base speaks. An empty table gives an empty result. One pass over the texts, no shuffle.
    """
    found = rules(docs, labels, sample)
    own = front(docs)
    out = measured(docs, own).withColumn(own + "base_failed", base_failed(own))
    return out.withColumn(own + "kept", ~F.col(own + "base_failed") & verdict(found, own))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = texts(docs)
    own = front(docs)
    return assess(docs, labels).select("doc_id", *[F.col(own + c).alias(c) for c in (*COUNTS[:5], "base_failed", "kept")])


def passed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with the columns they came with."""
    return assess(docs, labels).where(F.col(front(docs) + "kept")).select(*docs.columns)
