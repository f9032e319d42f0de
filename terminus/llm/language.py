"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Weights are learned with follow-the-regularised-leader (proximal, elastic net) on a bounded sample of the learning
documents, whose features come to the driver as sparse vectors of bounded size; document frequencies are counted over all
learning documents. The temperature is fitted on a part of the sample that the weights have not seen.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terminus.llm.common import batch, computed, free, sliced, texts

BUCKETS, ORDERS = 1 << 14, 3
#: Learning documents of each language that are fitted on, as expected; and of all languages at most.
PER_LANGUAGE, SAMPLE = 800, 6000
FOLDS = 5
LETTER = re.compile(r"[^\W\d_]")
NONE = "und"
#: Characters hashed at a time.
CHUNK = 1 << 20

_separators = np.ones(128, bool)
_separators[[*range(65, 91), *range(97, 123)]] = False


def counts(text: str) -> np.ndarray:
    """How often each bucket's character n-grams (1 to ORDERS) occur in a whole text, lower-cased; ASCII besides letters is one separator."""
    out = np.zeros(BUCKETS, np.int64)
    text = text.lower()
    for s in range(0, len(text), CHUNK):
        c = np.frombuffer(f" {text[s : s + CHUNK]} ".encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        c[(c < 128) & _separators[np.minimum(c, 127)]] = 32
        key = c
        for n in range(1, ORDERS + 1):
            if n > 1:
                key = key[:-1] * np.uint32(0x01000193) + c[n - 1 :] if len(key) > 1 else key[:0]
            out += np.bincount((key * np.uint32(2654435761) + np.uint32(n * 0x1F3779B9)) >> np.uint32(32 - 14), minlength=BUCKETS)
    return out


def vector(n: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(n)
    v = np.log1p(n[at]) * idf[at]
    return at, v / (np.sqrt((v * v).sum()) or 1.0)


def _frequencies(batches):
    total = np.zeros(BUCKETS, np.int64)
    for x in sliced(batches):
        for t in x.column(0).to_pylist():
            total += counts(t) > 0
    at = np.flatnonzero(total)
    yield batch({"bucket": at, "n": total[at]}, pa.schema([("bucket", pa.int64()), ("n", pa.int64())]))


def _sparse(batches):
    schema = pa.schema([("fold", pa.int32()), ("lang", pa.string()), ("at", pa.binary()), ("n", pa.binary())])
    for x in sliced(batches):
        rows = []
        for fold, lang, text in zip(*(x.column(i).to_pylist() for i in range(3))):
            n = counts(text)
            at = np.flatnonzero(n)
            rows.append((fold, lang, at.astype("<u2").tobytes(), n[at].astype("<u4").tobytes()))
        yield batch(dict(zip(schema.names, zip(*rows) if rows else [()] * 4)), schema)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, seed: int = 7) -> np.ndarray:
    """FTRL-proximal with elastic-net penalties; the last column is the intercept."""
    z, n = np.zeros((2, classes, BUCKETS + 1))
    rng = np.random.default_rng(seed)

    def weights(at):
        return np.where(np.abs(z[:, at]) <= l1, 0.0, -(z[:, at] - np.sign(z[:, at]) * l1) / ((beta + np.sqrt(n[:, at])) / alpha + l2))

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, v = np.append(rows[i][0], BUCKETS), np.append(rows[i][1], 1.0)
            w = weights(at)
            p = softmax(w @ v)
            p[y[i]] -= 1
            g = p[:, None] * v
            sigma = (np.sqrt(n[:, at] + g * g) - np.sqrt(n[:, at])) / alpha
            z[:, at] += g - sigma * w
            n[:, at] += g * g
    return weights(np.arange(BUCKETS + 1))


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the scores that makes the held-back labels likeliest, between 0.05 and 20; 1 if there is none."""
    if not len(y):
        return 1.0
    loss = lambda t: -np.log(softmax(z / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean()
    a, b, r = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fold() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))


def _predict(langs: list[str], w: np.ndarray, t: float, idf: np.ndarray):
    w = w.astype(np.float32)

    def compute(texts_: list) -> list:
        out = []
        for text in texts_:
            if not langs or text is None or not LETTER.search(text):
                out.append((NONE, 0.0))
                continue
            at, v = vector(counts(text), idf)
            p = softmax((w[:, at] @ v + w[:, BUCKETS]).astype(float) / t)
            k = int(np.argmax(p))
            out.append((langs[k], float(p[k])))
        return list(zip(*out)) if out else [[], []]

    return compute


#: Names of the columns that a prediction adds, with underscores in front where the table has such columns.
LANG, SCORE = "lang_pred", "score"


def predicted(docs: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> DataFrame:
    """Every document, as given, with LANG and SCORE, by names that are `free`, as its last columns.

    Documents whose crc32 remainder is 0 are held out; weights come from at most `sample` others with a language and a
    letter (about `per_language` of each, by hash of doc_id), document frequencies from all of these. Null texts
    and texts without a letter get `und` with score 0, as does everything if there is nothing to learn from. Of languages as
    probable as each other the first by name is taken. Repeated rows count each time; an empty table gives an empty result;
    columns besides doc_id, text and lang are not used.
    """
    name, score = free(docs.columns, LANG, SCORE)
    add = lambda *model: computed(docs, [F.col("text").cast("string")], _predict(*model), [(name, "string", pa.string()), (score, "double", pa.float64())])
    known = texts(docs, F.col("lang").cast("string").alias("lang"), fold().cast("int").alias("fold")).where("fold != 0 and lang is not null and text is not null")
    known = known.where(F.col("text").rlike(r"\p{L}"))
    narrow = known.select("doc_id", "lang", "fold")
    sizes = {r["lang"]: r["n"] for r in narrow.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    langs = sorted(sizes)
    if not langs:
        return add([], np.zeros((1, BUCKETS + 1)), 1.0, np.ones(BUCKETS))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    bound = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, per_language / n)])
    chosen = narrow.where(share < bound[F.col("lang")]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id").distinct()
    features = known.join(F.broadcast(chosen), "doc_id", "left_semi")  # at most `sample` numbers
    rows = features.select("fold", "lang", "text").mapInArrow(_sparse, "fold int, lang string, at binary, n binary").limit(2 * sample).collect()
    df = known.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most BUCKETS rows
    idf = np.full(BUCKETS, 0.0)
    total = sum(sizes.values())
    for r in df:
        idf[r["bucket"]] = np.log((1 + total) / (1 + r["n"])) + 1
    rows.sort(key=lambda r: (r["lang"], r["at"], r["n"]))
    code = {lang: i for i, lang in enumerate(langs)}
    x = [vector(np.bincount(np.frombuffer(r["at"], "<u2"), weights=np.frombuffer(r["n"], "<u4"), minlength=BUCKETS), idf) for r in rows]
    y = np.array([code[r["lang"]] for r in rows], dtype=int)
    back = np.array([r["fold"] == 1 for r in rows], dtype=bool)
    if back.all():
        back[:] = False
    w = fit([x[i] for i in np.flatnonzero(~back)], y[~back], len(langs))
    z = np.array([w[:, x[i][0]] @ x[i][1] + w[:, BUCKETS] for i in np.flatnonzero(back)]).reshape(-1, len(langs))
    t = temperature(z, y[back])
    return add(langs, w, t, idf)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    own = predicted(texts(docs, F.col("lang").cast("string").alias("lang")))
    return own.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), F.col(LANG).alias("lang_pred"), F.col(SCORE).alias("score"))


def passed(docs: DataFrame, least: float) -> DataFrame:
    """The documents in a learned language with that probability or more, with the columns they came with."""
    name, score = free(docs.columns, LANG, SCORE)
    return predicted(docs).where((F.col(name) != NONE) & (F.col(score) >= least)).select(*docs.columns)
