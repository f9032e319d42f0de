"""Exact top-k inner products over norm-sorted blocks.

Vectors are dealt into groups of blocks by descending length. The longest vectors give each query a first bound on its k-th score;
queries are then dealt into blocks by the length that a vector needs to reach that bound. Which group a block of queries must meet is decided
on narrow rows, by levels of length, before any vector moves; queries travel to the groups. Within a pair of blocks, slices of falling length are scored by the leading coordinates of an SVD rotation plus a
Cauchy-Schwarz bound on the rest; only what can still reach the bound gets its integer product.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terminus.llm.common import batch, materialize, sliced

K, EVERY, SCALE = 5, 50, 256
#: Vectors of a block, queries of a block, vectors scored at a time, leading coordinates of the rotation.
BLOCK, QUERIES, SLICE, LEADING = 2048, 1024, 512, 16
#: Blocks of a group; blocks of queries that meet a group in one task; levels for each doubling of length.
GROUP, MEET, LEVELS = 4, 64, 8
#: Vectors that the rotation is fitted on at most; it decides what is pruned, never a result.
FIT = 4096
EXACT = float(1 << 53)


def _clean(batches):
    schema = pa.schema([("vec_id", pa.int64()), ("ints", pa.list_(pa.float64())), ("norm", pa.float64())])
    for x in batches:
        ids, rows, norms = [], [], []
        for i, v in zip(x.column(0).to_pylist(), x.column(1).to_pylist()):
            if v is None or any(c is None for c in v):
                continue
            v = np.array(v, dtype=float)
            if np.isfinite(v).all():
                v = np.floor(SCALE * v)
                ids.append(i)
                rows.append(v)
                norms.append(float(np.sqrt((v * v).sum())))
        yield batch({"vec_id": ids, "ints": rows, "norm": norms}, schema)


def _blocks(d: int, most: int):
    """Rows (uid, vec_id, ints, rank, bound) in order: blocks with at most `most` of a partition's vectors, top the largest rank in them."""
    schema = pa.schema([("part", pa.int64()), ("key", pa.int64()), ("top", pa.float64()), ("uids", pa.binary()), ("ids", pa.binary()), ("matrix", pa.binary()), ("bounds", pa.binary())])

    def run(batches):
        part, key, held, n = TaskContext.get().partitionId(), 0, [], 0

        def pack(rows):
            m = np.zeros((rows.num_rows, d))
            for i, r in enumerate(rows.column(2).to_pylist()):
                m[i, : len(r)] = r
            of = [rows.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3, 4)]
            return batch({"part": [part], "key": [(part << 32) + key], "top": [of[2].max()], "uids": [of[0].astype("<i8").tobytes()], "ids": [of[1].astype("<i8").tobytes()], "matrix": [m.tobytes()], "bounds": [of[3].astype("<f8").tobytes()]}, schema)

        for x in sliced(batches, most):
            while x.num_rows:
                held.append(x.slice(0, most - n))
                n, x = n + held[-1].num_rows, x.slice(most - n)
                if n == most:
                    yield pack(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    key, held, n = key + 1, [], 0
        if n:
            yield pack(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return run


BLOCK_TYPE = "part long, key long, top double, uids binary, ids binary, matrix binary, bounds binary"


def _matrix(raw: bytes, d: int) -> np.ndarray:
    return np.frombuffer(raw).reshape(-1, d) if d else np.zeros((len(raw), 0))


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles."""
    if not q.shape[1] or not len(q) or not len(v):
        return np.zeros((len(q), len(v)))
    if np.abs(q).max() * np.abs(v).max() * q.shape[1] < EXACT:
        return q @ v.T
    return np.array(np.vectorize(int, otypes=[object])(q) @ np.vectorize(int, otypes=[object])(v).T)


def best(q: np.ndarray, quid: np.ndarray, bound: np.ndarray, v: np.ndarray, vuid: np.ndarray, vid: np.ndarray, rotation: np.ndarray, k: int = K):
    """Per query of the block its k best of v (all that tie by score are ordered by id), none that can't reach `bound`.

    v stands in order of falling length. Returns (query, vector, score) as index arrays and scores."""
    qn, vn = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    lead = min(LEADING, q.shape[1])
    qr, vr = q @ rotation, v @ rotation
    qrest, vrest = (np.sqrt(np.maximum(0, (m[:, lead:] ** 2).sum(axis=1))) for m in (qr, vr))
    bound, kept = bound.astype(float).copy(), [([], []) for _ in q]
    for s in range(0, len(v), SLICE):
        own = slice(s, min(len(v), s + SLICE))
        slack = 1e-9 * (1 + qn * vn[own.start])
        on = np.flatnonzero(qn * vn[own.start] + slack >= bound)
        if not len(on):
            if (qn * vn[own.start] + slack < bound).all():
                break
            continue
        reach = qr[on, :lead] @ vr[own, :lead].T + qrest[on, None] * vrest[None, own] + slack[on, None] >= bound[on, None]
        score = None
        if reach.mean() > 0.05:
            score = products(q[on], v[own])
        for row, i in enumerate(on):
            at = np.flatnonzero(reach[row])
            at = at[vuid[own][at] != quid[i]]
            if not len(at):
                continue
            value = score[row, at] if score is not None else products(q[i : i + 1], v[own][at])[0]
            all_at, all_value = np.concatenate([kept[i][0], s + at]).astype(int), np.concatenate([kept[i][1], value])
            order = np.lexsort((vuid[all_at], vid[all_at], -all_value))[:k]
            kept[i] = (all_at[order], all_value[order])
            if len(order) == k:
                bound[i] = max(bound[i], float(all_value[order[-1]]))
    hits = [(i, a, x) for i, (at, value) in enumerate(kept) for a, x in zip(at, value) if x >= bound[i]]
    return hits, bound


def _bounds(d: int, head: list[tuple], rotation: np.ndarray, k: int):
    """Give each query (uid, vec_id, ints, norm) the bound that the longest vectors set, and the least length of a vector that reaches it, negated."""

    def run(batches):
        schema = pa.schema([("uid", pa.int64()), ("vec_id", pa.int64()), ("ints", pa.list_(pa.float64())), ("rank", pa.float64()), ("bound", pa.float64())])
        for x in sliced(batches, QUERIES):
            q = np.zeros((x.num_rows, d))
            for i, r in enumerate(x.column(2).to_pylist()):
                q[i, : len(r)] = r
            quid, norm, bound = x.column(0).to_numpy(), np.sqrt((q * q).sum(axis=1)), np.full(len(q), -np.inf)
            for vuids, vids, vraw in head:
                bound = best(q, quid, bound, _matrix(vraw, d), np.frombuffer(vuids, "<i8"), np.frombuffer(vids, "<i8"), rotation, k)[1]
            with np.errstate(divide="ignore", invalid="ignore"):
                needed = np.where(bound > 0, bound / norm * (1 - 1e-9), 0.0)
            yield batch({"uid": x.column(0), "vec_id": x.column(1), "ints": x.column(2), "rank": -needed, "bound": bound}, schema)

    return run


def _pairs(d: int, rotation: np.ndarray, k: int):
    def run(batches):
        schema = pa.schema([("quid", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("uid", pa.int64()), ("score", pa.int64())])
        for x in sliced(batches, 1):
            for vuids, vids, vraw, quids, qids, qraw, bounds in zip(*(c.to_pylist() for c in x.columns)):
                vuid, vid, quid, qid = (np.frombuffer(b, "<i8") for b in (vuids, vids, quids, qids))
                hits, _ = best(_matrix(qraw, d), quid, np.frombuffer(bounds), _matrix(vraw, d), vuid, vid, rotation, k)
                i, a = np.array([h[0] for h in hits], int), np.array([h[1] for h in hits], int)
                yield batch({"quid": quid[i], "query_id": qid[i], "vec_id": vid[a], "uid": vuid[a], "score": [int(h[2]) for h in hits]}, schema)

    return run


def _level(length: Column) -> Column:
    return F.when(length > 0, F.floor(F.log2(F.greatest(length, F.lit(1e-9))) * LEVELS)).otherwise(F.lit(-(1 << 20))).cast("int")


def search(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by `every` its k best of all other rows.

    Null vectors, vectors with a null or non-finite component and rows without vec_id take no part. Shorter vectors count as
    if filled up with zeros. A repeated row is a row: it may be found by its double, and asks for itself. Ties go
    to the smaller vec_id. An empty table gives an empty result; other columns are not read. Scores must fit in 64 bits.

    The driver sees a count, at most FIT vectors for the rotation, the two longest blocks and the levels of length. A block of queries
    travels to the groups that it may find something in, a group once for each MEET such blocks.
    """
    spark = vectors.sparkSession
    raw = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    own = materialize(raw.mapInArrow(_clean, "vec_id long, ints array<double>, norm double").withColumn("uid", F.monotonically_increasing_id()), "vectors", rows=BLOCK)
    n, d, asked = own.agg(F.count(F.lit(1)), F.max(F.size("ints")), F.count_if(F.col("vec_id") % every == 0)).first()
    if not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample = own.orderBy(F.xxhash64("uid")).limit(FIT).select("ints").collect()
    m = np.zeros((len(sample), d))
    for i, r in enumerate(sample):
        m[i, : len(r[0])] = r[0]
    rotation = np.linalg.svd(m, full_matrices=True)[2].T if d else np.zeros((0, 0))
    rows = ("uid", "vec_id", "ints", "rank", "bound")
    ordered = own.withColumn("rank", F.col("norm")).withColumn("bound", F.lit(0.0)).repartitionByRange(math.ceil(n / (BLOCK * GROUP)), F.desc("rank"), F.asc("uid")).sortWithinPartitions(F.desc("rank"), "uid")
    blocks = materialize(ordered.select(*rows).mapInArrow(_blocks(d, BLOCK), BLOCK_TYPE).drop("bounds"), "blocks", rows=BLOCK)
    head = [tuple(r) for r in blocks.orderBy(F.desc("top"), "key").limit(2).select("uids", "ids", "matrix").collect()]
    bounded = own.where(F.col("vec_id") % every == 0).select("uid", "vec_id", "ints", "norm").repartition(math.ceil(asked / QUERIES), "uid").mapInArrow(_bounds(d, head, rotation, k), "uid long, vec_id long, ints array<double>, rank double, bound double")
    bounded = materialize(bounded, "bounds", rows=QUERIES).repartitionByRange(math.ceil(asked / (QUERIES * GROUP)), "rank", "uid").sortWithinPartitions("rank", "uid")
    queries = materialize(bounded.select(*rows).mapInArrow(_blocks(d, QUERIES), BLOCK_TYPE).withColumnRenamed("top", "rank"), "queries", rows=QUERIES)
    groups = blocks.groupBy("part").agg(F.max("top").alias("longest"))
    levels = sorted(r[0] for r in groups.select(_level(F.col("longest"))).distinct().collect())  # as many as lengths have levels
    reached = F.filter(F.array(*map(F.lit, levels)), lambda x: x >= _level(-F.col("rank")))
    asking = queries.select("key", "rank", F.explode(reached).alias("level")).join(groups.withColumn("level", _level(F.col("longest"))), "level").where(F.col("longest") >= -F.col("rank"))
    asking = asking.select("part", "key", F.pmod(F.xxhash64("key"), F.lit(math.ceil(asked / (QUERIES * MEET)))).alias("salt"))
    met = blocks.join(asking.select("part", "salt").distinct(), "part")
    of = queries.select("key", "rank", F.col("uids").alias("quids"), F.col("ids").alias("qids"), F.col("matrix").alias("qmatrix"), "bounds").join(asking, "key")
    pairs = met.drop("key").join(of, ["part", "salt"]).where(F.col("top") >= -F.col("rank")).select("uids", "ids", "matrix", "quids", "qids", "qmatrix", "bounds")
    found = pairs.mapInArrow(_pairs(d, rotation, k), "quid long, query_id long, vec_id long, uid long, score long")
    rank = F.row_number().over(Window.partitionBy("quid").orderBy(F.desc("score"), "vec_id", "uid"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
