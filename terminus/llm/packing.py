"""Best-two-fit packing of whole documents into sequences of bounded length.

Lengths are whole numbers of 1 to `limit`, so the packing is planned on their histogram: at most `limit` counts, whatever
the number of documents. The plan is a list of bin patterns with multiplicities; pieces then find their place by
their rank among the pieces of the same length. No window, join or task ever holds all pieces of one length.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terminus.llm.common import BATCH_NUMBERS, batch, gathered, materialize, sliced, texts

LIMIT, END = 1024, 2
#: Pieces of a length that are ranked together, about; more are dealt into parts that are ranked for themselves.
RANKED = 1 << 16
#: Characters on which the fast encoder's splitting rule and the tokenizers library's cannot differ: up to Latin Extended-A.
PLAIN = re.compile("[^\\x00-\\u017f]|<\\|")


@functools.cache
def encoder(path: str, ranks: str | None):
    """text -> ids as the tokenizers library gives them; plain texts go through the same vocabulary as ranks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    slow = lambda t: whole.encode(t, add_special_tokens=False).ids
    if not ranks:
        return slow
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
    return lambda t: slow(t) if PLAIN.search(t) else fast(t)


def _pieces(path: str, ranks: str | None, limit: int, end: int):
    def run(batches):
        encode = encoder(path, ranks)
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
        for x in sliced(batches):
            rows = []
            for d, t in zip(x.column(0).to_pylist(), x.column(1).to_pylist()):
                raw = np.array([*encode(t or ""), end], dtype="<u4").tobytes()
                cuts = [0, *range(len(raw) // 4 % limit or limit, len(raw) // 4 + 1, limit)]
                rows += [(d, i, a, b - a, zlib.crc32(raw[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            yield batch(dict(zip(schema.names, zip(*rows) if rows else [()] * 5)), schema)

    return run


def plan(counts: list[int], limit: int) -> list[tuple[int, list[int]]]:
    """counts[n]: pieces of length n. Bin patterns, each as (how many bins, lengths in it), that use every piece once.

    A bin is filled greedily, the largest piece that fits first. Then its smallest piece goes out for the two
    unpacked pieces that fit the expanded gap most tightly, if that leaves a smaller gap; of pairs as tight as
    each other the one with the longer piece is taken. A pattern is repeated while the pieces for it last.
    """
    counts = list(counts)
    lengths = [n for n in range(1, limit + 1) if counts[n]]
    out = []
    while lengths:
        own, gap = [], limit
        spare: dict[int, int] = {}
        left = lambda n: counts[n] - spare.get(n, 0)  # noqa: B023, E731
        while gap:
            k = bisect_right(lengths, gap)
            while k and not left(lengths[k - 1]):
                k -= 1
            if not k:
                break
            n = lengths[k - 1]
            own.append(n)
            spare[n] = spare.get(n, 0) + 1
            gap -= n
        if gap and len(own) > 1:
            low = min(own)
            space = gap + low
            best, pair = low, None
            open_ = [n for n in lengths[: bisect_right(lengths, space - 1)] if left(n)]
            i, j = 0, len(open_) - 1
            while i <= j:
                total = open_[i] + open_[j]
                if total > space or i == j and left(open_[i]) < 2:
                    j -= 1
                    continue
                if total > best:
                    best, pair = total, (open_[i], open_[j])
                i += 1
            if pair:
                own.remove(low)
                own += pair
                spare[low] -= 1
                for n in pair:
                    spare[n] = spare.get(n, 0) + 1
        m = min(counts[n] // k for n, k in spare.items() if k)
        for n, k in spare.items():
            counts[n] -= m * k
        out.append((m, sorted(own, reverse=True)))
        lengths = [n for n in lengths if counts[n]]
    return out


def places(patterns: list[tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """For each length, runs of ranks: rows (first rank, first sequence, offset), by first rank."""
    runs: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for m, own in patterns:
        offset = 0
        for n in own:
            runs.setdefault(n, []).append((used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + m
            offset += n
        sequence += m
    return {n: np.array(x, dtype=np.int64) for n, x in runs.items()}


def _place(runs: dict[int, np.ndarray]):
    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
        for x in batches:
            length, rank = (x.column(x.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros((2, len(rank)), np.int64)
            for n in np.unique(length):
                at, own = np.flatnonzero(length == n), runs[int(n)]
                k = np.searchsorted(own[:, 0], rank[at], side="right") - 1
                sequence[at] = own[k, 1] + rank[at] - own[k, 0]
                offset[at] = own[k, 2]
            yield batch({c: x.column(x.schema.get_field_index(c)) for c in schema.names[:5]} | {"sequence_id": sequence, "offset": offset}, schema)

    return run


def pack(docs: DataFrame, path: str, ranks: str | None = None, limit: int = LIMIT, end: int = END) -> DataFrame:
    """Pieces of all documents with their place: sequences of at most `limit` tokens, gapless from offset 0.

    path: a tokenizers file; ranks: the same vocabulary for the fast encoder, or None. A document is its ids and then
    `end`; only longer ones are cut, into pieces of `limit` after a first piece that takes the rest. Null
    texts count as empty, so they are one piece of one token. Equal documents are packed one by one; equal lengths
    are ranked by doc_id and piece, so a rerun gives the same places. Repeated doc_ids keep all their pieces. An
    empty table gives an empty result; other columns are not read.

    Pieces of `limit` tokens are a sequence each. To the driver come at most `limit` counts; the plan sent to the executors has
    a run for each pattern and length.
    """
    spark = docs.sparkSession
    cut = texts(docs).mapInArrow(_pieces(path, ranks, limit, end), "doc_id long, piece int, start long, length long, ids_crc32 long")
    every = materialize(gathered(cut.withColumn("row", F.monotonically_increasing_id()), docs), "pieces")
    counts = [0] * (limit + 1)
    for r in every.where(F.col("length") < limit).groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most `limit` rows
        counts[r["length"]] = r["n"]
    full = every.where(F.col("length") == limit).select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    parts = spark.createDataFrame([(n, -(-k // RANKED)) for n, k in enumerate(counts) if k], "length long, parts int")  # at most `limit` rows
    own = every.where(F.col("length") < limit).join(F.broadcast(parts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), "parts"))
    tally = materialize(own.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "tally", rows=BATCH_NUMBERS)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")
    base = tally.select("length", "salt", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1
    ranked = own.withColumn("within", within).join(base, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("within"))
    placed = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long").alias("rank")).mapInArrow(
        _place(places(plan(counts, limit))), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return placed.union(full)
