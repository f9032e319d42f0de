"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, and what such links lead to.

Candidates come from operator 7's index of SimHash fingerprints and from MinHash bands, links from the exact sets. Two texts of similarity s share a band with probability s**ROWS, so a pair
at 0.8 is missed with probability (1 - 0.8**5)**30, 7 in a million. Of a band's list of up to `FEW` texts all pairs are candidates.
In a longer list each text first meets the one that it agrees with most of the first `NEAREST` in all its lists, those that share lists with most others,
as the original of many copies does: one comparison a text. Then, round by round, those that links don't connect yet meet the first `HEADS` and sixteen times
as many each time, until the list is one component or each such pair was compared: nothing is cut off. A pair is passed over only where its
similarity can't be reached: shingles that a text of the long lists shares with none of the others are in no overlap of it; and where
fewer than `MATCHES` of the 150 minima agree, which happens to a pair at 0.8 with probability 3 in a million; and where the parities of the shingles in
`PARITY` classes differ in more places than the sets may differ in shingles, which happens to no pair at 0.8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terminus.llm.common import BATCH_NUMBERS, batch, dropped, free, gathered, materialize, sliced
from terminus.llm.components import components
from terminus.llm.simhash import fingerprint, links_of

WORDS, SEED, BANDS, ROWS = 5, 42, 30, 5
#: Similarity of 4 / 5 or more, in whole numbers.
LEAST = (4, 5)
#: Minima that must agree, of which a byte each is compared; equal ones always do. Bits of parity beside them.
MATCHES, PARITY = 97, 1024
#: Texts of a list that are all compared with each other; those of a longer one that all meet first, and those of which each text first meets one.
FEW, HEADS, NEAREST = 32, 2, 8
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Sorted XXH64 values of the distinct shingles of five words, of all words where there are fewer; empty without a word."""
    own = [w.encode("utf-8", "surrogatepass") for w in (text or "").lower().split()]
    if not own:
        return np.empty(0, np.uint64)
    line, ends = b" ".join(own), np.cumsum([len(w) + 1 for w in own])
    k = min(WORDS, len(own))
    starts = np.concatenate([[0], ends[:-1]])[: len(own) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts, (ends[k - 1 :] - 1).tolist())), np.uint64, len(starts)))


def minima(own: np.ndarray) -> np.ndarray:
    """The least value of the shingles under each hash."""
    low = np.full(len(FACTORS), (1 << 64) - 1, np.uint64)
    for at in range(0, len(own), 2048):
        np.minimum(low, (own[None, at : at + 2048] * FACTORS[:, None]).min(axis=1), out=low)
    return low


def bands(own: np.ndarray) -> list[int]:
    """One key for each band of minima; none without a shingle."""
    return _keys(minima(own)) if len(own) else []


def _keys(low: np.ndarray) -> list[int]:
    return [xxhash.xxh64_intdigest(low[i : i + ROWS].tobytes()) - (1 << 63) for i in range(0, len(low), ROWS)]


def sketch_of(own: np.ndarray, low: np.ndarray) -> bytes:
    """A byte of each minimum, then whether each class of shingles has an odd number of them."""
    odd = np.bincount((own % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return (low >> np.uint64(56)).astype(np.uint8).tobytes() + np.packbits(odd.astype(np.uint8)).tobytes()


def agreeing(sketch: np.ndarray, n: np.ndarray, other: np.ndarray, other_n: int) -> np.ndarray:
    """Minima that agree with another text's; -1 where the parities show that the sets of these sizes differ in too many shingles."""
    low = len(FACTORS)
    differ = np.bitwise_count(sketch[:, low:] ^ other[low:]).sum(axis=1, dtype=np.int64)
    return np.where((LEAST[0] + LEAST[1]) * differ <= (LEAST[1] - LEAST[0]) * (n + other_n), (sketch[:, :low] == other[:low]).sum(axis=1), -1)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    if LEAST[1] * min(len(a), len(b)) < LEAST[0] * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return LEAST[1] * both >= LEAST[0] * (len(a) + len(b) - both)


def _signed(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("node", pa.int64()), ("fp", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])
    for x in sliced(batches):
        sets = [shingles(t) for t in x.column(2).to_pylist()]
        low = [minima(s) for s in sets]
        yield batch({"doc_id": x.column(0), "hash": x.column(1), "node": [xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) for s in sets], "fp": np.array([fingerprint(t) for t in x.column(2).to_pylist()], np.uint64).view(np.int64), "bands": [_keys(m) if len(s) else [] for s, m in zip(sets, low)], "sketch": [sketch_of(s, m) for s, m in zip(sets, low)]}, schema)


def _sets(batches):
    schema = pa.schema([("node", pa.int64()), ("held", pa.binary())])
    for x in sliced(batches):
        yield batch({"node": x.column(0), "held": [shingles(t).tobytes() for t in x.column(1).to_pylist()]}, schema)


def _verified(batches):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    for x in sliced(batches):
        held = zip(x.column(2).to_pylist(), x.column(3).to_pylist())
        near = np.fromiter((alike(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in held), bool, x.num_rows)
        yield batch({"u": x.column(0).filter(pa.array(near)), "v": x.column(1).filter(pa.array(near))}, schema)


def _lists(batches, columns):
    """Sorted rows whose first `columns` name a list: the columns of one list at a time, also of one that goes over a batch's end. Bytes become rows of an array."""
    numbers = lambda c: np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), -1) if pa.types.is_binary(c.type) else np.asarray(c.to_numpy(zero_copy_only=False)).astype(np.int64)
    kept = None
    for x in batches:
        if not x.num_rows:
            continue
        cols = [numbers(c) for c in x.columns]
        if kept is not None:
            cols = [np.concatenate([k, c]) for k, c in zip(kept, cols)]
        new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:columns]])) + 1
        edges = [0, *new.tolist()]
        for s, e in zip(edges, edges[1:]):
            if e - s > 1:
                yield [c[s:e] for c in cols]
        kept = [c[edges[-1] :] for c in cols]
    if kept is not None and len(kept[0]) > 1:
        yield kept


FOUND = "kind long, u long, v long"


def _rows(found):
    """(kind, u, v) arrays as batches of bounded size."""
    schema = pa.schema([("kind", pa.int64()), ("u", pa.int64()), ("v", pa.int64())])
    held, n = [], 0
    for part in found:
        held.append(part)
        if (n := n + len(part[1])) > 50_000:
            yield batch(dict(zip(schema.names, map(np.concatenate, zip(*held)))), schema)
            held, n = [], 0
    if held:
        yield batch(dict(zip(schema.names, map(np.concatenate, zip(*held)))), schema)


def _candidates(batches):
    """Pairs (0, u, v) of each list (band, key, node), and the members (1, node, size) of a long one."""

    def found():
        for _, _, node in _lists(batches, 2):
            n = len(node)
            for at in range(1, n) if n <= FEW else ():
                yield np.zeros(n - at, np.int64), node[:-at], node[at:]
            if n > FEW:
                yield np.ones(n, np.int64), node, np.full(n, n)

    yield from _rows(found())


def reachable(n: np.ndarray, own: np.ndarray, other_n: int, other_own: int) -> np.ndarray:
    """Whether sets of these sizes, so many of whose shingles are in no other set, can have the least similarity."""
    most = np.minimum(n - own, other_n - other_own)
    return (LEAST[0] + LEAST[1]) * most >= LEAST[0] * (n + other_n)


def _shingled(batches):
    schema = pa.schema([("node", pa.int64()), ("shingle", pa.int64())])
    for x in sliced(batches):
        for node, held in zip(x.column(0).to_pylist(), x.column(1).to_pylist()):
            own = np.frombuffer(held, np.int64)
            yield batch({"node": np.full(len(own), node), "shingle": own}, schema)


def _across(low, high):
    """Pairs of each long list (band, key, order, node, root, n, own, sketch) that have other roots, can be alike, and have one of them at a place from low to high;
    (1, -, -) for a list to go on with."""

    def run(batches):
        def found():
            for _, _, _, node, root, n, own, sketch in _lists(batches, 2):
                if len(node) <= FEW or (root == root[0]).all():
                    continue
                for at in range(low, min(high, len(node))):
                    other = np.flatnonzero((root[at + 1 :] != root[at]) & reachable(n[at + 1 :], own[at + 1 :], n[at], own[at])) + at + 1
                    other = other[agreeing(sketch[other], n[other], sketch[at], n[at]) >= MATCHES]
                    yield np.zeros(len(other), np.int64), np.full(len(other), node[at]), node[other]
                if len(node) > high:
                    yield np.ones(1, np.int64), node[:1], node[:1]

        yield from _rows(found())

    return run


def _nearest(batches):
    """(minima that agree, head, node) for each text of a long list and the one of its first `NEAREST` that it agrees with most, of those that have another root and can be alike."""

    def found():
        for _, _, _, node, root, n, own, sketch in _lists(batches, 2):
            if len(node) <= FEW or (root == root[0]).all():
                continue
            most, head = np.full(len(node), -1), np.zeros(len(node), np.int64)
            for at in range(NEAREST):
                agree = np.where((root != root[at]) & reachable(n, own, n[at], own[at]), agreeing(sketch, n, sketch[at], n[at]), -1)
                head, most = np.where(agree > most, node[at], head), np.maximum(agree, most)
            near = most >= MATCHES
            yield most[near], head[near], node[near]

    yield from _rows(found())


def by_fingerprint(own: DataFrame) -> DataFrame:
    """Candidates (0, u, v): the sets (node) that have one SimHash fingerprint (fp), each with the smallest of them, and the smallest of two
    fingerprints that operator 7's index links. What links lead to is asked of the exact sets alone, so no components are made of fingerprints."""
    held = materialize(own.select("node", "fp").distinct(), "fingerprints", rows=BATCH_NUMBERS)
    least = materialize(held.groupBy("fp").agg(F.min("node").alias("v")), "least", rows=BATCH_NUMBERS)
    links = materialize(links_of(least.select("fp")).distinct(), "alike", rows=BATCH_NUMBERS)
    ends = links.join(least.select(F.col("fp").alias("u"), F.col("v").alias("first")), "u").join(least.select(F.col("fp").alias("v"), F.col("v").alias("second")), "v")
    pairs = held.join(least, "fp").select(F.col("node").alias("u"), "v").union(ends.select("first", "second")).where("u != v")
    out = materialize(pairs.select(F.lit(0).cast("long").alias("kind"), "u", "v"), "similar", rows=BATCH_NUMBERS)
    dropped(held, least, links)
    return out


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id and hash (of text) of the first row of each group of near copies.

    First is the smallest doc_id, null after all others, and of one doc_id the smallest hash. Texts with equal sets count as one before
    anything is compared; null texts and texts without a word are one group. An empty table gives an empty result.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), F.col("text").cast("string").alias("text"))
    own = materialize(gathered(keyed.mapInArrow(_signed, "doc_id long, hash long, node long, fp long, bands array<long>, sketch binary"), docs), "signed")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("first")
    distinct = materialize(own.groupBy("node").agg(least, F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")), "sets")
    similar = by_fingerprint(own)
    posted = distinct.select(F.posexplode("bands").alias("band", "key"), "node").repartition("band", "key").sortWithinPartitions("band", "key", "node")
    found = materialize(posted.mapInArrow(_candidates, FOUND), "candidates", rows=BATCH_NUMBERS)
    crowd = materialize(found.where("kind = 1").groupBy(F.col("u").alias("node")).agg(F.max("v").alias("size"), (-F.sum("v")).alias("order")), "crowd", rows=BATCH_NUMBERS)

    def asked(found: DataFrame) -> DataFrame:
        return materialize(found.where("kind = 0").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "pairs", rows=BATCH_NUMBERS)

    def verified(pairs: DataFrame) -> DataFrame:
        sides = pairs.join(held.select(F.col("node").alias("v"), F.col("held").alias("of_v")), "v")
        sides = sides.join(held.select(F.col("node").alias("u"), F.col("held").alias("of_u")), "u").select("u", "v", "of_u", "of_v")
        out = materialize(sides.mapInArrow(_verified, "u long, v long"), "links")
        dropped(pairs)
        return out

    pairs = asked(found.union(similar))
    dropped(found, similar)
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).union(crowd.select("node")).distinct()
    nodes = distinct.join(nodes, "node").select("node", F.col("first.doc_id").alias("own_id"), F.col("first.hash").alias("own_hash"))
    text = keyed.join(nodes, keyed["doc_id"].eqNullSafe(F.col("own_id")) & (keyed["hash"] == F.col("own_hash"))).select("node", "text")
    each = materialize(text.mapInArrow(_sets, "node long, held binary"), "held")
    held = materialize(each.dropDuplicates(["node"]), "held")  # of all that later rounds ask for, too
    dropped(each)
    links = verified(pairs)
    roots = components(links, "copies")
    crowded = held.join(crowd, "node").select("node", "order", (F.octet_length("held") / 8).cast("long").alias("n"), "held")
    alone = crowded.select("node", "held").mapInArrow(_shingled, "node long, shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("node")).where("k = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    crowded = materialize(crowded.select("node", "order", "n").join(alone, "node", "left").fillna(0, ["own"]), "crowded", rows=BATCH_NUMBERS)
    longest = crowd.agg(F.max("size")).first()[0] or 0

    def crowds() -> DataFrame:
        """(band, key, order, node, root, n, own, sketch) of the long lists' texts, sorted by list."""
        named = distinct.join(crowded, "node").join(roots, "node", "left").select("bands", "order", "node", F.coalesce("root", "node").alias("root"), "n", "own", "sketch")
        named = named.repartition("root", "node").select(F.posexplode("bands").alias("band", "key"), "order", "node", "root", "n", "own", "sketch")  # an even share to a task, also where the joins above are broadcast
        return named.repartition("band", "key").sortWithinPartitions("band", "key", "order", "node")

    low, high = 0, 0
    while low < longest:
        more = crowds().mapInArrow(_across(low, high) if high else _nearest, FOUND)
        if not high:
            more = more.groupBy("v").agg(F.max_by("u", F.struct("kind", "u")).alias("u")).select(F.lit(0).alias("kind"), "u", "v")
        more = materialize(more, "across", rows=BATCH_NUMBERS)
        if high and more.isEmpty():
            break
        pairs = asked(more)
        dropped(more)
        if not (fresh := verified(pairs)).isEmpty():  # else the components are as they were
            links = links.union(fresh)
            roots = components(links, "copies")
        low, high = high, max(HEADS, 16 * high)
    dropped(held)
    named = distinct.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    firsts = named.groupBy("root").agg(F.min("first").alias("lowest"))
    return firsts.select(F.col("lowest.doc_id").alias("doc_id"), F.col("lowest.hash").alias("hash"))


def first_copies(docs: DataFrame) -> DataFrame:
    """The documents as they were given, of each group of near copies the first row alone; rows are told apart by doc_id and text, repeated ones count as one.

    A group without doc_id keeps a row too. Extra columns keep their names and values."""
    doc, text, own = free(docs.columns, "first_id", "first_hash", "own_hash")
    first = near_copies(docs).select(F.col("doc_id").alias(doc), F.col("hash").alias(text))
    keyed = docs.withColumn(own, F.xxhash64("text"))
    kept = keyed.join(first, F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(text)), "left_semi")
    return kept.dropDuplicates(["doc_id", own]).drop(own)
