"""SimHash near-duplicates: an inverted index on byte positions with count filtering.

A fingerprint has eight bytes. Two that differ in at most `BITS` = 2 bits share at least six bytes at their positions, so
the count filter's guaranteed minimum is six matches. Tallying single-byte postings would pair everything in a list
of 1/256 of the corpus; instead a posting is made for each of the 28 choices of six positions, which is where any pair with
six matches must meet. Members of a list differ in two bytes only, so a list never has more than 65,536 different
fingerprints whatever the corpus holds; links in it are verified by counting shared bytes and differing bits, and
only a spanning forest of them leaves the list.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terminus.llm.common import batch, gathered, materialize, sliced, texts
from terminus.llm.components import components, local_labels

WORDS, SEED, BITS = 3, 42, 2
#: Bytes that two fingerprints within BITS bits share at least.
LEAST_BYTES = 8 - BITS
#: Masks that leave LEAST_BYTES of the eight bytes.
MASKS = [sum(0xFF << (8 * i) for i in kept) for kept in combinations(range(8), LEAST_BYTES)]
#: Lists of more members than this look their neighbours up by bit flips instead of comparing pairs.
PAIRWISE = 128


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64 majority bits over the XXH64 values of all word shingles of a whole text; 0 if it has no word."""
    own = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return 0
    line, ends = b" ".join(own), np.cumsum([len(w) + 1 for w in own])
    k = min(words, len(own))
    starts = np.concatenate([[0], ends[:-1]])[: len(own) - k + 1].tolist()
    stops = (ends[k - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    votes, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, 65536):
        h = np.array([digest(line[s:e], SEED) for s, e in zip(starts[at : at + 65536], stops[at : at + 65536])], dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def _fingerprints(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
    for x in sliced(batches):
        fp = np.array([fingerprint(t) for t in x.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
        yield batch({"doc_id": x.column(0), "fp": fp}, schema)


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


def _links(group: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by list: a spanning forest of the links in each list, as pairs of fingerprints."""
    n = len(fp)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, n))
    small, a, b = np.repeat(sizes <= PAIRWISE, sizes), [], []
    here = np.flatnonzero(small & (np.repeat(sizes, sizes) > 1))
    lag = 1
    while len(here):
        here = here[here + lag < n]
        here = here[group[here] == group[np.minimum(here + lag, n - 1)]]
        differ = fp[here] ^ fp[here + lag]
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = (shared >= LEAST_BYTES) & (_bits(differ) <= BITS)
        a.append(here[near])
        b.append(here[near] + lag)
        lag += 1
    for s, size in zip(starts[sizes > PAIRWISE], sizes[sizes > PAIRWISE]):
        own = fp[s : s + size].view(np.uint64)
        order = np.argsort(own)
        free = int(np.bitwise_or.reduce(own ^ own[0]))
        bits = [1 << i for i in range(64) if free >> i & 1]
        for flip in bits + [x | y for x, y in combinations(bits, 2)]:
            other = own ^ np.uint64(flip)
            at = np.minimum(np.searchsorted(own[order], other), size - 1)
            hit = np.flatnonzero((own[order[at]] == other) & (own < other))
            a.append(s + hit)
            b.append(s + order[at[hit]])
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
    root = local_labels(n, a, b)
    own = np.flatnonzero(root != np.arange(n))
    return fp[own], fp[root[own]]


def _scan(batches):
    """Sorted postings (slot, rest, fp): links of each list; a list that goes over a batch's end is carried on."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    kept = None
    for x in batches:
        cols = [np.asarray(x.column(i).to_numpy(zero_copy_only=False)) for i in range(3)]
        cols[0] = cols[0].astype(np.int64)
        if kept is not None:
            cols = [np.concatenate([k, c]) for k, c in zip(kept, cols)]
        slot, rest, fp = cols
        new = np.concatenate([[True], (slot[1:] != slot[:-1]) | (rest[1:] != rest[:-1])]) if len(fp) else np.empty(0, bool)
        if not len(fp):
            continue
        last = int(np.flatnonzero(new)[-1])
        kept = [c[last:] for c in cols]
        if last:
            u, v = _links(np.cumsum(new)[:last], fp[:last])
            yield batch({"u": u, "v": v}, schema)
    if kept is not None and len(kept[2]) > 1:
        u, v = _links(np.zeros(len(kept[2]), np.int64), kept[2])
        yield batch({"u": u, "v": v}, schema)


def links_of(distinct: DataFrame) -> DataFrame:
    """(u, v): links of at most two bits among the distinct fingerprints (fp), by the index; of each list a spanning forest."""
    signed = [m - (1 << 64) if m >> 63 else m for m in MASKS]
    posted = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("slot", "rest"))
    return posted.select("slot", "rest", "fp").repartition("slot", "rest").sortWithinPartitions("slot", "rest").mapInArrow(_scan, "u long, v long")


def linked(distinct: DataFrame) -> DataFrame:
    """(fp, root) for each of the distinct fingerprints (fp) that has a link of at most two bits, by the index; root is the smallest that links lead to."""
    return components(links_of(distinct), "simhash").withColumnRenamed("node", "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every document with its fingerprint and the smallest doc_id that links of at most two bits lead to.

    Null and empty texts and texts of white space have fingerprint zero and are linked like any other. Equal texts
    share a fingerprint, are collapsed before the index and come back by a join that adaptive execution can split, so
    a third of all rows may be copies of one text. Ties cannot occur: a component is named by its smallest doc_id.
    An empty table gives an empty result; columns besides doc_id and text are not touched.
    """
    own = materialize(gathered(texts(docs).mapInArrow(_fingerprints, "doc_id long, fp long"), docs), "fingerprints")
    distinct = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    named = distinct.join(linked(distinct), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "root").select("fp", "component_id")
    return own.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
