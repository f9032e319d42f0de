"""Suffix-array deduplication: every byte that a string of 400 bytes covers which starts elsewhere too goes.

Texts are sharded by content. Each 400-byte string is handed to the smallest gram in it (its anchor), so equal strings, and
their whole neighbourhood, meet under one anchor; anchors that occur once are dropped by a count. The suffixes under
an anchor are then merged by iterative interleave refinement: one block at first, each round splits the blocks by
the next symbols of the suffixes in them, and blocks of one suffix retire. What is left after 400 bytes has a common prefix
of 400 bytes with a neighbour; adjoining ones are the repeated intervals. Suffixes are never sorted over their whole
length, and a suffix that differs early costs one round. Rounds take 16, 48 and 336 bytes, as hashed symbols of 64 bits, in
place of one byte each: 400 rounds over every byte of a corpus can't be paid.

What a shard calls equal is compared byte by byte, a run of adjoining strings at a time.

Frequent anchors are split into shards of about SHARD windows. A shard settles what it holds twice. The rest, and one of each
kind it settled, meet the other shards' in two steps: strings whose anchor is as far in, in steps of STEP bytes, share
a core; only where several shards' rows have a core are the keys of the whole strings counted, 64 bits within an anchor
of 64 bits. Both counts have partial sums before the shuffle.

Shorter passages (PASSAGE bytes, what a passage of over 50 words has at least) are found first; a repeated string of LENGTH
bytes stands within a run of repeated shorter ones, so the longer are looked for in those runs alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terminus.llm.common import batch, dropped, free, gathered, materialize, sliced

#: Bytes of a repeated string, of a repeated passage, of an anchor.
LENGTH, PASSAGE, GRAM = 400, 240, 48
#: Bytes of the symbols of the first rounds; the last round takes the rest.
ROUNDS = (16, 48)
#: Windows of an anchor that one task handles together.
SHARD = 128
#: Strings that start within so many bytes share a core.
STEP = 8
#: Texts are scanned in segments of so many bytes; a window has at most PIECE strings, and shards are merged together up to ROOM bytes.
SEGMENT, PIECE, ROOM = 1 << 20, 4096, 1 << 20
BASE = 0x9E3779B97F4A7C15 | 5
EMPTY = hashlib.sha256(b"").hexdigest()

_powers = np.ones((2, 1), np.uint64)


def powers(n: int) -> np.ndarray:
    """Rows: BASE ** i and its inverse, modulo 2 ** 64."""
    global _powers
    if _powers.shape[1] < n:
        size = 1 << max(16, (n - 1).bit_length())
        _powers = np.empty((2, size), np.uint64)
        for row, base in enumerate((BASE % (1 << 64), pow(BASE, -1, 1 << 64))):
            _powers[row, 0] = 1
            done = 1
            while done < size:
                _powers[row, done : 2 * done] = _powers[row, :done] * np.uint64(pow(base, done, 1 << 64))
                done *= 2
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def sums(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * powers(len(x) + 1)[0, : len(x)], out=out[1:])
    return out


def grams(total: np.ndarray, at: np.ndarray | slice, size: int) -> np.ndarray:
    """Hashes of the strings of `size` bytes at the places given."""
    inverse = _powers[1]
    if isinstance(at, slice):
        a, b = at.start, at.stop
        return mixed((total[a + size : b + size] - total[a:b]) * inverse[a:b])
    return mixed((total[at + size] - total[at]) * inverse[at])


def smallest(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each window of `width` places."""
    n = len(x)
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = x
    rows = full.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def anchors(raw: bytes, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last, places): the strings of `length` bytes that start from first to last have that anchor, at so
    many places of the text (several where the text has a short period)."""
    found = []
    place = np.uint64((1 << 21) - 1)
    for s in range(0, max(0, len(raw) - length + 1), SEGMENT):
        x = np.frombuffer(raw, np.uint8, min(len(raw) - s, SEGMENT + length - 1), s)
        g = grams(sums(x), slice(0, len(x) - gram + 1), gram)
        low = smallest(g & ~place | np.arange(len(g), dtype=np.uint64), length - gram + 1) & place
        own = g[low.astype(np.int64)]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        places = np.add.reduceat(np.concatenate([[1], low[1:] != low[:-1]]), first)
        found.append((own[first].view(np.int64), s + first, s + np.append(first[1:], len(own)) - 1, places))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 4


def _index(length: int):
    schema = pa.schema([("row", pa.int64()), ("part", pa.int64()), ("sig", pa.binary()), ("n_bytes", pa.int64()), ("sha", pa.string())])
    inner = pa.struct([("h", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("m", pa.int32())])

    def run(batches):
        for x in sliced(batches):
            raws = x.column(2).to_pylist()
            own = [anchors(r, length) for r in raws]
            at = np.concatenate([[0], np.cumsum([len(o[0]) for o in own])]) if own else np.zeros(1)
            cols = [np.concatenate([o[i] for o in own]) if own else np.empty(0, np.int64) for i in range(4)]
            items = pa.StructArray.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype()), f.type) for c, f in zip(cols, inner)], fields=list(inner))
            narrow = batch({"row": x.column(0), "part": x.column(1), "sig": [hashlib.md5(r).digest() for r in raws], "n_bytes": [len(r) for r in raws], "sha": [hashlib.sha256(r).hexdigest() for r in raws]}, schema)
            yield pa.RecordBatch.from_arrays([*narrow.columns, pa.ListArray.from_arrays(pa.array(at, pa.int32()), items)], names=[*schema.names, "anchors"])

    return run


INDEX_TYPE = "row long, part long, sig binary, n_bytes long, sha string, anchors array<struct<h:long,a:int,b:int,m:int>>"


def _windows(length: int):
    schema = pa.schema([("h", pa.int64()), ("salts", pa.int32()), ("salt", pa.int32()), ("sig", pa.binary()), ("at", pa.int64()), ("window", pa.binary())])

    def run(batches):
        for x in sliced(batches):
            rows: list = []
            for sig, raw, own in zip(*(x.column(i).to_pylist() for i in range(3))):
                for o in own:
                    for a in range(o["a"], o["b"] + 1, PIECE):
                        rows.append((o["h"], o["salts"], int.from_bytes(sig[:6]) % o["salts"], sig, a, raw[a : min(o["b"], a + PIECE - 1) + length]))
                        if len(rows) >= 512:
                            yield batch(dict(zip(schema.names, zip(*rows))), schema)
                            rows = []
            if rows:
                yield batch(dict(zip(schema.names, zip(*rows))), schema)

    return run


def equal(raw: bytes, alive: np.ndarray, like: np.ndarray, length: int) -> bool:
    """Whether the string at each place of `alive`, in order, has the bytes of that at the place of `like`; adjoining strings are compared as one."""
    new = np.flatnonzero(np.concatenate([[True], (alive[1:] != alive[:-1] + 1) | (like[1:] != like[:-1] + 1)])) if len(alive) else np.empty(0, int)
    for s, e in zip(new.tolist(), [*new[1:].tolist(), len(alive)]):
        a, b, n = int(alive[s]), int(like[s]), e - s - 1 + length
        if a != b and raw[a : a + n] != raw[b : b + n]:
            return False
    return True


def refine(windows: list[bytes], group: np.ndarray, length: int, rounds: tuple = ROUNDS):
    """Merge the suffixes that start in the windows. Returns the bytes' prefix sums, each suffix's place and window, the
    places whose string of `length` bytes starts twice or more in its group, and for these one place a block."""
    sizes = np.array([len(w) for w in windows])
    offset = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    raw = b"".join(windows)
    total = sums(np.frombuffer(raw, np.uint8))
    n = sizes - length + 1
    window = np.repeat(np.arange(len(windows)), n)
    place = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + offset[window]
    alive, block, depth, first = place, group[window].astype(np.uint64), 0, np.empty(0, np.int64)
    like = first
    for size in (*rounds, length - sum(rounds)):
        key = mixed(block * np.uint64(0xD6E8FEB86659FD93) + grams(total, alive + depth, size))
        _, index, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        first, kept = alive[index[count > 1]], count[inverse] > 1
        like = alive[index][inverse[kept]]
        alive, block, depth = alive[kept], inverse[kept].astype(np.uint64), depth + size
    if not equal(raw, alive, like, length):  # two strings of one hash: the bytes themselves decide
        kinds: dict[tuple, list[int]] = {}
        for p, w in zip(place.tolist(), window.tolist()):
            kinds.setdefault((int(group[w]), raw[p : p + length]), []).append(p)
        twice = [v for v in kinds.values() if len(v) > 1]
        alive, first = np.sort(np.array([p for v in twice for p in v], np.int64)), np.array([v[0] for v in twice], np.int64)
    return total, place, window, alive, first


OUT = pa.schema([("h", pa.int64()), ("sig", pa.binary()), ("a", pa.int64()), ("b", pa.int64()), ("core", pa.int64()), ("keys", pa.list_(pa.int64()))])
OUT_TYPE = "h long, sig binary, a long, b long, core long, keys array<long>"


def cores(total: np.ndarray, h: np.ndarray, window: np.ndarray, p: np.ndarray, anchor: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For strings at the places p with their anchor's place: where rows of adjoining strings that share a core begin, the cores, the strings' keys."""
    own = h[window].view(np.uint64)
    step = (anchor - p) // STEP
    core = mixed(grams(total, anchor - STEP * step, length - STEP + 1) + own + step.astype(np.uint64))
    start = np.flatnonzero(np.concatenate([[True], (core[1:] != core[:-1]) | (p[1:] != p[:-1] + 1) | (window[1:] != window[:-1])]))
    return start, core[start].view(np.int64), mixed(grams(total, p, length) + own).view(np.int64)


def _settle(h, salts, sig, at, windows, new, length):
    group = np.cumsum(new)
    total, place, window, alive, first = refine(windows, group, length)
    offset = np.concatenate([[0], np.cumsum([len(w) for w in windows])[:-1]])
    own = np.searchsorted(offset, alive, side="right") - 1
    out: dict = {c: [] for c in OUT.names}
    if len(alive):
        start = np.flatnonzero(np.concatenate([[True], (alive[1:] != alive[:-1] + 1) | (own[1:] != own[:-1])]))
        end = np.append(start[1:], len(alive)) - 1
        w = own[start]
        out = {"h": h[w], "sig": [sig[i] for i in w], "a": at[w] + alive[start] - offset[w], "b": at[w] + alive[end] - offset[w] + length, "core": [None] * len(w), "keys": [None] * len(w)}
    yield batch(out, OUT)
    if (many := salts > 1).any():
        all_grams = grams(total, slice(0, len(total) - GRAM), GRAM)
        anchor = np.flatnonzero(all_grams.view(np.int64) == h[np.searchsorted(offset, np.arange(len(all_grams)), side="right") - 1])
        open_ = many[window] & ~np.isin(place, alive, assume_unique=True)
        first = np.sort(first)
        o = np.searchsorted(offset, first, side="right") - 1
        for p, w, named in ((place[open_], window[open_], True), (first[many[o]], o[many[o]], False)):
            if not len(p):
                continue
            start, core, keys = cores(total, h, w, p, anchor[np.searchsorted(anchor, p)], length)
            ends = np.append(start[1:], len(p))
            for s in range(0, len(start), 4096):
                k = slice(s, s + 4096)
                lists = pa.ListArray.from_arrays(pa.array(np.append(start[k], ends[k][-1]) - start[s], pa.int32()), pa.array(keys[start[s] : ends[k][-1]]))
                x = w[start[k]]
                a = at[x] + p[start[k]] - offset[x]
                yield batch({"h": h[x], "sig": [sig[i] if named else None for i in x], "a": a, "b": a, "core": core[k], "keys": lists}, OUT)


def _merge(length: int):
    """Windows sorted by anchor and salt; a shard that goes over a batch's end is carried on."""

    def run(batches):
        kept: list | None = None
        for x in [None], batches:
            for b in x:
                if b is not None and b.num_rows:
                    cols = [b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4)] + [b.column(3).to_pylist(), b.column(5).to_pylist()]
                    kept = cols if kept is None else [np.concatenate(c) if i < 4 else c[0] + c[1] for i, c in enumerate(zip(kept, cols))]
                    h, salt = kept[0], kept[2]
                    new = np.concatenate([[True], (h[1:] != h[:-1]) | (salt[1:] != salt[:-1])])
                    starts = np.flatnonzero(new)
                    size = np.concatenate([[0], np.cumsum([len(w) for w in kept[5]])])
                    done = 0
                    while done < len(starts) - 1:  # the last shard may go on
                        i = starts[done]
                        done = max(done + 1, int(np.searchsorted(size[starts[:-1]], size[i] + ROOM)))
                        j = starts[done]
                        yield from _settle(h[i:j], kept[1][i:j], kept[4][i:j], kept[3][i:j], kept[5][i:j], new[i:j], length)
                    kept = [c[starts[-1] :] for c in kept]
        if kept is not None:
            yield from _settle(kept[0], kept[1], kept[4], kept[3], kept[5], np.arange(len(kept[0])) == 0, length)

    return run


def union(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Spans joined where they overlap or touch."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def spans_of(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs: (row, part, raw) with bytes, named by row and part. Three tables: (row, part, sig, n_bytes, sha) of all; (sig, copies) of each text;
    (sig, raw, spans, id) of the texts that hold repeated strings of `length` bytes beside a whole copy, spans sorted and apart.

    A sig is in each of the last two once, so a text that very many documents have is met by one join that can be split."""
    index = materialize(gathered(docs.mapInArrow(_index(length), INDEX_TYPE), docs), "index")
    name = F.xxhash64("row", "part").alias("name")  # rows of one text that share it are copies like all others
    same = index.select("sig", name).groupBy("sig").agg(F.count(F.lit(1)).alias("copies"), F.min("name").alias("name"))
    one = index.select("sig", name, "anchors").join(same, ["sig", "name"], "left_semi")
    each = one.select("sig", "name", F.inline("anchors"))
    often = each.groupBy("h").agg(F.sum("m").alias("n")).where("n > 1").select("h", F.ceil(F.col("n") / SHARD).cast("int").alias("salts"))
    wanted = each.join(often, "h").groupBy("sig", "name").agg(F.collect_list(F.struct("h", "salts", "a", "b")).alias("own"))
    source = docs.select("raw", name, F.unhex(F.md5("raw")).alias("sig"))
    some = materialize(source.join(wanted, ["sig", "name"]).dropDuplicates(["sig", "name"]).select("sig", "raw", "own"), "candidates", "zstd")
    shards = some.mapInArrow(_windows(length), "h long, salts int, salt int, sig binary, at long, window binary").repartition("h", "salt").sortWithinPartitions("h", "salt")
    found = materialize(shards.mapInArrow(_merge(length), OUT_TYPE), "repeats")
    open_ = found.where("core is not null")
    shared = open_.groupBy("h", "core").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keys = materialize(open_.join(shared, ["h", "core"], "left_semi").select("h", "sig", "a", F.posexplode("keys").alias("i", "key")), "keys")
    twice = keys.groupBy("h", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = keys.where("sig is not null").join(twice, ["h", "key"], "left_semi").select("sig", (F.col("a") + F.col("i")).alias("a"))
    spans = found.where("core is null").select("sig", "a", "b").union(met.select("sig", "a", F.col("a") + length))
    spans = spans.groupBy("sig").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    held = materialize(some.select("sig", "raw").join(spans, "sig").withColumn("id", F.monotonically_increasing_id()), "spans", "zstd")
    dropped(some, found, keys)
    return index.drop("anchors"), same.select("sig", "copies"), held


def _cut(batches):
    schema = pa.schema([("sig", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha", pa.string()), ("kept", pa.string())])
    for x in sliced(batches):
        rows = []
        for sig, raw, own in zip(*(x.column(i).to_pylist() for i in range(3))):
            left, spans = without(raw, [(o["a"], o["b"]) for o in own])
            rows.append((sig, len(raw) - len(left), spans, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore")))
        yield batch(dict(zip(schema.names, zip(*rows) if rows else [()] * 5)), schema)


CUT_TYPE = "sig binary, n_removed long, n_spans long, kept_sha string, kept string"


def without(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes that no span covers, and the number of maximal spans."""
    out, end, apart = [], 0, union(spans)
    for a, b in apart:
        out.append(raw[end:a])
        end = b
    return b"".join([*out, raw[end:]]), len(apart)


def _runs(length: int):
    """The runs of spans that have `length` bytes or more, as texts of their own."""
    schema = pa.schema([("row", pa.int64()), ("part", pa.int64()), ("raw", pa.binary())])

    def run(batches):
        for x in sliced(batches):
            rows = []
            for row, raw, own in zip(*(x.column(i).to_pylist() for i in range(3))):
                rows += [(row, a, raw[a:b]) for a, b in union([(o["a"], o["b"]) for o in own]) if b - a >= length]
            yield batch(dict(zip(schema.names, zip(*rows) if rows else [()] * 3)), schema)

    return run


def _covered(batches):
    schema = pa.schema([("sig", pa.binary()), ("n_passage", pa.int64())])
    for x in sliced(batches):
        yield batch({"sig": x.column(0), "n_passage": [sum(b - a for a, b in union([(o["a"], o["b"]) for o in own])) for own in x.column(1).to_pylist()]}, schema)


def _named(docs: DataFrame) -> DataFrame:
    """(row, part, raw) of all documents; those without doc_id are told apart by their text alone."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("row"), F.col("doc_id").isNull().cast("long").alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("raw"))


def deduplicate(docs: DataFrame, length: int = LENGTH, passage: int = PASSAGE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and n_passage: the bytes covered by strings of `passage` bytes that start elsewhere too.

    Null texts count as empty; texts shorter than the string keep all. Documents with equal texts of `length` bytes or more lose
    all; repeated rows are such copies, whatever their doc_id. Strings are judged on the input, overlaps count, and a
    string may repeat in its own document. An empty table gives an empty result; other columns are not read. Equal
    texts are merged once, so their number doesn't matter; strings of one shard are compared by bytes, those that only shards
    of a frequent anchor share by 64 bits within an anchor of 64 bits.
    """
    every, same, short = spans_of(_named(docs), passage)
    runs = materialize(short.select("id", "raw", "spans").mapInArrow(_runs(length), "row long, part long, raw binary"), "runs", "zstd")
    parts, again, inner = spans_of(runs, length)
    dropped(runs)
    parts = parts.withColumnRenamed("sig", "of")
    whole = parts.join(again.where("copies > 1").withColumnRenamed("sig", "of"), "of").select("row", F.struct(F.col("part").alias("a"), (F.col("part") + F.col("n_bytes")).alias("b")).alias("span"))
    some = parts.join(inner.select(F.col("sig").alias("of"), "spans"), "of").select("row", F.explode("spans").alias("s"), "part").select("row", F.struct((F.col("part") + F.col("s.a")).alias("a"), (F.col("part") + F.col("s.b")).alias("b")).alias("span"))
    long_ = whole.union(some).groupBy("row").agg(F.collect_list("span").alias("spans"))
    cut = short.select(F.col("id").alias("row"), "sig", "raw").join(long_, "row").select("sig", "raw", "spans").mapInArrow(_cut, CUT_TYPE).drop("kept")
    covered = short.select("sig", "spans").mapInArrow(_covered, "sig binary, n_passage long")
    out = every.join(same.join(covered, "sig", "left").join(cut, "sig", "left"), "sig")
    copied = F.col("copies") > 1
    gone = copied & (F.col("n_bytes") >= length)
    return out.select(
        F.when(F.col("part") == 0, F.col("row")).alias("doc_id"),
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        F.when(copied & (F.col("n_bytes") >= passage), F.col("n_bytes")).otherwise(F.coalesce("n_passage", F.lit(0))).cast("long").alias("n_passage"),
    )


def cleaned(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents as they were given, without the bytes that strings of `length` bytes cover which start elsewhere too; n_chars, if there, follows the text.

    Null texts stay null with their n_chars, documents that lose all have an empty text. Where a span ends within a character, the rest of
    that character goes too. Repeated rows are copies of each other, so they lose all. Extra columns keep their names and values.
    """
    _, same, held = spans_of(_named(docs), length)
    cut = held.select("sig", "raw", "spans").mapInArrow(_cut, CUT_TYPE).select("sig", "kept")
    one, sig, copies, kept = free(docs.columns, "one", "sig", "copies", "kept")
    each = same.join(cut, "sig", "left").where("copies > 1 or kept is not null").select(F.col("sig").alias(sig), F.col("copies").alias(copies), F.col("kept").alias(kept))
    own = docs.withColumn(one, F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))).join(each, F.col(one) == F.col(sig), "left")
    whole = (F.col(copies) > 1) & (F.octet_length("text") >= length)
    text = F.when(F.col("text").isNull(), F.lit(None)).when(whole, F.lit("")).otherwise(F.coalesce(kept, "text"))
    own = own.withColumn("text", text).select(*docs.columns)
    return own.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars")) if "n_chars" in docs.columns else own
