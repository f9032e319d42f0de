"""BPE encoding and decoding by tree concatenation.

A text longer than a leaf is cut into halves, these again, down to leaves that are encoded for themselves; halves are then joined
pairwise, level by level: the text around each join is encoded again in a window that grows until it agrees with both
sides, token for token and place for place, or is both sides. The rest of the halves is taken as it is.

There are two encoders below the tree. Where white space, which the tokenizer drops, ends words, tokens are gathered by word: a word is split by the
tokenizer's own pattern, encoded by its model and remembered, so a side agrees with a window from the first whole word they share.
Unsplit text (a word longer than a leaf, and texts beyond Latin Extended-A) goes to the library, the leaves of a text in one call that runs them in
parallel; there a side agrees with a window where eight tokens in a row are the same. One would do: in a byte-pair encoding
every two neighbours are encoded as themselves, and a sequence in which that holds for all neighbours is the encoding.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from terminus.llm.common import batch, sliced, texts

#: Characters of a leaf; longer text is encoded as a tree.
LEAF = 1024
#: Threads that encode the leaves of one text where the session's machine doesn't say otherwise.
THREADS = 2
#: Tokens on either side that a window must share with what it meets, and its characters on either side at first.
AGREE, WINDOW = 8, 128
#: Words remembered by a worker; it starts over beyond.
REMEMBER = 300_000
#: Up to Latin Extended-A the library's and Python's ideas of white space and normal form are the same; the four information separators are not white space to the library.
WORD = re.compile(r"\S+")
#: Characters on either side of a join of words at first.
EDGE = 32
PLAIN = re.compile("[^\\x00-\\x1b\\x20-\\x84\\x86-\\u017f]")


@functools.cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return own


def _encode(own, parts: list[tuple[int, str]]) -> list[list[tuple[int, int, int]]]:
    """For each (place, text) its tokens as (id, start, end), places counted in the whole text."""
    done = own.encode_batch([t for _, t in parts], add_special_tokens=False)
    return [[(i, at + a, at + b) for i, (a, b) in zip(e.ids, e.offsets)] for (at, _), e in zip(parts, done)]


def _meet(left: list, window: list, right: list, agree: int) -> list | None:
    """left, window and right as one list, if the window has `agree` tokens in a row that left has, and that right has."""
    where = {t: i for i, t in enumerate(left[-len(window) - agree - 1 :], max(0, len(left) - len(window) - agree - 1))}
    a = next((k for k in range(1, len(window) - agree) if (i := where.get(window[k])) is not None and left[i : i + agree] == window[k : k + agree]), None)
    if a is None:
        return None
    where_r = {t: i for i, t in enumerate(right[: len(window) + agree + 1])}
    for k in range(len(window) - agree - 1, a, -1):
        if (j := where_r.get(window[k])) is not None and right[j : j + agree] == window[k : k + agree]:
            return left[: where[window[a]]] + window[a:k] + right[j:]
    return None


def encode_tree(text: str, path: str, leaf: int = LEAF, window: int = WINDOW, agree: int = AGREE) -> list[int]:
    """The ids of a text as the library gives them for the whole."""
    own = tokenizer(path)
    if len(text) <= leaf or "<|" in text:  # marks of special tokens are found in the whole text only
        return own.encode(text, add_special_tokens=False).ids
    cuts = [*range(0, len(text), leaf), len(text)]
    spans = list(zip(cuts, cuts[1:]))
    parts = _encode(own, [(a, text[a:b]) for a, b in spans])
    while len(parts) > 1:
        joins = list(range(0, len(parts) - 1, 2))
        merged: dict[int, list] = {}
        size = window
        while open_ := [i for i in joins if i not in merged]:
            ask = [(max(spans[i][0], spans[i][1] - size), min(spans[i + 1][1], spans[i + 1][0] + size)) for i in open_]
            for i, (a, b), got in zip(open_, ask, _encode(own, [(a, text[a:b]) for a, b in ask])):
                if (a, b) == (spans[i][0], spans[i + 1][1]):
                    merged[i] = got
                elif both := _meet(parts[i], got, parts[i + 1], agree):
                    merged[i] = both
            size *= 2
        odd = len(parts) % 2
        parts, spans = [merged[i] for i in joins] + parts[-1:] * odd, [(spans[i][0], spans[i + 1][1]) for i in joins] + spans[-1:] * odd
    return [t[0] for t in parts[0]]


@functools.cache
def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves, others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def word_rule(path: str) -> str | None:
    """How the tokenizer splits a word, if it only lower-cases plain words, splits by one pattern and maps bytes to letters; else None."""
    own = json.loads(tokenizer(path).to_str())
    normal = [x["type"] for x in (own["normalizer"] or {}).get("normalizers", [])]
    splits = (own["pre_tokenizer"] or {}).get("pretokenizers", [])
    if normal != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in splits] != ["Split", "ByteLevel"] or own["post_processor"] or own["decoder"]:
        return None
    first, second = splits
    if own["normalizer"]["normalizers"][1]["pattern"] != {"Regex": r"\s+"} or not first["invert"] or first["behavior"] != "Removed" or second["add_prefix_space"] or second["use_regex"]:
        return None
    return first["pattern"].get("Regex")


def _joined(text: str, a: int, m: int, b: int, left: list[str], right: list[str], size: int = EDGE) -> list[str]:
    """The words of text[a:b] from those of both sides of m: a window around m grows until it shares a whole word with either side, or is both sides."""
    while True:
        lo, hi = max(a, m - size), min(b, m + size)
        window = [(x.start(), x[0]) for x in WORD.finditer(text, lo, hi)]
        if (lo, hi) == (a, b):
            return [w for _, w in window]
        before, after = ([(x.start(), x[0]) for x in WORD.finditer(text, *span)] for span in ((lo, m), (m, hi)))
        # a window's first and last word may be cut off where it ends; the next ones are whole
        if len(before) > 2 and len(after) > 2 and len(window) > 2 and window[1] == before[1] and window[-2] == after[-2]:
            return left[: len(left) - len(before) + 1] + [w for _, w in window[1:-1]] + right[len(after) - 1 :]
        size *= 2


class Codec:
    """Encodes and decodes whole texts; remembers words between calls."""

    def __init__(self, path: str, leaf: int = LEAF):
        self.path, self.leaf, self.own, self.known = path, leaf, tokenizer(path), {}
        rule = word_rule(path)
        self.split = regex.compile(rule).findall if rule else None
        self.letters = dict(enumerate(byte_letters()))

    def _learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > REMEMBER:
            self.known.clear()
        tokenize = self.own.model.tokenize
        for w in words:
            if len(w) > self.leaf or "<|" in w:
                ids = encode_tree(w, self.path, self.leaf)
                self.known[w] = (len(ids), " ".join(map(str, ids)), self.own.decode(ids, skip_special_tokens=False))
                continue
            low = w.lower()
            parts = [low] if low.isalpha() else self.split(low)
            tokens = [t for p in parts for t in tokenize(p if p.isascii() and p.isprintable() else p.encode("utf-8").decode("latin-1").translate(self.letters))]
            self.known[w] = (len(tokens), " ".join([str(t.id) for t in tokens]), " ".join([t.value for t in tokens]))

    def words(self, text: str) -> list[str]:
        """The words of a whole text, in order, from the tree of its halves."""
        if len(text) <= self.leaf:
            return text.split()
        cuts = [*range(0, len(text), self.leaf), len(text)]
        spans = list(zip(cuts, cuts[1:]))
        parts = [text[a:b].split() for a, b in spans]
        while len(parts) > 1:
            joins, odd = range(0, len(parts) - 1, 2), len(parts) % 2
            parts = [_joined(text, *spans[i], spans[i + 1][1], parts[i], parts[i + 1]) for i in joins] + parts[-1:] * odd
            spans = [(spans[i][0], spans[i + 1][1]) for i in joins] + spans[-1:] * odd
        return parts[0]

    def __call__(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids joined by a space, the decoded text."""
        if not self.split or PLAIN.search(text):
            ids = encode_tree(text, self.path, self.leaf)
            return len(ids), " ".join(map(str, ids)), self.own.decode(ids, skip_special_tokens=False)
        words = self.words(text)
        known = self.known
        if new := set(words).difference(known):
            before = len(known)
            self._learn(new)
            if len(known) < before:
                self._learn(set(words).difference(known))
        parts = [p for w in words if (p := known[w])[0]]
        return sum(p[0] for p in parts), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts])


def _codec(path: str, leaf: int):
    def run(batches):
        codec = Codec(path, leaf)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
        for x in sliced(batches):
            rows = []
            for d, t in zip(x.column(0).to_pylist(), x.column(1).to_pylist()):
                n, ids, back = codec(t or "")
                rows.append((d, n, sha(ids), sha(back)))
            yield batch(dict(zip(schema.names, zip(*rows) if rows else [()] * 4)), schema)

    return run


def round_trip(docs: DataFrame, path: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text.

    Null and empty texts have no token and the hashes of nothing. Repeated rows are encoded each time. Very long texts
    are encoded in leaves, so no call to the library grows with the text unless a text defies agreement or holds the marks of special tokens. An empty
    table gives an empty result; columns besides doc_id and text are not read.
    """
    return texts(docs).mapInArrow(_codec(path, leaf), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
