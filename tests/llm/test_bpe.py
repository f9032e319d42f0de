import functools
import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

from terminus.llm.bpe import Codec, encode_tree, round_trip

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def load(path):
    return Tokenizer.from_file(path)


def library(text, path=PATH):
    own = load(path)
    ids = own.encode(text, add_special_tokens=False).ids
    return ids, own.decode(ids, skip_special_tokens=False)


def test_trees_equal_the_whole():
    rng = random.Random(1)
    kinds = ["abcdefghij", "aA1 'sé.,", "the quick brown ", "ab", "中文字é ", "\n \t", "123", "'s't're"]
    for path in (PATH, BYTES):
        for i in range(120):
            t = "".join(rng.choice(kinds[i % len(kinds)]) for _ in range(rng.randint(1, 700)))
            assert encode_tree(t, path, leaf=40, window=8) == library(t, path)[0], (path, t)
    long = "".join(rng.choice("etaoin") for _ in range(60_000))
    assert encode_tree(long, PATH) == library(long)[0]
    assert encode_tree("a" * 20_000, PATH) == library("a" * 20_000)[0]


def test_words_of_a_tree_are_those_of_the_whole():
    rng = random.Random(3)
    for leaf in (1, 7, 40, 1024):
        codec = Codec(PATH, leaf)
        for i in range(60):
            t = "".join(rng.choice(["a", "the", "x" * rng.randint(1, 90), " ", "  ", "\n", "é", "\xa0", " the end "]) for _ in range(rng.randint(0, 500)))
            assert codec.words(t) == t.split(), (leaf, t)
            if i < 10:
                ids, back = library(t)
                assert codec(t) == (len(ids), " ".join(map(str, ids)), back)


def test_codec_equals_the_library():
    rng = random.Random(2)
    codec = Codec(PATH)
    alphabet = ["the", "The", "don't", "é", "é", "<|endoftext|>", "x<|startoftext|>y", "12", "#!", "中", "\x1c", "\x85", "\xa0", " ", " ", "\n", "\0", "'s", "İ", "ſ", "ŉ", "ß"]
    for t in ["", " ", "<|endoftext|>", *("".join(rng.choice(alphabet) + rng.choice(["", " "]) for _ in range(rng.randint(0, 40))) for _ in range(1500))]:
        ids, back = library(t)
        assert codec(t) == (len(ids), " ".join(map(str, ids)), back), repr(t)


def test_documents(spark, docs):
    texts = [None, "", "a b", "a b", "word " * 3000, "x" * 50_000]
    got = sorted(map(tuple, round_trip(docs(texts), PATH).collect()))
    for d, n, a, b in got:
        ids, back = library(texts[d] or "")
        assert (n, a, b) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    assert len(got) == 6 and round_trip(docs([]), PATH).count() == 0
