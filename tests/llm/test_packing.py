import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from terminus.llm.packing import encoder, pack, plan

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_plan_uses_each_piece_once_and_packs_tightly():
    rng = random.Random(2)
    for limit in (7, 64, 1024):
        for _ in range(20):
            counts = [0] * (limit + 1)
            for _ in range(rng.randint(0, 400)):
                counts[rng.randint(1, limit)] += rng.choice([1, 1, 30])
            used = Counter()
            bins = 0
            for m, own in plan(counts, limit):
                assert m > 0 and sum(own) <= limit
                bins += m
                for n in own:
                    used[n] += m
            assert used == Counter({n: c for n, c in enumerate(counts) if c})
            total = sum(n * c for n, c in enumerate(counts))
            assert bins >= -(-total // limit) and bins <= total * 11 / 9 / limit + 4 + sum(c for n, c in enumerate(counts) if n > limit / 2)


def test_two_smaller_pieces_replace_the_smallest():
    counts = [0] * 11
    for n in (6, 3, 2, 2):
        counts[n] += 1
    assert plan(counts, 10)[0] == (1, [6, 2, 2])


def test_encoder_equals_the_library():
    whole = Tokenizer.from_file(PATH)
    encode = encoder(PATH, RANKS)
    rng = random.Random(3)
    alphabet = "abc dE  \n\t'sé İñ12.,!中\U0001f600é<|endoftext|>"
    for t in ["", "<|endoftext|> a", "x" * 3000, *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) for _ in range(300))]:
        assert list(encode(t)) == whole.encode(t, add_special_tokens=False).ids


def test_pieces(spark, docs):
    rng = random.Random(4)
    texts = [None, "", "a", "<|endoftext|>", *(" ".join(rng.choice(["the", "of", "zqx", "été"]) for _ in range(rng.choice([3, 90, 700, 2500]))) for _ in range(120))]
    texts += texts[10:14]
    got = pack(docs(texts), PATH, RANKS).collect()
    whole = Tokenizer.from_file(PATH)
    ids = [[*whole.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    of, bins = defaultdict(list), defaultdict(list)
    for r in got:
        of[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    assert sorted(of) == list(range(len(texts)))
    for d, rows in of.items():
        rows.sort(key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(len(rows))) and sum(r.length for r in rows) == len(ids[d])
        assert len(rows) == -(-len(ids[d]) // 1024) and all(r.length == 1024 for r in rows[1:])
        assert [r.start for r in rows] == [sum(x.length for x in rows[:i]) for i in range(len(rows))]
    for rows in bins.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == [sum(x.length for x in rows[:i]) for i in range(len(rows))] and sum(r.length for r in rows) <= 1024
    assert pack(docs([]), PATH, RANKS).count() == 0
