import random

import numpy as np
import xxhash

from terminus.llm.simhash import _links, near_duplicates


def brute(texts):
    fps = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sh = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(i, f"{fps[i]:016x}", find(i)) for i in range(len(fps))]


def test_against_brute_force(spark, docs):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    texts = [None, "", "  \n", "one", "One two", "one  TWO"]
    for _ in range(40):
        t = [rng.choice(vocab) for _ in range(rng.randint(3, 200))]
        texts.append(" ".join(t))
        for _ in range(rng.randint(0, 4)):
            c = list(t)
            c[rng.randrange(len(c))] = rng.choice(vocab)
            texts.append(" ".join(c))
            t = rng.choice([t, c])
    got = sorted(map(tuple, near_duplicates(docs(texts)).collect()))
    assert got == brute(texts)
    assert near_duplicates(docs([])).count() == 0


def test_long_lists_equal_pairs():
    rng = np.random.default_rng(1)
    fp = np.unique(rng.integers(0, 1 << 16, 900)).astype(np.int64)
    u, v = _links(np.zeros(len(fp), np.int64), fp)
    root = {int(x): int(x) for x in fp}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(u.tolist(), v.tolist()):
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {int(x): int(x) for x in fp}

    def look(x):
        while want[x] != x:
            x = want[x]
        return x

    for a in fp.tolist():
        for b in fp.tolist():
            if a < b and (a ^ b).bit_count() <= 2:
                x, y = sorted((look(a), look(b)))
                want[y] = x
    assert all((find(int(a)) == find(int(b))) == (look(int(a)) == look(int(b))) for a in fp[:60] for b in fp)
