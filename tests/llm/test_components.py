import random

from terminus.llm import common, components, nearcopies


def reachable(edges):
    root = {n: n for e in edges for n in e if e[0] != e[1]}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    return {(n, find(n)) for n in root if find(n) != n}


def test_against_union_find(spark, monkeypatch):
    monkeypatch.setattr(components, "contract", lambda batches: batches)  # nothing is joined before the first round
    rng = random.Random(5)
    names = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(400)]
    chain = list(zip(names[:40], names[1:40]))
    hot = [(names[50], n) for n in names[51:120]] + [(n, max(names)) for n in names[120:150]]
    loose = [tuple(rng.choices(names[150:], k=2)) for _ in range(200)]
    edges = chain + hot + loose + loose[:20] + [(names[0], names[0])]
    edges = [(max(e), min(e)) for e in edges]
    got = components.components(spark.createDataFrame(edges, components.EDGE)).collect()
    assert len(got) == len({r.node for r in got}) and {tuple(r) for r in got} == reachable(edges)
    assert components.components(spark.createDataFrame([], components.EDGE)).count() == 0


def test_a_round_has_few_tasks(spark, monkeypatch):
    """Without adaptive execution's joining of small partitions, a round has a number of tasks for each of its shuffles; the event log of a run and its disk grow with them."""
    store, tasks, parts = spark._jsc.sc().statusStore(), [], 16
    write = components.materialize

    def counted(df, name, **more):
        spark.sparkContext.setJobGroup(name, name)
        before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        out = write(df, name, **more)
        jobs = set(spark.sparkContext.statusTracker().getJobIdsForGroup(name)) - before
        tasks.append((name, sum(store.job(j).numCompletedTasks() for j in jobs)))
        return out

    monkeypatch.setattr(components, "materialize", counted)
    edges = spark.range(1, 60).selectExpr("id u", "id div 2 v").coalesce(1)
    with common.settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": parts}):
        components.components(edges, "few")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    rounds = [n for name, n in tasks if name == "few-round"]
    assert rounds and max(rounds) <= 5 * parts, tasks


def test_components_are_made_anew_only_for_new_links(spark, docs, monkeypatch):
    rng = random.Random(4)
    base = " ".join(f"w{i}" for i in range(100))

    def changed(n):
        w = base.split()
        for at in rng.sample(range(len(w)), n):
            w[at] = f"v{rng.randrange(10**9)}"
        return " ".join(w)

    made, found = [], []
    make, verify = nearcopies.components, nearcopies.materialize

    def written(df, name, **more):
        out = verify(df, name, **more)
        if name == "links":
            found.append(out.count())
        return out

    monkeypatch.setattr(nearcopies, "components", lambda links, name: made.append(name) or make(links, name))
    monkeypatch.setattr(nearcopies, "materialize", written)
    texts = [changed(rng.choice([1, 2, 3])) for _ in range(60)] + [changed(6) for _ in range(60)]
    nearcopies.near_copies(docs(texts)).collect()
    assert 0 in found[1:] and len(made) == 1 + sum(n > 0 for n in found[1:])


def test_equal_fingerprints_and_links_make_pairs(spark):
    own = spark.createDataFrame([(5, 0), (3, 0), (9, 3), (1, 1 << 40), (2, 255 << 20), (5, 0)], "node long, fp long")
    got = {frozenset((r.u, r.v)) for r in nearcopies.by_fingerprint(own).collect()}
    assert got >= {frozenset((5, 3)), frozenset((3, 9)), frozenset((3, 1))} and not any(2 in p for p in got)
