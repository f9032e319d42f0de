"""Read ends to sites of a transcript: modes, mixture components, sharpness, spacing; internal priming."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terminus.functions.sequence import fraction

DEFAULTS = {"min_cluster_size": 10, "max_k": 5, "min_distance": 50, "min_relative_dominance": 0.3, "min_sharpness": 0.5, "max_subsample": 50_000, "seed": 42}
#: Transcripts fitted together.
TOGETHER = 64
SITES = "transcript_id string, site_position int, site_count long, site_abundance double, site_rank int"


def modes(ends: DataFrame, *keys: str) -> DataFrame:
    """Most frequent read end; of equals the smallest."""
    n = ends.groupBy(*keys, "read_end").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*keys).agg(F.min_by("read_end", F.struct(-F.col("n"), "read_end")).alias("mode_position"), F.max("n").alias("mode_count"), F.sum("n").alias("n_reads"))


def sharpness(ends: DataFrame, min_distance: int = 50, least: int = 10, sharp: float = 0.5) -> DataFrame:
    """Per transcript, whether its mode is a sharp peak: enough reads within half the distance, and a small quartile range.

    Counts per position go through the range frame, not reads."""
    peak = modes(ends, "transcript_id")
    near = ends.join(peak.select("transcript_id", "mode_position"), "transcript_id").where(F.abs(F.col("read_end") - F.col("mode_position")) <= min_distance / 2)
    q = near.groupBy("transcript_id", "mode_position").agg(F.count(F.lit(1)).alias("n_near"), F.percentile("read_end", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    value = 1.0 - (F.col("q")[1] - F.col("q")[0]) / min_distance
    return q.select("transcript_id", "mode_position", "n_near", value.alias("sharpness"), ((F.col("n_near") >= least) & (value >= sharp)).alias("is_sharp"))


# Mixture fitting: one transcript's read ends as positions with counts, so a read more costs nothing.


def _seeds(x: np.ndarray, w: np.ndarray, k: int, rng: np.random.RandomState) -> np.ndarray:
    """Greedy seeding: each further centre is the best of a few drawn by squared distance."""
    total, trials = np.cumsum(w), 2 + int(math.log(k))
    centres = [x[np.searchsorted(total, rng.randint(int(total[-1])), side="right")]]
    near = (x - centres[0]) ** 2
    for _ in range(1, k):
        mass = np.cumsum(near * w)
        picks = np.minimum(np.searchsorted(mass, rng.random_sample(trials) * mass[-1]), len(x) - 1)
        each = [np.minimum(near, (x - x[p]) ** 2) for p in picks]
        best = int(np.argmin([(e * w).sum() for e in each]))
        near = each[best]
        centres.append(x[picks[best]])
    return np.array(centres, dtype=float)


def _start(x: np.ndarray, w: np.ndarray, k: int, rng: np.random.RandomState) -> np.ndarray:
    """Labels of a hard clustering that begins at the seeds."""
    c = _seeds(x, w, k, rng)
    label = np.full(len(x), -1)
    for _ in range(300):
        new = np.argmin((x[:, None] - c) ** 2, axis=1)
        if np.array_equal(new, label):
            break
        label = new
        n = np.bincount(label, w, k)
        c = np.where(n > 0, np.bincount(label, w * x, k) / np.maximum(n, 1e-300), c)
    return label


def fit_mixtures(data: list[tuple[np.ndarray, np.ndarray]], k: int, rngs: list[np.random.RandomState], restarts: int = 3, rounds: int = 200, tol: float = 1e-3, floor: float = 1e-6) -> list[tuple | None]:
    """Expectation-maximisation of one-dimensional Gaussian mixtures, all transcripts and restarts side by side, each until its own
    bound settles. Per transcript (mean, variance, weight) of the likeliest restart, or None if that did not settle."""
    rows, width = len(data) * restarts, max(len(x) for x, _ in data)
    x, w, r = np.zeros((rows, width)), np.zeros((rows, width)), np.zeros((rows, width, k))
    for i, ((px, pw), rng) in enumerate(zip(data, rngs)):
        for j in range(i * restarts, (i + 1) * restarts):
            x[j, : len(px)], w[j, : len(px)] = px, pw
            r[j, np.arange(len(px)), _start(px, pw, k, rng)] = 1
    mean, var, weight = np.zeros((3, rows, k))
    bound, done = np.full(rows, -np.inf), np.zeros(rows, bool)
    on = np.arange(rows)

    def estimate(r_, x_, w_):
        own = r_ * w_[:, :, None]
        n = own.sum(axis=1) + 10 * np.finfo(float).eps
        m = (own * x_[:, :, None]).sum(axis=1) / n
        v = (own * (x_[:, :, None] - m[:, None]) ** 2).sum(axis=1) / n + floor
        return m, v, n / n.sum(axis=1, keepdims=True)

    mean[:], var[:], weight[:] = estimate(r, x, w)
    for _ in range(rounds):
        xs, ws, m, v = x[on], w[on], mean[on], var[on]
        d = (np.log(weight[on]) - 0.5 * np.log(2 * np.pi * v))[:, None] - 0.5 * (xs[:, :, None] - m[:, None]) ** 2 / v[:, None]
        top = d.max(axis=2, keepdims=True)
        e = np.exp(d - top)
        total = e.sum(axis=2, keepdims=True)
        new = ((top + np.log(total))[:, :, 0] * ws).sum(axis=1) / ws.sum(axis=1)
        mean[on], var[on], weight[on] = estimate(e / total, xs, ws)
        settled = np.abs(new - bound[on]) < tol
        bound[on] = new
        done[on[settled]] = True
        on = on[~settled]
        if not len(on):
            break
    best = np.argmax(bound.reshape(-1, restarts), axis=1) + restarts * np.arange(len(data))
    return [(mean[b], var[b], weight[b]) if done[b] else None for b in best]


def components(model: tuple, x: np.ndarray) -> np.ndarray:
    mean, var, weight = model
    return np.argmax(np.log(weight) - 0.5 * np.log(var) - 0.5 * (x[:, None] - mean) ** 2 / var, axis=1)


def silhouette(x: np.ndarray, w: np.ndarray, label: np.ndarray) -> float:
    """Mean silhouette of sorted positions with counts, by prefix sums per component: linear in positions times components."""
    kinds = np.unique(label)
    size, dist = {}, {}
    for c in kinds:
        on = label == c
        n, s = np.concatenate([[0], np.cumsum(w * on)]), np.concatenate([[0], np.cumsum(w * on * x)])
        dist[c] = x * n[1:] - s[1:] + (s[-1] - s[1:]) - x * (n[-1] - n[1:])
        size[c] = n[-1]
    total = 0.0
    for c in kinds:
        on = label == c
        if size[c] <= 1:
            continue
        a = dist[c][on] / (size[c] - 1)
        b = np.min([dist[o][on] / size[o] for o in kinds if o != c], axis=0)
        with np.errstate(invalid="ignore"):
            s = np.nan_to_num((b - a) / np.maximum(a, b))
        total += float((s * w[on]).sum())
    return total / w.sum()


def choose_models(data: list[tuple[np.ndarray, np.ndarray]], max_k: int, seed: int) -> list[tuple | None]:
    """Per transcript the mixture with the best silhouette, fewest components among equals; None if one group is all there is."""
    best: list[tuple | None] = [None] * len(data)
    top = [-np.inf] * len(data)
    n = [int(w.sum()) for _, w in data]
    for k in range(2, max_k + 1):
        can = [i for i, (x, _) in enumerate(data) if len(x) > 1 and k < n[i]]
        if not can:
            continue
        for i, model in zip(can, fit_mixtures([data[i] for i in can], k, [np.random.RandomState(seed) for _ in can])):
            if model is None:
                continue
            x, w = data[i]
            lab = components(model, x)
            if 2 <= len(np.unique(lab)) < n[i] and (score := silhouette(x, w, lab)) > top[i]:
                top[i], best[i] = score, model
    return best


def greedy_peaks(labelled: DataFrame, min_cluster_size: int = 10, min_distance: int = 50, min_relative_dominance: float = 0.3, min_sharpness: float = 0.5) -> DataFrame:
    """(transcript_id, site_position, site_count): the peaks of read ends that a model has put into components.

    labelled: transcript_id, component (a number), site_position, n reads. Components that are large enough, sharp and dominant enough are gone through by
    falling size, then falling number; sharpness is that of all the transcript's reads around the mode; one whose mode lies nearer than min_distance to a peak taken before is passed over. Reads are counted per position first, and a
    transcript's list holds its components, so its size doesn't follow the reads."""
    keys = ["transcript_id", "component"]
    per = labelled.groupBy(*keys, "site_position").agg(F.sum("n").alias("n"))
    whole = per.groupBy(*keys).agg(F.sum("n").alias("size"), F.min(F.struct((-F.col("n")).alias("n"), "site_position"))["site_position"].alias("at")).where(F.col("size") >= min_cluster_size)
    near = per.select("transcript_id", "site_position", "n").join(whole, "transcript_id").where(F.abs(F.col("site_position") - F.col("at")) <= min_distance / 2)
    near = near.groupBy(*keys, "size", "at").agg(F.sum("n").alias("n"), F.percentile("site_position", F.array(F.lit(0.75), F.lit(0.25)), F.col("n")).alias("q"))
    near = near.where((F.col("n") >= min_cluster_size) & (1.0 - (F.col("q")[0] - F.col("q")[1]) / min_distance >= min_sharpness))
    top = whole.groupBy("transcript_id").agg(F.max("size").alias("top"))
    own = near.join(top, "transcript_id").where(F.col("size") >= min_relative_dominance * F.col("top"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("less"), (-F.col("component")).alias("number"), "at", "size")))
    none = F.array().cast("array<struct<at:int,size:bigint>>")
    apart = lambda a, p: F.when(F.exists(a, lambda t: F.abs(t["at"] - p["at"]) < min_distance), a).otherwise(F.concat(a, F.array(F.struct(p["at"].cast("int").alias("at"), p["size"].cast("long").alias("size")))))
    taken = own.groupBy("transcript_id").agg(listed.alias("all")).select("transcript_id", F.explode(F.aggregate("all", none, apart)).alias("p"))
    return taken.select("transcript_id", F.col("p.at").alias("site_position"), F.col("p.size").alias("site_count"))


def peaks(x: np.ndarray, w: np.ndarray, model: tuple | None, min_cluster_size: int, min_distance: int, min_relative_dominance: float, min_sharpness: float) -> list[tuple[int, int]]:
    """(position, reads) of the components that are large, sharp, dominant enough and apart, larger ones first; else the mode."""
    n = int(w.sum())
    mode = lambda on: int(x[on][np.argmax(w[on])])
    everything = np.ones(len(x), bool)
    found: list[tuple[int, int]] = []
    if model is not None:
        lab = components(model, x.astype(float))
        sizes = sorted(((int(w[lab == c].sum()), int(c)) for c in np.unique(lab)), reverse=True)
        sizes = [s for s in sizes if s[0] >= min_cluster_size]
        for size, c in sizes:
            at = mode(lab == c)
            near = np.repeat(x, np.where(np.abs(x - at) <= min_distance / 2, w, 0))
            if len(near) < min_cluster_size:
                continue
            q75, q25 = np.percentile(near, [75, 25])
            if 1.0 - (q75 - q25) / min_distance < min_sharpness or size < min_relative_dominance * sizes[0][0]:
                continue
            if all(abs(at - p) >= min_distance for p, _ in found):
                found.append((at, size))
    return sorted(found, key=lambda p: (-p[1], p[0])) or [(mode(everything), n)]


def call_sites(ends: DataFrame, min_reads: int = 10, **options) -> DataFrame:
    """Sites of every transcript with `min_reads` read ends or more.

    Reads are counted per position before they are grouped, so a transcript with most of all reads is an array as long as its
    positions. Transcripts of about the same number of positions are fitted together, each from its own seeded generator, so
    a result does not depend on what it shares a batch with."""
    o = DEFAULTS | options
    n = ends.groupBy("transcript_id", "read_end").agg(F.count(F.lit(1)).alias("n"))
    own = n.groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct("read_end", "n"))).alias("e"), F.sum("n").alias("total")).where(F.col("total") >= min_reads)
    own = own.select("transcript_id", F.transform("e", lambda x: x["read_end"]).alias("x"), F.transform("e", lambda x: x["n"]).alias("w"))

    def run(batches):
        for pdf in batches:
            pdf = pdf.iloc[np.argsort(pdf["x"].map(len).to_numpy(), kind="stable")]
            for s in range(0, len(pdf), TOGETHER):
                part = pdf.iloc[s : s + TOGETHER]
                data = [(np.asarray(x), np.asarray(w)) for x, w in zip(part["x"], part["w"])]
                fit = []
                for x, w in data:
                    total = int(w.sum())
                    if total > o["max_subsample"]:
                        pick = np.sort(np.random.default_rng(o["seed"]).choice(total, size=o["max_subsample"], replace=False))
                        x, w = np.unique(np.repeat(x, w)[pick], return_counts=True)
                    fit.append((x.astype(float), w.astype(float)))
                small = [int(w.sum()) < o["min_cluster_size"] for _, w in data]
                chosen = choose_models([f if not z else (f[0][:1], f[1][:1]) for f, z in zip(fit, small)], o["max_k"], o["seed"])
                rows = []
                for t, (x, w), model in zip(part["transcript_id"], data, chosen):
                    got = peaks(x, w, model, o["min_cluster_size"], o["min_distance"], o["min_relative_dominance"], o["min_sharpness"])
                    total = sum(c for _, c in got)
                    rows += [(t, p, c, c / total, i) for i, (p, c) in enumerate(got, 1)]
                yield pd.DataFrame(rows, columns=["transcript_id", "site_position", "site_count", "site_abundance", "site_rank"])

    return own.mapInPandas(run, SITES)


def with_abundance(sites: DataFrame, key: str = "transcript_id") -> DataFrame:
    """Share of a site among its transcript's sites, and its rank by count, then position."""
    w = Window.partitionBy(key)
    return sites.select("*", (F.col("site_count") / F.sum("site_count").over(w)).alias("site_abundance"), F.row_number().over(w.orderBy(F.desc("site_count"), "site_position")).alias("site_rank"))


def priming(sites: DataFrame, threshold: float = 0.5, run: int = 6) -> DataFrame:
    """sites with `downstream` (bases after the site in transcript direction, upper case, null or empty if unknown): adds
    a_content, has_run and is_removed. A transcript's first site by rank always stays."""
    text = F.coalesce(F.upper("downstream"), F.lit(""))
    share = F.coalesce(fraction(text, "A"), F.lit(0.0))
    has = text.contains("A" * run)
    return sites.select("*", share.alias("a_content"), has.alias("has_run"), ((F.col("site_rank") > 1) & ((share > threshold) | has)).alias("is_removed"))


def downstream(sequence, pos, strand, width: int = 20):
    """The `width` bases that follow a 1-based site in transcript direction, in a chromosome held as one string."""
    plus = F.substring(sequence, pos + 1, F.lit(width))
    first = F.greatest(F.lit(0), pos - width - 1)
    minus = F.substring(sequence, first + 1, F.greatest(F.lit(0), F.greatest(F.lit(0), pos - 1) - first))
    return F.when(strand == "-", F.reverse(F.translate(F.upper(minus), "ACGT", "TGCA"))).otherwise(plus)


def split_primed(sites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sites that stay, with shares and ranks anew, and removed ones with the shares that they had."""
    kept = with_abundance(sites.where("NOT is_removed").drop("site_abundance", "site_rank", "a_content", "has_run", "is_removed"))
    return kept, sites.where("is_removed").drop("has_run", "is_removed")


def report(sites: DataFrame) -> DataFrame:
    """Transcripts, those with several sites, their percentage, and how many transcripts have as many sites."""
    n = sites.groupBy("transcript_id").agg(F.count(F.lit(1)).alias("n_sites"))
    each = n.groupBy("n_sites").agg(F.count(F.lit(1)).alias("n_transcripts"))
    w = Window.partitionBy()
    total = F.sum("n_transcripts").over(w)
    many = F.sum(F.when(F.col("n_sites") > 1, F.col("n_transcripts")).otherwise(0)).over(w)
    return each.select("n_sites", "n_transcripts", total.alias("total"), many.alias("several"), (100.0 * many / total).alias("percent_several"))
