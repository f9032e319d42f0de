"""Sites of many samples to one catalogue: input rules, segmentation per gene, representative positions, support filters, summaries.

All steps are relational or column expressions except the absorption of weak clusters, a Python function over the chunks of a gene that
have any, on observations that were summed by position, transcript and sample before the shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terminus.functions.cuts import starts
from terminus.functions.numeric import plain_number, round_even
from terminus.sources.tables import BIOTYPES, MITOCHONDRIA
from terminus.staging import staged

#: Bases of a gene that one fold of the segmentation handles, about.
CHUNK = 4096
GENE_KEY = ["chromosome", "effective_gene_id", "strand"]
JOIN_KEY = [*GENE_KEY, "site_position"]
CLUSTER_ID = [*GENE_KEY, "cluster_number"]
MODE = ["mode_site_position", "mode_score", "mode_local_n_samples", "mode_local_total_site_count", "mode_exact_n_samples", "mode_exact_total_site_count"]
CLUSTER = [*JOIN_KEY, "cluster_key", "unified_ID", "cluster_start", "cluster_end", "cluster_width", "n_unique_positions", *MODE]
WEIGHTS = {"sample_weight": 0.7, "count_weight": 0.3, "mode_sample_weight": 0.8, "mode_count_weight": 0.2}
SEGMENT = {"max_cluster_width": 40, "max_internal_gap": 24, "penalty": 225.0, "compactness": 1.0, "min_observation_count": 5, "strong_count": 50, "strong_abundance": 0.25, "absorb": True}
FILTERS = {"min_observation_count": 5, "min_supported_observations": 2, "strong_count": 50, "strong_abundance": 0.25, "min_cluster_samples": 1, "min_single_transcript_count": 10, "min_multi_transcript_count": 5, "min_supported_transcripts": 2}


def text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit("")))


def row_fault() -> Column:
    """The first rule that a row of site tables breaks, or null: finite positive whole numbers, a strand, names that aren't blank."""
    number = lambda c: F.expr(f"try_cast({c} AS DOUBLE)")
    bad = lambda c: number(c).isNull() | F.isnan(number(c)) | (F.abs(number(c)) == float("inf")) | (number(c) <= 0) | (number(c) % 1 != 0)
    return (
        F.when(bad("site_position"), "site_position")
        .when(bad("site_count"), "site_count")
        .when(~F.coalesce(F.col("strand").isin("+", "-"), F.lit(False)), "strand")
        .when(text("chromosome") == "", "chromosome")
        .when(text("transcript_id") == "", "transcript_id")
    )


def strict(rows: DataFrame) -> DataFrame:
    """The rows, typed; one that breaks a rule ends the job with what it breaks."""
    checked = F.when(row_fault().isNotNull(), F.raise_error(F.concat(F.lit("invalid "), row_fault())))
    own = rows.withColumn("_ok", checked).where(F.col("_ok").isNull()).drop("_ok")
    return own.withColumn("site_position", F.expr("try_cast(try_cast(site_position AS DOUBLE) AS INT)")).withColumn("site_count", F.expr("try_cast(site_count AS DOUBLE)"))


def normalized(rows: DataFrame) -> DataFrame:
    """Biotype spelling, blank text for missing text, the gene that a row counts for; rows without a gene go."""
    own = rows.withColumns({c: text(c) for c in ("gene_id", "gene_name", "transcript_biotype")})
    own = own.withColumn("transcript_biotype", F.when(F.col("transcript_biotype") == "lnc_RNA", "lncRNA").otherwise(F.col("transcript_biotype")))
    own = own.withColumn("effective_gene_id", F.when(F.col("gene_id") != "", F.col("gene_id")).otherwise(F.col("gene_name")))
    return own.where("effective_gene_id != ''")


def drop_reason(biotypes: tuple = BIOTYPES, exclude_predicted: bool = False, keep_scaffolds: bool = False, keep_mitochondrial: bool = False) -> Column:
    """The first filter that a normalized row fails, or null."""
    out = F.when(~F.col("transcript_biotype").isin(*{"lncRNA" if b == "lnc_RNA" else b for b in biotypes}), "biotype")
    if exclude_predicted:
        out = out.when(F.col("transcript_id").rlike("^(XM_|XR_)"), "predicted")
    if not keep_scaffolds:
        out = out.when(~F.col("chromosome").startswith("NC_"), "scaffold")
    if not keep_mitochondrial:
        out = out.when(F.col("chromosome").isin(*MITOCHONDRIA), "mitochondrial")
    return out


def meet(left: DataFrame, right: DataFrame, keys: str | list[str], how: str = "inner") -> DataFrame:
    """A join that shuffles both sides: for tables that grow with positions, genes or clusters. The engine takes a table's size from its files, where a position is
    some three bytes; the same rows are a hundred bytes each once the driver gathers them to be broadcast."""
    return left.join(right.hint("merge"), keys, how)


def evidence(rows: DataFrame) -> DataFrame:
    """Per position of a gene: its samples and its reads."""
    own = rows.groupBy(*JOIN_KEY).agg(F.array_sort(F.collect_set("sample_id")).alias("samples"), F.sum("site_count").alias("total_count"))
    return own.select(*JOIN_KEY, "samples", F.size("samples").cast("long").alias("n_samples"), "total_count")


def dp_weights(ev: DataFrame, sample_weight: float = 0.7, count_weight: float = 0.3) -> DataFrame:
    """How much a position counts when clusters are cut; relative to its gene's largest values, which are joined back."""
    own = ev.withColumns({"_s": F.col("n_samples").cast("double"), "_c": F.log1p("total_count")})
    top = own.groupBy(*GENE_KEY).agg(F.max("_s").alias("_ts"), F.max("_c").alias("_tc"))
    part = lambda x, most: F.coalesce(F.col(x) / F.nullif(F.col(most), F.lit(0.0)), F.lit(0.0))
    own = meet(own, top, GENE_KEY).withColumn("dp_weight", F.greatest(sample_weight * part("_s", "_ts") + count_weight * part("_c", "_tc"), F.lit(1e-6)))
    return own.select(*ev.columns, "dp_weight")


def gap_clusters(ev: DataFrame, max_internal_gap: int = 24) -> DataFrame:
    """Clusters by gaps alone: a position further than the gap from the one before begins a cluster, numbered from 0."""
    w = Window.partitionBy(*GENE_KEY).orderBy("site_position")
    new = F.when(F.col("site_position") - F.lag("site_position").over(w) > max_internal_gap, 1).otherwise(0)
    return ev.withColumn("_new", new).withColumn("cluster_number", F.sum("_new").over(w)).drop("_new")


def partition(x: np.ndarray, w: np.ndarray, width: int, gap: int, penalty: float, compactness: float) -> list[int]:
    """Where clusters of sorted positions begin: least sum of a penalty a cluster and its weighted variance, then fewest clusters,
    then the earliest start of the last one. No cluster is wider than `width` or has a step over `gap`."""
    n = len(x)
    cost, parts, back = [math.inf] * (n + 1), [10**12] * (n + 1), [0] * (n + 1)
    cost[0], parts[0] = 0.0, 0
    places = x.tolist()
    low = 0
    for end in range(1, n + 1):
        if end > 1 and places[end - 1] - places[end - 2] > gap:
            low = end - 1
        while places[end - 1] - places[low] + 1 > width:
            low += 1
        # Sums over x[start:end] for every start at once, with places counted from the last one.
        d, ws = (x[low:end] - x[end - 1])[::-1], w[low:end][::-1]
        total = np.cumsum(ws)
        mean = np.cumsum(ws * d) / total
        spread = np.maximum(np.cumsum(ws * d * d) / total - mean * mean, 0.0)[::-1].tolist()
        best, fewest, first = math.inf, 10**12, 0
        for start in range(low, end):
            c = cost[start] + penalty + compactness * spread[start - low]
            if c < best - 1e-9 or abs(c - best) <= 1e-9 and parts[start] + 1 < fewest:
                best, fewest, first = c, parts[start] + 1, start
        cost[end], parts[end], back[end] = best, fewest, first
    out = []
    while n > 0:
        n = back[n]
        out.append(n)
    return out[::-1]


def absorb(clusters: list[list[int]], obs: pd.DataFrame, width: int, gap: int, min_count: int, strong_count: int, strong_abundance: float) -> list[list[int]]:
    """Single positions without a supported observation join a strong neighbour that stays within width and gap: the nearest,
    then the one with more supported observations, then with the larger one, then the left. Repeats until nothing moves.
    obs: transcript_id, sample_id, site_position, site_count, and gene_count, the reads of that transcript and sample in the
    whole gene, where obs is a part of it."""
    total: dict = {}
    at: dict = {}
    gene = obs["gene_count"] if "gene_count" in obs else obs.groupby(["transcript_id", "sample_id"])["site_count"].transform("sum")
    for t, k, p, n, whole in zip(*(obs[c] for c in ("transcript_id", "sample_id", "site_position", "site_count")), gene):
        total[t, k] = whole
        at.setdefault(p, []).append(((t, k), n))

    def support(cluster):
        own: dict = {}
        for p in cluster:
            for key, n in at[p]:
                own[key] = own.get(key, 0.0) + n
        good = sum(n >= min_count for n in own.values())
        strong = strong_count > 0 and any(n >= strong_count and n / total[key] >= strong_abundance for key, n in own.items())
        return good, max(own.values()), good >= 2 or strong

    state = [support(c) for c in clusters]
    i, changed = 0, False
    while True:
        if i >= len(clusters):
            if not changed:
                return clusters
            i, changed = 0, False
            continue
        if len(clusters[i]) > 1 or state[i][0] >= 1 or state[i][1] >= min_count:
            i += 1
            continue
        options = []
        for j in (i - 1, i + 1):
            if not 0 <= j < len(clusters) or not state[j][2]:
                continue
            both = sorted(clusters[i] + clusters[j])
            if both[-1] - both[0] + 1 <= width and all(b - a <= gap for a, b in zip(both, both[1:])):
                p = clusters[i][0]
                options.append((min(abs(p - clusters[j][0]), abs(p - clusters[j][-1])), -state[j][0], -state[j][1], j, both))
        if not options:
            i += 1
            continue
        *_, j, both = min(options)
        low = min(i, j)
        clusters[low : low + 2] = [both]
        state[low : low + 2] = [support(both)]
        changed, i = True, max(0, low - 1)


def islands(ev: DataFrame, max_internal_gap: int, width: int | None = None) -> DataFrame:
    """(JOIN_KEY, dp_weight, chunk): neighbouring islands of a gene, of about `width` bases together, have a chunk. No cluster and no absorption
    crosses a step over the gap, so chunks are segmented for themselves.

    A gene's positions are looked at in bins of bases; what begins an island in a bin or ends the one before is known from the bins' first and last
    positions, so a gene with most of all positions is never in one task; its positions come by gene, if weights were joined, and are dealt out by bins."""
    bins = [*GENE_KEY, "_bin"]
    own = ev.select(*JOIN_KEY, "dp_weight", F.floor(F.col("site_position") / F.lit(width or CHUNK)).alias("_bin")).repartition(*bins)
    own = own.withColumn("_step", F.col("site_position") - F.lag("site_position").over(Window.partitionBy(*bins).orderBy("site_position")))
    ends = own.groupBy(*bins).agg(F.min("site_position").alias("_first"), F.max("site_position").alias("_last"), F.min(F.when(F.col("_step") > max_internal_gap, F.col("site_position"))).alias("_inner"))
    along = Window.partitionBy(*GENE_KEY).orderBy("_bin")
    apart = F.coalesce(F.col("_first") - F.lag("_last").over(along) > max_internal_gap, F.lit(True))
    ends = ends.withColumn("_begin", F.when(apart, F.col("_first")).otherwise(F.col("_inner")))
    ends = ends.select(*bins, "_begin", F.last(F.when(F.col("_begin").isNotNull(), F.col("_bin")), True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    chunk = F.when(F.col("site_position") >= F.col("_begin"), F.col("_bin")).otherwise(F.col("_before"))
    return meet(own, ends, bins).select(*JOIN_KEY, "dp_weight", chunk.alias("chunk"))


def numbered_clusters(cut: DataFrame) -> DataFrame:
    """(JOIN_KEY, cluster_number) of (JOIN_KEY, chunk, _start): clusters of a gene from 0; those of earlier chunks are counted chunk by chunk."""
    per = cut.groupBy(*GENE_KEY, "chunk").agg(F.count_distinct("_start").alias("_n"))
    before = per.select(*GENE_KEY, "chunk", (F.coalesce(F.sum("_n").over(Window.partitionBy(*GENE_KEY).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_before"))
    own = cut.withColumn("_rank", F.dense_rank().over(Window.partitionBy(*GENE_KEY, "chunk").orderBy("_start")) - 1)
    return meet(own, before, [*GENE_KEY, "chunk"]).select(*JOIN_KEY, (F.col("_before") + F.col("_rank")).cast("long").alias("cluster_number"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows by key over as many tasks as the session shuffles to: what follows is long for its bytes, which adaptive execution would put together."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def whole(batches, keys: int, rows: int = 200_000):
    """Sorted rows as batches in which no group of the first `keys` columns is cut, of about so many rows, and where in each its groups begin."""
    held: list[pa.RecordBatch] = []

    def begins(x: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(max(x.num_rows - 1, 0), bool)
        for c in x.columns[:keys]:
            new |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        return np.concatenate([[0], np.flatnonzero(new) + 1])

    for x in batches:
        held.append(x)
        if sum(h.num_rows for h in held) >= rows:
            x = pa.concat_batches(held)
            at = begins(x)
            if at[-1]:
                yield x.slice(0, at[-1]), at[:-1]
            held, rows_left = [x.slice(at[-1])], x.num_rows - at[-1]
            rows = max(rows, 2 * rows_left)  # a group longer than a batch is put together a few times only
    if sum(h.num_rows for h in held):
        x = pa.concat_batches(held)
        yield x, begins(x)


def dynamic(placed: DataFrame, o: dict) -> DataFrame:
    """(JOIN_KEY, chunk, _start): each position with the first position of its cluster. A task has its chunks in order and cuts many of them at a time."""
    own = spread(placed.select(*GENE_KEY, "chunk", "site_position", "dp_weight"), *GENE_KEY, "chunk").sortWithinPartitions(*GENE_KEY, "chunk", "site_position")

    def cut(batches):
        for x, at in whole(batches, 4):
            place, weight = (x.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
            first = starts(place.astype(np.int64), weight, np.diff(np.append(at, x.num_rows)), o["max_cluster_width"], o["max_internal_gap"], o["penalty"], o["compactness"])
            yield pa.RecordBatch.from_arrays([*x.columns[:5], pa.array(place[first], x.schema.field(4).type)], names=[*x.schema.names[:5], "_start"])

    kinds = dict(own.dtypes)
    out = own.mapInArrow(cut, ", ".join(f"{c} {kinds[c]}" for c in own.columns[:5]) + f", _start {kinds['site_position']}")
    return out.select(*JOIN_KEY, "chunk", "_start")


def open_runs(own: DataFrame, o: dict) -> DataFrame:
    """(GENE_KEY, chunk, _start, run): the clusters of the runs of a chunk in which something may be absorbed.

    own: reads summed by position, transcript and sample. A run's neighbours are a weak single and any cluster, no more than the gap apart; clusters of different
    runs never meet. Nothing moves in a run that doesn't begin with a weak single that fits beside a neighbour within the width."""
    cluster = [*GENE_KEY, "chunk", "_start"]
    low, high = F.min("site_position"), F.max("site_position")
    per = own.groupBy(*cluster).agg(low.alias("low"), high.alias("high"), ((low == high) & (F.max("site_count") < o["min_observation_count"])).alias("weak"))
    w = Window.partitionBy(*GENE_KEY, "chunk").orderBy("_start")
    before = lambda c: F.lag(c).over(w)
    beside = F.coalesce((F.col("low") - before("high") <= o["max_internal_gap"]) & (F.col("weak") | before("weak")), F.lit(False))
    per = per.withColumns({"_beside": beside, "_fits": beside & (F.col("high") - before("low") + 1 <= o["max_cluster_width"])})
    per = per.select(*cluster, "_fits", F.sum((~F.col("_beside")).cast("int")).over(w).alias("run"))
    return per.withColumn("_open", F.max("_fits").over(Window.partitionBy(*GENE_KEY, "chunk", "run"))).where("_open").select(*cluster, "run")


def segment(rows: DataFrame, sample_weight: float = 0.7, count_weight: float = 0.3, **options) -> DataFrame:
    """(JOIN_KEY, cluster_number): positions of each gene and strand cut into clusters by dynamic programming, weak ones absorbed.

    Reads are summed by position, transcript and sample once, and the cut is made once, since numbers are counted from it. Only runs of clusters that have
    something to absorb go through Python."""
    o = SEGMENT | options
    sums = staged(rows.groupBy(*JOIN_KEY, "transcript_id", "sample_id").agg(F.sum("site_count").alias("site_count")), "sums")
    ev = sums.groupBy(*JOIN_KEY).agg(F.size(F.collect_set("sample_id")).cast("long").alias("n_samples"), F.sum("site_count").alias("total_count"))
    weighted = dp_weights(staged(ev, "evidence"), sample_weight, count_weight)
    cut = staged(dynamic(islands(weighted, o["max_internal_gap"]), o), "cut")
    if not o["absorb"]:
        return numbered_clusters(cut)
    cluster = [*GENE_KEY, "chunk", "_start"]
    own = meet(sums, cut, JOIN_KEY)
    runs = staged(open_runs(own, o), "runs")
    own = staged(meet(own, runs, cluster), "open")
    totals = sums.groupBy(*GENE_KEY, "transcript_id", "sample_id").agg(F.sum("site_count").alias("gene_count"))
    own = meet(own, totals, [*GENE_KEY, "transcript_id", "sample_id"])

    names = cut.columns

    def one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, run in pdf.groupby("run"):
            first = run.drop_duplicates("site_position").sort_values("site_position")
            clusters = [g.tolist() for _, g in first["site_position"].groupby(first["_start"], sort=True)]
            clusters = absorb(clusters, run, o["max_cluster_width"], o["max_internal_gap"], o["min_observation_count"], o["strong_count"], o["strong_abundance"])
            out += [(*key[:3], p, key[3], c[0]) for c in clusters for p in c]
        return pd.DataFrame(out, columns=names)

    changed = spread(own, *GENE_KEY, "chunk").groupBy(*GENE_KEY, "chunk").applyInPandas(one, cut.schema)
    return numbered_clusters(staged(meet(cut, runs, cluster, "left_anti").unionByName(changed), "absorbed"))


def local_support(numbered: DataFrame, reach: int = 15) -> DataFrame:
    """Samples and reads within `reach` of each position, in its own cluster."""
    w = Window.partitionBy(*GENE_KEY, "cluster_number").orderBy("site_position").rangeBetween(-reach, reach)
    return numbered.select("*", F.size(F.array_distinct(F.flatten(F.collect_list("samples").over(w)))).cast("long").alias("local_n_samples"), F.sum("total_count").over(w).alias("local_total_count"))


def scored(numbered: DataFrame, reach: int = 15, sample_weight: float = 0.7, count_weight: float = 0.3, mode_sample_weight: float = 0.8, mode_count_weight: float = 0.2) -> DataFrame:
    """Each position with how it represents its cluster (`mode`) and how it ranks for that (`rank`): by score of its own support, own samples, own reads,
    score of the support around it, samples and reads around it, nearness to the weighted centre, then the smallest."""
    own = local_support(numbered, reach)
    w = Window.partitionBy(*CLUSTER_ID)
    top = lambda c: F.when(F.max(c).over(w) != 0, F.max(c).over(w)).otherwise(1).cast("double")
    total = F.sum("total_count").over(w)
    centre = F.when(total > 0, F.sum(F.col("site_position") * F.col("total_count")).over(w) / total).otherwise((F.min("site_position").over(w) + F.max("site_position").over(w)) / 2.0)
    own = own.withColumns(
        {
            "_local": sample_weight * F.col("local_n_samples") / top("local_n_samples") + count_weight * F.col("local_total_count") / top("local_total_count"),
            "_score": mode_sample_weight * F.col("n_samples") / top("n_samples") + mode_count_weight * F.col("total_count") / top("total_count"),
            "_away": -F.abs(F.col("site_position") - centre),
        }
    )
    rank = F.struct("_score", "n_samples", "total_count", "_local", "local_n_samples", "local_total_count", "_away", -F.col("site_position"))
    mode = F.struct(F.col("site_position").alias(MODE[0]), round_even(F.col("_score"), 4).alias(MODE[1]), F.col("local_n_samples").alias(MODE[2]), F.col("local_total_count").alias(MODE[3]), F.col("n_samples").alias(MODE[4]), F.col("total_count").alias(MODE[5]))
    return own.select(*JOIN_KEY, "cluster_number", mode.alias("mode"), rank.alias("rank"))


#: What a cluster's positions have in common.
EXTENT = {"cluster_start": F.min, "cluster_end": F.max, "n_unique_positions": F.count}


def _described(own: DataFrame, *more: str) -> DataFrame:
    """A cluster's name and coordinates, of its number, ends and representative."""
    return own.select(
        *more, F.concat_ws("|", *GENE_KEY, F.col("cluster_number").cast("string")).alias("cluster_key"),
        F.concat("chromosome", F.lit(":"), F.col("cluster_start").cast("string"), F.lit("-"), F.col("cluster_end").cast("string"), F.lit(":"), "strand").alias("unified_ID"),
        "cluster_start", "cluster_end", (F.col("cluster_end") - F.col("cluster_start") + 1).alias("cluster_width"), "n_unique_positions", "mode.*",
    )


def cluster_heads(numbered: DataFrame, **representative) -> DataFrame:
    """A row for each cluster (CLUSTER_ID) with its name, extent and representative position, by the settings of `scored`."""
    own = scored(numbered, **representative).groupBy(*CLUSTER_ID).agg(*[f("site_position").alias(c) for c, f in EXTENT.items()], F.max_by("mode", "rank").alias("mode"))
    return _described(own, *CLUSTER_ID)


def cluster_map(numbered: DataFrame, **representative) -> DataFrame:
    """A row for each position with its cluster's name, extent and representative position, by the settings of `scored`.

    numbered: evidence with cluster_number, which is gone through once: what a cluster's positions share comes from windows over it."""
    w = Window.partitionBy(*CLUSTER_ID)
    own = scored(numbered, **representative).withColumns({c: f("site_position").over(w) for c, f in EXTENT.items()} | {"mode": F.max_by("mode", "rank").over(w)})
    return _described(own, *JOIN_KEY).select(*CLUSTER)


def with_clusters(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """The rows with their position's cluster."""
    return meet(rows, clusters, JOIN_KEY).withColumnRenamed("site_position", "original_site_position")


def by_cluster(detailed: DataFrame) -> DataFrame:
    """The rows of a cluster in one task: what groups by cluster, and by more beside it, then shuffles nothing."""
    return detailed.repartition("cluster_key")


def parts(detailed: DataFrame) -> DataFrame:
    """The rows with the reads of their transcript, sample and cluster (`_part`)."""
    return by_cluster(detailed).withColumn("_part", F.sum("site_count").over(Window.partitionBy("cluster_key", "transcript_id", "sample_id")))


def wholes(counted: DataFrame) -> DataFrame:
    """The reads of each transcript in each sample (`_whole`)."""
    return staged(counted.groupBy("transcript_id", "sample_id").agg(F.sum("site_count").alias("_whole")), "whole")


def shares(parted: DataFrame, name: str = "cluster_relative_abundance", whole: DataFrame | None = None) -> DataFrame:
    """`_part` as a share of the transcript's reads in the sample, to four decimals. A transcript with most of a sample's rows doesn't meet in one task: its sums
    are made in part before the shuffle. They are written, so the join is planned by their true size."""
    keys = ["transcript_id", "sample_id"]
    whole = whole or wholes(parted)
    own = parted.join(whole, keys).withColumn(name, round_even(F.col("_part") / F.col("_whole"), 4))
    first = [*keys, "cluster_key"]
    return own.select(*first, *[c for c in own.columns if c not in (*first, "_part", "_whole")])


def relative_abundance(detailed: DataFrame, name: str = "cluster_relative_abundance") -> DataFrame:
    """A cluster's share of its transcript's reads in a sample, to four decimals."""
    return shares(parts(detailed), name)


def placed(rows: DataFrame, numbered: DataFrame, **representative) -> DataFrame:
    """The rows with their cluster and `_part`, written once: shares, verdicts and tables are made from them.

    Rows meet no more than the number of their cluster on their way; what is said of a cluster as a whole is joined where the cluster's rows are together."""
    numbered = numbered if hasattr(numbered, "_terminus_path") else staged(numbered, "numbered")
    own = meet(rows, numbered.select(*CLUSTER_ID, "site_position"), JOIN_KEY).withColumnRenamed("site_position", "original_site_position").repartition(*CLUSTER_ID)
    own = own.withColumn("_part", F.sum("site_count").over(Window.partitionBy(*CLUSTER_ID, "transcript_id", "sample_id")))
    return staged(meet(own, cluster_heads(numbered, **representative), CLUSTER_ID).drop("cluster_number"), "detailed")


def short(x: float) -> str:
    return f"{x:g}"


def observation_verdicts(detailed: DataFrame, **options) -> DataFrame:
    """Verdict by observations (a transcript in a sample): enough supported ones, or one strong one with a large share before filtering."""
    o = FILTERS | options
    obs = by_cluster(detailed).groupBy("cluster_key", "transcript_id", "sample_id").agg(F.sum("site_count").alias("n"), F.max("prefilter_cluster_relative_abundance").alias("share"))
    strong = F.col("n") >= o["strong_count"]
    stats = obs.groupBy("cluster_key").agg(
        F.size(F.collect_set("sample_id")).cast("long").alias("n_samples"), F.count_if(F.col("n") >= o["min_observation_count"]).alias("supported_observations"),
        F.max("n").alias("max_observation"), F.coalesce(F.max(F.when(strong, F.col("share"))), F.lit(0.0)).alias("strong_share"),
    )
    enough = F.col("n_samples") >= o["min_cluster_samples"]
    supported = F.col("supported_observations") >= o["min_supported_observations"]
    single = F.lit(o["strong_count"] > 0) & (F.col("max_observation") >= o["strong_count"]) & (F.col("strong_share") >= o["strong_abundance"])
    reason = f"fewer_than_{o['min_supported_observations']}_transcript_sample_observations_with_count_ge_{o['min_observation_count']}"
    if o["strong_count"] > 0:
        reason += f"_and_max_observation_lt_{o['strong_count']}_or_relative_abundance_lt_{short(o['strong_abundance'])}"
    return stats.select(
        "cluster_key",
        (enough & (supported | single)).alias("filter_passed"),
        F.when(enough & supported, "supported_transcript_sample_observations").when(enough & single, "strong_single_transcript_sample_observation_with_abundance").otherwise("").alias("filter_pass_rule"),
        F.when(~enough, f"n_samples_lt_{o['min_cluster_samples']}").when(~(supported | single), reason).otherwise("").alias("filter_reason"),
    )


def transcript_verdicts(detailed: DataFrame, **options) -> DataFrame:
    """Verdict by a transcript's reads over all samples: one rule for clusters of one transcript, one for several."""
    o = FILTERS | options
    per = detailed.groupBy("cluster_key", "transcript_id").agg(F.sum("site_count").alias("n"))
    samples = detailed.groupBy("cluster_key").agg(F.count_distinct("sample_id").alias("n_samples"))
    stats = per.groupBy("cluster_key").agg(F.count(F.lit(1)).alias("n_transcripts"), F.max("n").alias("top"), F.count_if(F.col("n") >= o["min_multi_transcript_count"]).alias("supported"))
    stats = meet(stats, samples, "cluster_key")
    enough, one = F.col("n_samples") >= o["min_cluster_samples"], F.col("n_transcripts") == 1
    ok = F.when(one, F.col("top") >= o["min_single_transcript_count"]).otherwise(F.col("supported") >= o["min_supported_transcripts"])
    return stats.select(
        "cluster_key",
        (enough & ok).alias("filter_passed"),
        F.when(enough & ok, F.when(one, "single_transcript_count").otherwise("multi_transcript_count")).otherwise("").alias("filter_pass_rule"),
        F.when(~enough, f"n_samples_lt_{o['min_cluster_samples']}").when(ok, "").when(one, f"single_transcript_count_lt_{o['min_single_transcript_count']}").otherwise(f"fewer_than_{o['min_supported_transcripts']}_transcripts_with_count_ge_{o['min_multi_transcript_count']}").alias("filter_reason"),
    )


def no_filter(detailed: DataFrame) -> DataFrame:
    return detailed.select("cluster_key").distinct().select("cluster_key", F.lit(True).alias("filter_passed"), F.lit("no_filter").alias("filter_pass_rule"), F.lit("").alias("filter_reason"))


def renumbered(detailed: DataFrame) -> DataFrame:
    """(cluster_key, new_key): clusters of a gene numbered from 1 by start, end and name."""
    own = detailed.select("cluster_key", *GENE_KEY, "cluster_start", "cluster_end").distinct()
    rank = F.row_number().over(Window.partitionBy(*GENE_KEY).orderBy("cluster_start", "cluster_end", "cluster_key"))
    return own.select("cluster_key", F.concat_ws("|", *GENE_KEY, rank.cast("string")).alias("new_key"))


def tissue_names(detailed: DataFrame) -> DataFrame:
    """Names of tissue samples begin with a capital."""
    return detailed.withColumn("sample", F.when(F.col("sample_attribute") == "tissue", F.concat(F.upper(F.substring("sample", 1, 1)), F.substring("sample", 2, 1_000_000))).otherwise(F.col("sample")))


def weighted_positions(detailed: DataFrame, q: tuple = (0.25, 0.75)) -> DataFrame:
    """Mean, standard deviation and quantiles (first position at which the running weight reaches its share) of a cluster's reads."""
    per = by_cluster(detailed).groupBy("cluster_key", "original_site_position").agg(F.sum("site_count").alias("n"))
    w = Window.partitionBy("cluster_key")
    x = F.col("original_site_position")
    per = per.withColumns({"_total": F.sum("n").over(w), "_run": F.sum("n").over(w.orderBy("original_site_position")), "_mean": F.sum(x * F.col("n")).over(w) / F.sum("n").over(w)})
    return per.groupBy("cluster_key").agg(
        F.max("_mean").alias("weighted_mean"), F.sqrt(F.sum(F.col("n") * (x - F.col("_mean")) * (x - F.col("_mean"))) / F.sum("n")).alias("weighted_sd"),
        *[F.min(F.when(F.col("_run") >= F.lit(p) * F.col("_total"), x)).alias(f"q{round(100 * p)}") for p in q],
    )


def listed(c: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(c)), ",")


def transcript_counts(detailed: DataFrame) -> DataFrame:
    """Per cluster `transcript:reads` by falling reads, then name; number of transcripts and all reads."""
    per = by_cluster(detailed).groupBy("cluster_key", "transcript_id").agg(F.sum("site_count").alias("n"))
    items = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("transcript_id").alias("t"), plain_number(F.col("n")).alias("s"))))
    return per.groupBy("cluster_key").agg(F.array_join(F.array_sort(F.collect_list("transcript_id")), ",").alias("transcript_ids"), F.array_join(F.transform(items, lambda i: F.concat(i["t"], F.lit(":"), i["s"])), ",").alias("transcript_cluster_counts"), F.count(F.lit(1)).alias("n_transcripts"), F.sum("n").alias("total"))


def summary(detailed: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """A row a cluster. Attributes that rows of a cluster may differ in are the first row's by ingest_seq. What is counted or listed is made
    distinct by an aggregation of its own, so rows are never multiplied."""
    has = "cluster_relative_abundance" in detailed.columns
    first = ["unified_ID", "gene_id", "gene_name", "effective_gene_id", "chromosome", "strand", "cluster_start", "cluster_end", "cluster_width", *MODE, "n_unique_positions"]
    kind = lambda k: F.max((F.col("sample_attribute") == k).cast("int"))
    samples = by_cluster(detailed).groupBy("cluster_key", "sample_id").agg(F.collect_set("sample").alias("names"), F.collect_set("transcript_biotype").alias("types"), kind("tissue").alias("t"), kind("cell_culture").alias("c"))
    together = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), ",")
    samples = samples.groupBy("cluster_key").agg(
        F.count("sample_id").alias("n_samples"), F.coalesce(F.sum("t"), F.lit(0)).alias("n_tissues"), F.coalesce(F.sum("c"), F.lit(0)).alias("n_cell_cultures"),
        together("names").alias("sample_list"), together("types").alias("transcript_biotype"),
    )
    own = by_cluster(detailed).groupBy("cluster_key").agg(
        F.min_by(F.struct(*first), "ingest_seq").alias("f"), (round_even(F.median("cluster_relative_abundance"), 4) if has else F.lit(None).cast("double")).alias("median_cluster_relative_abundance"),
    )
    for more in (samples, weighted_positions(detailed), transcript_counts(detailed)):
        own = meet(own, more, "cluster_key")
    if verdicts is not None:
        own = meet(own, verdicts.select("cluster_key", "filter_pass_rule", "filter_reason"), "cluster_key", "left")
    else:
        own = own.withColumns({"filter_pass_rule": F.lit(""), "filter_reason": F.lit("")})
    return own.select(
        "cluster_key", *[F.col(f"f.{c}").alias(c) for c in first[:10]], *[(plain_number(F.col(f"f.{c}")) if c.endswith("total_site_count") else F.col(f"f.{c}")).alias(c) for c in MODE[1:]],
        F.col("f.n_unique_positions").alias("n_unique_positions"), round_even(F.col("weighted_mean"), 2).alias("weighted_mean_position"), round_even(F.col("weighted_sd"), 2).alias("weighted_position_sd"),
        plain_number((F.col("q75") - F.col("q25")).cast("double")).alias("position_iqr"), "n_transcripts", "transcript_ids", "transcript_cluster_counts", plain_number(F.col("total")).alias("total_site_count"),
        "n_samples", "n_tissues", "n_cell_cultures", "sample_list", "transcript_biotype", "median_cluster_relative_abundance",
        F.coalesce("filter_pass_rule", F.lit("")).alias("filter_pass_rule"), F.coalesce("filter_reason", F.lit("")).alias("filter_reason"),
    )


def resolve_cutoff(value: int | str, samples: int) -> int:
    """A rescue cutoff: a number, or `auto` for ten reads a sample file up to 50."""
    if value == "auto":
        if samples < 1:
            raise ValueError("auto needs a sample")
        return min(10 * samples, 50)
    if str(int(value)) != str(value).strip() or int(value) < 0:
        raise ValueError("a cutoff is auto or a whole number from 0")
    return int(value)


def unify(rows: DataFrame, strategy: str = "observations", strong_count: int | str = 50, capitalize: bool = True, numbered: DataFrame | None = None, segmentation: dict | None = None, representative: dict | None = None, **options) -> dict[str, DataFrame]:
    """Tables of a unification of normalized, filtered rows (with ingest_seq): detailed, summary, filtered_out, unfiltered, verdicts.

    Rows with their cluster, the verdicts and the rows kept are written once, when a table is asked for that is made from them.
    numbered: positions with cluster_number, if they come from elsewhere. representative: `reach` and the four weights of `cluster_map`;
    the two that segmentation has too are those of the segmentation unless given. A name of a cluster that is kept is a new one; the
    table of those filtered out has the names from before."""
    if strong_count == "auto":
        strong_count = resolve_cutoff("auto", rows.select("sample_id").distinct().count())
    options = options | {"strong_count": int(strong_count)}
    if numbered is None:
        numbered = staged(meet(evidence(rows), segment(rows, **(segmentation or {}), strong_count=int(strong_count)), JOIN_KEY), "numbered")
    shared = {k: v for k, v in (segmentation or {}).items() if k in ("sample_weight", "count_weight")}
    own = placed(rows, numbered, **shared | (representative or {}))
    found = {"observations": observation_verdicts, "transcript-totals": transcript_verdicts}
    named = lambda df: tissue_names(df) if capitalize else df
    out = Tables()
    passed = lambda: out["verdicts"].where("filter_passed").select("cluster_key")
    rename = lambda df: meet(df, out["names"], "cluster_key").drop("cluster_key").withColumnRenamed("new_key", "cluster_key")
    out.how = {
        "verdicts": lambda: staged(no_filter(own) if strategy == "none" else found[strategy](shares(own, "prefilter_cluster_relative_abundance"), **options), "verdicts"),
        "names": lambda: staged(renumbered(meet(own, passed(), "cluster_key", "left_semi")), "names"),
        "detailed": lambda: staged(named(shares(rename(own))), "kept"),
        "summary": lambda: summary(out["detailed"], rename(out["verdicts"])),
        "filtered_out": lambda: summary(meet(own, passed(), "cluster_key", "left_anti").drop("_part"), out["verdicts"]),
        "unfiltered": lambda: named(shares(own)),
    }
    return out


def kept(rows: DataFrame, numbered: DataFrame, columns: tuple = (), capitalize: bool = True, **options) -> Tables:
    """Tables of the clusters that pass by observations, for those who need little of them: `rows` (cluster_key, transcript_id, sample_id, site_count,
    cluster_relative_abundance and the rows' named columns), `transcripts` (see `transcript_counts`) and `positions` (see `weighted_positions`).

    They are those of the detailed table of `unify`, which moves and writes whole rows with all that is said of their cluster. Here verdicts are made from reads summed
    by cluster, transcript and sample, names from the clusters' ends, positions from the evidence; rows are shuffled with the named columns and their new name alone."""
    numbered = numbered if hasattr(numbered, "_terminus_path") else staged(numbered, "numbered")
    key = F.concat_ws("|", *GENE_KEY, F.col("cluster_number").cast("string")).alias("cluster_key")
    obs = ["cluster_key", "transcript_id", "sample_id"]
    out = Tables()

    def observations() -> DataFrame:
        own = meet(rows.select(*JOIN_KEY, *obs[1:], "site_count"), numbered.select(*JOIN_KEY, "cluster_number"), JOIN_KEY)
        return staged(own.select(key, *obs[1:], "site_count").groupBy(*obs).agg(F.sum("site_count").alias("site_count")), "observations")

    def names() -> DataFrame:
        own = out["observations"].withColumn("_part", F.col("site_count"))
        passed = observation_verdicts(shares(own, "prefilter_cluster_relative_abundance"), **options).where("filter_passed").select("cluster_key")
        ends = numbered.groupBy(*CLUSTER_ID).agg(F.min("site_position").alias("cluster_start"), F.max("site_position").alias("cluster_end"))
        return staged(renumbered(meet(ends.withColumn("cluster_key", key), staged(passed, "passed"), "cluster_key", "left_semi")), "names")

    of_kept = lambda df: meet(df, out["names"], "cluster_key", "left_semi")
    rename = lambda df: meet(df, out["names"], "cluster_key").drop("cluster_key").withColumnRenamed("new_key", "cluster_key")

    def with_shares() -> DataFrame:
        cut = staged(rename(numbered.select(*JOIN_KEY, key)), "cut")
        own = (tissue_names(rows) if capitalize and "sample" in columns else rows).select(*JOIN_KEY, *obs[1:], "site_count", *columns)
        own = meet(own, cut, JOIN_KEY).select(*obs, "site_count", *columns)
        return shares(parts(own), whole=wholes(of_kept(out["observations"])))

    out.how = {
        "observations": observations,
        "names": names,
        "rows": with_shares,
        "transcripts": lambda: rename(transcript_counts(of_kept(out["observations"]))),
        "positions": lambda: rename(weighted_positions(of_kept(numbered.select(key, F.col("site_position").alias("original_site_position"), F.col("total_count").alias("site_count"))))),
    }
    return out


class Tables(dict):
    """Tables by name, each made when it is first asked for, so that nothing is computed for those that nobody reads."""

    how: dict

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.how[name]()
        return self[name]


def shared_names(summary_: DataFrame) -> DataFrame:
    """Coordinates that clusters of several genes share."""
    return summary_.groupBy("unified_ID").agg(F.count_distinct("effective_gene_id").alias("n_genes")).where("n_genes > 1")
