"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terminus.llm.common import BATCH_NUMBERS, batch, dropped, materialize, same_set

EDGE = "u long, v long"


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n nodes over the edges a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    while not np.array_equal(label[label], label):
        label = label[label]
    return label


def contract(batches):
    """Replace the edges of each batch by stars around the smallest node of each part."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    for x in batches:
        u, v = (x.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = local_labels(len(nodes), at[: len(u)], at[len(u) :])
        own = np.flatnonzero(root != np.arange(len(nodes)))
        yield batch({"u": nodes[own], "v": nodes[root[own]]}, schema)


def components(edges: DataFrame, name: str = "components", most: int = 60) -> DataFrame:
    """edges (u, v): one row (node, root) for each node that reaches a smaller one, root the smallest node reachable.

    An edge leads from a node to a smaller one. In a round each edge goes on to the least neighbour of its end (large star), then each node's edges to the least of
    their ends (small star): one aggregation with partial sums, one join that adaptive execution may broadcast, and one shuffle by node whose order both the second
    aggregation and its join use, so a round has few tasks; rounds grow with the logarithm of a component's size. Only a count and
    a checksum reach the driver. Self-loops and repeated edges are ignored; an empty table gives no rows.
    """
    e = materialize(edges.where("u != v").mapInArrow(contract, EDGE).distinct(), f"{name}-edges", rows=BATCH_NUMBERS)
    state = same_set(e, "u", "v")
    for _ in range(most):
        if not state[0]:
            break
        low = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), "m")
        large = e.join(low, "v", "left").select("u", F.coalesce("m", "v").alias("v")).repartition("u")
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")).hint("merge"), "u")  # dealt out by u already; a broadcast would be one stage more
        small = small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e, before = materialize(small.distinct(), f"{name}-round", rows=BATCH_NUMBERS), e
        dropped(before)
        if (now := same_set(e, "u", "v")) == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    return e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
