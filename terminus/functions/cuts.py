"""The least-cost partition of the sorted positions of many chunks together, as one array program: the same sums and choices as `folds.starts`."""

from __future__ import annotations

import numpy as np

#: Costs that differ by no more count as equal.
EVEN = 1e-9


def starts(x: np.ndarray, w: np.ndarray, sizes: np.ndarray, width: int, gap: int, penalty: float, compactness: float) -> np.ndarray:
    """For each of the points (x, w) the number, from 0 over all, of the first point of its cluster. x rises within each of the chunks, which follow each other
    and have so many points (`sizes`); chunks are cut for themselves. Rules as in `folds.starts`.

    Chunks whose sizes have equally many bits take their steps together, so at most half of a step's places are empty."""
    begin = np.cumsum(sizes) - sizes
    chunk = np.repeat(np.arange(len(sizes)), sizes)
    here = np.arange(len(x))
    new = np.ones(len(x), bool)
    new[1:] = (chunk[1:] != chunk[:-1]) | (x[1:] - x[:-1] > gap)
    # The first point that a cluster with this one may begin at: within the width, after the last wide step.
    place = chunk * (1 << 34) + (x - (x.min() if len(x) else 0))
    low = np.minimum(np.maximum(np.searchsorted(place, place - int(width) + 1), np.maximum.accumulate(np.where(new, here, 0))), here) - begin[chunk]
    out = np.empty(len(x), np.int64)
    bits = np.frexp(sizes.astype(float))[1]
    for b in np.unique(bits):
        own = np.flatnonzero(bits == b)
        own = own[np.argsort(-sizes[own], kind="stable")]
        n = sizes[own]
        inside = np.arange(n[0])[:, None] < n
        rows = np.where(inside, begin[own] + np.arange(n[0])[:, None], 0)
        first = _together(x[rows].astype(float), np.where(inside, w[rows], 0.0), np.where(inside, low[rows], np.arange(n[0])[:, None]), n, penalty, compactness)
        out[rows[inside]] = (first + begin[own])[inside]
    return out


def _together(x: np.ndarray, w: np.ndarray, low: np.ndarray, n: np.ndarray, penalty: float, compactness: float) -> np.ndarray:
    """Points by place and chunk, chunks by falling size n; low: the first place that a cluster with the point may begin at. The first place of each point's cluster."""
    length, chunks = x.shape
    wide = int((np.arange(length)[:, None] - low).max()) + 1
    cost, parts = np.zeros((length + 1, chunks)), np.zeros((length + 1, chunks), np.int64)
    back = np.zeros((length, chunks), np.int64)
    active = np.searchsorted(-n, -np.arange(length), "left")  # chunks with more points than the place
    for at in range(length):
        m, first = active[at], max(0, at - wide + 1)
        d, own = (x[first : at + 1, :m] - x[at, :m])[::-1], w[first : at + 1, :m][::-1]
        pull = own * d
        total = np.cumsum(own, axis=0)
        mean = np.cumsum(pull, axis=0) / total
        spread = np.maximum(np.cumsum(pull * d, axis=0) / total - mean * mean, 0.0)[::-1]
        price = cost[first : at + 1, :m] + penalty + compactness * spread
        price[np.arange(first, at + 1)[:, None] < low[at, :m]] = np.inf
        best = price.argmin(axis=0)
        least = price[best, np.arange(m)]
        tied = np.flatnonzero((price <= least + 2 * EVEN).sum(axis=0) > 1)
        if len(tied):
            best[tied] = _chosen(price[:, tied], parts[first : at + 1, tied])
            least = price[best, np.arange(m)]
        back[at, :m] = first + best
        cost[at + 1, :m] = least
        parts[at + 1, :m] = parts[first + best, np.arange(m)] + 1
    out, until = np.empty((length, chunks), np.int64), n.copy()
    for at in range(length - 1, -1, -1):
        m = active[at]
        until[:m] = np.where(at < until[:m], back[at, :m], until[:m])
        out[at, :m] = until[:m]
    return out


def _chosen(price: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Of rows gone through in order, the one that is cheaper than the best before it, or as cheap with fewer clusters, for each column."""
    best, cheapest, fewest = np.zeros(price.shape[1], np.int64), np.full(price.shape[1], np.inf), np.full(price.shape[1], 2**31 - 1)
    for k in range(len(price)):
        c, p = price[k], parts[k] + 1
        even = np.isfinite(c) & (c <= cheapest + EVEN)
        better = (c < cheapest - EVEN) | even & (p < fewest)
        best[better], cheapest[better], fewest[better] = k, c[better], p[better]
    return best
