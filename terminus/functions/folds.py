"""Folds over arrays as column expressions: the least-cost partition of sorted positions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements of an inner fold: an array that grows in a fold is copied at each step, so a long one is made of short ones.
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def folded(items: Column, zero: Column, step: Callable[[Column, Column], Column], number: Callable[[Column], Column]) -> Column:
    """number(state) after each item, as an array; step(state, item) gives the next state."""
    numbers, lists = F.array().cast("array<int>"), F.array().cast("array<array<int>>")
    one = lambda t, item: let(step(t["state"], item), lambda r: F.struct(r.alias("state"), F.concat(t["out"], F.array(number(r))).alias("out")))
    block = lambda a, piece: let(F.aggregate(piece, F.struct(a["state"].alias("state"), numbers.alias("out")), one), lambda t: F.struct(t["state"].alias("state"), F.concat(a["out"], F.array(t["out"])).alias("out")))
    pieces = lambda own: F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / BLOCK).cast("int")), lambda b: F.slice(own, b * BLOCK + 1, F.lit(BLOCK)))
    return let(items, lambda own: F.flatten(F.aggregate(pieces(own), F.struct(zero.alias("state"), lists.alias("out")), block)["out"]))


def starts(points: Column, width: int, gap: int, penalty: float, compactness: float) -> Column:
    """For each of the sorted points (x, w) the number, from 0, of the first point of its cluster.

    Clusters cost a penalty each and their weighted variance; the least sum wins, then fewest clusters, then the earliest start of the last one. None is wider than
    `width` or has a step over `gap`. A state holds the points that a cluster with the next one may begin at, so it is as long as the width at most."""
    entry = "array<struct<x:int,w:double,cost:double,parts:int,i:int>>"
    zero = F.struct(F.array().cast(entry).alias("win"), F.lit(0.0).alias("cost"), F.lit(0).alias("parts"), F.lit(0).alias("i"), F.lit(0).alias("back"))
    no = F.array().cast("array<struct<c:double,parts:int,i:int>>")

    def priced(p: Column, a: Column, e: Column) -> Column:
        """One more point at the front of a cluster that ends with p: its sums, with places counted from p, and its price."""
        d = (e["x"] - p["x"]).cast("double")
        sums = F.struct((a["w"] + e["w"]).alias("w"), (a["m"] + e["w"] * d).alias("m"), (a["q"] + e["w"] * d * d).alias("q"))
        price = lambda t: e["cost"] + F.lit(float(penalty)) + F.lit(float(compactness)) * F.greatest(t["q"] / t["w"] - (t["m"] / t["w"]) * (t["m"] / t["w"]), F.lit(0.0))
        return let(sums, lambda t: F.struct(t["w"].alias("w"), t["m"].alias("m"), t["q"].alias("q"), F.concat(F.array(F.struct(price(t).alias("c"), (e["parts"] + 1).alias("parts"), e["i"].alias("i"))), a["found"]).alias("found")))

    def better(b: Column, c: Column) -> Column:
        return F.when((c["c"] < b["c"] - 1e-9) | (F.abs(c["c"] - b["c"]) <= 1e-9) & (c["parts"] < b["parts"]), c).otherwise(b)

    def step(s: Column, p: Column) -> Column:
        far = F.coalesce(p["x"] - F.try_element_at(s["win"], F.lit(-1))["x"] > gap, F.lit(False))
        kept = F.filter(F.when(far, F.array().cast(entry)).otherwise(s["win"]), lambda e: p["x"] - e["x"] + 1 <= width)
        win = F.concat(kept, F.array(F.struct(p["x"].alias("x"), p["w"].alias("w"), s["cost"].alias("cost"), s["parts"].alias("parts"), s["i"].alias("i"))))
        none = F.struct(F.lit(float("inf")).alias("c"), F.lit(2**31 - 1).alias("parts"), F.lit(0).alias("i"))
        sums = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("m"), F.lit(0.0).alias("q"), no.alias("found"))
        best = lambda v: F.aggregate(F.aggregate(F.reverse(v), sums, lambda a, e: priced(p, a, e))["found"], none, better)
        chosen = let(win, lambda v: F.struct(v.alias("win"), best(v).alias("best")))
        return let(chosen, lambda r: F.struct(r["win"].alias("win"), r["best"]["c"].alias("cost"), r["best"]["parts"].alias("parts"), (s["i"] + 1).alias("i"), r["best"]["i"].alias("back")))

    back = folded(points, zero, step, lambda s: s["back"])
    trail = lambda b: F.reverse(F.transform(b, lambda at, i: F.struct(i.alias("i"), at.alias("at"))))
    first = lambda b: F.reverse(folded(trail(b), F.size(b), lambda s, p: F.when(p["i"] < s, p["at"]).otherwise(s), lambda s: s))
    return let(back, first)
