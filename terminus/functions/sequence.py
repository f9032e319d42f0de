"""Nucleotide sequences as strings: orientation, windows around a site, motif scans by priority.

A context is (sequence, start): the sequence reads 5' to 3', and start is its first base relative to the site (site = 0).
Windows are half-open and clipped to the context. Everything is a built-in expression, so scans stay in generated code.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Complements of the IUPAC codes, in both cases.
IUPAC, COMPLEMENT = "ACGTRYSWKMBDHVNacgtryswkmbdhvn", "TGCAYRSWMKVHDBNtgcayrswmkvhdbn"

# Extent of a context, width of the displayed flank.
SCAN_START, SCAN_END, FLANK = -150, 61, 50


def reverse_complement(s: Column) -> Column:
    return F.reverse(F.translate(s, IUPAC, COMPLEMENT))


def window(sequence: Column, start: Column, a: int, b: int) -> tuple[Column, Column]:
    """The bases from a to b (exclusive) and where they begin after clipping."""
    first = F.greatest(start, F.lit(a))
    last = F.least(start + F.length(sequence), F.lit(b))
    return F.when(last > first, F.substring(sequence, first - start + 1, last - first)).otherwise(F.lit("")), first


def first_motif(sequence: Column, start: Column, a: int, b: int, motifs, *more: Column) -> Column:
    """struct(motif, position, more) of the first motif of the list that lies in the window, at its leftmost place; else null.

    One regular expression passes over windows without any of them."""
    text, first = window(sequence, start, a, b)
    found = F.coalesce(*[F.when(F.locate(m, text) > 0, F.struct(F.lit(m).alias("motif"), (first + F.locate(m, text) - 1).alias("position"), *more)) for m in motifs])
    return F.when(text.rlike("|".join(map(re.escape, motifs))), found)


def rich_hexamer(sequence: Column, start: Column, a: int, b: int, *more: Column, base: str = "T", least: int = 5) -> Column:
    """struct(motif, position, more) of the hexamer with most of a base (`least` or more), nearest to the site, then leftmost."""
    text, first = window(sequence, start, a, b)
    count = lambda s: F.length(s) - F.length(F.replace(s, F.lit(base), F.lit("")))
    hexamers = F.transform(
        F.when(F.length(text) >= 6, F.sequence(F.lit(0), F.length(text) - 6)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct((-count(F.substring(text, i + 1, F.lit(6)))).alias("n"), F.abs(first + i).alias("d"), (first + i).alias("position"), F.substring(text, i + 1, F.lit(6)).alias("motif")),
    )
    best = F.array_min(F.filter(hexamers, lambda h: h["n"] <= -least))
    rich = "|".join("".join("." if i in gaps else base for i in range(6)) for gaps in combinations(range(6), 6 - least))
    return F.when(text.rlike(rich), F.struct(best["motif"].alias("motif"), best["position"].alias("position"), *more))


def fraction(text: Column, base: str) -> Column:
    """Share of a base; null for an empty text."""
    return F.when(F.length(text) > 0, (F.length(text) - F.length(F.replace(text, F.lit(base), F.lit("")))) / F.length(text))


def context_bounds(pos: Column, strand: Column, length: Column) -> tuple[Column, Column, Column]:
    """0-based start and end (exclusive) on the chromosome and the relative start, for a 1-based site."""
    p = pos - 1
    plus = strand == "+"
    first = F.greatest(F.lit(0), F.when(plus, p + SCAN_START).otherwise(p - SCAN_END + 1))
    last = F.least(length, F.when(plus, p + SCAN_END).otherwise(p - SCAN_START + 1))
    return first, last, F.when(plus, first - p).otherwise(p - last + 1)


def oriented_context(sequence: Column, pos: Column, strand: Column) -> tuple[Column, Column]:
    """The context of a site in a chromosome held as one string, and where it starts."""
    first, last, start = context_bounds(pos, strand, F.length(sequence))
    piece = F.substring(sequence, first + 1, last - first)
    return F.when(strand == "-", reverse_complement(piece)).otherwise(piece), start


def display(sequence: Column, start: Column) -> Column:
    return window(sequence, start, -FLANK, FLANK + 1)[0]


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)
