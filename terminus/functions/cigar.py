"""Alignment strings: reference length and intron chain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reference_length(cigar: Column) -> Column:
    """Bases of the reference that an alignment spans: M, D, N, = and X advance."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), 1), F.lit(0), lambda a, n: a + n.cast("int"))


def junction_chain(cigar: Column, start: Column) -> Column:
    """(end of exon, start of next exon, ...) in 1-based coordinates, for a 0-based start; null without an intron.

    Only alignments with an N are gone through, by the steps that advance."""
    zero = F.struct(start.cast("int").alias("at"), F.array().cast("array<int>").alias("chain"))
    part = lambda i: F.regexp_extract_all(cigar, F.lit(r"(\d+)([MDN=X])"), i)
    steps = F.zip_with(part(1), part(2), lambda n, op: F.struct(n.cast("int").alias("n"), (op == "N").alias("gap")))

    def step(a, s):
        end = a["at"] + s["n"]
        return F.struct(end.alias("at"), F.when(s["gap"], F.concat(a["chain"], F.array(a["at"], end + 1))).otherwise(a["chain"]).alias("chain"))

    return F.when(cigar.rlike(r"\dN"), F.aggregate(steps, zero, step, lambda a: a["chain"]))
