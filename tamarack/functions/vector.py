"""Vectors, hashes and intervals as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column, guard: float = 1e-8) -> Column:
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(guard))


def sign_bits(a: Column) -> Column:
    """A 64-bit hash: bit k is set where element k is positive."""
    bits = F.transform(F.slice(a, 1, 64), lambda x, i: F.when(x > 0, F.expr("1L")).otherwise(F.expr("0L")))
    return F.aggregate(bits, F.expr("0L"), lambda s, x: F.shiftleft(s, 1).bitwiseOR(x))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def best_class(scores: Column) -> Column:
    """The key of the greatest value of a map; of equal ones the first."""
    entries = F.map_entries(scores)
    keyed = F.transform(entries, lambda e, i: F.struct(e["value"].alias("v"), (-i).alias("i"), e["key"].alias("k")))
    return F.array_max(keyed)["k"]


def runner_up(scores: Column, kind: str | Column) -> Column:
    return best_class(F.map_filter(scores, lambda k, v: k != kind))


def class_margin(scores: Column, kind: str | Column) -> Column:
    """How far the class leads all others, to 4 places; null where it has no score."""
    others = F.coalesce(F.array_max(F.map_values(F.map_filter(scores, lambda k, v: k != kind))), F.lit(0.0))
    return F.round(scores[kind] - others, 4)


def top_mean(values: Column, k: int = 3) -> Column:
    best = F.slice(F.sort_array(values, False), 1, k)
    return F.aggregate(best, F.lit(0.0), lambda s, x: s + x) / F.size(best)


def softmax(values: Column, heat: float = 50.0) -> Column:
    top = F.array_max(values)
    raised = F.transform(values, lambda x: F.exp((x - top) * heat))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda s, y: s + y))


def overlaps(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Strictly: intervals that touch do not overlap."""
    return (a1 > b0) & (b1 > a0)


def time_gap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Seconds between two intervals, 0 where they meet; null where a bound is missing."""
    known = a0.isNotNull() & a1.isNotNull() & b0.isNotNull() & b1.isNotNull()
    return F.when(known, F.greatest(F.lit(0.0), b0 - a1, a0 - b1))


def iou(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    shared = F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))
    whole = F.greatest(a1, b1) - F.least(a0, b0)
    return F.when(whole > 0, shared / whole).otherwise(0.0)


def pearson(a: Column, b: Column) -> Column:
    """Correlation of two arrays, such as histograms; 1 where both are constant."""
    n = F.size(a).cast("double")
    mean = lambda x: F.aggregate(x, F.lit(0.0), lambda s, y: s + y) / n
    ma, mb = mean(a), mean(b)
    da, db = F.transform(a, lambda x: x - ma), F.transform(b, lambda x: x - mb)
    scale = F.sqrt(dot(da, da) * dot(db, db))
    return F.when(scale > 0, dot(da, db) / scale).otherwise(1.0)


def ratio(text: Column) -> Column:
    """A rational such as 30000/1001, null where it has no value."""
    parts = F.split(text, "/")
    return F.try_divide(F.try_to_number(parts[0], F.lit("999999999")).cast("double"), F.coalesce(F.get(parts, F.lit(1)).cast("double"), F.lit(1.0)))
