"""The preview gate: metrics, decisions, evidence, budgets, tiers and fallbacks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def safe_ratio(a: Column, b: Column, places: int = 4) -> Column:
    """a / b rounded, 0 where b is 0 or unknown."""
    return F.coalesce(F.round(F.try_divide(a.cast("double"), b.cast("double")), places), F.lit(0.0))


def metrics(cf: str, shots: str, complete: str, rejected: str, discontinuous: str, seconds: str) -> dict[str, Column]:
    c = F.col
    return {
        "complete_event_yield": F.round(c(complete) / F.greatest(c(cf), F.lit(1)), 4),
        "events_per_minute": F.coalesce(F.round(F.try_divide(c(complete) * F.lit(60.0), c(seconds).cast("double")), 4), F.lit(0.0)),
        "incomplete_rate": F.round(c(rejected) / F.greatest(c(cf), F.lit(1)), 4),
        "discontinuity_rate": F.round(c(discontinuous) / F.greatest(c(cf), F.lit(1)), 4),
        "center_field_ratio": F.round(c(cf) / F.greatest(c(shots), F.lit(1)), 3),
    }


def decide(status: Column, context: Column, cf: Column, events: Column, yield_: Column, discontinuity: Column, cf_ratio: Column, outside: str = "non_mlb") -> Column:
    """recommended, borderline or reject; an unknown context is borderline at best."""
    good = (events >= 2) & (yield_ >= 0.20) & (discontinuity <= 0.20)
    return (
        F.when((status == "failed") | (context == outside) | (cf == 0), "reject")
        .when(good, F.when(context == "unknown", "borderline").otherwise("recommended"))
        .when((events >= 1) | ((cf_ratio >= 0.40) & (discontinuity <= 0.30)), "borderline").otherwise("reject")
    )


def reasons(status: Column, error: Column, context: Column, cf: Column, events: Column, yield_: Column, discontinuity: Column, cf_ratio: Column, incomplete: Column, outside: str = "non_mlb") -> Column:
    """Why a source was decided as it was, in order: one reason of the first rule that holds, and that the context is unknown."""
    said = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    # The wording of reasons.
    early = first_of([(status == "failed", said("acquisition failed: ", F.left(error, F.lit(120)))), (context == outside, "non-MLB competition context excluded from production"), (cf == 0, "zero center-field candidates in preview")], None)
    good = (events >= 2) & (yield_ >= 0.20) & (discontinuity <= 0.20)
    later = first_of([
        (good, said("yield ", yield_, " over ", cf, " CF candidates")), (events >= 1, said("single complete event (yield ", yield_, ")")),
        ((cf_ratio >= 0.40) & (discontinuity <= 0.30), said("no complete events, but CF available (", cf_ratio, ") with clean continuity")),
    ], said("yield ", yield_, ", incomplete_rate ", incomplete))
    unknown = F.when(context == "unknown", "competition context unknown (not confirmed MLB)")
    return F.when(early.isNotNull(), F.array(early)).otherwise(F.filter(F.array(later, unknown), lambda r: r.isNotNull()))


def evidence(cf: Column, complete: Column, rejected: Column, discontinuous: Column, start_incomplete: Column) -> Column:
    bad = (cf >= 8) & ((rejected >= 6) | (discontinuous >= 2) | (start_incomplete >= 4))
    return F.when(complete >= 1, "sufficient_good").when(bad, "sufficient_bad").otherwise("insufficient")


def budget_ok(segments: Column, seconds: Column, duration: Column) -> Column:
    """Whether less than 10 segments, 200 seconds and half the duration have been looked at."""
    return (segments < 10) & (seconds < 200) & ~F.coalesce((duration > 0) & (seconds / duration >= 0.5), F.lit(False))


def expansion_rounds(duration: Column) -> Column:
    return F.when(F.coalesce(duration <= 900, F.lit(False)), F.array(F.lit(2), F.lit(3))).otherwise(F.array(F.lit(2)))


def add_maps(a: Column, b: Column) -> Column:
    return F.map_zip_with(a, b, lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def merge_partials(parts: DataFrame, keys: list[str], sums: list[str], reason: str, count: str) -> DataFrame:
    """Partial counts by (keys, reason) of any number of rounds as one row a key, with a map of reasons."""
    each = parts.groupBy(*keys, reason).agg(F.sum(count).alias("__n"), *[F.sum(s).alias(s) for s in sums])
    entries = F.sort_array(F.collect_list(F.struct(F.col(reason).alias("key"), F.col("__n").alias("value"))))
    return each.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums], F.map_from_entries(entries).alias("by_reason"))


def fallback_ok(decision: Column, state: Column, wanted: str, cf: Column, context: Column, status: Column, outside: str = "non_mlb") -> Column:
    """A rejected source that may still be tried: with shots, in context, and acquired."""
    return (
        (decision == "reject") & (state == wanted) & (F.coalesce(cf, F.lit(0)) > 0)
        & (F.coalesce(context, F.lit("unknown")) != outside) & F.coalesce(status.isin("ok", "partial"), F.lit(False))
    )


def tier(decision: Column, state: Column, cf: Column, context: Column, status: Column, outside: str = "non_mlb") -> Column:
    """1 to 4, or null for a source that is not in the pool."""
    ok = lambda s: F.coalesce(fallback_ok(decision, state, s, cf, context, status, outside), F.lit(False))
    return (
        F.when(decision == "recommended", 1).when((decision == "borderline") & (F.coalesce(context, F.lit("unknown")) != outside), 2)
        .when(ok("insufficient"), 3).when(ok("sufficient_bad"), 4)
    )


MODES = ("recommended", "borderline_fallback", "insufficient_evidence_fallback", "bad_evidence_fallback")


def tier_order(tier_col: str, events: str, cf: str, score: str, *ties: str) -> list[Column]:
    """Ascending keys: tiers in turn; the first two by events and score, the others by shots and score, the greatest first and unknown scores last."""
    return [F.col(tier_col), -F.when(F.col(tier_col) <= 2, F.col(events)).otherwise(F.col(cf)), F.col(score).isNull(), -F.col(score), *map(F.col, ties)]


def with_places(rows: DataFrame, order: list[Column], key: str, place: str = "place", ranges: int = 64) -> DataFrame:
    """rows with their place from 1, by counts of ordered ranges: no task holds more than a range's rows.

    order: ascending; key, the last of them: unique. The bounds of the ranges are the rows of least hash of their key.
    """
    at = rows.withColumn("__at", F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)]))
    some = at.select("__at", F.xxhash64(key).alias("h")).orderBy("h", "__at").limit(ranges - 1)
    bounds = some.agg(F.collect_list("__at").alias("__bounds"))
    dealt = at.join(F.broadcast(bounds)).withColumn("__range", F.size(F.filter("__bounds", lambda b: b < F.col("__at")))).drop("__bounds")
    counts = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).agg(F.collect_list(F.struct("__range", "n")).alias("__counts"))
    before = F.aggregate(F.filter("__counts", lambda c: c["__range"] < F.col("__range")), F.lit(0).cast("long"), lambda s, c: s + c["n"])
    own = F.row_number().over(Window.partitionBy("__range").orderBy("__at"))
    return dealt.withColumn("__own", own).join(F.broadcast(counts)).withColumn(place, (F.col("__own") + before).cast("int")).drop("__at", "__range", "__own", "__counts")


def first_success(attempts: DataFrame, keys: list[str], ok: Column, order: list[Column], value: str) -> DataFrame:
    """Of each key the first attempt in order that succeeds."""
    return attempts.where(ok).groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias(value))


def first_of(rules: list[tuple[Column, str | Column]], otherwise: str | Column | None) -> Column:
    return reduce(lambda c, r: c.when(*r), rules[1:], F.when(*rules[0])).otherwise(otherwise)
