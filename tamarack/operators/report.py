"""Accounting: ratios, failure taxonomy, warnings, manifests, order statistics, stratified samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .gate import first_of, safe_ratio

# The keys that the manifests of a run and of a source must have.
RUN_KEYS = tuple("run_id pitcher status source_selection_mode sources_attempted finals results created_utc milestone".split())
SOURCE_KEYS = tuple(
    """pitcher_name video_id source_url source_title channel source_type competition_context game_year game_year_confidence discovery_score preview_decision
    source_selection_mode download_status acquisition_method local_path normalization_status shot_count center_field_candidates rejected_low_confidence
    rejected_transition rejected_homogeneous_closeup complete_events rejected_events rejected_start_incomplete rejected_end_incomplete rejected_no_complete_pitch
    rejected_discontinuity raw_clip_count duplicate_rejected replay_rejected replay_status final_clip_count final_duration_sec final_codec final_path status
    quality_summary quality_warning warnings""".split()
)


def ratios(shots: Column, cf: Column, complete: Column, final: Column, seconds: Column) -> dict[str, Column]:
    zero = F.lit(0.0)
    minutes = F.coalesce(seconds, zero) / 60.0
    return {
        "center_field_rate": safe_ratio(F.coalesce(cf, zero), shots), "complete_yield": safe_ratio(F.coalesce(complete, zero), cf),
        "final_yield": safe_ratio(F.coalesce(final, zero), cf), "clips_per_source_minute": safe_ratio(F.coalesce(final, zero), minutes),
    }


def taxonomy(status: Column, context: Column, shots: Column, cf_rate: Column, start: Column, end: Column, none: Column, complete: Column, final: Column, complete_yield: Column, seconds: Column, discontinuous: Column) -> Column:
    """The one bucket of a failure, by rules in order."""
    z = lambda c: F.coalesce(c, F.lit(0))
    total = z(start) + z(end) + z(none)
    return first_of([
        (status == "failed-download", "DOWNLOAD_FAILURE"), (context == "non_mlb", "SOURCE_NOT_MLB"), (z(shots) == 0, "UNKNOWN"), (cf_rate < 0.30, "LOW_CENTER_FIELD_COVERAGE"),
        ((total > 0) & (z(start) / F.greatest(total, F.lit(1)) >= 0.5), "HIGH_START_INCOMPLETE"), ((total > 0) & (z(end) / F.greatest(total, F.lit(1)) >= 0.5), "HIGH_END_INCOMPLETE"),
        ((z(complete) == 0) & (z(final) == 0), "ZERO_USABLE_EVENTS"), (complete_yield < 0.05, "LOW_COMPLETE_EVENT_YIELD"),
        ((z(seconds) > 0) & (z(seconds) < 180), "SOURCE_TOO_SHORT"), (z(discontinuous) / F.greatest(z(shots), F.lit(1)) >= 0.05, "SOURCE_BAD_EDITING"),
    ], "UNKNOWN")


def dedup_warning(removed: Column, kept: Column, most: float = 0.30) -> Column:
    total = F.coalesce(removed, F.lit(0)) + F.coalesce(kept, F.lit(0))
    return F.coalesce(F.try_divide(F.coalesce(removed, F.lit(0)).cast("double"), total.cast("double")) > most, F.lit(False))


def listed(*warnings: Column) -> Column:
    """The warnings that are not null, in order."""
    return F.filter(F.array(*warnings), lambda w: w.isNotNull())


def source_warnings(mode: Column, cf: Column, complete: Column, final: Column, year: Column, confidence: Column, replay: Column, status: Column, least: Column, low_yield: float = 0.03, few: int = 3) -> Column:
    """The warnings of a source's manifest, in order."""
    z = lambda c: F.coalesce(c, F.lit(0))
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    sure = (year != 0) & confidence.isin("high", "medium")
    return listed(
        first_of([
            (mode == "borderline_fallback", "borderline source fallback (no recommended source)"),
            (mode == "insufficient_evidence_fallback", "insufficient preview evidence fallback (accepted only on full-run yield)"),
            (mode == "bad_evidence_fallback", "preview judged source bad; last-resort fallback (accepted only on full-run yield)"),
        ], None),
        F.when((z(cf) > 0) & (z(complete) / F.greatest(z(cf), F.lit(1)) < low_yield), text("unusually low event yield (", z(complete), "/", z(cf), ")")),
        F.when((z(final) > 0) & (z(final) < few), text("very few final clips (", z(final), ")")),
        F.when(~F.coalesce(sure, F.lit(False)), F.when(year.isNotNull(), text("game year unreliable (", year, " is ", confidence, " confidence; filename uses UnknownYear)")).otherwise("game year unreliable")),
        F.when(replay == "uncertain", "replay detection conservative (uncertain)"),
        F.when(status == "no-usable-clips", "no usable clips from this source"),
        F.when(status == "low-yield", text(z(final), " final clips < ", least, " required; source not used")),
    )


def missing_keys(held: Column, required=RUN_KEYS) -> Column:
    """The required keys that a map of a manifest does not have."""
    return F.array_sort(F.array_except(F.array(*[F.lit(k) for k in required]), F.map_keys(held)))


def extremes(rows: DataFrame, group: str, value: str, id_col: str, k: int = 5, salts: int = 64) -> DataFrame:
    """The k lowest and k highest of each group: (group, side, rank, id, value). Parts of a group keep their k first, so that none is sorted whole."""
    sides = []
    for name, order in (("lowest", [F.col(value), F.col(id_col)]), ("highest", [F.col(value).desc(), F.col(id_col)])):
        dealt = rows.select(group, id_col, value, F.pmod(F.xxhash64(id_col), F.lit(salts)).alias("__salt"))
        part = dealt.withColumn("__n", F.row_number().over(Window.partitionBy(group, "__salt").orderBy(*order))).where(F.col("__n") <= k)
        whole = part.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)
        sides.append(whole.select(group, F.lit(name).alias("side"), "rank", id_col, value))
    return sides[0].unionByName(sides[1])


def latest(rows: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """The last record of each key, by a combining aggregate."""
    last = F.max_by(F.struct(*cols), F.struct(*order)).alias("__r")
    return rows.groupBy(*keys).agg(last).select(*keys, "__r.*")


def stratified(rows: DataFrame, strata: list[tuple[str, Column, int]], id_col: str) -> DataFrame:
    """Each row in the first stratum it fits, and of each stratum the first so many by id: (id, stratum, place)."""
    name = first_of([(c, n) for n, c, _ in strata], "rest")
    size = first_of([(F.col("stratum") == n, F.lit(k)) for n, _, k in strata], F.lit(0))
    fit = rows.withColumn("stratum", name).where(F.col("stratum") != "rest").withColumn("__salt", F.pmod(F.xxhash64(id_col), F.lit(64)))
    some = fit.withColumn("place", F.row_number().over(Window.partitionBy("stratum", "__salt").orderBy(id_col))).where(F.col("place") <= size)
    placed = some.withColumn("place", F.row_number().over(Window.partitionBy("stratum").orderBy(id_col)))
    return placed.where(F.col("place") <= size).select(id_col, "stratum", "place")


def clip_bounds(events: DataFrame, keys: list[str], pre: float = 2.0, post: float = 1.5, edge: float = 0.1, end_edge: float = 0.25, gap: float = 0.3, most: float = 30.0, id_col: str = "event_id") -> DataFrame:
    """events (keys, shot_start, shot_end, clip_start, onset, settle, clip_end) with start and end of the delivered clip.

    The last settle at or before an onset, and the first onset at or after a settle, among the others of the shot, come from
    one pass each over settles and onsets in order of time; no row carries its group.
    """
    c = F.col
    order = Window.partitionBy(*keys).orderBy("__t", "__side", id_col)

    def neighbour(mark: str, at: str, side: int, frame, best) -> DataFrame:
        """For each event the best `mark` of the group's events in the frame around its `at`."""
        rows = events.select(*keys, id_col, c("settle").alias("__t"), F.lit(0).alias("__side"), (c("settle") if mark == "settle" else F.lit(None).cast("double")).alias("__mark"))
        rows = rows.unionByName(events.select(*keys, id_col, c("onset").alias("__t"), F.lit(1).alias("__side"), (c("onset") if mark == "onset" else F.lit(None).cast("double")).alias("__mark")))
        return rows.withColumn("__best", best("__mark").over(frame)).where(c("__side") == side).select(*keys, id_col, c("__best").alias(at))

    earlier = neighbour("settle", "__earlier", 1, order.rowsBetween(Window.unboundedPreceding, -1), F.max)
    later = neighbour("onset", "__later", 0, order.rowsBetween(1, Window.unboundedFollowing), F.min)
    # An event that settles no later than its onset would meet itself: those few are compared with the others of their group.
    odd = events.where(c("settle") <= c("onset")).select(*keys, id_col, c("onset").alias("__o"), c("settle").alias("__s"))
    others = events.select(*keys, c(id_col).alias("__id"), c("onset").alias("__oo"), c("settle").alias("__os"))
    met = odd.join(others, keys).where(c(id_col) != c("__id")).groupBy(*keys, id_col).agg(F.max(F.when(c("__os") <= c("__o"), c("__os"))).alias("__earlier2"), F.min(F.when(c("__oo") >= c("__s"), c("__oo"))).alias("__later2"))
    rows = events.join(earlier, [*keys, id_col]).join(later, [*keys, id_col]).join(met, [*keys, id_col], "left")
    rows = rows.withColumn("__earlier", F.when(c("settle") <= c("onset"), c("__earlier2")).otherwise(c("__earlier"))).withColumn("__later", F.when(c("settle") <= c("onset"), c("__later2")).otherwise(c("__later")))
    start = F.greatest(c("shot_start") + edge, c("onset") - pre, c("__earlier") + gap)
    end = F.least(c("shot_end") - end_edge, c("settle") + post, c("__later") - gap)
    rows = rows.withColumn("__s", F.least(start, c("clip_start"))).withColumn("__e", F.least(F.greatest(end, c("clip_end")), c("shot_end") - end_edge))
    return rows.withColumn("start", F.round("__s", 3)).withColumn("end", F.round(F.least(c("__e"), c("__s") + most), 3)).drop("__earlier", "__later", "__earlier2", "__later2", "__s", "__e")


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, shares: list[float], accuracy: int = 1000) -> DataFrame:
    """(keys, n, quantiles): exact quantiles of each group, interpolated; no state grows with a group's distinct values.

    A sketch of bounded size brackets each quantile by values whose ranks are off by a share of 1/accuracy at most. A
    second pass counts what lies below each bracket and, of values within one, each with how often it comes, so that only
    about a 4/accuracy part of the distinct values is sorted. Should a sketch be off further than it says, the group is
    computed in full. Nulls don't count; a group of nulls only has no quantiles.
    """
    x, off = F.col("__x"), 2.0 / accuracy
    known = rows.select(*keys, F.col(value).cast("double").alias("__x")).where(x.isNotNull())
    probes = [p for q in shares for p in (max(0.0, q - off), min(1.0, q + off))]
    sketch = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(x, probes, accuracy).alias("__p"), F.min(x).alias("__min"), F.max(x).alias("__max"))
    brackets = F.array(*[
        F.struct(F.lit(k).alias("k"), (F.col("__min") if q - off <= 0 else F.get("__p", 2 * k)).alias("low"), (F.col("__max") if q + off >= 1 else F.get("__p", 2 * k + 1)).alias("high"), (F.lit(q) * (F.col("n") - 1)).alias("at"))
        for k, q in enumerate(shares)
    ])
    held = stored(sketch.select(*keys, "n", brackets.alias("__b")), "sketch")
    # Of each bracket what lies below it is one row (of a null value), and each value within it another.
    marks = F.transform(F.filter("__b", lambda b: x <= b["high"]), lambda b: F.struct(b["k"].alias("k"), b["at"].alias("at"), F.when(x >= b["low"], x).alias("x")))
    counted = known.join(held, keys).select(*keys, "n", F.explode(marks).alias("m")).groupBy(*keys, "n", F.col("m.k").alias("k"), F.col("m.at").alias("at"), F.col("m.x").alias("x")).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(*keys, "k").orderBy(F.asc_nulls_first("x"))
    first = F.sum("__c").over(w) - F.col("__c")
    placed = counted.withColumn("__first", first).where("x IS NOT NULL")
    has = lambda rank: (F.col("__first") <= rank) & (rank < F.col("__first") + F.col("__c"))
    lower, upper = F.floor("at"), F.ceil("at")
    ranks = placed.groupBy(*keys, "n", "k", "at").agg(F.max(F.when(has(lower), F.col("x"))).alias("low"), F.max(F.when(has(upper), F.col("x"))).alias("high"))
    one = F.when(lower == upper, F.col("low")).otherwise((upper - F.col("at")) * F.col("low") + (F.col("at") - lower) * F.col("high"))
    found = ranks.groupBy(*keys, "n").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", one.alias("v")))), lambda r: r["v"]).alias("quantiles"))
    found = stored(found.where((F.size("quantiles") == len(shares)) & ~F.exists("quantiles", lambda v: v.isNull())), "quantiles")
    missed = held.select(*keys, "n").join(found, keys, "left_anti")
    if missed.isEmpty():
        return found
    rest = known.join(missed, keys).groupBy(*keys).agg(F.max("n").alias("n"), F.percentile("__x", F.array(*[F.lit(q) for q in shares])).alias("quantiles"))
    return found.unionByName(rest)
