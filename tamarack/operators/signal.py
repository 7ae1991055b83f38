"""Ordered signals: change points, smoothing, runs, spikes. Rows are (keys, t, value); every window ends with a unique order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored


def change_points(rows: DataFrame, keys: list[str], order: list[str], same) -> DataFrame:
    """rows with is_cut: unlike the row before, and unlike the one before also one row later (a flash is no cut), unless last."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = lambda c: F.lag(c).over(w)
    after = F.lead(F.struct(*[F.col(c) for c in rows.columns])).over(w)
    flagged = rows.withColumn("__before", before(F.struct(*[F.col(c) for c in rows.columns]))).withColumn("__after", after)
    here = F.struct(*[F.col(c) for c in rows.columns])
    cut = F.col("__before").isNotNull() & ~same(F.col("__before"), here) & (F.col("__after").isNull() | ~same(F.col("__before"), F.col("__after")))
    return flagged.withColumn("is_cut", cut).drop("__before", "__after")


def accepted_cuts(cuts: DataFrame, roots: DataFrame, keys: list[str], gap: float) -> DataFrame:
    """(keys, t): the root of each group, and of its cuts those at least `gap` after the one accepted before.

    Which cut follows an accepted one depends on it alone: the first `gap` or more after it, found for all cuts by one
    ordered pass. From the roots, steps are doubled: after k rounds the first 2**k of each chain are known, so that the
    rounds go with the logarithm of the longest chain and no row grows with a group.
    """
    cuts = cuts.where(F.col("t") >= gap).distinct()
    probes = cuts.unionByName(roots).withColumn("__at", F.col("t") + gap).withColumn("__cut", F.lit(None).cast("double"))
    both = probes.unionByName(cuts.withColumn("__at", F.col("t")).withColumn("__cut", F.col("t")))
    later = Window.partitionBy(*keys).orderBy(F.desc("__at"), F.desc_nulls_last("__cut")).rowsBetween(Window.unboundedPreceding, 0)
    step = both.withColumn("next", F.last("__cut", ignorenulls=True).over(later)).where("__cut IS NULL AND next IS NOT NULL").select(*keys, "t", "next")
    known, step = stored(roots, "cuts"), stored(step, "steps")
    while True:
        new = stored(known.join(step, [*keys, "t"]).select(*keys, F.col("next").alias("t")), "cuts")
        if new.isEmpty():
            return known
        known = known.unionByName(new)
        step = stored(step.join(step.select(*keys, F.col("t").alias("next"), F.col("next").alias("__far")), [*keys, "next"]).select(*keys, "t", F.col("__far").alias("next")), "steps")


def shots_of(rows: DataFrame, keys: list[str], time: str, cut: str, gap: float = 0.4) -> DataFrame:
    """(keys, shot, start, end) from rows whose cut flag marks the time of a change, times from 0 on.

    Cuts follow the accepted one before by `gap` or more. As these are that far apart, only what is left after the last
    can be a sliver; it goes to the shot before.
    """
    length = rows.groupBy(*keys).agg(F.max(time).cast("double").alias("__length")).where("__length > 0")
    at = rows.where(F.col(cut)).select(*keys, F.col(time).cast("double").alias("t"))
    accepted = accepted_cuts(at, length.select(*keys, F.lit(0.0).alias("t")), keys, gap).join(length, keys)
    w = Window.partitionBy(*keys).orderBy("t")
    sliver = F.lead("t").over(w).isNull() & (F.col("t") > 0) & (F.col("__length") - F.col("t") < gap)
    starts = accepted.withColumn("__sliver", sliver).where("NOT __sliver")
    return starts.select(*keys, (F.row_number().over(w) - 1).alias("shot"), F.col("t").alias("start"), F.coalesce(F.lead("t").over(w), "__length").alias("end"))


def smooth(rows: DataFrame, keys: list[str], order: list[str], value: str, median: int = 1, trail: int = 3) -> DataFrame:
    """rows with smoothed: centred median, divided by its 99th percentile (0: by 1), cut at 1, mean with the rows before; under three rows 0."""
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = Window.partitionBy(*keys)
    level = rows.withColumn("__m", F.percentile(value, F.lit(0.5)).over(w.rowsBetween(-median, median)))
    top = F.percentile("__m", F.lit(0.99)).over(whole)
    scaled = level.withColumn("__x", F.least(F.lit(1.0), F.col("__m") / F.coalesce(F.nullif(top, F.lit(0.0)), F.lit(1.0)))).withColumn("__n", F.count(F.lit(1)).over(whole))
    mean = F.avg("__x").over(w.rowsBetween(-trail, 0))
    return scaled.withColumn("smoothed", F.when(F.col("__n") < 3, 0.0).otherwise(mean)).drop("__m", "__x", "__n")


def runs(rows: DataFrame, keys: list[str], order: list[str], time: str, flag) -> DataFrame:
    """(keys, run, first, last, rows) of the runs of successive rows for which flag holds."""
    w = Window.partitionBy(*keys).orderBy(*order)
    numbered = rows.withColumn("__f", flag).withColumn("__n", F.row_number().over(w))
    held = numbered.where("__f").withColumn("run", F.col("__n") - F.row_number().over(w))
    return held.groupBy(*keys, "run").agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count(F.lit(1)).alias("rows"))


def bridged(islands: DataFrame, keys: list[str], gap: float) -> DataFrame:
    """Runs with gaps shorter than `gap` between them as one: (keys, blob, first, last, rows)."""
    w = Window.partitionBy(*keys).orderBy("first", "run")
    new = F.coalesce((F.col("first") - F.lag("last").over(w) >= gap).cast("int"), F.lit(0))
    marked = islands.withColumn("__new", new).withColumn("blob", F.sum("__new").over(w))
    return marked.groupBy(*keys, "blob").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows"))


def spikes(rows: DataFrame, keys: list[str], order: list[str], value: str, hard: float = 20.0, least: float = 3.0, ratio: float = 4.0, floor: float = 0.3) -> DataFrame:
    """rows with is_spike: over `hard`, or a lone value over `least` and `ratio` times the median of those near it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    x = F.col(value)
    near = rows.withColumn("__l", F.concat(F.collect_list(value).over(w.rowsBetween(-15, -2)), F.collect_list(value).over(w.rowsBetween(2, 15))))
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    lone = (before.isNull() | (before < x / 2)) & (after.isNull() | (after < x / 2))
    near = near.withColumn("__lone", lone).withColumn("__l", F.sort_array("__l"))
    n = F.size("__l")
    middle = F.when(n > 0, (F.get("__l", ((n - 1) / 2).cast("int")) + F.get("__l", (n / 2).cast("int"))) / 2)
    jump = (n > 0) & F.col("__lone") & (x > least) & (x > ratio * F.greatest(middle, F.lit(floor)))
    return near.withColumn("is_spike", (x > hard) | F.coalesce(jump, F.lit(False))).drop("__l", "__lone")


def edges(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """rows with is_edge: the first or last of its group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("is_edge", (F.row_number().over(w) == 1) | F.lead(F.lit(1)).over(w).isNull())


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, right_cols: list[str]) -> DataFrame:
    """Each left row with the latest right row at or before it: one union and one window, not a join of all pairs."""
    tagged = left.select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_cols], F.col(left_time).alias("__t"), F.lit(1).alias("__side"))
    others = right.select(*keys, *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns if c not in keys], *right_cols, F.col(right_time).alias("__t"), F.lit(0).alias("__side"))
    both = tagged.unionByName(others)
    w = Window.partitionBy(*keys).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("__side") == 0, F.struct(*right_cols)), ignorenulls=True).over(w)
    return both.withColumn("__r", last).where("__side = 1").select(*left.columns, *[F.col(f"__r.{c}").alias(c) for c in right_cols])


def sample_agreement(rows: DataFrame, keys: list[str], order: list[str], value: str, samples: int, similar) -> DataFrame:
    """(keys, least_adjacent, ends) over the first samples of each group: the least similarity of neighbours, and that of the last with the first."""
    w = Window.partitionBy(*keys).orderBy(*order)
    seen = rows.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= samples)
    seen = seen.withColumn("__before", F.lag(value).over(w)).withColumn("__first", F.first(value).over(w))
    adjacent = F.when(F.col("__before").isNotNull(), similar(F.col(value), F.col("__before")))
    return seen.groupBy(*keys).agg(F.min(adjacent).alias("least_adjacent"), F.max_by(similar(F.col(value), F.col("__first")), "__k").alias("ends"))


def lagged_energy(rows: DataFrame, keys: list[str], order: list[str], frame: str, difference, flow=None, weight: float = 0.5, rate: float = 10.0) -> DataFrame:
    """rows with energy: difference(before, here) and, where given, weight * rate * flow(before, here); the first of a group has 0."""
    before = F.lag(frame).over(Window.partitionBy(*keys).orderBy(*order))
    value = difference(before, F.col(frame))
    if flow is not None:
        value = value + weight * rate * flow(before, F.col(frame))
    return rows.withColumn("energy", F.coalesce(F.when(before.isNotNull(), value), F.lit(0.0)))
