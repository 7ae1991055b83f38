"""Calibration of the event machine: windows with labels, a grid of parameters, rates with groups held out.

Each window's samples are read once, for all parameter sets; what is shuffled after that
is one row of a window and set, and then sums. Rates of training windows are those of
all windows less the held group's, so that no group is joined with the others.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .events import Params, Shot

# Levels of the grid, and the set it is compared with.
GRID = {"high": (0.35, 0.45), "decay_ratio": (0.5, 0.7), "min_settle": (0.4, 0.6), "gap_bridge": (0.3, 0.5), "min_prepared": (0.5, 0.8)}
FROZEN = "frozen"
COUNTS = ["tp", "fp", "fn", "tn", "strict_starts", "strict_ends"]


def machine_grid(levels: dict[str, tuple[float, ...]] | None = None) -> dict[str, Params]:
    """Parameter sets by name: every combination of the levels, and the absolute machine as it is."""
    levels = levels or GRID
    sets = {FROZEN: Params(relative=False)}
    for values in itertools.product(*levels.values()):
        chosen = dict(zip(levels, values))
        sets["/".join(f"{k}={v:g}" for k, v in chosen.items())] = Params(**chosen)
    return sets


def found_events(samples: DataFrame, sets: dict[str, Params]) -> DataFrame:
    """(window_id, config, events) of samples (window_id, t, smoothed, t0, t1): clips (start, end) that each set finds."""
    clip = pa.struct([("clip_start", pa.float64()), ("clip_end", pa.float64())])

    def one(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("t")
        t, x = rows.column("t").to_numpy(), rows.column("smoothed").to_numpy()
        t0, t1 = rows.column("t0")[0].as_py(), rows.column("t1")[0].as_py()
        events = [[{"clip_start": r[1], "clip_end": r[5]} for r in Shot(t, x, t0, t1, p).results() if r[0] == "event"] for p in sets.values()]
        return pa.table({"window_id": [key[0].as_py()] * len(sets), "config": list(sets), "events": pa.array(events, pa.list_(clip))})

    kept = samples.select(F.col("window_id").cast("string").alias("window_id"), *[F.col(c).cast("double").alias(c) for c in ("t", "smoothed", "t0", "t1")])
    return kept.groupBy("window_id").applyInArrow(one, "window_id string, config string, events array<struct<clip_start: double, clip_end: double>>")


def outcome(events: Column, complete: Column, t0: Column, t1: Column, latest: Column, earliest: Column) -> Column:
    """A window's outcome: TP, FN-start, FN-none, FP or TN, and whether its event keeps to the strict bounds.

    A complete window needs an event that begins in its first half and ends in its last; the first such event is judged.
    Strict: it begins by `latest` and ends no sooner than `earliest`, where those are known.
    """
    half = (t1 - t0) * 0.5
    hits = F.filter(events, lambda e: (e["clip_start"] <= t0 + half) & (e["clip_end"] >= t1 - half))
    hit = F.get(hits, F.lit(0))
    any_ = F.size(events) > 0
    kind = F.when(complete, F.when(F.size(hits) > 0, "TP").when(any_, "FN-start").otherwise("FN-none")).otherwise(F.when(any_, "FP").otherwise("TN"))
    # A bound of 0 counts as unknown.
    strict = lambda ok, bound: F.when(kind == "TP", F.coalesce(ok, F.lit(True)) | (F.coalesce(bound, F.lit(0.0)) == 0)).otherwise(kind.isin("FP", "TN"))
    return F.struct(kind.alias("outcome"), strict(hit["clip_start"] <= latest, latest).alias("strict_start"), strict(hit["clip_end"] >= earliest, earliest).alias("strict_end"))


def judged(windows: DataFrame, samples: DataFrame, sets: dict[str, Params]) -> DataFrame:
    """(window_id, held, config, outcome, strict_start, strict_end) of windows (window_id, held, complete, t0, t1, latest, earliest); one without samples has no event."""
    c = F.col
    configs = F.explode(F.array(*[F.lit(k) for k in sets]))
    each = windows.select(c("window_id").cast("string").alias("window_id"), "held", "complete", "t0", "t1", "latest", "earliest", configs.alias("config"))
    both = each.join(found_events(samples, sets), ["window_id", "config"], "left")
    events = F.coalesce("events", F.array().cast("array<struct<clip_start: double, clip_end: double>>"))
    return both.withColumn("o", outcome(events, c("complete"), c("t0"), c("t1"), c("latest"), c("earliest"))).select("window_id", "held", "config", "o.*")


def counts(rows: DataFrame, by: Iterable[str]) -> DataFrame:
    is_ = lambda k: F.col("outcome") == k
    return rows.groupBy(*by).agg(
        F.count_if(is_("TP")).alias("tp"), F.count_if(is_("FP")).alias("fp"), F.count_if(F.col("outcome").startswith("FN")).alias("fn"), F.count_if(is_("TN")).alias("tn"),
        F.count_if(is_("TP") & F.col("strict_start")).alias("strict_starts"), F.count_if(is_("TP") & F.col("strict_end")).alias("strict_ends"),
    )


def with_rates(sums: DataFrame) -> DataFrame:
    """sums of outcomes with precision, recall, f1, strict_start, strict_end and false_rate, to 3 places; 0 where undefined."""
    c = lambda x: F.col(x).cast("double")
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    p, r = share(c("tp"), c("tp") + c("fp")), share(c("tp"), c("tp") + c("fn"))
    rates = {"precision": p, "recall": r, "f1": share(2 * p * r, p + r), "strict_start": share(c("strict_starts"), c("tp")), "strict_end": share(c("strict_ends"), c("tp")), "false_rate": share(c("fp"), c("fp") + c("tn"))}
    return sums.withColumns({k: F.round(v, 3) for k, v in rates.items()})


def held_out(rows: DataFrame) -> DataFrame:
    """(config, held, side, counts, rates): side `held` is the group's own windows, `train` all others."""
    own = counts(rows, ["config", "held"])
    w = Window.partitionBy("config")
    train = own.select("config", "held", F.lit("train").alias("side"), *[(F.sum(k).over(w) - F.col(k)).alias(k) for k in COUNTS])
    return with_rates(own.select("config", "held", F.lit("held").alias("side"), *COUNTS).unionByName(train))


def chosen(sides: DataFrame) -> DataFrame:
    """(held, config, train_f1, counts, rates of the held group): for each group the set that its training windows rate best (f1, precision, then name)."""
    order = F.struct("f1", "precision")
    train = sides.where("side = 'train'")
    best = train.groupBy("held").agg(F.max(order).alias("__best")).join(train, "held").where(order == F.col("__best"))
    named = best.groupBy("held").agg(F.min("config").alias("config"), F.max("f1").alias("train_f1"))
    return named.join(sides.where("side = 'held'").drop("side"), ["held", "config"])


def pooled(choices: DataFrame) -> DataFrame:
    """One row: rates over all held-out windows, each judged by the set chosen without its group."""
    return with_rates(choices.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in COUNTS]))
