"""A run: who is eligible, what each source came to, and a manifest at every exit."""

from __future__ import annotations

import contextlib
import datetime
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .discover import exclusion_reason
from .gate import budget_ok, first_of

#: Discovery takes so many times the sources wanted, since exclusions come after it; clips that a source of a last tier must have.
OVERFETCH, LEAST_CLIPS = 2, 3


def run_id(now: Column | None = None) -> Column:
    return F.date_format(F.current_timestamp() if now is None else now, "yyyyMMdd'T'HHmmss'Z'")


def excluded(candidates: DataFrame, outside: str = "non_mlb") -> DataFrame:
    """(video_id, reason) of the candidates that can give no video of one person."""
    return candidates.select("video_id", exclusion_reason(F.col("competition_context"), F.col("source_type"), outside).alias("reason")).where("reason IS NOT NULL")


def eligible(candidates: DataFrame, top: int, order: list[Column], given: bool = False, outside: str = "non_mlb") -> DataFrame:
    """The first `top` candidates that are not excluded, of the first OVERFETCH * top; sources that the operator has given all stay, in their order."""
    ranked = candidates if given else candidates.orderBy(*order).limit(OVERFETCH * top)
    left = ranked.where(exclusion_reason(F.col("competition_context"), F.col("source_type"), outside).isNull())
    return left.orderBy(*order) if given else left.orderBy(*order).limit(top)


def previewed(selected: DataFrame, preview: Callable[[DataFrame], DataFrame], outside: str = "non_mlb") -> DataFrame:
    """Preview reports of all selected sources: those outside the league are rejected without the cost of a preview, which only sees the others."""
    out = F.coalesce(F.col("competition_context") == outside, F.lit(False))
    seen = preview(selected.where(~out))
    skipped = selected.where(out).select("video_id", "competition_context", F.lit("reject").alias("preview_decision"), F.lit("skipped").alias("preview_status"), F.array(F.lit("non-MLB competition context excluded from production")).alias("reasons"))
    # A report may know the context only after its preview.
    late = F.coalesce(F.col("competition_context") == outside, F.lit(False))
    return seen.withColumn("preview_decision", F.when(late, "reject").otherwise(F.col("preview_decision"))).unionByName(skipped, allowMissingColumns=True)


def check_inputs(shots: DataFrame, candidates: DataFrame) -> DataFrame:
    """candidates, or an error where one is not an accepted shot or there is none at all."""
    known = shots.where("accepted_for_pitch_detection").select("shot_id", F.lit(True).alias("__ok"))
    joined = candidates.join(known, "shot_id", "left").withColumn("__ok", F.when(F.col("__ok").isNull(), F.raise_error(F.concat(F.lit("no accepted shot: "), "shot_id"))).otherwise(F.col("__ok")))
    if candidates.isEmpty():
        raise ValueError("no candidates")
    return joined.where("__ok").select(*candidates.columns)


def veto_split(events: DataFrame, veto: Column, detail: Column, reason: str = "no_delivery_suspected") -> tuple[DataFrame, DataFrame]:
    """The events that stay, and (event_id, source_shot_id, reject_reason, detail) of those that the veto moves to the rejected."""
    gone = F.coalesce(veto, F.lit(False))
    moved = events.where(gone).select("event_id", "source_shot_id", F.lit(reason).alias("reject_reason"), F.concat_ws(": ", F.col("event_id").cast("string"), detail).alias("detail"))
    return events.where(~gone), moved


def source_status(download: Column, normalised: Column, kept: Column, least: Column, merged: Column) -> Column:
    """What a source came to: failed-download, failed-normalize, no-usable-clips, low-yield, failed-merge or ok."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return first_of([(no(download), "failed-download"), (no(normalised), "failed-normalize"), (kept == 0, "no-usable-clips"), (kept < least, "low-yield"), (no(merged), "failed-merge")], "ok")


def run_summary(results: DataFrame, keys: list[str]) -> DataFrame:
    """One row a run of results (keys, attempt, video_id, status, source_selection_mode, final_clip_count, final_duration_sec): status, mode, counts and sums.

    Only attempts up to the first that is ok took place; a run whose downloads all failed is an acquisition failure.
    """
    ok, c = F.col("status") == "ok", F.col
    first = Window.partitionBy(*keys).orderBy("attempt")
    done = results.withColumn("__before", F.coalesce(F.max(ok.cast("int")).over(first.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))).where("__before = 0")
    summed = done.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if(ok).alias("ok"), F.count_if(c("status").startswith("failed-download")).alias("download_failed"),
        F.coalesce(F.max(F.when(ok, c("source_selection_mode"))), F.min_by("source_selection_mode", "attempt")).alias("mode"),
        F.coalesce(F.sum(F.when(ok, c("final_clip_count"))), F.lit(0)).alias("final_clips"), F.coalesce(F.sum(F.when(ok, c("final_duration_sec"))), F.lit(0.0)).alias("final_seconds"),
    )
    status = first_of([(c("ok") > 0, "ok"), (c("download_failed") == c("attempted"), "acquisition_failed")], "no_suitable_source")
    return summed.withColumn("run_status", status)


@contextlib.contextmanager
def manifest(spark: SparkSession, path: str, **known) -> Iterator[dict]:
    """A dict that is stored as the run's manifest however the block ends: as it says, or with status run_error and why.

    The row goes beside its place and is renamed, so that no reader meets half of it.
    """
    from ..sources.delivery import replace_folder

    held = {"created_utc": datetime.datetime.now(datetime.timezone.utc).isoformat(), **known}
    try:
        yield held
    except Exception as e:
        held |= {"status": "run_error", "reason": f"{type(e).__name__}: {str(e)[:300]}"}
        raise
    finally:
        held.setdefault("status", "no_suitable_source")
        row = spark.createDataFrame([tuple(str(v) for v in held.values())], ", ".join(f"`{k}` string" for k in held))
        replace_folder(row.coalesce(1), path, "json")


def adaptive(first: DataFrame, expand: Callable[[DataFrame, int], DataFrame], state: Callable[[DataFrame], DataFrame], path: Callable[[int], str], rounds: tuple[int, ...] = (2, 3)) -> DataFrame:
    """Evidence over rounds: sources whose evidence is insufficient, acquired without failures and within budget, are looked at again.

    first: partial counts of round 1 (video_id, segments, seconds, duration, preview_status, ...); expand(sources, round) gives
    those of further segments; state(partials) gives (video_id, evidence_state). Every round is stored at path(round) before its
    counts are used, as looking has side effects, and a source that a round gives nothing for keeps the evidence it has.
    """
    spark = first.sparkSession
    first.write.mode("overwrite").parquet(path(1))
    held = spark.read.parquet(path(1))
    for number in rounds:
        totals = held.groupBy("video_id").agg(F.sum("segments").alias("segments"), F.sum("seconds").alias("seconds"), F.max("duration").alias("duration"), F.bool_and(F.col("preview_status") == "ok").alias("whole"), F.max("round").alias("last"))
        open_ = totals.join(state(held), "video_id").where((F.col("evidence_state") == "insufficient") & F.col("whole") & (F.col("last") == number - 1) & budget_ok(F.col("segments"), F.col("seconds"), F.col("duration")))
        if number > 2:
            open_ = open_.where(F.coalesce(F.col("duration") <= 900, F.lit(False)))
        expand(open_.select("video_id", "duration", "segments", "seconds"), number).withColumn("round", F.lit(number)).write.mode("overwrite").parquet(path(number))
        held = held.unionByName(spark.read.parquet(path(number)), allowMissingColumns=True)
    return held
