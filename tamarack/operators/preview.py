"""Preview statistics, segment accounting and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gate import first_of


def sample_times(start: Column, end: Column, fractions: tuple[float, ...] = (0.2, 0.5, 0.8)) -> Column:
    return F.transform(F.array(*[F.lit(f) for f in fractions]), lambda f: start + (end - start) * f)


def frame_grid(rows: DataFrame, index: str, source_fps: str, sample_fps: float) -> DataFrame:
    """Of frames (index, source_fps) those on the sampling grid."""
    step = F.greatest(F.lit(1), F.round(F.col(source_fps) / sample_fps).cast("int"))
    return rows.where(F.col(index) % step == 0)


def preview_stats(shots: DataFrame, keys: list[str], wanted: str = "center_field_good", graphic: str = "graphic_bad") -> DataFrame:
    """(keys, samples, cf_ratio, avg_shot, rapid_cut_rate, graphic_ratio, verdict) of shots (view_class, duration)."""
    share = lambda c: F.round(F.avg(c.cast("double")), 3)
    s = shots.groupBy(*keys).agg(F.count(F.lit(1)).alias("samples"), share(F.col("view_class") == wanted).alias("cf_ratio"), F.round(F.avg("duration"), 2).alias("avg_shot"), share(F.col("duration") < 2).alias("rapid_cut_rate"), share(F.col("view_class") == graphic).alias("graphic_ratio"))
    verdict = first_of([((F.col("cf_ratio") >= 0.5) & (F.col("avg_shot") >= 4.0) & (F.col("rapid_cut_rate") <= 0.4), "suitable"), ((F.col("cf_ratio") >= 0.3) & (F.col("rapid_cut_rate") <= 0.6), "marginal")], "unsuitable")
    return s.withColumn("verdict", verdict)


def segment_funnel(shots: DataFrame, events: DataFrame, rejects: DataFrame) -> DataFrame:
    """Counts a source over its segments, from interior shots only; a segment without candidates counts all its shots.

    shots: source, segment, shot_id, ord, accepted; events: source, segment, shot_id; rejects: source, segment, shot_id, reject_reason.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("source", "segment")
    flagged = shots.withColumn("edge", (F.row_number().over(w.orderBy("ord", "shot_id")) == 1) | F.lead(F.lit(1)).over(w.orderBy("ord", "shot_id")).isNull()).withColumn("any", F.max(F.col("accepted").cast("int")).over(w))
    counted = flagged.groupBy("source").agg(
        F.count_if((F.col("any") == 0) | ~F.col("edge")).alias("shots"), F.count_if((F.col("any") == 1) & F.col("accepted") & ~F.col("edge")).alias("candidates"),
        F.count_if((F.col("any") == 1) & F.col("edge")).alias("edge_skipped"), F.countDistinct(F.when(F.col("any") == 0, F.col("segment"))).alias("segments_skipped_empty"),
    )
    keys = ["source", "segment", "shot_id"]
    inner = flagged.where((F.col("any") == 1) & ~F.col("edge"))
    complete = events.join(inner.where("accepted").select(keys), keys, "left_semi").groupBy("source").agg(F.count(F.lit(1)).alias("complete"))
    edge = flagged.where(F.col("edge") | (F.col("any") == 0)).select(keys)
    reasons = rejects.join(edge, keys, "left_anti").groupBy("source", "reject_reason").agg(F.count(F.lit(1)).alias("n"))
    by = reasons.groupBy("source").agg(F.sum("n").alias("rejected"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("reject_reason", "n")))).alias("by_reason"))
    return counted.join(complete, "source", "left").join(by, "source", "left").na.fill(0, ["complete", "rejected"])


def by_decision(reports: DataFrame, decision: str = "preview_decision", id_col: str = "video_id", ord_col: str = "ord") -> DataFrame:
    """(decision, ids in order): the reports of a run, which are few."""
    return reports.groupBy(decision).agg(F.transform(F.sort_array(F.collect_list(F.struct(ord_col, id_col))), lambda x: x[id_col]).alias("ids"))


def run_status(sources: DataFrame) -> DataFrame:
    """One row: final_clip_count, sources_ok, status of a run's source manifests (status, final_clip_count)."""
    s = sources.agg(F.coalesce(F.sum("final_clip_count"), F.lit(0)).alias("final_clip_count"), F.count_if(F.col("status") == "ok").alias("sources_ok"), F.count(F.lit(1)).alias("sources"))
    return s.withColumn("status", first_of([(F.col("sources_ok") > 0, "ok"), (F.col("sources") == 0, "no-source")], "no-usable-source"))
