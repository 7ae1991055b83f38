"""Replays of saved runs: pools of shots, changed acceptance, changed scores, reports over runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import report


def pool(shots: DataFrame, segments: DataFrame, path_col: str = "path", file_col: str = "file") -> DataFrame:
    """Shots of preview segments on their video's time: (video_id, segment, file, shot_id, seg_start, seg_end, start, end, ...).

    shots: a path .../sources/<video>/m1m2/<segment>/shots.json; segments: a file .../sources/<video>/segments/<segment>_<offset>s.mp4.
    """
    of = lambda c, p, k=1: F.nullif(F.regexp_extract(F.translate(F.col(c), "\\", "/"), p, k), F.lit(""))
    left = shots.withColumns({"video_id": of(path_col, "sources/([^/]+)/m1m2/seg[0-9]+/shots[.]json"), "segment": of(path_col, "/m1m2/(seg[0-9]+)/shots[.]json")}).where("video_id IS NOT NULL")
    named = "sources/([^/]+)/segments/(seg[0-9]+)_([0-9]+)s[.]mp4$"
    right = segments.select(of(file_col, named).alias("video_id"), of(file_col, named, 2).alias("segment"), of(file_col, named, 3).cast("double").alias("offset"), F.col(file_col).alias("file")).where("video_id IS NOT NULL")
    one = right.groupBy("video_id", "segment").agg(F.min_by(F.struct("file", "offset"), "file").alias("__f"))
    joined = left.join(one, ["video_id", "segment"])
    moved = joined.withColumnsRenamed({"start": "seg_start", "end": "seg_end"}).withColumn("file", F.col("__f.file"))
    return moved.withColumn("start", F.round(F.col("__f.offset") + F.col("seg_start"), 2)).withColumn("end", F.round(F.col("__f.offset") + F.col("seg_end"), 2)).drop("__f", path_col)


def replay(events: DataFrame, shots: DataFrame, keys: list[str], accepted: Column) -> DataFrame:
    """events with replayed: whether their shot is accepted by another rule; a shot that is not there is not accepted."""
    now = shots.select(*keys, F.col("shot_id").alias("source_shot_id"), F.coalesce(accepted, F.lit(False)).alias("replayed"))
    return events.join(now, [*keys, "source_shot_id"], "left").withColumn("replayed", F.coalesce("replayed", F.lit(False)))


def veto_volume(shots: DataFrame, events: DataFrame, keys: list[str], margin: Column, texture: Column, wanted: Column, least_margin: float = 0.4, least_texture: float = 0.10) -> DataFrame:
    """(keys, shots, low, vetoed, vetoed_events): shots of the wanted view, those of low margin, those of them without texture, and events on these."""
    with_event = events.select(*keys, F.col("source_shot_id").alias("shot_id"), F.lit(True).alias("__event")).distinct()
    rows = shots.where(wanted).join(with_event, [*keys, "shot_id"], "left")
    low = F.coalesce(margin < least_margin, F.lit(False))
    veto = low & (F.coalesce(texture, F.lit(1.0)) < least_texture)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("shots"), F.count_if(low).alias("low"), F.count_if(veto).alias("vetoed"), F.count_if(veto & F.coalesce("__event", F.lit(False))).alias("vetoed_events"))


def differences(old: DataFrame, new: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """(id, column, old, new) of every value that differs, and of rows that only one side has; null equals null."""
    tagged = [df.select(F.col(id_col), F.lit(True).alias(f"{t}_here"), *[F.col(c).cast("string").alias(f"{t}_{c}") for c in cols]) for df, t in ((old, "old"), (new, "new"))]
    both = tagged[0].join(tagged[1], id_col, "full")
    each = F.array(F.struct(F.lit("*").alias("column"), F.col("old_here").cast("string").alias("old"), F.col("new_here").cast("string").alias("new")), *[F.struct(F.lit(c).alias("column"), F.col(f"old_{c}").alias("old"), F.col(f"new_{c}").alias("new")) for c in cols])
    alone = F.col("old_here").isNull() | F.col("new_here").isNull()
    changed = F.filter(each, lambda x: ~x["old"].eqNullSafe(x["new"]) & ((x["column"] == "*") | ~alone))
    return both.select(id_col, F.explode(changed).alias("x")).select(id_col, "x.*")


def report_rows(manifests: DataFrame, durations: DataFrame, notes: DataFrame) -> DataFrame:
    """Rows of a report over runs: manifests with the source's duration and the reviewer's notes, their ratios, failure and warning.

    durations (video_id, seconds), notes (video_id, note): both are given from outside, as manifests hold neither.
    """
    c = F.col
    rows = manifests.join(durations, "video_id", "left").join(notes, "video_id", "left")
    rows = rows.withColumns(report.ratios(c("shot_count"), c("center_field_candidates"), c("complete_events"), c("final_clip_count"), c("seconds")))
    failed = report.taxonomy(c("status"), c("competition_context"), c("shot_count"), c("center_field_rate"), c("rejected_start_incomplete"), c("rejected_end_incomplete"), c("rejected_no_complete_pitch"), c("complete_events"), c("final_clip_count"), c("complete_yield"), c("seconds"), c("rejected_discontinuity"))
    return rows.withColumn("failure", F.when(c("status") != "ok", failed)).withColumn("dedup_warning", report.dedup_warning(c("duplicate_rejected"), c("final_clip_count")))


def as_markdown(rows: DataFrame, cols: list[str], order: list[str]) -> DataFrame:
    """(line) of a table in order: a row of text each, so that no table is gathered to be printed."""
    line = lambda values: F.concat(F.lit("| "), F.concat_ws(" | ", *values), F.lit(" |"))
    body = rows.orderBy(*order).select(line([F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]).alias("line"))
    top = rows.sparkSession.createDataFrame([("| " + " | ".join(cols) + " |",), ("|" + "-|" * len(cols),)], "line string")
    return top.unionByName(body)
