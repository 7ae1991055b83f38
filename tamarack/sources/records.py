"""Readers of record files: JSON arrays and lines, CSV traces, embeddings, latest runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHOT = "shot_id string, start double, end double, duration double, view_class string, confidence double, accepted_for_pitch_detection boolean, reject_reason string, classifier string, scores map<string,double>, transition_contaminated boolean, homogeneous_closeup boolean"
EVENT = "event_id string, source_shot_id string, clip_start double, motion_onset double, motion_peak double, settle_time double, clip_end double, confidence double, complete boolean, reject_reason string"
CLIP = "clip_id string, path string, clip_start double, clip_end double, duration double"
CANDIDATE = "id string, title string, channel string, uploader string, webpage_url string, duration double, upload_date string, description string, _query_source string"
WINDOW = "window_id string, video_file string, t0_file double, t1_file double, pitcher string, broadcast_source string, view string, complete_pitch boolean, acceptable_clip_start array<double>, acceptable_clip_end array<double>, failure_reason string, notes string"


def json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of files that hold one JSON array or object each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_lines(spark: SparkSession, path: str, schema: str, name_col: str | None = None) -> DataFrame:
    """Records of JSON lines, blank ones skipped; name_col: a column that is the file's stem where the record has none."""
    rows = spark.read.schema(schema).json(path)
    if name_col is None:
        return rows
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1)
    return rows.withColumn(name_col, F.coalesce(name_col, stem) if name_col in rows.columns else stem)


def traces(spark: SparkSession, path: str, schema: str = "shot_id string, t double, motion double, smoothed double") -> DataFrame:
    """Signal traces in CSV with a header; filters on them are pushed to the reader."""
    return spark.read.schema(schema).option("header", True).csv(path)


def embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("shot_id string, embedding array<float>").parquet(path)


def latest_run(table: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Rows of the last run; with the column as a partition only that run's files are read."""
    last = table.agg(F.max(run_col).alias("r")).first().r
    return table.where(F.col(run_col) == last) if last is not None else table.limit(0)
