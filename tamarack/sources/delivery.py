"""Delivery: items of batches, single batches, manifests of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import batches
from .batches import BatchExists  # noqa: F401


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def replace_folder(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Store df beside its place, then rename it there; what was there is kept beside it until then, and put back if a crash came between."""
    spark = df.sparkSession
    staged, aside = f"{path}.staged", f"{path}.before"
    fs, target = _fs(spark, path)
    old = _fs(spark, aside)[1]
    if fs.exists(old) and not fs.exists(target):
        fs.rename(old, target)
    df.write.mode("overwrite").format(kind).save(staged)
    if fs.exists(target):
        fs.delete(old, True)
        fs.rename(target, old)
    if not fs.rename(_fs(spark, staged)[1], target):
        fs.rename(old, target)
        raise OSError(f"cannot move {staged} to {path}")
    fs.delete(old, True)


class HiddenCut(Exception):
    """A clip to be delivered has a hard cut in it."""


def delivery_items(clips: DataFrame, events: DataFrame, shots: DataFrame, keys: list[str], cuts: DataFrame | None = None) -> DataFrame:
    """Items of a batch: kept clips with their event and its shot, their bounds among the other events of the shot, and anchors from the clip's start.

    clips (keys, clip_id, clip_start), events (keys, event_id, source_shot_id, clip_start, motion_onset, motion_peak, settle_time, clip_end),
    shots (keys, shot_id, start, end), cuts (keys, clip_id): hard cuts found in the clips, which are refused.
    """
    from ..operators.report import clip_bounds

    if cuts is not None and (bad := clips.join(cuts, [*keys, "clip_id"], "left_semi").select("clip_id").limit(5).collect()):
        raise HiddenCut(", ".join(str(r.clip_id) for r in bad))
    c = F.col
    of_shot = shots.select(*keys, c("shot_id").alias("source_shot_id"), c("start").alias("shot_start"), c("end").alias("shot_end"))
    placed = events.join(of_shot, [*keys, "source_shot_id"]).withColumnsRenamed({"motion_onset": "onset", "settle_time": "settle"})
    bounded = clip_bounds(placed, [*keys, "source_shot_id"]).withColumnRenamed("event_id", "clip_id").drop("clip_start")
    items = clips.join(bounded.drop("shot_start", "shot_end", "clip_end"), [*keys, "clip_id"])
    rel = lambda name: F.round(c(name) - c("start"), 3)
    return items.select(*keys, "clip_id", "source_shot_id", "clip_start", "start", "end", rel("onset").alias("onset_at"), rel("motion_peak").alias("peak_at"), rel("settle").alias("settle_at"))


def parse_exclusions(given: list[str], default: str = "excluded by review") -> dict[str, str]:
    """k=reason pairs; a bare k has the default reason."""
    return {k.strip(): v.strip() or default for k, _, v in (x.partition("=") for x in given)}


def deliver(items: DataFrame, root: str, batch_id: str, exclude: dict[str, str] | None = None, least: int = 1, id_col: str = "item_id", order: list[str] | None = None) -> str:
    """Store items as the batch root/batch_id and append it to root/index; gives the batch's path. See `batches` for what holds when something fails."""
    spark = items.sparkSession
    left_out = None
    if exclude:
        rows = spark.createDataFrame([(batch_id, k, v) for k, v in exclude.items()], "batch_id string, id string, reason string")
        left_out = rows.select("batch_id", F.col("id").cast(items.schema[id_col].dataType).alias(id_col), "reason")
    batches.deliver_run(items.withColumn("batch_id", F.lit(batch_id)), root, "batch_id", id_col, order, left_out, least)
    return f"{root}/{batch_id}"


def write_run(df: DataFrame, path: str, *partitions: str) -> None:
    """Rows of a run below its partitions, so that the last run is found without reading the others."""
    df.write.mode("append").partitionBy(*partitions).parquet(path)


def preflight(which, needed: tuple[str, ...] = ("ffmpeg", "ffprobe", "yt-dlp")) -> list[str]:
    """What is missing of the outside tools, by a lookup such as shutil.which."""
    return [f"{tool} not found" for tool in needed if not which(tool)]


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))
