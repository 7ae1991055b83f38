"""The stage that locates events as tables below a folder, and what files need before it: facts of a probe and the choice to re-encode.

Tables are written by source, so that one source's are found without reading the
others, and a stage that is run again replaces only those of the sources it is given.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.delivery import replace_folder
from ..sources.shared import stored
from .acquire import frame_rate
from .events import Params, localize
from .run import check_inputs

PROBE = "streams array<struct<codec_type: string, codec_name: string, pix_fmt: string, width: int, height: int, avg_frame_rate: string, r_frame_rate: string, duration: string>>, format struct<duration: string>"
# Codecs and pixel format that are kept as they are, and the greatest width.
KEPT_CODECS, KEPT_PIXELS, WIDEST = ("h264", "avc"), "yuv420p", 1280
REUSED, RECODED = "reuse-original", "transcode-h264"


def probe_facts(text: Column) -> Column:
    """struct(width, height, fps, duration, codec, pix_fmt) of a probe's JSON, of its first video stream; null where it has none."""
    p = F.from_json(text, PROBE)
    v = F.get(F.filter(p["streams"], lambda s: s["codec_type"] == "video"), F.lit(0))
    number = lambda c: c.try_cast("double")
    rate = F.coalesce(v["avg_frame_rate"], v["r_frame_rate"], F.lit("30/1"))
    fps = F.when(F.contains(rate, F.lit("/")), frame_rate(rate)).otherwise(F.coalesce(number(rate), F.lit(0.0)))
    facts = F.struct(
        F.coalesce(v["width"], F.lit(0)).alias("width"), F.coalesce(v["height"], F.lit(0)).alias("height"), fps.alias("fps"),
        F.coalesce(number(p["format"]["duration"]), number(v["duration"]), F.lit(0.0)).alias("duration"), F.coalesce(v["codec_name"], F.lit("")).alias("codec"), F.trim(F.coalesce(v["pix_fmt"], F.lit(""))).alias("pix_fmt"),
    )
    return F.when(v.isNotNull(), facts)


def normalising(facts: Column) -> Column:
    """struct(method, width): a file is used as it is, or encoded anew, no wider than it is and than WIDEST; null without facts."""
    same = facts["codec"].isin(*KEPT_CODECS) & (facts["pix_fmt"] == KEPT_PIXELS)
    return F.when(facts.isNotNull(), F.struct(F.when(same, REUSED).otherwise(RECODED).alias("method"), F.when(same, facts["width"]).otherwise(F.least(facts["width"], F.lit(WIDEST))).alias("width")))


def partials(names: list[str], target: str) -> list[str]:
    """Of the names in a folder those that a failed download of `target` leaves: whatever begins with its stem and a dot."""
    stem = os.path.splitext(os.path.basename(target))[0] + "."
    return [n for n in names if n.startswith(stem)]


def clear_partials(target: str) -> list[str]:
    """Remove what a failed download of `target` has left beside it; gives the names. One that can't be removed stays."""
    folder, gone = os.path.dirname(target) or ".", []
    for name in partials(sorted(os.listdir(folder)), target) if os.path.isdir(folder) else ():
        path = os.path.join(folder, name)
        if os.path.isfile(path):
            try:
                os.unlink(path)
            except OSError:
                continue
            gone.append(name)
    return gone


def event_windows(events: DataFrame, samples: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, event_id, t, motion, smoothed, in_clip): each event with all samples of its shot, and whether they lie in its clip, ends included.

    A shot has few events, so that this is a join on its key with the samples on the one side.
    """
    bounds = events.select(*keys, "event_id", "clip_start", "clip_end")
    inside = F.col("t").between(F.col("clip_start"), F.col("clip_end"))
    return samples.select(*keys, "t", "motion", "smoothed").join(bounds, keys).select(*keys, "event_id", "t", "motion", "smoothed", inside.alias("in_clip"))


def locate_stage(spark: SparkSession, shots: DataFrame, candidates: DataFrame, samples: DataFrame, root: str, params: Params | None = None, continuity: Callable[[DataFrame], DataFrame] | None = None, localizer: Callable[[DataFrame, Params | None], DataFrame] = localize) -> DataFrame:
    """Events, rejections, scores and windows of all candidates (video_id, shot_id, start, end) below root, by source; gives the manifest.

    Candidates must be accepted shots. samples: (video_id, shot_id, t, motion, smoothed). continuity(events) gives
    (video_id, shot_id, onset, continuous, least_corr): events over a change of camera become rejections. Events are numbered by
    time over all shots of a source after that, so that no number comes twice. A shot without samples has no row.
    """
    c, key = F.col, ["video_id", "shot_id"]
    one = F.to_json(F.struct(*key))
    named = lambda df: df.withColumn("name", one)
    checked = check_inputs(named(shots).select(c("name").alias("shot_id"), "accepted_for_pitch_detection"), named(candidates).select(c("name").alias("shot_id"), c("start").alias("shot_start"), c("end").alias("shot_end")))
    ready = named(samples).select(c("name").alias("shot_id"), "t", "smoothed").join(checked, "shot_id")
    ids = candidates.select(*key, one.alias("name"))
    told = stored(localizer(ready, params).withColumnRenamed("shot_id", "name").join(ids, "name").drop("name"), "located")
    found = told.where("kind = 'event'").drop("kind", "reason")
    rejected = told.where("kind = 'rejected'").select(*key, c("reason").alias("reject_reason"), F.lit(None).cast("string").alias("detail"))
    if continuity is not None:
        seen = stored(found.join(continuity(found).select(*key, "onset", "continuous", "least_corr"), [*key, "onset"], "left"), "continuity")
        cut = seen.where("NOT coalesce(continuous, true)")
        rejected = rejected.unionByName(cut.select(*key, F.lit("shot_discontinuity").alias("reject_reason"), F.concat(F.lit("min_corr="), c("least_corr").cast("string")).alias("detail")))
        found = seen.where("coalesce(continuous, true)").drop("continuous", "least_corr")
    n = F.row_number().over(Window.partitionBy("video_id").orderBy("clip_start", "shot_id"))
    events = found.withColumn("event_id", F.format_string("p%03d", n))

    def write(df: DataFrame, name: str) -> DataFrame:
        df.write.partitionBy("video_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}").join(candidates.select("video_id").distinct(), "video_id", "left_semi")

    events, rejected = write(events, "events"), write(rejected, "rejected_events")
    scores = samples.select(*key, F.round("t", 3).alias("t"), F.round("motion", 4).alias("motion"), F.round("smoothed", 4).alias("smoothed")).join(candidates.select(*key), key, "left_semi")
    write(scores, "temporal_scores")
    write(event_windows(events, scores, key), "event_windows")
    reasons = rejected.groupBy("video_id", "reject_reason").agg(F.count(F.lit(1)).alias("n")).groupBy("video_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reject_reason", "n")))).alias("reject_by_reason"))
    count = lambda df, name: df.groupBy("video_id").agg(F.count(F.lit(1)).alias(name))
    whole = count(candidates, "input_candidates").join(count(events, "complete_events"), "video_id", "left").join(count(rejected, "rejected_windows"), "video_id", "left").join(reasons, "video_id", "left")
    replace_folder(whole.na.fill(0, ["complete_events", "rejected_windows"]), f"{root}/manifest_m2")
    return spark.read.schema(whole.schema).parquet(f"{root}/manifest_m2")


def normalised(jobs: DataFrame, probe: Callable[[str], str], recode: Callable[[str, str, int], None], copy: Callable[[str, str], None]) -> DataFrame:
    """jobs (id, src, dest) with ok, method, width, height, fps and error: probed, copied or encoded anew, and probed again.

    probe(path) gives a probe's JSON; recode(src, dest, width) and copy(src, dest) write. A failure is a row.
    """

    def looked(paths: str, out: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                got = []
                for path in rows[paths]:
                    try:
                        got.append((probe(path), None))
                    except Exception as e:  # what went wrong is a column of the result
                        got.append((None, f"probe: {str(e)[:200]}"))
                yield rows.assign(**{out: [g[0] for g in got], "problem": [old or g[1] for old, g in zip(rows["problem"], got)]})

        return run

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            problems = []
            for src, dest, method, width, old in rows[["src", "dest", "method", "to_width", "problem"]].itertuples(index=False):
                try:
                    if method == REUSED and src != dest:
                        copy(src, dest)
                    elif method == RECODED:
                        recode(src, dest, int(width))
                    problems.append(old or (None if method else "no video stream"))
                except Exception as e:
                    problems.append(f"normalize: {str(e)[:200]}")
            yield rows.assign(problem=problems)

    base = "id string, src string, dest string, problem string"
    first = jobs.select("id", "src", "dest", F.lit(None).cast("string").alias("problem")).mapInPandas(looked("src", "before"), f"{base}, before string")
    plan = first.withColumn("__n", normalising(probe_facts(F.col("before")))).select("id", "src", "dest", "problem", F.col("__n.method").alias("method"), F.col("__n.width").alias("to_width"))
    done = stored(plan, "normalising").mapInPandas(made, f"{base}, method string, to_width int")
    after = stored(done, "normalised").mapInPandas(looked("dest", "after"), f"{base}, method string, to_width int, after string")
    facts = probe_facts(F.col("after"))
    ok = F.col("problem").isNull() & facts.isNotNull()
    return stored(after, "normalised").select("id", ok.alias("ok"), F.when(ok, F.col("method")).alias("method"), F.when(ok, facts["width"]).alias("width"), F.when(ok, facts["height"]).alias("height"), F.when(ok, F.round(facts["fps"], 3)).alias("fps"), F.when(~ok, F.coalesce("problem", F.lit("no video stream"))).alias("error"))
