"""Whole runs: candidates over preview, pool, production with fallback, finals, manifest and delivery, for many runs at once.

A run is one wanted product, such as a person's video; runs are rows, and each stage is
one job over all of them. Sources of a run's pool are tried in order: the n-th wave
produces, in one job, the n-th source of every run that no earlier wave has satisfied.
Each wave is stored before its outcome is read, as producing has side effects; a run that
is started again goes on after the waves that are there.

What reaches outside is passed in (`Tools`): `preview` and `produce` map DataFrames to
DataFrames with a row for each source, failures included, and `merge` joins files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..sources import batches
from ..sources.delivery import _fs, replace_folder
from ..sources.shared import stored
from . import acquire, gate, resume, run
from .discover import exclusion_reason, or_all, year_ok

CLIPS = "array<struct<clip_id: string, frame_hashes: array<bigint>, clip_start: double, clip_end: double, duration: double, path: string>>"
PRODUCED = f"run_id string, video_id string, downloaded boolean, normalised boolean, clips {CLIPS}, error string"
REPORT = "run_id string, video_id string, preview_status string, preview_decision string, evidence_state string, competition_context string, complete_events long, center_field_shots long"
RESULT = "run_id string, video_id string, attempt int, source_selection_mode string, status string, raw_clips long, final_clip_count long, final_duration_sec double, file string, error string"
KEPT = "run_id string, video_id string, clip_id string, number string, status string, clip_start double, clip_end double, duration double, path string"


@dataclass(frozen=True)
class Tools:
    preview: Callable[[DataFrame], DataFrame]  #: eligible candidates -> REPORT
    produce: Callable[[DataFrame], DataFrame]  #: (run_id, video_id, url, attempt) -> PRODUCED
    merge: Callable[[list[str]], dict]  #: paths of clips in order -> file, duration


def eligible(candidates: DataFrame, top: int, year: Column | None = None, outside: str = "non_mlb") -> DataFrame:
    """Of each run (run_id, video_id, final_score, ord, ...) the first `top` candidates that are not excluded, with their rank.

    Ranks are taken over OVERFETCH times as many; given ones (column `given`) all stay, in their order. year: the one
    wanted, which leaves a run's candidates alone where it fits none.
    """
    by = Window.partitionBy("run_id")
    order = [F.when(F.col("given"), F.lit(0.0)).otherwise(-F.col("final_score")), "ord", "video_id"]
    ranked = candidates.withColumn("rank", F.row_number().over(by.orderBy(*order))).where(F.col("given") | (F.col("rank") <= run.OVERFETCH * top))
    if year is not None:
        fits = ranked.withColumn("__fits", year_ok(F.col("game_year"), F.col("game_year_confidence"), F.col("published_date"), year))
        ranked = or_all(fits, "__fits", "run_id").drop("__fits")
    left = ranked.where(exclusion_reason(F.col("competition_context"), F.col("source_type"), outside).isNull())
    again = left.withColumn("rank", F.row_number().over(by.orderBy("rank")))
    return again.where(F.col("given") | (F.col("rank") <= top))


def pool(sources: DataFrame, reports: DataFrame, outside: str = "non_mlb") -> DataFrame:
    """(run_id, video_id, url, attempt, source_selection_mode): sources by tier, events or shots, and score, numbered in the order they are tried."""
    c = F.col
    said = sources.select("run_id", "video_id", "url", "final_score", "rank").join(reports, ["run_id", "video_id"])
    # A report may know the context only after its preview.
    late = F.coalesce(c("competition_context") == outside, F.lit(False))
    decision = F.when(late, "reject").otherwise(c("preview_decision"))
    tier = gate.tier(decision, c("evidence_state"), c("center_field_shots"), c("competition_context"), c("preview_status"), outside)
    count = {k: F.coalesce(c(k), F.lit(0)) for k in ("complete_events", "center_field_shots")}
    tiered = said.withColumns(count).withColumn("tier", tier).where("tier IS NOT NULL")
    at = F.row_number().over(Window.partitionBy("run_id").orderBy(*gate.tier_order("tier", "complete_events", "center_field_shots", "final_score", "rank")))
    mode = F.get(F.array(*[F.lit(m) for m in gate.MODES]), c("tier") - 1)
    return tiered.select("run_id", "video_id", "url", at.cast("int").alias("attempt"), mode.alias("source_selection_mode"))


def outcomes(tried: DataFrame, produced: DataFrame, merge: Callable[[list[str]], dict], decide: Callable[[DataFrame], DataFrame], least: int) -> tuple[DataFrame, DataFrame]:
    """(RESULT, KEPT) of one wave: near duplicates go, what is left of each source is joined where it is enough."""
    c, key = F.col, F.to_json(F.struct("run_id", "video_id"))
    clips = produced.select(key.alias("source"), F.explode("clips").alias("x")).select("source", "x.*")
    finals = resume.finals_of(clips, decide).where("status != 'removed'")
    names = produced.select("run_id", "video_id", key.alias("source"))
    held = stored(finals.join(names, "source"), "finals")
    counts = held.groupBy("source").agg(F.count(F.lit(1)).alias("final_clip_count"))
    enough = held.join(counts.where(c("final_clip_count") >= least), "source", "left_semi")
    joined = acquire.merged(enough, ["source"], merge).select("source", c("ok").alias("merged"), c("file"), c("duration").alias("final_duration_sec"), c("error").alias("merge_error"))
    each = tried.join(produced, ["run_id", "video_id"], "left").withColumn("source", key).join(counts, "source", "left").join(joined, "source", "left")
    kept = F.coalesce("final_clip_count", F.lit(0))
    status = run.source_status(c("downloaded"), c("normalised"), kept, F.lit(least), c("merged"))
    results = each.select(
        "run_id", "video_id", "attempt", "source_selection_mode", status.alias("status"), F.coalesce(F.size("clips"), F.lit(0)).cast("long").alias("raw_clips"), kept.alias("final_clip_count"),
        F.coalesce("final_duration_sec", F.lit(0.0)).alias("final_duration_sec"), F.when(status == "ok", c("file")).alias("file"), F.coalesce("error", "merge_error").alias("error"),
    )
    return results, held.select(*[x.split()[0] for x in KEPT.split(", ")])


def produce(spark: SparkSession, candidates: DataFrame, tools: Tools, root: str, top: int = 3, most: int = 3, year: Column | None = None, least: int = run.LEAST_CLIPS, decide: Callable[[DataFrame], DataFrame] = resume.resolve, outside: str = "non_mlb") -> DataFrame:
    """Run all runs of candidates (run_id, video_id, url, final_score, ord, given, competition_context, source_type, and with a year game_year, game_year_confidence, published_date).

    Below root: reports, results/wave=n, finals/wave=n and, as the last, run_manifest, which is returned: a row of each
    run with its status, mode, counts, candidates, excluded sources and the file that came out. most: sources previewed of a run.
    """
    c, place = F.col, lambda name: f"{root}/{name}"
    there = lambda path: _fs(spark, path)[0].exists(_fs(spark, f"{path}/_SUCCESS")[1])
    chosen = stored(eligible(candidates, top, year, outside).where(c("given") | (c("rank") <= most)), "eligible")
    if not there(place("reports")):
        tools.preview(chosen).select(*[x.split()[0] for x in REPORT.split(", ")]).write.mode("overwrite").parquet(place("reports"))
    order = stored(pool(chosen, spark.read.schema(REPORT).parquet(place("reports")), outside), "pool")
    waves, done = [], spark.createDataFrame([], "run_id string")
    while not (tried := order.where(c("attempt") == len(waves) + 1).join(done, "run_id", "left_anti")).isEmpty():
        n = len(waves) + 1
        made, left, kept = (place(f"{k}/wave={n}") for k in ("produced", "results", "finals"))
        if not there(made):
            tools.produce(tried).select(*[x.split()[0].strip() for x in ("run_id", "video_id", "downloaded", "normalised", "clips", "error")]).write.mode("overwrite").parquet(made)
        if not there(left):
            results, finals = outcomes(tried, spark.read.schema(PRODUCED).parquet(made), tools.merge, decide, least)
            finals.write.mode("overwrite").parquet(kept)
            results.write.mode("overwrite").parquet(left)
        waves.append(n)
        done = spark.read.schema(RESULT).parquet(*[place(f"results/wave={k}") for k in waves]).where("status = 'ok'").select("run_id")
    results = spark.read.schema(RESULT).parquet(*[place(f"results/wave={k}") for k in waves]) if waves else spark.createDataFrame([], RESULT)
    sums = run.run_summary(results, ["run_id"]).select("run_id", "run_status", "attempted", c("mode").alias("source_selection_mode"), "final_clips", "final_seconds")
    ended = results.where("status = 'ok'").groupBy("run_id").agg(F.min("video_id").alias("video_id"), F.min("file").alias("file"))
    out = run.excluded(candidates, outside).join(candidates.select("run_id", "video_id"), "video_id").groupBy("run_id").agg(F.count_distinct("video_id").alias("excluded"))
    pools = order.groupBy("run_id").agg(F.count(F.lit(1)).alias("selected"))
    previews = chosen.groupBy("run_id").agg(F.count(F.lit(1)).alias("previewed"))
    every = candidates.groupBy("run_id").agg(F.count(F.lit(1)).alias("candidates"))
    for part in (out, previews, pools, sums, ended):
        every = every.join(part, "run_id", "left")
    why = gate.first_of([(c("previewed").isNull(), "no eligible source among the candidates"), (c("selected").isNull(), "preview gate admitted no source")], F.lit(None).cast("string"))
    whole = every.withColumn("status", F.coalesce("run_status", F.lit("no_suitable_source"))).withColumn("reason", why).drop("run_status").na.fill(0, ["excluded", "previewed", "selected", "attempted", "final_clips"]).na.fill(0.0, ["final_seconds"])
    replace_folder(whole, place("run_manifest"))
    return spark.read.schema(whole.schema).parquet(place("run_manifest"))


def deliver(spark: SparkSession, root: str, to: str, exclude: DataFrame | None = None) -> None:
    """Deliver the finals of every run that is ok: a batch each, named by run and source, all of them in one job or none."""
    manifest = spark.read.parquet(f"{root}/run_manifest").where("status = 'ok'").select("run_id", "video_id")
    finals = spark.read.option("basePath", f"{root}/finals").parquet(f"{root}/finals").drop("wave", "number").join(manifest, ["run_id", "video_id"])
    name = F.concat_ws("-", text.slug(F.col("run_id")), text.slug(F.col("video_id")))
    batches.deliver_run(finals.withColumn("batch_id", name), to, id_col="clip_id", order=["clip_start", "clip_id"], exclude=exclude)
