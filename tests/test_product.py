"""Whole runs with scripted tools."""

import os

import pytest
from pyspark.sql import functions as F

from tamarack.operators import product, resume
from tamarack.sources import batches

CANDIDATE = "run_id string, video_id string, url string, final_score double, ord int, given boolean, competition_context string, source_type string, game_year int, game_year_confidence string, published_date string"
#: What each source's preview says and what its production gives: decision, state, events, shots; downloaded, normalised, clips, merges.
SCRIPT = {
    "good": ("recommended", "sufficient_good", 4, 9, True, True, 4, True), "better": ("recommended", "sufficient_good", 7, 9, True, True, 5, True), "few": ("recommended", "sufficient_good", 9, 9, True, True, 2, True),
    "border": ("borderline", "insufficient", 1, 5, True, True, 3, True), "lost": ("recommended", "sufficient_good", 8, 8, False, False, 0, True), "odd": ("borderline", "insufficient", 2, 5, True, False, 0, True),
    "thin": ("reject", "insufficient", 0, 3, True, True, 4, True), "bad": ("reject", "sufficient_bad", 0, 9, True, True, 4, True), "zero": ("reject", "insufficient", 0, 0, True, True, 9, True), "torn": ("recommended", "sufficient_good", 9, 9, True, True, 4, False),
}
LOOKS = [0, -1, 0x0F0F0F0F0F0F0F0F, 0x3333333333333333, 0x00FF00FF00FF00FF]


def candidates(spark, runs, score=None, **fields):
    rows = []
    for run_id, names in runs.items():
        for k, name in enumerate(names):
            own = {"competition_context": "mlb", "source_type": "full_outing", "given": False, "game_year": 2024, "game_year_confidence": "high", "published_date": "2024-05-01"} | fields.get(name, {})
            rows.append((run_id, name, f"u/{name}", 1.0 - k / 10, k, own["given"], own["competition_context"], own["source_type"], own["game_year"], own["game_year_confidence"], own["published_date"]))
    return spark.createDataFrame(rows, CANDIDATE)


def tools(spark, calls=None):
    said = spark.createDataFrame([(n, *v) for n, v in SCRIPT.items()], "video_id string, preview_decision string, evidence_state string, complete_events long, center_field_shots long, downloaded boolean, normalised boolean, n int, merges boolean")

    def preview(sources):
        return sources.select("run_id", "video_id", "competition_context").join(said, "video_id").withColumn("preview_status", F.lit("ok"))

    def produce(sources):
        if calls is not None:
            calls.append(sorted((r.run_id, r.video_id) for r in sources.collect()))
        look = F.array(*[F.lit(x) for x in LOOKS])
        one = lambda k: F.struct(
            F.format_string("c%d", k).alias("clip_id"), F.array(look[k - 1]).alias("frame_hashes"), (k * 100.0).alias("clip_start"), (k * 100.0 + 5).alias("clip_end"), F.lit(5.0).alias("duration"),
            F.concat(F.when(F.col("merges"), F.lit("/")).otherwise(F.lit("torn/")), "video_id", F.format_string("/%d", k)).alias("path"),
        )
        clips = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(1), F.least("n", F.lit(5))), one)).otherwise(F.array().cast(product.CLIPS))
        return sources.join(said, "video_id").select("run_id", "video_id", "downloaded", "normalised", clips.alias("clips"), F.when(~F.col("downloaded"), "HTTP 403").alias("error"))

    def merge(paths):
        if paths[0].startswith("torn"):
            raise OSError("bad stream")
        return {"file": "+".join(paths), "duration": 5.0 * len(paths)}

    return product.Tools(preview, produce, merge)


RUNS = {
    "first": ["good", "better", "thin"], "falls": ["lost", "border", "thin"], "again": ["few", "torn", "bad"], "none": ["zero"], "all_lost": ["lost"], "last": ["bad", "thin"], "outside": ["good", "better"], "odd": ["odd"],
}
OUT = {"good": {}, "better": {}}


def test_runs_end_as_their_sources_do(spark, tmp_path):
    calls = []
    rows = candidates(spark, RUNS).withColumn("competition_context", F.when(F.col("run_id") == "outside", "non_mlb").otherwise(F.col("competition_context")))
    got = {r.run_id: r for r in product.produce(spark, rows, tools(spark, calls), f"{tmp_path}/runs").collect()}
    assert {k: (r.status, r.video_id, r.source_selection_mode, r.attempted) for k, r in got.items()} == {
        "first": ("ok", "better", "recommended", 1), "falls": ("ok", "border", "borderline_fallback", 2), "again": ("ok", "bad", "bad_evidence_fallback", 3), "none": ("no_suitable_source", None, None, 0),
        "all_lost": ("acquisition_failed", None, "recommended", 1), "last": ("ok", "thin", "insufficient_evidence_fallback", 1), "outside": ("no_suitable_source", None, None, 0), "odd": ("no_suitable_source", None, "borderline_fallback", 1),
    }
    assert got["first"].final_clips == 5 and got["first"].final_seconds == 25.0 and got["first"].file == "+".join(f"/better/{k}" for k in range(1, 6))
    assert got["none"].reason == "preview gate admitted no source" and got["outside"].reason == "no eligible source among the candidates" and got["outside"].excluded == 2
    # One job a wave; runs that are satisfied are in no later one.
    assert [len(x) for x in calls] == [6, 2, 1] and calls[2] == [("again", "bad")]
    results = {(r.run_id, r.video_id): (r.status, r.error) for r in spark.read.parquet(f"{tmp_path}/runs/results").collect()}
    assert results["again", "few"] == ("low-yield", None) and results["again", "torn"][0] == "failed-merge" and "bad stream" in results["again", "torn"][1]
    assert results["falls", "lost"] == ("failed-download", "HTTP 403") and results["odd", "odd"][0] == "failed-normalize"

    product.deliver(spark, f"{tmp_path}/runs", f"{tmp_path}/to", spark.createDataFrame([("first-better", "c2", "blurred")], "batch_id string, clip_id string, reason string"))
    index = {r.batch_id: (r["items"], r.excluded) for r in batches.index(spark, f"{tmp_path}/to").collect()}
    assert index == {"first-better": (4, {"c2": "blurred"}), "falls-border": (3, {}), "again-bad": (4, {}), "last-thin": (4, {})}
    with pytest.raises(batches.BatchExists):
        product.deliver(spark, f"{tmp_path}/runs", f"{tmp_path}/to")


def test_a_run_goes_on_after_the_waves_that_are_there(spark, tmp_path):
    calls, root = [], f"{tmp_path}/runs"
    rows, works = candidates(spark, {"again": RUNS["again"], "first": RUNS["first"]}), tools(spark, calls)

    def stops(sources):
        if len(calls) == 1:
            raise OSError("driver lost")
        return works.produce(sources)

    with pytest.raises(OSError):
        product.produce(spark, rows, product.Tools(works.preview, stops, works.merge), root)
    assert not os.path.exists(f"{root}/run_manifest")

    def no_preview(sources):
        raise AssertionError("reports are there")

    got = {r.run_id: (r.status, r.attempted) for r in product.produce(spark, rows, product.Tools(no_preview, works.produce, works.merge), root).collect()}
    assert got == {"again": ("ok", 3), "first": ("ok", 1)} and [len(x) for x in calls] == [2, 1, 1]


def test_eligible_candidates(spark):
    rows = candidates(spark, {"r": list("abcdefgh"), "own": ["x", "y"], "all": ["p", "q"]}, a={"source_type": "full_game"}, c={"game_year": 2020}, b={"competition_context": "non_mlb"}, x={"given": True}, y={"given": True, "game_year": 2020}, p={"game_year": 2020}, q={"game_year": 2021})
    names = lambda df: {k: [r.video_id for r in sorted(df.collect(), key=lambda r: r["rank"]) if r.run_id == k] for k in ("r", "own", "all")}
    assert names(product.eligible(rows, 3)) == {"r": ["c", "d", "e"], "own": ["x", "y"], "all": ["p", "q"]}
    assert names(product.eligible(rows, 3, F.lit(2024))) == {"r": ["d", "e", "f"], "own": ["x"], "all": ["p", "q"]}


def test_a_wave_takes_as_many_jobs_whatever_its_chains(spark):
    n = 250
    clips = spark.range(n).selectExpr("format_string('c%03d', id) AS clip_id", "array(id) AS frame_hashes", "id * 10.0D AS clip_start", "id * 10.0D + 11 AS clip_end", "id + 5.0D AS duration", "format_string('/%d', id) AS path")
    one = clips.agg(F.collect_list(F.struct("clip_id", "frame_hashes", "clip_start", "clip_end", "duration", "path")).alias("clips"))  # each clip loses against the next
    made = one.selectExpr("'r' AS run_id", "'v' AS video_id", "true AS downloaded", "true AS normalised", "clips", "CAST(NULL AS string) AS error")
    tried = spark.createDataFrame([("r", "v", 1, "recommended")], "run_id string, video_id string, attempt int, source_selection_mode string")
    spark.sparkContext.setJobGroup("wave", "wave")
    try:
        results, kept = product.outcomes(tried, made, lambda paths: {"file": "+".join(paths), "duration": 1.0}, resume.resolve, 1)
        row, left = results.first(), kept.collect()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("wave"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (row.status, row.raw_clips, row.final_clip_count, row.file) == ("ok", n, 1, f"/{n - 1}") and [r.clip_id for r in left] == [f"c{n - 1}"]
    assert jobs < 200
