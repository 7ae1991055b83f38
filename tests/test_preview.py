"""Preview statistics and funnels."""

from pyspark.sql import functions as F

from tamarack.operators import preview, report


def test_segment_funnel(spark):
    shots = [("v", 0, f"s{k}", k, k in (1, 2, 4)) for k in range(5)] + [("v", 1, f"t{k}", k, False) for k in range(3)]
    s = spark.createDataFrame(shots, "source string, segment int, shot_id string, ord int, accepted boolean")
    e = spark.createDataFrame([("v", 0, "s1"), ("v", 0, "s4")], "source string, segment int, shot_id string")
    r = spark.createDataFrame([("v", 0, "s2", "start_incomplete"), ("v", 0, "s0", "end_incomplete")], "source string, segment int, shot_id string, reject_reason string")
    (got,) = preview.segment_funnel(s, e, r).collect()
    assert (got.shots, got.candidates, got.edge_skipped, got.segments_skipped_empty, got.complete, got.rejected, got.by_reason) == (6, 2, 2, 1, 1, 1, {"start_incomplete": 1})


def test_stats_and_summaries(spark):
    shots = spark.createDataFrame([("a", "center_field_good", 4.0), ("a", "other", 1.0), ("b", "graphic_bad", 1.0)], "v string, view_class string, duration double")
    got = {r.v: (r.cf_ratio, r.rapid_cut_rate, r.verdict) for r in preview.preview_stats(shots, ["v"]).collect()}
    assert got == {"a": (0.5, 0.5, "marginal"), "b": (0.0, 1.0, "unsuitable")}
    reports = spark.createDataFrame([("x", "reject", 1), ("y", "recommended", 2), ("z", "reject", 0)], "video_id string, preview_decision string, ord int")
    assert {r.preview_decision: r.ids for r in preview.by_decision(reports).collect()} == {"reject": ["z", "x"], "recommended": ["y"]}
    assert spark.range(1).select(preview.sample_times(F.lit(0.0), F.lit(10.0)).alias("t")).first().t == [2.0, 5.0, 8.0]
    runs = spark.createDataFrame([("ok", 3), ("low-yield", 1)], "status string, final_clip_count int")
    (s,) = preview.run_status(runs).collect()
    assert (s.final_clip_count, s.sources_ok, s.status) == (4, 1, "ok")


def test_source_warnings(spark):
    row = spark.createDataFrame([("borderline_fallback", 100, 2, 2, 2024, "low", "uncertain", "low-yield", 3)], "mode string, cf int, complete int, final int, year int, conf string, replay string, status string, least int")
    c = F.col
    (got,) = row.select(report.source_warnings(*map(c, row.columns)).alias("w")).collect()
    assert len(got.w) == 6 and got.w[1] == "unusually low event yield (2/100)" and got.w[-1] == "2 final clips < 3 required; source not used"
