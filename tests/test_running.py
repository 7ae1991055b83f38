"""Acquisition with scripted tools, runs, deliveries, replays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.functions import text
from tamarack.operators import acquire, evaluate, gate, purity, replay, report, run
from tamarack.sources import delivery, frames


def test_trials_need_a_file_and_stop_at_a_timeout(spark):
    waits = []
    codes = iter([(1, "x\nERROR: gone\n"), (0, ""), (0, "")])
    sizes = iter([7, 0, 5])
    got = acquire.trial_list([acquire.Strategy("s", lambda: next(codes), lambda: next(sizes), 3, (5.0, 15.0))], (), waits.append)
    assert [(t["code"], t["bytes"]) for t in got] == [(1, 7), (0, 0), (0, 5)] and waits == [5.0, 15.0]

    def late():
        raise TimeoutError("timeout after 300s")

    def said(run, size=lambda: 0):
        trials = acquire.trial_list([acquire.Strategy("s", run, size, 3, (5.0,))], (), lambda s: None)
        df = spark.createDataFrame([(trials,)], f"trials array<{acquire.TRIAL}>")
        last = F.element_at("trials", -1)
        return df.select(F.size("trials"), acquire.worked(last), acquire.trouble(last)).first()

    assert tuple(said(late, lambda: 1)) == (1, False, "timeout after 300s")
    assert tuple(said(lambda: (1, "a\nERROR: b\r\nERROR: c"))) == (3, False, "ERROR: b | ERROR: c")
    assert said(lambda: (0, ""))[2] == "exit 0, no output file"
    assert said(lambda: (2, "a\n\n b\nc\nd\n"))[2] == "b | c | d" and len(said(lambda: (2, "x" * 900))[2]) == 300
    assert said(lambda: 1 / 0)[2] == "ZeroDivisionError: division by zero"
    assert said(lambda: (0, ""), lambda: 9)[1]
    assert acquire.runtime_args({"node": "n"}.get) == ["--js-runtimes", "node"] and acquire.runtime_args({"deno": "d", "node": "n"}.get) == [] == acquire.runtime_args({}.get)


def test_waits_of_outcomes():
    waits = []
    assert len(list(acquire.outcomes(lambda: 1 / 0, 4, (5.0, 15.0), waits.append))) == 4 and waits == [5.0, 15.0, 15.0]


def test_search_and_lookup(spark):
    def find(query, limit):
        if "bad" in query:
            raise OSError("no network")
        return [{"id": f"{query}{k}", "title": "t", "duration": 5.0} for k in range(limit)]

    got = acquire.search(spark.createDataFrame([(0, "a", 2), (1, "bad", 2)], "ord long, query string, limit int"), find, wait=0.0).collect()
    assert [(r.id, r._query_source) for r in got] == [("a0", "a"), ("a1", "a")]
    urls = spark.createDataFrame([(0, "u0"), (1, "u1")], "ord long, url string")
    got = acquire.lookup(urls, lambda u: {"id": u} if u == "u1" else None).collect()
    assert [(r.ord, r.id, r._query_source) for r in got] == [(1, "u1", "operator --source-url")]


def test_sections_fall_back(spark):
    plans = spark.createDataFrame([(f"v{k}", "u", k, 1.0, 20.0, f"/x/{k}") for k in range(4)], "id string, url string, index int, start double, length double, path string")
    done = set()

    def section(url, start, length, path):
        if path == "/x/0":
            done.add(path)
        if path == "/x/3":
            raise ValueError("odd")
        return (0, "") if path in done else (1, "ERROR: 403")

    def full(url, path):
        if path == "/x/1.full":
            done.add(path)
            return 0, ""
        return 1, "ERROR: gone"

    got = {r["index"]: r for r in acquire.download_sections(plans, section, full, lambda whole, s, n, path: done.add(path), lambda p: int(p in done), sleep=lambda s: None).collect()}
    assert [got[k].method for k in range(4)] == ["section", "full-then-trim", "failed", "failed"]
    assert got[0].file == "/x/0" and got[2].file is None and got[2].error == "section: ERROR: 403 (attempts=2) | full: ERROR: gone"
    assert got[1].error == "section: ERROR: 403 (attempts=2)" and got[0].error is None and got[3].error.startswith("section: ValueError: odd (attempts=2)")


def test_media_rows(spark):
    jobs = spark.createDataFrame([("a", 1.0), ("b", -1.0)], "id string, start double")

    def work(start):
        if start < 0:
            raise ValueError("no such time")
        return {"ok": True, "duration": start * 2}

    got = {r.id: r for r in acquire.media(jobs, work, ["start"], "duration double").collect()}
    assert got["a"].ok and got["a"].duration == 2.0 and not got["b"].ok and "no such time" in got["b"].error
    clips = spark.createDataFrame([("v", 5.0, "c2", "/2"), ("v", 1.0, "c1", "/1")], "video_id string, clip_start double, clip_id string, path string")
    one = acquire.merged(clips, ["video_id"], lambda paths: {"file": "+".join(paths), "duration": 3.0}).first()
    assert (one.file, one.clips, one.ok) == ("/1+/2", 2, True)


def test_preview_spares_sources_outside(spark):
    selected = spark.createDataFrame([("a", "mlb"), ("b", "non_mlb"), ("c", None)], "video_id string, competition_context string")
    seen = []

    def preview(rows):
        seen.extend(r.video_id for r in rows.collect())
        return rows.select("video_id", F.when(F.col("video_id") == "c", "non_mlb").otherwise("mlb").alias("competition_context"), F.lit("recommended").alias("preview_decision"))

    got = {r.video_id: r.preview_decision for r in run.previewed(selected, preview).collect()}
    assert seen == ["a", "c"] and got == {"a": "recommended", "b": "reject", "c": "reject"}


def test_inputs_are_checked(spark):
    shots = spark.createDataFrame([("s1", True), ("s2", False)], "shot_id string, accepted_for_pitch_detection boolean")
    ok = spark.createDataFrame([("s1",)], "shot_id string")
    assert run.check_inputs(shots, ok).count() == 1
    with pytest.raises(Exception, match="no accepted shot: s2"):
        run.check_inputs(shots, spark.createDataFrame([("s2",)], "shot_id string")).collect()
    with pytest.raises(ValueError):
        run.check_inputs(shots, ok.limit(0))


def test_manifest_at_every_exit(spark, tmp_path):
    path = f"file://{tmp_path}/run/manifest"
    read = lambda: spark.read.json(path).first().asDict()
    with run.manifest(spark, path, run_id="r1") as m:
        m["status"] = "ok"
    assert read()["status"] == "ok" and read()["run_id"] == "r1"
    with pytest.raises(OSError), run.manifest(spark, path, run_id="r2"):
        raise OSError("disk full")
    assert read()["status"] == "run_error" and read()["reason"] == "OSError: disk full"
    with run.manifest(spark, path, run_id="r3"):
        pass
    assert read()["status"] == "no_suitable_source"


def test_adaptive_rounds(spark, tmp_path):
    kind = "video_id string, segments long, seconds double, duration double, preview_status string, round int, events long"
    first = spark.createDataFrame([("good", 5, 100.0, 800.0, "ok", 1, 1), ("thin", 5, 100.0, 800.0, "ok", 1, 0), ("part", 5, 100.0, 800.0, "partial", 1, 0), ("long", 5, 100.0, 5000.0, "ok", 1, 0), ("spent", 9, 300.0, 5000.0, "ok", 1, 0)], kind)
    asked = []

    def expand(open_, number):
        ids = sorted(r.video_id for r in open_.collect())
        asked.append((number, ids))
        return spark.createDataFrame([(i, 2, 30.0, 800.0 if i == "thin" else 5000.0, "ok", number, 0) for i in ids], kind)

    state = lambda held: held.groupBy("video_id").agg(F.when(F.sum("events") > 0, "sufficient_good").otherwise("insufficient").alias("evidence_state"))
    got = run.adaptive(first, expand, state, lambda k: f"file://{tmp_path}/round{k}")
    assert asked == [(2, ["long", "thin"]), (3, ["thin"])] and got.count() == 8


def test_reasons(spark):
    row = spark.range(1).select(
        gate.reasons(F.lit("ok"), F.lit(""), F.lit("unknown"), F.lit(5), F.lit(2), F.lit(0.4), F.lit(0.0), F.lit(0.5), F.lit(0.1)).alias("a"), gate.reasons(F.lit("failed"), F.lit("x" * 200), F.lit("mlb"), F.lit(0), F.lit(0), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("b"),
        text.type_and_reason(F.lit("Full outing highlights"), F.lit(""), F.lit(600.0), F.lit("")).alias("c"), text.type_and_reason(F.lit("Full outing highlights"), F.lit(""), F.lit(60.0), F.lit("")).alias("d"),
        text.type_and_reason(F.lit("plain"), F.lit(""), F.lit(60.0), F.lit("")).alias("e"), text.type_and_reason(F.lit("Nasty strikeouts"), F.lit(""), F.lit(600.0), F.lit("")).alias("f"),
    ).first()
    assert row.a == ["yield 0.4 over 5 CF candidates", "competition context unknown (not confirmed MLB)"] and row.b == ["acquisition failed: " + "x" * 120]
    assert tuple(row.c) == ("full_outing", "full outing + highlights suffix but duration consistent (10min)") and tuple(row.d) == ("pitching_highlights", "full outing claim contradicted by highlights wording at short/unknown duration")
    assert tuple(row.e) == ("short", "duration <= 65s") and tuple(row.f) == ("pitching_highlights", "general highlights/montage wording + pitching context -> pitching_highlights")


def test_delivery_refuses_hidden_cuts(spark):
    clips = spark.createDataFrame([("v", "e1", 1.0)], "video_id string, clip_id string, clip_start double")
    events = spark.createDataFrame([("v", "e1", "s", 1.0, 3.0, 4.0, 5.0, 6.0), ("v", "e2", "s", 8.0, 9.0, 9.5, 10.0, 11.0)], "video_id string, event_id string, source_shot_id string, clip_start double, motion_onset double, motion_peak double, settle_time double, clip_end double")
    shots = spark.createDataFrame([("v", "s", 0.0, 20.0)], "video_id string, shot_id string, start double, end double")
    item = delivery.delivery_items(clips, events, shots, ["video_id"]).first()
    assert (item.start, item.end, item.onset_at, item.peak_at, item.settle_at) == (1.0, 6.5, 2.0, 3.0, 4.0)
    with pytest.raises(delivery.HiddenCut, match="e1"):
        delivery.delivery_items(clips, events, shots, ["video_id"], cuts=clips.select("video_id", "clip_id"))


def test_bounds_of_events_without_length(spark):
    """Events that settle at their onset have the same neighbours as in all pairs."""
    rows = [(g, f"e{k}", 0.0, 60.0, t - 0.5, t, t + d, t + d + 0.2) for g in range(3) for k, (t, d) in enumerate([(1.0, 0.0), (1.0, 0.0), (4.0, 2.0), (5.0, 0.0), (6.0, 1.0), (30.0, 0.0)])]
    events = spark.createDataFrame(rows, "g long, event_id string, shot_start double, shot_end double, clip_start double, onset double, settle double, clip_end double")
    got = {(r.g, r.event_id): (r.start, r.end) for r in report.clip_bounds(events, ["g"]).collect()}
    for g, i, a, b, cs, on, se, ce in rows:
        others = [r for r in rows if r[0] == g and r[1] != i]
        before, after = [r[6] for r in others if r[6] <= on], [r[5] for r in others if r[5] >= se]
        s = min(max(a + 0.1, on - 2, *([max(before) + 0.3] if before else [])), cs)
        e = min(max(min(b - 0.25, se + 1.5, *([min(after) - 0.3] if after else [])), ce), b - 0.25)
        assert got[g, i] == (pytest.approx(s), pytest.approx(min(e, s + 30)))


def test_cascade_spares_later_stages(spark):
    shots = spark.createDataFrame([("a", "center_field_good", 0.9), ("b", "center_field_good", 0.2), ("c", "closeup_bad", 0.9), ("d", "center_field_good", 0.8)], "shot_id string, view_class string, confidence double")
    seen = {}

    def stage(name, flagged):
        def look(rows):
            seen[name] = sorted(r.shot_id for r in rows.collect())
            return rows.select("shot_id", F.col("shot_id").isin(*flagged).alias("flag"))

        return look

    got = {r.shot_id: (r.homogeneous_closeup, r.transition_contaminated) for r in purity.cascade(shots, stage("near", ["d"]), stage("mixed", ["a"])).collect()}
    assert seen == {"near": ["a", "d"], "mixed": ["a"]} and got == {"a": (False, True), "b": (False, False), "c": (False, False), "d": (True, False)}


def test_leave_one_out_and_differences(spark):
    rows = spark.createDataFrame([("x", 1), ("x", 2), ("y", 2), ("z", 3)], "g string, v long")
    assert {r.held: r.others for r in evaluate.leave_one_out(rows, "g", "v").collect()} == {"x": [2, 3], "y": [1, 2, 3], "z": [1, 2]}
    old, new = spark.createDataFrame([(1, "a"), (2, None)], "id long, c string"), spark.createDataFrame([(2, "b"), (3, "c")], "id long, c string")
    assert sorted((r.id, r.column, r.old, r.new) for r in replay.differences(old, new, "id", ["c"]).collect()) == [(1, "*", "true", None), (2, "c", None, "b"), (3, "*", None, "true")]
    lines = [r.line for r in replay.as_markdown(new, ["id", "c"], ["id"]).collect()]
    assert sorted(lines) == sorted(["| id | c |", "|-|-|", "| 2 | b |", "| 3 | c |"])


def test_frames(spark):
    green, black = np.zeros((20, 30, 3), np.uint8), np.zeros((20, 30, 3), np.uint8)
    green[..., 1] = 200
    assert frames.green_share(green) == 1.0 and frames.green_share(black) == 0.0 and frames.colour_entropy(black) == 0.0
    assert frames.LayoutClassifier().classify([green])[0] == "center_field_good" and frames.LayoutClassifier().classify([]) == ("other_bad", 0.0, dict.fromkeys(purity.VIEWS, 0.0))
    label, share, scores = frames.LayoutClassifier().classify([np.zeros_like(green), green])
    assert (label, share) == ("center_field_good", 0.5) and list(scores) == list(purity.VIEWS)  # a tie goes to the first view
    assert frames.clip_hashes([green, None]) is None and len(frames.clip_hashes([green] * 8)) == 8 and len(frames.sample_times(0, 8)) == 8

    def broken():
        raise OSError("no weights")

    assert frames.first_classifier(broken, frames.LayoutClassifier).backend.startswith("heuristic")
    shots = spark.createDataFrame([("a",), ("b",)], "shot_id string")
    got = {r.shot_id: (r.view_class, r.classifier) for r in frames.classified(shots, lambda i: [green] if i == "a" else [], frames.LayoutClassifier).collect()}
    assert got == {"a": ("center_field_good", "heuristic_fallback:v1"), "b": ("other_bad", "heuristic_fallback:v1")}
    points = spark.createDataFrame([("f", 3.0), ("f", 1.0), ("f", 70.0)], "path string, t double")
    got = {r.t: (r.height, r.width) for r in frames.point_frames(points, lambda path, times: [green if t < 60 else None for t in times]).collect()}
    assert got == {1.0: (20, 30), 3.0: (20, 30), 70.0: (None, None)}


def test_facts_of_files(spark):
    probe = spark.createDataFrame([("30000/1001", "30000/1001", "90", "3.0", "0.033", "1:1", 1), ("0/0", "x", None, None, None, None, 0)], "r_frame_rate string, avg_frame_rate string, nb_read_frames string, duration string, start_time string, sample_aspect_ratio string, audio_streams int")
    a, b = acquire.file_facts(probe).collect()
    assert (a.fps_float, a.constant_frame_rate, a.frame_count, a.has_audio) == (29.97, True, 90, True) and (b.fps_float, b.constant_frame_rate, b.frame_count, b.square_pixels, b.has_audio) == (0.0, False, 0, True, False)
