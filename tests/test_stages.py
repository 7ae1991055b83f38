"""The locating stage and its tables; probes, re-encoding and leftovers of downloads."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tamarack.operators import stages

PATTERN = [0.1] * 10 + [0.4, 0.6, 0.8, 0.7, 0.6, 0.55] + [0.35] * 9 + [0.1] * 10


def tables(spark, shots):
    """shots: (video, shot, values or None, accepted), each from 100 times its place on."""
    rows, track = [], []
    for k, (video, shot, values, accepted) in enumerate(shots):
        start = 100.0 * k
        rows.append((video, shot, start, start + len(values or PATTERN) / 10, accepted))
        track += [(video, shot, start + j / 10, 2 * v, v) for j, v in enumerate(values or [])]
    s = spark.createDataFrame(rows, "video_id string, shot_id string, start double, end double, accepted_for_pitch_detection boolean")
    return s, s.where("accepted_for_pitch_detection").select("video_id", "shot_id", "start", "end"), spark.createDataFrame(track, "video_id string, shot_id string, t double, motion double, smoothed double")


SHOTS = [("v", "s0", PATTERN, True), ("v", "s1", [0.6] * 25, True), ("v", "s2", PATTERN, True), ("v", "s3", None, False), ("w", "s0", PATTERN, True), ("w", "s9", [0.12] * 30, True)]


def test_tables_of_the_stage(spark, tmp_path):
    root, (shots, candidates, samples) = f"{tmp_path}/m2", tables(spark, SHOTS)
    got = {r.video_id: r for r in stages.locate_stage(spark, shots, candidates, samples, root).collect()}
    assert (got["v"].input_candidates, got["v"].complete_events, got["v"].rejected_windows, got["v"].reject_by_reason) == (3, 2, 1, {"start_incomplete": 1})
    assert (got["w"].input_candidates, got["w"].complete_events, got["w"].reject_by_reason) == (2, 1, {"no_complete_pitch": 1})
    events = spark.read.parquet(f"{root}/events").orderBy("video_id", "event_id").collect()
    assert [(r.video_id, r.shot_id, r.event_id) for r in events] == [("v", "s0", "p001"), ("v", "s2", "p002"), ("w", "s0", "p001")]
    windows = spark.read.parquet(f"{root}/event_windows").where("video_id = 'v' AND event_id = 'p002'").orderBy("t").collect()
    own = events[1]
    assert len(windows) == len(PATTERN) and [r.in_clip for r in windows] == [own.clip_start <= r.t <= own.clip_end for r in windows] and 0 < sum(r.in_clip for r in windows) < len(PATTERN)
    assert spark.read.parquet(f"{root}/temporal_scores").count() == 3 * len(PATTERN) + 25 + 30
    # Run again for one source, the other's tables stay.
    again = candidates.where("video_id = 'w'")
    stages.locate_stage(spark, shots, again, samples.where("shot_id = 's9'"), root)
    assert spark.read.parquet(f"{root}/events").where("video_id = 'v'").count() == 2
    with pytest.raises(Exception, match="no accepted shot"):
        stages.locate_stage(spark, shots, candidates.unionByName(shots.where("shot_id = 's3'").select(*candidates.columns)), samples, root)
    with pytest.raises(ValueError, match="no candidates"):
        stages.locate_stage(spark, shots, candidates.where("false"), samples, root)


def test_numbers_do_not_repeat_after_a_cut_event(spark, tmp_path):
    shots, candidates, samples = tables(spark, SHOTS)
    cut = lambda e: e.select("video_id", "shot_id", "onset", (F.col("shot_id") != "s0").alias("continuous"), F.lit(0.21).alias("least_corr"))
    got = {r.video_id: r for r in stages.locate_stage(spark, shots, candidates, samples, str(tmp_path), continuity=cut).collect()}
    assert got["v"].reject_by_reason == {"shot_discontinuity": 1, "start_incomplete": 1} and got["w"].complete_events == 0
    assert [(r.shot_id, r.event_id) for r in spark.read.parquet(f"{tmp_path}/events").collect()] == [("s2", "p001")]
    assert {r.detail for r in spark.read.parquet(f"{tmp_path}/rejected_events").where("reject_reason = 'shot_discontinuity'").collect()} == {"min_corr=0.21"}


def probe(codec="h264", pixels="yuv420p", width=1920, rate="30000/1001", **more):
    return json.dumps({"streams": [{"codec_type": "audio", "codec_name": "aac"}, {"codec_type": "video", "codec_name": codec, "pix_fmt": pixels, "width": width, "height": 1080, "avg_frame_rate": rate} | more], "format": {"duration": "12.5"}})


def test_probes(spark):
    rows = [("a", probe()), ("b", probe("vp9", "yuv420p", 1000, "0/0")), ("c", '{"streams": [{"codec_type": "audio"}]}'), ("d", "no json"), ("e", None), ("f", probe(pixels="yuv444p", rate="25"))]
    f = stages.probe_facts(F.col("p"))
    got = {r.id: (r.f, r.n) for r in spark.createDataFrame(rows, "id string, p string").select("id", f.alias("f"), stages.normalising(f).alias("n")).collect()}
    assert tuple(got["a"][0]) == (1920, 1080, 30000 / 1001, 12.5, "h264", "yuv420p") and tuple(got["a"][1]) == ("reuse-original", 1920)
    assert got["b"][0].fps == 0.0 and tuple(got["b"][1]) == ("transcode-h264", 1000) and got["f"][0].fps == 25.0 and tuple(got["f"][1]) == ("transcode-h264", 1280)
    assert all(got[k] == (None, None) for k in "cde")


def test_files_are_copied_or_encoded_anew(spark, tmp_path):
    log = f"{tmp_path}/log"

    said = {"good": probe(), "wide": probe("vp9"), "out-good": probe(), "out-wide": probe(width=1280), "sound": '{"streams": []}', "stuck": probe("vp9"), "out-stuck": probe()}

    def look(path):
        name = os.path.basename(path)
        if name == "gone":
            raise OSError("no such file")
        return said.get(name, "")

    def recode(src, dest, width):
        if src.endswith("stuck"):
            raise RuntimeError("killed")
        with open(log, "a") as f:
            f.write(f"recode {src} {width}\n")

    def copy(src, dest):
        with open(log, "a") as f:
            f.write(f"copy {src}\n")

    jobs = spark.createDataFrame([(n, f"/in/{n}", f"/in/out-{n}") for n in ("good", "wide", "gone", "sound", "stuck")], "id string, src string, dest string").coalesce(1)
    got = {r.id: r for r in stages.normalised(jobs, look, recode, copy).collect()}
    assert (got["good"].ok, got["good"].method, got["good"].width, got["good"].fps) == (True, "reuse-original", 1920, 29.97)
    assert (got["wide"].ok, got["wide"].method, got["wide"].width) == (True, "transcode-h264", 1280)
    assert [got[k].ok for k in ("gone", "sound", "stuck")] == [False] * 3 and "no such file" in got["gone"].error and got["sound"].error == "no video stream" and "killed" in got["stuck"].error
    with open(log) as f:
        assert sorted(f.read().splitlines()) == ["copy /in/good", "recode /in/wide 1280"]


def test_leftovers_of_downloads(tmp_path):
    for name in ("clip.mp4", "clip.f137.mp4.part", "clip.f251.webm.ytdl", "clip2.mp4", "other.clip.mp4", "clip"):
        (tmp_path / name).write_text("x")
    (tmp_path / "clip.folder").mkdir()
    assert stages.clear_partials(f"{tmp_path}/clip.mp4") == ["clip.f137.mp4.part", "clip.f251.webm.ytdl", "clip.mp4"]
    assert sorted(os.listdir(tmp_path)) == ["clip", "clip.folder", "clip2.mp4", "other.clip.mp4"] and stages.clear_partials(f"{tmp_path}/none/x.mp4") == []
