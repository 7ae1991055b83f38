"""The command line over small files."""

import json

from pyspark.sql import functions as F

from tamarack.__main__ import main
from tamarack.operators import product


def scripted(spark):
    """Tools that admit every source and give it three clips."""

    def preview(sources):
        kind = F.when(F.col("video_id") == "a", "recommended").otherwise("borderline")
        return sources.select("run_id", "video_id", "competition_context", F.lit("ok").alias("preview_status"), kind.alias("preview_decision"), F.lit("sufficient_good").alias("evidence_state"), F.lit(3).alias("complete_events"), F.lit(3).alias("center_field_shots"))

    def produce(sources):
        clip = lambda k: F.struct(k.cast("string").alias("clip_id"), F.array(F.xxhash64(k)).alias("frame_hashes"), (k * 100.0).alias("clip_start"), (k * 100.0 + 5).alias("clip_end"), F.lit(5.0).alias("duration"), k.cast("string").alias("path"))
        return sources.select("run_id", "video_id", F.lit(True).alias("downloaded"), F.lit(True).alias("normalised"), F.transform(F.sequence(F.lit(1), F.lit(3)), clip).alias("clips"), F.lit(None).cast("string").alias("error"))

    return product.Tools(preview, produce, lambda paths: {"file": "+".join(paths), "duration": 15.0})


def test_discover_and_segments(spark, tmp_path):
    hits = [
        {"ord": 0, "id": "a", "title": "Jane Roe full outing vs Mets", "channel": "MLB", "duration": 900, "upload_date": "20250401", "_query_source": "q1"},
        {"ord": 1, "id": "b", "title": "WBC full outing", "channel": "x", "duration": 900, "_query_source": "q1"},
        {"ord": 2, "id": "a", "title": "Jane Roe full outing vs Mets", "channel": "MLB", "duration": 900, "_query_source": "q2"},
        {"ord": 3, "id": "c", "title": "Jane Roe funniest moments #shorts", "channel": "y", "duration": 40, "_query_source": "q2"},
    ]
    (tmp_path / "hits.jsonl").write_text("\n".join(map(json.dumps, hits)))
    main(["discover", f"{tmp_path}/hits.jsonl", f"{tmp_path}/out", "--top", "2"])
    selected = {r.video_id: r for r in spark.read.json(f"{tmp_path}/out/selected").collect()}
    assert set(selected) == {"a", "c"} and selected["a"].query_source == "q1 + q2"
    assert [(r.video_id, r.reason) for r in spark.read.json(f"{tmp_path}/out/excluded").collect()] == [("b", "non_mlb")]
    main(["run", f"{tmp_path}/out/candidates", f"{tmp_path}/runs", "--name", "Jane Roe", "--tools", "test_commands:scripted", "--deliver", f"{tmp_path}/box"])
    (got,) = spark.read.parquet(f"{tmp_path}/runs/run_manifest").collect()
    assert (got.status, got.video_id, got.candidates, got.excluded, got.final_clips) == ("ok", "a", 3, 1, 3)
    assert [(r.batch_id.split("-")[-1], r["items"]) for r in spark.read.json(f"{tmp_path}/box/index").collect()] == [("a", 3)]
    main(["segments", f"{tmp_path}/out/selected", f"{tmp_path}/plan"])
    assert spark.read.json(f"{tmp_path}/plan").where("video_id = 'a'").count() == 5


def test_locate_deliver_evaluate(spark, tmp_path):
    x = [0.1] * 10 + [0.4, 0.6, 0.8, 0.7, 0.6, 0.55] + [0.35] * 9 + [0.1] * 10
    (tmp_path / "s.csv").write_text("shot_id,t,smoothed,shot_start,shot_end\n" + "\n".join(f"s1,{k / 10},{v},0,{len(x) / 10}" for k, v in enumerate(x)))
    main(["locate", f"{tmp_path}/s.csv", f"{tmp_path}/events"])
    assert [r.kind for r in spark.read.parquet(f"{tmp_path}/events").collect()] == ["event"]
    spark.createDataFrame([(f"i{k}", k) for k in range(5)], "item_id string, n long").write.parquet(f"{tmp_path}/items")
    main(["deliver", f"{tmp_path}/items", f"file://{tmp_path}/box", "b1", "--exclude", "i2=blurred"])
    assert sorted(r.number for r in spark.read.parquet(f"{tmp_path}/box/b1").collect()) == ["p01", "p02", "p03", "p04"]
    spark.createDataFrame([("x", True, True), ("x", True, False), ("y", False, True)], "who string, truth boolean, predicted boolean").write.parquet(f"{tmp_path}/rows")
    main(["evaluate", f"{tmp_path}/rows", f"{tmp_path}/rates", "--by", "who"])
    got = {r.who: (r.tp, r.fp, r.fn, r.precision) for r in spark.read.parquet(f"{tmp_path}/rates").collect()}
    assert got == {None: (1, 1, 1, 0.5), "x": (1, 0, 1, 1.0), "y": (0, 1, 0, 0.0)}
