"""Readers, frame kernels, the delivery sink and streams."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.operators import acquire
from tamarack.sources import delivery, frames, records
from tamarack.streaming import windows


def test_records(spark, tmp_path):
    (tmp_path / "clips.json").write_text(json.dumps([{"clip_id": "a", "clip_start": 1.5}, {"clip_id": "b"}]))
    assert [r.clip_id for r in records.json_records(spark, str(tmp_path / "clips.json"), records.CLIP).orderBy("clip_id").collect()] == ["a", "b"]
    (tmp_path / "ace.jsonl").write_text('{"t": 1}\n\n{"t": 2, "pitcher": "x"}\n')
    got = records.json_lines(spark, str(tmp_path / "ace.jsonl"), "t int, pitcher string", "pitcher").orderBy("t").collect()
    assert [r.pitcher for r in got] == ["ace", "x"]


def test_attempts_are_rows_not_failures(spark):
    def fetch(url):
        return (url == "good", "timeout" if url == "slow" else "refused")

    jobs = spark.createDataFrame([("1", "good"), ("2", "bad"), ("3", "slow")], "id string, url string")
    got = {r.id: (r.ok, r.attempts, r.error) for r in acquire.attempts(jobs, fetch, sleep=lambda s: None).collect()}
    assert got == {"1": (True, 1, None), "2": (False, 3, "refused"), "3": (False, 1, "timeout")}


def test_delivery_is_immutable_and_indexed_last(spark, tmp_path):
    root = f"{tmp_path}/out"
    items = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "item_id string, x int")
    place = delivery.deliver(items, root, "b1", delivery.parse_exclusions(["b=blurred"]))
    assert [(r.number, r.item_id) for r in spark.read.parquet(place).orderBy("number").collect()] == [("p01", "a"), ("p02", "c")]
    assert [r.batch_id for r in spark.read.json(f"{root}/index").collect()] == ["b1"]
    with pytest.raises(delivery.BatchExists):
        delivery.deliver(items, root, "b1")
    with pytest.raises(ValueError):
        delivery.deliver(items, root, "b2", least=9)
    assert spark.read.json(f"{root}/index").count() == 1


def test_frames():
    ramp = np.tile(np.arange(90, dtype=np.float32), (80, 1))
    assert frames.clip_hashes([ramp, ramp[:, ::-1]]) == [-1, 0]
    still = [np.zeros((8, 8, 3))] * 3
    assert frames.motion(still) == [0.0, 0.0, 0.0]
    assert frames.edge_density(np.zeros((8, 8))) == 0.0
    assert frames.box_share(still[0], still[1], (0, 0.5, 0, 1), (0.5, 1, 0, 1)) is None


def test_streams_agree_with_batch(spark, tmp_path):
    e = spark.createDataFrame([(1, "2024-01-01 00:00:01", 2.0), (1, "2024-01-01 00:04:00", 3.0), (2, "2024-01-01 00:11:00", 4.0)], "user_id long, ts string, value double").withColumn("ts", F.to_timestamp("ts"))
    e.write.parquet(f"{tmp_path}/events")
    stream = spark.readStream.schema(e.schema).parquet(f"{tmp_path}/events")
    q = windows.tumbling_counts(stream, "10 minutes").writeStream.outputMode("complete").format("memory").queryName("tumbling").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = sorted(map(tuple, windows.tumbling_counts(e, "10 minutes").collect()))
    assert sorted(map(tuple, spark.table("tumbling").collect())) == batch and [r[1] for r in batch] == [2, 1]
    assert sorted(r.n for r in windows.session_counts(e, "5 minutes").collect()) == [1, 2]
