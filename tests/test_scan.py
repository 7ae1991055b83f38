"""Recordings as a data source: what is read, on which grid, in batches and streams."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamarack.sources import frames as kernels
from tamarack.sources import scan


@pytest.fixture
def folder(tmp_path):
    rng = np.random.default_rng(0)
    for name, n in (("a", 300), ("b", 65), ("c", 0)):
        rng.integers(0, 256, (n, 4, 5)).astype("<f4").tofile(tmp_path / f"{name}.raw")
        (tmp_path / f"{name}.json").write_text(json.dumps({"rate": 30.0, "shape": [4, 5]}))
    (tmp_path / "half.json").write_text("{}")  # no frames beside it
    return str(tmp_path)


def arrays(folder):
    return {n: np.fromfile(f"{folder}/{n}.raw", "<f4").reshape(-1, 20) for n in "abc"}


def test_all_frames(spark, folder):
    got = scan.frames(spark, folder, span="2").collect()
    want = arrays(folder)
    assert len(got) == 365 and {r.source for r in got} == {"a", "b"}
    assert all(r.t == r.frame / 30.0 and np.array_equal(r.value, want[r.source][r.frame]) for r in got)


@pytest.mark.parametrize("test", ["t >= 1.5", "t > 1.5 AND t <= 2.25", "t < 0.1", "t = 2.0", "t IN (0.1, 1.0, 99.0)", "source = 'b'", "source IN ('a', 'x') AND t > 9.5", "t > 5 AND t < 4", "t >= 1 AND value[0] > 100", "t > 1e30", "t < -1"])
def test_filters_give_the_rows_of_a_filter_above(spark, folder, test):
    kept = scan.frames(spark, folder, span="1").where(test).select("source", "frame")
    plain = spark.createDataFrame([(r.source, r.frame, r.t, r.value) for r in scan.frames(spark, folder).collect()], scan.SCHEMA).where(test).select("source", "frame")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, plain.collect()))


def test_only_wanted_partitions_are_read(spark, folder):
    parts = lambda df: df.rdd.getNumPartitions()
    every = scan.frames(spark, folder, span="1")
    assert parts(every) == 10 + 3
    assert parts(every.where("t >= 8.5")) == 2 and parts(every.where("source = 'b'")) == 3 and parts(every.where("t IN (0.5, 9.5)")) == 3
    plan = every.where("t >= 8.5")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")
    reader = scan.FrameReader(scan.Options({"path": folder}))
    left = list(reader.pushFilters([scan.GreaterThanOrEqual(("t",), 2.0), scan.EqualTo(("frame",), 3)]))
    assert [type(f).__name__ for f in left] == ["EqualTo"] and [(p.recording.source, p.first, p.last) for p in reader.partitions()] == [("a", 60, 300), ("b", 60, 65)]


def test_sampling_grid(spark, folder):
    got = scan.frames(spark, folder, fps="10", start="1.05", end="3", span="0.5").where("source = 'a'").orderBy("frame").collect()
    first = int(1.05 * 30)
    assert [r.frame for r in got] == [k for k in range(first, 91) if (k - first) % 3 == 0 and 1.05 <= k / 30 <= 3]
    assert {r.frame % 15 for r in scan.frames(spark, folder, fps="2").collect()} == {0}


def test_motion_over_a_scan(spark, folder):
    rows = scan.frames(spark, folder, fps="10").where("source = 'b'").orderBy("t").collect()
    energy = kernels.motion([np.array(r.value).reshape(4, 5) for r in rows])
    assert len(energy) == 22 and energy[0] == 0.0 and all(e > 0 for e in energy[1:])


def test_record_and_read_back(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 7 AS source", "id div 7 AS frame", "array(float(id), float(id % 3)) AS value")
    scan.record(rows.orderBy(F.rand(1)), f"file://{tmp_path}/r", 10.0, (2,))
    got = scan.frames(spark, f"file://{tmp_path}/r")
    assert sorted((int(r.source), r.frame, tuple(r.value)) for r in got.collect()) == sorted((r.source, r.frame, tuple(r.value)) for r in rows.collect())


def test_a_stream_has_what_was_added(spark, folder, tmp_path):
    def add(name, n):
        with open(f"{folder}/{name}.raw", "ab") as f:
            np.full((n, 20), 7, "<f4").tofile(f)

    def run():
        out = scan.frame_stream(spark, folder, span="1").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/out")
        out.awaitTermination()
        return spark.read.schema(scan.SCHEMA).parquet(f"{tmp_path}/out")

    assert run().count() == 365
    add("b", 10), add("c", 4)
    got = run()
    assert got.count() == 379 and got.dropDuplicates(["source", "frame"]).count() == 379
    assert got.where("value[0] = 7 AND source = 'c'").count() == 4


def test_very_many_recordings_in_few_partitions(spark, tmp_path):
    rows = spark.range(0, 2500 * 20, 1, 4).selectExpr("id div 20 AS source", "id % 20 AS frame", "array(float(id)) AS value")
    scan.record(rows, f"{tmp_path}/r", 10.0)
    every = scan.frames(spark, f"{tmp_path}/r", fps="5").where("t >= 0.5")
    assert every.rdd.getNumPartitions() == 3
    want = {(str(k), f, f / 10.0, float(k * 20 + f)) for k in range(2500) for f in range(6, 20, 2)}
    got = [(r.source, r.frame, r.t, r.value[0]) for r in every.collect()]
    assert len(got) == len(want) and set(got) == want
    assert every.where("source = '7'").rdd.getNumPartitions() == 1 and every.where("t > 5").count() == 0
    reader = scan.FrameReader(scan.Options({"path": f"{tmp_path}/r", "span": "1"}))
    assert len(reader.partitions()) == 5 and sum(len(p.packed) for p in reader.partitions()) < 5000 * 60


def test_large_ranges_are_not_read_together(tmp_path):
    big, small = (scan.Recording(n, f"{tmp_path}/{n}", 10.0, s, "<f4") for n, s in (("big", (1 << 20,)), ("small", ())))
    parts = scan.together(iter([scan.FrameRange(big, k, k + 3, 1) for k in range(0, 30, 3)] + [scan.FrameRange(small, k, k + 1, 1) for k in range(1500)]))
    assert [len(p.ranges()) for p in parts] == [1] * 9 + [1000, 501]
    assert [(r.recording.source, r.first) for p in parts for r in p.ranges()] == [("big", k) for k in range(0, 30, 3)] + [("small", k) for k in range(1500)]
