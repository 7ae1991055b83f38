"""The event machine over samples that are still coming."""

import os
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from tamarack.catalog import QUERIES
from tamarack.operators.events import OpenShot, Params, Shot, localize
from tamarack.plans import signals
from tamarack.streaming.machine import localize_stream

SF = "/root/testdata/sf0.01"
KIND = "shot_id string, t double, smoothed double, shot_start double, shot_end double, ts timestamp"


def noisy(rng, n):
    out = []
    while len(out) < n:
        level = rng.choice([0.05, 0.1, 0.2, 0.3, 0.32, 0.4, 0.45, 0.5, 0.6, 0.9, 0.7])
        out += [round(level + rng.choice([0, 0, 0.01, -0.01, 0.02]), 3) for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 12]))]
    return out[:n]


@pytest.mark.parametrize("seed", range(4))
def test_parts_of_any_size_decide_alike(seed):
    rng = random.Random(seed)
    for _ in range(600):
        n, step = rng.choice([1, 3, 4, 5, 8, 20, 60, 150, 400]), rng.choice([0.1, 0.2, 0.05])
        x, t = noisy(rng, n), [round(k * step, 3) for k in range(n)]
        start, end = rng.choice([0.0, -1.0]), t[-1] + rng.choice([0, 0.1, 0.5])
        p = Params(relative=rng.random() < 0.7, max_events=rng.choice([1, 2, 50]), min_prepared=rng.choice([0.8, 0.3, 0.1]), min_active=rng.choice([0.8, 0.3]), min_settle=rng.choice([0.6, 0.2]), gap_bridge=rng.choice([0.5, 0.2, 1.0]), quiet_anchor=rng.choice([0.3, 0.2]), edge_skip=rng.choice([0.3, 0, 1.0]))
        shot, got, k = OpenShot(start, end, p), [], 0
        while k < n:
            m = rng.choice([1, 1, 2, 5, 30])
            got += shot.push(t[k : k + m], x[k : k + m])
            shot, k = OpenShot(start, end, p, shot.held), k + m
        got += shot.push([], [], True)
        assert list(map(str, got)) == list(map(str, Shot(t, x, start, end, p).results()))


def test_what_is_held_does_not_grow_with_the_shot():
    pattern = [0.1] * 30 + [0.4, 0.6, 0.8, 0.7, 0.6, 0.55] + [0.35] * 9 + [0.1] * 30
    p, most = Params(max_events=10**9), {}
    for times in (10, 1000):
        x = pattern * times + [0.2] * 20_000 + [0.6] * 20_000
        shot = OpenShot(0.0, len(x) / 10, p)
        events = [r for k in range(0, len(x) - 100, 50) for r in shot.push([i / 10 for i in range(k, k + 50)], x[k : k + 50])]
        sizes = len(shot.t)
        assert len(events) == times // 2  # calm lasts up to the next core, whose pattern then has no quiet before it
        most[times] = sizes
    assert most[10] == most[1000] <= 12


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_q18_over_a_stream(spark, tmp_path):
    """In several batches and out of order, all shots give the rows of the table."""
    p = Params(low=0.2, high=0.3, min_prepared=0.3, min_active=0.3, min_settle=0.3, quiet_anchor=0.2)
    samples = signals._samples(spark, SF).toPandas()
    rng = random.Random(3)
    samples["ts"] = [datetime(2024, 1, 1) + timedelta(seconds=float(t)) for t in samples.t]
    samples["batch"] = [int(t // 2) + rng.choice([0, 0, 1]) for t in samples.t]
    last = int(samples.batch.max())
    clock = [("clock", 0.0, 0.0, 0.0, 1e9, datetime(2025, 1, 1) + timedelta(days=k)) for k in range(3)]
    for b in range(last + 1):
        part = samples[samples.batch == b].sample(frac=1.0, random_state=b).drop(columns="batch")
        if len(part):
            spark.createDataFrame(pd.DataFrame(part), KIND).coalesce(1).write.parquet(f"{tmp_path}/in/{b:04d}")
    for k, row in enumerate(clock):  # time goes on elsewhere
        spark.createDataFrame([row], KIND).coalesce(1).write.parquet(f"{tmp_path}/in/{9000 + k}")
    stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 4).parquet(f"{tmp_path}/in/*")
    q = localize_stream(stream, p, late="4 seconds").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint").outputMode("append").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    key = lambda df: sorted(map(repr, (tuple(r) for r in df.collect())))
    got = spark.read.parquet(f"{tmp_path}/out").where("shot_id != 'clock'")
    assert key(got) == key(localize(samples_df := spark.createDataFrame(samples[["shot_id", "t", "smoothed", "shot_start", "shot_end"]]), p)) and samples_df.count() > 1000
    assert key(got) == key(QUERIES["q18_localize_relative"](spark, SF))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_q71_is_q18(spark):
    key = lambda df: sorted(map(repr, (tuple(r) for r in df.collect())))
    assert key(QUERIES["q71_localize_stream"](spark, SF)) == key(QUERIES["q18_localize_relative"](spark, SF))
