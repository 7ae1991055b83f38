"""Runs that are cut off and resumed."""

import glob
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tamarack.operators import neardup, resume

SCHEMA = "source string, clip_id string, frame_hashes array<long>, clip_start double, clip_end double, duration double"


def clips(spark, names=("a", "b=1/x", "c"), shift=0.0):
    rows = [(s, f"c{k}", [(0, -1, 0x0F0F0F0F0F0F0F0F)[k // 2]], 30.0 * k + shift, 30.0 * k + 5 + shift, 5.0 + k % 2) for s in names for k in range(6)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def files(root):
    """Bytes of the finals by partition, and the manifest's rows."""
    out = {}
    for f in glob.glob(f"{root}/finals/*/*.parquet"):
        with open(f, "rb") as held:
            out.setdefault(f.split("/")[-2], []).append(hashlib.sha256(held.read()).hexdigest())
    return {k: sorted(v) for k, v in out.items()}


def manifest(spark, root):
    return sorted(map(tuple, spark.read.parquet(f"{root}/manifest").collect()))


def states(df):
    return {r.source: r.state for r in df.collect()}


def test_only_what_differs_is_made_anew(spark, tmp_path):
    root, calls = str(tmp_path), []

    def decide(c):
        calls.append(sorted(r.source for r in c.select("source").distinct().collect()))
        return neardup.resolve(c)

    assert set(states(resume.rebuild(clips(spark), root, decide)).values()) == {"missing"}
    first, rows = files(root), manifest(spark, root)
    assert [r[3:7] for r in rows] == [(6, 3, 0, 3)] * 3 and len(first) == 3
    assert set(states(resume.rebuild(clips(spark), root, decide)).values()) == {"current"} and calls[-1] == []
    assert files(root) == first and manifest(spark, root) == rows
    mixed = clips(spark, ("a", "c")).unionByName(clips(spark, ("new",))).withColumn("duration", F.when(F.col("source") == "c", 9.0).otherwise(F.col("duration")))
    assert states(resume.rebuild(mixed, root, decide)) == {"a": "current", "b=1/x": "orphan", "c": "stale", "new": "missing"} and calls[-1] == ["c", "new"]
    assert sorted(files(root)) == ["source=a", "source=c", "source=new"] and [r[0] for r in manifest(spark, root)] == ["a", "c", "new"]


def test_a_run_that_is_cut_off_is_resumed(spark, tmp_path, monkeypatch):
    whole, cut = f"{tmp_path}/whole", f"{tmp_path}/cut"
    resume.rebuild(clips(spark), whole)
    resume.rebuild(clips(spark, shift=500.0), cut)
    with monkeypatch.context() as m:
        m.setattr(resume, "replace_folder", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            resume.rebuild(clips(spark), cut)
    assert set(states(resume.rebuild(clips(spark), cut)).values()) == {"stale"}
    assert files(cut) == files(whole) and manifest(spark, cut) == manifest(spark, whole)


def test_a_damaged_partition_is_mended(spark, tmp_path):
    root = str(tmp_path)
    resume.rebuild(clips(spark), root)
    before = files(root)
    for f in glob.glob(f"{root}/finals/source=a/*.parquet"):
        os.remove(f)
    os.rename(f"{root}/manifest", f"{root}/manifest.before")  # cut off as the manifest was replaced
    assert states(resume.rebuild(clips(spark), root)) == {"a": "damaged", "b=1/x": "current", "c": "current"}
    assert files(root) == before and sorted(os.listdir(root)) == ["finals", "manifest"]
