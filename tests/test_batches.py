"""The two-phase sink of batches: all of a run or nothing, names taken once, the index last."""

import glob
import hashlib
import os
import threading

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tamarack.sources import batches


def items(spark, n=300, sources=7):
    return spark.range(n).selectExpr(f"concat('s', id % {sources}) AS batch_id", "concat('i', id) AS item_id", "id * 7 % 100 AS at", "id AS x")


def left(root):
    """What stands in the folder, but for items."""
    return sorted(x for x in os.listdir(root)) if os.path.isdir(root) else []


def test_all_sources_of_a_run_in_one_job(spark, tmp_path):
    root = f"{tmp_path}/out"
    rows = items(spark)
    out = spark.createDataFrame([("s1", "i1", "blurred"), ("s1", "i8", "cut"), ("s2", "absent", "none")], "batch_id string, item_id string, reason string")
    batches.deliver_run(rows, root, order=["at", "item_id"], exclude=out)
    index = {r.batch_id: r for r in batches.index(spark, root).collect()}
    assert sorted(index) == [f"s{k}" for k in range(7)] and index["s1"].excluded == {"i1": "blurred", "i8": "cut"} and index["s2"].excluded == {}
    assert left(root) == ["index", *sorted(index)] and len(glob.glob(f"{root}/index/*")) == 1
    got = batches.delivered(spark, root, sorted(index)).collect()
    assert len(got) == 298 and index["s1"]["items"] == 41
    for name in index:
        own = sorted((r for r in got if r.batch_id == name), key=lambda r: (r["at"], r.item_id))
        assert [r.number for r in own] == [f"p{k + 1:02d}" for k in range(len(own))]
        for f in index[name].files:
            with open(f"{root}/{name}/{f.name}", "rb") as held:
                assert hashlib.sha256(held.read()).hexdigest() == f.sha256


def test_more_than_99_items_have_longer_numbers(spark, tmp_path):
    batches.deliver_run(items(spark, 120, 1), f"{tmp_path}/out", order=["x"])
    got = batches.delivered(spark, f"{tmp_path}/out", ["s0"]).orderBy("x").collect()
    assert (got[0].number, got[98].number, got[119].number) == ("p01", "p99", "p120")


def test_one_taken_name_stops_the_whole_run(spark, tmp_path):
    root = f"{tmp_path}/out"
    batches.deliver_run(items(spark, 5, 1).withColumn("batch_id", F.lit("s3")), root)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/**", recursive=True) if os.path.isfile(f)}
    with pytest.raises(batches.BatchExists, match="s3"):
        batches.deliver_run(items(spark), root)
    assert left(root) == ["index", "s3"] and batches.index(spark, root).count() == 1
    assert before == {f: os.path.getmtime(f) for f in glob.glob(f"{root}/**", recursive=True) if os.path.isfile(f)}
    with pytest.raises(ValueError, match="50 needed"):
        batches.deliver_run(items(spark), f"{tmp_path}/few", least=50)
    assert left(f"{tmp_path}/few") == []


def test_a_task_that_fails_leaves_nothing(spark, tmp_path):
    root = f"{tmp_path}/out"
    broken = items(spark).withColumn("x", F.when(F.col("x") == 299, F.raise_error(F.lit("killed"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="killed"):
        batches.deliver_run(broken, root)
    assert left(root) == []
    with pytest.raises(ValueError, match="no name"):
        batches.deliver_run(items(spark).withColumn("batch_id", F.lit("../up")), root)
    assert left(root) == []


def rows(batch, n):
    return pa.RecordBatch.from_pydict({"batch_id": [batch] * n, "x": list(range(n))})


def test_a_second_try_of_a_task_counts_once(tmp_path):
    writer = batches.BatchWriter({"root": str(tmp_path), "run": "r"})

    def dies():
        yield rows("a", 3)
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        writer.write(dies())
    message, other = writer.write(iter([rows("a", 3), rows("a", 2), rows("b", 1)])), writer.write(iter([rows("a", 4)]))
    writer.commit([message, other, None])
    assert left(tmp_path) == ["a", "b", "index"]
    assert sum(pq.read_metadata(f).num_rows for f in glob.glob(f"{tmp_path}/a/*")) == 9 and len(os.listdir(tmp_path / "a")) == 2


def test_of_two_writers_one_gets_the_name(tmp_path):
    writers = [batches.BatchWriter({"root": str(tmp_path), "run": str(k)}) for k in range(8)]
    messages, lost = [w.write(iter([rows("same", k + 1)])) for k, w in enumerate(writers)], []

    def commit(k):
        try:
            writers[k].commit([messages[k]])
        except batches.BatchExists:
            lost.append(k)

    threads = [threading.Thread(target=commit, args=(k,)) for k in range(8)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert len(lost) == 7 and left(tmp_path) == ["index", "same"] and len(os.listdir(tmp_path / "index")) == 1
    (winner,) = set(range(8)) - set(lost)
    assert sum(pq.read_metadata(f).num_rows for f in glob.glob(f"{tmp_path}/same/*")) == winner + 1


def test_a_stream_reads_the_index_once(spark, tmp_path):
    from tamarack.streaming import windows

    root = f"{tmp_path}/out"

    def seen():
        stream = spark.readStream.schema(batches.INDEX).json(f"{root}/index")
        q = windows.new_batches(stream).select("batch_id").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/seen")
        q.awaitTermination()
        return sorted(r.batch_id for r in spark.read.schema("batch_id string").parquet(f"{tmp_path}/seen").collect())

    batches.deliver_run(items(spark, 9, 3), root)
    assert seen() == ["s0", "s1", "s2"]
    batches.deliver_run(items(spark, 2, 1).withColumn("batch_id", F.lit("t")), root)
    assert seen() == ["s0", "s1", "s2", "t"]
