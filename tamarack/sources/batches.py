"""Immutable batches as a Spark sink with two phases.

Tasks write their rows of each batch to files of their own in a staging folder and
report them; only the commit, on the driver, makes batches of them. It takes each
batch's name by creating its folder, which one writer alone can do, moves the files in,
and as the last step puts one file with a line for each batch into the index. Whatever
fails before that, a task, the commit or the driver, leaves no line in the index;
what was staged and the folders that were taken are removed again.

Options: root (a folder that driver and executors mount), batch (the column that names
the batch, default batch_id), least (items a batch needs), excluded (JSON: batch ->
item -> reason, recorded in the index). Rows should come grouped by batch within
partitions (`deliver_run` sees to it); those of one batch may lie in several.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .scan import _local

NAME = "tamarack_batches"
INDEX = "batch_id string, items long, excluded map<string,string>, files array<struct<name: string, items: long, sha256: string>>, delivered_at timestamp"


class BatchExists(Exception):
    """A batch of that name has been delivered; batches never change."""


@dataclass
class Staged(WriterCommitMessage):
    """Files of one task: (batch, file name, items, sha256)."""

    files: list[tuple[str, str, int, str]] = field(default_factory=list)


def _digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.root, self.column = _local(options["root"]), options.get("batch", "batch_id")
        self.least, self.excluded = int(options.get("least", 1)), json.loads(options.get("excluded", "{}"))
        self.staging = os.path.join(self.root, f".staging-{options.get('run') or uuid.uuid4().hex}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        os.makedirs(self.staging, exist_ok=True)
        mine, done, open_name, out, n = uuid.uuid4().hex, Staged(), None, None, 0  # another try has other names

        def close() -> None:
            if out is not None:
                out.close()
                name = os.path.basename(out.where)
                done.files.append((open_name, name, n, _digest(os.path.join(self.staging, name))))

        for batch in iterator:
            names = batch.column(batch.schema.get_field_index(self.column)).to_pylist()
            rows = batch.select([c for c in batch.schema.names if c != self.column])
            at = 0
            while at < len(names):
                upto = at
                while upto < len(names) and names[upto] == names[at]:
                    upto += 1
                if names[at] is None or "/" in str(names[at]) or str(names[at]).startswith("."):
                    raise ValueError(f"no name for a batch: {names[at]!r}")
                if open_name != str(names[at]):
                    close()
                    open_name, n = str(names[at]), 0
                    out = pq.ParquetWriter(os.path.join(self.staging, f"part-{len(done.files):05d}-{mine}.parquet"), rows.schema)
                out.write_batch(rows.slice(at, upto - at))
                n += upto - at
                at = upto
        close()
        return done

    def commit(self, messages: list[Staged | None]) -> None:
        files: dict[str, list[tuple[str, int, str]]] = {}
        for m in messages:
            for batch, name, n, digest in m.files if m else ():
                files.setdefault(batch, []).append((name, n, digest))
        for batch in self.excluded:
            files.setdefault(batch, [])  # all its items may be excluded
        taken: list[str] = []
        try:
            for batch, held in sorted(files.items()):
                count = sum(n for _, n, _ in held)
                if count < self.least:
                    raise ValueError(f"{batch}: {count} items, {self.least} needed")
                try:
                    os.mkdir(place := os.path.join(self.root, batch))
                except FileExistsError:
                    raise BatchExists(place) from None
                taken.append(place)
                for name, _, _ in held:
                    os.rename(os.path.join(self.staging, name), os.path.join(place, name))
            now = datetime.now(timezone.utc).isoformat()
            lines = [json.dumps({"batch_id": b, "items": sum(n for _, n, _ in held), "excluded": self.excluded.get(b, {}), "files": [{"name": f, "items": n, "sha256": d} for f, n, d in sorted(held)], "delivered_at": now}, ensure_ascii=False) for b, held in sorted(files.items())]
            os.makedirs(os.path.join(self.root, "index"), exist_ok=True)
            with open(line := os.path.join(self.root, f".index-{uuid.uuid4().hex}"), "w") as f:
                f.write("".join(x + "\n" for x in lines))
                f.flush()
                os.fsync(f.fileno())
            if lines:
                os.rename(line, os.path.join(self.root, "index", f"{now.replace(':', '')}-{uuid.uuid4().hex}.json"))
            else:
                os.remove(line)
        except BaseException:
            for place in taken:
                shutil.rmtree(place, ignore_errors=True)
            raise
        finally:
            shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list[Staged | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class BatchSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        raise ValueError("batches are read as Parquet; see delivered()")

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        return BatchWriter({"run": uuid.uuid4().hex} | dict(self.options))


def numbered(items: DataFrame, batch: str, order: list[str]) -> DataFrame:
    """items with `number`, p01, p02, ... within their batch; batches are numbered side by side."""
    n = F.row_number().over(Window.partitionBy(batch).orderBy(*order))
    return items.withColumn("number", F.format_string("p%02d", n))


def deliver_run(items: DataFrame, root: str, batch: str = "batch_id", id_col: str = "item_id", order: list[str] | None = None, exclude: DataFrame | None = None, least: int = 1) -> None:
    """Deliver all batches of a run in one job: every one, or none.

    exclude: (batch, id_col, reason) of items that are left out; the index records them, and a batch has them all as one
    map, which is meant for a review's few. Numbers follow `order` after exclusions.
    """
    spark = items.sparkSession
    left_out: dict[str, dict[str, str]] = {}
    if exclude is not None:
        known = exclude.join(items.select(batch, id_col), [batch, id_col], "left_semi")
        for r in known.select(F.col(batch).cast("string").alias("b"), F.col(id_col).cast("string").alias("i"), "reason").toLocalIterator():
            left_out.setdefault(r["b"], {})[r["i"]] = r["reason"]
        items = items.join(exclude.select(batch, id_col), [batch, id_col], "left_anti")
    spark.dataSource.register(BatchSink)
    rows = numbered(items, batch, order or [id_col]).withColumn(batch, F.col(batch).cast("string"))
    os.makedirs(_local(root), exist_ok=True)
    try:
        rows.sortWithinPartitions(batch, "number").write.format(NAME).option("root", root).option("batch", batch).option("least", least).option("excluded", json.dumps(left_out)).mode("append").save()
    except Exception as e:
        for kind in (BatchExists, ValueError):  # raised in a worker of Spark's, where it ends as text
            if f"{kind.__name__}: " in str(e):
                raise kind(str(e).split(f"{kind.__name__}: ", 1)[1].splitlines()[0]) from e
        raise


def index(spark: SparkSession, root: str) -> DataFrame:
    """A row of each delivered batch."""
    return spark.read.schema(INDEX).json(f"{root}/index")


def delivered(spark: SparkSession, root: str, batches: list[str], schema=None) -> DataFrame:
    """Items of batches that the index has, with `batch_id`."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    rows = reader.parquet(*[f"{root}/{b}" for b in batches])
    return rows.withColumn("batch_id", F.element_at(F.split(F.input_file_name(), "/"), -2))
