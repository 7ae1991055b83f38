"""Recorded frames and signals as a Spark data source: partitions are ranges of time of a file, filters on time reach the file.

A recording is `<source>.raw`, frames one after the other, beside `<source>.json` with
rate (frames a second), shape ([] for a signal) and dtype. Rows are (source, frame, t,
value), value flat. Options: path (a folder); fps, the sampling grid (each
round(rate / fps)-th frame from `start` on, all frames by default); start and end in
seconds; span, the seconds of a partition (of over a thousand, those that follow each other are read together). Comparisons of t and tests of source with =
or IN leave out files, partitions and frames before anything is read; a stream has the
frames of each recording that were added since the last batch.

Files are opened by path on the executors: the folder is one that they all mount.
"""

from __future__ import annotations

import json
import math
import os
import pickle
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

SCHEMA = "source string, frame bigint, t double, value array<float>"
NAME = "tamarack_frames"
ARROW = pa.schema([("source", pa.string()), ("frame", pa.int64()), ("t", pa.float64()), ("value", pa.list_(pa.float32()))])
#: Bytes of frames in a batch of rows.
BATCH_BYTES = 8 << 20
#: Where there are more ranges than this, a task reads as many as this that follow each other, or so many bytes of frames.
RANGES, RANGES_BYTES = 1000, 16 << 20


def _local(path: str) -> str:
    return urlparse(path).path if path.startswith("file:") else path


@dataclass(frozen=True)
class Recording:
    source: str
    path: str
    rate: float
    shape: tuple[int, ...]
    dtype: str

    @property
    def frame_bytes(self) -> int:
        return int(np.dtype(self.dtype).itemsize * math.prod(self.shape))

    def frames(self) -> int:
        return os.path.getsize(self.path) // self.frame_bytes


def recordings(folder: str, names: set[str] | None = None) -> Iterator[Recording]:
    """The folder's recordings, or those of the given names."""
    folder = _local(folder)
    for name in sorted(f[:-5] for f in os.listdir(folder) if f.endswith(".json")) if names is None else sorted(names):
        path = os.path.join(folder, name)
        if os.path.exists(f"{path}.json") and os.path.exists(f"{path}.raw"):
            with open(f"{path}.json") as f:
                about = json.load(f)
            yield Recording(name, f"{path}.raw", float(about["rate"]), tuple(about.get("shape", [])), about.get("dtype", "<f4"))


@dataclass
class FrameRange(InputPartition):
    """Frames first, first + step, ... below last of a recording; of these only `points` where given."""

    recording: Recording
    first: int
    last: int
    step: int
    points: tuple[int, ...] | None = None

    def wanted(self) -> np.ndarray:
        grid = np.arange(self.first, self.last, self.step)
        return grid if self.points is None else grid[np.isin(grid, self.points)]

    @property
    def frame_bytes(self) -> int:
        return self.recording.frame_bytes * len(range(self.first, self.last, self.step))


@dataclass
class FrameRanges(InputPartition):
    """Ranges of one or more recordings that a task reads, packed: the driver holds a few bytes of each."""

    packed: bytes

    @classmethod
    def of(cls, ranges: list[FrameRange]) -> FrameRanges:
        return cls(zlib.compress(pickle.dumps(ranges)))

    def ranges(self) -> list[FrameRange]:
        return pickle.loads(zlib.decompress(self.packed))


def together(ranges: Iterator[FrameRange]) -> list[FrameRange | FrameRanges]:
    """Partitions of ranges: each of its own, or, of very many, those that follow each other, so that tasks go with frames and not with recordings."""
    some = list(islice(ranges, RANGES + 1))
    if len(some) <= RANGES:
        return some
    out, held, size = [], [], 0
    for part in chain(some, ranges):
        if held and (len(held) == RANGES or size + part.frame_bytes > RANGES_BYTES):
            out.append(FrameRanges.of(held))
            held, size = [], 0
        held.append(part)
        size += part.frame_bytes
    return [*out, FrameRanges.of(held)]


def read_ranges(part: FrameRange | FrameRanges | None) -> Iterator[pa.RecordBatch]:
    """Rows of a partition, those of small ranges in common batches."""
    if not isinstance(part, FrameRanges):
        yield from read_range(part)
        return
    held, size = [], 0
    for batch in chain.from_iterable(map(read_range, part.ranges())):
        if held and size + batch.nbytes > BATCH_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def read_range(part: FrameRange | None) -> Iterator[pa.RecordBatch]:
    """Rows of a range; only bytes of wanted frames are read. None stands for a scan without any partition."""
    if part is None:
        return
    r, wanted = part.recording, part.wanted()
    each = max(1, BATCH_BYTES // r.frame_bytes)
    with open(r.path, "rb") as f:
        for at in range(0, len(wanted), each):
            some = wanted[at : at + each]
            rows = []
            for run in np.split(some, np.flatnonzero(np.diff(some) != 1) + 1):
                f.seek(int(run[0]) * r.frame_bytes)
                rows.append(np.frombuffer(f.read(len(run) * r.frame_bytes), r.dtype))
            flat = np.concatenate(rows).astype(np.float32)
            width = math.prod(r.shape)
            value = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * width, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array([r.source] * len(some)), pa.array(some, pa.int64()), pa.array(some / r.rate), value], schema=ARROW)


class Options:
    def __init__(self, given: dict[str, str]):
        if "path" not in given:
            raise ValueError("option path is needed")
        self.path, self.span = given["path"], float(given.get("span", 60))
        self.fps = float(given["fps"]) if "fps" in given else None
        self.start, self.end = float(given.get("start", 0)), float(given.get("end", "inf"))

    def step(self, r: Recording) -> int:
        return max(1, round(r.rate / self.fps)) if self.fps else 1

    def ranges(self, r: Recording, low: int, high: int, points: tuple[int, ...] | None = None) -> Iterator[FrameRange]:
        """Partitions of frames [low, high) on the grid; points: only those that have any."""
        step, origin = self.step(r), int(self.start * r.rate)
        low = max(low, origin)
        first = origin + -(-(low - origin) // step) * step
        size = max(step, int(self.span * r.rate) // step * step)
        for at in range(first, high, size):
            part = FrameRange(r, at, min(at + size, high), step, points)
            if points is None or len(part.wanted()):
                yield part


class FrameReader(DataSourceReader):
    def __init__(self, options: Options):
        self.options, self.tests, self.names, self.points = options, [], None, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column, value = f.attribute if hasattr(f, "attribute") else None, getattr(f, "value", None)
            if column == ("t",) and isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                self.tests.append((type(f).__name__, float(value)))
            elif column == ("t",) and isinstance(f, (EqualTo, In)):
                points = {float(x) for x in (value if isinstance(f, In) else [value]) if x is not None}
                self.points = points if self.points is None else self.points & points
            elif column == ("source",) and isinstance(f, (EqualTo, In)):
                names = {x for x in (value if isinstance(f, In) else [value]) if x is not None}
                self.names = names if self.names is None else self.names & names
            elif not (isinstance(f, IsNotNull) and column in (("t",), ("source",), ("frame",))):  # which never are
                yield f

    def _bounds(self, r: Recording) -> tuple[int, int]:
        """Frames that comparisons of t leave: a first guess by the rate, then exactly by the times themselves."""
        n = r.frames()
        passes = {"GreaterThan": np.greater, "GreaterThanOrEqual": np.greater_equal, "LessThan": np.less, "LessThanOrEqual": np.less_equal}
        low, high = 0, n
        for name, value in [*self.tests, ("GreaterThanOrEqual", self.options.start), ("LessThanOrEqual", self.options.end)]:
            near = int(min(max(value * r.rate, 0), n))
            around = np.arange(max(near - 2, 0), min(near + 3, n))
            held = around[passes[name](around / r.rate, value)]
            if name.startswith("Greater"):
                low = max(low, int(held[0]) if len(held) else min(near + 3, n))
            else:
                high = min(high, int(held[-1]) + 1 if len(held) else max(near - 2, 0))
        return low, high

    def _ranges(self) -> Iterator[FrameRange]:
        for r in recordings(self.options.path, self.names):
            points = None
            if self.points is not None:
                near = {k for p in self.points if math.isfinite(p) for k in range(int(p * r.rate) - 1, int(p * r.rate) + 3)}
                points = tuple(sorted(k for k in near if k >= 0 and k / r.rate in self.points))
            yield from self.options.ranges(r, *self._bounds(r), points)

    def partitions(self) -> list[FrameRange | FrameRanges]:
        return together(self._ranges())

    def read(self, partition: FrameRange | FrameRanges) -> Iterator[pa.RecordBatch]:
        return read_ranges(partition)


class FrameStream(DataSourceStreamReader):
    """Offsets are the numbers of frames of each recording."""

    def __init__(self, options: Options):
        self.options = options

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {r.source: r.frames() for r in recordings(self.options.path)}

    def partitions(self, start: dict, end: dict) -> list[FrameRange | FrameRanges]:
        grown = {name for name, n in end.items() if n > start.get(name, 0)}
        return together(p for r in recordings(self.options.path, grown) for p in self.options.ranges(r, start.get(r.source, 0), end[r.source]))

    def read(self, partition: FrameRange | FrameRanges) -> Iterator[pa.RecordBatch]:
        return read_ranges(partition)

    def commit(self, end: dict) -> None:
        pass


class FrameSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FrameReader:
        return FrameReader(Options(dict(self.options)))

    def streamReader(self, schema) -> FrameStream:
        return FrameStream(Options(dict(self.options)))


def _ready(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FrameSource)


def frames(spark: SparkSession, path: str, **options) -> DataFrame:
    _ready(spark)
    return spark.read.format(NAME).options(path=path, **options).load()


def frame_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    _ready(spark)
    return spark.readStream.format(NAME).options(path=path, **options).load()


def record(rows: DataFrame, path: str, rate: float, shape: tuple[int, ...] = ()) -> None:
    """Write rows (source, frame, value) as recordings, frames in order; a source is written by one task as it streams by, and appears once it is whole."""
    folder = _local(path)
    os.makedirs(folder, exist_ok=True)
    about = json.dumps({"rate": rate, "shape": list(shape), "dtype": "<f4"})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        mine, open_name, out, n = TaskContext.get().taskAttemptId(), None, None, 0

        def finish() -> Iterator[pa.RecordBatch]:
            if open_name is not None:
                out.close()
                os.replace(out.name, os.path.join(folder, f"{open_name}.raw"))
                with open(f"{out.name}.about", "w") as f:
                    f.write(about)
                os.replace(f.name, os.path.join(folder, f"{open_name}.json"))
                yield pa.RecordBatch.from_pydict({"source": [open_name], "frames": [n]})

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != open_name:
                    yield from finish()
                    open_name, n, out = name, 0, open(os.path.join(folder, f".{name}.{mine}"), "wb")
                out.write(np.asarray(value, "<f4").tobytes())
                n += 1
        yield from finish()

    flat = rows.select(F.col("source").cast("string").alias("source"), "frame", F.col("value").cast("array<float>").alias("value"))
    ordered = flat.repartition("source").sortWithinPartitions("source", "frame").select("source", "value")
    ordered.mapInArrow(write, "source string, frames long").write.format("noop").mode("overwrite").save()
