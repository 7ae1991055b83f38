"""What several operators share: tables in the shared folder and word units of texts."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession

#: Places where cutting a text before a space or line end could change how it is split.
UNSAFE_CUT = re.compile(r"\s[ \n](?:\s|\Z)| \n")
#: Between a character that is no white space and white space every splitting rule used here ends a match.
SAFE_CUT = re.compile(r"(?<=\S)(?=\s)")

_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where that is unset and all runs in one process (tests)."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="tamarack-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark)}/tamarack/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends here and survives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written() -> list[str]:
    """Paths of the shared folder that this process has written and not released."""
    return list(_written)


def release(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete paths of the shared folder (by default all that this process has written), once results that read them are stored."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in written() if paths is None else paths:
        if name in _written:
            _written.remove(name)
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_kept: dict[tuple, object] = {}


def kept(key: tuple, build: Callable[[], object]):
    """What a worker process keeps between tasks: one thing, so that operators run in turn by one worker don't add up."""
    if key not in _kept:
        forget()
        _kept[key] = build()
    return _kept[key]


def forget() -> None:
    """Drops what this worker process has kept."""
    if _kept:
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def unit_keys(block: str) -> list[str] | None:
    """A text cut before each space and line end, or None where that could change how it is split.

    A unit is named by what follows its space, or by itself where it starts with a line end; the first unit has no space.
    """
    if UNSAFE_CUT.search(block):
        return None
    return block.replace("\n", " \n").split(" ")


def unit_text(key: str) -> str:
    """The text of any unit but the first."""
    return key if key[:1] == "\n" else " " + key


def blocks(text: str, size: int) -> Iterable[str]:
    """The text in blocks of about `size` characters, cut only at safe places; one block where none exists."""
    at, n = 0, len(text)
    while n - at > max(size, 1):
        cut = SAFE_CUT.search(text, at + max(size, 1))
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def in_groups(texts: Iterable[str], size: int) -> Iterator[list[tuple[bool, str]]]:
    """(whether its text ends there, block) of the successive blocks of texts, in lists of about `size` characters."""
    held, n = [], 0
    for text in texts:
        own = list(blocks(text, 1 << 20))
        for k, block in enumerate(own, 1):
            held.append((k == len(own), block))
            n += len(block)
            if n >= size:
                yield held
                held, n = [], 0
    if held:
        yield held


def joined_slices(values: pa.Array, ends: np.ndarray) -> list[memoryview]:
    """The values (large_binary) between successive ends, joined."""
    if not len(values):
        return [memoryview(b"")] * (len(ends) - 1)
    places = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1)[ends].tolist()
    data = memoryview(values.buffers()[2] or b"")
    return [data[a:b] for a, b in zip(places, places[1:])]


def gathered(texts: list[str | None], values: Callable[[list[str]], tuple[list, ...]]) -> Iterator[tuple[memoryview, ...]]:
    """For each text the joined values of its units, which single spaces separate (a null has none).

    values: distinct units -> lists of their values, bytes or text. It is called once, so that a unit which the texts
    repeat is looked up once; Arrow cuts them, tells units apart and puts the values in order.
    """
    cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    coded = cut.values.dictionary_encode()
    ends, own = cut.offsets.to_numpy(), values(coded.dictionary.to_pylist())
    return zip(*(joined_slices(pa.array(x, pa.large_binary()).take(coded.indices), ends) for x in own))


#: A group of over a 1/HOT part of all rows is joined by broadcast: by this definition there are fewer than HOT of them.
HOT = 10_000


def with_groups(rows: DataFrame, groups: DataFrame, keys: list[str], total: int, outer: bool = False) -> DataFrame:
    """rows with the columns of their group; groups: keys, n (rows of that key) and more; total: how many rows there are.

    The fewer than HOT groups of over total/HOT rows are joined by broadcast, so that no key's rows meet in one task;
    the rest by a shuffle. outer: rows without a group stay, with nulls.
    """
    from pyspark.sql import functions as F

    hot, rest = groups.where(F.col("n") > total / HOT), groups.where(F.col("n") <= total / HOT)
    few = F.broadcast(hot)
    return rows.join(few, keys).unionByName(rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys, "left" if outer else "inner"))


def sweep(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of jobs that are over."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Bits of the filter below (2 MB), and bits of a row of it.
FILTER_BITS, BLOCK_BITS = 1 << 24, 1 << 15


def likely(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """rows without most of those whose keys are not in `wanted`, and with all of the others; nothing is shuffled but marks.

    A bitmap of FILTER_BITS bits holds the hashes of the wanted keys and goes to every task: 2 MB at most, whatever the
    tables. What passes by chance is left to the join or grouping that follows.
    """
    from pyspark.sql import functions as F

    slot = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    marks = wanted.select(slot.alias("__slot")).groupBy(F.expr(f"__slot div {BLOCK_BITS}").alias("__block")).agg(F.expr(f"bitmap_construct_agg(__slot % {BLOCK_BITS})").alias("__bits"))
    bit = F.expr(f"shiftright(int(conv(hex(substring(__bits, int(__slot % {BLOCK_BITS} div 8) + 1, 1)), 16, 10)), int(__slot % 8)) & 1")
    own = rows.withColumn("__slot", slot).withColumn("__block", F.expr(f"__slot div {BLOCK_BITS}"))
    return own.join(F.broadcast(marks), "__block").where(bit == 1).select(*rows.columns)


def nested(rows: DataFrame, *keys: Column) -> DataFrame:
    """rows as one struct column `row`, beside keys: no name of theirs can clash with a key's. `select("row.*")` undoes it."""
    from pyspark.sql import functions as F

    return rows.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in rows.columns]).alias("row"), *keys)


def one_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One of the rows that share keys; keys that rows were just joined on need no other shuffle."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))).where("__n = 1").drop("__n")
