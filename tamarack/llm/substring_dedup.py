"""Substring deduplication by level-wise doubling.

A window of `window` words is removed where its words also start in a document of
a smaller doc_id. Levels:

1. Half windows. Of the half windows in a window the one of least hash is its
   anchor, which depends on the words alone, so equal windows have equal anchors.
   Successive windows with one anchor form a run, about an eighth as many as
   there are words. Anchors that only one document has end here.
2. Runs whose anchor repeats, extended to all the words that their windows cover:
   a run that equals one of a smaller doc_id is removed whole.
3. The runs left whose anchor more than one document still has are extended window
   by window to full windows, and those repeated from a smaller doc_id are
   removed. A run removed before equals one that is left, so none is missed.

Groups of any size are combined before the shuffle and their size is known before
rows are joined to them: the fewer than HOT groups with over a HOT-th of all rows
go by broadcast. Windows longer than `window` need no levels of their own: the
words that they cover are those of the windows in them. Keys have 128 bits.

Null texts have no words; rows that repeat a doc_id do not remove words from one
another; a null doc_id counts as smaller than any other; empty tables give empty
tables; further columns are ignored by `repeated_words` and kept by `remove_repeats`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, nested, sweep, table, with_groups
from .wordhash import OF_WORDS, OF_WORDS_TOO, Words, parts, prefixes, spans

WINDOW = 50
LEAST = -(2**63)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def runs_of(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, hash of all covered words, first window, windows) of each run."""
    half = window // 2
    sums, down = prefixes(words.hashes, OF_WORDS)
    starts = words.room(window)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, none, starts, starts
    halves = spans(sums, down, np.arange(len(words.hashes) - half + 1), np.arange(half, len(words.hashes) + 1))
    many, least, size = window - half + 1, halves, 1
    while size * 2 <= many:  # least hash of 2, 4, ... successive half windows
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    anchors = np.minimum(least[starts], least[starts + many - size])
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1) | (words.document_of(starts[1:]) != words.document_of(starts[:-1]))
    at = np.flatnonzero(new)
    first, many_windows = starts[at], np.diff(np.append(at, len(starts)))
    sums, down = prefixes(words.hashes, OF_WORDS_TOO)
    return anchors[at], spans(sums, down, first, first + many_windows - 1 + window), first, many_windows


def run_rows(docs: DataFrame, window: int) -> DataFrame:
    """(anchor, span, id, text_key, pos, many) of the runs of docs (id, text_key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for low, _, data, offsets in parts(batch, 2):
                words = Words(data, offsets)
                anchors, covered, first, many = runs_of(words, window)
                doc = words.document_of(first)
                yield pa.RecordBatch.from_arrays([signed(anchors), signed(covered), pa.array(ids[low + doc]), pa.array(keys[low + doc]), pa.array((first - words.limits[doc]).astype(np.int32)), pa.array(many.astype(np.int32))], names=["anchor", "span", "id", "text_key", "pos", "many"])

    return docs.select("id", "text_key", "text").mapInArrow(run, "anchor long, span long, id long, text_key long, pos int, many int")


def window_rows(docs: DataFrame, window: int) -> DataFrame:
    """(a, b, id, text_key, pos) of each window in the runs of docs (id, text_key, text, runs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            lists = batch.column(3).to_pylist()
            for low, high, data, offsets in parts(batch, 2):
                words = Words(data, offsets)
                at = [np.arange(r["pos"], r["pos"] + r["many"]) + words.limits[k] for k in range(high - low) for r in lists[low + k]]
                first = np.concatenate(at) if at else np.zeros(0, np.int64)
                doc = words.document_of(first)
                both = []
                for powers in (OF_WORDS, OF_WORDS_TOO):
                    sums, down = prefixes(words.hashes, powers)
                    both.append(signed(spans(sums, down, first, first + window)))
                yield pa.RecordBatch.from_arrays([*both, pa.array(ids[low + doc]), pa.array(keys[low + doc]), pa.array((first - words.limits[doc]).astype(np.int32))], names=["a", "b", "id", "text_key", "pos"])

    return docs.select("id", "text_key", "text", "runs").mapInArrow(run, "a long, b long, id long, text_key long, pos int")


def key_columns() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key")]


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*key_columns(), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def removed_runs(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, text_key, runs): of each document with words to remove, the windows (pos, many) that go."""
    spark = docs.sparkSession
    count, first, last = F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), F.max("id").alias("last")
    rows = materialize(run_rows(docs, window), "runs")
    anchors = rows.groupBy("anchor").agg(count, first, last).where("first < last").drop("first", "last")
    total = rows.count()
    rows = materialize(with_groups(rows, materialize(anchors, "anchors"), ["anchor"], total).drop("n"), "repeated-runs")
    sweep(spark)
    total = rows.count()
    # A row's group always exists; groups of one row need no join.
    covered = rows.groupBy("anchor", "span").agg(count, first).where("n > 1")
    marked = with_groups(rows, materialize(covered, "spans"), ["anchor", "span"], total, outer=True)
    marked = materialize(marked.withColumn("gone", F.coalesce(F.col("first") < F.col("id"), F.lit(False))).drop("n", "first"), "marked-runs")
    left = marked.where(~F.col("gone")).drop("gone", "span")
    still = left.groupBy("anchor").agg(count, first, last).where("first < last").drop("first", "last")
    left = with_groups(left, materialize(still, "left-anchors"), ["anchor"], total)
    listed = left.groupBy("id", "text_key").agg(F.collect_list(F.struct("pos", "many")).alias("runs"))
    windows = materialize(window_rows(docs.join(listed, ["id", "text_key"]), window), "windows")
    sweep(spark)
    total = windows.count()
    same = windows.groupBy("a", "b").agg(count, first, last).where("first < last").drop("last")
    single = with_groups(windows, materialize(same, "same-windows"), ["a", "b"], total).where("first < id")
    gone = marked.where("gone").select("id", "text_key", "pos", "many").unionByName(single.select("id", "text_key", "pos", F.lit(1).alias("many")))
    out = materialize(gone.groupBy("id", "text_key").agg(F.collect_list(F.struct("pos", "many")).alias("runs")), "removed")
    sweep(spark)
    return out


def mask(n: int, runs: list | None, window: int) -> np.ndarray:
    """Which of n words stay."""
    edge = np.zeros(n + 1, np.int64)
    if runs is not None and len(runs):
        pos = np.array([r["pos"] for r in runs], np.int64)
        many = np.array([r["many"] for r in runs], np.int64)
        np.add.at(edge, pos, 1)
        np.add.at(edge, pos + many - 1 + window, -1)
    return np.cumsum(edge[:n]) == 0


def with_removed(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    own = keyed(docs)
    return own, own.join(removed_runs(own, window), ["id", "text_key"], "left")


def repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of each row."""
    _, joined = with_removed(docs, window)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch.column(1), batch.column(2).to_pylist()):
                words = text.as_py().encode().split()
                if runs:
                    stay = mask(len(words), runs, window)
                    kept = b" ".join(compress(words, stay.tolist()))
                    out.append((len(words), len(words) - int(stay.sum()), hashlib.sha256(kept).hexdigest()))
                else:
                    out.append((len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest()))
            ids = [None if x == LEAST else x for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array([x[k] for x in out], schema.types[k + 1]) for k in range(3))], schema=schema)

    return joined.select("id", "text", "runs").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with repeated words cut out of `text` (and n_chars, where there is one, after it).

    A text without repeats stays as it is, a null text null; of others the words that stay are joined by one space.
    """
    rows = nested(docs, *key_columns())
    gone = removed_runs(keyed(docs), window)
    joined = rows.join(gone, ["id", "text_key"], "left").select("row", "runs")

    @F.pandas_udf("string")
    def cut(text, runs):
        import pandas as pd

        out = []
        for t, r in zip(text, runs):
            if r is None or len(r) == 0:
                out.append(t)
            else:
                words = t.encode().split()
                out.append(b" ".join(compress(words, mask(len(words), r, window).tolist())).decode())
        return pd.Series(out)

    new = F.col("row").withField("text", cut("row.text", "runs"))
    if "n_chars" in docs.columns:
        new = new.withField("n_chars", F.length(new["text"]).cast(docs.schema["n_chars"].dataType))
    return joined.select(F.when(F.col("runs").isNull(), F.col("row")).otherwise(new).alias("row")).select("row.*")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(table(spark, sf_dir, "documents"))
