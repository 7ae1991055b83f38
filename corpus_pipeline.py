"""The corpus pipeline: stages over documents, each one's rows stored as Parquet and read by the next.

Each stage takes the rows that the one before it has kept, with all columns of
documents; the last returns the packed pieces. Labels for the classifier are read
from sf_dir. Null texts, repeated rows, empty tables and further columns are
handled as each operator's module says.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from tamarack.llm.common import materialize, release, table, written
from tamarack.llm.exact_dedup import drop_copies
from tamarack.llm.order_minhash import drop_near_copies
from tamarack.llm.packing import pack_documents
from tamarack.llm.quality import keep_good
from tamarack.llm.substring_dedup import remove_repeats


_of_last_stage: list[str] = []


def _stage(work):
    """A stage that first deletes the tables of the stage before it, whose result is stored by then."""

    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = " ".join(docs.inputFiles()[:1])
        release(spark, [p for p in _of_last_stage if p.rpartition("/")[2] not in read])
        # Rows go to Python in batches of so many bytes: both sides hold whole batches of texts, for each task at once.
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
        before = set(written())
        out = work(spark, docs, sf_dir)
        _of_last_stage[:] = [p for p in written() if p not in before]
        return out

    return run_stage


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


@_stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the largest doc_id."""
    return drop_copies(docs)


@_stage
def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


@_stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one of a smaller doc_id has too."""
    return remove_repeats(docs)


@_stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document that is left, packed into sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), cache_units=100_000)  # executors hold other stages' memory too


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", minhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: No SQL: the classifier, the tokenizer and the packing are not expressible; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, over the whole table."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
