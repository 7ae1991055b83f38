"""Exact deduplication over stateful streaming; DataFrame operations only.

Every text's SHA-256 is landed as a narrow stream of (digest, doc_id, row_id).
A stateful query keeps, for each digest and without expiry, the largest doc_id
(the stable identifier), the landed row that carries it (the content locator) and
a count, in the disk-backed RocksDB state store; equal digests are combined before
the shuffle, so a third of all rows sharing a text is no burden. On hits (digests
met more than once) the full normalised texts are read again and compared, those
of hits alone, which a bitmap of bounded size tells apart before the shuffle; a
digest that two different texts share sends its rows to a regrouping by text.

Texts are equal when identical after lower-casing A-Z alone. Null texts count as
empty, and empty texts equal one another. Where rows repeat a doc_id with an equal
text, exactly one of them is kept. A null doc_id sorts below all others. An empty
table gives an empty table; further columns, whatever their names, are ignored by
`exact_groups` and kept by `drop_copies`.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import likely, materialize, nested, one_each, shared_path, table, with_groups

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def normalised(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else; `lower` does just that where all characters are ASCII."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def dedup_stream(prints: DataFrame) -> DataFrame:
    """State of a stream (or table) of prints: digest, keep_id, locator, n; each output row replaces the digest's earlier ones."""
    return prints.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.max_by("row_id", F.coalesce("doc_id", F.lit(-(2**63)))).alias("locator"), F.count(F.lit(1)).alias("n"))


def run_state(spark: SparkSession, landed: str, max_bytes_per_trigger: int = 64 << 30) -> DataFrame:
    """The final state over the prints landed in a folder, by a query that takes what is there in micro-batches and then stops."""
    prints = spark.read.parquet(landed)
    if prints.isEmpty():
        return dedup_stream(prints)
    session = spark.newSession()
    for k, v in (STATE | {"spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions")}).items():
        session.conf.set(k, v)
    out, checkpoint = shared_path(spark, "dedup-state"), shared_path(spark, "dedup-checkpoint")

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = session.readStream.schema(prints.schema).option("maxBytesPerTrigger", str(max_bytes_per_trigger)).parquet(landed)
    query = dedup_stream(stream).writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    versions = spark.read.parquet(out)
    if versions.agg(F.max("batch").alias("b")).first().b in (None, 0):
        return versions.drop("batch")
    last = versions.groupBy("digest").agg(F.max("batch").alias("batch"))
    return materialize(versions.join(last, ["digest", "batch"], "left_semi").drop("batch"), "dedup-last")


def collided(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests of more than one row whose full texts are not all the same bytes; texts: digest, text.

    Texts without a hit are left behind before the shuffle, by a bitmap of the hits; what passes by chance is a group of
    one text. Equal texts are combined before the shuffle, so one plan serves every size and every number of copies.
    """
    hits = likely(texts, groups.where(F.col("n") > 1), ["digest"])
    return hits.groupBy("digest").agg(F.min("text").alias("least"), F.max("text").alias("most")).where(F.col("least") != F.col("most")).select("digest")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=digest_of) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("text")).withColumn("digest", digest(F.col("text")))
    landed = shared_path(spark, "prints")
    sha = [] if digest is digest_of else [F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256")]
    texts.select("doc_id", "digest", *sha, F.monotonically_increasing_id().alias("row_id")).write.parquet(landed)
    prints, groups = spark.read.parquet(landed), run_state(spark, landed)
    total = groups.agg(F.sum("n").alias("n")).first().n or 0
    sha = F.col("text_sha256") if sha else F.lower(F.hex("digest")).alias("text_sha256")
    out = with_groups(prints, groups, ["digest"], total)
    rows = [F.col("doc_id"), F.col("keep_id"), F.col("n").alias("group_size"), (F.col("row_id") == F.col("locator")).alias("kept"), sha]
    clash = materialize(collided(texts.select("digest", "text"), groups), "collided")
    if clash.isEmpty():
        return out.select(*rows)
    # Different texts under one digest: those rows are grouped anew by their whole text.
    again = texts.join(clash, "digest", "left_semi").withColumn("row_id", F.monotonically_increasing_id())
    again = materialize(again.drop("digest"), "collided-rows")
    sizes = dedup_stream(again.withColumnRenamed("text", "digest")).withColumnRenamed("digest", "text")
    anew = again.join(sizes, "text").withColumn("text_sha256", F.sha2(F.encode("text", "UTF-8"), 256))
    return out.join(clash, "digest", "left_anti").select(*rows).unionByName(anew.select(*rows[:4], "text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    least = F.lit(-(2**63))
    kept = exact_groups(docs).where("kept").select(F.coalesce("doc_id", least).alias("id"), F.unhex("text_sha256").alias("sha"))
    own = nested(docs, F.coalesce(F.col("doc_id").cast("long"), least).alias("id"), digest_of(normalised(F.col("text"))).alias("sha"))
    return one_each(own.join(kept, ["id", "sha"], "left_semi"), ["id", "sha"]).select("row.*")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


#: The same rows in DuckDB; translate() changes A-Z alone.
OP5_SQL = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g USING (text)
"""
