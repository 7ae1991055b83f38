"""Finals of a run, built, resumed and brought up to date: what was stored is held against what it was made of.

Each source's finals are a partition; the manifest has a row of each source with the
digest of the clips it was made of and of the finals themselves. A run compares digests
and makes anew only what is missing, was made of other clips, or isn't what the
manifest says. Partitions are replaced as they are written, the manifest last, so that a
run that was cut off anywhere is resumed by the next, with the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.delivery import _fs, replace_folder
from ..sources.shared import stored
from .neardup import resolve

MANIFEST = "source string, clips_digest string, finals_digest string, clips long, kept long, flagged long, removed long, seconds double"


def digests(rows: DataFrame, key: str = "source") -> DataFrame:
    """(key, digest) of the rows of each key, whatever their order: number, sums of two halves of a hash, and xor; nothing is listed."""
    cols = [F.col(f"`{c}`") for c in sorted(rows.columns) if c != key]
    h = F.xxhash64(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))
    parts = [F.count(F.lit(1)).cast("string"), F.sum(F.shiftright(h, 32)).cast("string"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).cast("string"), F.hex(F.bit_xor(h))]
    return rows.groupBy(key).agg(F.concat_ws(":", *parts).alias("digest"))


def reconcile(inputs: DataFrame, manifest: DataFrame, finals: DataFrame) -> DataFrame:
    """(source, state, digest) of digests of clips, the manifest and digests of finals: current, stale, missing, damaged or orphan."""
    made = manifest.select("source", "clips_digest", "finals_digest")
    both = inputs.select("source", "digest").join(made, "source", "full").join(finals.select("source", F.col("digest").alias("__there")), "source", "full")
    state = (
        F.when(F.col("digest").isNull(), "orphan").when(F.col("clips_digest").isNull(), "missing").when(F.col("digest") != F.col("clips_digest"), "stale")
        .when(F.coalesce(F.col("__there") != F.col("finals_digest"), F.lit(True)), "damaged").otherwise("current")
    )
    return both.select("source", state.alias("state"), "digest")


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    fs, p = _fs(spark, path)
    if not fs.exists(p) and fs.exists(_fs(spark, f"{path}.before")[1]):  # a run was cut off as it replaced the folder
        path = f"{path}.before"
    return spark.read.schema(schema).parquet(path) if fs.exists(_fs(spark, path)[1]) else spark.createDataFrame([], schema)


def finals_of(clips: DataFrame, decide: Callable[[DataFrame], DataFrame] = resolve) -> DataFrame:
    """clips with status, duplicate_of, confidence, reason and `number`, the order of what stays by time: p01, p02, ..."""
    told = clips.join(decide(clips), ["source", "clip_id"])
    stays = F.col("status") != "removed"
    n = F.row_number().over(Window.partitionBy("source", stays).orderBy(F.asc_nulls_last("clip_start"), "clip_id"))
    return told.withColumn("number", F.when(stays, F.format_string("p%02d", n)))


def rebuild(clips: DataFrame, root: str, decide: Callable[[DataFrame], DataFrame] = resolve) -> DataFrame:
    """Bring root/finals and root/manifest up to date with clips; gives (source, state) as they were found."""
    spark = clips.sparkSession
    schema = finals_of(clips.limit(0), lambda c: c.select("source", "clip_id", *[F.lit(None).cast(t).alias(n) for n, t in (("status", "string"), ("duplicate_of", "string"), ("confidence", "double"), ("reason", "string"))])).schema
    folder = f"{root}/finals"
    before = stored(_read(spark, f"{root}/manifest", MANIFEST), "manifest")
    there = digests(_read(spark, folder, schema))
    plan = stored(reconcile(digests(clips), before, there), "plan")
    todo = plan.where("state IN ('missing', 'stale', 'damaged')").select("source")
    made = finals_of(clips.join(todo, "source", "left_semi"), decide).select(*schema.names)
    ordered = made.repartition("source").sortWithinPartitions("source", F.asc_nulls_last("clip_start"), "clip_id")
    ordered.write.partitionBy("source").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(folder)
    fs, _ = _fs(spark, folder)
    for row in plan.where("state = 'orphan'").select("source").toLocalIterator():
        for status in fs.globStatus(_fs(spark, f"{folder}/source={_escaped(row['source'])}")[1]) or ():
            fs.delete(status.getPath(), True)
    finals = spark.read.schema(schema).parquet(folder)
    new = finals.join(todo, "source", "left_semi")
    is_ = lambda s: F.count_if(F.col("status") == s)
    sums = new.groupBy("source").agg(F.count(F.lit(1)).alias("clips"), (is_("kept") + is_("flagged")).alias("kept"), is_("flagged").alias("flagged"), is_("removed").alias("removed"), F.round(F.coalesce(F.sum(F.when(F.col("status") != "removed", F.col("duration"))), F.lit(0.0)), 3).alias("seconds"))
    names = [c.split()[0] for c in MANIFEST.split(", ")]
    fresh = sums.join(digests(new).withColumnRenamed("digest", "finals_digest"), "source").join(plan.select("source", F.col("digest").alias("clips_digest")), "source").select(*names)
    same = before.join(plan.where("state = 'current'").select("source"), "source", "left_semi").select(*names)
    replace_folder(fresh.unionByName(same), f"{root}/manifest")
    return plan.select("source", "state")


def _escaped(source: str) -> str:
    """The name as Spark writes it into a partition's path, for a glob."""
    return "".join(f"%{ord(c):02X}" if c in '"#%\'*/:=?\\{}[]^\x7f' or ord(c) < 32 else c for c in source)
