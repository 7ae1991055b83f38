"""Queries of streams, of the library's own data sources, of calibration and of resumed runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import calibrate, neardup, product, resume, stages
from ..operators.events import Params
from ..sources import batches, kernels, scan
from ..sources.shared import shared_path
from ..streaming.machine import localize_stream
from .registry import ORACLES, query, table
from .signals import _clips, _samples


@query()
def q71_localize_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of q18 from a stream of the samples, decided as the watermark passes them; a shot of its own carries the clock on."""
    place = shared_path(spark, "machine")
    at = (F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + F.col("t")).cast("timestamp")
    samples = _samples(spark, sf_dir).withColumn("ts", at)
    clock = spark.range(1).select(F.lit("clock").alias("shot_id"), F.lit(0.0).alias("t"), F.lit(0.0).alias("smoothed"), F.lit(0.0).alias("shot_start"), F.lit(1e12).alias("shot_end"), F.lit("2100-01-01").cast("timestamp").alias("ts"))
    samples.unionByName(clock).write.parquet(f"{place}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{place}/in").schema).parquet(f"{place}/in")
    p = Params(low=0.2, high=0.3, min_prepared=0.3, min_active=0.3, min_settle=0.3, quiet_anchor=0.2)
    done = localize_stream(stream, p, late="1 minute").writeStream.format("parquet").option("checkpointLocation", f"{place}/checkpoint").outputMode("append").trigger(availableNow=True).start(f"{place}/out")
    done.awaitTermination()
    return spark.read.parquet(f"{place}/out").where("shot_id != 'clock'")


@query("""SELECT source, frame, t, value FROM (SELECT CAST(user_id AS VARCHAR) AS source, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame, frame / 10.0::DOUBLE AS t, round(CAST(value AS FLOAT)::DOUBLE, 3) AS value FROM events)
WHERE frame % 5 = 0 AND t >= 1 AND t < 7.5""")
def q72_frame_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's values as a recording of ten a second, scanned on a grid of two a second between two times."""
    place = shared_path(spark, "recordings")
    n = F.expr("row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1")
    signal = table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), n.alias("frame"), F.array("value").alias("value"))
    scan.record(signal, place, 10.0)
    found = scan.frames(spark, place, fps="2").where("t >= 1 AND t < 7.5")
    return found.select("source", "frame", "t", F.round(F.col("value")[0].cast("double"), 3).alias("value"))


@query("""WITH kept AS (SELECT source, doc_id, lang, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)),
bad AS (SELECT source, count(*) AS excluded FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY source)
SELECT source AS batch_id, format('p{:02d}', row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id)) AS number, doc_id, lang, n_chars, count(*) OVER (PARTITION BY source) AS items, coalesce(excluded, 0) AS excluded
FROM kept LEFT JOIN bad USING (source)""")
def q73_deliver_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source of documents as a batch, toxic ones excluded, all in one job; read back with the index."""
    root = shared_path(spark, "batches")
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("batch_id"), "doc_id", "lang", "n_chars")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").join(docs.select("batch_id", "doc_id"), "doc_id").select("batch_id", "doc_id", F.lit("toxic").alias("reason"))
    batches.deliver_run(docs, root, id_col="doc_id", order=["n_chars", "doc_id"], exclude=toxic)
    index = batches.index(spark, root)
    names = [r.batch_id for r in index.select("batch_id").collect()]  # as many as sources
    items = batches.delivered(spark, root, names)
    return items.join(index.select("batch_id", "items", F.size("excluded").cast("long").alias("excluded")), "batch_id").select("batch_id", "number", "doc_id", "lang", "n_chars", "items", "excluded")


#: Levels for signals of users' values, lower than those of the default grid.
LEVELS = {"low": (0.2,), "high": (0.3, 0.4), "decay_ratio": (0.5, 0.7), "min_settle": (0.2, 0.3), "gap_bridge": (0.2, 0.3), "min_prepared": (0.1, 0.2), "min_active": (0.2,), "quiet_anchor": (0.2,)}


def calibration_windows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Windows of 40 samples of each user, and their samples: complete where a fifth of the rows are purchases; groups of users are held out."""
    c = F.col
    n = F.expr("row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1")
    bought = table(spark, sf_dir, "events").select("user_id", F.floor(n / 40).alias("block"), (c("event_type") == "purchase").alias("buy"))
    complete = bought.groupBy("user_id", "block").agg((F.count_if("buy") * 5 >= F.count(F.lit(1))).alias("complete"))
    name = lambda u, b: F.concat_ws("-", u, b.cast("string"))
    s = _samples(spark, sf_dir).withColumn("block", F.floor(F.round(c("t") * 10) / 40)).withColumn("window_id", name(c("shot_id"), c("block")))
    w = F.expr("block * 4.0D")
    samples = s.select("window_id", "t", "smoothed", w.alias("t0"), F.expr("least(block * 4.0D + 3.9D, shot_end)").alias("t1"))
    bounds = samples.groupBy("window_id").agg(F.max("t0").alias("t0"), F.max("t1").alias("t1"))
    windows = complete.select(name(c("user_id").cast("string"), c("block")).alias("window_id"), (c("user_id") % 7).alias("held"), "complete").join(bounds, "window_id")
    return windows.withColumn("latest", F.expr("t0 + 1.0D")).withColumn("earliest", F.expr("t1 - 1.0D")), samples


@query()
def q75_calibrate_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each group of users the parameters that the others' windows rate best, and how these do on its own."""
    windows, samples = calibration_windows(spark, sf_dir)
    rows = calibrate.judged(windows, samples, calibrate.machine_grid(LEVELS))
    return calibrate.chosen(calibrate.held_out(rows))


@query(f"""SELECT source, clip_id, status, duplicate_of, CASE WHEN status <> 'removed' THEN format('p{{:02d}}', row_number() OVER (PARTITION BY source, status <> 'removed' ORDER BY clip_id::INT)) END AS number,
    CASE WHEN source::INT % 3 = 0 THEN 'stale' ELSE 'current' END AS state FROM ({ORACLES["q27_neardup_greedy"]})""")
def q79_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finals of all sources, first made of clips that differ in every third source, then brought up to date."""
    root, clips = shared_path(spark, "finals"), _clips(spark, sf_dir)
    decide = lambda c: neardup.resolve(c, gap=400.0, most=24.0)
    longer = F.when(F.col("source").cast("int") % 3 == 0, F.col("duration") + 20).otherwise(F.col("duration"))
    resume.rebuild(clips.withColumn("duration", longer), root, decide)
    states = resume.rebuild(clips, root, decide)
    return spark.read.parquet(f"{root}/finals").withColumn("source", F.col("source").cast("string")).join(states, "source").select("source", "clip_id", "status", "duplicate_of", "number", "state")


@query()
def q80_image_kernels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's first 64 values as a grey image of 8 x 8: its hash, edges and brightness."""
    pixels = F.transform(F.slice("embedding", 1, 64), lambda x: F.least(F.lit(255.0), F.greatest(F.lit(0.0), (x.cast("double") + 0.5) * 255)))
    e = table(spark, sf_dir, "embeddings").select("vec_id", pixels.alias("value"))
    halves = {"high": lambda f: kernels.thumbnail_hash(f) >> 32, "low": lambda f: kernels.thumbnail_hash(f) & 0xFFFFFFFF}  # a double holds either exactly
    out = kernels.over_batches(e, {**halves, "edges": kernels.edge_share, "brightness": lambda f: f.mean()}, (8, 8))
    return out.select("vec_id", (F.col("high").cast("long") * 4294967296 + F.col("low").cast("long")).alias("hash"), "edges", "brightness")


@query("""WITH cand AS (SELECT o_custkey AS run_id, o_orderkey AS v, o_totalprice::DOUBLE AS s, CASE WHEN o_orderkey % 5 = 0 THEN 'non_mlb' WHEN o_orderkey % 5 = 1 THEN 'unknown' ELSE 'mlb' END AS context, o_orderkey % 7 = 0 AS game,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice::DOUBLE DESC, o_orderkey) AS rk FROM orders),
chosen AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY rk) AS r FROM cand WHERE rk <= 6 AND context <> 'non_mlb' AND NOT game QUALIFY r <= 3),
lines AS (SELECT l_orderkey AS v, count(*) AS n, sum(l_quantity)::DOUBLE AS seconds FROM lineitem GROUP BY 1),
said AS (SELECT c.*, coalesce(n, 0) AS n, coalesce(seconds, 0) AS seconds, CASE v % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 END AS tier FROM chosen c LEFT JOIN lines USING (v)),
tried AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY tier, CASE WHEN tier <= 2 THEN -(v % 6) ELSE -(v % 9 + 1) END, -s, r) AS attempt FROM said WHERE tier IS NOT NULL),
firsts AS (SELECT run_id, min(attempt) FILTER (v % 11 > 0 AND n >= 3) AS won, count(*) AS selected, count(*) FILTER (v % 11 = 0) AS lost FROM tried GROUP BY 1),
ended AS (SELECT f.run_id, won, selected, lost, v, seconds, n FROM firsts f LEFT JOIN tried t ON t.run_id = f.run_id AND t.attempt = f.won)
SELECT run_id, CASE WHEN e.won IS NOT NULL THEN 'ok' WHEN e.selected > 0 AND e.lost = e.selected THEN 'acquisition_failed' ELSE 'no_suitable_source' END AS status, e.v AS video_id, coalesce(e.won, e.selected, 0) AS attempted,
    coalesce(CASE WHEN e.won IS NOT NULL THEN e.n END, 0) AS final_clips, coalesce(CASE WHEN e.won IS NOT NULL THEN e.seconds END, 0) AS final_seconds
FROM (SELECT DISTINCT run_id FROM cand) LEFT JOIN ended e USING (run_id)""")
def q81_whole_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run for each customer, whose orders are its candidates and their lines the clips; tools are plans over the tables."""
    c, k = F.col, F.col("video_id").cast("long")
    o = table(spark, sf_dir, "orders")
    context = F.when(c("o_orderkey") % 5 == 0, "non_mlb").when(c("o_orderkey") % 5 == 1, "unknown").otherwise("mlb")
    rows = o.select(
        c("o_custkey").cast("string").alias("run_id"), c("o_orderkey").cast("string").alias("video_id"), F.lit("u").alias("url"), c("o_totalprice").cast("double").alias("final_score"), c("o_orderkey").alias("ord"), F.lit(False).alias("given"),
        context.alias("competition_context"), F.when(c("o_orderkey") % 7 == 0, "full_game").otherwise("full_outing").alias("source_type"),
    )

    def preview(sources: DataFrame) -> DataFrame:
        kind = F.when(k % 4 == 0, "recommended").when(k % 4 == 1, "borderline").otherwise("reject")
        state = F.when(k % 4 == 2, "insufficient").otherwise("sufficient_good")
        return sources.select("run_id", "video_id", "competition_context", F.lit("ok").alias("preview_status"), kind.alias("preview_decision"), state.alias("evidence_state"), (k % 6).alias("complete_events"), (k % 9 + 1).alias("center_field_shots"))

    def make(sources: DataFrame) -> DataFrame:
        n = c("l_linenumber").cast("long")
        clip = F.struct(n.cast("string").alias("clip_id"), F.array(F.xxhash64("l_linenumber")).alias("frame_hashes"), (n * 100.0).alias("clip_start"), (n * 100.0 + 1).alias("clip_end"), c("l_quantity").cast("double").alias("duration"), F.concat_ws("/", "video_id", n.cast("string")).alias("path"))
        lines = table(spark, sf_dir, "lineitem").withColumn("video_id", c("l_orderkey").cast("string"))
        clips = sources.select("run_id", "video_id").join(lines, "video_id").groupBy("run_id", "video_id").agg(F.collect_list(clip).alias("clips"))  # an order has few lines
        ok = k % 11 > 0
        return sources.select("run_id", "video_id").join(clips, ["run_id", "video_id"], "left").select("run_id", "video_id", ok.alias("downloaded"), ok.alias("normalised"), F.coalesce("clips", F.array().cast(product.CLIPS)).alias("clips"), F.lit(None).cast("string").alias("error"))

    tools = product.Tools(preview, make, lambda paths: {"file": "+".join(paths), "duration": float(len(paths))})
    runs = product.produce(spark, rows, tools, shared_path(spark, "runs"))
    kept = table(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").cast("string").alias("video_id")).agg(F.sum("l_quantity").cast("double").alias("__seconds"))
    return runs.join(kept, "video_id", "left").select(c("run_id").cast("long").alias("run_id"), "status", k.alias("video_id"), "attempted", "final_clips", F.coalesce("__seconds", F.lit(0.0)).alias("final_seconds"))


@query("""WITH s AS (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, event_type, value, (epoch_us(ts) // 1000000)::DOUBLE AS t FROM events),
e AS (SELECT user_id, day, event_id, t - 1800 AS a, t + 3600 AS b FROM s WHERE event_type = 'purchase' QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY t, event_id) <= 2)
SELECT user_id, day, e.event_id, t, value AS motion, s.t BETWEEN a AND b AS in_clip FROM e JOIN s USING (user_id, day)""")
def q82_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two purchases of each user's day with all of the day's values, marked where they lie near."""
    c = F.col
    s = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").cast("string").alias("day"), "event_id", "event_type", F.floor(F.unix_micros(c("ts").cast("timestamp")) / 1000000).cast("double").alias("t"), c("value").alias("motion"), c("value").alias("smoothed"))
    n = F.expr("row_number() OVER (PARTITION BY user_id, day ORDER BY t, event_id)")
    e = s.where("event_type = 'purchase'").withColumn("n", n).where("n <= 2").select("user_id", "day", "event_id", (c("t") - 1800).alias("clip_start"), (c("t") + 3600).alias("clip_end"))
    return stages.event_windows(e, s, ["user_id", "day"]).drop("smoothed")
