"""Queries of ordered signals, intervals, vectors and near duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vector
from ..operators import events as machine
from ..operators import graph, neardup, purity, report, signal
from .registry import query, table

KEYS, ORDER = ["user_id"], ["ts", "event_id"]


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with t, seconds as a double."""
    return table(spark, sf_dir, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)


TIMED = "timed AS (SELECT *, epoch_us(ts) / 1e6 AS t FROM events)"


@query("""SELECT event_id, user_id, coalesce(b IS NOT NULL AND b <> event_type AND (a IS NULL OR a <> b), false) AS is_cut FROM (
    SELECT *, lag(event_type) OVER w AS b, lead(event_type) OVER w AS a FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""")
def q12_change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return signal.change_points(e, KEYS, ORDER, lambda a, b: a["event_type"] == b["event_type"]).select("event_id", "user_id", "is_cut")


@query("""WITH RECURSIVE e AS (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, ts, event_type, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id, CAST(ts AS DATE)))::DOUBLE AS t FROM events),
near AS (SELECT *, lag(event_type) OVER w AS b, lead(event_type) OVER w AS a FROM e WINDOW w AS (PARTITION BY user_id, day ORDER BY ts, event_id)),
cuts AS (SELECT DISTINCT user_id, day, t FROM near WHERE b <> event_type AND (a IS NULL OR a <> b)),
groups AS (SELECT user_id, day, max(t) AS length FROM e GROUP BY 1, 2 HAVING max(t) > 0),
kept AS (SELECT user_id, day, 0.0::DOUBLE AS t FROM groups
    UNION ALL SELECT k.user_id, k.day, min(c.t) FROM kept k JOIN cuts c ON c.user_id = k.user_id AND c.day = k.day AND c.t - k.t >= 1800e6 GROUP BY k.user_id, k.day, k.t),
whole AS (SELECT k.*, length FROM kept k JOIN groups USING (user_id, day)),
real AS (SELECT * FROM whole QUALIFY NOT (lead(t) OVER (PARTITION BY user_id, day ORDER BY t) IS NULL AND t > 0 AND length - t < 1800e6))
SELECT user_id, day, CAST(row_number() OVER w - 1 AS INT) AS shot, t / 1e6 AS start, coalesce(lead(t) OVER w, length) / 1e6 AS "end" FROM real WINDOW w AS (PARTITION BY user_id, day ORDER BY t)""")
def q13_sliver_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots of each user's day: cuts at least 1800 s apart, slivers merged; times in microseconds are whole until the end."""
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts").cast("string")).withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    first = F.min("us").over(Window.partitionBy("user_id", "day"))
    e = e.select("event_id", "user_id", "day", "ts", "event_type", (F.col("us") - first).cast("double").alias("t"))
    cut = signal.change_points(e, ["user_id", "day"], ORDER, lambda a, b: a["event_type"] == b["event_type"])
    shots = signal.shots_of(cut, ["user_id", "day"], "t", "is_cut", 1800e6)
    return shots.withColumn("start", F.col("start") / 1e6).withColumn("end", F.col("end") / 1e6)


SMOOTH = """level AS (SELECT *, quantile_cont(value, 0.5) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m FROM events),
top AS (SELECT user_id, quantile_cont(m, 0.99) AS p, count(*) AS n FROM level GROUP BY user_id),
smoothed AS (SELECT event_id, user_id, ts, CASE WHEN n < 3 THEN 0.0 ELSE avg(least(1.0, m / coalesce(nullif(p, 0), 1))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) END AS smoothed FROM level JOIN top USING (user_id))"""


@query(f"WITH {SMOOTH} SELECT event_id, round(smoothed, 6) AS smoothed FROM smoothed")
def q14_signal_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal.smooth(table(spark, sf_dir, "events"), KEYS, ORDER, "value").select("event_id", F.round("smoothed", 6).alias("smoothed"))


RUNS = f"""{TIMED}, numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM timed),
islands AS (SELECT user_id, n - k AS run, min(t) AS first, max(t) AS last, count(*) AS rows FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM numbered WHERE value <= 80) GROUP BY 1, 2)"""


@query(f"""WITH {RUNS} SELECT user_id, min(first) AS anchor, count(*) AS quiet_runs FROM islands WHERE last - first >= 3600 GROUP BY user_id""")
def q15_quiet_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    quiet = signal.runs(timed(spark, sf_dir), KEYS, ORDER, "t", F.col("value") <= 80).where(F.col("last") - F.col("first") >= 3600)
    return quiet.groupBy("user_id").agg(F.min("first").alias("anchor"), F.count(F.lit(1)).alias("quiet_runs"))


@query(f"""WITH {RUNS}, marked AS (SELECT *, coalesce((first - lag(last) OVER (PARTITION BY user_id ORDER BY first, run) >= 14400)::INT, 0) AS new FROM islands),
blobs AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY first, run) AS blob FROM marked)
SELECT user_id, CAST(blob AS BIGINT) AS blob, min(first) AS first, max(last) AS last, CAST(sum(rows) AS BIGINT) AS rows FROM blobs GROUP BY user_id, blob""")
def q16_bridged_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    islands = signal.runs(timed(spark, sf_dir), KEYS, ORDER, "t", F.col("value") <= 80)
    return signal.bridged(islands, KEYS, 14400)


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's smoothed values, tenths of a second apart, as one shot."""
    s = signal.smooth(table(spark, sf_dir, "events"), KEYS, ORDER, "value")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy(*ORDER))
    s = s.withColumn("t", (n - 1) / 10.0)
    return s.select(F.col("user_id").cast("string").alias("shot_id"), "t", "smoothed", F.lit(0.0).alias("shot_start"), F.max("t").over(Window.partitionBy("user_id")).alias("shot_end"))


@query()
def q17_localize_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return machine.localize(_samples(spark, sf_dir), machine.Params(low=0.15, high=0.25, min_prepared=0.3, min_active=0.2, min_settle=0.2, quiet_anchor=0.2, relative=False))


@query()
def q18_localize_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return machine.localize(_samples(spark, sf_dir), machine.Params(low=0.2, high=0.3, min_prepared=0.3, min_active=0.3, min_settle=0.3, quiet_anchor=0.2))


@query("""SELECT conv_id, count(*) AS turns, count(*) FILTER (WHERE edge) AS edges, count(*) FILTER (WHERE NOT edge AND role = 'assistant') AS interior_answers FROM (
    SELECT *, row_number() OVER w = 1 OR lead(turn) OVER w IS NULL AS edge FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) GROUP BY conv_id""")
def q19_edge_interior(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = signal.edges(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"])
    return e.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.count_if("is_edge").alias("edges"), F.count_if(~F.col("is_edge") & (F.col("role") == "assistant")).alias("interior_answers"))


@query("""SELECT event_id, value > 300 OR coalesce(len(l) > 0 AND (b IS NULL OR b < value / 2) AND (a IS NULL OR a < value / 2) AND value > 60 AND value > 2 * greatest(list_median(l), 0.3), false) AS is_spike FROM (
    SELECT *, list_concat(coalesce(list(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 15 PRECEDING AND 2 PRECEDING), []), coalesce(list(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 FOLLOWING AND 15 FOLLOWING), [])) AS l,
        lag(value) OVER w AS b, lead(value) OVER w AS a FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""")
def q20_spike_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal.spikes(table(spark, sf_dir, "events"), KEYS, ORDER, "value", hard=300.0, least=60.0, ratio=2.0).select("event_id", "is_spike")


@query(f"""WITH {TIMED}, e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, t AS onset, t + 900 AS settle, t - 300 AS clip_start, t + 1000 AS clip_end,
    min(t) OVER (PARTITION BY user_id, CAST(ts AS DATE)) - 600 AS shot_start, max(t) OVER (PARTITION BY user_id, CAST(ts AS DATE)) + 1200 AS shot_end FROM timed),
n AS (SELECT a.*, max(CASE WHEN b.settle <= a.onset THEN b.settle END) AS earlier, min(CASE WHEN b.onset >= a.settle THEN b.onset END) AS later
    FROM e a LEFT JOIN e b ON a.user_id = b.user_id AND a.day = b.day AND a.event_id <> b.event_id GROUP BY ALL),
x AS (SELECT *, least(greatest(shot_start + 60, onset - 600, earlier + 30), clip_start) AS s, least(greatest(least(shot_end - 60, settle + 900, later - 30), clip_end), shot_end - 60) AS e FROM n)
SELECT event_id, round(s, 3) AS start, round(least(e, s + 1800), 3) AS "end" FROM x""")
def q21_clip_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = Window.partitionBy("user_id", "day")
    e = timed(spark, sf_dir).withColumn("day", F.to_date("ts")).select("event_id", "user_id", "day", F.col("t").alias("onset"), (F.col("t") + 900).alias("settle"), (F.col("t") - 300).alias("clip_start"), (F.col("t") + 1000).alias("clip_end"), (F.min("t").over(day) - 600).alias("shot_start"), (F.max("t").over(day) + 1200).alias("shot_end"))
    return report.clip_bounds(e, ["user_id", "day"], pre=600, post=900, edge=60, end_edge=60, gap=30, most=1800).select("event_id", "start", "end")


SHOTS = """shots AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'side_fullbody_acceptable' WHEN 1 THEN 'batter_bad' ELSE 'center_field_good' END AS view, (doc_id * 37 % 100) / 100.0::DOUBLE AS confidence,
    CASE WHEN l.toxic IS NOT NULL THEN l.toxic = 1 END AS contaminated, CASE WHEN l.quality IS NOT NULL THEN l.quality = 0 END AS closeup FROM documents LEFT JOIN labels l USING (doc_id))"""


@query(f"""WITH {SHOTS}, r AS (SELECT CASE WHEN view = 'batter_bad' THEN 'wrong_view_batter' WHEN view <> 'center_field_good' THEN 'non_center_field_side_view_reserved' WHEN confidence < 0.5 THEN 'low_view_confidence' WHEN contaminated THEN 'transition_contaminated' WHEN closeup THEN 'homogeneous_closeup' END AS reject_reason FROM shots)
SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS n FROM r GROUP BY 1""")
def q22_accept_shot(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    view = F.when(F.col("doc_id") % 7 == 0, "side_fullbody_acceptable").when(F.col("doc_id") % 7 == 1, "batter_bad").otherwise("center_field_good")
    reason = purity.reject_reason(view, F.col("doc_id") * 37 % 100 / 100.0, F.col("toxic") == 1, F.col("quality") == 0)
    return d.groupBy(F.coalesce(reason, F.lit("accepted")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def _scores():
    return F.map_from_arrays(F.array(*[F.lit(v) for v in purity.VIEWS]), F.transform(F.slice("embedding", 1, 7), lambda x: F.round(x.cast("double"), 4)))


VIEW_LIST = "[" + ", ".join(f"'{v}'" for v in purity.VIEWS) + "]"
MARGINS = f"""v AS (SELECT vec_id, label, list_transform(embedding[1:7], lambda x: round(x::DOUBLE, 4)) AS s, {VIEW_LIST} AS names FROM embeddings),
margins AS (SELECT vec_id, label, names[list_position(s, list_max(s))] AS best, round(s[1] - list_max(s[2:7]), 4) AS margin, names[1 + list_position(s[2:7], list_max(s[2:7]))] AS second FROM v)"""


@query(f"WITH {MARGINS} SELECT vec_id, best, margin, second FROM margins")
def q23_class_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").withColumn("s", _scores())
    return e.select("vec_id", vector.best_class(F.col("s")).alias("best"), vector.class_margin(F.col("s"), purity.VIEWS[0]).alias("margin"), vector.runner_up(F.col("s"), purity.VIEWS[0]).alias("second"))


FRAMING = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
pairs AS (SELECT a.label, a.vec_id, list_cosine_similarity(a.v, b.v) AS sim, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.v, b.v) DESC, b.vec_id) AS rn, b.vec_id AS other FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
framed AS (SELECT label, vec_id, count(*) AS others, CASE WHEN count(*) >= 5 THEN round(avg(sim) FILTER (WHERE rn <= 3), 4) + 0.0::DOUBLE END AS framing_score FROM pairs GROUP BY 1, 2)"""


def _framed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select(F.col("label").alias("source"), F.col("vec_id").alias("shot_id"), "embedding", F.lit(True).alias("accepted"), F.lit(1.0).alias("margin"))
    return purity.framing_scores(e)


@query(f"WITH {FRAMING} SELECT label, vec_id, others, framing_score, coalesce(framing_score < 0.15, false) AS vetoed FROM framed")
def q24_framing_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors pass the operator's rule, so each is scored against all others of its label."""
    return _framed(spark, sf_dir).select(F.col("source").alias("label"), F.col("shot_id").alias("vec_id"), "others", "framing_score", F.coalesce(F.col("framing_score") < 0.15, F.lit(False)).alias("vetoed"))


@query(f"""WITH {MARGINS}, m AS (SELECT m.vec_id, margin * 10 AS margin, second, CASE WHEN m.vec_id % 3 <> 0 THEN abs(e.embedding[8])::DOUBLE END AS edge FROM margins m JOIN embeddings e USING (vec_id))
SELECT vec_id, CASE WHEN margin IS NULL OR margin >= 0.4 THEN false WHEN margin < 0.3 AND second <> 'field_bad' THEN true ELSE coalesce(edge < 0.1, false) END AS vetoed FROM m""")
def q25_closeup_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").withColumn("s", _scores())
    first = purity.VIEWS[0]
    edge = F.when(F.col("vec_id") % 3 != 0, F.abs(F.col("embedding")[7]).cast("double"))
    return e.select("vec_id", purity.closeup_veto(vector.class_margin(F.col("s"), first) * 10, vector.runner_up(F.col("s"), first), edge).alias("vetoed"))


@query("""WITH h AS (SELECT vec_id, label, array_to_string(list_transform(embedding::DOUBLE[], lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '')::BIT AS h FROM embeddings)
SELECT a.vec_id AS id_a, b.vec_id AS id_b, CAST(bit_count(xor(a.h, b.h)) AS INT) AS distance FROM h a JOIN h b ON a.vec_id < b.vec_id AND b.vec_id - a.vec_id <= 60 WHERE bit_count(xor(a.h, b.h)) <= 20""")
def q26_neardup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("vec_id").alias("at"), vector.sign_bits(F.col("embedding")).alias("h"))
    return neardup.band_pairs(e, [], "vec_id", "at", "h", 60, 20)


LIKE = "mean <= 24 AND abs(ad - bd) / greatest(ad, bd) <= 0.25"


@query(f"""WITH RECURSIVE c AS (SELECT label::VARCHAR AS source, vec_id::VARCHAR AS clip_id, row_number() OVER (PARTITION BY label ORDER BY vec_id * 10.0, vec_id::VARCHAR) AS p, vec_id * 10.0::DOUBLE AS s,
    5.0::DOUBLE + vec_id % 3 AS d, s + 5 + vec_id % 3 AS e, array_to_string(list_transform(embedding[1:64]::DOUBLE[], lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '')::BIT AS h FROM embeddings),
pairs AS (SELECT a.source, a.p AS i, b.p AS j, a.d AS ad, b.d AS bd, bit_count(xor(a.h, b.h))::DOUBLE AS mean, greatest(0, b.s - a.e, a.s - b.e) AS apart, a.e > b.s AND b.e > a.s AS meet FROM c a JOIN c b ON a.source = b.source AND a.p < b.p),
conflicts AS (SELECT *, CASE WHEN ad < bd THEN i ELSE j END AS loser, CASE WHEN ad < bd THEN j ELSE i END AS winner, row_number() OVER (PARTITION BY source ORDER BY i, j) AS k FROM pairs WHERE meet OR ({LIKE} AND apart <= 400)),
sim AS (SELECT DISTINCT source, 0::BIGINT AS k, []::BIGINT[] AS gone, []::BIGINT[] AS took FROM c
    UNION ALL SELECT s.source, f.k, CASE WHEN list_contains(gone, i) OR list_contains(gone, j) THEN gone ELSE list_append(gone, loser) END, CASE WHEN list_contains(gone, i) OR list_contains(gone, j) THEN took ELSE list_append(took, f.k) END
    FROM sim s JOIN conflicts f ON f.source = s.source AND f.k = s.k + 1),
lost AS (SELECT f.* FROM (SELECT source, unnest(took) AS k FROM (SELECT source, arg_max(took, k) AS took FROM sim GROUP BY source)) JOIN conflicts f USING (source, k)),
chain AS (SELECT source, loser AS p, winner AS last, 1 AS steps FROM lost UNION ALL SELECT c.source, c.p, l.winner, steps + 1 FROM chain c JOIN lost l ON l.source = c.source AND l.loser = c.last),
ends AS (SELECT source, p, arg_max(last, steps) AS last FROM chain GROUP BY 1, 2),
far AS (SELECT x.source, x.i, x.j FROM pairs x LEFT JOIN lost a ON a.source = x.source AND a.loser = x.i LEFT JOIN lost b ON b.source = x.source AND b.loser = x.j
    WHERE NOT x.meet AND x.mean <= 24 AND abs(x.ad - x.bd) / greatest(x.ad, x.bd) <= 0.25 AND x.apart > 400 AND (a.i IS NULL OR (a.i, a.j) > (x.i, x.j)) AND (b.i IS NULL OR (b.i, b.j) > (x.i, x.j))),
flags AS (SELECT DISTINCT source, unnest([i, j]) AS p FROM far)
SELECT c.source, c.clip_id, CASE WHEN l.loser IS NOT NULL THEN 'removed' WHEN f.p IS NOT NULL THEN 'flagged' ELSE 'kept' END AS status, t.clip_id AS duplicate_of,
    CASE WHEN l.meet THEN 1.0 WHEN l.loser IS NOT NULL THEN round_even(1 - l.mean / 64, 3) END::DOUBLE AS confidence, CASE WHEN l.meet THEN 'time-overlap' WHEN l.loser IS NOT NULL THEN 'near-identical-frames' END AS reason
FROM c LEFT JOIN lost l ON l.source = c.source AND l.loser = c.p LEFT JOIN flags f ON f.source = c.source AND f.p = c.p LEFT JOIN ends n ON n.source = c.source AND n.p = c.p LEFT JOIN c t ON t.source = c.source AND t.p = n.last""")
def q27_neardup_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.resolve(_clips(spark, sf_dir), gap=400.0, most=24.0)


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as a clip of its label, ten seconds after the one before."""
    n = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(F.col("label").cast("string").alias("source"), n.cast("string").alias("clip_id"), F.array(vector.sign_bits(F.col("embedding"))).alias("frame_hashes"), (n * 10.0).alias("clip_start"), (n * 10.0 + 5 + n % 3).alias("clip_end"), (5.0 + n % 3).alias("duration"))


SPANS = f"""{TIMED}, a AS (SELECT event_id, user_id, t AS s, t + 7200 AS e FROM timed WHERE event_id % 2 = 0), b AS (SELECT event_id, user_id, t + 900 AS s, t + 7500 AS e FROM timed WHERE event_id % 2 = 1),
ov AS (SELECT a.event_id AS gt, b.event_id AS pred, greatest(0.0, least(a.e, b.e) - greatest(a.s, b.s)) / (greatest(a.e, b.e) - least(a.s, b.s)) AS iou FROM a JOIN b ON a.user_id = b.user_id AND a.s < b.e AND b.s < a.e),
best AS (SELECT gt, max(iou) AS iou, arg_max(pred, (iou, -pred)) AS pred FROM ov GROUP BY gt)"""


@query(f"""WITH {SPANS}, m AS (SELECT * FROM best WHERE iou >= 0.5)
SELECT a.event_id AS gt, m.pred AS pred, round(m.iou, 6) AS iou FROM a LEFT JOIN m ON m.gt = a.event_id""")
def q34_iou_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = timed(spark, sf_dir)
    a = e.where("event_id % 2 = 0").select(F.col("event_id").alias("gt"), "user_id", F.col("t").alias("s"), (F.col("t") + 7200).alias("e"))
    b = e.where("event_id % 2 = 1").select(F.col("event_id").alias("pred"), "user_id", (F.col("t") + 900).alias("ps"), (F.col("t") + 7500).alias("pe"))
    # A range join by time bucket: an interval meets only those that start in its own bucket or the ones beside it.
    bucket = lambda c: F.floor(F.col(c) / 7500).cast("long")
    left = a.withColumn("k", F.explode(F.array(bucket("s") - 1, bucket("s"), bucket("s") + 1)))
    met = left.join(b.withColumn("k", bucket("ps")), ["user_id", "k"]).where(vector.overlaps(F.col("s"), F.col("e"), F.col("ps"), F.col("pe")))
    scored = met.withColumn("iou", vector.iou(F.col("s"), F.col("e"), F.col("ps"), F.col("pe")))
    best = scored.groupBy("gt").agg(F.max("iou").alias("iou"), F.max_by("pred", F.struct("iou", -F.col("pred"))).alias("pred")).where("iou >= 0.5")
    return a.select("gt").join(best, "gt", "left").select("gt", "pred", F.round("iou", 6).alias("iou"))


@query("""SELECT c.event_id, v.event_id AS view_id, v.value AS view_value FROM (SELECT * FROM events WHERE event_type = 'click') c
ASOF LEFT JOIN (SELECT user_id, ts, arg_max(event_id, event_id) AS event_id, arg_max(value, event_id) AS value FROM events WHERE event_type = 'view' GROUP BY 1, 2) v ON c.user_id = v.user_id AND c.ts >= v.ts""")
def q47_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    views = e.where("event_type = 'view'").groupBy("user_id", "ts").agg(F.max("event_id").alias("view_id"), F.max_by("value", "event_id").alias("view_value"))
    clicks = e.where("event_type = 'click'").select("event_id", "user_id", "ts")
    return signal.as_of(clicks, views.withColumnRenamed("ts", "vts").select("user_id", "vts", "view_id", "view_value"), KEYS, "ts", "vts", ["view_id", "view_value"]).select("event_id", "view_id", "view_value")


@query("""WITH RECURSIVE p AS (SELECT doc_id AS node, lag(doc_id) OVER (PARTITION BY md5(text) ORDER BY doc_id) AS prev FROM documents),
chain AS (SELECT node, prev AS last, 1 AS steps FROM p WHERE prev IS NOT NULL UNION ALL SELECT c.node, p.prev, steps + 1 FROM chain c JOIN p ON p.node = c.last WHERE p.prev IS NOT NULL)
SELECT node AS doc_id, arg_max(last, steps) AS first_copy, max(steps) AS steps FROM chain GROUP BY node""")
def q74_copies_to_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each copy of a text points to the one before it; following that leads to the first."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    pointers = d.select(F.col("doc_id").alias("node"), F.lag("doc_id").over(Window.partitionBy("h").orderBy("doc_id")).alias("to")).where("to IS NOT NULL")
    return graph.chase(pointers).select(F.col("node").alias("doc_id"), F.col("last").alias("first_copy"), "steps")
