"""Queries of acquisition, runs, deliveries and replays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import acquire, evaluate, gate, replay, run, signal
from ..rules import generic
from ..sources import delivery, frames
from .accounting import FUNNEL, funnel
from .discovery import CANDIDATES, _type_sql, any_of, candidates
from .registry import query, table


@query("""WITH s AS (SELECT o_orderkey, (o_orderkey % 40000) * 0.25 AS a, (o_orderkey % 40000) * 0.25 + 20.0 AS b FROM orders)
SELECT o_orderkey, '*' || printf('%02d:%02d:%05.2f', CAST(floor(a / 3600) AS BIGINT), CAST(floor((floor(a) % 3600) / 60) AS BIGINT), (a - floor(a / 60) * 60)::DOUBLE) || '-' ||
    printf('%02d:%02d:%05.2f', CAST(floor(b / 3600) AS BIGINT), CAST(floor((floor(b) % 3600) / 60) AS BIGINT), (b - floor(b / 60) * 60)::DOUBLE) AS section FROM s""")
def q53_section_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = (F.col("o_orderkey") % 40000) * F.lit(0.25)
    return table(spark, sf_dir, "orders").select("o_orderkey", acquire.section_name(start, F.lit(20.0)).alias("section"))


def _reason_sql() -> str:
    wording = {n: p for n, p, _ in generic.PRIORITY}
    t = "lower(title || chr(10) || description_excerpt)"
    hinted, high = any_of(t, generic.HINTS), any_of(t, wording["general_highlights"])
    out = [f"WHEN {high} AND {any_of(t, wording[n])} THEN CASE WHEN duration >= {s} THEN '{n.replace('_', ' ')} + highlights suffix but duration consistent (' || CAST(floor(duration / 60) AS INT) || 'min)' ELSE '{n.replace('_', ' ')} claim contradicted by highlights wording at short/unknown duration' END" for n, s in generic.LONG_FORMS]
    out += [f"WHEN {any_of(t, p)} THEN " + (f"CASE WHEN {hinted} THEN '{why} + pitching context -> pitching_highlights' ELSE '{why}' END" if n == "general_highlights" else f"'{why}'") for n, p, why in generic.PRIORITY]
    return f"CASE {' '.join(out)} WHEN duration <= 65 THEN 'duration <= 65s' WHEN contains(url, '/shorts/') THEN 'shorts URL' WHEN {hinted} THEN 'pitching context only' ELSE 'no type signal' END"


@query(f"WITH {CANDIDATES} SELECT doc_id, {_type_sql(generic)} AS source_type, {_reason_sql()} AS reason FROM cand")
def q54_type_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    why = text.type_and_reason(c("title"), c("description_excerpt"), c("duration"), c("url"), generic)
    rows = candidates(spark, sf_dir).select("doc_id", why.alias("w"))
    return rows.select("doc_id", c("w.type").alias("source_type"), c("w.reason").alias("reason"))


@query(f"""WITH {FUNNEL} SELECT l_suppkey, CASE WHEN status = 'failed' THEN 'acquisition failed: tool error' WHEN context = 'non_mlb' THEN 'non-MLB competition context excluded from production' WHEN cf = 0 THEN 'zero center-field candidates in preview' ELSE
    CASE WHEN complete >= 2 AND complete_event_yield >= 0.2 AND discontinuity_rate <= 0.2 THEN 'yield over ' || cf || ' CF candidates' WHEN complete >= 1 THEN 'single complete event' WHEN center_field_ratio >= 0.4 AND discontinuity_rate <= 0.3 THEN 'no complete events, but CF available' ELSE 'yield, incomplete_rate' END
    || CASE WHEN context = 'unknown' THEN '; competition context unknown (not confirmed MLB)' ELSE '' END END AS reasons FROM decided""")
def q55_gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons with their numbers taken out, which engines print differently."""
    c = F.col
    why = gate.reasons(c("status"), F.lit("tool error"), c("context"), c("cf"), c("complete"), c("complete_event_yield"), c("discontinuity_rate"), c("center_field_ratio"), c("incomplete_rate"))
    plain = F.transform(why, lambda r: F.regexp_replace(F.regexp_replace(F.regexp_replace(r, r" \((?:yield )?[0-9.E-]+\)( with clean continuity)?", ""), r"^yield [0-9.E-]+ over", "yield over"), r"^yield [0-9.E-]+, incomplete_rate [0-9.E-]+", "yield, incomplete_rate"))
    return funnel(spark, sf_dir).select("l_suppkey", F.array_join(plain, "; ").alias("reasons"))


SOURCES = """src AS (SELECT s_suppkey AS video_id, CASE s_suppkey % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN 'non_mlb' ELSE 'mlb' END AS competition_context, CASE WHEN s_suppkey % 7 = 0 THEN 'full_game' ELSE 'full_outing' END AS source_type, s_acctbal AS score FROM supplier)"""


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    context = F.when(k % 5 == 0, "unknown").when(k % 5 == 1, "non_mlb").otherwise("mlb")
    return table(spark, sf_dir, "supplier").select(k.alias("video_id"), context.alias("competition_context"), F.when(k % 7 == 0, "full_game").otherwise("full_outing").alias("source_type"), F.col("s_acctbal").alias("score"))


@query(f"""WITH {SOURCES} SELECT video_id FROM (SELECT * FROM src ORDER BY score DESC, video_id LIMIT 16) WHERE competition_context <> 'non_mlb' AND source_type <> 'full_game' ORDER BY score DESC, video_id LIMIT 8""")
def q56_eligible_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: eight sources, of the sixteen that discovery takes."""
    return run.eligible(_sources(spark, sf_dir), 8, [F.col("score").desc(), F.col("video_id")]).select("video_id")


@query(f"""WITH {SOURCES} SELECT video_id, CASE WHEN competition_context = 'non_mlb' THEN 'non_mlb' ELSE 'full_game (both teams'' pitchers)' END AS reason FROM src WHERE competition_context = 'non_mlb' OR source_type = 'full_game'""")
def q57_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run.excluded(_sources(spark, sf_dir))


ATTEMPTS = """att AS (SELECT l_orderkey, l_linenumber AS attempt, l_partkey AS video_id, CASE WHEN l_suppkey % 4 > 0 AND l_partkey % 9 > 0 THEN CASE WHEN l_quantity < 10 THEN 'no-usable-clips' WHEN l_quantity < 25 THEN 'low-yield' WHEN l_discount < 0.02 THEN 'failed-merge' ELSE 'ok' END
    WHEN l_suppkey % 4 > 0 THEN 'failed-normalize' ELSE 'failed-download' END AS status, CASE l_linenumber % 2 WHEN 0 THEN 'borderline_fallback' ELSE 'recommended' END AS mode, CAST(l_quantity AS BIGINT) AS clips, CAST(l_extendedprice AS DOUBLE) AS seconds FROM lineitem)"""


@query(f"""WITH {ATTEMPTS}, done AS (SELECT * FROM att a WHERE NOT EXISTS (SELECT 1 FROM att b WHERE b.l_orderkey = a.l_orderkey AND b.attempt < a.attempt AND b.status = 'ok'))
SELECT l_orderkey, count(*) AS attempted, coalesce(max(mode) FILTER (WHERE status = 'ok'), arg_min(mode, attempt)) AS mode, CAST(coalesce(sum(clips) FILTER (WHERE status = 'ok'), 0) AS BIGINT) AS final_clips, round(coalesce(sum(seconds) FILTER (WHERE status = 'ok'), 0), 2) AS final_seconds,
    CASE WHEN count(*) FILTER (WHERE status = 'ok') > 0 THEN 'ok' WHEN count(*) FILTER (WHERE status = 'failed-download') = count(*) THEN 'acquisition_failed' ELSE 'no_suitable_source' END AS run_status FROM done GROUP BY 1""")
def q58_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    status = run.source_status(c("l_suppkey") % 4 > 0, c("l_partkey") % 9 > 0, F.when(c("l_quantity") < 10, 0).otherwise(c("l_quantity")), F.lit(25), c("l_discount") >= 0.02)
    mode = F.when(c("l_linenumber") % 2 == 0, "borderline_fallback").otherwise("recommended")
    tries = table(spark, sf_dir, "lineitem").select("l_orderkey", c("l_linenumber").alias("attempt"), c("l_partkey").alias("video_id"), status.alias("status"), mode.alias("source_selection_mode"), c("l_quantity").cast("long").alias("final_clip_count"), c("l_extendedprice").cast("double").alias("final_duration_sec"))
    return run.run_summary(tries, ["l_orderkey"]).select("l_orderkey", "attempted", "mode", "final_clips", F.round("final_seconds", 2).alias("final_seconds"), "run_status")


@query("""SELECT event_id, CASE WHEN share IS NOT NULL AND (share < 0.4 OR (active < 1.4 AND share < 0.48)) THEN 'no_delivery_suspected' END AS reject_reason FROM (SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN value / 100 END AS share, 0.5::DOUBLE + event_id % 20 / 10.0::DOUBLE AS active FROM events)""")
def q59_veto_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, kept ones and those that the veto moves."""
    from ..operators.purity import no_delivery

    c = F.col
    e = table(spark, sf_dir, "events").select("event_id", c("user_id").alias("source_shot_id"), F.when(c("event_id") % 13 != 0, c("value") / 100).alias("share"), (F.lit(0.5) + c("event_id") % 20 / 10.0).alias("active"))
    kept, moved = run.veto_split(e, no_delivery(c("share"), c("active")), F.lit("implausible"))
    return kept.select("event_id", F.lit(None).cast("string").alias("reject_reason")).unionByName(moved.select("event_id", "reject_reason"))


@query("""SELECT e.event_id FROM events e WHERE e.event_type = 'view' AND NOT EXISTS (SELECT 1 FROM events c WHERE c.event_type = 'click' AND c.user_id = e.user_id AND c.ts >= e.ts AND c.ts <= e.ts + INTERVAL 1 HOUR)""")
def q60_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views as predictions that no click within an hour confirms; the range join goes by hours of a user."""
    e = table(spark, sf_dir, "events").withColumn("h", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000).cast("long"))
    views = e.where("event_type = 'view'").select("event_id", "user_id", "ts", "h")
    clicks = e.where("event_type = 'click'").select("user_id", F.col("ts").alias("cts"), F.explode(F.array("h", F.col("h") - 1)).alias("h"))
    matches = views.join(clicks, ["user_id", "h"]).where("cts >= ts AND cts <= ts + INTERVAL 1 HOUR").select("event_id")
    return evaluate.unmatched(views, matches, "event_id").select("event_id")


@query("""SELECT 's' || p_partkey || '/' || p_size AS shot_id, 'v' || (p_partkey % 50) AS video_id, 'seg0' || (p_partkey % 5) AS segment, round((p_partkey % 5) * 60 + p_size * 0.25, 2)::DOUBLE AS "start", round((p_partkey % 5) * 60 + p_size * 0.25 + 2, 2)::DOUBLE AS "end" FROM part""")
def q61_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    of = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    p = table(spark, sf_dir, "part")
    shots = p.select(of("s", c("p_partkey"), "/", c("p_size")).alias("shot_id"), (c("p_size") * 0.25).alias("start"), (c("p_size") * 0.25 + 2).alias("end"), of("out/sources/v", c("p_partkey") % 50, "/m1m2/seg0", c("p_partkey") % 5, "/shots.json").alias("path"))
    files = spark.range(50).select(F.col("id").alias("v"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k")).select(of("out/sources/v", c("v"), "/segments/seg0", c("k"), "_", c("k") * 60, "s.mp4").alias("file"))
    return replay.pool(shots, files).select("shot_id", "video_id", "segment", "start", "end")


@query("""WITH s AS (SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS shot_id, l_returnflag = 'N' AS wanted, l_discount::DOUBLE * 10 AS margin, CASE WHEN l_linenumber <> 3 THEN l_tax::DOUBLE * 2 END AS texture FROM lineitem),
e AS (SELECT shot_id FROM s WHERE shot_id % 3 = 0)
SELECT l_suppkey, count(*) AS shots, count(*) FILTER (WHERE margin < 0.4) AS low, count(*) FILTER (WHERE margin < 0.4 AND coalesce(texture, 1) < 0.1) AS vetoed, count(*) FILTER (WHERE margin < 0.4 AND coalesce(texture, 1) < 0.1 AND shot_id % 3 = 0) AS vetoed_events FROM s WHERE wanted GROUP BY 1""")
def q62_veto_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    s = table(spark, sf_dir, "lineitem").select("l_suppkey", (c("l_orderkey") * 10 + c("l_linenumber")).alias("shot_id"), (c("l_returnflag") == "N").alias("wanted"), (c("l_discount").cast("double") * 10).alias("margin"), F.when(c("l_linenumber") != 3, c("l_tax").cast("double") * 2).alias("texture"))
    events = s.where("shot_id % 3 = 0").select("l_suppkey", c("shot_id").alias("source_shot_id"))
    return replay.veto_volume(s, events, ["l_suppkey"], c("margin"), c("texture"), c("wanted"))


@query("""SELECT l_orderkey, l_partkey, coalesce(o_totalprice > 150000 AND o_orderstatus <> 'P', false) AS replayed FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 4 > 0""")
def q63_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of shots that another rule accepts; every fourth shot is not there."""
    c = F.col
    shots = table(spark, sf_dir, "orders").where("o_orderkey % 4 > 0").select((c("o_orderkey") % 10).alias("run"), c("o_orderkey").alias("shot_id"), "o_totalprice", "o_orderstatus")
    events = table(spark, sf_dir, "lineitem").select((c("l_orderkey") % 10).alias("run"), c("l_orderkey").alias("source_shot_id"), "l_partkey")
    return replay.replay(events, shots, ["run"], (c("o_totalprice") > 150000) & (c("o_orderstatus") != "P")).select(c("source_shot_id").alias("l_orderkey"), "l_partkey", "replayed")


@query("""WITH o AS (SELECT c_custkey, c_mktsegment, round(c_acctbal, 0) AS score FROM customer WHERE c_custkey % 10 > 0), n AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'NONE' ELSE c_mktsegment END AS c_mktsegment, round(c_acctbal + (c_custkey % 3 = 0)::INT, 0) AS score FROM customer WHERE c_custkey % 11 > 0),
j AS (SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, o.c_custkey IS NOT NULL AS a, n.c_custkey IS NOT NULL AS b, o.c_mktsegment AS s1, n.c_mktsegment AS s2, o.score AS x, n.score AS y FROM o FULL JOIN n USING (c_custkey))
SELECT c_custkey, '*' AS "column" FROM j WHERE a <> b UNION ALL SELECT c_custkey, 'segment' FROM j WHERE a AND b AND s1 IS DISTINCT FROM s2 UNION ALL SELECT c_custkey, 'score' FROM j WHERE a AND b AND x IS DISTINCT FROM y""")
def q64_rescored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What differs between two versions of a scored pool."""
    c = F.col
    p = table(spark, sf_dir, "customer")
    old = p.where("c_custkey % 10 > 0").select("c_custkey", c("c_mktsegment").alias("segment"), F.round("c_acctbal", 0).alias("score"))
    new = p.where("c_custkey % 11 > 0").select("c_custkey", F.when(c("c_custkey") % 7 == 0, "NONE").otherwise(c("c_mktsegment")).alias("segment"), F.round(c("c_acctbal") + (c("c_custkey") % 3 == 0).cast("int"), 0).alias("score"))
    return replay.differences(old, new, "c_custkey", ["segment", "score"]).select("c_custkey", "column")


@query("""WITH v AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '30000/1001' WHEN 1 THEN '25/1' WHEN 2 THEN '0/0' WHEN 3 THEN 'x' ELSE '60/1' END AS r, CASE o_orderkey % 3 WHEN 0 THEN '30000/1001' WHEN 1 THEN '25/1' ELSE '59/1' END AS a,
    CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 1000 ELSE 0 END AS n, CASE WHEN o_orderkey % 6 > 0 THEN (o_orderkey % 900) * 0.25 ELSE 0 END AS d, CASE o_orderkey % 3 WHEN 0 THEN '1:1' WHEN 1 THEN '4:3' END AS sar, o_orderkey % 2 AS streams FROM orders),
q AS (SELECT *, coalesce(TRY_CAST(split_part(r, '/', 1) AS DOUBLE) / nullif(TRY_CAST(nullif(split_part(r, '/', 2), '') AS DOUBLE), 0), 0) AS rr, TRY_CAST(split_part(a, '/', 1) AS DOUBLE) / TRY_CAST(split_part(a, '/', 2) AS DOUBLE) AS aa FROM v)
SELECT o_orderkey, round(rr, 3) AS fps_float, rr <> 0 AND aa <> 0 AND coalesce(abs(rr - aa) / nullif(rr, 0) < 0.005, false) AS constant_frame_rate, n::BIGINT AS frame_count, d::DOUBLE AS duration_sec, 0.5::DOUBLE AS container_start_time_sec,
    coalesce(sar = '1:1', true) AS square_pixels, streams > 0 AS has_audio FROM q""")
def q65_file_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    r = F.when(k % 5 == 0, "30000/1001").when(k % 5 == 1, "25/1").when(k % 5 == 2, "0/0").when(k % 5 == 3, "x").otherwise("60/1")
    avg = F.when(k % 3 == 0, "30000/1001").when(k % 3 == 1, "25/1").otherwise("59/1")
    given = {
        "nb_read_frames": F.when(k % 4 > 0, (k % 1000).cast("string")).otherwise("N/A"), "duration": F.when(k % 6 > 0, ((k % 900) * 0.25).cast("string")), "start_time": F.lit("0.500000"),
        "sample_aspect_ratio": F.when(k % 3 == 0, "1:1").when(k % 3 == 1, "4:3"), "audio_streams": k % 2,
    }
    probe = table(spark, sf_dir, "orders").select("o_orderkey", r.alias("r_frame_rate"), avg.alias("avg_frame_rate"), *[v.alias(n) for n, v in given.items()])
    return acquire.file_facts(probe).select("o_orderkey", "fps_float", "constant_frame_rate", "frame_count", "duration_sec", "container_start_time_sec", "square_pixels", "has_audio")


@query("""WITH f AS (SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS frame, l_discount::DOUBLE * 6 AS green, l_tax::DOUBLE * 3 AS edges FROM lineitem),
v AS (SELECT l_suppkey, green > 0.45 AND edges < 0.1 AS a, green > 0.35 AS b, edges > 0.18 AND green < 0.15 AS c, green < 0.2 AND edges > 0.1 AS d FROM f),
t AS (SELECT l_suppkey, sum(CASE WHEN a THEN 1.0 WHEN b THEN 0.6 ELSE 0 END) AS center_field_good, sum(CASE WHEN NOT a AND b THEN 0.4 ELSE 0 END) AS field_bad, sum(CASE WHEN NOT a AND NOT b AND c THEN 1.0 ELSE 0 END) AS graphic_bad, sum(CASE WHEN NOT a AND NOT b AND NOT c AND d THEN 0.6 ELSE 0 END) AS closeup_bad,
    sum(CASE WHEN a OR b OR c THEN 0 WHEN d THEN 0.4 ELSE 1.0 END) AS other_bad, count(*) AS n FROM v GROUP BY 1)
SELECT l_suppkey, round(center_field_good::DOUBLE / n, 4) AS center_field_good, round(field_bad::DOUBLE / n, 4) AS field_bad, round(graphic_bad::DOUBLE / n, 4) AS graphic_bad, round(closeup_bad::DOUBLE / n, 4) AS closeup_bad, round(other_bad::DOUBLE / n, 4) AS other_bad FROM t""")
def q66_layout_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout classifier's votes on frames of which the shares of green and of edges are known, averaged by shot."""
    c = F.col
    f = table(spark, sf_dir, "lineitem").select("l_suppkey", frames.layout_votes(c("l_discount").cast("double") * 6, c("l_tax").cast("double") * 3).alias("v"))
    names = ["center_field_good", "field_bad", "graphic_bad", "closeup_bad", "other_bad"]
    return f.groupBy("l_suppkey").agg(*[F.round(F.avg(F.coalesce(c("v")[n], F.lit(0.0))), 4).alias(n) for n in names])


@query("""WITH n AS (SELECT user_id, event_id, embedding[1:8] AS e, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events v JOIN embeddings m ON m.vec_id = v.event_id % 500),
a AS (SELECT user_id, k, e, lag(e) OVER (PARTITION BY user_id ORDER BY k) AS before, first_value(e) OVER (PARTITION BY user_id ORDER BY k) AS first FROM n WHERE k <= 5)
SELECT user_id, round(min(CASE WHEN before IS NOT NULL THEN list_cosine_similarity(e, before)::DOUBLE END), 3) AS least_adjacent, round(arg_max(list_cosine_similarity(e, first)::DOUBLE, k), 3) AS ends FROM a GROUP BY 1""")
def q67_five_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a user's first five events the least similarity of neighbours, and that of the last with the first."""
    from ..functions.vector import cosine

    c = F.col
    e = table(spark, sf_dir, "events").withColumn("vec_id", c("event_id") % 500).join(table(spark, sf_dir, "embeddings").select("vec_id", F.slice("embedding", 1, 8).alias("e")), "vec_id")
    return signal.sample_agreement(e, ["user_id"], ["ts", "event_id"], "e", 5, cosine).select("user_id", F.round("least_adjacent", 3).alias("least_adjacent"), F.round("ends", 3).alias("ends"))


@query("""SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS number, 'e' || lpad(CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS VARCHAR), 4, '0') AS event_id FROM orders""")
def q68_event_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.discover import number_in

    n = number_in("o_custkey", order=["o_orderdate", "o_orderkey"])
    return table(spark, sf_dir, "orders").withColumn("number", n).select("o_custkey", "o_orderkey", "number", F.concat(F.lit("e"), F.lpad(F.col("number").cast("string"), 4, "0")).alias("event_id"))


ITEMS = """ev AS (SELECT o_custkey, o_orderkey AS event_id, o_orderkey % 2 AS shot, (o_orderkey % 97) * 1.5::DOUBLE AS onset, (o_orderkey % 97) * 1.5::DOUBLE + (o_orderkey % 7) * 0.75::DOUBLE AS settle FROM orders),
b AS (SELECT e.*, (SELECT max(o.settle) FROM ev o WHERE o.o_custkey = e.o_custkey AND o.shot = e.shot AND o.event_id <> e.event_id AND o.settle <= e.onset) AS earlier, (SELECT min(o.onset) FROM ev o WHERE o.o_custkey = e.o_custkey AND o.shot = e.shot AND o.event_id <> e.event_id AND o.onset >= e.settle) AS later FROM ev e),
x AS (SELECT *, least(greatest(0.1::DOUBLE, onset - 2, coalesce(earlier + 0.3, 0.1::DOUBLE)), onset - 1) AS s, least(greatest(least(159.75::DOUBLE, settle + 1.5, coalesce(later - 0.3, 159.75::DOUBLE)), settle + 0.4), 159.75::DOUBLE) AS t FROM b)"""


@query(f"""WITH {ITEMS} SELECT event_id AS clip_id, round(s, 3) AS "start", round(least(t, s + 30), 3) AS "end", round(onset - round(s, 3), 3) AS onset_at, round(settle - round(s, 3), 3) AS settle_at FROM x WHERE event_id % 3 <> 0""")
def q69_delivery_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips with their event and shot, bounded by the other events of the shot, with anchors from the clip's start."""
    c = F.col
    at = (c("o_orderkey") % 97) * F.lit(1.5)
    e = table(spark, sf_dir, "orders").select("o_custkey", c("o_orderkey").alias("event_id"), (c("o_orderkey") % 2).alias("source_shot_id"), at.alias("motion_onset"), (at + (c("o_orderkey") % 7) * F.lit(0.75)).alias("settle_time"))
    e = e.withColumns({"motion_peak": c("motion_onset"), "clip_start": c("motion_onset") - 1, "clip_end": c("settle_time") + 0.4})
    shots = e.select("o_custkey", c("source_shot_id").alias("shot_id"), F.lit(0.0).alias("start"), F.lit(160.0).alias("end")).distinct()
    clips = e.where("event_id % 3 <> 0").select("o_custkey", c("event_id").alias("clip_id"), "clip_start")
    return delivery.delivery_items(clips, e, shots, ["o_custkey"]).select("clip_id", "start", "end", "onset_at", "settle_at")


@query(f"""WITH {FUNNEL}, r AS (SELECT l_suppkey, status, context, seconds AS shots, shots AS cf, complete, final, start_incomplete AS bad_start, discontinuous, l_suppkey % 7 AS removed, CASE WHEN l_suppkey % 4 <> 0 THEN seconds END AS length FROM decided),
x AS (SELECT *, coalesce(round(cf / nullif(shots, 0), 4), 0) AS center_field_rate, coalesce(round(complete / nullif(cf, 0), 4), 0) AS complete_yield, coalesce(round(final / nullif(cf, 0), 4), 0) AS final_yield,
    coalesce(round(final / nullif(coalesce(length, 0) / 60.0::DOUBLE, 0), 4), 0) AS clips_per_source_minute FROM r)
SELECT l_suppkey, center_field_rate, complete_yield, final_yield, clips_per_source_minute, coalesce(length, 0) > 0 AS timed, CASE WHEN l_suppkey % 6 = 0 THEN 'checked' END AS note,
    CASE WHEN status <> 'ok' THEN CASE WHEN context = 'non_mlb' THEN 'SOURCE_NOT_MLB' WHEN shots = 0 THEN 'UNKNOWN' WHEN center_field_rate < 0.3 THEN 'LOW_CENTER_FIELD_COVERAGE' WHEN bad_start > 0 THEN 'HIGH_START_INCOMPLETE'
        WHEN complete = 0 AND final = 0 THEN 'ZERO_USABLE_EVENTS' WHEN complete_yield < 0.05 THEN 'LOW_COMPLETE_EVENT_YIELD' WHEN length < 180 THEN 'SOURCE_TOO_SHORT' WHEN discontinuous / shots >= 0.05 THEN 'SOURCE_BAD_EDITING' ELSE 'UNKNOWN' END END AS failure,
    coalesce(removed / nullif(removed + final, 0)::DOUBLE > 0.3, false) AS dedup_warning FROM x""")
def q70_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a report over runs, with durations and notes given from outside."""
    c = F.col
    f = funnel(spark, sf_dir).select(c("l_suppkey").alias("video_id"), c("seconds").cast("double").alias("shot_count"), c("shots").alias("center_field_candidates"), c("complete").alias("complete_events"), c("final").alias("final_clip_count"), "status", c("context").alias("competition_context"),
        c("start_incomplete").alias("rejected_start_incomplete"), F.lit(0).alias("rejected_end_incomplete"), F.lit(0).alias("rejected_no_complete_pitch"), c("discontinuous").alias("rejected_discontinuity"), (c("l_suppkey") % 7).alias("duplicate_rejected"))
    durations = f.where("video_id % 4 <> 0").select("video_id", c("shot_count").alias("seconds"))
    notes = f.where("video_id % 6 = 0").select("video_id", F.lit("checked").alias("note"))
    rows = replay.report_rows(f, durations, notes).withColumn("timed", F.coalesce("seconds", F.lit(0.0)) > 0)
    return rows.select(c("video_id").alias("l_suppkey"), "center_field_rate", "complete_yield", "final_yield", "clips_per_source_minute", "timed", "note", "failure", "dedup_warning")
