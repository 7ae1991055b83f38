"""Queries of discovery: classification, years, scores, ranking, provenance, plans, names."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import generators, score, text
from ..operators import discover
from ..rules import domain, generic
from .registry import ORACLES, any_of, query, table

#: The default scores over channels that the driver's tables have.
SCORES = SimpleNamespace(OFFICIAL=["src1"], MEDIA=["src2"], GENERIC=["src3", "src4"], RISKY=["sh", "she", "the", "ß", "###", "eaux", "ción"], SEMANTIC=domain.SEMANTIC, HOLD=domain.HOLD, WEIGHTS=domain.WEIGHTS)

CANDIDATES = """cand AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, source AS channel,
    CASE WHEN doc_id % 10 = 0 THEN 'http://v/shorts/' ELSE 'http://v/' END || CAST(doc_id AS VARCHAR) AS url,
    CASE WHEN doc_id % 17 <> 0 THEN CAST(n_chars AS DOUBLE) END AS duration, left(text, 500) AS description_excerpt FROM documents)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id", F.substring_index("text", "\n", 1).alias("title"), F.col("source").alias("channel"),
        F.concat(F.when(F.col("doc_id") % 10 == 0, "http://v/shorts/").otherwise("http://v/"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("doc_id") % 17 != 0, F.col("n_chars").cast("double")).alias("duration"), F.left("text", F.lit(500)).alias("description_excerpt"),
    )


def _type_sql(pack) -> str:
    wording = {n: p for n, p, _ in pack.PRIORITY}
    t = "lower(title || chr(10) || description_excerpt)"
    hinted, high = any_of(t, pack.HINTS), any_of(t, wording["general_highlights"])
    tier = f"CASE WHEN {hinted} THEN 'pitching_highlights' ELSE 'general_highlights' END"
    out = [f"WHEN {high} AND {any_of(t, wording[n])} THEN CASE WHEN duration >= {s} THEN '{n}' ELSE {tier} END" for n, s in pack.LONG_FORMS]
    out += [f"WHEN {any_of(t, p)} THEN " + (tier if n == "general_highlights" else f"'{n}'") for n, p, _ in pack.PRIORITY]
    return f"CASE {' '.join(out)} WHEN duration <= 65 OR contains(url, '/shorts/') THEN 'short' WHEN {hinted} THEN 'pitching_highlights' ELSE 'unknown' END"


def _context_sql(pack) -> str:
    t = f"regexp_replace(lower(title || chr(10) || description_excerpt), '{pack.RELIEF}', ' ', 'g')"
    a, b, c = pack.CONTEXTS
    return f"CASE WHEN {any_of(t, pack.OUTSIDE)} THEN '{a}' WHEN {any_of('lower(title || chr(10) || channel)', pack.INSIDE)} THEN '{b}' ELSE '{c}' END"


def _case(kind: str, scores: dict) -> str:
    return f"CASE {kind} {' '.join(f'WHEN {k!r} THEN {v}' for k, v in scores.items())} ELSE 0.4 END::DOUBLE"


TERMS = "[" + ", ".join(f"'{t}'" for t in SCORES.RISKY) + "]"
HITS = f"list_filter({TERMS}, lambda t: contains(lower(title || chr(10) || description_excerpt), t))"
DURATION = """CASE WHEN duration IS NULL THEN 0.4 WHEN duration <= 65 THEN 0.0 WHEN duration < 480 THEN 0.3::DOUBLE + 0.7::DOUBLE * (duration - 65) / 415.0::DOUBLE
    WHEN duration <= 2700 THEN 1.0 WHEN duration <= 10800 THEN greatest(0.3::DOUBLE, 1.0::DOUBLE - (duration - 2700) / 8100.0::DOUBLE * 0.7::DOUBLE) ELSE 0.3 END::DOUBLE"""
SCORED = f"""typed AS (SELECT *, {_type_sql(generic)} AS source_type, {HITS} AS hits FROM cand),
parts AS (SELECT *, round({_case('source_type', domain.SEMANTIC)}, 3) AS semantic_score,
    CASE WHEN source_type = 'full_game' AND duration < 1800 THEN 0.4 WHEN source_type IN ('full_outing', 'full_start') AND duration < 480 THEN 0.5 ELSE 1.0 END::DOUBLE AS duration_sanity_factor,
    round({DURATION}, 3) AS duration_score,
    CASE WHEN contains(lower(channel), 'src1') THEN 1.0 WHEN contains(lower(channel), 'src2') THEN 0.6 WHEN contains(lower(channel), 'src3') OR contains(lower(channel), 'src4') THEN 0.7 ELSE 0.4 END::DOUBLE AS source_score,
    round(CASE WHEN duration > 1200 THEN least(1.0::DOUBLE, {_case('source_type', domain.HOLD)} + 0.1::DOUBLE) ELSE {_case('source_type', domain.HOLD)} END, 3) AS hold_score,
    list_filter(hits, lambda t: NOT list_contains(list_transform(hits, lambda o: o <> t AND contains(o, t)), true)) AS risk FROM typed),
risked AS (SELECT *, least(1.0::DOUBLE, len(risk) / 3.0::DOUBLE) AS share FROM parts),
scored AS (SELECT *, round(CASE WHEN duration <= 65 THEN greatest(share, 0.9::DOUBLE) WHEN duration < 180 THEN greatest(share, 0.4::DOUBLE) ELSE share END, 3) AS editing_risk FROM risked),
final AS (SELECT *, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.35::DOUBLE * semantic_score * duration_sanity_factor + 0.2::DOUBLE * duration_score + 0.2::DOUBLE * source_score + 0.15::DOUBLE * hold_score - 0.35::DOUBLE * editing_risk)) + 1e-9, 4) AS final_score FROM scored)"""


@query("SELECT n_name AS name, CAST(ord AS INT) AS ord, replace(t, '{}', n_name) AS query, 5 AS \"limit\" FROM nation, (VALUES " + ", ".join(f"({k}, '{t}')" for k, t in enumerate(domain.QUERIES)) + ") v(ord, t)")
def q01_build_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.build_queries(table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")))


@query("""SELECT CAST(doc_id AS VARCHAR) AS video_id, split_part(text, chr(10), 1) AS title, source AS channel, 'https://www.youtube.com/watch?v=' || CAST(doc_id AS VARCHAR) AS url,
    CAST(n_chars AS DOUBLE) AS duration, CASE WHEN doc_id % 5 <> 0 THEN '2024-' || lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0') || '-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') END AS published_date,
    left(text, 500) AS description_excerpt, lang AS query_source FROM documents""")
def q02_normalize_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = lambda e: F.lpad(F.expr(e).cast("string"), 2, "0")
    day = F.when(F.expr("doc_id % 5 != 0"), F.concat(F.lit("2024"), two("doc_id % 12 + 1"), two("doc_id % 28 + 1"))).otherwise("2024")
    raw = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.substring_index("text", "\n", 1).alias("title"), F.lit("").alias("channel"), F.col("source").alias("uploader"), F.lit(None).cast("string").alias("webpage_url"), F.col("n_chars").alias("duration"), day.alias("upload_date"), F.col("text").alias("description"), F.col("lang").alias("_query_source"))
    return discover.normalize(raw)


@query(f"WITH {CANDIDATES} SELECT doc_id, {_type_sql(generic)} AS source_type FROM cand")
def q03_classify_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).select("doc_id", text.source_type(F.col("title"), F.col("description_excerpt"), F.col("duration"), F.col("url"), generic).alias("source_type"))


@query(f"WITH {CANDIDATES} SELECT doc_id, {_context_sql(generic)} AS competition_context FROM cand")
def q04_context_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).select("doc_id", text.context(F.col("title"), F.col("description_excerpt"), F.col("channel"), generic).alias("competition_context"))


TITLED = """titled AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Order of ' || strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN 'Season ' || strftime(o_orderdate, '%Y') || ' order'
    WHEN 2 THEN 'Shipped March 4, ' || strftime(o_orderdate, '%Y') WHEN 3 THEN strftime(o_orderdate, '%Y') || ' highlights' WHEN 4 THEN 'Order' ELSE 'on ' || strftime(o_orderdate, '%m/%d/%Y') END AS title,
    CASE WHEN o_orderkey % 4 = 0 THEN 'text of season ' || strftime(o_orderdate, '%Y') ELSE 'Subscribe 2001-01-01' END AS description,
    CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS published FROM orders)"""


def _titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    y, k = F.date_format("o_orderdate", "yyyy"), F.col("o_orderkey")
    title = (
        F.when(k % 6 == 0, F.concat(F.lit("Order of "), F.date_format("o_orderdate", "yyyy-MM-dd"))).when(k % 6 == 1, F.concat(F.lit("Season "), y, F.lit(" order")))
        .when(k % 6 == 2, F.concat(F.lit("Shipped March 4, "), y)).when(k % 6 == 3, F.concat(y, F.lit(" highlights"))).when(k % 6 == 4, "Order").otherwise(F.concat(F.lit("on "), F.date_format("o_orderdate", "MM/dd/yyyy")))
    )
    about = F.when(k % 4 == 0, F.concat(F.lit("text of season "), y)).otherwise("Subscribe 2001-01-01")
    return table(spark, sf_dir, "orders").select("o_orderkey", title.alias("title"), about.alias("description"), F.when(k % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("published"))


YEARS = """years AS (SELECT *, nullif(regexp_extract(core, '\\b((?:19|20)[0-9]{2})[-/][0-9]{1,2}[-/][0-9]{1,2}\\b', 1), '') AS a,
    nullif(regexp_extract(core, '\\b[0-9]{1,2}[-/][0-9]{1,2}[-/]((?:19|20)[0-9]{2})\\b', 1), '') AS b, nullif(regexp_extract(core, '(?i)\\b((?:19|20)[0-9]{2})\\s+(?:highlights|outing|start|game)\\b', 1), '') AS c,
    CASE WHEN regexp_matches(core, '(?i)\\b(?:march)\\b\\.?\\s+[0-9]{1,2}(?:st|nd|rd|th)?,?\\s+(?:19|20)[0-9]{2}') THEN nullif(regexp_extract(core, '((?:19|20)[0-9]{2})', 1), '') END AS m,
    nullif(regexp_extract(title, '\\b((?:19|20)[0-9]{2})\\b', 1), '') AS t, nullif(regexp_extract(title || chr(10) || description, '(?i)\\bseason\\s+((?:19|20)[0-9]{2})\\b', 1), '') AS s, left(published, 4) AS p
    FROM (SELECT *, title || chr(10) || CASE WHEN contains(description, 'Subscribe') THEN left(description, strpos(description, 'Subscribe') - 1) ELSE left(description, 300) END AS core FROM titled)),
dated AS (SELECT *, CAST(coalesce(m, a, b, c, t, s, p) AS INT) AS game_year, CASE WHEN coalesce(m, a, b, c) IS NOT NULL THEN 'high' WHEN coalesce(t, s) IS NOT NULL THEN 'medium' WHEN p IS NOT NULL THEN 'low' ELSE 'null' END AS game_year_confidence FROM years)"""


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _titled(spark, sf_dir)
    return t.withColumn("y", text.year_and_confidence(F.col("title"), F.col("description"), F.col("published"))).select("*", F.col("y.year").alias("game_year"), F.col("y.confidence").alias("game_year_confidence")).drop("y")


@query(f"WITH {TITLED}, {YEARS} SELECT o_orderkey, game_year, game_year_confidence, CASE WHEN game_year_confidence IN ('high', 'medium') THEN game_year END AS reliable_year FROM dated")
def q05_extract_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _dated(spark, sf_dir)
    return d.select("o_orderkey", "game_year", "game_year_confidence", text.reliable_year(F.col("game_year"), F.col("game_year_confidence")).alias("reliable_year"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    typed = candidates(spark, sf_dir).withColumn("source_type", text.source_type(c("title"), c("description_excerpt"), c("duration"), c("url"), generic))
    return typed.withColumn("s", score.suitability(c("source_type"), c("title"), c("description_excerpt"), c("channel"), c("duration"), pack=SCORES))


@query(f"WITH {CANDIDATES}, {SCORED} SELECT doc_id, source_type, semantic_score, duration_sanity_factor, duration_score, source_score, hold_score, editing_risk, final_score FROM final")
def q06_score_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("doc_id", "source_type", *[f"s.{x}" for x in ("semantic_score", "duration_sanity_factor", "duration_score", "source_score", "hold_score", "editing_risk", "final_score")])


@query(f"WITH {CANDIDATES}, {SCORED} SELECT doc_id, array_to_string(risk, ',') AS terms, CAST(len(risk) AS INT) AS n FROM final")
def q07_risk_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score.risk_terms(F.col("title"), F.col("description_excerpt"), SCORES.RISKY)
    return candidates(spark, sf_dir).withColumn("r", found).select("doc_id", F.array_join("r", ",").alias("terms"), F.size("r").alias("n"))


@query(f"WITH {CANDIDATES}, {SCORED} SELECT doc_id, source_type, final_score FROM final ORDER BY final_score DESC, doc_id LIMIT 10")
def q08_rank_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.rank(_scored(spark, sf_dir).select("doc_id", "source_type", "s.final_score"), "final_score", "doc_id", top=10)


@query("""WITH f AS (SELECT sha256(text) AS id, source, min(doc_id) AS first FROM documents GROUP BY 1, 2)
SELECT id, min(first) AS ord, string_agg(source, ' + ' ORDER BY first, source) AS source FROM f GROUP BY id""")
def q09_dedup_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("id"), "source", F.col("doc_id").alias("ord"))
    return discover.dedup_hits(hits, source_col="source").select("id", "ord", "source")


PLANS = """plans AS (SELECT p_partkey, d, CAST(i AS INT) AS index, CASE WHEN d IS NULL THEN 60.0 + 300.0 * i WHEN d < 60 THEN greatest(0.0, d / 2 - 10) ELSE round(greatest(0.0, least(d * f - 10, d - 20)), 1) END::DOUBLE AS start,
    CASE WHEN d < 60 THEN least(20.0, d) ELSE 20.0 END::DOUBLE AS length
    FROM (SELECT p_partkey, CASE WHEN p_size % 9 <> 0 THEN CAST(p_size * p_size AS DOUBLE) END AS d FROM part), (VALUES (0, 0.1::DOUBLE, 0.1::DOUBLE), (1, 0.3::DOUBLE, 0.3::DOUBLE), (2, 0.5::DOUBLE, 0.7::DOUBLE), (3, 0.7::DOUBLE, NULL), (4, 0.9::DOUBLE, NULL)) v(i, f5, f3),
    LATERAL (SELECT CASE WHEN d < 150 THEN f3 ELSE f5 END AS f) WHERE CASE WHEN d IS NULL THEN i < 3 WHEN d < 60 THEN i = 0 WHEN d < 150 THEN i < 3 ELSE true END)"""


def _timed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 9 != 0, (F.col("p_size") * F.col("p_size")).cast("double")).alias("duration"))


@query(f"WITH {PLANS} SELECT p_partkey, index, start, length FROM plans")
def q10_plan_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.plan_segments(_timed_parts(spark, sf_dir)).drop("duration")


@query(f"""WITH {PLANS}, more AS (SELECT p_partkey, CAST(i AS INT) AS index, greatest(0.0, least(d * f - 10, d - 20)) AS exact
    FROM (SELECT p_partkey, CAST(p_size * p_size AS DOUBLE) AS d FROM part WHERE p_size % 9 <> 0), (VALUES (0, 0.2::DOUBLE), (1, 0.4::DOUBLE), (2, 0.6::DOUBLE), (3, 0.8::DOUBLE)) v(i, f))
SELECT p_partkey, index, round(exact, 1) AS start, 20.0::DOUBLE AS length FROM more m
WHERE NOT EXISTS (SELECT 1 FROM plans p WHERE p.p_partkey = m.p_partkey AND p.start < m.exact + 21 AND m.exact < p.start + p.length + 1)""")
def q11_plan_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _timed_parts(spark, sf_dir)
    taken = discover.plan_segments(parts).select("p_partkey", "start", (F.col("start") + F.col("length")).alias("end"))
    return discover.plan_expansion(parts.where("duration IS NOT NULL"), taken, ["p_partkey"])


@query(f"""WITH {TITLED}, {YEARS}, ok AS (SELECT o_custkey, d.o_orderkey, coalesce(CASE WHEN game_year_confidence IN ('high', 'medium') THEN game_year = 1996 ELSE published IS NULL OR CAST(left(published, 4) AS INT) >= 1996 END, false) AS fits FROM dated d JOIN orders USING (o_orderkey))
SELECT o_custkey, o_orderkey, fits FROM (SELECT *, max(fits::INT) OVER (PARTITION BY o_custkey) AS any_ok FROM ok) WHERE fits OR any_ok = 0""")
def q33_year_filter_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _dated(spark, sf_dir).join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    fits = discover.year_ok(F.col("game_year"), F.col("game_year_confidence"), F.col("published"), 1996)
    return discover.or_all(d.select("o_custkey", "o_orderkey", fits.alias("fits")), "fits", "o_custkey")


@query("""WITH s AS (SELECT c_custkey, 'Cust_' || CAST(c_nationkey AS VARCHAR) || '_' || CASE WHEN c_custkey % 3 = 0 THEN 'UnknownYear' ELSE '2024' END AS stem FROM customer),
n AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY c_custkey) - 1 AS k FROM s)
SELECT c_custkey, stem || CASE WHEN k = 0 THEN '' WHEN k < 100 THEN '_' || lpad(CAST(k AS VARCHAR), 2, '0') ELSE '_' || CAST(k AS VARCHAR) END || '.mp4' AS filename FROM n""")
def q49_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    name = F.concat(F.lit("  Cust  "), F.col("c_nationkey").cast("string"), F.lit("é!"))
    stem = text.file_stem(name, F.lit(2024), F.when(F.col("c_custkey") % 3 == 0, "low").otherwise("high"))
    k = discover.number_in("stem", order=["c_custkey"]) - 1
    suffix = F.when(F.col("k") == 0, "").when(F.col("k") < 100, F.concat(F.lit("_"), F.lpad(F.col("k").cast("string"), 2, "0"))).otherwise(F.concat(F.lit("_"), F.col("k").cast("string")))
    return c.select("c_custkey", stem.alias("stem")).withColumn("k", k).select("c_custkey", F.concat("stem", suffix, F.lit(".mp4")).alias("filename"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{\"id\":' || CAST(event_id AS VARCHAR) || ',\"kind\":\"' || event_type || '\"}' AS encoded FROM events")
def q50_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k bigint")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("encoded"))


@query(ORACLES["q01_build_queries"])
def q76_queries_lateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q01 as SQL over a table function."""
    generators.register(spark)
    return spark.sql("SELECT n_name AS name, q.* FROM {nation}, LATERAL build_queries(n_name, 5) q", nation=table(spark, sf_dir, "nation"))


@query(ORACLES["q10_plan_segments"])
def q77_segments_lateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q10 as SQL over a table function."""
    generators.register(spark)
    return spark.sql("SELECT p_partkey, s.* FROM {parts}, LATERAL plan_segments(duration, 20.0D) s", parts=_timed_parts(spark, sf_dir))


@query(ORACLES["q11_plan_expansion"])
def q78_expansion_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q11 as a table function over q10's rows, a part at a time."""
    generators.register(spark)
    parts = _timed_parts(spark, sf_dir).where("duration IS NOT NULL")
    plans = discover.plan_segments(parts).select(F.col("p_partkey").alias("key"), "duration", "start", "length")
    return spark.sql("SELECT key AS p_partkey, index, start, length FROM plan_expansion(TABLE(SELECT * FROM {plans}))", plans=plans)
