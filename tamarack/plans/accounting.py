"""Queries of the gate, tiers, evaluation, reports and delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import evaluate, gate, report
from ..functions import text
from .registry import query, table

FUNNEL = """funnel AS (SELECT l_suppkey, count(*) * 3 AS shots, count(*) AS cf, count(*) FILTER (WHERE l_linestatus = 'F' AND l_quantity > 40) AS complete, count(*) FILTER (WHERE l_returnflag <> 'N') AS rejected,
    count(*) FILTER (WHERE l_returnflag = 'R' AND l_quantity < 20) AS discontinuous, count(*) FILTER (WHERE l_returnflag = 'A') AS start_incomplete, CAST(sum(l_quantity) AS DOUBLE) AS seconds, count(*) FILTER (WHERE l_discount > 0.08) AS final FROM lineitem GROUP BY l_suppkey),
rated AS (SELECT *, round(complete / greatest(cf, 1), 4) AS complete_event_yield, coalesce(round(complete * 60.0::DOUBLE / nullif(seconds, 0), 4), 0) AS events_per_minute, round(rejected / greatest(cf, 1), 4) AS incomplete_rate,
    round(discontinuous / greatest(cf, 1), 4) AS discontinuity_rate, round(cf / greatest(shots, 1), 3) AS center_field_ratio, CASE l_suppkey % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN 'non_mlb' ELSE 'mlb' END AS context, CASE WHEN l_suppkey % 11 = 0 THEN 'failed' ELSE 'ok' END AS status FROM funnel),
decided AS (SELECT *, CASE WHEN status = 'failed' OR context = 'non_mlb' OR cf = 0 THEN 'reject' WHEN complete >= 2 AND complete_event_yield >= 0.1 + 0.1 AND discontinuity_rate <= 0.2 THEN CASE WHEN context = 'unknown' THEN 'borderline' ELSE 'recommended' END
    WHEN (l_suppkey % 3 <> 0 AND complete >= 1) OR (center_field_ratio >= 0.4 AND discontinuity_rate <= 0.3) THEN 'borderline' ELSE 'reject' END AS decision,
    CASE WHEN l_suppkey % 3 <> 0 AND complete >= 1 THEN 'sufficient_good' WHEN cf >= 8 AND (rejected >= 6 OR discontinuous >= 2 OR start_incomplete >= 4) THEN 'sufficient_bad' ELSE 'insufficient' END AS evidence FROM rated)"""


def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.count_if
    c = F.col
    f = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        (F.count(F.lit(1)) * 3).alias("shots"), F.count(F.lit(1)).alias("cf"), one((c("l_linestatus") == "F") & (c("l_quantity") > 40)).alias("complete"), one(c("l_returnflag") != "N").alias("rejected"),
        one((c("l_returnflag") == "R") & (c("l_quantity") < 20)).alias("discontinuous"), one(c("l_returnflag") == "A").alias("start_incomplete"), F.sum("l_quantity").alias("seconds"), one(c("l_discount") > 0.08).alias("final"),
    )
    rated = f.withColumns(gate.metrics("cf", "shots", "complete", "rejected", "discontinuous", "seconds"))
    context = F.when(c("l_suppkey") % 5 == 0, "unknown").when(c("l_suppkey") % 5 == 1, "non_mlb").otherwise("mlb")
    rated = rated.withColumn("context", context).withColumn("status", F.when(c("l_suppkey") % 11 == 0, "failed").otherwise("ok"))
    decision = gate.decide(c("status"), c("context"), c("cf"), c("complete"), c("complete_event_yield"), c("discontinuity_rate"), c("center_field_ratio"))
    # Every third supplier counts as one without events unless it is recommended, so that all outcomes occur.
    lean = gate.decide(c("status"), c("context"), c("cf"), F.lit(0), c("complete_event_yield"), c("discontinuity_rate"), c("center_field_ratio"))
    good = (c("complete") >= 2) & (c("complete_event_yield") >= 0.20) & (c("discontinuity_rate") <= 0.20)
    rated = rated.withColumn("decision", F.when((c("l_suppkey") % 3 != 0) | good, decision).otherwise(lean))
    return rated.withColumn("evidence", gate.evidence(c("cf"), F.when(c("l_suppkey") % 3 != 0, c("complete")).otherwise(0), c("rejected"), c("discontinuous"), c("start_incomplete")))


@query(f"WITH {FUNNEL} SELECT l_suppkey, complete_event_yield, events_per_minute, incomplete_rate, discontinuity_rate, center_field_ratio, decision FROM decided")
def q28_gate_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel(spark, sf_dir).select("l_suppkey", "complete_event_yield", "events_per_minute", "incomplete_rate", "discontinuity_rate", "center_field_ratio", "decision")


@query(f"""WITH {FUNNEL} SELECT l_suppkey, evidence, rejected % 12 < 10 AND seconds % 400 < 200 AND NOT coalesce(shots % 500 > 0 AND seconds % 400 / nullif(shots % 500, 0) >= 0.5, false) AS may_expand,
    CASE WHEN shots <= 900 THEN '2,3' ELSE '2' END AS rounds FROM decided""")
def q29_evidence_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, c = funnel(spark, sf_dir), F.col
    may = gate.budget_ok(c("rejected") % 12, c("seconds") % 400, F.nullif(c("shots") % 500, F.lit(0)))
    return f.select("l_suppkey", "evidence", may.alias("may_expand"), F.array_join(F.transform(gate.expansion_rounds(c("shots")), lambda x: x.cast("string")), ",").alias("rounds"))


@query("""WITH m AS (SELECT l_suppkey, l_returnflag AS k, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, CAST(sum(q) AS DOUBLE) AS quantity, string_agg(k || '=' || CAST(n AS VARCHAR), ',' ORDER BY k) AS by_reason FROM m GROUP BY 1""")
def q30_partial_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial counts of two rounds (odd and even line numbers), merged."""
    li = table(spark, sf_dir, "lineitem")
    parts = li.groupBy("l_suppkey", (F.col("l_linenumber") % 2).alias("round"), "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
    merged = gate.merge_partials(parts, ["l_suppkey"], ["quantity"], "l_returnflag", "n")
    return merged.select("l_suppkey", "quantity", F.array_join(F.transform(F.map_entries("by_reason"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("by_reason"))


@query(f"""WITH {FUNNEL}, t AS (SELECT s.s_suppkey, CASE WHEN decision = 'recommended' THEN 1 WHEN decision = 'borderline' AND coalesce(context, 'unknown') <> 'non_mlb' THEN 2
    WHEN decision = 'reject' AND cf > 0 AND context <> 'non_mlb' AND status <> 'failed' AND evidence = 'insufficient' THEN 3 WHEN decision = 'reject' AND cf > 0 AND context <> 'non_mlb' AND status <> 'failed' AND evidence = 'sufficient_bad' THEN 4 END AS tier, complete, cf, s_acctbal
    FROM supplier s LEFT JOIN decided d ON s.s_suppkey = d.l_suppkey)
SELECT s_suppkey, CAST(tier AS INT) AS tier, CAST(row_number() OVER (ORDER BY tier, CASE WHEN tier <= 2 THEN complete ELSE cf END DESC, s_acctbal DESC, s_suppkey) AS INT) AS place FROM t WHERE tier IS NOT NULL ORDER BY place""")
def q31_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pool: tiers in turn, then events or shots, then score."""
    c = F.col
    s = table(spark, sf_dir, "supplier").join(funnel(spark, sf_dir), c("s_suppkey") == c("l_suppkey"), "left")
    t = s.withColumn("tier", gate.tier(c("decision"), c("evidence"), c("cf"), c("context"), c("status"))).where("tier IS NOT NULL").select("s_suppkey", "tier", "complete", "cf", "s_acctbal")
    order = gate.tier_order("tier", "complete", "cf", "s_acctbal", "s_suppkey")
    return gate.with_places(t, order, "s_suppkey").select("s_suppkey", "tier", "place")


@query("SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000 GROUP BY 1")
def q32_first_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)
    return gate.first_success(table(spark, sf_dir, "orders"), ["o_custkey"], ok, [F.col("o_orderdate"), F.col("o_orderkey")], "o_orderkey")


RATES = "round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0)) / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 0), 6) AS f1"


@query(f"""WITH r AS (SELECT source, lang, quality = 1 AS t, toxic = 0 AS p FROM labels JOIN documents USING (doc_id)),
c AS (SELECT source, lang, count(*) FILTER (WHERE t AND p) AS tp, count(*) FILTER (WHERE NOT t AND p) AS fp, count(*) FILTER (WHERE t AND NOT p) AS fn, count(*) FILTER (WHERE NOT t AND NOT p) AS tn FROM r GROUP BY GROUPING SETS ((source), (lang), ()))
SELECT *, {RATES} FROM c""")
def q35_precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "doc_id")
    return evaluate.grouped(j.select("source", "lang", (F.col("quality") == 1).alias("t"), (F.col("toxic") == 0).alias("p")), "t", "p", [["source"], ["lang"], []])


@query("SELECT r.r_regionkey AS held, string_agg(CAST(n.n_nationkey AS VARCHAR), ',' ORDER BY n.n_nationkey) AS others FROM region r JOIN nation n ON n.n_regionkey <> r.r_regionkey GROUP BY 1")
def q36_lopo(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = evaluate.leave_one_out(table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "held_of"), "held_of", "n_nationkey")
    return out.select("held", F.array_join(F.transform("others", lambda x: x.cast("string")), ",").alias("others"))


@query(f"""WITH g(config, cut, floor) AS (VALUES {", ".join(f"({k}, {20 * (k // 2 + 1)}, {k % 2 * 10})" for k in range(8))}),
c AS (SELECT config, cut, floor, count(*) FILTER (WHERE t AND p) AS tp, count(*) FILTER (WHERE NOT t AND p) AS fp, count(*) FILTER (WHERE t AND NOT p) AS fn, count(*) FILTER (WHERE NOT t AND NOT p) AS tn
    FROM (SELECT g.*, event_type = 'purchase' AS t, value >= floor AND value <= cut AS p FROM events, g) GROUP BY 1, 2, 3)
SELECT CAST(config AS INT) AS config, CAST(cut AS INT) AS cut, CAST(floor AS INT) AS floor, tp, fp, fn, tn, {RATES} FROM c""")
def q37_calibration_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = [{"cut": 20 * (k // 2 + 1), "floor": k % 2 * 10} for k in range(8)]
    return evaluate.over_grid(table(spark, sf_dir, "events").select("event_type", "value"), grid, F.col("event_type") == "purchase", lambda g: (F.col("value") >= g["floor"]) & (F.col("value") <= g["cut"]))


RATIOS = """ratios AS (SELECT *, CASE WHEN l_suppkey % 13 = 0 THEN 'failed-download' ELSE 'ok' END AS run_status, coalesce(round(cf / nullif(shots, 0), 4), 0) AS center_field_rate, coalesce(round(complete / nullif(cf, 0), 4), 0) AS complete_yield,
    coalesce(round(final / nullif(cf, 0), 4), 0) AS final_yield, coalesce(round(final / nullif(seconds / 60.0::DOUBLE, 0), 4), 0) AS clips_per_source_minute, discontinuous + start_incomplete AS bad FROM rated)"""


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    f = funnel(spark, sf_dir).withColumn("run_status", F.when(c("l_suppkey") % 13 == 0, "failed-download").otherwise("ok"))
    return f.withColumns(report.ratios(c("shots"), c("cf"), c("complete"), c("final"), c("seconds")))


@query(f"""WITH {FUNNEL}, {RATIOS} SELECT l_suppkey, center_field_rate, complete_yield, final_yield, clips_per_source_minute,
    CASE WHEN run_status = 'failed-download' THEN 'DOWNLOAD_FAILURE' WHEN context = 'non_mlb' THEN 'SOURCE_NOT_MLB' WHEN shots = 0 THEN 'UNKNOWN' WHEN center_field_rate < 0.3 THEN 'LOW_CENTER_FIELD_COVERAGE'
        WHEN start_incomplete / greatest(start_incomplete + discontinuous + final, 1) >= 0.5 THEN 'HIGH_START_INCOMPLETE' WHEN discontinuous / greatest(start_incomplete + discontinuous + final, 1) >= 0.5 THEN 'HIGH_END_INCOMPLETE'
        WHEN complete = 0 AND final = 0 THEN 'ZERO_USABLE_EVENTS' WHEN complete_yield < 0.05 THEN 'LOW_COMPLETE_EVENT_YIELD' WHEN seconds < 180 THEN 'SOURCE_TOO_SHORT' WHEN discontinuous / shots >= 0.05 THEN 'SOURCE_BAD_EDITING' ELSE 'UNKNOWN' END AS failure_taxonomy,
    start_incomplete / nullif(start_incomplete + final, 0) > 0.3 AS dedup_warning FROM ratios""")
def q38_ratios_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    kind = report.taxonomy(c("run_status"), c("context"), c("shots"), c("center_field_rate"), c("start_incomplete"), c("discontinuous"), c("final"), c("complete"), c("final"), c("complete_yield"), c("seconds"), c("discontinuous"))
    return _ratios(spark, sf_dir).select("l_suppkey", "center_field_rate", "complete_yield", "final_yield", "clips_per_source_minute", kind.alias("failure_taxonomy"), report.dedup_warning(c("start_incomplete"), c("final")).alias("dedup_warning"))


@query(f"""WITH {FUNNEL}, {RATIOS} SELECT l_suppkey, final > 30 OR cf > 100 OR complete_yield < 0.03 OR context = 'unknown' AS quality_warning,
    concat_ws('; ', CASE WHEN complete_yield < 0.03 THEN 'unusually low event yield' END, CASE WHEN final > 30 THEN 'many clips (' || CAST(final AS VARCHAR) || ')' END, CASE WHEN context = 'unknown' THEN 'context unknown' END, CASE WHEN cf > 100 THEN 'large source' END) AS warnings,
    CASE WHEN l_suppkey % 2 = 0 THEN 'created_utc,finals,milestone,pitcher,results,source_selection_mode,sources_attempted' ELSE 'created_utc,finals,milestone,pitcher,results,source_selection_mode,sources_attempted,status' END AS missing FROM ratios""")
def q39_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    found = report.listed(F.when(c("complete_yield") < 0.03, "unusually low event yield"), F.when(c("final") > 30, F.concat(F.lit("many clips ("), c("final").cast("string"), F.lit(")"))), F.when(c("context") == "unknown", "context unknown"), F.when(c("cf") > 100, "large source"))
    keys = F.when(c("l_suppkey") % 2 == 0, F.create_map(F.lit("run_id"), F.lit("1"), F.lit("status"), F.lit("1"), F.lit("final_clip_count"), F.lit("1"))).otherwise(F.create_map(F.lit("run_id"), F.lit("1"), F.lit("final_clip_count"), F.lit("1")))
    return _ratios(spark, sf_dir).withColumn("w", found).select("l_suppkey", (F.size("w") > 0).alias("quality_warning"), F.array_join("w", "; ").alias("warnings"), F.array_join(report.missing_keys(keys), ",").alias("missing"))


@query("""WITH m AS (SELECT label, round(embedding[1]::DOUBLE - list_max(embedding[2:7]::DOUBLE[]), 4) AS margin FROM embeddings)
SELECT label, CASE WHEN margin < 0 THEN 'negative' WHEN margin < 0.05 THEN '0.00-0.05' WHEN margin < 0.1 THEN '0.05-0.10' ELSE '0.10+' END AS band, count(*) AS n, min(margin) AS least FROM m GROUP BY 1, 2""")
def q40_margin_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.transform(F.slice("embedding", 1, 7), lambda x: x.cast("double"))
    m = table(spark, sf_dir, "embeddings").withColumn("v", values).select("label", F.round(F.col("v")[0] - F.array_max(F.slice("v", 2, 6)), 4).alias("margin"))
    band = F.when(F.col("margin") < 0, "negative").when(F.col("margin") < 0.05, "0.00-0.05").when(F.col("margin") < 0.1, "0.05-0.10").otherwise("0.10+")
    return m.groupBy("label", band.alias("band")).agg(F.count(F.lit(1)).alias("n"), F.min("margin").alias("least"))


@query("""WITH r AS (SELECT c_nationkey, c_custkey, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS lo, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS hi FROM customer)
SELECT c_nationkey, 'lowest' AS side, CAST(lo AS INT) AS rank, c_custkey, c_acctbal FROM r WHERE lo <= 5 UNION ALL SELECT c_nationkey, 'highest', CAST(hi AS INT), c_custkey, c_acctbal FROM r WHERE hi <= 5""")
def q41_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.extremes(table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", "c_custkey")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def q42_latest_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.latest(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "value"])


@query("SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99, max(l_extendedprice) AS most FROM lineitem GROUP BY 1")
def q43_order_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice")
    s = report.exact_quantiles(li, ["l_suppkey"], "l_extendedprice", [0.5, 0.9, 0.99, 1.0])
    return s.select("l_suppkey", *[F.round(F.col("quantiles")[k], 4).alias(n) for k, n in enumerate(("median", "p90", "p99"))], F.col("quantiles")[3].alias("most"))


@query("""WITH k AS (SELECT o_orderkey, l_linenumber, p_brand, l_quantity, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey WHERE l_returnflag <> 'R')
SELECT o_orderkey, l_linenumber, 'p' || CASE WHEN n < 100 THEN lpad(CAST(n AS VARCHAR), 2, '0') ELSE CAST(n AS VARCHAR) END AS item, sha256(CAST(o_orderkey AS VARCHAR) || ':' || p_brand || ':' || CAST(CAST(l_quantity AS INT) AS VARCHAR)) AS sha256 FROM k""")
def q44_delivery_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where("l_returnflag != 'R'").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    j = table(spark, sf_dir, "orders").select("o_orderkey").join(li, F.col("o_orderkey") == F.col("l_orderkey")).join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    n = F.row_number().over(Window.partitionBy("o_orderkey").orderBy("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"))
    item = F.concat(F.lit("p"), F.when(F.col("n") < 100, F.lpad(F.col("n").cast("string"), 2, "0")).otherwise(F.col("n").cast("string")))
    return j.withColumn("n", n).select("o_orderkey", "l_linenumber", item.alias("item"), F.sha2(F.concat_ws(":", F.col("o_orderkey").cast("string"), "p_brand", F.col("l_quantity").cast("int").cast("string")), 256).alias("sha256"))


@query("""WITH s AS (SELECT p_partkey, CASE WHEN p_size < 5 THEN 'small' WHEN p_retailprice > 1500 THEN 'dear' WHEN p_size > 45 THEN 'large' ELSE 'rest' END AS stratum FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY p_partkey) AS place FROM s)
SELECT p_partkey, stratum, CAST(place AS INT) AS place FROM r WHERE place <= CASE stratum WHEN 'small' THEN 10 WHEN 'dear' THEN 20 WHEN 'large' THEN 5 ELSE 0 END""")
def q45_stratified_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampling operator: its sizes are the feature."""
    c = F.col
    return report.stratified(table(spark, sf_dir, "part"), [("small", c("p_size") < 5, 10), ("dear", c("p_retailprice") > 1500, 20), ("large", c("p_size") > 45, 5)], "p_partkey")


@query("""SELECT c_custkey, 'with' AS side FROM customer c WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 150000)
UNION ALL SELECT c_custkey, 'without' FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def q46_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    on = F.col("c_custkey") == F.col("o_custkey")
    return c.join(o.where("o_totalprice > 150000"), on, "left_semi").withColumn("side", F.lit("with")).unionByName(c.join(o, on, "left_anti").withColumn("side", F.lit("without")))


@query("""SELECT 'tumbling' AS kind, CAST(NULL AS BIGINT) AS user_id, time_bucket(INTERVAL 10 MINUTE, ts) AS start, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 3
UNION ALL SELECT 'session', user_id, min(ts), count(*), round(sum(value), 2) FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
    SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""")
def q48_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling and session windows in batch; tamarack.streaming has the same over streams."""
    from ..streaming.windows import session_counts, tumbling_counts

    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    cols = ["kind", "user_id", "start", "n", "total"]
    tumbling = tumbling_counts(e, "10 minutes").withColumn("kind", F.lit("tumbling")).withColumn("user_id", F.lit(None).cast("long"))
    session = session_counts(e, "6 hours").withColumn("kind", F.lit("session"))
    both = tumbling.select(cols).unionByName(session.select(cols))
    return both.withColumn("start", F.col("start").cast("timestamp_ntz")).withColumn("total", F.round("total", 2))


@query("""SELECT source, lang, count(*) AS n, count(*) FILTER (WHERE l.quality IS NULL) AS unlabelled, max(strlen(text)) AS longest FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY CUBE (source, lang)""")
def q51_cube_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.octet_length("text").cast("long").alias("b"))
    j = d.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return j.cube("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality").isNull()).alias("unlabelled"), F.max("b").alias("longest"))


@query("SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_replace(regexp_replace(lower(regexp_extract(url, '^https?://([^/]+)', 1)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, sha256(html) AS sha256, strlen(html) AS n_bytes FROM pages")
def q52_page_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    return table(spark, sf_dir, "pages").select("page_id", host.alias("host"), text.slug(host).alias("slug"), F.sha2("html", 256).alias("sha256"), F.octet_length("html").cast("long").alias("n_bytes"))
