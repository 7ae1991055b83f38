"""Discovery: queries, hits, enrichment, ranking, filters and sampling plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import score, text
from ..rules import domain


def build_queries(names: DataFrame, name_col: str = "name", limit: int = 5, templates: list[str] | None = None) -> DataFrame:
    """names with a row for each template: ord, query, limit. A blank name is an error."""
    name = F.trim(F.regexp_replace(F.col(name_col), r"\s+", " "))
    checked = F.when(F.coalesce(name, F.lit("")) == "", F.raise_error(F.lit("empty name"))).otherwise(name)
    filled = F.array(*[F.replace(F.lit(t), F.lit("{}"), checked) for t in templates or domain.QUERIES])
    return names.select("*", F.posexplode(filled).alias("ord", "query")).withColumn("limit", F.lit(limit))


def normalize(hits: DataFrame, watch_url: str = "https://www.youtube.com/watch?v=") -> DataFrame:
    """Raw metadata (id, title, channel, uploader, webpage_url, duration, upload_date, description, _query_source) as candidates."""
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    empty = F.lit("")
    return hits.select(
        F.coalesce("id", empty).alias("video_id"), F.coalesce("title", empty).alias("title"), F.coalesce(blank("channel"), blank("uploader"), empty).alias("channel"),
        F.coalesce(blank("webpage_url"), F.concat(F.lit(watch_url), F.coalesce("id", empty))).alias("url"), F.col("duration").cast("double").alias("duration"),
        text.iso_date(F.col("upload_date")).alias("published_date"), F.left(F.coalesce("description", empty), F.lit(500)).alias("description_excerpt"), F.coalesce("_query_source", empty).alias("query_source"),
    )


def enrich(candidates: DataFrame, pack=domain, scores=domain, terms: list[str] | None = None) -> DataFrame:
    """Candidates with source_type, competition_context, game_year, game_year_confidence, suitability and selection_reason."""
    c = F.col
    typed = candidates.withColumn("source_type", text.source_type(c("title"), c("description_excerpt"), c("duration"), c("url"), pack))
    typed = typed.withColumn("competition_context", text.context(c("title"), c("description_excerpt"), c("channel"), pack))
    dated = typed.withColumn("__y", text.year_and_confidence(c("title"), c("description_excerpt"), c("published_date")))
    scored = dated.withColumn("suitability", score.suitability(c("source_type"), c("title"), c("description_excerpt"), c("channel"), c("duration"), pack=scores, terms=terms))
    out = scored.withColumn("selection_reason", score.selection_reason(c("source_type"), c("suitability"), c("channel")))
    return out.withColumn("game_year", c("__y.year")).withColumn("game_year_confidence", c("__y.confidence")).drop("__y")


def dedup_hits(hits: DataFrame, id_col: str = "id", source_col: str = "_query_source", ord_col: str = "ord") -> DataFrame:
    """One row an id, that of the least ord, with the distinct sources of all in order of first sight; rows without an id go."""
    named = hits.where(F.coalesce(F.col(id_col), F.lit("")) != "")
    each = named.groupBy(id_col, source_col).agg(F.min(ord_col).alias("__first"))
    merged = each.groupBy(id_col).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__first", source_col))), lambda x: x[source_col]), " + ").alias(f"{source_col}s"), F.min("__first").alias("__ord"))
    firsts = named.join(merged, (named[id_col] == merged[id_col]) & (named[ord_col] == merged["__ord"])).drop(merged[id_col])
    return firsts.drop(source_col, "__ord").withColumnRenamed(f"{source_col}s", source_col)


def rank(candidates: DataFrame, score_col: str, *ties: str, top: int | None = None) -> DataFrame:
    """The candidates by score, ties in the order given; top: so many of them."""
    ordered = candidates.orderBy(F.col(score_col).desc(), *ties)
    return ordered if top is None else ordered.limit(top)


def year_ok(year: Column, confidence: Column, published: Column, wanted: int) -> Column:
    """A reliable year must be the wanted one; without it the publication year must not be earlier, or be unknown."""
    sure, shown = text.reliable_year(year, confidence), F.left(F.coalesce(published, F.lit("")), F.lit(4))
    return F.when(sure.isNotNull(), sure == wanted).otherwise(~(shown.rlike("^[0-9]+$") & (F.coalesce(shown.try_cast("int"), F.lit(9999)) < wanted)))


def or_all(rows: DataFrame, flag: str, *group: str) -> DataFrame:
    """Rows whose flag holds, or all rows of a group in which it holds for none."""
    any_ok = rows.groupBy(*group).agg(F.max(F.coalesce(F.col(flag), F.lit(False))).alias("__any"))
    joined = rows.crossJoin(F.broadcast(any_ok)) if not group else rows.join(any_ok, list(group))
    return joined.where(F.coalesce(F.col(flag), F.lit(False)) | ~F.col("__any")).drop("__any")


def exclusion_reason(ctx: Column, kind: Column, outside: str = "non_mlb") -> Column:
    return F.when(ctx == outside, outside).when(kind == "full_game", "full_game (both teams' pitchers)")


# Where segments are taken, as fractions of the duration.
FRACTIONS, ROUND_2, ROUND_3 = (0.10, 0.30, 0.50, 0.70, 0.90), (0.20, 0.40, 0.60, 0.80), (0.05, 0.25, 0.45, 0.65, 0.85)


def segment_start(seconds: Column, fraction: Column, length: float = 20.0) -> Column:
    return F.round(F.greatest(F.lit(0.0), F.least(seconds * fraction - length / 2, seconds - length)), 1)


def plan_segments(sources: DataFrame, seconds_col: str = "duration", length: float = 20.0) -> DataFrame:
    """sources with a row for each segment (index, start, length) to look at."""
    d = F.col(seconds_col).cast("double")
    at = lambda fs: F.array(*[F.struct(segment_start(d, F.lit(f), length).alias("start"), F.lit(length).alias("length")) for f in fs])
    unknown = F.array(*[F.struct(F.lit(60.0 + 300.0 * k).alias("start"), F.lit(length).alias("length")) for k in range(3)])
    single = F.array(F.struct(F.greatest(F.lit(0.0), d / 2 - length / 2).alias("start"), F.least(F.lit(length), d).alias("length")))
    plan = F.when(d.isNull() | (d <= 0), unknown).when(d < 60, single).when(d < 150, at([FRACTIONS[0], FRACTIONS[1], FRACTIONS[3]])).otherwise(at(FRACTIONS))
    return sources.select("*", F.posexplode(plan).alias("index", "__p")).select(*sources.columns, "index", "__p.start", "__p.length")


def plan_expansion(sources: DataFrame, taken: DataFrame, keys: list[str], seconds_col: str = "duration", fractions: tuple = ROUND_2, length: float = 20.0, slack: float = 1.0) -> DataFrame:
    """Further segments (index, start, length) that meet none of those taken (keys, start, end) within a second."""
    d = F.col(seconds_col).cast("double")
    plans = sources.select(*keys, seconds_col, F.posexplode(F.array(*[F.lit(f) for f in fractions])).alias("index", "fraction"))
    plans = plans.withColumn("exact", F.greatest(F.lit(0.0), F.least(d * F.col("fraction") - length / 2, d - length)))
    used = taken.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("start").alias("__s"), F.col("end").alias("__e"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"__{k}"))
    free = plans.join(used, same & (F.col("__s") < F.col("exact") + length + slack) & (F.col("exact") < F.col("__e") + slack), "left_anti")
    return free.select(*keys, "index", F.round("exact", 1).alias("start"), F.lit(length).alias("length"))


def number_in(*group: str, order: list) -> Column:
    return F.row_number().over(Window.partitionBy(*group).orderBy(*order))
