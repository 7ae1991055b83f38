"""python -m tamarack COMMAND: the stages of a run over files, and the registered queries.

query QUERY TABLES OUTPUT    a registered query over a folder of tables, stored as Parquet
discover HITS OUTPUT         search results (JSON lines) to ranked candidates, those selected and those excluded
run CANDIDATES ROOT          a whole run over what `discover` found, with the tools of a module: preview, production, finals, manifest, delivery
segments SELECTED OUTPUT     where to look into each selected source
locate SAMPLES OUTPUT        events and rejections of signal samples (CSV or Parquet)
deliver ITEMS ROOT BATCH     an immutable batch of items (Parquet) and its line in the index
evaluate ROWS OUTPUT         precision and recall, whole and by groups
summary RESULTS OUTPUT       what each run came to, from the results of its sources
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import QUERIES
from .functions import text
from .operators import discover, evaluate, events, product, run
from .sources import delivery, records


def _query(spark: SparkSession, a: argparse.Namespace) -> None:
    QUERIES[a.query](spark, a.tables).write.parquet(a.output)


def _discover(spark: SparkSession, a: argparse.Namespace) -> None:
    hits = records.json_lines(spark, a.hits, f"ord long, {records.CANDIDATE}")
    rows = discover.enrich(discover.normalize(discover.dedup_hits(hits)))
    rows = rows.withColumn("score", F.col("suitability.final_score"))
    if a.year is not None:
        rows = discover.or_all(rows.withColumn("__ok", discover.year_ok(F.col("game_year"), F.col("game_year_confidence"), F.col("published_date"), a.year)), "__ok").drop("__ok")
    rows.write.json(f"{a.output}/candidates")
    stored = spark.read.schema(rows.schema).json(f"{a.output}/candidates")
    order = [F.col("score").desc(), F.col("video_id")]
    run.eligible(stored, a.top, order).write.json(f"{a.output}/selected")
    run.excluded(stored).write.json(f"{a.output}/excluded")


def _run(spark: SparkSession, a: argparse.Namespace) -> None:
    module, _, name = a.tools.partition(":")
    tools = getattr(importlib.import_module(module), name or "tools")
    c = F.col
    found = spark.read.json(a.candidates)
    known = {"run_id": text.slug(F.lit(a.name)), "final_score": c("score"), "ord": F.lit(0), "given": F.lit(False)}
    rows = found.withColumns({k: v for k, v in known.items() if k not in found.columns})
    product.produce(spark, rows, tools(spark) if callable(tools) else tools, a.root, a.top, a.most, None if a.year is None else F.lit(a.year), a.least)
    if a.deliver:
        product.deliver(spark, a.root, a.deliver)


def _segments(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = spark.read.schema("video_id string, url string, duration double").json(a.selected)
    discover.plan_segments(rows).write.json(a.output)


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", True).csv(path) if path.endswith(".csv") else spark.read.parquet(path)


def _locate(spark: SparkSession, a: argparse.Namespace) -> None:
    c = F.col
    rows = _table(spark, a.samples).select(c("shot_id").cast("string"), c("t").cast("double"), c("smoothed").cast("double"), c("shot_start").cast("double"), c("shot_end").cast("double"))
    events.localize(rows, events.Params(relative=not a.absolute)).write.parquet(a.output)


def _deliver(spark: SparkSession, a: argparse.Namespace) -> None:
    print(delivery.deliver(_table(spark, a.items), a.root, a.batch, delivery.parse_exclusions(a.exclude), a.least, a.id))


def _evaluate(spark: SparkSession, a: argparse.Namespace) -> None:
    evaluate.grouped(_table(spark, a.rows), a.truth, a.predicted, [[], *[[c] for c in a.by]]).write.parquet(a.output)


def _summary(spark: SparkSession, a: argparse.Namespace) -> None:
    run.run_summary(_table(spark, a.results), ["run_id"]).write.parquet(a.output)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tamarack", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(required=True, metavar="COMMAND")

    def command(name: str, work, *places: str) -> argparse.ArgumentParser:
        own = sub.add_parser(name)
        own.set_defaults(work=work)
        for x in places:
            own.add_argument(x)
        return own

    q = sub.add_parser("query")
    q.set_defaults(work=_query)
    q.add_argument("query", choices=sorted(QUERIES))
    q.add_argument("tables")
    q.add_argument("output")
    d = command("discover", _discover, "hits", "output")
    d.add_argument("--top", type=int, default=3)
    d.add_argument("--year", type=int)
    d = command("run", _run, "candidates", "root")
    d.add_argument("--tools", required=True, metavar="MODULE:NAME", help="a product.Tools, or a function of the session that gives one")
    d.add_argument("--name", default="run")
    d.add_argument("--top", type=int, default=3)
    d.add_argument("--most", type=int, default=3)
    d.add_argument("--year", type=int)
    d.add_argument("--least", type=int, default=run.LEAST_CLIPS)
    d.add_argument("--deliver", metavar="ROOT")
    command("segments", _segments, "selected", "output")
    command("locate", _locate, "samples", "output").add_argument("--absolute", action="store_true")
    d = command("deliver", _deliver, "items", "root", "batch")
    d.add_argument("--exclude", action="append", default=[], metavar="ID=REASON")
    d.add_argument("--least", type=int, default=run.LEAST_CLIPS)
    d.add_argument("--id", default="item_id")
    e = command("evaluate", _evaluate, "rows", "output")
    e.add_argument("--truth", default="truth")
    e.add_argument("--predicted", default="predicted")
    e.add_argument("--by", action="append", default=[])
    command("summary", _summary, "results", "output")
    return p


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    a.work(SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate(), a)


if __name__ == "__main__":
    main()
