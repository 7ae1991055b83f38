"""Evaluation: precision and recall in several groupings, complements, parameter grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(truth: Column, predicted: Column) -> dict[str, Column]:
    return {"tp": F.count_if(truth & predicted), "fp": F.count_if(~truth & predicted), "fn": F.count_if(truth & ~predicted), "tn": F.count_if(~truth & ~predicted)}


def rates(counts: DataFrame) -> DataFrame:
    """counts (tp, fp, fn, ...) with precision, recall and f1; 0 where undefined."""
    div = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    tp = F.col("tp")
    p, r = div(tp, tp + F.col("fp")), div(tp, tp + F.col("fn"))
    return counts.withColumns({"precision": F.round(p, 6), "recall": F.round(r, 6), "f1": F.round(div(2 * p * r, p + r), 6)})


def grouped(rows: DataFrame, truth: str, predicted: str, sets: list[list[str]]) -> DataFrame:
    """Rates of each grouping set in one pass; columns of other sets are null."""
    cols = [F.col(c) for c in dict.fromkeys(c for s in sets for c in s)]
    counted = rows.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(*[v.alias(k) for k, v in confusion(F.col(truth), F.col(predicted)).items()])
    return rates(counted)


def leave_one_out(rows: DataFrame, group: str, value: str) -> DataFrame:
    """For each group the sorted values that any other group has: a value stays out only where no group but this one has it."""
    each = rows.select(group, value).where(F.col(value).isNotNull()).distinct()
    held = rows.select(F.col(group).alias("held")).where("held IS NOT NULL").distinct()
    owners = each.groupBy(value).agg(F.count(F.lit(1)).alias("__n"), F.min(group).alias("__owner"))
    # One list of all values, as long as a single row of the result; each group takes out what is its own alone.
    all_ = owners.agg(F.array_sort(F.collect_list(value)).alias("__all"))
    own = owners.where("__n = 1").groupBy(F.col("__owner").alias("held")).agg(F.collect_list(value).alias("__own"))
    lists = held.join(own, "held", "left").join(F.broadcast(all_))
    return lists.select("held", F.array_except("__all", F.coalesce("__own", F.array().cast(rows.select(F.array(value)).schema[0].dataType))).alias("others"))


def unmatched(predictions: DataFrame, matches: DataFrame, id_col: str) -> DataFrame:
    """Predictions that no truth was matched with: false positives, of no group."""
    return predictions.join(matches.where(F.col(id_col).isNotNull()).select(id_col).distinct(), id_col, "left_anti")


def over_grid(rows: DataFrame, grid: list[dict], truth: Column, predicted) -> DataFrame:
    """Rates of each configuration of a literal grid; predicted(config columns) is evaluated for all of them in one scan."""
    spec = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in g.items()]) for g in grid])
    each = rows.select("*", F.posexplode(spec).alias("config", "__g"))
    counted = each.groupBy("config", *[F.col(f"__g.{k}").alias(k) for k in grid[0]]).agg(*[v.alias(k) for k, v in confusion(truth, predicted(F.col("__g"))).items()])
    return rates(counted)
