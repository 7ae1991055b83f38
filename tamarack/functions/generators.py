"""Plan generators as table functions of SQL: `SELECT ... FROM sources, LATERAL plan_segments(duration, 20.0)`.

They give the rows of `operators.discover`, for users of SQL; `register` puts them into a
session. Numbers are rounded half up, as SQL does.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from ..operators.discover import FRACTIONS, ROUND_2
from ..rules import domain

SEGMENT = StructType().add("index", IntegerType()).add("start", DoubleType()).add("length", DoubleType())
QUERY = StructType().add("ord", IntegerType()).add("query", StringType()).add("limit", IntegerType())


def _tenth(x: float) -> float:
    return float(Decimal(repr(x)).quantize(Decimal("0.1"), ROUND_HALF_UP))


def _number(arg: AnalyzeArgument, name: str) -> None:
    if arg.isTable or arg.dataType.typeName() not in ("double", "float", "integer", "long", "decimal", "void"):
        raise ValueError(f"{name} is a number, not {arg.dataType.simpleString()}")


class BuildQueries:
    """(ord, query, limit) of a name: one for each template."""

    @staticmethod
    def analyze(name: AnalyzeArgument, limit: AnalyzeArgument) -> AnalyzeResult:
        if name.isTable or name.dataType.typeName() != "string":
            raise ValueError(f"the name is a string, not {name.dataType.simpleString()}")
        if not limit.isConstantExpression or limit.value is None or limit.value < 1:
            raise ValueError("the limit is a constant of 1 or more")
        return AnalyzeResult(QUERY)

    def eval(self, name: str | None, limit: int) -> Iterator[tuple]:
        plain = " ".join((name or "").split())
        if not plain:
            raise ValueError("empty name")
        for k, template in enumerate(domain.QUERIES):
            yield k, template.replace("{}", plain), limit


class PlanSegments:
    """(index, start, length) of a duration: segments of about `length` seconds to look at."""

    @staticmethod
    def analyze(duration: AnalyzeArgument, length: AnalyzeArgument) -> AnalyzeResult:
        _number(duration, "the duration"), _number(length, "the length")
        return AnalyzeResult(SEGMENT)

    def eval(self, duration: float | None, length: float) -> Iterator[tuple]:
        d, length = None if duration is None else float(duration), float(length)
        if d is None or d <= 0:
            yield from ((k, 60.0 + 300.0 * k, length) for k in range(3))
        elif d < 60:
            yield 0, max(0.0, d / 2 - length / 2), min(length, d)
        else:
            for k, f in enumerate(FRACTIONS if d >= 150 else (FRACTIONS[0], FRACTIONS[1], FRACTIONS[3])):
                yield k, _tenth(max(0.0, min(d * f - length / 2, d - length))), length


class PlanExpansion:
    """(key, index, start, length) of a table (key, duration, start, length) PARTITION BY key: further segments, clear of its own by a second.

    Rows are a source's segments so far, or one with a null start where it has none; only what they take of the few
    possible segments is kept of them.
    """

    @staticmethod
    def analyze(plans: AnalyzeArgument) -> AnalyzeResult:
        if not plans.isTable or [f.name for f in plans.dataType] != ["key", "duration", "start", "length"]:
            raise ValueError("give a table of key, duration, start and length")
        schema = StructType([plans.dataType["key"], *SEGMENT])
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn("key")], orderBy=[OrderingColumn("start")])

    def __init__(self) -> None:
        self.key, self.free = None, None

    def eval(self, row) -> Iterator[tuple]:
        d, size = row["duration"], 20.0
        if self.free is None:
            self.key = row["key"]
            self.free = {} if d is None else {k: max(0.0, min(d * f - size / 2, d - size)) for k, f in enumerate(ROUND_2)}
        if row["start"] is not None:
            end = row["start"] + row["length"]
            self.free = {k: at for k, at in self.free.items() if not (row["start"] < at + size + 1.0 and at < end + 1.0)}
        return iter(())

    def terminate(self) -> Iterator[tuple]:
        for k, at in (self.free or {}).items():
            yield self.key, k, _tenth(at), 20.0


def register(spark: SparkSession) -> None:
    for name, kind in (("build_queries", BuildQueries), ("plan_segments", PlanSegments), ("plan_expansion", PlanExpansion)):
        spark.udtf.register(name, udtf(kind))
