"""Table functions of SQL and exact quantiles."""

import random

import numpy as np
import pytest

from tamarack.functions import generators
from tamarack.operators import discover, report


def test_segments_of_any_duration(spark):
    generators.register(spark)
    rows = [(k, d) for k, d in enumerate([None, 0.0, -3.0, 1.0, 19.5, 40.0, 59.9, 60.0, 100.0, 149.9, 150.0, 333.3, 1800.0, 7205.25, 0.25])]
    df = spark.createDataFrame(rows, "id int, duration double")
    got = spark.sql("SELECT id, s.* FROM {df}, LATERAL plan_segments(duration, 20.0D) s", df=df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, discover.plan_segments(df).drop("duration").collect()))


def test_what_the_analysis_refuses(spark):
    generators.register(spark)
    for sql in ("SELECT * FROM plan_segments('x', 20.0D)", "SELECT * FROM build_queries('a', 0)", "SELECT * FROM build_queries(1, 5)", "SELECT * FROM plan_expansion(TABLE(SELECT 1 AS a))"):
        with pytest.raises(Exception, match="not|constant|give a table"):
            spark.sql(sql).collect()
    with pytest.raises(Exception, match="empty name"):
        spark.sql("SELECT * FROM build_queries('  ', 5)").collect()
    assert spark.sql("SELECT query FROM build_queries(' A   B ', 5)").first()[0].startswith("A B ")


def test_exact_quantiles(spark):
    rng = random.Random(1)
    groups = {"spread": [rng.gauss(0, 100) for _ in range(20_000)], "few": [rng.choice([1.0, 2.0, 2.5]) for _ in range(9000)], "hot": [7.0] * 15_000 + [rng.random() * 14 for _ in range(300)], "one": [4.0], "two": [1.0, 2.0], "none": [None, None]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("spread", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    shares = [0.0, 0.01, 0.5, 0.9, 0.999, 1.0]
    got = {r.g: r for r in report.exact_quantiles(df, ["g"], "v", shares, accuracy=100).collect()}
    assert set(got) == set(groups) - {"none"}
    for g, r in got.items():
        assert r.n == len(groups[g]) and np.allclose(r.quantiles, np.quantile(groups[g], shares), rtol=1e-12, atol=1e-9)


def test_quantiles_where_the_sketch_is_wrong(spark, monkeypatch):
    """Brackets that miss are noticed, and the group is computed in full."""
    from pyspark.sql import functions as F

    df = spark.range(1000).selectExpr("id % 2 AS g", "double(id) AS v")
    monkeypatch.setattr(report.F, "percentile_approx", lambda x, probes, accuracy: F.array(*[F.lit(5.0 + k % 2) for k in range(len(probes))]))
    got = {r.g: r.quantiles for r in report.exact_quantiles(df, ["g"], "v", [0.5, 0.9]).collect()}
    assert np.allclose(got[0], np.quantile(np.arange(0, 1000, 2), [0.5, 0.9])) and np.allclose(got[1], np.quantile(np.arange(1, 1000, 2), [0.5, 0.9]))
