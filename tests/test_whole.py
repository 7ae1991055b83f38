"""Queries that must give every row, against their rule in plain Python or SQL without a cap."""

import os

import duckdb
import numpy as np
import pytest

from tamarack.catalog import ORACLES, QUERIES
from tamarack.operators import purity

DATA = "/root/testdata"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_pool_is_whole(spark, sf):
    con = duckdb.connect()
    for t in ("supplier", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{sf}/{t}.parquet'")
    sql = ORACLES["q31_tiers"].replace(" LIMIT 50", "")
    wanted = con.execute(f"SELECT s_suppkey, tier, place FROM ({sql}) ORDER BY place").fetchall()
    got = QUERIES["q31_tiers"](spark, f"{DATA}/{sf}").orderBy("place").collect()
    assert len(wanted) > 50 and [tuple(r) for r in got] == wanted


def framing_wanted(rows, k=3, least=5):
    """{shot_id: (others, score)} of rows (source, shot_id, vector), all of them prototypes."""
    out = {}
    for source in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == source]
        e = np.array([r[2] for r in own], float)
        e /= np.maximum(np.linalg.norm(e, axis=1, keepdims=True), 1e-8)
        sims = e @ e.T
        np.fill_diagonal(sims, -np.inf)
        for r, s in zip(own, np.sort(sims, axis=1)[:, ::-1]):
            out[r[1]] = (len(own) - 1, s[:k].mean() if len(own) - 1 >= least else None)
    return out


def test_framing_sees_all_others(spark):
    held = spark.read.parquet(f"{DATA}/sf0.001/embeddings.parquet")
    wanted = framing_wanted([(r.label, r.vec_id, r.embedding) for r in held.collect()])
    got = {r.vec_id: r for r in QUERIES["q24_framing_knn"](spark, f"{DATA}/sf0.001").collect()}
    assert len(got) == len(wanted)
    for k, (others, score) in wanted.items():
        assert got[k].others == others and got[k].framing_score == pytest.approx(score, abs=6e-5)
        assert got[k].vetoed == (got[k].framing_score < 0.15)


def test_framing_in_blocks(spark):
    e = spark.read.parquet(f"{DATA}/sf0.001/embeddings.parquet").selectExpr("label AS source", "vec_id AS shot_id", "embedding", "true AS accepted", "1.0 AS margin")
    rows = [sorted(map(tuple, purity.framing_scores(e, block=b).collect())) for b in (7, 1000)]
    assert rows[0] == rows[1]
