"""Classification, years, contexts, plans, tiers and reports on small rows."""

import functools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamarack.functions import score, text, vector
from tamarack.operators import discover, gate, graph, neardup, purity, report


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


TYPES = [
    ("Ace full outing vs rivals", "", 1200.0, "full_outing"), ("Every pitch from the ace", "", 300.0, "every_pitch"), ("FULL GAME HIGHLIGHTS", "", 600.0, "general_highlights"),
    ("Full game | Highlights", "", 7200.0, "full_game"), ("Ace strikeout highlights", "", 300.0, "pitching_highlights"), ("Ace interview", "", 300.0, "interview"),
    ("A title", "", 60.0, "short"), ("A title", "", None, "unknown"), ("Season recap", "", 400.0, "recap"), ("The best mix", "", 400.0, "montage"),
]


@pytest.mark.parametrize("title, about, seconds, wanted", TYPES)
def test_source_type(spark, title, about, seconds, wanted):
    assert one(spark, text.source_type(F.lit(title), F.lit(about), F.lit(seconds).cast("double"), F.lit(""))) == wanted


def test_context(spark):
    ctx = lambda t, d="", c="": one(spark, text.context(F.lit(t), F.lit(d), F.lit(c)))
    assert ctx("Ace at the World Baseball Classic") == "non_mlb"
    assert ctx("Ace out of the bullpen, every pitch") == "mlb"
    assert ctx("Ace bullpen session") == "non_mlb"
    assert ctx("Ace") == "unknown" and ctx("Ace", "", "MLB") == "mlb"


YEARS = [
    ("Start on June 15, 2024", "", None, 2024, "high"), ("Start 2023-05-01", "", None, 2023, "high"), ("2022 highlights", "", None, 2022, "high"), ("Top plays 2021", "", None, 2021, "medium"),
    ("Ace", "in season 2020", None, 2020, "medium"), ("Ace", "", "2019-01-02", 2019, "low"), ("Ace", "", None, None, "null"), ("Ace", "Subscribe January 19, 2000", None, None, "null"),
]


@pytest.mark.parametrize("title, about, published, year, sure", YEARS)
def test_year(spark, title, about, published, year, sure):
    assert tuple(one(spark, text.year_and_confidence(F.lit(title), F.lit(about), F.lit(published).cast("string")))) == (year, sure)


def test_risk_terms_do_not_count_twice(spark):
    assert one(spark, score.risk_terms(F.lit("Highlights"), F.lit(None).cast("string"))) == ["highlights"]


def test_duration_score(spark):
    got = [one(spark, score.duration_score(F.lit(s).cast("double"))) for s in (None, 65, 480, 2700, 10800, 20000)]
    assert got == [0.4, 0.0, 1.0, 1.0, pytest.approx(0.3), 0.3]


def test_names(spark):
    assert one(spark, text.safe_name(F.lit("  José  Ramírez! "))) == "Jos_Ramrez"
    assert one(spark, text.file_stem(F.lit("A B"), F.lit(2024), F.lit("low"))) == "A_B_UnknownYear"


def test_plans(spark):
    df = spark.createDataFrame([(1, 1800.0), (2, 100.0), (3, 40.0), (4, None)], "id int, duration double")
    got = {}
    for r in discover.plan_segments(df).orderBy("id", "index").collect():
        got.setdefault(r.id, []).append(r.start)
    assert got == {1: [170.0, 530.0, 890.0, 1250.0, 1610.0], 2: [0.0, 20.0, 60.0], 3: [10.0], 4: [60.0, 360.0, 660.0]}
    taken = spark.createDataFrame([(1, 170.0, 190.0), (1, 700.0, 730.0)], "id int, start double, end double")
    more = discover.plan_expansion(df.where("id = 1"), taken, ["id"])
    assert [r.start for r in more.orderBy("index").collect()] == [350.0, 1070.0, 1430.0]


def test_blank_name_is_an_error(spark):
    with pytest.raises(Exception, match="empty name"):
        discover.build_queries(spark.createDataFrame([("  ",)], "name string")).collect()


def test_dedup_hits(spark):
    hits = spark.createDataFrame([("a", "q1", 0), ("b", "q1", 1), ("a", "q2", 2), ("", "q3", 3), ("a", "q1", 4)], "id string, _query_source string, ord int")
    assert {(r.id, r._query_source) for r in discover.dedup_hits(hits).collect()} == {("a", "q1 + q2"), ("b", "q1")}


def test_delivery_rule_keeps_unknown(spark):
    cases = [(0.38, 3.0, True), (0.43, 3.0, False), (0.46, 1.0, True), (0.46, 2.0, False), (0.50, 1.0, False), (None, 0.5, False)]
    assert all(one(spark, purity.no_delivery(F.lit(s).cast("double"), F.lit(a))) == wanted for s, a, wanted in cases)


def test_evidence_and_budget(spark):
    e = lambda *a: one(spark, gate.evidence(*[F.lit(x) for x in a]))
    assert [e(1, 0, 1, 0, 0), e(5, 1, 4, 0, 0), e(8, 0, 6, 0, 0), e(8, 0, 1, 2, 0)] == ["insufficient", "sufficient_good", "sufficient_bad", "sufficient_bad"]
    b = lambda n, s, d: one(spark, gate.budget_ok(F.lit(n), F.lit(s), F.lit(d).cast("double")))
    assert [b(5, 100, 1800), b(10, 100, 1800), b(5, 200, 1800), b(5, 100, 200), b(0, 0, None)] == [True, False, False, False, True]


def test_framing_leaves_one_out(spark):
    rows = [("s", f"p{k}", [1.0, 0.01 * k], 0.8, True) for k in range(5)] + [("s", "x", [0.0, 1.0], 0.3, True)]
    df = spark.createDataFrame(rows, "source string, shot_id string, embedding array<double>, margin double, accepted boolean")
    got = {r.shot_id: r.framing_score for r in purity.framing_scores(df).collect()}
    assert got["p0"] is None and got["x"] is not None and got["x"] < 0.9
    after = {r.shot_id: r.accepted for r in purity.with_framing(df, purity.framing_scores(df)).collect()}
    assert after == {**{f"p{k}": True for k in range(5)}, "x": False}


def test_near_duplicate_resolution(spark):
    rows = [("v", "a", [1, 2], 0.0, 5.0, 5.0), ("v", "b", [1, 2], 19.0, 24.0, 5.0), ("v", "c", [1, 2], 400.0, 405.0, 5.0), ("v", "d", [-1, 77], 410.0, 415.0, 5.0), ("v", "e", None, None, None, 5.0)]
    df = spark.createDataFrame(rows, "source string, clip_id string, frame_hashes array<long>, clip_start double, clip_end double, duration double")
    got = {r.clip_id: (r.status, r.duplicate_of) for r in neardup.resolve(df).collect()}
    assert got == {"a": ("flagged", None), "b": ("removed", "a"), "c": ("flagged", None), "d": ("kept", None), "e": ("kept", None)}


def plain_resolution(rows, gap=60.0, most=8.0, tolerance=0.25):
    """{clip: (status, duplicate_of, confidence, reason)} of one source by a loop over all pairs."""
    rows = sorted(rows, key=lambda r: (r[3] is None, r[3] or 0.0, r[1]))
    lost, flagged = {}, set()
    for n, a in enumerate(rows):
        for b in rows[n + 1 :]:
            if a[1] in lost:
                break
            if b[1] in lost:
                continue
            known = None not in (a[3], a[4], b[3], b[4])
            loser, winner = (a, b) if a[5] < b[5] else (b, a)
            if known and a[4] > b[3] and b[4] > a[3]:
                lost[loser[1]] = (winner[1], 1.0, "time-overlap")
            elif a[2] and b[2]:
                bits = [((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(a[2], b[2])]
                mean = sum(bits) / len(bits)
                if mean <= most and abs(a[5] - b[5]) / max(a[5], b[5], 1e-6) <= tolerance:
                    if known and max(0.0, b[3] - a[4], a[3] - b[4]) <= gap:
                        lost[loser[1]] = (winner[1], round(1 - mean / 64, 3), "near-identical-frames")
                    else:
                        flagged |= {a[1], b[1]}
    out = {}
    for r in rows:
        kept = r[1]
        while kept in lost:
            kept = lost[kept][0]
        out[r[1]] = ("removed", kept, *lost[r[1]][1:]) if r[1] in lost else ("flagged" if r[1] in flagged else "kept", None, None, None)
    return out


def test_resolution_by_all_pairs(spark):
    rng = random.Random(6)
    looks = [[rng.getrandbits(64) - 2**63 for _ in range(8)] for _ in range(4)]
    rows = []
    for s in range(8):
        for k in range(60):
            base = rng.choice(looks)
            hashes = [h ^ sum(1 << k for k in rng.sample(range(63), rng.choice([0, 2, 6, 9, 12]))) for h in base][: rng.choice([8, 8, 8, 3])]
            start = rng.choice([None, *[round(rng.uniform(0, 900), 1)] * 12])
            length = rng.choice([4.0, 5.0, 5.5, 8.0])
            rows.append((f"s{s}", f"c{k:02d}", rng.choice([hashes] * 9 + [None, []]), start, None if start is None or rng.random() < 0.05 else start + length, length))
    df = spark.createDataFrame(rows, "source string, clip_id string, frame_hashes array<long>, clip_start double, clip_end double, duration double")
    got = {}
    for r in neardup.resolve(df).collect():
        got.setdefault(r.source, {})[r.clip_id] = (r.status, r.duplicate_of, r.confidence, r.reason)
    assert got == {s: plain_resolution([r for r in rows if r[0] == s]) for s in got} and len(got) == 8
    kinds = [v[0] + str(v[3]) for s in got.values() for v in s.values()]
    assert len(set(kinds)) == 4 and neardup.resolve(df.where("false")).count() == 0


def test_resolution_keeps_no_row_for_a_pair(spark, monkeypatch):
    n, sizes = 600, {}
    clips = spark.range(n).selectExpr("'s' AS source", "format_string('c%04d', id) AS clip_id", "array(7L, 9L) AS frame_hashes", "id * 1000.0D AS clip_start", "id * 1000.0D + 5 AS clip_end", "5.0D AS duration")

    def counted(df, label):
        out = stored(df, label)
        sizes[label] = out.count()
        return out

    stored = neardup.stored
    monkeypatch.setattr(neardup, "stored", counted)
    assert {r.status for r in neardup.resolve(clips).collect()} == {"flagged"} and max(sizes.values()) <= n


def test_resolution_over_several_blocks(spark, monkeypatch):
    rng = random.Random(8)
    looks = [[rng.getrandbits(64) - 2**63 for _ in range(3)] for _ in range(12)]
    rows = []
    for s, n in (("a", 61), ("b", 7), ("c", 1)):
        for k in range(n):
            hashes = [h ^ sum(1 << k for k in rng.sample(range(63), rng.choice([0, 3, 9]))) for h in rng.choice(looks)]
            rows.append((s, f"c{k:02d}", rng.choice([hashes] * 5 + [hashes[:2]]), k * 40.0 + 0.5, k * 40.0 + 6, rng.choice([5.0, 5.5])))
    df = spark.createDataFrame(rows, "source string, clip_id string, frame_hashes array<long>, clip_start double, clip_end double, duration double")
    monkeypatch.setattr(neardup, "flagged", functools.partial(neardup.flagged, block=8))
    got = {(r.source, r.clip_id): (r.status, r.duplicate_of, r.confidence, r.reason) for r in neardup.resolve(df).collect()}
    assert got == {(s, k): v for s in "abc" for k, v in plain_resolution([r for r in rows if r[0] == s]).items()}
    assert {v[0] for v in got.values()} == {"flagged", "kept", "removed"}


def test_losses_of_many_runs(spark):
    rng, rows, wanted = random.Random(11), [], set()
    for source in ("a", "b"):
        gone = set()
        for i in range(0, 9000, 3):
            for j in rng.sample(range(i + 1, i + 8), 2) if i % 30 == 0 else (i + 1,):
                loser, winner = rng.sample((i, j), 2)
                rows.append((source, i, j, loser, winner))
        for s, i, j, loser, winner in sorted(r for r in rows if r[0] == source):
            if i not in gone and j not in gone:
                gone.add(loser)
                wanted.add((s, loser, winner, i, j))
    rng.shuffle(rows)
    got = neardup.losses(spark.createDataFrame(rows, "source string, i long, j long, loser long, winner long"), ["source"])
    assert got.columns == ["source", "lost", "to", "i", "j"] and sorted(map(tuple, got.collect())) == sorted(wanted)
    assert "FlatMapGroups" not in got._jdf.queryExecution().executedPlan().toString()  # a call of Python for each run


def test_blocks_by_strips_and_by_pairs(monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(neardup, "STRIP", 3)
    kind = pa.list_(pa.struct([("place", pa.int64()), ("s", pa.float64()), ("e", pa.float64()), ("d", pa.float64()), ("li", pa.int64()), ("lj", pa.int64()), ("h", pa.list_(pa.int64()))]))
    looks = [rng.getrandbits(64) - 2**63 for _ in range(3)]

    def row(place, lost=False):
        start = rng.choice([None, place * 30.0, place * 30.0])
        li, lj = rng.choice([(None, None), (rng.randrange(20), rng.randrange(20, 40))]) if lost else (None, None)
        hashes = [None if rng.random() < 0.05 else rng.choice(looks) for _ in range(rng.choice([1, 1, 2, 4]))]
        return {"place": place, "s": start, "e": None if start is None else start + 8, "d": rng.choice([5.0, 6.0, 8.0, None]), "li": li, "lj": lj, "h": hashes}

    def plain(a, b):
        i, j = sorted((a["place"], b["place"]))
        pairs = list(zip(a["h"], b["h"]))
        if i == j or None in (x for p in pairs for x in p) or None in (a["d"], b["d"]):
            return False
        known = None not in (a["s"], b["s"])
        near = known and max(0.0, b["s"] - a["e"], a["s"] - b["e"]) <= 60
        alike = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in pairs) / len(pairs) <= 8
        return alike and not near and abs(a["d"] - b["d"]) / max(a["d"], b["d"]) <= 0.25 and (b["li"] is None or (b["li"], b["lj"]) > (i, j))

    sets = [([row(k) for k in rng.sample(range(40), m)], [row(k, True) for k in rng.sample(range(40), n)]) for m, n in ((1, 1), (5, 2), (11, 17), (2, 30))]
    wanted = [sorted(x["place"] for x in a if any(plain(x, y) for y in b)) for a, b in sets]
    a, b = pa.array([[], *[x[0] for x in sets]], kind)[1:], pa.array([[], *[x[1] for x in sets]], kind)[1:]
    by_pairs = list(zip(*[x.tolist() for x in neardup.flags_of_small(a, b, 60.0, 8.0, 0.25)]))
    assert [sorted(p for k, p in by_pairs if k == n) for n in range(4)] == wanted and sum(map(len, wanted)) > 5
    for x, y, w in zip(a, b, wanted):
        mine = neardup.Clips(x.values)
        assert sorted(mine.place[neardup.flags(mine, neardup.Clips(y.values), 60.0, 8.0, 0.25)].tolist()) == w


def test_chains_of_pointers(spark):
    links = [(k, k + 1) for k in range(40)] + [(1000, 1001), (1001, 1002), (1002, 1000), (5000, 5000)]
    got = {r.node: (r.last, r.steps) for r in graph.chase(spark.createDataFrame(links, "node long, to long")).collect()}
    assert all(got[k] == (40, 40 - k) for k in range(40)) and got[1000] == (1002, 2) and 5000 not in got
    assert graph.chase(spark.createDataFrame([], "node string, to string")).count() == 0


def test_long_chains_and_circles_of_pointers(spark):
    rng = random.Random(4)
    links = {k: k + 1 for k in range(700)} | {10_000 + k: 10_000 + (k + 1) % 90 for k in range(90)} | {20_000 + k: 20_000 + rng.randrange(300) for k in range(300)}
    links |= {30_000 + k: 30_000 + k + 1 for k in range(50)} | {30_050: 10_007}
    wanted = {}
    for node in links:
        met = [node]
        while links.get(met[-1], met[-1]) not in met:
            met.append(links[met[-1]])
        if len(met) > 1:
            wanted[node] = (met[-1], len(met) - 1)
    spark.sparkContext.setJobGroup("chase", "chase")
    try:
        got = graph.chase(spark.createDataFrame(list(links.items()), "node long, to long")).collect()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("chase"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == len(wanted) and {r.node: (r.last, r.steps) for r in got} == wanted
    assert jobs < 300  # not one or more for each step of the longest chain
    named = spark.createDataFrame([(("a", 1), ("a", 2)), (("a", 2), ("a", 1)), (("b", 1), ("a", 1)), (("c", 1), ("c", 0))], "node struct<s: string, k: long>, to struct<s: string, k: long>")
    assert {tuple(r.node): (tuple(r.last), r.steps) for r in graph.chase(named).collect()} == {("a", 1): (("a", 2), 1), ("a", 2): (("a", 1), 1), ("b", 1): (("a", 2), 2), ("c", 1): (("c", 0), 1)}


def test_clip_bounds(spark):
    rows = [("p001", "s0", 0.0, 10.0, 2.0, 3.0, 4.5, 4.9), ("p002", "s0", 0.0, 10.0, 5.0, 6.0, 7.5, 7.9), ("p003", "s1", 10.0, 20.0, 10.2, 11.0, 12.5, 12.9)]
    df = spark.createDataFrame(rows, "event_id string, shot string, shot_start double, shot_end double, clip_start double, onset double, settle double, clip_end double")
    got = [(r.start, r.end) for r in report.clip_bounds(df, ["shot"]).orderBy("event_id").collect()]
    assert got == [(1.0, 5.7), (4.8, 9.0), (10.1, 14.0)]


def test_vectors(spark):
    assert one(spark, vector.time_gap(F.lit(0.0), F.lit(5.0), F.lit(19.0), F.lit(24.0))) == 14.0
    assert one(spark, vector.time_gap(F.lit(0.0), F.lit(None).cast("double"), F.lit(19.0), F.lit(24.0))) is None
    assert one(spark, vector.best_class(F.create_map(F.lit("a"), F.lit(0.5), F.lit("b"), F.lit(0.5)))) == "a"
