"""The event machine and signal operators on small signals."""

import random

import pytest

from tamarack.operators.events import Params, Shot, localize
from tamarack.operators.signal import shots_of, spikes


def v(text):
    """Values such as ".1x10 .4 .6"."""
    out = []
    for part in text.split():
        value, _, times = part.partition("x")
        out += [float(value)] * int(times or 1)
    return out


def results(text, params=None, end=None):
    x = v(text)
    t = [k / 10 for k in range(len(x))]
    return list(Shot(t, x, 0.0, end if end is not None else len(x) / 10, params or Params()).results())


CASES = [
    (".1x10 .4 .6 .8 .7 .6 .55 .35x9 .1x10", ["event"], None),
    (".7x12 .2x10", ["start_incomplete"], None),
    (".1x10 .6x12", ["end_incomplete"], None),
    (".1x8 .35x3 .1x8 .4x2 .1x10", ["no_complete_pitch"], None),
    (".5 .4 .1x10 .5 .7 .9 .8 .7 .6 .5 .45 .4 .35 .2 .1x9", ["event"], None),
    (".6x25", ["start_incomplete"], None),
    (".1x10 .5 .7 .9 .8 .6 .5 .38 .35 .33 .36 .34 .35 .33 .34", ["event"], None),
    (".12x30", ["no_complete_pitch"], None),
    (".1x4", ["shot_too_short"], None),
]


@pytest.mark.parametrize("text, kinds, end", CASES)
def test_cases(text, kinds, end):
    assert [r[0] if r[0] == "event" else r[-1] for r in results(text, end=end)] == kinds


def test_lead_artefact_is_not_the_onset():
    (event,) = results(".5 .4 .1x10 .5 .7 .9 .8 .7 .6 .5 .45 .4 .35 .2 .1x9")
    assert event[2] >= 0.4 and event[1] <= event[2] <= event[3] <= event[4] <= event[5]


def test_absolute_completion():
    p = Params(relative=False)
    assert [r[0] for r in results(".1x10 .5x9 .1x10", p)] == ["event"]
    assert results(".1x10 .5x12", p)[0][-1] == "end_incomplete"


def test_grouped_over_any_partitioning(spark):
    rows = [(s, k / 10, x, 0.0, 4.4) for s in ("a", "b") for k, x in enumerate(v(".1x10 .4 .6 .8 .7 .6 .55 .35x9 .1x10"))]
    df = spark.createDataFrame(rows, "shot_id string, t double, smoothed double, shot_start double, shot_end double")
    once, again = (sorted(map(tuple, localize(df.repartition(n)).collect())) for n in (1, 7))
    assert once == again and [r[1] for r in once] == ["event", "event"]


def fold(cuts, length, gap=0.4):
    """Shots by a loop over the cuts."""
    bounds = [0.0]
    for c in sorted(cuts):
        if c - bounds[-1] >= gap:
            bounds.append(c)
    shots = []
    for a, b in zip(bounds, [*bounds[1:], length]):
        if b <= a:
            continue
        if shots and (b - a < gap or shots[-1][1] - shots[-1][0] < gap):
            shots[-1] = (shots[-1][0], b)
        else:
            shots.append((a, b))
    return shots


def test_cuts_and_slivers(spark):
    rng = random.Random(4)
    cases = [([], 5.0), ([2.0, 2.1, 3.0], 5.0), ([0.2, 2.0], 2.1), ([0.0, 0.25, 0.5], 0.5), ([], 0.0), ([1.0, 1.0, 1.0], 1.0)]
    cases += [([rng.randrange(4000) / 8 for _ in range(rng.choice([1, 5, 60, 700]))], 500.0) for _ in range(25)]
    rows = [(k, c, True) for k, (cuts, _) in enumerate(cases) for c in cuts] + [(k, n, False) for k, (_, n) in enumerate(cases)]
    got = {}
    for r in shots_of(spark.createDataFrame(rows, "g int, t double, cut boolean"), ["g"], "t", "cut").orderBy("g", "shot").collect():
        got.setdefault(r.g, []).append((r.start, r.end))
        assert r.shot == len(got[r.g]) - 1
    assert got == {k: s for k, (cuts, n) in enumerate(cases) if (s := fold(cuts, n))}
    assert got[0] == [(0.0, 5.0)] and got[1] == [(0.0, 2.0), (2.0, 3.0), (3.0, 5.0)] and got[2] == [(0.0, 2.1)] and 4 not in got


def test_jump_cut(spark):
    rows = [(0, k, 8.0 if k == 50 else 1.0) for k in range(100)]
    out = spikes(spark.createDataFrame(rows, "g int, k int, x double"), ["g"], ["k"], "x").where("is_spike").collect()
    assert [r.k for r in out] == [50]
