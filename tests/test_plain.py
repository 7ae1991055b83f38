"""Queries that SQL does not express, against plain Python over whole tables of sf0.01."""

import os

import pandas as pd
import pytest

from tamarack.catalog import QUERIES
from tamarack.operators import calibrate
from tamarack.operators.events import Params, Shot
from tamarack.plans import signals, streams

SF = "/root/testdata/sf0.01"
needs = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@needs
def test_q13_by_a_loop(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "ts", "event_id", "event_type").toPandas().sort_values(["user_id", "ts", "event_id"])
    wanted = {}
    for (user, day), g in rows.groupby(["user_id", rows.ts.dt.date]):
        kinds, t = g.event_type.tolist(), ((g.ts - g.ts.iloc[0]).dt.total_seconds()).tolist()
        last, cuts = 0.0, [0.0]
        for k in range(1, len(kinds)):
            changed = kinds[k] != kinds[k - 1] and (k + 1 == len(kinds) or kinds[k + 1] != kinds[k - 1])
            if changed and t[k] - last >= 1800:
                cuts.append(t[k])
                last = t[k]
        shots = []
        for a, b in zip(cuts, [*cuts[1:], t[-1]]):
            if b <= a:
                continue
            if shots and (b - a < 1800 or shots[-1][1] - shots[-1][0] < 1800):
                shots[-1] = (shots[-1][0], b)
            else:
                shots.append((a, b))
        for k, (a, b) in enumerate(shots):
            wanted[user, str(day), k] = (a, b)
    got = {(r.user_id, r.day, r.shot): (r.start, r.end) for r in QUERIES["q13_sliver_merge"](spark, SF).collect()}
    assert got.keys() == wanted.keys() and len(got) > 1000
    assert all(got[k] == pytest.approx(v, abs=1e-6) for k, v in wanted.items())


def absolute(t, x, start, end, p):
    """Kinds and times of absolute completion, a sample at a time."""
    n = len(t)
    if n < 5 or end - start < 1.5:
        return [("rejected", "shot_too_short")]
    run = anchor = None
    for k in range(n):
        run = None if x[k] > p.low else k if run is None else run
        if run is not None and t[k] - t[run] >= p.quiet_anchor:
            anchor = run
            break
    if anchor is None:
        return [("rejected", "start_incomplete")]
    out, k = [], anchor
    while k < n:
        while k < n and x[k] <= p.low:
            k += 1
        if k >= n:
            break
        onset = k
        first = onset
        while first > anchor and x[first - 1] <= p.low:
            first -= 1
        ready = t[onset - 1] - t[first] if first < onset else 0.0
        while k < n and x[k] > p.low:
            k += 1
        if ready < p.min_prepared:
            if t[onset] - start < p.min_prepared + p.quiet_anchor:
                out.append(("rejected", "start_incomplete"))
                return out
            anchor = k
            continue
        blob_end = k
        if max(x[onset:blob_end]) < p.high or t[blob_end - 1] - t[onset] < p.min_active:
            anchor = k
            continue
        if blob_end >= n:
            out.append(("rejected", "end_incomplete"))
            return out
        while k < n and x[k] <= p.low:
            k += 1
        if t[k - 1] - t[blob_end] < p.min_settle:
            if k >= n:
                out.append(("rejected", "end_incomplete"))
                return out
            anchor = k
            continue
        out.append(("event", t[onset], t[blob_end]))
        anchor = k
        if len(out) >= p.max_events:
            return out
    if not out:
        out.append(("rejected", "start_incomplete" if t[first_quiet(t, x, p)] - start >= p.pre_heat_min else "no_complete_pitch"))
    return out


def first_quiet(t, x, p):
    run = None
    for k in range(len(t)):
        run = None if x[k] > p.low else k if run is None else run
        if run is not None and t[k] - t[run] >= p.quiet_anchor:
            return run


@needs
def test_q17_by_a_loop(spark):
    p = Params(low=0.15, high=0.25, min_prepared=0.3, min_active=0.2, min_settle=0.2, quiet_anchor=0.2, relative=False)
    samples = signals._samples(spark, SF).toPandas().sort_values(["shot_id", "t"])
    wanted = {shot: absolute(g.t.tolist(), g.smoothed.tolist(), g.shot_start.iloc[0], g.shot_end.iloc[0], p) for shot, g in samples.groupby("shot_id")}
    rows = QUERIES["q17_localize_absolute"](spark, SF).toPandas()
    got = {}
    for r in rows.itertuples():
        got.setdefault(r.shot_id, []).append(("event", r.onset, r.settle) if r.kind == "event" else ("rejected", r.reason))
    assert {k: sorted(map(str, v)) for k, v in got.items()} == {k: sorted(map(str, v)) for k, v in wanted.items()}


@needs
def test_q27_by_all_pairs(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    clips = {}
    for r in e.itertuples():
        bits = sum(1 << k for k, v in enumerate(r.embedding[:64]) if v > 0)
        clips.setdefault(str(r.label), []).append((r.vec_id * 10.0, str(r.vec_id), 5.0 + r.vec_id % 3, bits))
    wanted = {}
    for own in clips.values():
        own.sort()
        removed, flagged = {}, set()
        for i, (s, a, d, h) in enumerate(own):
            for s2, b, d2, h2 in own[i + 1 :]:
                if a in removed:
                    break
                if b in removed:
                    continue
                gap = max(0.0, s2 - (s + d), s - (s2 + d2))
                lose, win = (a, b) if d < d2 else (b, a)
                if s < s2 + d2 and s2 < s + d:
                    removed[lose] = win
                elif (h ^ h2).bit_count() <= 24 and abs(d - d2) / max(d, d2) <= 0.25:
                    if gap <= 400:
                        removed[lose] = win
                    else:
                        flagged |= {a, b}
        for _, a, *_ in own:
            wanted[a] = "removed" if a in removed else "flagged" if a in flagged else "kept"
    got = {r.clip_id: r.status for r in QUERIES["q27_neardup_greedy"](spark, SF).collect()}
    assert got == wanted


def plain_rates(rows):
    """Counts and rates of (outcome, strict start, strict end), rounded to 3 places."""
    n = {k: sum(r[0].startswith(k) for r in rows) for k in ("TP", "FP", "FN", "TN")}
    tps = [r for r in rows if r[0] == "TP"]
    p = n["TP"] / (n["TP"] + n["FP"]) if n["TP"] + n["FP"] else 0.0
    r = n["TP"] / (n["TP"] + n["FN"]) if n["TP"] + n["FN"] else 0.0
    f1 = 2 * p * r / (p + r) if p + r else 0.0
    return [n["TP"], n["FP"], n["FN"], n["TN"], *(round(x + 1e-12, 3) for x in (p, r, f1, sum(x[1] for x in tps) / max(1, len(tps)), sum(x[2] for x in tps) / max(1, len(tps)), n["FP"] / max(1, n["FP"] + n["TN"])))]


@needs
def test_q75_by_loops(spark):
    windows, samples = (df.toPandas() for df in streams.calibration_windows(spark, SF))
    sets = calibrate.machine_grid(streams.LEVELS)
    assert len(sets) == 33 and len(calibrate.machine_grid()) == 33
    of = {k: g.sort_values("t") for k, g in samples.groupby("window_id")}
    judged = {}
    for w in windows.itertuples():
        g = of[w.window_id]
        for name, p in sets.items():
            events = [(r[1], r[5]) for r in Shot(g.t, g.smoothed, w.t0, w.t1, p).results() if r[0] == "event"]
            half = (w.t1 - w.t0) * 0.5
            hits = [e for e in events if e[0] <= w.t0 + half and e[1] >= w.t1 - half]
            if w.complete:
                row = ("TP", hits[0][0] <= (w.latest or 1e9), hits[0][1] >= (w.earliest or -1e9)) if hits else ("FN-start" if events else "FN-none", False, False)
            else:
                row = ("FP" if events else "TN", True, True)
            judged.setdefault(name, []).append((w.held, row))
    wanted = {}
    for held in set(windows.held):
        best = min(((-plain_rates([r for h, r in rows if h != held])[6], -plain_rates([r for h, r in rows if h != held])[4], name) for name, rows in judged.items()))
        wanted[held] = (best[2], -best[0], plain_rates([r for h, r in judged[best[2]] if h == held]))
    got = {r.held: r for r in QUERIES["q75_calibrate_machine"](spark, SF).collect()}
    names = ["tp", "fp", "fn", "tn", "precision", "recall", "f1", "strict_start", "strict_end", "false_rate"]
    assert {k: (r.config, r.train_f1, [r[n] for n in names]) for k, r in got.items()} == wanted
    assert sum(r.tp for r in got.values()) > 0 and sum(r.fp for r in got.values()) > 0
    one = calibrate.pooled(QUERIES["q75_calibrate_machine"](spark, SF)).first()
    assert [one[n] for n in names] == plain_rates([r for held, (name, _, _) in wanted.items() for h, r in judged[name] if h == held])
