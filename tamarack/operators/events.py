"""Temporal events in a smoothed signal.

The machine reads a shot's samples in order: a sustained quiet run anchors it, a
rise from quiet preparation opens a pattern, a delivery-level core with decay and a
calm regime completes it. It depends on its own earlier decisions, so it runs as
one grouped function a shot; the samples of one shot are its only group.

`OpenShot` is the same machine over samples that are still coming: a step whose outcome
later samples could change is put off, and between steps only those samples stay that
such a step can still ask for (`Shot.needed`), a few for each open pattern.
`streaming.machine` runs it as stateful processing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "shot_id string, kind string, clip_start double, onset double, peak double, settle double, clip_end double, confidence double, reason string"


@dataclass(frozen=True)
class Params:
    """Fixed default values of the machine, in signal units and seconds."""

    low: float = 0.30
    high: float = 0.45
    min_prepared: float = 0.8
    min_active: float = 0.8
    min_settle: float = 0.6
    pre_buffer: float = 1.0
    post_buffer: float = 0.4
    max_events: int = 2
    quiet_anchor: float = 0.3
    pre_heat_min: float = 0.8
    decay_ratio: float = 0.7
    gap_bridge: float = 0.5
    edge_skip: float = 0.3
    edge_min_stable: float = 0.25
    wobble: float = 0.2
    relative: bool = True


class Undecided(Exception):
    """What samples that are still to come could change."""


class Runs:
    """Runs of samples of one side of a level: [from, to) in order, looked up by sample. open: the last may go on."""

    def __init__(self, above: np.ndarray, open: bool = False):
        self.above, self.open = above, open
        cuts = np.flatnonzero(np.diff(above.astype(np.int8))) + 1
        self.low, self.high = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(above)]])
        self.of = np.repeat(np.arange(len(self.low)), self.high - self.low)

    def seen(self, k: int) -> int:
        """Where the run of k ends, as far as samples have come."""
        return int(self.high[self.of[k]])

    def end(self, k: int) -> int:
        e = self.seen(k)
        if self.open and e == len(self.above):
            raise Undecided
        return e

    def next(self, k: int, above: bool) -> int | None:
        """The first sample at or after k on that side."""
        if k < len(self.above):
            e = k if self.above[k] == above else self.end(k)
            if e < len(self.above):
                return e
        if self.open:
            raise Undecided
        return None


class Shot:
    """The machine over a shot's samples, or over those from `at` on that are needed to go on after `found` events.

    open: samples may follow; a step that they could change raises Undecided, with `at` and `found` as they were before it.
    """

    def __init__(self, times, values, start: float, end: float, params: Params, open: bool = False, count: int | None = None, at: int | None = None, found: int = 0, heat: float = 0.0):
        self.t, self.x, self.start, self.end, self.p = np.asarray(times, float), np.asarray(values, float), start, end, params
        self.open, self.count = open, len(self.t) if count is None else count
        self.hot, self.core = Runs(self.x > params.low, open), Runs(self.x >= params.high, open)
        self.at, self.found, self.heat, self.over = at, found, heat, False

    def results(self) -> Iterator[tuple]:
        """(kind, clip_start, onset, peak, settle, clip_end, confidence, reason) of each event and rejection."""
        p, t = self.p, self.t
        if self.end - self.start < 1.5 or self.count < 5:
            if self.open and self.end - self.start >= 1.5:
                raise Undecided
            yield self.rejected("shot_too_short")
            return
        if self.at is None:
            quiet = [k for k, e in zip(self.hot.low, self.hot.high) if not self.hot.above[k] and t[e - 1] - t[k] >= p.quiet_anchor]
            if not quiet:
                if self.open:
                    raise Undecided
                yield self.rejected("start_incomplete")
                return
            self.at = int(quiet[0])
            self.heat = float(t[self.at] - self.start)
        while not self.over and (onset := self.hot.next(self.at, True)) is not None:
            first = self.prepared_from(onset, self.at)
            ready = t[onset - 1] - t[first] if first < onset else 0.0
            if ready < p.min_prepared:
                if not p.relative and t[onset] - self.start < p.min_prepared + p.quiet_anchor:
                    yield self.rejected("start_incomplete")
                    return
                self.at = self.hot.end(onset)
                continue
            row, self.at = (self.decaying if p.relative else self.settling)(onset, first, ready)
            if row is not None:
                self.found += 1
                yield row
                if row[0] == "rejected" or self.found >= p.max_events:
                    return
        if not self.found:
            yield self.rejected("start_incomplete" if self.heat >= p.pre_heat_min else "no_complete_pitch")

    def needed(self) -> np.ndarray:
        """Samples that steps to come can ask for, the first of them `at`: ends of runs, the onset, the rise, the peak and what follows it."""
        n = len(self.t)
        if self.count < 5:  # too few to look at
            return np.arange(n)
        if self.at is None:  # the quiet run that may become the anchor
            return np.unique([n - 1] if self.hot.above[n - 1] else [self.hot.low[self.hot.of[n - 1]], n - 1])
        at = min(self.at, n - 1)
        edge = self.hot.of if not self.p.relative else self.hot.of + self.core.of  # rises by one at each end of either's runs
        change = np.flatnonzero(np.diff(edge))
        ends = np.concatenate([change, change + 1, [at, n - 1]])
        limit = int(np.searchsorted(self.t, self.end - self.p.edge_skip, "right"))
        ends = np.concatenate([ends, np.arange(max(limit - 1, 0), n)])
        onset = at if self.hot.above[at] else self.hot.seen(at)
        if onset >= n:
            return np.unique(ends[ends >= at])
        if not self.p.relative:
            peak = onset + int(np.argmax(self.x[onset : self.hot.seen(onset)]))
            return np.unique(np.concatenate([ends[ends >= at], [onset, peak]]))
        settle, own = self.asked(onset)
        # Between the onset and where the peak has decayed, runs are bridged already; only `own` is asked for.
        kept = [ends[(ends >= settle) | (ends == at) | (ends == n - 1)], own]
        # After an event the machine goes on from there, so that what comes up later can be an onset too.
        kept += [self.asked(int(k))[1] for k in self.hot.low if k > settle and self.hot.above[k]]
        kept = np.concatenate(kept)
        return np.unique(kept[(kept >= at) & (kept < n)])

    def asked(self, onset: int) -> tuple[int, list[int]]:
        """Where the blob of an onset has decayed, as far as samples have come, and which of its samples decide on it."""
        blob, n = self.blob_end(onset, True), len(self.t)
        rise, settle = self.rise(onset, blob), self.settle(onset, blob)
        cool = np.flatnonzero(~self.hot.above[onset : min(rise, n)])
        bridge = [onset + int(cool[-1]), onset + int(cool[-1]) + 1] if len(cool) else []
        return settle, [onset - 1, onset, onset + int(np.argmax(self.x[onset:blob])), rise, settle - 1, settle, *bridge]

    def rejected(self, reason: str) -> tuple:
        return ("rejected", None, None, None, None, None, None, reason)

    def prepared_from(self, onset: int, at: int) -> int:
        """Where the quiet before an onset begins, short wobbles bridged; the onset itself where there is none."""
        first = onset
        while first > at:
            run = self.hot.of[first - 1]
            low = max(int(self.hot.low[run]), at)
            if self.hot.above[first - 1]:
                bridge = self.p.relative and first < onset and low > at and self.t[first - 1] - self.t[low] < self.p.wobble
                if not bridge:
                    break
                low = max(int(self.hot.low[run - 1]), at)
            first = low
        return first

    def event(self, onset: int, first: int, peak: int, settle: int, calm: float, ready: float, active: float) -> tuple:
        p, t = self.p, self.t
        begin = max(self.start, t[onset] - p.pre_buffer, t[first])
        finish = min(self.end, t[settle] + p.post_buffer)
        sure = min(1.0, ready / 1.5 * 0.3 + active / 2.0 * 0.4 + calm / 1.5 * 0.3)
        return ("event", begin, t[onset], t[peak], t[settle], finish, round(sure, 3), None)

    def settling(self, onset: int, first: int, ready: float) -> tuple[tuple | None, int]:
        """Absolute completion: the blob ends and an unbroken quiet run follows."""
        p, t, n = self.p, self.t, len(self.t)
        end = self.hot.end(onset)
        active = t[end - 1] - t[onset]
        if not (self.x[onset:end] >= p.high).any() or active < p.min_active:
            return None, end
        if end >= n:
            return self.rejected("end_incomplete"), end
        after = self.hot.end(end)
        calm = t[after - 1] - t[end]
        if calm < p.min_settle:
            return (self.rejected("end_incomplete") if after >= n else None), after
        return self.event(onset, first, onset + int(np.argmax(self.x[onset:end])), end, calm, ready, active), after

    def blob_end(self, onset: int, so_far: bool = False) -> int:
        """The end of the hot blob, quiet gaps shorter than gap_bridge bridged; so_far: as the samples are."""
        n, end = len(self.t), self.hot.seen(onset) if so_far else self.hot.end(onset)
        while end < n:
            back = self.hot.seen(end)
            if back >= n:
                if self.open and not so_far and self.t[n - 1] - self.t[end] < self.p.gap_bridge:
                    raise Undecided
                break
            if self.t[back] - self.t[end] >= self.p.gap_bridge:
                break
            end = self.hot.seen(back) if so_far else self.hot.end(back)
        return end

    def rise(self, onset: int, blob: int) -> int:
        """The first sample of the blob at the core's level, or the blob's end."""
        core = np.flatnonzero(self.core.above[onset:blob])
        return onset + int(core[0]) if len(core) else blob

    def settle(self, onset: int, blob: int) -> int:
        """The first sample after the blob's peak that has decayed, or the number of samples."""
        peak = onset + int(np.argmax(self.x[onset:blob]))
        below = np.flatnonzero(self.x[peak + 1 :] <= max(self.p.low, self.x[peak] * self.p.decay_ratio))
        return peak + 1 + int(below[0]) if len(below) else len(self.t)

    def decaying(self, onset: int, first: int, ready: float) -> tuple[tuple | None, int]:
        """Relative completion: decay from the peak, then calm that adds up, short bumps tolerated."""
        p, t, x, n = self.p, self.t, self.x, len(self.t)
        end = self.blob_end(onset)
        rise = self.rise(onset, end)
        active = t[end - 1] - t[onset]
        if rise >= end or active < p.min_active:
            return None, end
        peak = onset + int(np.argmax(x[onset:end]))
        cool = np.flatnonzero(x[first : rise + 1] <= p.low)
        ready = t[first + cool[-1]] - t[first] if len(cool) else 0.0
        limit = self.end - p.edge_skip
        settle = self.settle(onset, end)
        if settle >= n and self.open:
            raise Undecided
        if settle >= n or t[settle] > limit:
            return self.rejected("end_incomplete"), settle
        usable = int(np.searchsorted(t, limit, "right"))
        calm, k = 0.0, settle
        while k < usable:
            stop = self.core.seen(k) if usable < n else self.core.end(k)
            stop = min(stop, usable)
            if not self.core.above[k]:
                calm += t[stop - 1] - t[k]
                if calm >= p.min_settle:
                    return self.event(onset, first, peak, settle, calm, ready, active), stop
            elif t[stop - 1] - t[k] >= p.min_active:
                return None, self.core.end(stop) if stop < n and self.core.above[stop] else stop
            k = stop
        self.over = True
        if calm >= p.edge_min_stable:
            return self.event(onset, first, peak, settle, calm, ready, active), n
        return self.rejected("end_incomplete"), k


class OpenShot:
    """The machine over samples that come in order of time, in any number of parts; `held` is all it needs to go on."""

    def __init__(self, start: float, end: float, params: Params, held: tuple | None = None):
        self.start, self.end, self.p = start, end, params
        self.t, self.x, self.count, self.anchored, self.found, self.heat, self.done = held or ([], [], 0, False, 0, 0.0, False)

    @property
    def held(self) -> tuple:
        return (list(self.t), list(self.x), self.count, self.anchored, self.found, self.heat, self.done)

    def push(self, times, values, last: bool = False) -> list[tuple]:
        """What the samples decide; last: no others follow."""
        if self.done or not len(self.t) + len(times):
            return []
        self.count += len(times)
        shot = Shot([*self.t, *times], [*self.x, *values], self.start, self.end, self.p, not last, self.count, 0 if self.anchored else None, self.found, self.heat)
        rows = []
        try:
            for row in shot.results():
                rows.append(row)
            self.done, self.t, self.x = True, [], []
        except Undecided:
            keep = shot.needed()
            self.t, self.x = shot.t[keep].tolist(), shot.x[keep].tolist()
        self.anchored, self.found, self.heat = shot.at is not None, shot.found, shot.heat
        return rows


def localize(samples: DataFrame, params: Params | None = None) -> DataFrame:
    """Events and rejections of samples (shot_id, t, smoothed, shot_start, shot_end), a shot at a time."""
    used = params or Params()

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("t")
        shot = Shot(rows.t, rows.smoothed, float(rows.shot_start.iloc[0]), float(rows.shot_end.iloc[0]), used)
        out = [(key[0], *r) for r in shot.results()]
        return pd.DataFrame(out, columns=["shot_id", "kind", "clip_start", "onset", "peak", "settle", "clip_end", "confidence", "reason"])

    return samples.groupBy("shot_id").applyInPandas(one, SCHEMA)
