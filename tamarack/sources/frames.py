"""Measures and classes of decoded frames (numpy arrays) and where frames come from; a decoder is passed in, as none is required. `kernels` has the image kernels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.purity import VIEWS
from . import kernels


def gray(frame: np.ndarray) -> np.ndarray:
    """Luma of a BGR frame."""
    f = frame.astype(np.float32)
    return f if f.ndim == 2 else 0.114 * f[..., 0] + 0.587 * f[..., 1] + 0.299 * f[..., 2]


def motion(frames: list[np.ndarray]) -> list[float]:
    """Mean absolute difference from the frame before; the first has none."""
    grays = [gray(f) for f in frames]
    return [0.0] + [float(np.abs(b - a).mean()) for a, b in zip(grays, grays[1:])]


def colour_histogram(frame: np.ndarray, bins: int = 16) -> np.ndarray:
    """A joint histogram of hue and saturation, of unit length."""
    f = frame.astype(np.float64) / 255
    high, low = f.max(-1), f.min(-1)
    span = high - low
    b, g, r = f[..., 0], f[..., 1], f[..., 2]
    safe = np.where(span > 0, span, 1)
    hue = np.where(high == r, (g - b) / safe % 6, np.where(high == g, (b - r) / safe + 2, (r - g) / safe + 4)) / 6
    sat = np.where(high > 0, span / np.where(high > 0, high, 1), 0)
    out, _, _ = np.histogram2d(np.where(span > 0, hue, 0).ravel(), sat.ravel(), bins=bins, range=[[0, 1], [0, 1]])
    return out / max(1e-12, np.linalg.norm(out))


def edge_density(frame: np.ndarray, least: float = 32.0) -> float:
    """Share of pixels whose gradient exceeds `least`."""
    g = gray(frame)
    dy, dx = np.gradient(g)
    return float((np.hypot(dx, dy) > least).mean())


def box_share(a: np.ndarray, b: np.ndarray, first: tuple, second: tuple) -> float | None:
    """Of the motion in two boxes (x0, x1, y0, y1 as fractions) the first's share; None without motion."""
    d = np.abs(gray(b) - gray(a))
    h, w = d.shape
    sums = [float(d[int(y0 * h) : int(y1 * h), int(x0 * w) : int(x1 * w)].sum()) for x0, x1, y0, y1 in (first, second)]
    return sums[0] / sum(sums) if sum(sums) > 0 else None


def clip_hashes(frames: list[np.ndarray | None]) -> list[int] | None:
    """The hashes of a clip's samples, None where one is unreadable or there is none."""
    return [kernels.thumbnail_hash(f) for f in frames] if frames and all(f is not None for f in frames) else None


def sample_times(start: float, end: float, samples: int = 8) -> list[float]:
    """Times of evenly spaced samples within a clip."""
    return [start + (end - start) * (k + 0.5) / samples for k in range(samples)]


def colour_entropy(frame: np.ndarray, bins: int = 16) -> float:
    """Entropy in bits of a frame's hues and saturations."""
    p = colour_histogram(frame, bins).ravel()
    p = p[p > 0] / p.sum() if p.sum() else p[p > 0]
    return float(-(p * np.log2(p)).sum())


def green_share(frame: np.ndarray) -> float:
    """Share of pixels of a saturated green hue, of a BGR frame."""
    f = frame.astype(np.float64) / 255
    high, span = f.max(-1), f.max(-1) - f.min(-1)
    b, g, r = f[..., 0], f[..., 1], f[..., 2]
    safe = np.where(span > 0, span, 1)
    hue = 60 * np.where(high == r, (g - b) / safe % 6, np.where(high == g, (b - r) / safe + 2, (r - g) / safe + 4))
    return float(((span > 0) & (hue > 70) & (hue < 170) & (span / np.where(high > 0, high, 1) > 40 / 255)).mean())


# Of each layout, in order: shares of green and of edges over or under which it holds, and its votes. The last takes the rest.
LAYOUTS = [
    ({"green_over": 0.45, "edges_under": 0.10}, {"center_field_good": 1.0}),
    ({"green_over": 0.35}, {"center_field_good": 0.6, "field_bad": 0.4}),
    ({"edges_over": 0.18, "green_under": 0.15}, {"graphic_bad": 1.0}),
    ({"green_under": 0.2, "edges_over": 0.10}, {"closeup_bad": 0.6, "other_bad": 0.4}),
    ({}, {"other_bad": 1.0}),
]


def _holds(cuts: dict[str, float], **shares):
    """Whether shares (numbers or columns) are strictly beyond each cut."""
    out = None
    for name, cut in cuts.items():
        share, side = name.split("_")
        test = shares[share] > cut if side == "over" else shares[share] < cut
        out = test if out is None else out & test
    return out


def layout_votes(green: Column, edges: Column) -> Column:
    """A frame's votes by class from its shares of green and of edges."""
    out = F
    for cuts, votes in LAYOUTS:
        given = F.create_map(*[F.lit(x) for kv in votes.items() for x in kv])
        out = out.when(_holds(cuts, green=green, edges=edges), given) if cuts else out.otherwise(given)
    return out


class LayoutClassifier:
    """Views of shots from layout alone, for where no trained model is at hand; `classify(frames)` gives (label, confidence, scores).

    Scores are a share of the votes for each view; of equal ones the first in the order of views wins. No frames: the last view, without any vote.
    """

    backend = "heuristic_fallback:v1"

    def classify(self, frames: list[np.ndarray]) -> tuple[str, float, dict[str, float]]:
        scores = dict.fromkeys(VIEWS, 0.0)
        for f in frames:
            shares = {"green": np.float64(green_share(f)), "edges": np.float64(edge_density(f))}
            votes = next(votes for cuts, votes in LAYOUTS if not cuts or _holds(cuts, **shares))
            for view, share in votes.items():
                scores[view] += share / len(frames)
        best = max(VIEWS, key=scores.__getitem__) if frames else VIEWS[-1]
        return best, scores[best], scores


def first_classifier(*makers):
    """The first classifier that can be made: anything with `backend` and `classify(frames)`."""
    errors = []
    for make in makers:
        try:
            return make()
        except Exception as e:
            errors.append(str(e))
    raise RuntimeError("; ".join(errors) or "no classifier given")


def classified(shots: DataFrame, frames_of, make, id_col: str = "shot_id") -> DataFrame:
    """shots (id, ...) with view_class, confidence, scores and classifier; make() is called once a task, frames_of(id) reads a shot's samples."""
    import pandas as pd

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shots.schema)

    def run(batches):
        model = make()
        for rows in batches:
            out = [model.classify(frames_of(i)) for i in rows[id_col]]
            yield rows.assign(view_class=[x[0] for x in out], confidence=[float(x[1]) for x in out], scores=pd.Series([x[2] for x in out], index=rows.index, dtype=object), classifier=model.backend)

    return shots.mapInPandas(run, f"{kinds}, view_class string, confidence double, scores map<string,double>, classifier string")


def point_frames(points: DataFrame, read, path_col: str = "path", time_col: str = "t") -> DataFrame:
    """(path, t, height, width, pixels) of single frames; a file's times are read together, in order, by read(path, times) -> frames or None."""
    import pandas as pd

    wanted = points.select(F.col(path_col).alias("path"), F.col(time_col).cast("double").alias("t")).distinct()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("t")
        got = read(rows["path"].iloc[0], rows["t"].tolist())
        shapes = [(None, None, None) if f is None else (f.shape[0], f.shape[1], f.astype(np.uint8).tobytes()) for f in got]
        return pd.DataFrame([(p, t, *s) for p, t, s in zip(rows["path"], rows["t"], shapes)], columns=["path", "t", "height", "width", "pixels"])

    # A long video's times are dealt by minutes, so that no task reads all of one.
    minute = F.floor(F.col("t") / 60)
    return wanted.groupBy("path", minute.alias("minute")).applyInPandas(lambda rows: run(rows), "path string, t double, height int, width int, pixels binary")
