"""Image kernels in numpy: histogram of hue and saturation, edges by non-maximum suppression and hysteresis, dense flow by polynomial expansion, and hashes of bilinear thumbnails.

Frames are arrays of 8-bit values, BGR or grey. The kernels run on Arrow batches of
frames (`over_batches`), each frame by itself or with the one before of its group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Bins of hue and saturation; size of a frame for edges, and levels of weak and strong ones; size of a thumbnail.
HUES, SATURATIONS, EDGE_SIZE, WEAK, STRONG, THUMB = 50, 60, (144, 256), 80, 160, (8, 9)
# The region of motion (left, right, top, bottom), and of its variant what lower rows and side columns count.
CENTRE = (0.19, 0.81, 0.10, 0.82)
LOWER, LOWER_WEIGHT, SIDES, SIDE_WEIGHT = 0.75, 0.35, (0.10, 0.90), 0.5
# Levels of the flow's pyramid, side of its averaging window, rounds a level, and radius and spread of its polynomials.
LEVELS, WINDOW, ROUNDS, RADIUS, SPREAD = 3, 15, 3, 5, 1.2


def grey(frame: np.ndarray) -> np.ndarray:
    """Luma of a BGR frame, rounded to 8 bits."""
    if frame.ndim == 2:
        return frame.astype(np.uint8)
    b, g, r = (frame[..., k].astype(np.int64) for k in range(3))
    return ((r * 4899 + g * 9617 + b * 1868 + 8192) >> 14).astype(np.uint8)


def _taps(size: int, out: int, support: float) -> np.ndarray:
    """Weights (out, size) of a triangle filter: of one pixel's width where support is 1, of a whole cell's where it is the scale."""
    scale = size / out
    centre = (np.arange(out) + 0.5) * scale - 0.5
    if support <= 1:  # two neighbours, edges repeated
        centre = np.clip(centre, 0, size - 1)
        w = np.maximum(0, 1 - np.abs(np.arange(size)[None, :] - centre[:, None]))
    else:
        w = np.maximum(0, 1 - np.abs(np.arange(size)[None, :] - centre[:, None]) / support)
    return w / w.sum(1, keepdims=True)


def resize(image: np.ndarray, height: int, width: int, smooth: bool = False) -> np.ndarray:
    """Bilinear, rounded to 8 bits after each axis; smooth: over all pixels that a smaller one covers."""
    for axis, size in ((1, width), (0, height)):
        have = image.shape[axis]
        if have != size:
            w = _taps(have, size, max(1.0, have / size) if smooth else 1.0)
            image = np.moveaxis(np.tensordot(w, np.moveaxis(image.astype(np.float64), axis, 0), 1), 0, axis)
            image = np.clip(np.floor(image + 0.5), 0, 255).astype(np.uint8)
    return image


def thumbnail_hash(frame: np.ndarray) -> int:
    """64 bits, row by row: whether a pixel of the 8 x 9 thumbnail is brighter than its left neighbour; as a signed integer."""
    small = resize(grey(frame), *THUMB, smooth=True).astype(np.int16)
    value = int.from_bytes(np.packbits((small[:, 1:] > small[:, :-1]).ravel()).tobytes(), "big")
    return value - (1 << 64) if value >> 63 else value


def hue_saturation(frame: np.ndarray) -> np.ndarray:
    """Histogram of hue (0 to 180) and saturation (0 to 256) of a BGR frame, 8 bits each, of unit length."""
    f = frame.astype(np.float64)
    high, span = f.max(-1), f.max(-1) - f.min(-1)
    b, g, r = f[..., 0], f[..., 1], f[..., 2]
    safe = np.where(span > 0, span, 1)
    sector = np.where(high == r, (g - b) / safe, np.where(high == g, 2 + (b - r) / safe, 4 + (r - g) / safe))
    hue = np.floor(np.where(span > 0, sector * 30 % 180, 0) + 0.5).astype(int) % 180
    sat = np.floor(np.where(high > 0, 255 * span / np.where(high > 0, high, 1), 0) + 0.5).astype(int)
    counts = np.bincount((hue * HUES // 180 * SATURATIONS + sat * SATURATIONS // 256).ravel(), minlength=HUES * SATURATIONS).astype(np.float64)
    return counts.reshape(HUES, SATURATIONS) / max(np.linalg.norm(counts), 1e-12)


def correlation(a: np.ndarray, b: np.ndarray) -> float:
    """Of two histograms; 1 where both are flat."""
    x, y = a.ravel() - a.mean(), b.ravel() - b.mean()
    scale = math.sqrt(float(x @ x) * float(y @ y))
    return float(x @ y) / scale if scale > 0 else 1.0


def edges(image: np.ndarray, weak: float = WEAK, strong: float = STRONG) -> np.ndarray:
    """Edge pixels of a grey image: ridges of the gradient that are over `weak` and hang together with one over `strong`.

    Gradients are 3 x 3 differences, their size the sum of both parts; a ridge is over its neighbour on the one side of
    its direction, of four, and no less than that on the other.
    """
    g = np.pad(image.astype(np.int64), 1, mode="edge")
    across = g[:, 2:] - g[:, :-2]
    dx = across[:-2] + 2 * across[1:-1] + across[2:]
    down = g[2:] - g[:-2]
    dy = down[:, :-2] + 2 * down[:, 1:-1] + down[:, 2:]
    size = np.abs(dx) + np.abs(dy)
    m = np.pad(size, 1)
    h, w = size.shape
    near = lambda y, x: m[1 + y : 1 + y + h, 1 + x : 1 + x + w]
    ax, ay, t = np.abs(dx), np.abs(dy), math.tan(math.pi / 8)
    flat, steep = ay < t * ax, ay * t > ax
    same = (dx < 0) == (dy < 0)
    ridge = np.where(
        flat, (size > near(0, -1)) & (size >= near(0, 1)),
        np.where(steep, (size > near(-1, 0)) & (size >= near(1, 0)), np.where(same, (size > near(-1, -1)) & (size > near(1, 1)), (size > near(-1, 1)) & (size > near(1, -1)))),
    )
    open_ = ridge & (size > weak)
    held, grown = np.zeros_like(open_), open_ & (size > strong)
    while grown.any():  # strong pixels take in the weak ones beside them, and these theirs
        held |= grown
        wide = np.pad(grown, 1)
        wide = wide[:-2] | wide[1:-1] | wide[2:]
        grown = (wide[:, :-2] | wide[:, 1:-1] | wide[:, 2:]) & open_ & ~held
    return held


def edge_share(frame: np.ndarray) -> float:
    """Share of edge pixels of a frame at the size for edges, to 4 places."""
    return round(float(edges(grey(resize(frame, *EDGE_SIZE))).mean()), 4)


def region(height: int, width: int, lower: bool = False) -> np.ndarray:
    """Weights of pixels in the measure of motion; lower: with its lower rows and side columns counting less."""
    left, right, top, bottom = CENTRE
    out = np.zeros((height, width))
    out[int(height * top) : int(height * bottom), int(width * left) : int(width * right)] = 1.0
    if lower:
        out[int(height * LOWER) :] *= LOWER_WEIGHT
        out[:, : int(width * SIDES[0])] *= SIDE_WEIGHT
        out[:, int(width * SIDES[1]) :] *= SIDE_WEIGHT
    return out


def _along(image: np.ndarray, taps: np.ndarray, axis: int) -> np.ndarray:
    """Correlation with taps along an axis, edges repeated."""
    n = len(taps) // 2
    padded = np.pad(image, [(n, n) if k == axis else (0, 0) for k in range(image.ndim)], mode="edge")
    return np.apply_along_axis(np.convolve, axis, padded, taps[::-1], "valid")


def polynomials(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A, b) of each pixel: x'Ax + b'x + c is the weighted least squares fit to its neighbourhood; x is (row, column)."""
    k = np.arange(-RADIUS, RADIUS + 1, dtype=np.float64)
    w = np.exp(-(k**2) / (2 * SPREAD**2))
    w /= w.sum()
    powers = [(0, 0), (1, 0), (0, 1), (2, 0), (0, 2), (1, 1)]
    moment = lambda p: float((w * k**p).sum())
    gram = np.array([[moment(a + c) * moment(b + d) for c, d in powers] for a, b in powers])
    rows = [_along(image.astype(np.float64), w * k**p, 0) for p in range(3)]
    held = np.stack([_along(rows[a], w * k**b, 1) for a, b in powers], -1)
    _, by, bx, ayy, axx, ayx = np.moveaxis(held @ np.linalg.inv(gram).T, -1, 0)
    return np.stack([np.stack([ayy, ayx / 2], -1), np.stack([ayx / 2, axx], -1)], -2), np.stack([by, bx], -1)


def _at(field: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Bilinear values of a field at places within it."""
    y0, x0 = np.minimum(y.astype(int), field.shape[0] - 2), np.minimum(x.astype(int), field.shape[1] - 2)
    shape = y.shape + (1,) * (field.ndim - 2)
    fy, fx = (y - y0).reshape(shape), (x - x0).reshape(shape)
    return (field[y0, x0] * (1 - fx) + field[y0, x0 + 1] * fx) * (1 - fy) + (field[y0 + 1, x0] * (1 - fx) + field[y0 + 1, x0 + 1] * fx) * fy


def flow(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Displacement (row, column) of each pixel between two grey images.

    A shift of a polynomial changes its linear part only; each pixel's shift is the least squares solution over a window
    of what the changes say, from coarse to fine and a few rounds each.
    """
    shift, box = None, np.full(WINDOW, 1 / WINDOW)
    for level in range(LEVELS - 1, -1, -1):
        height, width = (max(4, round(n / 2**level)) for n in before.shape)
        if level and min(height, width) < 2 * RADIUS:
            continue
        scale = lambda f: f.astype(np.float64) if level == 0 else resize(f, height, width, smooth=True).astype(np.float64)
        (a1, b1), (a2, b2) = polynomials(scale(before)), polynomials(scale(after))
        yy, xx = np.mgrid[:height, :width].astype(np.float64)
        if shift is None:
            shift = np.zeros((height, width, 2))
        else:
            ry, rx = (np.linspace(0, n - 1, m) for n, m in zip(shift.shape[:2], (height, width)))
            shift = _at(shift, *np.meshgrid(ry, rx, indexing="ij")) * [height / shift.shape[0], width / shift.shape[1]]
        for _ in range(ROUNDS):
            y, x = np.clip(yy + shift[..., 0], 0, height - 1), np.clip(xx + shift[..., 1], 0, width - 1)
            a = (a1 + _at(a2, y, x)) / 2
            known = np.stack([y - yy, x - xx], -1)
            change = (b1 - _at(b2, y, x)) / 2 + np.einsum("...ij,...j->...i", a, known)
            normal, right = np.einsum("...ji,...jk->...ik", a, a), np.einsum("...ji,...j->...i", a, change)
            normal, right = (_along(_along(f, box, 0), box, 1) for f in (normal, right))
            det = normal[..., 0, 0] * normal[..., 1, 1] - normal[..., 0, 1] ** 2
            ok = det > 1e-6
            safe = np.where(ok, det, 1)
            dy = (normal[..., 1, 1] * right[..., 0] - normal[..., 0, 1] * right[..., 1]) / safe
            dx = (normal[..., 0, 0] * right[..., 1] - normal[..., 0, 1] * right[..., 0]) / safe
            shift = np.stack([np.where(ok, dy, 0), np.where(ok, dx, 0)], -1)
    return shift


def energy(before: np.ndarray, after: np.ndarray, weight: float = 0.5, rate: float = 10.0, lower: bool = False) -> float:
    """Motion between two grey images: mean difference in the region, and weight x rate of the mean length of the flow there."""
    mask = region(*after.shape, lower)
    total = mask.sum() or 1.0
    difference = float((np.abs(after.astype(np.float64) - before.astype(np.float64)) * mask).sum() / total)
    return difference + weight * rate * float((np.hypot(*np.moveaxis(flow(before, after), -1, 0)) * mask).sum() / total)


def over_batches(frames: DataFrame, kernels: dict[str, Callable[[np.ndarray], float]], shape: tuple[int, ...], value: str = "value") -> DataFrame:
    """frames with a double column for each kernel of the frame in the array column `value`; null where the frame is null."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frames.schema if f.name != value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [None if v is None else np.asarray(v, np.float64).clip(0, 255).astype(np.uint8).reshape(shape) for v in batch.column(value).to_pylist()]
            own = [k for k, n in enumerate(batch.schema.names) if n != value]
            more = [pa.array([None if f is None else float(kernel(f)) for f in held], pa.float64()) for kernel in kernels.values()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in own), *more], names=[*(batch.schema.names[k] for k in own), *kernels])

    return frames.mapInArrow(run, ", ".join(filter(None, [kinds, *(f"`{k}` double" for k in kernels)])))
