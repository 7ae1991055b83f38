"""Image kernels on arrays whose results are known."""

import os

import numpy as np
import pytest

from tamarack.catalog import QUERIES
from tamarack.sources import kernels as k

SF = "/root/testdata/sf0.001"


def texture(height=96, width=128, dy=0.0, dx=0.0):
    y, x = np.mgrid[:height, :width]
    y, x = y - dy, x - dx
    return (128 + 50 * np.sin(y / 5 + x / 9) + 40 * np.cos(x / 6 - y / 11)).astype(np.uint8)


def test_bilinear_sizes_by_hand():
    row = np.array([[0, 100, 200, 100]], np.uint8)
    assert k.resize(row, 1, 2).tolist() == [[50, 150]]  # between the middle two of each pair
    assert k.resize(row, 1, 8)[0].tolist() == [0, 25, 75, 125, 175, 175, 125, 100]
    wide = k.resize(np.tile(np.arange(90, dtype=np.uint8), (80, 1)), 8, 9, smooth=True)
    assert wide.shape == (8, 9) and np.all(np.abs(wide[:, 1:-1] - (np.arange(1, 8) * 10 + 4.5)) <= 0.5)


def test_thumbnail_hashes():
    ramp = np.tile(np.arange(90, dtype=np.uint8), (80, 1))
    assert k.thumbnail_hash(ramp) == -1 and k.thumbnail_hash(ramp[:, ::-1]) == 0 and k.thumbnail_hash(np.full((30, 40), 7, np.uint8)) == 0
    one = np.full((8, 9), 50, np.uint8)
    one[0, 8] = 60
    assert k.thumbnail_hash(one) == 1 << 56  # the last bit of the first row
    assert k.thumbnail_hash(np.dstack([ramp] * 3)) == -1


def test_histograms():
    red = np.zeros((4, 4, 3), np.uint8)
    red[..., 2] = 255
    h = k.hue_saturation(red)
    assert h.shape == (50, 60) and h[0, 59] == 1.0 and h.sum() == 1.0
    green = np.zeros_like(red)
    green[..., 1] = 200
    assert k.hue_saturation(green)[60 * 50 // 180, 59] == 1.0
    both = np.concatenate([red, green])
    assert k.hue_saturation(both).max() == pytest.approx(2**-0.5) and k.correlation(h, h) == pytest.approx(1.0)
    assert k.correlation(h, k.hue_saturation(green)) < 0 and k.hue_saturation(np.full_like(red, 9))[0, 0] == 1.0


def test_edges_of_a_step_are_one_pixel_wide():
    step = np.zeros((20, 30), np.uint8)
    step[:, 15:] = 200
    found = k.edges(step)
    assert found.sum() == 20 and len(set(np.flatnonzero(found) % 30)) == 1 and not k.edges(np.full((9, 9), 80, np.uint8)).any()
    assert (k.edges(step.T) == k.edges(step.T)).all() and k.edges(step.T).sum() == 20
    box = np.zeros((40, 40), np.uint8)
    box[10:30, 10:30] = 255
    assert 70 <= k.edges(box).sum() <= 84


def test_weak_edges_stay_where_they_hang_on_strong_ones():
    fading = np.zeros((40, 30), np.uint8)
    fading[:20, 15:] = 100  # gradient 400
    fading[20:, 15:] = 30  # gradient 120: weak
    alone = np.zeros((40, 30), np.uint8)
    alone[:, 15:] = 30
    assert k.edges(fading)[25:, 13:17].sum() == 15 and not k.edges(alone).any()
    assert 0 < k.edge_share(np.dstack([texture(300, 500)] * 3)) < 0.5 and k.edge_share(np.zeros((10, 10), np.uint8)) == 0.0


@pytest.mark.parametrize("dy,dx", [(0.0, 0.0), (1.0, -2.0), (3.0, 0.0), (-2.5, 4.0)])
def test_flow_finds_a_shift(dy, dx):
    got = k.flow(texture(), texture(dy=dy, dx=dx))[20:-20, 20:-20]
    assert np.abs(np.median(got[..., 0]) - dy) < 0.25 and np.abs(np.median(got[..., 1]) - dx) < 0.25


def test_energy_counts_the_region_only():
    still = texture()
    assert k.energy(still, still) == pytest.approx(0.0, abs=1e-6)
    edge = still.copy()
    edge[:6] = 255  # above the region
    assert k.energy(still, edge, weight=0.0) == 0.0 and k.energy(still, texture(dx=2.0)) > k.energy(still, texture(dx=2.0), weight=0.0) > 0
    assert k.region(100, 100).sum() == 62 * 72 and k.region(100, 100, lower=True).sum() == pytest.approx(62 * 65 + 62 * 7 * 0.35)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_q80_by_a_loop(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = {r.vec_id: r for r in QUERIES["q80_image_kernels"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows[::17]:
        frame = np.clip((np.asarray(r.embedding[:64], np.float64) + 0.5) * 255, 0, 255).astype(np.uint8).reshape(8, 8)
        assert got[r.vec_id].hash == k.thumbnail_hash(frame) and got[r.vec_id].edges == k.edge_share(frame) and got[r.vec_id].brightness == frame.mean()
