"""Raster kernels in tiles against the same kernels on whole images."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloudloom.operators import raster


def frame(spark, images, value):
    rows = [(k, int(v), int(u), float(image[v, u])) for k, image in images.items() for v, u in zip(*np.nonzero(image))]
    return spark.createDataFrame(rows, f"cam_id long, iv int, iu int, {value} double")


def array(df, cam, shape, value=None):
    out = np.zeros(shape)
    for r in df.where(F.col("cam_id") == cam).collect():
        out[r["iv"], r["iu"]] = r[value] if value else 1
    return out


def whole_edges(grey, low, high):
    """Hysteresis by growing the strong pixels until nothing changes."""
    sizes = raster.thinned(grey)
    weak, found = sizes > low, sizes > high
    while True:
        wide = np.pad(found, 1)
        grown = weak & np.any([wide[1 + dy : 1 + dy + grey.shape[0], 1 + dx : 1 + dx + grey.shape[1]] for dy in (-1, 0, 1) for dx in (-1, 0, 1)], axis=0)
        if (grown == found).all():
            return found
        found = grown


def pictures():
    rng = np.random.default_rng(3)
    h, w = 45, 61
    steps = np.kron(rng.integers(0, 4, (9, 13)), np.ones((5, 5)))[:h, :w] * 30 + rng.integers(0, 6, (h, w))
    spiral = np.full((h, w), 10.0)
    for k in range(0, 20, 6):  # long thin edges through many tiles, strong at one end only
        spiral[k : h - k, k] = spiral[k, k : w - k] = spiral[h - k - 1, k : w - k] = 40
    spiral[0:4, 0:6] = 255
    return {1: steps.astype(float), 2: spiral}


@pytest.mark.parametrize("tile", [7, 16, 256])
def test_edges_in_tiles(spark, tile):
    images = pictures()
    df = frame(spark, images, "grey")
    found = raster.canny_edges(df, 61, 45, 40.0, 200.0, tile=tile)
    for k, image in images.items():
        assert (array(found, k, image.shape) > 0).tolist() == whole_edges(image, 40.0, 200.0).tolist()
    assert found.count() > 100


@pytest.mark.parametrize("tile", [50, 256])
def test_completion_in_tiles(spark, tile):
    rng = np.random.default_rng(5)
    shape = (90, 130)
    images = {1: np.where(rng.random(shape) < 0.002, rng.random(shape) * 40 + 1, 0.0), 2: np.where(rng.random(shape) < 0.05, rng.random(shape) * 9 + 1, 0.0)}
    found = raster.densify_morphological(frame(spark, images, "depth"), 130, 90, tile=tile)
    for k, image in images.items():
        want = np.where(image > 0, image, raster.completed(image))
        assert np.allclose(array(found, k, shape, "depth"), want, atol=1e-9)


def test_blobs():
    mask = np.zeros((6, 9), bool)
    mask[[0, 1, 2, 1, 0], [0, 1, 2, 3, 4]] = True  # a zigzag over corners
    mask[5, 5:] = True
    label = raster._blobs(mask)
    assert len(set(label[mask])) == 2 and label[0, 4] == 0 and label[5, 8] == 5 * 9 + 5


def test_empty_images(spark):
    none = frame(spark, {}, "grey")
    assert raster.canny_edges(none, 10, 10).count() == 0
    assert raster.densify_morphological(frame(spark, {}, "depth"), 10, 10).count() == 0


def test_lookups_build_only_the_tiles_that_are_asked_for(spark):
    """Samples of whole and damaged images, by a broadcast of the asked tiles and by a shuffle, against plain look-ups."""
    rng = np.random.default_rng(8)
    h, w = 35, 50
    images = {k: rng.integers(1, 255, (h, w)).astype(float) * (rng.random((h, w)) > 0.05) for k in (1, 2)}
    pixels = frame(spark, images, "grey")
    asked = [(1 + k % 3, k, float(u), float(v)) for k, (u, v) in enumerate(zip(rng.random(300) * (w - 1), rng.random(300) * (h - 1)))]
    asked += [(1, 900, 7.5, 7.5), (1, 901, 8.0, 8.0), (2, 902, 15.25, 0.0)]
    points = spark.createDataFrame(asked, "cam_id long, point_id long, u double, v double")
    at = points.selectExpr("cam_id", "point_id", "cast(floor(v) as int) iv", "cast(floor(u) as int) iu")
    want, near = {}, {}
    for cam, k, u, v in asked:
        y, x = int(v), int(u)
        if cam in images:
            near |= {k: images[cam][y, x]} if images[cam][y, x] else {}
            four = images[cam][[y, y, min(y + 1, h - 1), min(y + 1, h - 1)], [x, min(x + 1, w - 1), x, min(x + 1, w - 1)]]
            if four.all():
                fx, fy = u - x, v - y
                want[k] = four @ [(1 - fx) * (1 - fy), fx * (1 - fy), (1 - fx) * fy, fx * fy] / 255
    for limit in (0, 1000):
        found = {r.point_id: r.grey for r in raster.bilinear(points, pixels, w, h, ["grey"], broadcast_tiles=limit).collect()}
        assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-12 for k in want)
        assert {r.point_id: r.grey for r in raster.gather(at, pixels, ["grey"], broadcast_tiles=limit).collect()} == near
