"""Focal kernels, heights and climbs against whole-grid and plain programs."""

import numpy as np
import pytest

from meridian.operators import raster


@pytest.fixture(scope="module")
def grid():
    rng = np.random.default_rng(4)
    g = rng.normal(100, 30, (37, 41))
    g[rng.random(g.shape) < 0.05] = np.nan
    g[8:16, 8:16] = np.nan  # a tile that doesn't exist
    return g


@pytest.fixture(scope="module")
def pixels(spark, grid):
    return spark.createDataFrame([(int(x), int(y), float(grid[y, x])) for y, x in zip(*np.nonzero(~np.isnan(grid)))] + [(None, 1, 2.0), (3, 3, None)], "x long, y long, height double").cache()


def whole(grid, halo, kernel):
    """The kernel over the whole grid at once."""
    return kernel(np.pad(grid, halo, constant_values=np.nan), halo)


@pytest.mark.parametrize("n", [5, 8, 64])
def test_focal_kernels_do_not_depend_on_tiles(spark, grid, pixels, n):
    tiles = raster.tiled(pixels, n)
    for kernel, halo in ((raster.blur(1.5), 3), (raster.position_index, 2), (raster.hillshade(30.0), 1)):
        got = {(r.x, r.y): r.height for r in raster.pixels_of(raster.focal(tiles, n, halo, kernel), n).collect()}
        want = whole(grid, halo, kernel)
        assert set(got) == {(int(x), int(y)) for y, x in zip(*np.nonzero(~np.isnan(want)))} and all(v == want[y, x] for (x, y), v in got.items())
    assert raster.focal(tiles.limit(0), n, 1, raster.position_index).count() == 0
    with pytest.raises(ValueError):
        raster.focal(tiles, n, n + 1, raster.position_index)


def test_hillshade_faces_the_light():
    y, x = np.mgrid[0:9, 0:9].astype(float)
    light = lambda g: float(raster.hillshade(1.0)(g, 1)[3, 3])
    flat = light(x * 0)
    assert abs(flat - 255 * np.sin(np.radians(45))) < 1e-9
    assert light(x + y) > flat > light(-x - y)  # a slope that falls to the north-west faces the light


def test_heights_between_pixels(spark, grid, pixels):
    rng = np.random.default_rng(5)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-1, 40, (300, 2)))] + [(400, 3.0, 4.0), (401, 3.5, 4.0), (402, None, 1.0), (403, 36.0, 40.0)] + [(500 + i, 20.25, 20.5) for i in range(200)]
    got = {r.point_id: r.height for r in raster.heights_at(spark.createDataFrame(points, "point_id long, x double, y double"), raster.tiled(pixels, 8), 8).collect()}
    assert len(got) == len(points)
    for i, x, y in points:
        want = None
        if x is not None:
            a, b = int(np.floor(x)), int(np.floor(y))
            corners = [((1 - abs(x - a - dx)) * (1 - abs(y - b - dy)), grid[b + dy, a + dx] if 0 <= b + dy < 37 and 0 <= a + dx < 41 else np.nan) for dx in (0, 1) for dy in (0, 1)]
            corners = [(w, v) for w, v in corners if w > 0]
            want = sum(w * v for w, v in corners) if not any(np.isnan(v) for _, v in corners) else None
        assert (got[i] is None) == (want is None) and (want is None or abs(got[i] - want) < 1e-9)


def test_climbs(spark):
    rng = np.random.default_rng(6)
    rows = [(w, k, float(rng.uniform(0, 50)), float(rng.uniform(0, 50)), float(rng.normal(0, 10)) if rng.random() < 0.9 else None) for w in range(20) for k in range(int(rng.integers(1, 40)))]
    rows += [(30, 0, None, 1.0, 5.0), (31, 0, 1.0, 1.0, None), (None, 0, 1.0, 1.0, 1.0)]
    got = {r.way: (r.length, r.climb, r.descent) for r in raster.climbs(spark.createDataFrame(rows, "way long, ord long, x double, y double, height double"), 60.0).collect()}
    for w in range(20):
        at, seen, taken, before = 0.0, set(), [], None
        known = [r for r in rows if r[0] == w and r[4] is not None]
        for r in (r for r in rows if r[0] == w):
            at += np.hypot(r[2] - before[2], r[3] - before[3]) if before else 0.0
            before = r
            if r[4] is not None and (at // 60.0 not in seen or r is known[-1]):
                seen.add(at // 60.0)
                taken.append(r[4])
        d = np.diff(taken)
        assert np.allclose(got[w], (at, d[d > 0].sum(), -d[d < 0].sum()))
    assert got[31] == (0, 0, 0) and 30 not in got and None not in got
