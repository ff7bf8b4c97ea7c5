"""Rasters in square tiles: cutting, focal kernels with halos from the neighbours, heights of points, climb of ways.

A tile is a row (tx, ty, heights): ``heights`` has n x n doubles, row by row, null where the raster has no value; its pixels are those with
floor(x / n) = tx and floor(y / n) = ty. Tiles that don't exist have no values. Repeated tiles of one place are an error of the
input (the one with the larger list counts); empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.nearness import crowded_join

TILE = "tx long, ty long, heights array<double>"


def tiled(pixels: DataFrame, n: int) -> DataFrame:
    """Tiles of (x, y, height) pixels; of several heights of a pixel the largest counts. A tile has n x n pixels at most, so no group grows."""
    x, y = F.col("x").cast("long"), F.col("y").cast("long")
    one = pixels.filter("x is not null and y is not null and height is not null").groupBy(x.alias("x"), y.alias("y")).agg(F.max("height").cast("double").alias("h"))
    tx, ty = F.floor(F.col("x") / n), F.floor(F.col("y") / n)
    place = ((F.col("y") - ty * n) * n + F.col("x") - tx * n).cast("int")
    held = one.groupBy(tx.alias("tx"), ty.alias("ty")).agg(F.map_from_entries(F.collect_list(F.struct(place.alias("k"), F.col("h").alias("v")))).alias("m"))
    return held.select("tx", "ty", F.transform(F.sequence(F.lit(0), F.lit(n * n - 1)), lambda k: F.try_element_at("m", k)).alias("heights"))


def pixels_of(tiles: DataFrame, n: int, name: str = "height") -> DataFrame:
    """(x, y, height) of the pixels that have a value."""
    each = tiles.select("tx", "ty", F.posexplode("heights").alias("k", name)).filter(F.col(name).isNotNull())
    return each.select((F.col("tx") * n + F.col("k") % n).alias("x"), (F.col("ty") * n + F.floor(F.col("k") / n)).alias("y"), name)


def focal(tiles: DataFrame, n: int, halo: int, kernel: Callable[[np.ndarray, int], np.ndarray]) -> DataFrame:
    """Tiles after a kernel that looks ``halo`` pixels (n at most) around each pixel.

    ``kernel(window, halo)`` gets a tile with its halo, NaN where there is no value, and returns the tile. A tile sends its neighbours only the
    strips that they need; a task holds one tile. The result doesn't depend on how the raster was cut.
    """
    if not 0 <= halo <= n:
        raise ValueError("the halo is wider than a tile")
    tiles = tiles.select(F.col("tx").cast("long").alias("tx"), F.col("ty").cast("long").alias("ty"), F.col("heights").cast("array<double>").alias("heights"))
    tiles = tiles.groupBy("tx", "ty").agg(F.max("heights").alias("heights"))

    def strip(dx: int, dy: int) -> Column:
        """What the neighbour at (dx, dy) needs of a tile."""
        cut = lambda d: (0, n - 1) if d == 0 else (0, halo - 1) if d < 0 else (n - halo, n - 1)
        (c0, c1), (r0, r1) = cut(dx), cut(dy)
        rows = F.transform(F.sequence(F.lit(r0), F.lit(r1)), lambda r: F.slice("heights", r * n + c0 + 1, F.lit(c1 - c0 + 1)))
        return F.struct((F.col("tx") + dx).alias("tx"), (F.col("ty") + dy).alias("ty"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.flatten(rows).alias("part"))

    around = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if halo or (dx, dy) == (0, 0)]
    sent = tiles.select(F.explode(F.array(*(strip(dx, dy) for dx, dy in around))).alias("s")).select("s.*")

    def meet(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        if not any(r["dx"] == r["dy"] == 0 for r in rows):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.list_(pa.float64()))], ["tx", "ty", "heights"])
        window = np.full((n + 2 * halo, n + 2 * halo), np.nan)
        place = {0: slice(halo, halo + n), -1: slice(halo + n, None), 1: slice(0, halo)}  # a neighbour at the left sends to the right, and so on
        for r in rows:
            target = window[place[r["dy"]], place[r["dx"]]]
            target[:] = np.array([np.nan if v is None else v for v in r["part"]], float).reshape(target.shape)
        out = kernel(window, halo)
        flat = pa.array([[None if v != v else v for v in out.ravel().tolist()]], pa.list_(pa.float64()))
        return pa.table([pa.array([rows[0]["tx"]], pa.int64()), pa.array([rows[0]["ty"]], pa.int64()), flat], ["tx", "ty", "heights"])

    return sent.groupBy("tx", "ty").applyInArrow(meet, TILE)


def _shifted(window: np.ndarray, halo: int, dy: int, dx: int) -> np.ndarray:
    h, w = window.shape
    return window[halo + dy : h - halo + dy, halo + dx : w - halo + dx]


def blur(sigma: float) -> Callable[[np.ndarray, int], np.ndarray]:
    """Gaussian mean of the values around; pixels without a value stay so."""

    def kernel(window: np.ndarray, halo: int) -> np.ndarray:
        total = weight = 0.0
        for dy in range(-halo, halo + 1):
            for dx in range(-halo, halo + 1):
                w, v = np.exp(-(dx * dx + dy * dy) / (2 * sigma * sigma)), _shifted(window, halo, dy, dx)
                total, weight = total + np.where(np.isnan(v), 0.0, v * w), weight + np.where(np.isnan(v), 0.0, w)
        return np.where(np.isnan(_shifted(window, halo, 0, 0)), np.nan, total / np.maximum(weight, 1e-300))

    return kernel


def position_index(window: np.ndarray, halo: int) -> np.ndarray:
    """Height above the mean of the other values within the halo; without any, 0."""
    own, total, count = _shifted(window, halo, 0, 0), 0.0, 0
    for dy in range(-halo, halo + 1):
        for dx in range(-halo, halo + 1):
            if dx or dy:
                v = _shifted(window, halo, dy, dx)
                total, count = total + np.where(np.isnan(v), 0.0, v), count + ~np.isnan(v)
    return np.where(count > 0, own - total / np.maximum(count, 1), own * 0.0)


def hillshade(pixel: float, azimuth: float = 315.0, altitude: float = 45.0) -> Callable[[np.ndarray, int], np.ndarray]:
    """Light (0 to 255) on slopes by the gradient over eight neighbours; a neighbour without a value has the pixel's own. Needs a halo of 1 or more.

    Rows run from north to south; ``azimuth`` is where the light comes from, clockwise from north.
    """

    def kernel(window: np.ndarray, halo: int) -> np.ndarray:
        own = _shifted(window, halo, 0, 0)

        def at(dy: int, dx: int) -> np.ndarray:
            v = _shifted(window, halo, dy, dx)
            return np.where(np.isnan(v), own, v)

        east = (at(-1, 1) + 2 * at(0, 1) + at(1, 1) - at(-1, -1) - 2 * at(0, -1) - at(1, -1)) / (8 * pixel)
        south = (at(1, -1) + 2 * at(1, 0) + at(1, 1) - at(-1, -1) - 2 * at(-1, 0) - at(-1, 1)) / (8 * pixel)
        up, around = np.radians(altitude), np.radians(azimuth)
        # the surface's normal is (-east, south, 1) to the east, north and up
        light = (-east * np.sin(around) * np.cos(up) + south * np.cos(around) * np.cos(up) + np.sin(up)) / np.sqrt(1 + east * east + south * south)
        return 255 * np.maximum(0.0, light)

    return kernel


def heights_at(points: DataFrame, tiles: DataFrame, n: int) -> DataFrame:
    """(point_id, height) of points (point_id, x, y; pixel units): bilinear between the four pixels around; null where one that counts has no value.

    A point is sent to the tiles of its pixels (one, two or four), and only weights travel with it. Tiles that many points need are dealt over tasks.
    Point ids are unique; points with a null coordinate have a null height.
    """
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    fx, fy = x - F.floor(x), y - F.floor(y)
    corner = lambda dx, dy, w: F.struct((F.floor(x) + dx).alias("px"), (F.floor(y) + dy).alias("py"), w.alias("w"))
    corners = F.array(corner(0, 0, (1 - fx) * (1 - fy)), corner(1, 0, fx * (1 - fy)), corner(0, 1, (1 - fx) * fy), corner(1, 1, fx * fy))
    each = points.filter("x is not null and y is not null").select("point_id", F.explode(F.filter(corners, lambda c: c["w"] > 0)).alias("c")).select("point_id", "c.*")
    sent = each.withColumn("tx", F.floor(F.col("px") / n)).withColumn("ty", F.floor(F.col("py") / n))
    sent = sent.select("point_id", "w", "tx", "ty", ((F.col("py") - F.col("ty") * n) * n + F.col("px") - F.col("tx") * n).cast("int").alias("k"))
    met = crowded_join(sent, tiles.select("tx", "ty", "heights"), ["tx", "ty"]).select("point_id", "w", F.get("heights", F.col("k")).alias("h")).filter("h is not null")
    # all weights must be there; they are products that add up to 1 but for rounding
    found = met.groupBy("point_id").agg(F.sum(F.col("w") * F.col("h")).alias("height"), F.sum("w").alias("weight"))
    found = found.select("point_id", F.when(F.col("weight") > 1 - 1e-9, F.col("height")).alias("height"))
    return points.select("point_id").join(found, "point_id", "left")


def climbs(points: DataFrame, step: float) -> DataFrame:
    """(way, length, climb, descent): sums of the rises and falls along each way, taken every ``step`` of its length.

    ``points``: way, ord, x, y, height. Of each stretch of ``step`` the first point with a height counts, and the way's last one, so that small ups and
    downs within a step don't add up. Points without coordinates or heights are passed over in the heights, those without coordinates in the length, too. A way is as
    long as the map's ways are, some thousand points; ties of ``ord`` go by x and y.
    """
    order = Window.partitionBy("way").orderBy("ord", "x", "y")
    located = points.filter("way is not null and x is not null and y is not null").select("way", "ord", "x", "y", "height")
    leg = F.coalesce(F.sqrt(F.pow(F.col("x") - F.lag("x").over(order), 2) + F.pow(F.col("y") - F.lag("y").over(order), 2)), F.lit(0.0))
    along = located.withColumn("leg", leg).withColumn("at", F.sum("leg").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    known = along.filter("height is not null").withColumn("stretch", F.floor(F.col("at") / step))
    first = F.row_number().over(Window.partitionBy("way", "stretch").orderBy("ord", "x", "y")) == 1
    last = F.row_number().over(Window.partitionBy("way").orderBy(F.desc("ord"), F.desc("x"), F.desc("y"))) == 1
    taken = known.withColumn("first", first).withColumn("last", last).filter("first or last")
    rise = F.col("height") - F.lag("height").over(order)
    sums = taken.withColumn("rise", rise).groupBy("way").agg(
        F.coalesce(F.sum(F.when(F.col("rise") > 0, F.col("rise"))), F.lit(0.0)).alias("climb"), F.coalesce(-F.sum(F.when(F.col("rise") < 0, F.col("rise"))), F.lit(0.0)).alias("descent")
    )
    return along.groupBy("way").agg(F.max("at").alias("length")).join(sums, "way", "left").select("way", "length", F.coalesce("climb", F.lit(0.0)).alias("climb"), F.coalesce("descent", F.lit(0.0)).alias("descent"))
