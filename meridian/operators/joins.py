"""Joins that Spark has no single operator for.

Unless said otherwise: null keys and null coordinates meet nothing, repeated rows count as rows of their own, ties go as stated, and empty
tables give empty results (an outer join keeps the other side). Helper columns begin with an underscore; inputs must not use such names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.nearness import bundled, crowded_join, unbundled


def nearest_in_time(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: Sequence[str], tie: str) -> DataFrame:
    """As-of join to the nearest right row of the key; ties go to the smaller ``tie``.

    Both sides become one table in time order per key; the last right row before and the first one after
    each left row are found by windows, so no left row meets all right rows of its key.
    """
    both = left.withColumn("_side", F.lit(1)).withColumn("_t", F.col(left_time))
    nothing = F.struct(*(F.lit(None).cast(right.schema[c].dataType).alias(c) for c in (right_time, tie, *values)))
    both = both.withColumn("_r", nothing)
    own = F.struct(*(F.col(c) for c in (right_time, tie, *values)))
    other = right.groupBy(key, right_time).agg(F.min_by(own, tie).alias("_r")).select(
        key, *(F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema if f.name != key), F.lit(0).alias("_side"), F.col(right_time).alias("_t"), "_r"
    )
    rows = both.unionByName(other)
    back = Window.partitionBy(key).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(key).orderBy(F.desc("_t"), "_side").rowsBetween(Window.unboundedPreceding, 0)
    real = F.when(F.col("_side") == 0, F.col("_r"))
    found = rows.withColumn("_b", F.last(real, ignorenulls=True).over(back)).withColumn("_a", F.last(real, ignorenulls=True).over(ahead)).filter("_side = 1")
    gap = lambda c: F.abs(F.col("_t").cast("double") - F.col(c)[right_time].cast("double"))
    closer = F.col("_b").isNotNull() & (F.col("_a").isNull() | (gap("_b") < gap("_a")) | ((gap("_b") == gap("_a")) & (F.col("_b")[tie] <= F.col("_a")[tie])))
    pick = F.when(closer, F.col("_b")).otherwise(F.col("_a"))
    return found.withColumn("_p", pick).select(*left.columns, *(F.col("_p")[c].alias(c) for c in values))


def active_periods(intervals: DataFrame, start: str, end: str, unit: str = "month") -> DataFrame:
    """One row per interval and period that it touches."""
    grid = F.sequence(F.date_trunc(unit, start), F.date_trunc(unit, end), F.expr(f"interval 1 {unit}"))
    return intervals.withColumn("period", F.explode(grid))


def reconcile(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str, tolerance: float = 0.005) -> DataFrame:
    """Full outer join with both values (0 where missing), their difference and a status."""
    a, b = F.coalesce(left_value, F.lit(0.0)), F.coalesce(right_value, F.lit(0.0))
    status = (
        F.when(F.col(left_value).isNull(), "only_right").when(F.col(right_value).isNull(), "only_left")
        .when(F.abs(a - b) <= tolerance, "equal").when(a > b, "under").otherwise("over")
    )
    return left.join(right, key, "full_outer").select(key, a.alias(left_value), b.alias(right_value), (a - b).alias("difference"), status.alias("status"))


def snapshot_diff(start: DataFrame, end: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """key and change (added, deleted, changed) between two snapshots; nulls compare equal."""
    a = start.select(key, F.struct(*attributes).alias("was"))
    b = end.select(key, F.struct(*attributes).alias("is"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "deleted").when(~F.col("was").eqNullSafe(F.col("is")), "changed")
    return a.join(b, key, "full_outer").select(key, change.alias("change")).filter("change is not null")


def snapshot_delta(start: DataFrame, end: DataFrame, key: Sequence[str], attributes: Sequence[str], modified: DataFrame | None = None) -> DataFrame:
    """(key, attributes, change): what must be added to ``start`` to get ``end``: rows that are added or changed, and tombstones.

    Rows of ``end`` whose attributes differ (nulls equal each other) or that ``start`` lacks are kept with their attributes. A row that ``end`` lacks
    becomes a tombstone, change ``deleted``, with the attributes that it had; but if ``modified`` (the first key column's values that were edited)
    has any row, only if it is listed there or has a null id, since others merely left the cut-out. Of rows of one key the largest counts;
    keys that are null belong together.
    """
    one = lambda df, name: df.groupBy(*key).agg(F.max(F.struct(*attributes)).alias(name))
    a, b = one(start, "_was"), one(end, "_is")
    both = a.alias("a").join(b.alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key], "full_outer")
    both = both.select(*(F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in key), "_was", "_is")
    change = F.when(F.col("_was").isNull(), "added").when(F.col("_is").isNull(), "deleted").when(~F.col("_was").eqNullSafe(F.col("_is")), "changed")
    out = both.select(*key, F.coalesce("_is", "_was").alias("_now"), change.alias("change")).filter("change is not null")
    if modified is not None:
        listed = modified.select(F.col(modified.columns[0]).alias(key[0])).filter(F.col(key[0]).isNotNull()).distinct().withColumn("_listed", F.lit(True))
        some = modified.agg((F.count("*") > 0).alias("_some"))  # one row
        out = out.join(listed, key[0], "left").join(F.broadcast(some))
        out = out.filter((F.col("change") != "deleted") | ~F.col("_some") | F.col("_listed") | F.col(key[0]).isNull())
    return out.select(*key, *(F.col(f"_now.{c}").alias(c) for c in attributes), "change")


def _meeting(left: DataFrame, right: DataFrame, cell: float, predicate: Column, a: Sequence[str], b: Sequence[str], weights: Sequence[Column | None]) -> DataFrame:
    """Rows whose rectangles meet, by grid cells: each pair is made only in the cell that owns it, that of the lower left corner of the common part."""

    def cells(df: DataFrame, box: Sequence[str]) -> DataFrame:
        span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
        return df.withColumn("_cx", F.explode(span(box[0], box[2]))).withColumn("_cy", F.explode(span(box[1], box[3])))

    owner = (F.col("_cx") == F.floor(F.greatest(a[0], b[0]) / cell)) & (F.col("_cy") == F.floor(F.greatest(a[1], b[1]) / cell))
    return crowded_join(cells(left, a), cells(right, b), ["_cx", "_cy"], weights=weights).filter(owner & predicate).drop("_cx", "_cy")


def grid_join(
    left: DataFrame, right: DataFrame, cell: float, predicate: Column, a: Sequence[str], b: Sequence[str], derived: dict[str, Column] | None = None
) -> DataFrame:
    """Rectangles that meet, by grid cells.

    ``a`` and ``b`` name (min x, min y, max x, max y) of either side; ``predicate`` and the ``derived`` columns look at these columns only. Rows of one
    rectangle are compared as one, and paired row by row at the end.
    """
    one, other = bundled(left, list(dict.fromkeys(a)), "_l"), bundled(right, list(dict.fromkeys(b)), "_r")
    met = _meeting(one, other, cell, predicate, a, b, [F.size("_l"), F.size("_r")]).withColumns(derived or {})
    return unbundled(met, {"_l": left.columns, "_r": right.columns})


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a ray from the point to the right crosses an odd number of edges of ``ring``, an array of (x, y) that closes itself."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))

    def crosses(p: Column, q: Column) -> Column:
        at = F.try_divide((q["x"] - p["x"]) * (y - p["y"]), q["y"] - p["y"]) + p["x"]
        return ((p["y"] > y) != (q["y"] > y)) & (x < at)

    return F.size(F.filter(F.zip_with(ring, following, crosses), lambda c: c)) % 2 == 1


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float) -> DataFrame:
    """Pairs of a point and a polygon around it; points: x, y and others; polygons: ring (array of x, y doubles) and others.

    Both sides meet in grid cells of the polygons' boxes. ``cell`` should be near the size of a common
    polygon: a ring is sent once for each cell that its box touches. Points of one place are compared as one. Points with a null coordinate and
    polygons without a ring meet nothing.
    """
    edge = lambda f, c: f(F.transform("ring", lambda v: v[c]))
    boxed = polygons.filter(F.size("ring") > 0).withColumns({
        "_x0": edge(F.array_min, "x"), "_y0": edge(F.array_min, "y"), "_x1": edge(F.array_max, "x"), "_y1": edge(F.array_max, "y"),
    })
    located = bundled(points, ["x", "y"], "_points")
    inside = in_ring(F.col("x"), F.col("y"), F.col("ring"))
    names = ["_x0", "_y0", "_x1", "_y1"]
    around = _meeting(located, boxed, cell, inside, ["x", "y", "x", "y"], names, [F.size("_points"), None])
    return unbundled(around.drop(*names), {"_points": points.columns})


def nearest_within(left: DataFrame, right: DataFrame, cell: float, radius: float, a: Sequence[str], b: Sequence[str], left_id: str, right_id: str) -> DataFrame:
    """Nearest other right point within ``radius`` (excluded) on the plane; ties go to the smaller id. ``cell`` >= radius.

    Points of one place are one point until the end. As a point passes over its own id only, the two smallest ids of a place, and the two nearest
    ids of a point, are enough.
    """
    steps = F.explode(F.array(*(F.lit(k) for k in (-1, 0, 1))))
    wide = left.select(*a).dropna().distinct().withColumn("_dx", steps).withColumn("_dy", steps)
    wide = wide.withColumn("_cx", F.floor(F.col(a[0]) / cell) + F.col("_dx")).withColumn("_cy", F.floor(F.col(a[1]) / cell) + F.col("_dy")).drop("_dx", "_dy")
    two = lambda df, by, *order: df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_k <= 2").drop("_k")
    own = two(right.select(*b, right_id).dropna().distinct(), b, right_id)
    own = own.withColumn("_cx", F.floor(F.col(b[0]) / cell)).withColumn("_cy", F.floor(F.col(b[1]) / cell))
    d2 = F.pow(F.col(a[0]) - F.col(b[0]), 2) + F.pow(F.col(a[1]) - F.col(b[1]), 2)
    near = crowded_join(wide, own, ["_cx", "_cy"]).withColumn("d2", d2).filter(F.col("d2") < radius * radius)
    best = two(near.groupBy(*a, right_id).agg(F.min("d2").alias("d2")), a, "d2", right_id)
    best = best.groupBy(*a).agg(F.array_sort(F.collect_list(F.struct("d2", F.col(right_id).alias("id")))).alias("_best"))
    other = F.get(F.filter("_best", lambda m: m["id"] != F.col(left_id)), F.lit(0))
    found = crowded_join(left.select(left_id, *a), best, a).groupBy(left_id).agg(F.min(other).alias("m")).filter("m is not null")
    return found.select(left_id, F.col("m.id").alias(right_id), F.sqrt("m.d2").alias("distance"))


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` that a defaulting left join would flag as missing."""
    return left.join(right.select(key).distinct(), key, "left_anti")


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``, as SQL says NOT IN: a null among the right keys leaves no rows, and a null
    left key passes only where ``right`` is empty."""
    known = right.agg(F.count("*").alias("_rows"), F.count_if(F.col(key).isNull()).alias("_nulls"))  # one row
    rest = left.join(right.select(key), key, "left_anti").join(F.broadcast(known))
    return rest.filter((F.col("_rows") == 0) | ((F.col("_nulls") == 0) & F.col(key).isNotNull())).select(*left.columns)
