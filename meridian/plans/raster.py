"""Queries on rasters, and their SQL: a customer is a pixel, 32 in a row, its balance the height."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.operators import raster
from meridian.plans.queries import query, r

_PIXELS = "g AS (SELECT (c_custkey - 1) % 32 AS x, (c_custkey - 1) // 32 AS y, c_acctbal AS h FROM customer WHERE c_custkey % 41 <> 0)"


def _tiles(load, n):
    k = F.col("c_custkey") - 1
    return raster.tiled(load("customer").filter("c_custkey % 41 <> 0").select((k % 32).alias("x"), F.floor(k / 32).alias("y"), F.col("c_acctbal").alias("height")), n)


@query(f"""WITH {_PIXELS}
SELECT a.x, a.y, round(coalesce(any_value(a.h) - avg(b.h), 0), 8) + 0.0 AS height FROM g a LEFT JOIN g b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND (a.x <> b.x OR a.y <> b.y) GROUP BY 1, 2""")
def raster_position_index(spark, load):
    """Height above the neighbours' mean, over tiles of 8 x 8 with halos."""
    out = raster.pixels_of(raster.focal(_tiles(load, 8), 8, 1, raster.position_index), 8)
    return out.select("x", "y", (r("height", 8) + 0.0).alias("height"))


@query(f"""WITH {_PIXELS}, top AS (SELECT max(y) AS most FROM g),
p AS (SELECT o_orderkey AS point_id, (o_orderkey * 53 % 3000) / 100.0::DOUBLE AS x, (o_orderkey * 29 % (most * 100)) / 100.0::DOUBLE AS y FROM orders, top),
c AS (SELECT point_id, x, y, floor(x) + dx AS px, floor(y) + dy AS py, (CASE WHEN dx = 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END) * (CASE WHEN dy = 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END) AS w FROM p, (VALUES (0), (1)) a(dx), (VALUES (0), (1)) b(dy))
SELECT point_id, CASE WHEN count(*) = count(g.h) THEN round(sum(w * g.h), 6) + 0.0 END AS height FROM c LEFT JOIN g ON g.x = px AND g.y = py WHERE w > 0 GROUP BY 1""")
def point_heights(spark, load):
    """Heights of points between pixels."""
    most = load("customer").filter("c_custkey % 41 <> 0").agg(F.max(F.floor((F.col("c_custkey") - 1) / 32)).alias("most"))  # one row
    k = F.col("o_orderkey")
    points = load("orders").join(F.broadcast(most)).select(k.alias("point_id"), (k * 53 % 3000 / 100.0).alias("x"), (k * 29 % (F.col("most") * 100) / 100.0).alias("y"))
    return raster.heights_at(points, _tiles(load, 8), 8).select("point_id", (r("height", 6) + 0.0).alias("height"))


@query("""WITH p AS (SELECT o_custkey AS way, o_orderkey AS k, CAST(o_orderkey * 53 % 997 AS DOUBLE) AS x, CAST(o_orderkey * 29 % 991 AS DOUBLE) AS y, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS h FROM orders),
l AS (SELECT *, coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)), 0) AS leg FROM p WINDOW w AS (PARTITION BY way ORDER BY k)),
a AS (SELECT *, sum(leg) OVER (PARTITION BY way ORDER BY k ROWS UNBOUNDED PRECEDING) AS at_ FROM l),
t AS (SELECT *, row_number() OVER (PARTITION BY way, floor(at_ / 900) ORDER BY k) AS f, row_number() OVER (PARTITION BY way ORDER BY k DESC) AS b FROM a WHERE h IS NOT NULL),
s AS (SELECT way, h - lag(h) OVER (PARTITION BY way ORDER BY k) AS rise FROM t WHERE f = 1 OR b = 1)
SELECT n.way, round(n.length, 3) AS length, round(coalesce(sum(CASE WHEN rise > 0 THEN rise END), 0), 2) AS climb, round(coalesce(-sum(CASE WHEN rise < 0 THEN rise END), 0), 2) AS descent
FROM (SELECT way, max(at_) AS length FROM a GROUP BY 1) n LEFT JOIN s USING (way) GROUP BY 1, n.length""")
def way_climbs(spark, load):
    """Climb and descent of each customer's way through its orders, every 900 of its length."""
    k = F.col("o_orderkey")
    points = load("orders").select(F.col("o_custkey").alias("way"), k.alias("ord"), (k * 53 % 997).cast("double").alias("x"), (k * 29 % 991).cast("double").alias("y"), F.when(k % 7 != 0, F.col("o_totalprice")).alias("height"))
    return raster.climbs(points, 900.0).select("way", r("length", 3).alias("length"), r("climb", 2).alias("climb"), r("descent", 2).alias("descent"))
