"""Queries on rings, polygons and staged entities, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from meridian.operators import polygons as P
from meridian.plans.queries import query, r

_EDGES = """c0 AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1, 2),
p AS (SELECT l_orderkey AS relation, l_linenumber AS k, l_quantity AS q, l_partkey, row_number() OVER w AS i, count(*) OVER (PARTITION BY l_orderkey) AS n,
lead(l_linenumber) OVER w AS following, first_value(l_linenumber) OVER w AS least, lead(l_quantity) OVER w AS q2, first_value(l_quantity) OVER w AS q0, l_suppkey % 5 = 0 AS gap
FROM c0 WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber))"""


def _edges(lines):
    """Edges (relation, way, nodes, x, y of the first node): the line numbers of an order are the corners of a polygon around (0, 0), in turn."""
    lines = lines.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"), F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"))
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    whole = Window.partitionBy("l_orderkey")
    ahead = F.coalesce(F.lead("l_linenumber").over(w), F.min("l_linenumber").over(whole))
    angle = 2 * F.pi() * (F.row_number().over(w) - 1) / F.count("*").over(whole)
    node = lambda k: F.col("l_orderkey") * 8 + k
    own, other = node(F.col("l_linenumber")), node(ahead)
    nodes = F.when(F.col("l_partkey") % 2 == 0, F.array(own, other)).otherwise(F.array(other, own))
    return lines.select(
        F.col("l_orderkey").alias("relation"), node(F.col("l_linenumber") * 5 % 8).alias("way"), nodes.alias("nodes"), own.alias("id"),
        (F.col("l_quantity") * F.cos(angle)).alias("x"), (F.col("l_quantity") * F.sin(angle)).alias("y"), (F.col("l_suppkey") % 5 == 0).alias("gap"), F.count("*").over(whole).alias("n"),
    )


@query(f"""WITH {_EDGES},
e AS (SELECT *, CASE WHEN following IS NULL THEN q0 ELSE q2 END AS qn, 2 * pi() * (i - 1) / n AS a, 2 * pi() * (i % n) / n AS b FROM p WHERE n > 2)
SELECT relation, count(*) AS nodes, round(abs(sum(q * cos(a) * qn * sin(b) - qn * cos(b) * q * sin(a))) / 2, 4) AS area,
round(sum((q * cos(a) + qn * cos(b)) * (q * cos(a) * qn * sin(b) - qn * cos(b) * q * sin(a))) / (3 * sum(q * cos(a) * qn * sin(b) - qn * cos(b) * q * sin(a))), 3) + 0.0 AS cx FROM e GROUP BY 1""")
def ring_areas(spark, load):
    """Edges in any direction, joined to rings, with their areas and centres."""
    edges = _edges(load("lineitem")).filter("n > 2").withColumn("role", F.lit("outer"))
    keys = ["relation", "role"]
    found = P.located(P.rings(edges.select(*keys, "way", "nodes"), keys), edges.select("id", "x", "y"), keys).filter("closed and missing = 0")
    # a closed ring names its first node twice
    ring = F.slice("ring", F.lit(1), F.size("ring") - 1)
    return found.select("relation", F.size(ring).cast("long").alias("nodes"), r(F.abs(P.signed_area(ring))).alias("area"), (r(P.centroid(ring)["x"], 3) + 0.0).alias("cx"))


@query(f"""WITH {_EDGES},
e AS (SELECT relation, i, n, gap, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY relation ORDER BY i) AS before, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY relation) AS gaps FROM p WHERE n > 2),
c AS (SELECT relation, n, gaps, before % greatest(gaps, 1) AS chain, count(*) AS ways FROM e WHERE NOT gap GROUP BY 1, 2, 3, 4)
SELECT relation, gaps = 0 AS closed, count(*) AS chains, CAST(sum(ways) AS BIGINT) AS ways, CAST(sum(ways + 1) AS BIGINT) AS nodes, max(ways) AS longest FROM c GROUP BY 1, 2""")
def ring_chains(spark, load):
    """The same with gaps: what is left of a ring is one open chain for each stretch between gaps."""
    edges = _edges(load("lineitem")).filter("n > 2 and not gap")
    found = P.rings(edges.select("relation", "way", "nodes"), ["relation"])
    return found.groupBy("relation", "closed").agg(F.count("*").alias("chains"), F.sum("ways").alias("ways"), F.sum(F.size("nodes")).alias("nodes"), F.max("ways").alias("longest"))


_MEMBERS = """m AS (SELECT DISTINCT l_orderkey AS id, CASE WHEN l_quantity <= 6 THEN 'relation' WHEN l_quantity <= 30 THEN 'way' ELSE 'node' END AS type,
CASE WHEN l_quantity <= 6 THEN (l_partkey * 31 + l_orderkey) % (SELECT count(*) + count(*) // 4 FROM orders) WHEN l_quantity <= 30 THEN l_partkey ELSE l_suppkey END AS ref FROM lineitem)"""


@query(f"""WITH RECURSIVE {_MEMBERS},
c AS (SELECT o_orderkey AS root, o_orderkey AS id FROM orders UNION SELECT c.root, m.ref FROM c JOIN m ON m.id = c.id AND m.type = 'relation' JOIN orders ON o_orderkey = c.id),
d AS (SELECT DISTINCT root, type AS kind, ref AS id FROM c JOIN orders ON o_orderkey = c.id JOIN m USING (id) WHERE type <> 'relation'),
wn AS (SELECT DISTINCT l_partkey AS id, l_suppkey AS node FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size % 4 <> 0 AND l_linenumber = 1),
n AS (SELECT root, id FROM d WHERE kind = 'node' UNION SELECT root, node FROM d JOIN wn USING (id) WHERE kind = 'way')
SELECT root, 'relation' AS kind, id, id NOT IN (SELECT o_orderkey FROM orders) AS missing FROM c
UNION ALL SELECT root, kind, id, id NOT IN (SELECT p_partkey FROM part WHERE p_size % 4 <> 0) FROM d WHERE kind = 'way'
UNION ALL SELECT root, 'node', id, id NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey % 3 <> 0) FROM n""")
def staged_members(spark, load):
    """Orders are relations of orders, parts (ways) and suppliers (nodes); some of each aren't staged."""
    lines, orders = load("lineitem"), load("orders")
    n = orders.agg((F.count("*") + F.floor(F.count("*") / 4)).alias("n"))  # one row
    small = F.col("l_quantity") <= 6
    way = F.col("l_quantity") <= 30
    kind = F.when(small, "relation").when(way, "way").otherwise("node").alias("type")
    ref = F.when(small, (F.col("l_partkey") * 31 + F.col("l_orderkey")) % F.col("n")).when(way, F.col("l_partkey")).otherwise(F.col("l_suppkey")).alias("ref")
    members = lines.join(F.broadcast(n)).select(F.col("l_orderkey").alias("id"), kind, ref)
    ways = load("part").filter("p_size % 4 <> 0").select(F.col("p_partkey").alias("id"))
    way_nodes = lines.filter("l_linenumber = 1").select(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("node")).join(ways, "id", "left_semi")
    nodes = load("supplier").filter("s_nationkey % 3 <> 0").select(F.col("s_suppkey").alias("id"))
    return P.closure(members, {"relation": orders.select(F.col("o_orderkey").alias("id")), "way": ways, "node": nodes}, way_nodes)


@query("""WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS n FROM lineitem)
SELECT l_partkey, l_orderkey, l_linenumber FROM l WHERE n = 1""")
def staged_entities(spark, load):
    """Of the versions of an entity the one that was loaded last stays, whole."""
    versions = load("lineitem").select("l_partkey", "l_orderkey", "l_linenumber", F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("loaded"))
    return P.staged(versions, "l_partkey", "loaded").select("l_partkey", "l_orderkey", "l_linenumber")
