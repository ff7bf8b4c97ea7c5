"""Queries on nearest things, deltas of snapshots, pairs of runs, follow-ups and storage, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.operators import joins, nearness, reports
from meridian.plans.queries import query, r


def _xy(df, key, name, x, y, a, b):
    k = F.col(key)
    return df.select(k.alias(name), (k * a % 1000).alias(x), (k * b % 1000).alias(y))


@query("""WITH p AS (SELECT c_custkey AS point_id, CAST(c_custkey * 37 % 1000 AS DOUBLE) AS px, CAST(c_custkey * 91 % 1000 AS DOUBLE) AS py FROM customer),
s AS (SELECT o_orderkey AS segment_id, CAST(o_orderkey * 53 % 1000 AS DOUBLE) AS ax, CAST(o_orderkey * 29 % 1000 AS DOUBLE) AS ay, CAST(o_orderkey % 40 - 20 AS DOUBLE) AS dx, CAST(o_orderkey * 7 % 40 - 20 AS DOUBLE) AS dy FROM orders),
t AS (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(((px - ax) * dx + (py - ay) * dy) / nullif(dx * dx + dy * dy, 0), 0.0::DOUBLE))) AS t FROM p JOIN s ON px BETWEEN ax - 40 AND ax + 40 AND py BETWEEN ay - 40 AND ay + 40),
d AS (SELECT *, sqrt((px - (ax + t * dx)) * (px - (ax + t * dx)) + (py - (ay + t * dy)) * (py - (ay + t * dy))) AS distance FROM t)
SELECT point_id, arg_min(segment_id, struct_pack(d := distance, i := segment_id)) AS segment_id, round(min(distance), 4) AS distance FROM d WHERE distance <= 15 GROUP BY 1""")
def nearest_segment(spark, load):
    """The nearest road of each point within 15; roads are up to 28 long."""
    k = F.col("o_orderkey")
    points = _xy(load("customer"), "c_custkey", "point_id", "px", "py", 37, 91)
    starts = _xy(load("orders"), "o_orderkey", "segment_id", "ax", "ay", 53, 29)
    roads = starts.withColumn("bx", F.col("ax") + F.col("segment_id") % 40 - 20).withColumn("by", F.col("ay") + F.col("segment_id") * 7 % 40 - 20)
    return nearness.nearest_segments(points, roads, 20.0, 15.0).select("point_id", "segment_id", r("distance").alias("distance"))


@query("""WITH l AS (SELECT s_suppkey AS left_id, s_suppkey * 53 % 1000 AS x, s_suppkey * 29 % 1000 AS y FROM supplier), q AS (SELECT c_custkey AS right_id, c_custkey * 37 % 1000 AS rx, c_custkey * 91 % 1000 AS ry FROM customer),
d AS (SELECT left_id, right_id, sqrt(CAST((x - rx) * (x - rx) + (y - ry) * (y - ry) AS DOUBLE)) AS distance FROM l, q)
SELECT left_id, CAST(rank AS INTEGER) AS rank, right_id, round(distance, 4) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY distance, right_id) AS rank FROM d) WHERE rank <= 5""")
def nearest_five(spark, load):
    """The five customers that are nearest to each supplier, without a radius."""
    left, right = _xy(load("supplier"), "s_suppkey", "left_id", "lx", "ly", 53, 29), _xy(load("customer"), "c_custkey", "right_id", "rx", "ry", 37, 91)
    return nearness.nearest_k(left, right, 5, 10.0).select("left_id", "rank", "right_id", r("distance").alias("distance"))


@query("""WITH a AS (SELECT p_partkey, p_name, p_size FROM part WHERE p_partkey % 7 <> 0), b AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS p_size FROM part WHERE p_partkey % 11 <> 0)
SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, coalesce(b.p_name, a.p_name) AS p_name, coalesce(b.p_size, a.p_size) AS p_size, CASE WHEN a.p_partkey IS NULL THEN 'added' WHEN b.p_partkey IS NULL THEN 'deleted' ELSE 'changed' END AS change
FROM a FULL OUTER JOIN b ON a.p_partkey = b.p_partkey WHERE a.p_partkey IS NULL OR (b.p_partkey IS NULL AND a.p_partkey IN (SELECT p_partkey FROM part WHERE p_size % 2 = 0)) OR (b.p_partkey IS NOT NULL AND a.p_size <> b.p_size)""")
def snapshot_delta(spark, load):
    """Added and changed parts, and tombstones for those that are gone and were edited."""
    part = load("part")
    later = part.filter("p_partkey % 11 <> 0").withColumn("p_size", F.when(F.col("p_partkey") % 5 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return joins.snapshot_delta(part.filter("p_partkey % 7 <> 0"), later, ["p_partkey"], ["p_name", "p_size"], part.filter("p_size % 2 = 0").select("p_partkey"))


@query("""WITH g AS (SELECT o_custkey AS k, year(o_orderdate) AS run, max(o_orderstatus) AS found FROM orders GROUP BY 1, 2),
n AS (SELECT a.run AS first_run, b.run AS second_run, a.found AS first_group, b.found AS second_group, count(*) AS n FROM g a JOIN g b ON a.k = b.k AND a.run < b.run GROUP BY 1, 2, 3, 4)
SELECT CAST(first_run AS INTEGER) AS first_run, CAST(second_run AS INTEGER) AS second_run, first_group, second_group, n, round(n / sum(n) OVER (PARTITION BY first_run, second_run, second_group), 4) AS share FROM n""")
def run_pairs(spark, load):
    """How results moved between groups, for each two runs (years)."""
    results = load("orders").select("o_custkey", F.year("o_orderdate").alias("run"), F.col("o_orderstatus").alias("found"))
    return reports.run_pairs(results, "o_custkey", "run", "found").withColumn("share", r("share"))


@query("""WITH e AS (SELECT event_type AS uri, CASE WHEN value > 20 THEN user_id END AS account, props AS address, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events WHERE NOT (event_type = 'signup' AND value > 20)),
a AS (SELECT uri, 'a' || account AS who, min(t) AS t FROM e WHERE account IS NOT NULL GROUP BY 1, 2), i AS (SELECT uri, 'i' || address AS who, min(t) AS t FROM e WHERE address IS NOT NULL GROUP BY 1, 2),
u AS (SELECT uri, count(DISTINCT account) AS accounts, count(DISTINCT address) AS addresses FROM e GROUP BY 1),
p AS (SELECT x.uri AS first_uri, y.uri AS next_uri, y.t - x.t AS delay FROM a x JOIN a y ON x.who = y.who AND x.uri <> y.uri AND x.t < y.t
  UNION ALL SELECT x.uri, y.uri, y.t - x.t FROM i x JOIN i y ON x.who = y.who AND x.uri <> y.uri AND x.t < y.t JOIN u v ON v.uri = x.uri JOIN u w ON w.uri = y.uri WHERE v.accounts = 0 OR w.accounts = 0)
SELECT first_uri, next_uri, count(*) AS followers, CAST(trunc(median(delay)) AS BIGINT) AS delay FROM p JOIN u ON u.uri = first_uri GROUP BY 1, 2, accounts, addresses HAVING 100 * count(*) > CASE WHEN accounts > 0 THEN accounts ELSE addresses END""")
def uri_delays(spark, load):
    """Followers of a URI and their median delay, by account, or by address where a URI has no accounts."""
    seconds = F.floor(F.col("ts").cast("timestamp").cast("double")).cast("long")
    events = load("events").filter("not (event_type = 'signup' and value > 20)")
    touches = events.select(F.col("event_type").alias("uri"), F.when(F.col("value") > 20, F.col("user_id")).alias("account"), F.col("props").alias("address"), seconds.alias("t"))
    return reports.followups(touches)


@query("""WITH f AS (SELECT user_id, event_type, props, ts, event_id, CAST(round(value) AS BIGINT) - 20 AS size FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, props ORDER BY ts DESC, event_id DESC) AS v FROM f)
SELECT user_id, count(*) FILTER (WHERE size >= 0) AS versions, count(*) FILTER (WHERE size >= 0 AND v = 1) AS files, CAST(coalesce(sum(size) FILTER (WHERE size >= 0 AND v = 1), 0) AS BIGINT) AS newest_size, CAST(coalesce(sum(size) FILTER (WHERE size >= 0), 0) AS BIGINT) AS all_size FROM n GROUP BY 1""")
def storage_usage(spark, load):
    """Files by type and name; a negative size is a tombstone, and a file whose newest version is one doesn't count."""
    files = load("events").select("user_id", "event_type", "props", F.struct("ts", "event_id").alias("at"), (F.round("value").cast("long") - 20).alias("size"))
    return reports.storage_usage(files, "user_id", ["event_type", "props"], "at", "size")
