"""Queries on map objects and scalars, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from meridian.functions import scalars as X
from meridian.operators import maps
from meridian.plans.queries import query, r


@query("""SELECT o_orderkey AS way, coalesce(array_to_string(list(l_partkey ORDER BY l_linenumber, l_partkey) FILTER (WHERE l_partkey IS NOT NULL), ','), '') AS nodes FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 25) ON o_orderkey = l_orderkey GROUP BY 1""")
def way_nodes(spark, load):
    lines = load("lineitem").filter("l_quantity > 25").withColumnRenamed("l_orderkey", "o_orderkey")
    ways = maps.with_children(load("orders").select("o_orderkey"), lines, "o_orderkey", ["l_linenumber", "l_partkey"], ["l_partkey"], "nodes")
    return ways.select(F.col("o_orderkey").alias("way"), F.array_join(F.transform("nodes", lambda n: n["l_partkey"].cast("string")), ",").alias("nodes"))


@query("""WITH t AS (SELECT p_partkey AS item, p_partkey AS ord, 0 AS place, 'segment' AS tag, CASE WHEN p_size % 2 = 0 THEN 'BUILDING' ELSE 'HOUSEHOLD' END AS value FROM part
UNION ALL SELECT p_partkey, p_partkey, 1, 'nation', CAST(p_size AS VARCHAR) FROM part),
o AS (SELECT c_custkey AS object, 'segment' AS tag, c_mktsegment AS value FROM customer UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer)
SELECT object, arg_max(item, struct_pack(a := ord, b := place, c := item)) AS item FROM t JOIN o USING (tag, value) GROUP BY 1""")
def alternative_keys(spark, load):
    pair = lambda t, v: F.struct(F.lit(t).alias("tag"), v.alias("value"))
    keys = F.array(pair("segment", F.when(F.col("p_size") % 2 == 0, "BUILDING").otherwise("HOUSEHOLD")), pair("nation", F.col("p_size").cast("string")))
    items = load("part").select(F.col("p_partkey").alias("item"), F.col("p_partkey").alias("order"), keys.alias("keys"))
    tags = F.explode(F.array(pair("segment", F.col("c_mktsegment")), pair("nation", F.col("c_nationkey").cast("string"))))
    objects = load("customer").select(F.col("c_custkey").alias("object"), tags.alias("t")).select("object", "t.*")
    # only the last item of each tag value can be the last assignment of an object
    tried = items.select("item", "order", F.posexplode("keys").alias("place", "k"))
    last = tried.groupBy("k").agg(F.max(F.struct("order", "place", "item")).alias("m")).select(F.col("m.item").alias("item"), F.col("m.order").alias("order"), F.array("k").alias("keys"))
    return maps.assigned_by_tags(last, objects)


@query("""WITH a AS (SELECT o_custkey AS id, max(o_orderpriority) AS name FROM orders GROUP BY 1), b AS (SELECT user_id AS id, max(event_type) AS name, max(props) AS extra FROM events GROUP BY 1),
m AS (SELECT coalesce(a.id, b.id) AS id, coalesce(b.name, a.name) AS name FROM a FULL OUTER JOIN b ON a.id = b.id)
SELECT m.id, m.name, coalesce(c.title, 'none') AS title FROM m LEFT JOIN (VALUES ('click', 'Clicked'), ('view', 'Viewed'), ('5-low', 'Low')) c(k, title) ON lower(m.name) = c.k""")
def merged_lookup(spark, load):
    a = load("orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderpriority").alias("old"))
    b = load("events").groupBy(F.col("user_id").alias("id")).agg(F.max("event_type").alias("new"))
    names = spark.createDataFrame([("click", "Clicked"), ("view", "Viewed"), ("5-low", "Low")], "k string, title string")
    merged = a.join(b, "id", "full_outer").select("id", F.coalesce("new", "old").alias("name"))
    return merged.join(F.broadcast(names), F.lower("name") == F.col("k"), "left").select("id", "name", F.coalesce("title", F.lit("none")).alias("title"))


@query("""WITH p AS (SELECT c_custkey AS point_id, c_custkey * 37 % 1000 AS x, c_custkey * 91 % 1000 AS y FROM customer),
q AS (SELECT s_suppkey AS place_id, CASE WHEN s_suppkey % 3 = 0 THEN 'city' ELSE 'village' END AS kind, s_suppkey * 53 % 1000 AS px, s_suppkey * 29 % 1000 AS py FROM supplier)
SELECT point_id, place_id, kind, round(sqrt(pow(x - px, 2) + pow(y - py, 2)), 4) AS distance FROM p JOIN q ON sqrt(pow(x - px, 2) + pow(y - py, 2)) < CASE kind WHEN 'city' THEN 70 ELSE 30 END""")
def near_cities(spark, load):
    at = lambda k, a, b, x, y: [(F.col(k) * a % 1000).alias(x), (F.col(k) * b % 1000).alias(y)]
    points = load("customer").select(F.col("c_custkey").alias("point_id"), *at("c_custkey", 37, 91, "x", "y"))
    kind = F.when(F.col("s_suppkey") % 3 == 0, "city").otherwise("village").alias("kind")
    places = load("supplier").select(F.col("s_suppkey").alias("place_id"), kind, *at("s_suppkey", 53, 29, "px", "py"))
    return maps.within_type_radius(points, places, {"city": 70.0, "village": 30.0}).withColumn("distance", r("distance"))


@query("""WITH p AS (SELECT c_custkey AS point FROM customer), e AS (SELECT o_custkey AS a, o_orderkey % (SELECT count(*) FROM customer) AS b, o_orderkey AS id FROM orders)
SELECT point, (SELECT count(*) FROM e WHERE e.a = point) AS outgoing, (SELECT count(*) FROM e WHERE e.b = point) AS incoming FROM p""")
def edges_per_point(spark, load):
    n = load("customer").agg(F.count("*").alias("n"))
    edges = load("orders").join(F.broadcast(n)).select(F.col("o_custkey").alias("a"), (F.col("o_orderkey") % F.col("n")).alias("b"))
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("point"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("b").alias("point"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e"))
    counts = ends.groupBy("e.point").agg(F.sum("e.o").alias("outgoing"), F.sum("e.i").alias("incoming"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return load("customer").select(F.col("c_custkey").alias("point")).join(counts, "point", "left").select("point", zero("outgoing"), zero("incoming"))


@query("""WITH t AS (SELECT doc_id // 4 AS title, lang, min(doc_id) AS id, max(CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END) AS banner FROM documents GROUP BY 1, 2)
SELECT a.title, a.lang, coalesce(nullif(a.banner, ''), b.banner) AS banner FROM t a LEFT JOIN t b ON a.title = b.title AND b.lang = 'en'""")
def banner_from_english(spark, load):
    banner = F.max(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("source"))).alias("banner")
    titles = load("documents").groupBy(F.floor(F.col("doc_id") / 4).alias("title"), "lang").agg(banner)
    english = titles.filter("lang = 'en'").select("title", F.col("banner").alias("en"))
    return titles.join(english, "title", "left").select("title", "lang", F.coalesce(F.nullif("banner", F.lit("")), "en").alias("banner"))


@query("""SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'kind=cheap,name=' || p_brand ELSE 'brand=' || p_brand || ',type=' || p_type END AS tags FROM part""")
def tag_transformation(spark, load):
    tags = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"))
    rules = [({"type": "ECONOMY", "brand": "*"}, {"name": "$brand", "kind": "cheap"}, ["brand", "type"])]
    text = F.array_join(F.transform(F.array_sort(F.map_entries(maps.transformed_tags(F.col("tags"), rules))), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return load("part").select("p_partkey", tags.alias("tags")).select("p_partkey", text.alias("tags"))


@query("""WITH rel AS (SELECT o_orderkey AS id, list(DISTINCT l_partkey) AS members, any_value(o_orderpriority) AS p, any_value(o_orderstatus) AS s FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1),
m AS (SELECT id, unnest(members) AS member, p, s, chr(CASE s WHEN 'F' THEN 97 WHEN 'O' THEN 98 ELSE 99 END) AS k FROM rel)
SELECT member, string_agg('priority=' || p || ',status=' || s, ';' ORDER BY k, id) AS groups FROM m GROUP BY 1""")
def relation_propagation(spark, load):
    lines = load("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set("l_partkey").alias("members"))
    tags = F.create_map(F.lit("priority"), F.col("o_orderpriority"), F.lit("status"), F.col("o_orderstatus"))
    relations = load("orders").select(F.col("o_orderkey").alias("id"), tags.alias("tags")).join(lines, "id")
    return maps.propagated(relations, [["status", "F", "O"]], ["priority", "status"])


@query("""SELECT l_partkey AS node FROM lineitem GROUP BY 1 HAVING bool_or(l_returnflag = 'R') AND NOT bool_and(l_returnflag = 'R')""")
def border_nodes(spark, load):
    taken = load("lineitem").select(F.col("l_partkey").alias("node"), F.col("l_orderkey").alias("way"), (F.col("l_returnflag") == "R").alias("satisfied"))
    return maps.border_points(taken)


_ROADS = """r0 AS (SELECT l_suppkey || '-' || strftime(l_shipdate, '%Y%m%d') AS ref, l_orderkey * 8 + l_linenumber AS id, min([l_partkey % 5, l_orderkey % 5]) AS nodes FROM lineitem GROUP BY 1, 2)"""


@query(f"""WITH RECURSIVE {_ROADS},
s AS (SELECT ref, nodes[1] AS node, min(id) AS id FROM r0 GROUP BY 1, 2 HAVING count(*) = 1), e AS (SELECT ref, nodes[2] AS node, min(id) AS id FROM r0 GROUP BY 1, 2 HAVING count(*) = 1),
f AS (SELECT e.ref, e.id, s.id AS next FROM e JOIN s USING (ref, node) WHERE e.id <> s.id),
w AS (SELECT ref, id, id AS place FROM r0 UNION SELECT w.ref, w.id, f.next FROM w JOIN f ON f.ref = w.ref AND f.id = w.place),
c AS (SELECT ref, id, min(other) AS chain FROM (SELECT ref, id, place AS other FROM w UNION ALL SELECT ref, place, id FROM w) GROUP BY 1, 2)
SELECT ref, chain, CAST(count(*) + 1 AS BIGINT) AS n FROM c GROUP BY 1, 2""")
def road_chains(spark, load):
    """Roads of a ref (a supplier's day) joined at shared end points."""
    lines = load("lineitem")
    ref = F.concat_ws("-", F.col("l_suppkey").cast("string"), F.date_format("l_shipdate", "yyyyMMdd"))
    roads = lines.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), ref.alias("ref"), F.array(F.col("l_partkey") % 5, F.col("l_orderkey") % 5).alias("nodes"))
    return maps.merged_roads(roads).select("ref", "chain", F.size("nodes").cast("long").alias("n"))


@query("""WITH n AS (SELECT doc_id AS id, 't' || doc_id AS title, 't' || (doc_id // 10) AS parent, lang FROM documents)
SELECT a.title, a.lang, coalesce(string_agg(b.title, ';' ORDER BY b.title), '') AS children FROM n a LEFT JOIN n b ON b.parent = a.title AND b.lang = a.lang AND b.title <> a.title GROUP BY 1, 2""")
def children_lists(spark, load):
    name = lambda c: F.concat(F.lit("t"), c.cast("string"))
    nodes = load("documents").select(name(F.col("doc_id")).alias("title"), name(F.floor(F.col("doc_id") / 10)).alias("parent"), "lang")
    lists = nodes.filter("title <> parent").groupBy(F.col("parent").alias("title"), "lang").agg(F.array_join(F.sort_array(F.collect_list("title")), ";").alias("children"))
    return nodes.select("title", "lang").join(lists, ["title", "lang"], "left").select("title", "lang", F.coalesce("children", F.lit("")).alias("children"))


@query("""SELECT n_name AS region, c_custkey AS id, coalesce(k.n, 0) AS ranking FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) k ON k.user_id = c_custkey WHERE r_name IN ('ASIA', 'EUROPE')""")
def export_by_country(spark, load):
    nations = load("nation").join(load("region").filter("r_name in ('ASIA', 'EUROPE')"), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    views = load("events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n"))
    both = load("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(views, "c_custkey", "left")
    return both.select(F.col("n_name").alias("region"), F.col("c_custkey").alias("id"), F.coalesce("n", F.lit(0)).alias("ranking"))


@query("""WITH p AS (SELECT c_custkey AS id, c_nationkey % 3 AS cluster, c_custkey * 7 % 50 AS x, c_custkey * 3 % 4 AS y FROM customer),
m AS (SELECT *, count(*) OVER (PARTITION BY x, y, cluster) AS m FROM p)
SELECT x, y, CASE WHEN count(*) = 2 THEN min(id) ELSE arg_max(id, struct_pack(a := m, b := -id)) END AS kept, count(*) - 1 AS merged FROM m GROUP BY 1, 2 HAVING count(*) > 1""")
def shared_border_points(spark, load):
    k = F.col("c_custkey")
    return maps.merged_border_points(load("customer").select(k.alias("id"), (F.col("c_nationkey") % 3).alias("cluster"), (k * 7 % 50).alias("x"), (k * 3 % 4).alias("y")))


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS a, (p_partkey * 3 + 1) % 1000 AS b FROM part UNION SELECT p_partkey, (p_partkey + 17) % 1000 FROM part),
w AS (SELECT CAST(5 AS BIGINT) AS node, 0 AS d UNION SELECT e.b, w.d + 1 FROM w JOIN e ON e.a = w.node WHERE w.d < 4) SELECT node, min(d) AS distance FROM w GROUP BY 1""")
def reachable_roads(spark, load):
    k = F.col("p_partkey")
    edges = load("part").select(k.alias("a"), ((k * 3 + 1) % 1000).alias("b")).union(load("part").select(k, (k + 17) % 1000)).distinct()
    return maps.reached(edges, spark.createDataFrame([(5,)], "node long"), 4)


@query("""SELECT user_id * 1000 % 64 AS x, event_id % 16 AS y, event_type AS band, round(sum(value), 2) AS value FROM events GROUP BY 1, 2, 3""")
def weather_bands(spark, load):
    """Bands as a long table of tiles, one value per band and cell."""
    return load("events").groupBy((F.col("user_id") * 1000 % 64).alias("x"), (F.col("event_id") % 16).alias("y"), F.col("event_type").alias("band")).agg(r(F.sum("value"), 2).alias("value"))


_OWN = "SELECT l_suppkey % 8 AS region, CASE WHEN l_partkey % 10 < 7 THEN 'k' || (l_suppkey % 8) ELSE 'k' || (l_partkey % 8) END AS key, count(*) AS n FROM lineitem GROUP BY 1, 2"


@query(f"""WITH c AS ({_OWN}), p AS (SELECT r AS region, r AS ancestor, 2 AS depth FROM (SELECT unnest(range(8)) AS r) UNION ALL SELECT r, 100 + r // 4, 1 FROM (SELECT unnest(range(8)) AS r) UNION ALL SELECT r, 200, 0 FROM (SELECT unnest(range(8)) AS r)),
u AS (SELECT ancestor AS region, key, depth, sum(n) AS n FROM c JOIN p USING (region) GROUP BY 1, 2, 3), t AS (SELECT key, sum(n) AS total FROM c GROUP BY 1),
e AS (SELECT u.region, key, depth, n / CAST(total AS DOUBLE) AS share FROM u JOIN t USING (key) WHERE n / CAST(total AS DOUBLE) > 0.7),
below AS (SELECT DISTINCT x.ancestor AS region, e.key FROM e JOIN (SELECT region, ancestor FROM p UNION ALL SELECT 100, 200 UNION ALL SELECT 101, 200) x ON x.region = e.region AND x.ancestor <> e.region)
SELECT CAST(e.region AS BIGINT) AS region, e.key, round(e.share, 6) AS share FROM e LEFT JOIN below b ON b.region = e.region AND b.key = e.key WHERE b.key IS NULL""")
def ownership_hierarchy(spark, load):
    """Leaves 0 to 7 lie in 100 and 101, these in 200."""
    lines = load("lineitem")
    leaf = F.col("l_suppkey") % 8
    key = F.concat(F.lit("k"), F.when(F.col("l_partkey") % 10 < 7, leaf).otherwise(F.col("l_partkey") % 8).cast("string"))
    counts = lines.groupBy(leaf.alias("region"), key.alias("key")).agg(F.count("*").alias("n"))
    tree = [(k, k, 2) for k in range(8)] + [(k, 100 + k // 4, 1) for k in range(8)] + [(k, 200, 0) for k in (*range(8), 100, 101)]
    parents = spark.createDataFrame([*tree, (100, 100, 1), (101, 101, 1)], "region long, ancestor long, depth int")
    return maps.owners(counts, parents, 0.7).withColumn("share", r("share", 6))


@query("""WITH RECURSIVE k AS (SELECT s_nationkey AS region, p_type AS key, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
g AS (SELECT region, key, row_number() OVER (PARTITION BY region ORDER BY n DESC, key) AS rank FROM k),
w AS (SELECT key FROM (VALUES ('ECONOMY')) v(key) UNION SELECT b.key FROM w JOIN g a ON a.key = w.key JOIN g b ON b.region = a.region AND b.rank <= a.rank)
SELECT b.region, b.key FROM g b JOIN (SELECT region, max(rank) AS lowest FROM g JOIN w USING (key) GROUP BY 1) l ON l.region = b.region AND b.rank <= l.lowest""")
def enabled_fixpoint(spark, load):
    rows = load("lineitem").join(load("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(load("part"), F.col("l_partkey") == F.col("p_partkey"))
    counts = rows.groupBy(F.col("s_nationkey").alias("region"), F.col("p_type").alias("key")).agg(F.count("*").alias("n"))
    ranked = counts.select("region", "key", F.row_number().over(Window.partitionBy("region").orderBy(F.desc("n"), "key")).alias("rank"))
    return maps.enabled_above(ranked, spark.createDataFrame([("ECONOMY",)], "key string"))


@query("""SELECT event_id, CASE WHEN x < 100 THEN 'a' WHEN x < 300 THEN 'b' WHEN x BETWEEN 400 AND 700 THEN 'c' END AS country FROM (SELECT event_id, event_id * 7919 % 1000 AS x FROM events)""")
def address_lookup(spark, load):
    """A small table of address ranges, joined by range."""
    ranges = spark.createDataFrame([(0, 99, "a"), (100, 299, "b"), (400, 700, "c")], "lo long, hi long, country string")
    at = load("events").select("event_id", (F.col("event_id") * 7919 % 1000).alias("x"))
    return at.join(F.broadcast(ranges), F.col("x").between(F.col("lo"), F.col("hi")), "left").select("event_id", "country")


@query("""SELECT p_partkey, md5(p_name)[1:1] || '/' || md5(p_name)[1:2] AS shard, CAST(round_even(pow(20, 10 * least(greatest(p_retailprice / 2000, 0), 1) - 10) * 100, 0) AS INTEGER) AS score,
CAST(floor(round((0.5 * greatest(p_size, 0) / 50 + 0.2 * p_retailprice / 2000) * 1000, 6)) AS INTEGER) AS weighted, replace(replace(p_name, 'cold', 'cd'), 'widget', 'wdg') AS short,
lpad(CAST(p_partkey % 90 AS VARCHAR), 2, '0') || '30.0000' AS ddmm, CAST((p_size + 350) % 360 AS INTEGER) AS bearing FROM part""")
def scalar_mix(spark, load):
    size, price = F.col("p_size"), F.col("p_retailprice")
    return load("part").select(
        "p_partkey", X.shard(F.col("p_name")).alias("shard"), X.curved_score(price / 2000, 20).alias("score"), X.weighted_score([(size / 50, 0.5), (price / 2000, 0.2)]).alias("weighted"),
        X.abbreviated(F.col("p_name"), {"cold": "cd", "widget": "wdg"}).alias("short"), X.degrees_minutes(F.col("p_partkey") % 90 + 0.5, 2).alias("ddmm"), ((size + 350) % 360).alias("bearing"),
    )


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{"t":"' || event_type || '"}' ELSE '{}' END AS kept, CASE WHEN user_id % 3 = 0 THEN 'x' ELSE event_type END AS kind FROM events""")
def tags_and_fields(spark, load):
    text = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.col("event_type").alias("t"), F.lit(1).alias("drop")))).otherwise('{"drop":2}')
    own = F.when(F.col("user_id") % 3 == 0, F.create_map(F.lit("kind"), F.lit("x")))
    tags = X.added_tags(own, F.create_map(F.lit("kind"), F.col("event_type"), F.lit("more"), F.lit("y")))
    return load("events").select("event_id", X.without_fields(text, ["drop"]).alias("kept"), tags["kind"].alias("kind"))


@query("""WITH p AS (SELECT c_custkey AS id, round(sqrt(pow(c_custkey * 37 % 100, 2)) + 1, 4) AS len FROM customer), l AS (SELECT id, len, CAST(greatest(0, ceil(log2(len / 10))) AS INTEGER) AS level FROM p)
SELECT id, CAST(pow(2, level) AS BIGINT) + 1 AS points, round(len / pow(2, level), 4) AS step FROM l""")
def densified_lines(spark, load):
    length = r(F.abs(F.col("c_custkey") * 37 % 100).cast("double") + 1)
    lines = load("customer").select(F.col("c_custkey").alias("id"), length.alias("len")).withColumn("at", X.midpoints(F.col("len"), 10.0))
    return lines.select("id", F.size("at").cast("long").alias("points"), r(F.col("len") * F.get("at", 1)).alias("step"))


@query("""WITH s AS (SELECT c_custkey AS stop, c_nationkey AS route, c_custkey * 37 % 1000 AS x, c_custkey * 91 % 1000 AS y FROM customer), d AS (SELECT *, sqrt(pow(x - 500, 2) + pow(y - 500, 2)) AS distance FROM s)
SELECT route, stop, round(distance, 4) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY route ORDER BY distance, stop) AS k FROM d WHERE distance < 400 AND route NOT IN (SELECT route FROM s WHERE stop = 7)) WHERE k = 1""")
def nearby_routes(spark, load):
    k = F.col("c_custkey")
    stops = load("customer").select(k.alias("stop"), F.col("c_nationkey").alias("route"), F.sqrt(F.pow(k * 37 % 1000 - 500, F.lit(2)) + F.pow(k * 91 % 1000 - 500, F.lit(2))).alias("distance"))
    own = stops.filter("stop = 7").select("route")
    near = stops.filter("distance < 400").join(own, "route", "left_anti").groupBy("route").agg(F.min(F.struct("distance", "stop")).alias("m"))
    return near.select("route", F.col("m.stop").alias("stop"), r("m.distance").alias("distance"))
