from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from meridian.functions import columns as C
from meridian.operators import etl, joins, ranking
from meridian.sources import readers
from meridian.streaming import feeds


def test_rank_percentile_edges(spark):
    x = lambda *v: spark.createDataFrame([(sorted(map(float, v)),)], "x array<double>").select(C.rank_percentile(F.col("x"), 95.0)).first()[0]
    assert x(7) == 7
    assert x(1, 2) == 2
    assert abs(x(*range(1, 21)) - 19.95) < 1e-9


def test_merged_buckets():
    assert ranking.merged_buckets([(5, 1), (4, 1), (3, 5), (1, 9)], 3) == [(4, 5, 2), (3, 3, 5), (1, 1, 9)]
    assert ranking.merged_buckets([(2, 3)], 7) == [(2, 2, 3)]


def test_nearest_in_time_ties_go_to_the_first(spark):
    left = spark.createDataFrame([("a", datetime(2024, 1, 2)), ("b", datetime(2024, 1, 2))], "k string, t timestamp")
    right = spark.createDataFrame([("a", datetime(2024, 1, 1), 1.0, 2), ("a", datetime(2024, 1, 3), 2.0, 1)], "k string, d timestamp, v double, o int")
    got = {r.k: r.v for r in joins.nearest_in_time(left, right, "k", "t", "d", ["v"], "o").collect()}
    assert got == {"a": 2.0, "b": None}


def test_track_speed_skips_frozen_points(spark):
    rows = [(1, 0, 0, 0.0, 0.0, 0), (1, 0, 1, 0.0, 0.0, 1000), (1, 0, 2, 0.0, 0.001, 11000), (1, 0, 3, 0.0, 0.002, 11499)]
    t = etl.track_speeds(spark.createDataFrame(rows, "track long, seg int, ord int, lat double, lon double, time_ms long")).first()
    assert t.points == 3 and t.time_ms == 11000 and abs(t.distance - 111.19) < 0.1


def test_best_duplicates(spark):
    scores = spark.createDataFrame([(1, 10), (2, 20), (3, 20)], "id long, score int")
    pairs = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.95), (2, 1, 0.9), (2, 3, 0.8), (3, 1, 0.95)], "id long, dup long, similarity double")
    assert {(r.id, r.dup) for r in ranking.best_duplicates(pairs, scores).collect()} == {(1, 3), (2, 3)}


def test_hierarchy_leaves_out_cycles(spark):
    nodes = spark.createDataFrame([("a", None), ("b", "a"), ("c", "d"), ("d", "c")], "id string, parent string")
    assert {r.path for r in etl.hierarchy_paths(nodes, "id", "parent").collect()} == {"a", "a/b"}


def test_points_in_polygons(spark):
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    notch = [(20.0, 0.0), (30.0, 0.0), (30.0, 10.0), (25.0, 2.0), (20.0, 10.0)]
    polygons = spark.createDataFrame([("square", square), ("notch", notch), ("none", []), ("null", None)], "region string, ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 25.0, 5.0), (3, 21.0, 5.0), (4, 11.0, 5.0), (5, None, 5.0)], "id long, x double, y double")
    for cell in (3.0, 7.0, 100.0):
        got = joins.points_in_polygons(points, polygons, cell)
        assert got.columns == ["id", "x", "y", "region", "ring"]
        assert sorted((r.id, r.region) for r in got.collect()) == [(1, "square"), (3, "notch")]


def test_lifetime_value(spark):
    def value(rows):
        return {r.sku: r for r in etl.lifetime_value(spark.createDataFrame(rows, "sku string, periods int, ended boolean, months int, price double, retention double")).collect()}

    few = value([("a", 3, True, 12, 20.0, 0.5), ("b-%", 0, False, 1, 10.0, 0.9)])
    assert abs(few["a"].factor - 2) < 1e-9 and abs(few["a"].value - 40) < 1e-9
    assert abs(few["b-%"].factor - 4.5) < 1e-9
    rows = [("c", 5, False, 12, 1.0, 0.1)] * 12 + [("c", k, True, 12, 1.0, 0.1) for k in (1, 2, 2, 3, 4, 4)]
    rates = [17 / 18, 15 / 17, (14 / 15 * 12 / 14) ** 0.5]
    want = 1 + rates[0] + rates[0] * rates[1] + rates[0] * rates[1] * rates[2] * (1 + 0.8 / 0.2)
    got = value(rows)["c"]
    assert got.subscriptions == 18 and abs(got.factor - want) < 1e-9
    assert value([]) == {}


def test_way_tags_to_nodes(spark):
    rows = [(1, [5, 6, 7], {"highway": "road", "x": "1"}), (2, [5, 6, 7, 5], {"highway": "road"}), (3, [8, 9], {"highway": "path"}), (4, [], {"highway": "road"}), (5, [4], {"x": "2"}), (6, [1, 2], None)]
    ways = spark.createDataFrame(rows, "way long, nodes array<long>, tags map<string,string>")
    at = lambda *rule: sorted((r.way, r.value, r.first, r.last) for r in etl.way_tags_to_nodes(ways, [rule]).collect())
    assert at("highway", None, "center", True) == [(1, "road", 1, 1), (3, "path", 0, 1)]
    assert at("highway", "road", "center", False) == [(1, "road", 1, 1), (2, "road", 2, 2)]
    assert at("highway", None, "start", False) == [(1, "road", 0, 1), (2, "road", 0, 1), (3, "path", 0, 1)]
    assert at("highway", None, "end", False) == [(1, "road", 1, 2), (2, "road", 2, 3), (3, "path", 0, 1)]
    assert at("x", None, "all", False) == [(1, "1", 0, 0), (1, "1", 1, 1), (1, "1", 2, 2), (5, "2", 0, 0)]
    assert etl.way_tags_to_nodes(ways, [("x", "2", "end", False), ("x", "1", "end", False)]).count() == 1


def test_dump_and_log(spark, tmp_path):
    (tmp_path / "d.sql").write_text("-- x;\nINSERT INTO `t` VALUES (1,'a\\'b (c)',NULL),(2,'',3.5);\n")
    assert [r.fields for r in readers.sql_dump(spark, str(tmp_path / "d.sql")).collect()] == [["1", "a'b (c)", None], ["2", "", "3.5"]]
    (tmp_path / "log").write_text('1.2.3.4 - - [01/Jan/2024:00:00:01 +0000] "GET /x/y?aid=ab1 HTTP/1.1" 200 5 "-" "u"\nbroken\n')
    row = readers.access_log(spark, str(tmp_path / "log")).collect()
    assert len(row) == 1 and row[0].aid == "ab1" and row[0].status == 200


def test_osm_xml(spark, tmp_path):
    (tmp_path / "m.osm").write_text('<osm><node id="1" lat="1.5" lon="2"><tag k="a" v="b"/></node><way id="2"><nd ref="1"/><nd ref="3"/></way></osm>')
    node = readers.osm_xml(spark, str(tmp_path / "m.osm"), "node").first()
    assert (node.id, node.lat, node.tags) == (1, 1.5, {"a": "b"})
    assert readers.osm_xml(spark, str(tmp_path / "m.osm"), "way").first().nodes == [1, 3]


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = feeds.events(spark, str(tmp_path / "in"), events.schema)
    got = feeds.run_once(feeds.windowed_counts(stream), "windows").agg(F.sum("n")).first()[0]
    assert got == events.count()
    last = feeds.run_once(feeds.last_values(stream), "lasts")
    assert last.count() == events.select("user_id").distinct().count()


def test_nearest_vectors_over_all_ids(spark):
    from meridian.plans.queries import QUERIES

    rng = np.random.default_rng(5)
    rows = [(i, "ab"[i % 2], [round(float(x), 2) for x in rng.normal(size=4)]) for i in range(300, 480)] + [(600, "c", [1.0] * 4), (601, "a", None), (602, "a", [0.0] * 4), (603, None, [1.0] * 4)]
    vectors = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    real = [(i, g, np.array(v)) for i, g, v in rows if g and v]
    cosine = lambda a, b: np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b) or 1.0)
    want = set()
    for i, g, v in real:
        near = sorted((-round(max(0.0, min(1.0, cosine(v, w))), 4), j) for j, h, w in real if h == g and j != i)[:2]
        want |= {(i, j, -s, n + 1) for n, (s, j) in enumerate(near)}
    for block in (4096, 25):
        assert {tuple(r) for r in ranking.nearest_vectors(vectors, "vec_id", "label", "embedding", 2, block).collect()} == want
    all_of = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    assert QUERIES["knn_embeddings"](spark, "/root/testdata/sf0.1").select("id").distinct().count() == all_of.filter("embedding is not null").select("vec_id").distinct().count()


def test_nearest_rate_over_all_orders(spark, tmp_path):
    from meridian.plans.queries import QUERIES

    orders = [(1, 7, datetime(1995, 1, 1), 10.0), (2, 7, datetime(1997, 11, 30), 20.0), (3, 7, datetime(1998, 3, 1), 30.0), (4, 8, datetime(1992, 1, 1), 40.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    events = [(1, 7, datetime(2024, 1, 1)), (2, 7, datetime(2024, 6, 1)), (3, 8, datetime(2024, 1, 1)), (4, 9, datetime(2024, 1, 1))]
    spark.createDataFrame(events, "event_id long, user_id long, ts timestamp_ntz").write.parquet(str(tmp_path / "events.parquet"))
    assert {tuple(r) for r in QUERIES["asof_nearest_rate"](spark, str(tmp_path)).collect()} == {(1, 20.0), (2, 30.0), (3, 40.0)}


def test_top_bucket_has_no_end(spark):
    counts = spark.createDataFrame([(1, 10_000), (2, 10_001), (3, 5_000_000), (4, 19), (5, 1)], "u long, n long")
    from meridian.plans.queries import BUCKETS

    assert {(r.u, r["rank"]) for r in ranking.bucket_ranks(counts, "u", "n", BUCKETS).collect()} == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 5)}


def test_rank_percentiles_collect_no_group(spark):
    from meridian.plans.queries import QUERIES

    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(size=3000).tolist(), "b": [2.0] * 500 + [1.0, 3.0], "c": [7.0], None: [1.0, 4.0], "d": []}
    rows = [(g, x) for g, values in groups.items() for x in [*values, None]]
    got = {(r.g, r.p): r.v for r in ranking.rank_percentiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", (5, 50, 95)).collect()}
    for g, values in groups.items():
        x = spark.createDataFrame([(sorted(values),)], "x array<double>")
        for p in (5, 50, 95):
            want = x.select(C.rank_percentile(F.col("x"), float(p))).first()[0]
            assert got[g, p] == want or abs(got[g, p] - want) < 1e-9
    assert len(got) == 15
    plan = QUERIES["legacy_percentile"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(value" not in plan
