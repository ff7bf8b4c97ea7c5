"""Rows that operators write to shuffles, and odd rows that must come out as before."""

from pyspark.sql import functions as F

from meridian.operators import maps
from meridian.operators import polygons as P


def shuffled(spark, run):
    """(what ``run`` returns, rows that it writes to shuffles, rows that it reads from them)."""
    context = spark.sparkContext
    jsc, jvm = context._jsc.sc(), context._jvm

    def stages():
        jsc.listenerBus().waitUntilEmpty()
        none = jvm.java.util.ArrayList()
        found = jsc.statusStore().stageList(none, False, False, context._gateway.new_array(jvm.double, 0), none)
        return {(s := found.apply(k)).stageId(): (s.shuffleWriteRecords(), s.shuffleReadRecords()) for k in range(found.size())}

    old = max(stages(), default=-1)
    out = run()
    new = [n for k, n in stages().items() if k > old]
    return out, *map(sum, zip(*new, strict=True))


def test_small_steps_of_a_closure_leave_links_and_known_pairs_where_they_are(spark, monkeypatch):
    # 2,000 relations with a child each, and one chain of 8 relations, which takes 8 steps
    members = spark.range(2000).selectExpr("id", "'relation' as type", "id + 10000 as ref").union(spark.range(8).selectExpr("id + 20000", "'relation'", "id + 20001"))
    ids = spark.range(2000).union(spark.range(10000, 12000)).union(spark.range(20000, 20008))
    none = spark.range(0)
    way_nodes = spark.range(0).selectExpr("id", "id as node")
    run = lambda: sorted(map(tuple, P.closure(members, {"relation": ids, "way": none, "node": none}, way_nodes).collect()))
    got, rows, _ = shuffled(spark, run)
    want = [(k, "relation", k, False) for k in (*range(2000), *range(10000, 12000))] + [(k, "relation", k + 10000, False) for k in range(2000)]
    assert got == sorted(want + [(20000 + a, "relation", 20000 + b, b == 8) for a in range(8) for b in range(a, 9)])
    # 8 steps that shuffle all links and known pairs write over 60,000 rows
    assert rows < 40_000
    # steps that are too large to be sent give the same
    monkeypatch.setattr(P, "SENT", 0)
    assert run() == got


def test_odd_rows_of_a_closure(spark, monkeypatch):
    rows = [(1, "relation", 2), (1, "relation", 2), (2, "relation", 1), (2, "relation", 9), (9, "relation", 3), (9, "way", 5), (None, "relation", 1), (3, "relation", None), (3, "node", 6), (3, "other", 6), (3, None, 6)]
    members = spark.createDataFrame(rows, "id long, type string, ref long")
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "id long")
    nodes = spark.createDataFrame([(5, 7), (5, 7), (None, 7), (5, None)], "id long, node long")
    want = []
    for root, found in ((1, (1, 2, 9, 3)), (2, (1, 2, 9, 3)), (3, (3,)), (None, (None,))):
        want += [(root, "relation", k, k == 9) for k in found]
        want += [(root, "way", 5, False)] * (9 in found) + [(root, "node", 6, True)] * (3 in found) + [(root, "node", 7, False)] * (9 in found)
    for most in (100_000, 0):
        monkeypatch.setattr(P, "SENT", most)
        got = P.closure(members, {"relation": ids(1, 2, 2, 3, None), "way": ids(5), "node": ids(7, 7)}, nodes).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_ways_and_chains_are_made_once(spark):
    # 500 squares of four ways; what makes the ways shuffles 4,000 rows
    rows = spark.range(4000).selectExpr("id % 2000 as k", "id as v")
    ways = rows.repartition(3).groupBy("k").agg(F.max("v").alias("v")).selectExpr("k div 4 as relation", "'outer' as role", "k as way", "array(k, if(k % 4 = 3, k - 3, k + 1)) as nodes")
    nodes = spark.range(2000).selectExpr("id", "id % 4 as x", "id % 2 as y")
    keys = ["relation", "role"]
    got, written, read = shuffled(spark, lambda: P.located(P.rings(ways, keys), nodes, keys).collect())
    assert len(got) == 500 and all(r.closed and r.missing == 0 and len(r.ring) == 5 and tuple(r.ring[0]) == (0, 0) == tuple(r.ring[4]) for r in got)
    # made twice, they would be 8,000 rows more
    assert written < 14_000 and read < 14_000


def test_odd_rows_of_located(spark):
    rows = [(1, "a", 1, True, 2, [1, 2, 1]), (1, "a", 3, False, 1, [4, 5]), (1, None, 4, False, 1, [1, 2]), (None, "a", 5, False, 1, [1, 2]), (2, "a", 6, False, 1, []), (2, "a", 7, False, 1, None), (2, "a", 8, None, 1, [3, None, 9])]
    chains = spark.createDataFrame(rows, "relation long, role string, chain long, closed boolean, ways long, nodes array<long>")
    nodes = spark.createDataFrame([(1, 1.0, 2.0), (2, 5.0, None), (2, 3.0, 4.0), (3, None, None), (4, float("nan"), 1.0), (None, 8.0, 8.0)], "id long, x double, y double")
    found = P.located(chains, nodes, ["relation", "role"])
    assert found.columns == ["relation", "role", "chain", "closed", "ways", "nodes", "missing", "ring"]
    assert found.schema["ring"].dataType.simpleString() == "array<struct<x:double,y:double>>"
    got = {r.chain: (r.closed, r.ways, r.nodes, r.missing, str([tuple(p) for p in r.ring])) for r in found.collect()}
    want = {1: (True, 2, [1, 2, 1], 0, "[(1.0, 2.0), (3.0, 4.0), (5.0, None), (1.0, 2.0)]"), 3: (False, 1, [4, 5], 1, "[(nan, 1.0)]"), 8: (None, 1, [3, None, 9], 2, "[(None, None)]")}
    assert got == want


ROADS = "id long, ref string, nodes array<long>"


def test_roads_are_read_once_for_ends_and_once_for_chains(spark):
    # 3,000 roads of their own ref, and ten chains of five roads
    roads = spark.range(3050).selectExpr("id", "if(id < 3000, concat('r', id), concat('c', id % 10)) as ref", "array(id div 10, id div 10 + 1, id div 10 + 1) as nodes")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as large tables are joined
    try:
        got, _, read = shuffled(spark, lambda: sorted((r.ref, r.chain, r.nodes) for r in maps.merged_roads(roads).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = [(f"r{k}", k, [k // 10, k // 10 + 1, k // 10 + 1]) for k in range(3000)]
    want += [(f"c{k}", 3000 + k, [300, *(300 + x for x in range(1, 6) for _ in range(2))]) for k in range(10)]
    assert got == sorted(want)
    # read twice each, roads would be 6,100 rows more
    assert read < 12_500


def test_odd_rows_of_roads(spark):
    rows = [(1, "a", [1, 2]), (1, "a", [1, 9]), (1, "a", [1, 2]), (2, "a", [2, 3]), (3, "a", [3, None]), (4, "a", [None, 1]), (5, "a", [7, 7]), (6, "b", [1, 2]), (7, "b", [2, 1]), (8, "c", [1, 2]), (9, "c", [2, 3]), (10, "c", [2, 4]), (None, "a", [3, 4]), (11, None, [1, 2]), (12, "d", []), (13, "d", None), (14, "d", [1])]
    got = {(r.ref, r.chain): r.nodes for r in maps.merged_roads(spark.createDataFrame(rows, ROADS)).collect()}
    assert got == {("a", 1): [None, 1, 2, 3, None], ("a", 5): [7, 7], ("b", 6): [1, 2, 1], ("c", 8): [1, 2], ("c", 9): [2, 3], ("c", 10): [2, 4]}


def test_walks_of_all_lengths(spark):
    # chains of 1 to 20 darts and a ring of 6
    rows = [(n, k, k + 1 if k + 1 < n else None) for n in range(1, 21) for k in range(n)] + [(99, k, (k + 1) % 6) for k in range(6)]
    chain = spark.createDataFrame(rows, "g long, dart long, next long").withColumn("least", F.col("dart")).withColumn("steps", F.lit(1).cast("long"))
    out, written, _ = shuffled(spark, lambda: P.doubled(chain, ["g"], 5))
    got = {(r.g, r.dart): (r.next, r.least, r.steps) for r in out.collect()}
    assert got == {(n, k): (None, k, n - k) for n in range(1, 21) for k in range(n)} | {(99, k): ((k + 32) % 6, 0, 32) for k in range(6)}
    # 216 rows, on both sides of five joins, would be 2,160
    assert written < 1_700
