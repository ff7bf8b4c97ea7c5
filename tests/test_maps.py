"""Map operators, scalars, reports and sources on small fixtures: nulls, ties, repeats, empty tables."""

from datetime import datetime

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meridian.functions import scalars as X
from meridian.functions import search as S
from meridian.operators import joins, maps, reports
from meridian.sources import readers


def test_not_in_minds_nulls(spark):
    keys = lambda *v: spark.createDataFrame([(x,) for x in v], "k long")
    left = keys(1, 2, None)
    got = lambda right: sorted((r.k for r in joins.not_in(left, right, "k").collect()), key=str)
    assert got(keys(2)) == [1] and got(keys(2, None)) == [] and got(keys()) == [1, 2, None]


def test_search_grammar(spark):
    rows = [(1, "Red fox"), (2, "red dog"), (3, None), (4, "a, fox")]
    df = spark.createDataFrame(rows, "id long, t string")
    at = lambda q: [r.id for r in df.filter(S.matches_search([F.col("t")], q)).orderBy("id").collect()]
    assert at("red fox") == [1] and at("red, fox") == [1, 2, 4] and at("red -dog") == [1] and at('"red fox"') == [1] and at('-"red"') == [3, 4] and at("") == [1, 2, 3, 4]


def test_tags(spark):
    df = spark.createDataFrame([(1, {"a": "1"}), (2, {"a": "2", "b": "x"}), (3, None), (4, {})], "id long, tags map<string,string>")
    ids = lambda rules: [r.id for r in df.filter(S.tags_match(F.col("tags"), rules)).orderBy("id").collect()]
    assert ids([{"a": "1"}, {"a": ["2", "3"], "b": "x"}]) == [1, 2] and ids([]) == []
    out = {r.id: r.t for r in df.select("id", maps.transformed_tags(F.col("tags"), [({"a": "*"}, {"c": "$a"}, ["a"]), ({"c": "2"}, {}, ["b"])]).alias("t")).collect()}
    assert out == {1: {"c": "1"}, 2: {"c": "2"}, 3: None, 4: {}}
    assert df.select(X.added_tags(F.col("tags"), F.create_map(F.lit("a"), F.lit("9"), F.lit("z"), F.lit("0")), F.lit(None).cast("map<string,string>")).alias("t")).collect()[2].t == {"a": "9", "z": "0"}


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(X.natural_join(F.array(*map(F.lit, ("10", "2b", "2B", "A", "2a"))))) == "2a;2B;10;A"
    assert one(X.digits_only(F.lit("ca. 1200 m"))) == 1200 and one(X.digits_only(F.lit("none"))) is None
    assert one(X.prefixes(F.lit("Old Town (north) Oldest"), 3)) == ["old", "tow"]
    assert one(X.degrees_minutes(F.lit(-7.25), 3)) == "00715.0000"
    assert one(X.quadkey(F.lit(3), F.lit(5), 3)) == "213"
    assert one(X.angle_between(F.lit(350), F.lit(10))) == 20
    assert one(X.midpoints(F.lit(35.0), 10.0)) == [0.0, 0.25, 0.5, 0.75, 1.0]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(-(2**50), 2**50)))
def test_deltas_round_trip(values):
    assert X._unzigzag(X._zigzag(np.array(values, np.int64))) == values


def test_simplified_and_packed(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0, 2.0, 3.0], [0.0, 0.01, 0.0, 5.0], [5, -3, 5]), (2, None, None, None), (3, [1.0], [1.0], [])], "id long, x array<double>, y array<double>, v array<long>")
    got = {r.id: (r.k, r.v, r.w) for r in df.select("id", "v", X.simplified(0.1)("x", "y").alias("k"), X.unpacked_deltas(X.packed_deltas("v")).alias("w")).collect()}
    assert got[1][0] == [0, 2, 3] and got[2][0] == [] and got[3][0] == [0] and all(v == w for _, v, w in got.values())


def test_roads_and_runs(spark):
    roads = spark.createDataFrame([(1, "A", [1, 2]), (2, "A", [2, 3]), (3, "A", [3, 4]), (4, "A", [9, 8]), (5, "B", [2, 1]), (6, None, [1, 2]), (7, "A", [7])], "id long, ref string, nodes array<long>")
    assert {(r.ref, r.chain, tuple(r.nodes)) for r in maps.merged_roads(roads).collect()} == {("A", 1, (1, 2, 3, 4)), ("A", 4, (9, 8)), ("B", 5, (2, 1))}
    assert maps.trimmed_run([1, 2, 3, 9, 2], {2, 3}) == [2, 3] and maps.trimmed_run([], {1}) == []


def test_children_and_owners(spark):
    parents, children = spark.createDataFrame([(1,), (2,), (None,)], "k long"), spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (None, 1, "z")], "k long, o int, v string")
    assert {r.k: [c.v for c in r.c] for r in maps.with_children(parents, children, "k", ["o"], ["v"], "c").collect()} == {1: ["a", "b"], 2: [], None: []}
    tree = spark.createDataFrame([(1, 1, 1), (2, 2, 1), (1, 9, 0), (2, 9, 0), (9, 9, 0)], "region long, ancestor long, depth int")
    counts = spark.createDataFrame([(1, "a", 8), (2, "a", 2), (1, "b", 5), (2, "b", 5)], "region long, key string, n long")
    assert {(r.region, r.key, r.share) for r in maps.owners(counts, tree).collect()} == {(1, "a", 0.8), (9, "b", 1.0)}


def test_reports(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 4.0), (1, 4, 8.0), (1, 3, None), (2, 1, None)], "k long, o long, h double")
    assert {(r.k, r.o): r.h for r in reports.filled(df, "k", "o", "h").collect()} == {(1, 1): 4.0, (1, 2): 4.0, (1, 3): 6.0, (1, 4): 8.0, (2, 1): None}
    a, b = spark.createDataFrame([("x", 1), ("x", 1), ("y", None)], "k string, v int"), spark.createDataFrame([("x", 1), ("y", None), ("z", 2)], "k string, v int")
    assert sorted((r.k, r.found) for r in reports.compared(a, b, "k", "v", ["v"]).collect()) == [("x", "equal"), ("x", "first"), ("y", "equal"), ("z", "second")]
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 51), (None, 3)], "a long, b long")
    assert {r.v: r.label for r in reports.aliases(chain).collect()} == {**{i: 0 for i in range(21)}, 50: 50, 51: 50}
    assert [r.id for r in reports.stride_sample(spark.range(10), "id", 25).orderBy("id").collect()] == [0, 4, 7]
    assert reports.stride_sample(spark.range(0), "id", 25).count() == 0


def test_sources(spark, tmp_path):
    (tmp_path / "t.gpx").write_text('<gpx><trk><name>n</name><trkseg><trkpt lat="1" lon="2"><ele>3</ele><time>2024-01-01T00:00:00Z</time></trkpt><trkpt lat="1.5" lon="2"/></trkseg></trk></gpx>')
    points = readers.gpx_points(spark, str(tmp_path / "t.gpx")).orderBy("ord").collect()
    assert [(p.seg, p.ord, p.lat, p.ele) for p in points] == [(0, 0, 1.0, 3.0), (0, 1, 1.5, None)] and points[0].time == datetime(2024, 1, 1)
    (tmp_path / "d.xml").write_text('<w><page><id>7</id><title>Q7</title><revision><text>{"a":"b"}</text></revision></page><page><id>8</id><title>x</title><revision><text>no</text></revision></page></w>')
    assert {r.id: r.fields for r in readers.dump_pages(spark, str(tmp_path / "d.xml")).collect()}[7] == {"a": "b"}
    (tmp_path / "j.json").write_text('[{"a": 1}, {"a": 2}]')
    assert sorted(r.a for r in readers.json_documents(spark, str(tmp_path / "j.json"), "a long").collect()) == [1, 2]
    (tmp_path / "g.json").write_text('{"properties":{"name":"x","zz":"1"},"geometry":{"type":"Point","coordinates":[1,2]}}\n')
    assert readers.geojson_features(spark, str(tmp_path / "g.json"), ["name", "other"]).first().tags == {"name": "x"}
    nodes = spark.createDataFrame([(1, 1.5, 2.0, {"a": "b"}), (2, 0.0, 0.0, {})], "id long, lat double, lon double, tags map<string,string>")
    readers.write_osm_nodes(nodes.coalesce(1), str(tmp_path / "nodes"))
    assert {r.id: r.tags for r in readers.osm_xml(spark, str(tmp_path / "nodes"), "node").collect()} == {1: {"a": "b"}, 2: {}}
    readers.write_csv_union([spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2, 'q"z')], "a int, c string")], str(tmp_path / "csv"))
    back = readers.csv_cropped(spark, str(tmp_path / "csv"))
    assert back.columns == ["a", "b", "c"] and {(r.a, r.b, r.c) for r in back.collect()} == {("1", "x", None), ("2", None, 'q"z')}
    rows = spark.createDataFrame([(1, datetime(2023, 1, 1)), (2, datetime(2023, 1, 1)), (3, datetime(2024, 5, 1)), (4, None)], "k long, t timestamp")
    assert sorted(r.k for r in readers.purged(rows, "t", "2024-01-01", spark.createDataFrame([(2,)], "k long"), "k").collect()) == [2, 3, 4]
    assert sorted(r.k for r in readers.without_blocked({"r": (rows, "k")}, spark.createDataFrame([(1,)], "id long"), "id")["r"].collect()) == [2, 3, 4]


def test_mappings(spark):
    from meridian.functions.mappings import Translation, due_ids, mapped, window_seconds

    df = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "a", "y")], "id long, k string, v string")
    assert [tuple(r) for r in mapped(df, {"where": {"k": "a"}, "select": {"n": "id", "t": ["k", "v"]}}).orderBy("n").collect()] == [(1, "a"), (3, "a y")]
    assert mapped(df, {"where": {"v": None}}).count() == 1 and mapped(df, {}).columns == df.columns and mapped(df, {"where": {"k": ["a", "b"]}}).count() == 3

    class Parks(Translation):
        def keep(self, tags):
            return tags["type"] == "park"

        def translate(self, tags):
            return F.create_map(F.lit("leisure"), tags["type"])

    layer = spark.createDataFrame([(1, {"type": "park"}), (2, {"type": "road"}), (3, None)], "id long, tags map<string,string>")
    assert [(r.id, r.tags) for r in Parks().transform(layer).collect()] == [(1, {"leisure": "park"})]
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "id long")
    due, mark = due_ids(ids(1, 2, 5), ids(3, 3, 5), 3)
    assert [r.id for r in due.collect()] == [3, 6, 7] and mark.first().mark == 6 and due_ids(ids(), ids(), 2)[1].first().mark == 1
    assert [window_seconds(s) for s in (0, 610, 615, 1300, 9999)] == [0, 0, 600, 1200, 2400]
