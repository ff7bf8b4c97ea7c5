"""Box relations, ranks, texts, rolling statistics, pages and symmetric pairs on small fixtures."""

import gzip
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from meridian.functions import columns as C
from meridian.operators import etl, reports


def test_box_relations(spark):
    boxes = {"equal": (0, 0, 4, 4), "contains": (1, 1, 3, 4), "inside": (-1, 0, 4, 5), "touches": (4, 4, 6, 6), "overlaps": (3, 3, 6, 6), "disjoint": (5, 0, 6, 1)}
    df = spark.createDataFrame([(k, *map(float, v)) for k, v in boxes.items()] + [(None, None, 0.0, 1.0, 1.0)], "k string, x0 double, y0 double, x1 double, y1 double")
    own = [F.lit(float(v)) for v in (0, 0, 4, 4)]
    got = [(r.k, r.x) for r in df.select("k", C.box_relation(own, [F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("x")).collect()]
    assert all(k == x for k, x in got) and len(got) == 7


def test_texts_and_ranks(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    tags = F.create_map(*map(F.lit, ("Name:en", "a", "alt_name", "b", "WEBSITE", "c", "other", "d")))
    assert one(C.important_tags(tags)) == 3
    assert one(C.island_rank(F.lit(100.0), F.lit(3))) == 24.9 and one(C.island_rank(F.lit(0.0), F.lit(50))) == 70.0 and one(C.island_rank(F.lit(1e30), F.lit(0))) == 30.0
    assert one(C.has_extension(F.lit("A.JpG"), ["jpg"])) and not one(C.has_extension(F.lit("jpg"), ["jpg", "png"]))
    texts = ["2024-01-31T10:20:30", "2024-01-31 10:20:30.5", "2024-01-31T10:20:30+02:00", "never", None]
    got = [r.x for r in spark.createDataFrame([(t,) for t in texts], "t string").select(C.iso_timestamp(F.col("t")).cast("string").alias("x")).collect()]
    assert got == ["2024-01-31 10:20:30", "2024-01-31 10:20:30.5", "2024-01-31 08:20:30", None, None]
    packed = gzip.compress("<gpx>é</gpx>".encode())
    rows = [(packed.hex(),), (packed.hex().upper(),), (packed.hex()[:-8],), ("zz",), ("",), (None,), (gzip.compress(b"\xff").hex(),)]
    assert [r.x for r in spark.createDataFrame(rows, "h string").select(C.gunzipped(F.col("h")).alias("x")).collect()] == ["<gpx>é</gpx>"] * 2 + [None, None, "", None, None]


def test_old_columns(spark):
    """Helpers that no query uses."""
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert abs(one(C.bearing(*(F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)))) - 90) < 1e-9 and abs(one(C.bearing(*(F.lit(x) for x in (1.0, 5.0, 0.0, 5.0)))) - 180) < 1e-9
    assert one(C.tile_x(F.lit(0.0), 3)) == 4 and one(C.tile_y(F.lit(0.0), 3)) == 4 and one(C.tile_x(F.lit(-180.0), 5)) == 0 and one(C.tile_y(F.lit(85.0511), 4)) == 0
    assert one(C.xor_checksum(F.lit("AB"))) == "3"
    speeds = {(5.0, 9.0): "foot", (20.0, 30.0): "cycling", (0.0, 1.0): "nospeed", (None, 1.0): "nospeed", (90.0, 130.0): "driving", (800.0, 900.0): "aviation", (5.0, 5000.0): "other"}
    for (avg, top), name in speeds.items():
        assert one(C.activity_by_speed(F.lit(avg).cast("double"), F.lit(top))) == name
    problems = {(9, 900.0, 1.0, 1.0): "sparse", (10, 199.0, 1.0, 1.0): "short", (10, 200.0, 1001.0, 1201.0): "teleport", (10, 200.0, 1001.0, 1.0): None}
    for values, name in problems.items():
        assert one(C.track_problem(*map(F.lit, values))) == name


def test_rolling_statistics(spark):
    rng = np.random.default_rng(3)
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(minutes=int(m)), float(v)) for m, v in zip(rng.integers(0, 6000, 300), rng.integers(0, 20, 300))] + [(start, None), (None, 1.0), (start + timedelta(hours=24), 5.0)]
    times = [start + timedelta(hours=h) for h in (0, 24, 48, 90)] + [start + timedelta(days=400)]
    at = spark.createDataFrame([(t,) for t in times + times[:1]], "t timestamp_ntz")
    got = {(r.at, r.hours): (r.n, r.mean, r.value) for r in reports.rolling_statistics(spark.createDataFrame(rows, "when timestamp_ntz, v double"), "when", "v", at, [3, 24, 72], 90).collect()}
    want = {}
    for t in times:
        for h in (3, 24, 72):
            x = sorted(v for m, v in rows if m is not None and v is not None and t - timedelta(hours=h) < m <= t)
            if x:
                pos = 0.9 * (len(x) + 1)
                k = int(pos)
                want[t, h] = (len(x), np.mean(x), x[0] if pos < 1 else x[-1] if pos >= len(x) else x[k - 1] + (pos - k) * (x[k] - x[k - 1]))
    assert set(got) == set(want) and all(np.allclose(got[k], want[k]) for k in want)


def test_pages_and_symmetric_pairs(spark):
    df = spark.createDataFrame([(k,) for k in range(25)], "id long")
    page = lambda n: [(r.id, r.total) for r in reports.page_of(df, [F.desc("id")], 10, n).collect()]
    assert sorted(page(2)) == [(k, 25) for k in range(5)] and page(3) == [] and reports.page_of(df.limit(0), [F.col("id")], 5, 0).count() == 0
    pairs = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.7), (1, 3, 0.1), (4, 4, 1.0), (None, 1, 0.2)], "id long, other long, similarity double")
    assert sorted(map(tuple, reports.symmetric(pairs).collect())) == [(1, 2, 0.7), (1, 3, 0.1), (2, 1, 0.7), (3, 1, 0.1)]


def test_preferred_parents(spark):
    rows = [(1, "root", "en", None), (2, "root", "de", None), (3, "a", "de", "root"), (4, "a", "fr", "root"), (5, "b", "de", "a"), (6, "b", "it", "a"), (7, "c", "de", "nowhere"), (8, "d", "de", "c"), (9, "e", None, "a"), (10, "x", "en", "y"), (11, "y", "en", "x")]
    nodes = spark.createDataFrame(rows, "id long, title string, lang string, part_of string")
    got = {r.id: r.parent for r in etl.preferred_parents(nodes).collect()}
    assert got == {1: None, 2: None, 3: 2, 4: 1, 5: 3, 6: 3, 8: 7, 9: 3, 10: 11, 11: 10}
    paths = {r.id: r.path for r in etl.hierarchy_paths(etl.preferred_parents(nodes), "id", "parent").collect()}
    assert paths == {1: "1", 2: "2", 3: "2/3", 4: "1/4", 5: "2/3/5", 6: "2/3/6", 9: "2/3/9"}
