"""Sources, sinks, texts and streams that no query reaches."""

import json
import sqlite3

from pyspark.sql import functions as F

from meridian.functions import columns as C
from meridian.sources import readers
from meridian.streaming import feeds


def test_texts(spark):
    df = spark.createDataFrame([("2024-05-17", "a - b - c", "/api/x/y?q=1", " Côte d’Azur "), (None, "none", "/map/tile?z=1", None), ("2024", " - x", "/subscription/a", "`A´"), ("", "", "/", "")], "d string, s string, u string, n string")
    got = df.select(C.month_of(F.col("d")), C.before_separator(F.col("s"), " - "), C.endpoint(F.col("u")), C.folded_name(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("2024-05", "a", "/api/x/y", "côte d'azur"), (None, None, "/map", None), ("2024", "", "/subscription/a", "'a'"), ("", None, "/", "")]


def test_sampled_rows_are_exact_and_repeatable(spark):
    df = spark.range(1000)
    first, again = ({r.id for r in readers.sampled(df, 37).collect()} for _ in range(2))
    assert len(first) == 37 and first == again and readers.sampled(df, 5000).count() == 1000 and readers.sampled(df.limit(0), 3).count() == 0


def test_files_partitions_and_upserts(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x.obf").write_bytes(b"12345")
    (tmp_path / "a" / "y.txt").write_bytes(b"1")
    assert [(r.path[-9:], r.length) for r in readers.files(spark, str(tmp_path / "a"), "*.obf").collect()] == [("a/b/x.obf", 5)]
    out = str(tmp_path / "parts")
    readers.overwrite_partitions(spark.createDataFrame([(1, "x"), (2, "y")], "v long, k string"), out, "k")
    readers.overwrite_partitions(spark.createDataFrame([(3, "y"), (4, "z")], "v long, k string"), out, "k")
    assert sorted((r.v, r.k) for r in spark.read.parquet(out).collect()) == [(1, "x"), (3, "y"), (4, "z")]
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "id long, v string, w double")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "id long, v string")
    assert sorted(map(tuple, readers.upserted(old, new, ["id"]).collect()), key=str) == sorted([(1, "a", 1.0), (2, "B", None), (3, "C", None), (None, "n", 0.0)], key=str)


def test_geojson(spark):
    df = spark.createDataFrame([(1.5, 2.5, "a", None), (None, 0.0, "b", 3)], "lat double, lon double, name string, n long")
    first, second = (json.loads(r.feature) for r in readers.geojson(df, "lat", "lon", ["name", "n"]).collect())
    assert first == {"type": "Feature", "geometry": {"type": "Point", "coordinates": [2.5, 1.5]}, "properties": {"name": "a"}}
    assert second["properties"] == {"name": "b", "n": 3}


def test_jdbc_passes_its_ranges_on(spark, monkeypatch):
    """No driver of a database is at hand; the call that Spark gets is what counts."""
    seen = {}
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, *a, **k: seen.update(k, args=a) or "rows")
    assert readers.jdbc(spark, "jdbc:x", "t", "id", 0, 100, 4, user="u") == "rows"
    assert seen == {"args": ("jdbc:x", "t"), "column": "id", "lowerBound": 0, "upperBound": 100, "numPartitions": 4, "properties": {"user": "u"}} and sqlite3.sqlite_version


SIGNALS = "user_id long, ts timestamp, arrived timestamp, event_id long, event_type string, value double"


def test_streams_of_signals(spark, tmp_path):
    at = lambda m: f"2024-01-01 00:{m:02d}:00"
    batches = [
        [(1, at(30), at(1), 1, "late time", 5.0), (1, at(10), at(2), 2, "second", None), (2, at(1), at(1), 3, "x", 7.0)],
        [(1, at(5), at(3), 4, "third", None), (2, at(2), at(2), 5, "y", None), (2, at(2), at(2), 6, "z", 9.0), (None, at(1), at(1), 7, "nobody", 1.0)],
    ]
    for k, rows in enumerate(batches):
        typed = [(u, t, a, i, e, v) for u, t, a, i, e, v in rows]
        df = spark.createDataFrame(typed, "user_id long, ts string, arrived string, event_id long, event_type string, value double")
        df.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("arrived", F.col("arrived").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SIGNALS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = feeds.run_once(feeds.last_arrivals(stream), "arrivals", "update").groupBy("user_id").agg(F.max_by(F.struct("last_type", "last_value", "signals"), "signals").alias("m")).select("user_id", "m.*").collect()
    got = {r.user_id: (r.last_type, r.last_value, r.signals) for r in out}
    assert got[1][1:] == (5.0, 3) and got[2][1:] in ((9.0, 3), (7.0, 3)) and got[None] == ("nobody", 1.0, 1)
    # files are taken in the order of their times, which may be equal here; either batch may be the later one
    assert (got[1][0], got[2][0], got[2][1]) in (("third", "z", 9.0), ("second", "x", 7.0))
    lasts = {r.user_id: (r.last_type, r.last_value) for r in feeds.run_once(feeds.last_values(stream), "by_time").collect()}
    assert lasts == {1: ("late time", 5.0), 2: ("z", 9.0), None: ("nobody", 1.0)}
    rows = [(1, at(1), at(1), 1, "a", 1.0)] * 3 + [(1, at(2), at(2), 1, "a", 2.0), (2, at(1), at(1), 1, "a", 1.0)]
    df = spark.createDataFrame(rows, "user_id long, ts string, arrived string, event_id long, event_type string, value double")
    df.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("arrived", F.col("arrived").cast("timestamp")).write.parquet(str(tmp_path / "twice"))
    once = feeds.run_once(feeds.deduplicated(spark.readStream.schema(SIGNALS).parquet(str(tmp_path / "twice")), ["user_id", "event_id"]), "once", "append")
    assert sorted(r.user_id for r in once.collect()) == [1, 2]
