"""Nearest things, crowded joins, deltas, run pairs, follow-ups, storage and logs against plain programs."""

import io
import math
from datetime import datetime, timedelta, timezone

import numpy as np
from pyspark.sql import functions as F

from meridian.operators import joins, maps, nearness, reports
from meridian.sources import logs, readers


def test_crowded_join_loses_and_doubles_nothing(spark):
    rng = np.random.default_rng(0)
    left = [(i, int(k) if k < 4 else 0, {"a": "b"}) for i, k in enumerate(rng.integers(0, 9, 300))] + [(900, None, None)]
    right = [(i, int(k) if k < 6 else 1) for i, k in enumerate(rng.integers(0, 30, 200))] + [(900, None)]
    a, b = spark.createDataFrame(left, "l long, k long, m map<string,string>"), spark.createDataFrame(right, "r long, k long")
    want = sorted((x, k, y) for x, k, _ in left for y, q in right if k is not None and k == q)
    for share in (0.002, 0.3, 1.0):
        assert sorted((r.l, r.k, r.r) for r in nearness.crowded_join(a, b, ["k"], share, 8).collect()) == want
    assert nearness.crowded_join(a.limit(0), b, ["k"]).count() == nearness.crowded_join(a, b.limit(0), ["k"]).count() == 0


def test_crowded_keys_are_dealt_by_their_rows(spark):
    left, right = [(i, 0 if i < 200 else i) for i in range(300)], [(i, i % 7 * 50) for i in range(90)]
    a, b = spark.createDataFrame(left, "l long, k long"), spark.createDataFrame(right, "r long, k long")
    assert [(r.k, r["_parts"]) for r in nearness.crowded_keys(a, ["k"], 0.1, 32, 1).collect()] == [(0, 7)]
    assert nearness.crowded_keys(a, ["k"], 0.1).count() == 0
    want = sorted((x, k, y) for x, k in left for y, q in right if k == q)
    joined = nearness.crowded_join(a, b, ["k"], 0.01, 8, 1)
    assert sorted((r.l, r.k, r.r) for r in joined.collect()) == want
    # sides that are sent to many parts are never broadcast, whatever their files' sizes say
    assert "strategy=merge" in joined._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_one_shape_meet_once(spark, monkeypatch):
    monkeypatch.setattr(nearness, "LISTED", 3)
    rng = np.random.default_rng(1)
    boxes = [(x, y, x + 3, y + 2) for x, y in rng.integers(0, 12, (5, 2)).tolist()]
    left, right = ([(i, *boxes[k]) for i, k in enumerate(rng.integers(0, 5, 60).tolist())] for _ in range(2))
    left += left[:2] + [(None, *boxes[0]), (99, None, 1, 2, 3)]
    a, b = (spark.createDataFrame(rows, ", ".join(f"{p}{c} long" for c in ("id", "x0", "y0", "x1", "y1"))) for p, rows in (("a_", left), ("b_", right)))
    names = lambda p: [f"{p}{c}" for c in ("x0", "y0", "x1", "y1")]
    meet = (F.col("a_x0") <= F.col("b_x1")) & (F.col("b_x0") <= F.col("a_x1")) & (F.col("a_y0") < F.col("b_y1")) & (F.col("b_y0") < F.col("a_y1"))
    got = joins.grid_join(a, b, 2.0, meet, names("a_"), names("b_"))
    key = lambda t: (t[0] is None, t)
    want = [(p[0], q[0]) for p in left for q in right if None not in p[1:] and p[1] <= q[3] and q[1] <= p[3] and p[2] < q[4] and q[2] < p[4]]
    assert sorted(((r.a_id, r.b_id) for r in got.collect()), key=key) == sorted(want, key=key)
    assert got.columns == [*a.columns, *b.columns]
    one = nearness.bundled(a, names("a_"), "rows").select(F.size("rows").alias("n")).collect()
    assert sum(r.n for r in one) == 63 and len(one) < 63


def test_lists_hold_ids_and_are_dealt_over_all_tasks(spark):
    rows = [(i, i % 7, i % 5, i % 7 + 2, i % 5 + 1) for i in range(300)] + [(None, 0, 0, 2, 1)]
    a, b = (spark.createDataFrame(rows, ", ".join(f"{p}{c} long" for c in ("id", "x0", "y0", "x1", "y1"))) for p in ("a_", "b_"))
    names = lambda p: [f"{p}{c}" for c in ("x0", "y0", "x1", "y1")]
    # what is alike in all rows of a list doesn't travel with each of them
    assert nearness.bundled(a, names("a_"), "rows").schema["rows"].dataType.elementType.names == ["a_id"]
    meet = (F.col("a_x0") <= F.col("b_x1")) & (F.col("b_x0") <= F.col("a_x1")) & (F.col("a_y0") <= F.col("b_y1")) & (F.col("b_y0") <= F.col("a_y1"))
    got = joins.grid_join(a, b, 2.0, meet, names("a_"), names("b_"), {"wider": F.col("a_x1") - F.col("b_x0")})
    want = [(*p, *q, p[3] - q[1]) for p in rows for q in rows if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    # few bytes come in and many pairs are made: tasks aren't reduced by bytes
    assert got.rdd.getNumPartitions() == nearness.SHARES * spark.sparkContext.defaultParallelism
    # 0.0 and -0.0 are one shape, but stay what they are in their rows
    zero = spark.createDataFrame([(1, 0.0), (2, -0.0)], "id long, v double")
    back = nearness.unbundled(nearness.bundled(zero, ["v"], "rows"), {"rows": zero.columns})
    assert back.columns == zero.columns and {r.id: math.copysign(1, r.v) for r in back.collect()} == {1: 1.0, 2: -1.0}


def test_copies_of_points(spark):
    rng = np.random.default_rng(2)
    at = rng.integers(0, 9, (70, 2)).tolist()
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(at)] + [(200, None, 1.0)], "id long, x double, y double")
    side = lambda p: points.select(*(F.col(c).alias(f"{p}{c}") for c in points.columns))
    got = joins.nearest_within(side("a_"), side("b_"), 2.0, 2.0, ["a_x", "a_y"], ["b_x", "b_y"], "a_id", "b_id").collect()
    d = lambda i, j: math.dist(at[i], at[j])
    want = {i: min(((d(i, j), j) for j in range(70) if j != i and d(i, j) < 2), default=None) for i in range(70)}
    assert {r.a_id: (round(r.distance, 9), r.b_id) for r in got} == {i: (round(m[0], 9), m[1]) for i, m in want.items() if m}
    places = spark.createDataFrame([(j, "cityvillage"[j % 2 * 4 :][: 4 + j % 2 * 3] if j % 5 else "moor", float(x), float(y)) for j, (x, y) in enumerate(at)], "place_id long, kind string, px double, py double")
    near = maps.within_type_radius(points.withColumnRenamed("id", "point_id"), places, {"city": 3.0, "village": 1.5}).collect()
    kind = {r.place_id: r.kind for r in places.collect()}
    assert sorted((r.point_id, r.place_id) for r in near) == [(i, j) for i in range(70) for j in range(70) if d(i, j) < {"city": 3, "village": 1.5}.get(kind[j], 0)]


def test_sizes_round_halves_to_even(spark):
    sizes = [0, 51, 52, 256, 768, 1280, 1023, 1 << 20, (1 << 20) - 1, (1 << 20) + (1 << 18), 3 * (1 << 18) + (1 << 20), 1001 * 20011 + 1, -256, -1280, 5 << 40]
    got = [r.s for r in spark.createDataFrame([(k, v) for k, v in enumerate(sizes)], "k long, v long").select("k", reports.readable_size(F.col("v")).alias("s")).orderBy("k").collect()]
    assert got == ["%.1f KB" % (v / 1024) if v < 1 << 20 else "%.1f MB" % (v / (1 << 20)) for v in sizes]


def test_nearest_segments(spark):
    rng = np.random.default_rng(1)
    points = [(i, *map(float, rng.integers(-50, 50, 2))) for i in range(150)] + [(500 + i, 1.0, 1.0) for i in range(80)] + [(999, None, 1.0), (998, 1e6, 0.0)]
    segments = [(i, float(x), float(y), float(x + dx), float(y + dy)) for i, (x, y, dx, dy) in enumerate(rng.integers(-40, 40, (60, 4)).tolist())]
    segments += [(100, 1.0, 1.0, 1.0, 1.0), (101, 1.0, 1.0, 1.0, 1.0), (102, None, 0.0, 1.0, 1.0), (103, -50.0, -50.0, 50.0, 50.0)]

    def exact(p, s):
        (px, py), (ax, ay, bx, by) = p, s
        n = (bx - ax) ** 2 + (by - ay) ** 2
        t = max(0.0, min(1.0, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / n if n else 0.0))
        return math.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay))

    got = {r.point_id: r for r in nearness.nearest_segments(spark.createDataFrame(points, "point_id long, px double, py double"), spark.createDataFrame(segments, "segment_id long, ax double, ay double, bx double, by double"), 7.0, 9.0).collect()}
    for i, x, y in points:
        near = sorted((round(exact((x, y), s[1:]), 9), s[0]) for s in segments if None not in s) if x is not None else [(99.0, 0)]
        assert (i in got) == (near[0][0] <= 9)
        if i in got:
            assert abs(got[i].distance - near[0][0]) < 1e-8 and abs(math.hypot(got[i].x - x, got[i].y - y) - got[i].distance) < 1e-8
            assert abs(exact((x, y), next(s[1:] for s in segments if s[0] == got[i].segment_id)) - near[0][0]) < 1e-8
    assert got[500].segment_id == 100  # of equal ones the smaller id


def test_nearest_k(spark):
    rng = np.random.default_rng(2)
    right = [(i, *map(float, rng.integers(0, 40, 2))) for i in range(120)] + [(200 + i, 3.0, 3.0) for i in range(40)] + [(300, 5000.0, 5000.0), (301, None, 0.0)]
    left = [(i, *map(float, rng.integers(-5, 60, 2))) for i in range(40)] + [(50, 4000.0, 4000.0), (51, None, None), (52, 3.0, 3.0), (52, 3.0, 3.0)]
    a, b = spark.createDataFrame(left, "left_id long, lx double, ly double"), spark.createDataFrame(right, "right_id long, rx double, ry double")
    for k, cell in ((4, 2.0), (200, 1000.0)):
        want = sorted((i, n + 1, j, round(d, 9)) for i, x, y in left if x is not None for n, (d, j) in enumerate(sorted((math.sqrt((x - u) ** 2 + (y - v) ** 2), j) for j, u, v in right if u is not None)[:k]))
        assert sorted((r.left_id, r.rank, r.right_id, round(r.distance, 9)) for r in nearness.nearest_k(a, b, k, cell).collect()) == want
    assert nearness.nearest_k(a, b.limit(0), 3, 1.0).count() == nearness.nearest_k(a.limit(0), b, 3, 1.0).count() == 0


def test_snapshot_delta(spark):
    table = lambda *rows: spark.createDataFrame(rows, "id long, kind string, a string, _now string")
    start = table((1, "x", "p", "k"), (2, "x", None, "k"), (3, "x", "p", "k"), (4, "x", "p", "k"), (None, "x", "p", "k"), (5, "x", "p", "k"), (5, "x", "p", "k"), (6, "y", "p", "k"))
    end = table((1, "x", "p", "k"), (2, "x", "q", "k"), (6, "x", None, "k"), (6, "y", "p", "k"))
    got = lambda m: sorted(((r.id, r.kind, r.a, r.change) for r in joins.snapshot_delta(start, end, ["id", "kind"], ["a", "_now"], m).collect()), key=str)
    kept = [(2, "x", "q", "changed"), (6, "x", None, "added"), (None, "x", "p", "deleted")]
    gone = {i: (i, "x", "p", "deleted") for i in (3, 4, 5)}
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "edited long")
    assert got(None) == got(ids()) == sorted([*kept, *gone.values()], key=str) and got(ids(3, 77)) == sorted([*kept, gone[3]], key=str)


def test_run_pairs_follow_ups_and_storage(spark):
    results = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "b"), (2, 1, "a"), (2, 2, "a"), (3, 1, None), (3, 2, "b"), (None, 1, "a"), (1, 1, "a")], "k long, run long, g string")
    got = {tuple(r)[:4]: tuple(r)[4:] for r in reports.run_pairs(results, "k", "run", "g").collect()}
    assert got == {(1, 2, "a", "b"): (1, 1.0), (1, 2, "a", "a"): (1, 1.0), (1, 3, "a", "b"): (1, 1.0), (2, 3, "b", "b"): (1, 1.0)}
    touches = [("u", "p", "1", 10), ("v", "p", "9", 15), ("v", "p", "9", 12), ("u", "q", "2", 0), ("v", "q", "2", 9), ("w", None, "1", 30), ("w", None, "2", 1), ("u", None, None, 5), (None, "p", "1", 99), ("w", None, "1", None)]
    found = {(r.first_uri, r.next_uri): (r.followers, r.delay) for r in reports.followups(spark.createDataFrame(touches, "uri string, account string, address string, t long")).collect()}
    assert found == {("u", "v"): (2, 5), ("u", "w"): (2, 10), ("w", "v"): (1, 8)}
    files = [(1, "gpx", "a", 1, 10), (1, "gpx", "a", 2, 20), (1, "gpx", "b", 1, 5), (1, "gpx", "b", 2, -1), (1, "fav", "a", 1, 0), (2, "gpx", "a", 1, None)]
    usage = {r.u: tuple(r)[1:] for r in reports.storage_usage(spark.createDataFrame(files, "u long, type string, name string, at long, size long"), "u", ["type", "name"], "at", "size").collect()}
    assert usage == {1: (4, 2, 20, 35), 2: (0, 0, 0, 0)}


def test_merged_roads_against_pairing(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i), f"r{i % 6}", [int(x) for x in rng.integers(0, 14, int(rng.integers(2, 4)))]) for i in rng.permutation(120)] + [(500, None, [1, 2]), (501, "r0", None), (502, "r0", [3])]
    want = set()
    for ref in {f"r{k}" for k in range(6)}:
        chains = {i: list(n) for i, r, n in rows if r == ref and n and len(n) > 1}
        while True:
            starts, ends = {}, {}
            for k, n in chains.items():
                starts.setdefault(n[0], []).append(k)
                ends.setdefault(n[-1], []).append(k)
            pairs = [(ends[n][0], s[0]) for n, s in starts.items() if len(s) == 1 and len(ends.get(n, ())) == 1 and s[0] != ends[n][0]]
            if not pairs:
                break
            a, b = pairs[0]
            nodes = chains.pop(a) + chains.pop(b)[1:]
            chains[min(a, b)] = nodes
        want |= {(ref, k, tuple(n) if n[0] != n[-1] else frozenset(n), len(n)) for k, n in chains.items()}
    got = maps.merged_roads(spark.createDataFrame(rows, "id long, ref string, nodes array<long>")).collect()
    assert {(r.ref, r.chain, tuple(r.nodes) if r.nodes[0] != r.nodes[-1] else frozenset(r.nodes), len(r.nodes)) for r in got} == want
    assert maps.merged_roads(spark.createDataFrame([], "id long, ref string, nodes array<long>")).count() == 0


class Counting(io.BytesIO):
    """A file that counts what is read."""

    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out


def log(n: int, odd: int = 0) -> bytes:
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    lines = []
    for k in range(n):
        at = (start + timedelta(seconds=k // 2)).strftime("%d/%b/%Y:%H:%M:%S +0000")
        lines.append(f'10.0.0.{k % 250} - - [{at}] "GET /api/x{k}?aid=u{k % 7} HTTP/1.1" {404 if k % 10 == 3 else 200} 5 "-" "é"' if not odd or k % odd else "x" * (k % 50_000))
    return "\n".join(lines).encode() + b"\n"


def test_start_of_a_log_reads_little():
    data = log(200_000)
    start = datetime(2024, 1, 1, 20, tzinfo=timezone.utc)
    f = Counting(data)
    at = logs.start_offset(f, len(data), start)
    first = next(i for i, line in enumerate(data.split(b"\n")) if logs.time_of(line) >= start)
    place = len(b"\n".join(data.split(b"\n")[:first])) + 1
    assert at <= place <= at + 2 * logs.PROBE and f.taken < 40 * logs.PROBE < len(data) / 20
    for other, want in ((datetime(2023, 1, 1, tzinfo=timezone.utc), 0), (datetime(2025, 1, 1, tzinfo=timezone.utc), len(data))):
        assert abs(logs.start_offset(Counting(data), len(data), other) - want) <= logs.PROBE
    assert logs.start_offset(Counting(b""), 0, start) == 0


def test_stretches_give_each_line_once():
    for data in (log(300), log(300)[:-1], b"", b"one line", b"\n\na\n", b"a\nb"):
        for split in (1, 7, 50, 333, 10**6):
            cuts = [*range(0, len(data), split), len(data)]
            got = [x for a, b in zip(cuts, cuts[1:]) for x in logs.lines_of(io.BytesIO(data), a, b, len(data), 64)]
            assert got == data.split(b"\n")[: None if data and not data.endswith(b"\n") else -1]


def test_log_since_equals_a_full_scan(spark, tmp_path):
    path = tmp_path / "access.log"
    path.write_bytes(log(6000, odd=97))
    start = "2024-01-01T00:30:10"
    full = readers.access_log(spark, str(path)).filter((F.col("time") >= F.lit(start).cast("timestamp")) & ~F.col("status").between(400, 499))
    part = logs.log_since(spark, str(path), start, split=20_000)
    assert part.rdd.getNumPartitions() > 5 and sorted(map(str, part.collect())) == sorted(map(str, full.collect())) and part.count() > 1000
    assert logs.log_since(spark, str(path), start, text="aid=u3").count() == full.filter("aid = 'u3'").count()
    assert logs.log_since(spark, str(path), "2030-01-01").count() == 0
