"""Rings, areas and staging against plain programs and known figures."""

import numpy as np
from pyspark.sql import functions as F

from meridian.operators import polygons as P

KEYS = ["relation", "role"]
WAYS = "relation long, role string, way long, nodes array<long>"


def square(k=1, x=0, y=0):
    """Corners of a square around (x, y), as (x, y)."""
    return [(x + k * a, y + k * b) for a, b in ((-1, 1), (1, 1), (1, -1), (-1, -1))]


def number(p):
    return 1_000_000 + 1000 * p[0] + p[1]


def polygon(spark, parts):
    """One row of polygons for ways given as (role, corners)."""
    rows = [(1, role, k, [number(p) for p in way]) for k, (role, way) in enumerate(parts)]
    nodes = spark.createDataFrame(sorted({(number(p), float(p[0]), float(p[1])) for _, way in parts for p in way}), "id long, x double, y double")
    chains = P.located(P.rings(spark.createDataFrame(rows, WAYS), KEYS), nodes, KEYS)
    return P.polygons(chains, "relation", "role").first()


def plain_rings(ways):
    """{(closed, nodes from the smallest way on)} of one group, by walking from end to end."""
    ends = {}
    for w, nodes in sorted(ways.items()):
        for e in (0, 1):
            ends.setdefault(nodes[-e], []).append((w, e))
    mate = {}
    for at in ends.values():
        at.sort()
        for a, b in zip(at[::2], at[1::2]):
            mate[a], mate[b] = b, a
    out, left = set(), set(ways)
    while left:
        head = min(left)

        def walk(w, d):  # d 0: forward
            seen = []
            while True:
                seen.append((w, d))
                after = mate.get((w, 1 - d))
                if after is None or after == (head, start):
                    return seen, after is not None
                w, d = after

        start = 0
        ahead, closed = walk(head, 0)
        behind = []
        if not closed:
            start = 1
            behind = [(w, 1 - d) for w, d in walk(head, 1)[0][1:]][::-1]
        nodes = []
        for w, d in behind + ahead:
            own = ways[w][::-1] if d else ways[w]
            nodes += own if not nodes else own[1:]
        out.add((closed, tuple(nodes)))
        left -= {w for w, _ in behind + ahead}
    return out


def test_rings_of_shuffled_ways(spark):
    rng = np.random.default_rng(1)
    rows, groups = [], {}
    for g in range(20):
        ways, ids = {}, iter(rng.permutation(400).tolist())
        for _ in range(int(rng.integers(1, 5))):
            # rings through a small pool of nodes cross each other at times
            corners = rng.choice(10_000 if g % 2 else 25, int(rng.integers(4, 20)), replace=False).tolist()
            cuts = sorted(rng.choice(len(corners), int(rng.integers(2, 4)), replace=False).tolist())
            ring = corners[cuts[0] :] + corners[: cuts[0]] + [corners[cuts[0]]]
            at = [c - cuts[0] for c in cuts] + [len(corners)]
            for a, b in zip(at, at[1:]):
                if rng.random() < 0.85 and ring[a] != ring[b]:
                    part = ring[a : b + 1]
                    ways[next(ids)] = part[::-1] if rng.random() < 0.5 else part
        groups[g] = ways
        rows += [(g, "outer", w, n) for w, n in ways.items()]
    rng.shuffle(rows)
    rows = [(int(a), str(b), int(c), [int(x) for x in n]) for a, b, c, n in rows]
    got = P.rings(spark.createDataFrame(rows + rows[:5], WAYS).repartition(4), KEYS).collect()
    assert {(r.relation, r.closed, tuple(r.nodes)) for r in got} == {(g, *x) for g, ways in groups.items() for x in plain_rings(ways)}
    assert sum(r.ways for r in got) == len(rows)


def test_small_groups_are_walked_as_large_ones_are_joined(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(g, None if g == 4 else "outer", int(w), [int(x) for x in rng.integers(0, 9, int(rng.integers(1, 4)))]) for g in range(5) for w in rng.permutation(30)[:12]]
    rows += [(7, "outer", w, [w, (w + 1) % 40]) for w in range(40)] + rows[:3] + [(1, "outer", rows[12][2], [0, 1])]
    ways = spark.createDataFrame(rows, WAYS)
    found = []
    for most in (10_000, 60, 0):
        monkeypatch.setattr(P, "WALKED", most)
        found.append(sorted((r.relation, r.role, r.chain, r.closed, r.ways, r.nodes) for r in P.rings(ways, KEYS).collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) > 10
    assert P.walked([(3, [1, 2]), (5, [1, 3])]) == [(3, False, 2, [3, 1, 2])]


def test_long_chain_and_odd_ways(spark):
    n = 70
    order = np.random.default_rng(3).permutation(n).tolist()
    rows = [(1, None if k == 9 else "outer", w, [k, (k + 1) % n] if w % 3 else [(k + 1) % n, k]) for k, w in enumerate(order) if k != 9]
    rows += [(2, "outer", 5, [1, 2, 3, 1]), (2, "outer", 6, []), (2, "outer", 7, None), (2, "outer", 8, [4]), (2, "outer", 9, [4, None, 5]), (2, None, 10, [4, 5]), (None, "outer", 11, [4, 5]), (2, "outer", None, [4, 5]), (3, "inner", 12, [7, 8])]
    got = {(r.relation, r.role): r for r in P.rings(spark.createDataFrame(rows, WAYS), KEYS).collect()}
    chain = got[1, "outer"]
    assert set(got) == {(1, "outer"), (2, "outer"), (3, "inner")} and not chain.closed and chain.ways == n - 1
    steps = {(b - a) % n for a, b in zip(chain.nodes, chain.nodes[1:])}
    assert len(chain.nodes) == n and steps in ({1}, {n - 1}) and {chain.nodes[0], chain.nodes[-1]} == {9, 10}
    assert got[2, "outer"].closed and got[2, "outer"].nodes == [1, 2, 3, 1] and not got[3, "inner"].closed
    assert P.rings(spark.createDataFrame([], WAYS), KEYS).count() == 0


def test_known_polygons(spark):
    first, second = [(0, 0), (1, 0), (1, 1), (1, 2)], [(1, 2), (0, 2), (-1, 2), (0, 0)]
    other = [(4, 4), (4, 5), (3, 5), (4, 4)]
    two = polygon(spark, [("outer", first), ("outer", second), ("outer", other)])
    assert len(two.outer) == 2 and two.open == 0
    assert [polygon(spark, [("outer", x)]).open for x in (other, first)] == [0, 1]
    chain = polygon(spark, [("outer", [(1, 1), (1, 2), (1, 3)]), ("outer", [(1, 5), (1, 6), (1, 2)]), ("outer", [(1, 3), (1, 4), (1, 5)])])
    assert chain.open == 1 and not chain.outer
    ring = lambda k, x=0, y=0: [*square(k, x, y), square(k, x, y)[0]]
    holed = polygon(spark, [("outer", ring(40)), ("inner", ring(1)), ("inner", ring(1, 10, 10)), ("", ring(2, 100, 100))])
    assert len(holed.outer) == 2 and len(holed.inner) == 2 and holed.area == 80 * 80 - 2 * 4 + 16


def test_areas_and_points(spark):
    rows = [
        (1, [(0.0, 0.0), (0.0, 1.0), (0.5, 1.0), (0.5, 1.5), (1.0, 1.0)]),  # (x longitude, y latitude)
        (2, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]), (3, [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]),
        (4, [(1.0, 1.0), (3.0, 3.0)]), (5, []), (6, [(0.0, 0.0), (6.0, 0.0), (6.0, 6.0), (5.0, 6.0), (5.0, 1.0), (1.0, 1.0), (1.0, 6.0), (0.0, 6.0)]),
    ]
    df = spark.createDataFrame(rows, "id long, ring array<struct<x double, y double>>")
    got = {r.id: r for r in df.select("id", P.signed_area(F.col("ring")).alias("a"), P.square_metres(F.col("ring")).alias("m"), P.centroid(F.col("ring")).alias("c"), P.interior_point(F.array("ring")).alias("p")).collect()}
    assert abs(got[1].m / 7716818755.73 - 1) < 0.01
    assert got[2].a == 16 and got[3].a == -16 and got[4].a == got[5].a == 0 and got[6].a == 16
    assert tuple(got[2].c) == tuple(got[3].c) == (2, 2) and tuple(got[4].c) == (2, 2) and got[5].c is None and tuple(got[6].c)[0] == 3
    assert tuple(got[2].p) == (2, 2) and got[5].p is None and got[6].p.y == 3 and got[6].p.x in (0.5, 5.5)
    hole = df.filter("id in (2)").select(P.interior_point(F.array("ring", F.expr("array(named_struct('x', 1D, 'y', 1D), named_struct('x', 3.5D, 'y', 1D), named_struct('x', 3.5D, 'y', 3D), named_struct('x', 1D, 'y', 3D))"))).alias("p")).first().p
    assert tuple(hole) == (0.5, 2)


def test_nodes_that_are_missing(spark):
    chains = spark.createDataFrame([(1, "outer", 1, True, 1, [1, 2, 3, 1]), (1, "outer", 4, False, 1, [9, 8])], "relation long, role string, chain long, closed boolean, ways long, nodes array<long>")
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (3, 1.0, 0.0)], "id long, x double, y double")
    got = {r.chain: (r.missing, [tuple(p) for p in r.ring]) for r in P.located(chains, nodes, KEYS).collect()}
    assert got == {1: (1, [(0, 0), (1, 0), (0, 0)]), 4: (2, [])}


def test_tasks_of_a_closure_follow_its_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "ROWS", 100)
    ids = lambda n: spark.range(n)
    members = spark.range(60).selectExpr("id % 30 as id", "if(id < 30, 'relation', 'way') as type", "(id + 1) % 30 as ref")
    way_nodes = spark.range(90).selectExpr("id % 30 as id", "id as node")
    got = P.closure(members, {"relation": ids(30), "way": ids(20), "node": ids(80)}, way_nodes)
    # a ring of 30 relations: each of them leads to all relations, ways and nodes
    want = [(r, kind, k, k >= there) for kind, n, there in (("relation", 30, 30), ("way", 30, 20), ("node", 90, 80)) for r in range(30) for k in range(n)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    # 900 ways and 2,700 nodes to tell apart, at about 100 rows in a task
    assert got.rdd.getNumPartitions() >= 36


def test_closure_of_cycles_and_missing_members(spark):
    members = spark.createDataFrame([(1, "relation", 2), (2, "relation", 3), (3, "relation", 1), (1, "relation", 99), (2, "way", 7), (2, "way", 8), (3, "node", 5), (1, None, 4), (1, "way", None), (4, "relation", 4), (1, "relation", 2)], "id long, type string, ref long")
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "id long")
    nodes = spark.createDataFrame([(7, 50), (7, 51), (7, None), (8, 50)], "id long, node long")
    got = sorted(map(tuple, P.closure(members, {"relation": ids(1, 2, 3, 4), "way": ids(7), "node": ids(50, 5)}, nodes).collect()))
    loop = [(r, "relation", x, x == 99) for r in (1, 2, 3) for x in (1, 2, 3, 99)] + [(4, "relation", 4, False)]
    assert got == sorted(loop + [(r, "way", w, w == 8) for r in (1, 2, 3) for w in (7, 8)] + [(r, "node", n, n == 51) for r in (1, 2, 3) for n in (5, 50, 51)])
    assert P.closure(members.limit(0), {k: ids() for k in ("relation", "way", "node")}, nodes).count() == 0
    rows = spark.createDataFrame([(1, 1, "old", "x"), (1, 2, "new", None), (1, 2, "new", None), (None, 3, "no", "x")], "id long, seq long, name string, row string")
    assert [tuple(r) for r in P.staged(rows, "id", "seq").collect()] == [(1, 2, "new", None)]
