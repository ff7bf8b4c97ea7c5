"""Rings of ways, their areas and points inside; staging of map entities.

Unless said otherwise: null keys meet nothing, repeated rows count once, and empty tables give empty results.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.saving import saved

#: Radius of the sphere on which areas are taken, in metres.
RADIUS = 6_378_137.0
#: Nodes of a group's ways, with repeats, up to which the group is joined in one place.
WALKED = 10_000
#: Rows that a task of ``closure`` sorts or tells apart, about.
ROWS = 1_000_000
#: Rows of a step of ``closure`` up to which it is sent to the links and the pairs that it may meet again, instead of shuffling those.
SENT = 100_000


def doubled(chain: DataFrame, keys: list[str], rounds: int) -> DataFrame:
    """``chain`` (keys, dart, next, least, steps) after following ``next`` 2^rounds steps: the smallest ``least`` on the way, the steps
    taken, and where the walk stands (null where it ended)."""
    for _ in range(rounds):
        ahead = chain.select(*keys, F.col("dart").alias("next"), F.col("next").alias("next2"), F.col("least").alias("least2"), F.col("steps").alias("steps2"))
        # a walk that ended is met by others, but goes no further; its rows don't add tasks with each round
        ended = chain.filter("next is null").select(*keys, "dart", "next", "least", "steps").coalesce(int(chain.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        both = chain.filter("next is not null").join(ahead, [*keys, "next"], "left")
        moved = both.select(*keys, "dart", F.col("next2").alias("next"), F.least("least", "least2").alias("least"), (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"))
        chain = saved(moved.union(ended))
    return chain


def walked(ways: list[tuple[int, list[int]]]) -> list[tuple[int, bool, int, list[int]]]:
    """(chain, closed, ways, nodes) of one small group's (way, nodes), as ``rings`` says."""
    least: dict[int, list[int]] = {}
    for way, nodes in ways:
        least[way] = min(nodes, least.get(way, nodes))
    out = [(way, True, 1, nodes) for way, nodes in least.items() if nodes[0] == nodes[-1]]
    parts = {way: nodes for way, nodes in sorted(least.items()) if nodes[0] != nodes[-1]}
    # ends (way, 0 for its first node or 1 for its last) that are joined
    waiting, partner = {}, {}
    for way, nodes in parts.items():
        for end, node in ((0, nodes[0]), (1, nodes[-1])):
            if other := waiting.pop(node, None):
                partner[other], partner[way, end] = (way, end), other
            else:
                waiting[node] = way, end
    seen = set()
    for way in parts:
        if way in seen:
            continue
        seen.add(way)
        ahead, behind, closed, at = [(way, False)], [], False, (way, 1)
        while not closed and (found := partner.get(at)):
            closed = found[0] == way
            if not closed:
                ahead.append((found[0], found[1] == 1))
                at = found[0], 1 - found[1]
        at = way, 0
        while not closed and (found := partner.get(at)):
            behind.append((found[0], found[1] == 0))
            at = found[0], 1 - found[1]
        nodes: list[int] = []
        for k, turned in [*reversed(behind), *ahead]:
            seen.add(k)
            own = parts[k][::-1] if turned else parts[k]
            nodes += own[1:] if nodes else own
        out.append((way, closed, len(ahead) + len(behind), nodes))
    return out


def rings(ways: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, chain, closed, ways, nodes): the ways of each group joined at shared end points into rings, or open chains where ends are left.

    ``ways``: keys (a relation and a role, say), way (long, not negative), nodes (array of long). Of several ways that end at a node the
    first two by id are joined, then the next two; a closed way is a ring of its own. A chain is known by its smallest way, which is
    passed forward; a ring begins with it, and ends with the node that it began with. Ways without nodes, with null nodes or with one node
    are left out; of rows of one way in one group the one with the smallest list counts.

    Groups of up to ``WALKED`` nodes are brought together once and walked way by way; larger ones are joined by ``large_rings``.
    """
    usable = ways.filter((F.size("nodes") > 1) & ~F.exists("nodes", lambda n: n.isNull())).dropna(subset=[*keys, "way"]).select(*keys, "way", "nodes")
    usable = saved(usable)  # whatever makes the ways does so once, not again after the groups' sizes are known
    large = saved(usable.groupBy(*keys).agg(F.sum(F.size("nodes")).alias("n")).filter(F.col("n") > WALKED).select(*keys))
    some = not large.isEmpty()
    few = usable.join(large, keys, "left_anti") if some else usable
    kind = usable.schema
    walk = F.udf(walked, f"array<struct<chain:{kind['way'].dataType.simpleString()},closed:boolean,ways:bigint,nodes:{kind['nodes'].dataType.simpleString()}>>", useArrow=False)
    found = few.groupBy(*keys).agg(F.collect_list(F.struct("way", "nodes")).alias("all")).select(*keys, F.explode(walk("all")).alias("ring")).select(*keys, "ring.*")
    return found.union(large_rings(usable.join(large, keys, "left_semi"), keys)) if some else found


def large_rings(usable: DataFrame, keys: list[str]) -> DataFrame:
    """``rings`` of groups of any size, of ways that are usable.

    No chain is walked node by node: each way has two darts, one for each direction, and a dart knows the dart that follows it.
    Following the followers of followers gives, in as many rounds as the number of ways of the largest group has binary digits, the
    smallest dart of a chain, and then each dart's distance from its end.
    """
    usable = saved(usable.groupBy(*keys, "way").agg(F.min("nodes").alias("nodes")))
    first, last = F.get("nodes", F.lit(0)), F.element_at("nodes", -1)
    alone = usable.filter(first == last).select(*keys, F.col("way").alias("chain"), F.lit(True).alias("closed"), F.lit(1).cast("long").alias("ways"), "nodes")
    parts = usable.filter(first != last)
    most = parts.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    if not most:
        return alone
    rounds = max(1, ceil(log2(most)))

    # ends: 0 is a way's first node, 1 its last one
    ends = parts.select(*keys, "way", F.explode(F.array(F.struct(F.lit(0).alias("end"), first.alias("node")), F.struct(F.lit(1).alias("end"), last.alias("node")))).alias("e")).select(*keys, "way", "e.*")
    order = Window.partitionBy(*keys, "node").orderBy("way", "end")
    couple = F.floor((F.row_number().over(order) - 1) / 2)
    coupled = ends.withColumn("couple", couple).groupBy(*keys, "node", "couple").agg(F.array_sort(F.collect_list(F.struct("way", "end"))).alias("both")).filter(F.size("both") == 2)
    a, b = F.get("both", F.lit(0)), F.get("both", F.lit(1))
    # a dart leaves a way at an end, and enters the other way at its: way * 2 forward, way * 2 + 1 back
    leaves = lambda x: x["way"] * 2 + (1 - x["end"])
    enters = lambda x: x["way"] * 2 + x["end"]
    follows = coupled.select(*keys, F.explode(F.array(F.struct(leaves(a).alias("dart"), enters(b).alias("next")), F.struct(leaves(b).alias("dart"), enters(a).alias("next")))).alias("f")).select(*keys, "f.*")
    darts = parts.select(*keys, F.explode(F.array(F.col("way") * 2, F.col("way") * 2 + 1)).alias("dart"))
    follows = saved(darts.join(follows, [*keys, "dart"], "left"))

    walked = doubled(follows.select(*keys, "dart", "next", F.col("dart").alias("least"), F.lit(1).cast("long").alias("steps")), keys, rounds)
    back = walked.select(*keys, F.col("dart").bitwiseXOR(F.lit(1)).alias("dart"), F.col("least").bitwiseXOR(F.lit(1)).alias("behind"))
    head = F.when(F.shiftright("behind", 1) < F.shiftright("least", 1), F.col("behind")).otherwise(F.col("least"))
    chosen = walked.join(back, [*keys, "dart"]).select(*keys, "dart", head.alias("head"), F.col("next").isNotNull().alias("closed")).filter(F.col("head").bitwiseAND(F.lit(1)) == 0)
    # of a ring the dart before the head has no follower any more
    opened = F.when(~(F.col("closed") & (F.col("next") == F.col("head"))), F.col("next")).alias("next")
    again = chosen.join(follows, [*keys, "dart"]).select(*keys, "dart", opened, F.col("dart").alias("least"), F.lit(1).cast("long").alias("steps"))
    placed = doubled(again, keys, rounds).select(*keys, "dart", "steps").join(chosen, [*keys, "dart"])
    turned = F.when(F.col("dart").bitwiseAND(F.lit(1)) == 1, F.reverse("nodes")).otherwise(F.col("nodes"))
    pieces = placed.withColumn("way", F.shiftright("dart", 1)).join(parts, [*keys, "way"]).select(*keys, F.shiftright("head", 1).alias("chain"), "closed", F.struct((-F.col("steps")).alias("place"), turned.alias("nodes")).alias("piece"))
    grouped = pieces.groupBy(*keys, "chain", "closed").agg(F.array_sort(F.collect_list("piece")).alias("p"))
    nodes = F.flatten(F.transform("p", lambda x, i: F.when(i == 0, x["nodes"]).otherwise(F.slice(x["nodes"], F.lit(2), F.size(x["nodes"]) - 1))))
    return alone.union(grouped.select(*keys, "chain", "closed", F.size("p").cast("long").alias("ways"), nodes.alias("nodes")))


def located(chains: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
    """``chains`` with ``ring``, an array of (x, y) of their nodes, and ``missing``, the number of nodes that ``nodes`` (id, x, y) lacks; those are passed over."""
    chains = saved(chains)  # taken twice
    each = chains.select(*keys, "chain", F.posexplode("nodes").alias("at", "id"))
    there = nodes.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.lit(True).alias("there"))
    at = each.join(there, "id", "left").select(*keys, "chain", "there", F.when(F.col("there"), F.struct("at", "x", "y")).alias("p"))
    points = at.groupBy(*keys, "chain").agg(F.array_sort(F.collect_list("p")).alias("q"), F.count_if(F.col("there").isNull()).alias("missing"))
    return chains.join(points, [*keys, "chain"]).withColumn("ring", F.transform("q", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))).drop("q")


def _edges(ring: Column, edge) -> Column:
    """``edge`` of each point and the one that follows it; the last is followed by the first."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, following, edge)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def signed_area(ring: Column) -> Column:
    """Area on the plane, positive where the ring runs against the clock; rings close themselves. An empty ring has none (0)."""
    return _sum(_edges(ring, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])) / 2


def square_metres(ring: Column) -> Column:
    """Area of a ring of (x longitude, y latitude) in degrees, on the sphere."""
    sine = lambda p: F.sin(F.radians(p["y"]))
    return F.abs(_sum(_edges(ring, lambda p, q: F.radians(q["x"] - p["x"]) * (2 + sine(p) + sine(q))))) * RADIUS * RADIUS / 2


def centroid(ring: Column) -> Column:
    """(x, y) of the centre of gravity; of a ring without area the mean of its points; null for an empty one."""
    cross = lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]
    six = 6 * signed_area(ring)
    mean = lambda c: F.try_divide(_sum(F.transform(ring, lambda p: p[c])), F.size(ring).cast("double"))
    along = lambda c: F.when(six == 0, mean(c)).otherwise(F.try_divide(_sum(_edges(ring, lambda p, q: (p[c] + q[c]) * cross(p, q))), six))
    return F.when(F.size(ring) > 0, F.struct(along("x").alias("x"), along("y").alias("y")))


def interior_point(rings_: Column) -> Column:
    """(x, y) inside a polygon given as an array of its rings, holes too: the middle of the widest stretch inside at the middle height. Null without area."""
    ys = F.flatten(F.transform(rings_, lambda ring: F.transform(ring, lambda p: p["y"])))
    y = (F.array_min(ys) + F.array_max(ys)) / 2

    def crossing(p: Column, q: Column) -> Column:
        at = p["x"] + F.try_divide((y - p["y"]) * (q["x"] - p["x"]), q["y"] - p["y"])
        return F.when((p["y"] > y) != (q["y"] > y), at)

    xs = F.array_sort(F.filter(F.flatten(F.transform(rings_, lambda ring: _edges(ring, crossing))), lambda x: x.isNotNull()))
    stretch = lambda k: F.struct((F.get(xs, 2 * k + 1) - F.get(xs, 2 * k)).alias("w"), ((F.get(xs, 2 * k + 1) + F.get(xs, 2 * k)) / 2).alias("x"))
    stretches = F.when(F.size(xs) > 1, F.transform(F.sequence(F.lit(0), F.floor(F.size(xs) / 2).cast("int") - 1), stretch))
    widest = F.array_max(stretches)
    return F.when(widest["w"] > 0, F.struct(widest["x"].alias("x"), y.alias("y")))


def polygons(rings_: DataFrame, relation: str, role: str, inner: str = "inner") -> DataFrame:
    """(relation, outer, inner, open, area): closed rings of each relation by role, the number of its open chains, and its area without holes.

    ``rings_``: relation, role, closed, ring. Rings of a role other than ``inner`` (null, too) are outer ones.
    """
    hole = F.coalesce(F.col(role) == inner, F.lit(False))
    area = F.abs(signed_area(F.col("ring")))
    some = lambda c: F.collect_list(F.when(F.col("closed") & c, F.col("ring")))
    sums = F.coalesce(F.sum(F.when(F.col("closed"), F.when(hole, -area).otherwise(area))), F.lit(0.0))
    return rings_.groupBy(relation).agg(some(~hole).alias("outer"), some(hole).alias("inner"), F.count_if(~F.col("closed")).alias("open"), sums.alias("area"))


def staged(entities: DataFrame, key: str, order: str) -> DataFrame:
    """One row per id, the one that was loaded last, as a whole; rows of an equal ``order`` go by their content. Rows without an id are left out."""
    return entities.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(order, F.struct(*entities.columns).alias("row"))).alias("m")).select("m.row.*")


def _dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` shuffled by ``keys`` to as many tasks as ``rows`` ask for. Spark's own number goes by compressed bytes, of which rows of ids have few."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, ceil(rows / ROWS)), *keys)


def closure(members: DataFrame, present: dict[str, DataFrame], way_nodes: DataFrame) -> DataFrame:
    """(root, kind, id, missing): all that a relation is made of, in phases: relations through relations, then ways, then nodes of either.

    ``members``: id, type (relation, way or node), ref, of staged relations; ``present``: by type, the staged ids (id); ``way_nodes``: id, node.
    A relation is part of itself. Each pair of a root and a relation is met once, so that cycles end, and the pairs of a step are saved before the next one; members
    that aren't staged are listed as missing and lead nowhere. Members with a null type or reference are left out. What is missing is marked on members, before they are
    multiplied by roots, and a task gets about ``ROWS`` rows however large the input is. Only pairs of roots that still go on can be met again: a step of up to
    ``SENT`` pairs is sent to the links and to what is known of such roots, and the rest is let go.
    """
    there = {kind: df.select(F.lit(kind).alias("type"), F.col("id").alias("ref"), F.lit(True).alias("there")).distinct() for kind, df in present.items()}
    named = members.filter("type in ('relation', 'way', 'node') and ref is not null").select("id", "type", "ref").distinct()
    staged_ = there["relation"].union(there["way"]).union(there["node"])
    marked = saved(named.join(staged_, ["type", "ref"], "left").select("id", "type", "ref", F.col("there").isNull().alias("missing")))
    n_members = marked.count()
    links = marked.filter("type = 'relation'").select("id", "ref", "missing")
    front = saved(present["relation"].select("id").distinct().select(F.col("id").alias("root"), "id", F.lit(False).alias("missing")))
    n = reached = front.count()
    known = front
    # pairs that can be met again; that a root is part of itself is known without a join
    met = front.filter("root <> id").select("root", "id")
    while reached:
        pairs = front.select("root", "id")
        if reached <= SENT:
            step = links.join(F.broadcast(pairs), "id")
            met = saved(met.join(F.broadcast(pairs.select("root")), "root", "left_semi"))
        else:
            step = _dealt(pairs, max(reached, n_members), "id").join(_dealt(links, max(reached, n_members), "id"), "id")
        step = step.filter(F.col("root") != F.col("ref")).select("root", F.col("ref").alias("id"), "missing")
        front = saved(_dealt(step, n, "root", "id").distinct().join(_dealt(met, n, "root", "id"), ["root", "id"], "left_anti"))
        reached = front.count()
        if reached:
            few = front.coalesce(ceil(reached / ROWS))  # kept already; small steps are one task later on
            known, met, n = known.union(few), met.union(few.select("root", "id")), n + reached
    others = marked.filter("type <> 'relation'")
    direct = _dealt(known.drop("missing"), max(n, n_members), "id").join(_dealt(others, max(n, n_members), "id"), "id")
    direct = saved(direct.select("root", F.col("type").alias("kind"), F.col("ref").alias("id"), "missing"))
    n_direct = direct.count()
    of = lambda kind: direct.filter(F.col("kind") == kind).drop("kind")
    ways = saved(_dealt(of("way"), n_direct, "root", "id").distinct())
    of_ways = saved(way_nodes.filter("id is not null and node is not null").select("id", "node").distinct().join(
        there["node"].select(F.col("ref").alias("node"), "there"), "node", "left").select("id", "node", F.col("there").isNull().alias("missing")))
    each = ways.groupBy("id").agg(F.count("*").alias("a")).join(of_ways.groupBy("id").agg(F.count("*").alias("b")), "id")
    pairs = each.agg(F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0))).first()[0]
    through = _dealt(ways.select("root", "id"), max(n_direct, pairs), "id").join(_dealt(of_ways, max(n_direct, pairs), "id"), "id")
    through = through.select("root", F.col("node").alias("id"), "missing")
    nodes = _dealt(of("node").union(through), n_direct + pairs, "root", "id").distinct()
    as_kind = lambda df, kind: df.select("root", F.lit(kind).alias("kind"), "id", "missing")
    return as_kind(known, "relation").union(as_kind(ways, "way")).union(as_kind(nodes, "node"))
