"""Operators on map objects: ways and nodes, tag rules, relations, roads, border points, regions.

Unless said otherwise: null keys meet nothing, repeated rows count as rows of their own, empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.nearness import bundled, crowded_join, unbundled
from meridian.operators.polygons import doubled
from meridian.operators.saving import saved


def with_children(parents: DataFrame, children: DataFrame, key: str, order: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """``parents`` with an array of their children's ``fields`` in ``order``; an empty array for parents without any."""
    row = F.struct(*(F.col(c).alias(f"_{k}") for k, c in enumerate(order)), F.struct(*fields).alias("row"))
    grouped = children.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(row)), lambda x: x["row"]).alias(name))
    joined = parents.join(grouped, key, "left")
    return joined.withColumn(name, F.coalesce(name, F.array().cast(grouped.schema[name].dataType)))


def assigned_by_tags(items: DataFrame, objects: DataFrame) -> DataFrame:
    """(object, item): map objects that carry one of an item's tag values; of several items the last assignment wins.

    ``items``: item, order, keys (array of (tag, value) from the first tried to the last); ``objects``: object, tag, value.
    """
    tried = items.select("item", "order", F.posexplode("keys").alias("place", "k")).select("item", "order", "place", F.col("k.tag").alias("tag"), F.col("k.value").alias("value"))
    found = tried.join(objects, ["tag", "value"])
    return found.groupBy("object").agg(F.max_by("item", F.struct("order", "place", "item")).alias("item"))


def within_type_radius(points: DataFrame, places: DataFrame, radii: Mapping[str, float]) -> DataFrame:
    """(point_id, place_id, kind, distance) of places within the radius of their kind, on the plane.

    Points: point_id, x, y; places: place_id, kind, px, py. The cells are as large as the largest radius; a place is sent to its own
    and the eight around it. Points of one place, and places of one kind there, are compared as one. Null coordinates and kinds without a radius meet nothing.
    """
    cell = max(radii.values())
    radius = F.create_map(*(F.lit(x) for pair in radii.items() for x in pair))[F.col("kind")]
    steps = F.explode(F.array(*map(F.lit, (-1, 0, 1))))
    sent = bundled(places.select("place_id", "kind", "px", "py"), ["px", "py", "kind"], "_places").withColumn("_cx", steps).withColumn("_cy", steps)
    sent = sent.withColumn("_cx", F.floor(F.col("px") / cell) + F.col("_cx")).withColumn("_cy", F.floor(F.col("py") / cell) + F.col("_cy")).withColumn("_r", radius)
    own = bundled(points.select("point_id", "x", "y"), ["x", "y"], "_points")
    own = own.withColumn("_cx", F.floor(F.col("x") / cell)).withColumn("_cy", F.floor(F.col("y") / cell))
    distance = F.sqrt(F.pow(F.col("x") - F.col("px"), 2) + F.pow(F.col("y") - F.col("py"), 2))
    met = crowded_join(own, sent, ["_cx", "_cy"], weights=[F.size("_points"), F.size("_places")])
    met = met.withColumn("distance", distance).filter(F.col("distance") < F.col("_r")).select("_points", "_places", "kind", "distance")
    return unbundled(met, {"_points": ["point_id"], "_places": ["place_id"]}).select("point_id", "place_id", "kind", "distance")


def transformed_tags(tags: Column, rules: Sequence[tuple[Mapping[str, str], Mapping[str, str], Sequence[str]]]) -> Column:
    """Tags after rules (if, to, drop) in their order: where all of ``if`` hold, ``to`` is set and ``drop`` goes. Null values of ``if``
    tags never hold; ``*`` holds for any value; ``$tag`` in ``to`` is that tag's value before the rule."""
    out = tags
    for conditions, to, drop in rules:
        holds = F.lit(True)
        for tag, value in conditions.items():
            holds &= out[tag].isNotNull() if value == "*" else F.coalesce(out[tag] == value, F.lit(False))
        new = {tag: out[value[1:]] if value.startswith("$") else F.lit(value) for tag, value in to.items()}
        gone = [*drop, *to]
        rest = F.map_filter(out, lambda k, v: ~k.isin(*gone))  # noqa: B023
        changed = F.map_concat(rest, F.map_filter(F.create_map(*(x for t, v in new.items() for x in (F.lit(t), v))), lambda k, v: v.isNotNull())) if new else rest
        out = F.when(holds, changed).otherwise(out)
    return out


def propagated(relations: DataFrame, sort_rules: Sequence[Sequence[str]], tags: Sequence[str]) -> DataFrame:
    """(member, groups): what members take over from their relations, one group of tags per relation.

    ``relations``: id, members (array), tags (map). A group holds the ``tags`` that its relation has; groups are in the order of a key
    with one letter per rule: the place of the relation's value in the rule's list, or the letter after the list if unknown. Rules are lists of a tag and
    its values. Ties go by relation id; relations without any of the tags give nothing.
    """
    letters = []
    for tag, *values in sort_rules:
        place = F.array_position(F.array(*map(F.lit, values)), F.coalesce(F.col("tags")[tag], F.lit(""))).cast("int")
        letters.append(F.char(F.when(place == 0, len(values)).otherwise(place - 1) + 97))
    group = F.map_filter("tags", lambda k, v: k.isin(*tags))
    text = F.array_join(F.transform(F.array_sort(F.map_entries(group)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    named = relations.filter(F.size(group) > 0).select("members", F.concat(*letters).alias("key"), "id", text.alias("group"))
    each = named.select("members", F.struct("key", "id", "group").alias("g")).select(F.explode("members").alias("member"), "g")
    return each.groupBy("member").agg(F.array_join(F.transform(F.sort_array(F.collect_list("g")), lambda g: g["group"]), ";").alias("groups"))


def border_points(taken: DataFrame) -> DataFrame:
    """Of (node, way, satisfied) rows, the nodes that lie between ways that satisfy a rule and ways that don't."""
    return taken.groupBy("node").agg(F.bool_or("satisfied").alias("yes"), F.bool_and("satisfied").alias("all")).filter("yes and not all").select("node")


def merged_roads(roads: DataFrame) -> DataFrame:
    """(ref, chain, nodes): roads of one ref joined end to start wherever exactly one of them ends and one starts at a node.

    ``roads``: id (long), ref, nodes (array). A chain has the smallest id of its roads; a chain that closes begins with that road, and a road that ends
    where it starts isn't joined to itself. Roads without a ref, or with fewer than two nodes, are left out; of rows of one id in a ref the one with the smallest
    list counts. Followers are found by joins, and a chain's order by following the followers of followers, so no ref is one task's work. Roads that join
    no other, most of them as a rule, take no part in that.
    """
    usable = roads.filter("ref is not null and id is not null and size(nodes) > 1").groupBy("ref", "id").agg(F.min("nodes").alias("nodes"))
    end = lambda node, dart, next: F.struct(node.alias("node"), dart.alias("dart"), next.alias("next"))
    none = F.lit(None).cast(usable.schema["id"].dataType)
    ends = usable.select("ref", F.explode(F.array(end(F.element_at("nodes", -1), F.col("id"), none), end(F.get("nodes", F.lit(0)), none, F.col("id")))).alias("e"))
    # one group for each node: the roads that end there, and those that start there
    at = ends.select("ref", "e.*").filter("node is not null").groupBy("ref", "node").agg(*(f(c).alias(a) for c in ("dart", "next") for f, a in ((F.count, f"{c}s"), (F.min, c))))
    next_ = saved(at.filter("darts = 1 and nexts = 1 and dart <> next").select("ref", "dart", "next"))
    joined = saved(next_.select("ref", "dart").union(next_.select("ref", "next")).distinct())
    most = joined.groupBy("ref").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    rounds = max(1, ceil(log2(most)))
    steps = F.lit(1).cast("long").alias("steps")
    follows = saved(joined.join(next_, ["ref", "dart"], "left"))
    ahead = doubled(follows.select("ref", "dart", "next", F.col("dart").alias("least"), steps), ["ref"], rounds)
    before = follows.filter("next is not null").select("ref", F.col("next").alias("dart"), F.col("dart").alias("next"))
    before = follows.select("ref", "dart").join(before, ["ref", "dart"], "left")
    behind = doubled(before.select("ref", "dart", "next", F.col("dart").alias("least"), steps), ["ref"], rounds).select("ref", "dart", F.col("least").alias("behind"))
    chains = saved(ahead.join(behind, ["ref", "dart"]).select("ref", "dart", F.least("least", "behind").alias("chain"), F.col("next").isNotNull().alias("closed")))
    opened = chains.join(follows, ["ref", "dart"]).select("ref", "dart", F.when(~(F.col("closed") & (F.col("next") == F.col("chain"))), F.col("next")).alias("next"), F.col("dart").alias("least"), steps)
    placed = doubled(opened, ["ref"], rounds).select("ref", "dart", "steps").join(chains, ["ref", "dart"])
    # places are known by one join, whether there are any or not
    each = saved(usable.join(placed.select("ref", F.col("dart").alias("id"), "chain", "steps"), ["ref", "id"], "left"))
    alone = each.filter("chain is null").select("ref", F.col("id").alias("chain"), "nodes")
    pieces = each.filter("chain is not null").groupBy("ref", "chain").agg(F.array_sort(F.collect_list(F.struct((-F.col("steps")).alias("at"), "nodes"))).alias("p"))
    whole = F.flatten(F.transform("p", lambda x, i: F.when(i == 0, x["nodes"]).otherwise(F.slice(x["nodes"], F.lit(2), F.size(x["nodes"]) - 1))))
    return alone.union(pieces.select("ref", "chain", whole.alias("nodes")))


def trimmed_run(roads: Sequence[int], inside: set[int]) -> list[int]:
    """The first unbroken run of a road list whose members are all in ``inside``; empty where none is."""
    out: list[int] = []
    for road in roads:
        if road in inside:
            out.append(road)
        elif out:
            break
    return out


def merged_border_points(points: DataFrame) -> DataFrame:
    """(x, y, kept, merged) of positions that several border points share.

    ``points``: id, cluster, x, y. Two points merge into the smaller id; of more, the point of the cluster that is most often there is
    kept, ties by id.
    """
    per = points.withColumn("_m", F.count("*").over(Window.partitionBy("x", "y", "cluster")))
    grouped = per.groupBy("x", "y").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.max_by("id", F.struct("_m", -F.col("id"))).alias("common"))
    return grouped.filter("n > 1").select("x", "y", F.when(F.col("n") == 2, F.col("least")).otherwise(F.col("common")).alias("kept"), (F.col("n") - 1).alias("merged"))


def reached(edges: DataFrame, sources: DataFrame, steps: int) -> DataFrame:
    """(node, distance) of nodes that sources reach over edges (a, b) in at most ``steps`` steps; each node is expanded once."""
    out = front = saved(sources.select("node").distinct().withColumn("distance", F.lit(0)))
    for k in range(1, steps + 1):
        near = front.join(edges, F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct()
        front = saved(near.join(out, "node", "left_anti").withColumn("distance", F.lit(k)))
        out = out.union(front)
    return out


def owners(counts: DataFrame, parents: DataFrame, share: float = 0.7) -> DataFrame:
    """(region, key, share): from the deepest regions upward, a region owns a key if more than ``share`` of the whole count lies in it and
    no region below it owns the key.

    ``counts``: region, key, n of the leaves; ``parents``: region, ancestor, depth for each region and each of its ancestors, itself
    included, with the ancestor's depth. The tree of regions is small and broadcast; counts are summed before anything is compared.
    """
    base = counts.groupBy("region", "key").agg(F.sum("n").alias("n"))
    total = base.groupBy("key").agg(F.sum("n").alias("total"))
    up = base.join(F.broadcast(parents), "region").groupBy(F.col("ancestor").alias("region"), "key", "depth").agg(F.sum("n").alias("n"))
    enough = up.join(total, "key").withColumn("share", F.col("n") / F.col("total")).filter(F.col("share") > share)
    below = enough.select("key", F.col("region").alias("low")).join(F.broadcast(parents.select(F.col("region").alias("low"), F.col("ancestor").alias("region")).filter("low <> region")), "low")
    return enough.join(below.select("key", "region").distinct(), ["key", "region"], "left_anti").select("region", "key", "share")


def enabled_above(ranked: DataFrame, enabled: DataFrame) -> DataFrame:
    """(region, key) after enabling everything that is ranked above an enabled key, in any region, until nothing changes.

    ``ranked``: region, key, rank (1 is highest); ``enabled``: key. A round enables, in every region, the keys down to its lowest
    enabled one; rounds end when no key is new.
    """
    keys = enabled.select("key").distinct()
    known = -1
    while True:
        lowest = ranked.join(keys, "key", "left_semi").groupBy("region").agg(F.max("rank").alias("lowest"))
        above = ranked.join(lowest, "region").filter(F.col("rank") <= F.col("lowest"))
        keys = above.select("key").union(keys).distinct()
        keys = saved(keys)
        n = keys.count()
        if n == known:
            return above.select("region", "key")
        known = n
