"""Map ETL: indexes, hierarchies, ownership, merges of change files, tracks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.columns import haversine
from meridian.operators.saving import saved
from meridian.operators.ranking import newest


def token_index(objects: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Postings (token, id, occurrences) of lower-cased words of ASCII letters."""
    words = F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit("[a-z]+"), F.lit(0)))
    return objects.select(F.col(id_col), words.alias("token")).groupBy("token", id_col).agg(F.count("*").alias("occurrences"))


def hierarchy_paths(nodes: DataFrame, id_col: str, parent_col: str, deepest: int = 30) -> DataFrame:
    """id, depth and path from the root; nodes that reach no root within ``deepest`` steps are left out.

    Each step joins the frontier to its children, so cycles end with the depth limit. A frontier is kept before the
    next one is made of it, so no level is joined twice.
    """
    rows = nodes.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent"))
    front = rows.filter("parent is null").select("id", F.lit(0).alias("depth"), F.col("id").cast("string").alias("path"))
    out = front
    for depth in range(1, deepest + 1):
        up = front.select(F.col("id").alias("parent"), "path")
        front = saved(rows.join(up, "parent").select("id", F.lit(depth).alias("depth"), F.concat_ws("/", "path", F.col("id").cast("string")).alias("path")))
        if front.isEmpty():
            break
        out = out.union(front)
    return out


def preferred_parents(nodes: DataFrame, fallback: str = "en") -> DataFrame:
    """(id, parent) of nodes (id, title, lang, part_of): the row that ``part_of`` names in the node's own language, else in ``fallback``, else in the first language by
    name; ties go by id. A node without ``part_of`` is a root (null parent); one whose ``part_of`` is no title is left out, as it reaches no root. Null languages equal nothing."""
    up = nodes.select(F.col("title").alias("part_of"), F.col("lang").alias("up_lang"), F.col("id").alias("up"))
    other = lambda c: ~F.coalesce(c, F.lit(False))
    order = F.struct(other(F.col("up_lang") == F.col("lang")).alias("a"), other(F.col("up_lang") == fallback).alias("b"), F.coalesce("up_lang", F.lit("")).alias("c"), F.col("up").alias("d"))
    found = nodes.select("id", "lang", "part_of").join(up, "part_of").groupBy("id").agg(F.min(order).alias("m")).select("id", F.col("m.d").alias("parent"))
    return found.union(nodes.filter("part_of is null").select("id", F.lit(None).cast(nodes.schema["id"].dataType)))


def owned_keys(counts: DataFrame, share: float = 0.7) -> DataFrame:
    """(region, key, share) where a region has more than ``share`` of all of a key; counts: region, key, n."""
    total = counts.groupBy("key").agg(F.sum("n").alias("total"))
    return counts.join(total, "key").select("region", "key", (F.col("n") / F.col("total")).alias("share")).filter(F.col("share") > share)


def compacted(changes: DataFrame, key: Sequence[str], order: Sequence[str], deleted: str) -> DataFrame:
    """Last write of each key wins; keys whose last write is a deletion are gone."""
    return newest(changes, key, [F.desc(c) for c in order]).filter(~F.coalesce(F.col(deleted), F.lit(False)))


def track_speeds(points: DataFrame, least_ms: int = 500, least_speed: float = 0.1) -> DataFrame:
    """Per track: points, moving distance (m) and time (s), avg and max speed (km/h), largest gap (m).

    A point equal to its predecessor is skipped; the step to the next different point counts if it takes
    ``least_ms`` or more and is faster than ``least_speed``.
    """
    w = Window.partitionBy("track", "seg").orderBy("ord")
    same = (F.col("lat") == F.lag("lat").over(w)) & (F.col("lon") == F.lag("lon").over(w))
    moved = points.withColumn("_same", F.coalesce(same, F.lit(False))).filter("not _same")
    step = moved.withColumn("_d", haversine(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon"))).withColumn("_t", F.col("time_ms") - F.lag("time_ms").over(w))
    speed = F.when(F.col("_t") >= least_ms, F.col("_d") / (F.col("_t") / 1000.0))
    good = speed > least_speed
    return (
        step.groupBy("track").agg(
            F.count("*").alias("points"), F.coalesce(F.sum(F.when(good, F.col("_d"))), F.lit(0.0)).alias("distance"),
            F.coalesce(F.sum(F.when(good, F.col("_t"))), F.lit(0)).alias("time_ms"), F.max(F.when(good, speed * 3.6)).alias("max_speed"),
            F.max("_d").alias("largest_gap"),
        ).withColumn("avg_speed", F.try_divide(F.col("distance") * 3600, F.col("time_ms")))
    )


def lifetime_value(subscriptions: DataFrame, least: int = 5, steepest: float = 0.8) -> DataFrame:
    """Per sku: subscriptions, years factor and lifetime value, from observed retention with a geometric tail.

    ``subscriptions``: sku, periods, ended, months (of one period), price, retention (where nothing is
    observed). A subscription's last period counts in the total of that period only if it ended, and is never
    kept. The chain of rates stops at the first period with ``least`` or fewer in the total or kept. Rates
    after the sixth (periods over a month: third; over three: second) become their geometric mean. A sku's
    months, price and retention are the largest of its rows; skus ending in ``-%`` pay half the first period.
    """
    skus = subscriptions.groupBy("sku").agg(
        F.count("*").alias("subscriptions"), F.max("months").alias("months"), F.max("price").alias("price"), F.max("retention").alias("retention")
    )
    each = subscriptions.filter("periods > 0").withColumn("period", F.explode(F.sequence(F.lit(0), F.col("periods").cast("int") - 1)))
    stays = F.col("period") < F.col("periods") - 1
    counts = each.groupBy("sku", "period").agg(F.count_if(stays | F.col("ended")).alias("total"), F.count_if(stays).alias("kept"))
    known = F.min((F.col("total") > least) & (F.col("kept") > least)).over(Window.partitionBy("sku").orderBy("period"))
    trim = F.when(F.col("months") > 3, 2).when(F.col("months") > 1, 3).otherwise(6)
    rates = (
        counts.withColumn("known", known).filter("known").join(skus.select("sku", trim.alias("trim")), "sku")
        .groupBy("sku", F.least("period", "trim").alias("step")).agg(F.avg(F.ln(F.col("kept") / F.col("total"))).alias("log_rate"))
    )
    running = rates.withColumn("product", F.exp(F.sum("log_rate").over(Window.partitionBy("sku").orderBy("step"))))
    chain = running.groupBy("sku").agg(
        F.sum("product").alias("sum"), F.max_by("product", "step").alias("product"), F.exp(F.max_by("log_rate", "step")).alias("rate")
    )
    last = F.least(F.coalesce("rate", "retention"), F.lit(steepest))
    first = F.when(F.col("sku").endswith("-%"), 0.5).otherwise(1.0)
    factor = first + F.coalesce("sum", F.lit(0.0)) + F.coalesce("product", F.lit(1.0)) * last / (1 - last)
    return skus.join(chain, "sku", "left").select("sku", "subscriptions", factor.alias("factor"), (F.col("price") * factor).alias("value"))


def way_tags_to_nodes(ways: DataFrame, rules: Sequence[tuple[str, str | None, str, bool]]) -> DataFrame:
    """(way, tag, value, first, last): the stretch of node positions of a way that takes over a tag.

    ``ways``: way, nodes (array), tags (map). ``rules``: (tag, value or None for any, kind, open only).
    Kinds: ``all`` gives every node, ``start`` and ``end`` the first and last segment, ``center`` the node
    in the middle (the segment, of two nodes), and nothing for closed ways where the rule is for open ones
    only. Ways without nodes give nothing; those of one node have no segment.
    """
    n = F.size("nodes")
    stretch = lambda a, b: F.array(F.struct(a.cast("int").alias("first"), b.cast("int").alias("last")))
    none = F.array().cast("array<struct<first:int,last:int>>")
    is_closed = F.element_at("nodes", 1) == F.element_at("nodes", -1)

    def places(kind: str, open_only: bool) -> Column:
        if kind == "all":
            return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("first"), i.alias("last")))
        if kind == "start":
            return F.when(n > 1, stretch(F.lit(0), F.lit(1))).otherwise(none)
        if kind == "end":
            return F.when(n > 1, stretch(n - 2, n - 1)).otherwise(none)
        middle = stretch(F.floor(n / 2), F.floor(n / 2))
        return F.when(n == 2, stretch(F.lit(0), F.lit(1))).when(is_closed, none if open_only else middle).otherwise(middle)

    def taken(tag: str, value: str | None, kind: str, open_only: bool) -> Column:
        own = F.col("tags")[tag]
        found = F.transform(places(kind, open_only), lambda s: F.struct(F.lit(tag).alias("tag"), own.alias("value"), s["first"].alias("first"), s["last"].alias("last")))
        return F.when(own.isNotNull() if value is None else own == value, found)

    every = F.flatten(F.array_compact(F.array(*(taken(*rule) for rule in rules))))
    return ways.filter(n > 0).select("way", F.explode(every).alias("t")).select("way", "t.*").distinct()
