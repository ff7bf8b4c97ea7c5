"""Nearest segments and nearest points by grid cells, and joins that deal crowded cells over many tasks.

Coordinates are on the plane. Null coordinates meet nothing, repeated rows count as rows of their own, and empty tables give empty
results. Rows travel as structs, so that no column of the input can clash with a helper's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, MapType

from meridian.operators.saving import saved

#: A key is dealt over a part for each such share of a side's rows; there are fewer keys with more than one part than the share's inverse.
CROWDED = 0.002
#: Rows of a key that are never dealt.
FEW = 5_000
#: Parts that a crowded key's rows are dealt to, at most.
DEALT = 32
#: Tasks of a join for each core, at least, so that cores end at about the same time.
SHARES = 8
#: Rows of one shape that travel in one list, about.
LISTED = 4_096


def crowded_keys(df: DataFrame, keys: Sequence[str], share: float = CROWDED, dealt: int = DEALT, few: int = FEW, weight: Column | None = None) -> DataFrame:
    """(keys, _parts): the keys with more than ``share`` of the rows and more than ``few``, and the parts to deal them to; fewer than 1 / share.
    A row counts ``weight`` times."""
    counts = df.groupBy(*keys).agg(F.sum(F.lit(1) if weight is None else weight).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))  # one row
    parts = F.least(F.lit(dealt), F.ceil(F.col("_n") / F.greatest(F.lit(few), share * F.col("_total")))).cast("int")
    return counts.join(F.broadcast(total)).select(*keys, parts.alias("_parts")).filter("_parts > 1")


def _content(df: DataFrame) -> Column:
    """A hash by content, so that a task that runs again deals its rows alike."""
    return F.xxhash64(*(f.name for f in df.schema if not isinstance(f.dataType, MapType)))


def crowded_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], share: float = CROWDED, dealt: int = DEALT, few: int = FEW, weights: Sequence[Column | None] = (None, None)
) -> DataFrame:
    """Inner join on ``keys``: rows of a key that is crowded on one side are dealt over parts, as many as it has rows for, and the other side's rows of
    such keys are sent to each part. Of two crowded sides the one with more parts is dealt. No pair is lost or made twice.

    Sides are merged, never broadcast: Spark judges a side by its files, but rows that are sent to several cells or parts are many times as large. For
    the same reason they are shuffled to a number of tasks that Spark doesn't reduce: it goes by the bytes that come in, not by the pairs that are made of them.
    """
    keys = list(keys)
    sides = [crowded_keys(df, keys, share, dealt, few, w).withColumn("_side", F.lit(k)) for k, (df, w) in enumerate(zip((left, right), weights))]
    # fewer than 2 / share rows: small whatever the input
    hot = F.broadcast(sides[0].union(sides[1]).groupBy(*keys).agg(F.max(F.struct("_parts", "_side")).alias("_hot")))
    every = F.sequence(F.lit(0), F.col("_hot._parts") - 1)

    def side(df: DataFrame, k: int) -> DataFrame:
        own = F.array(F.pmod(_content(df), F.col("_hot._parts")).cast("int"))
        part = F.when(F.col("_hot").isNull(), F.array(F.lit(0))).when(F.col("_hot._side") == k, own).otherwise(every)
        return df.join(hot, keys, "left").withColumn("_part", F.explode(part)).drop("_hot")

    spark = left.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), SHARES * spark.sparkContext.defaultParallelism)
    both = [side(df, k).repartition(tasks, *keys, "_part") for k, df in enumerate((left, right))]
    return both[0].join(both[1].hint("merge"), [*keys, "_part"]).drop("_part")


def bundled(df: DataFrame, shape: Sequence[str], name: str) -> DataFrame:
    """(shape, name): rows that are alike in the ``shape`` columns as arrays, about ``LISTED`` in each; rows with a null there are left out. An array holds
    what its rows have beside the shape; floating numbers stay with the row, as 0.0 and -0.0 are alike.

    What depends on the shape alone is then found once for a list; ``unbundled`` gives the rows back. Rows that are alike in all columns share a list.
    """
    df = df.dropna(subset=list(shape))
    many = df.groupBy(*shape).agg(F.count("*").alias("_n")).filter(F.col("_n") > LISTED)  # fewer than rows / LISTED
    lists = F.coalesce(F.pmod(_content(df), F.ceil(F.col("_n") / LISTED)), F.lit(0))
    dealt = df.join(F.broadcast(many), list(shape), "left").withColumn("_list", lists)
    own = [f.name for f in df.schema if f.name not in shape or isinstance(f.dataType, DoubleType | FloatType)]
    return dealt.groupBy(*shape, "_list").agg(F.collect_list(F.struct(*(own or df.columns))).alias(name)).drop("_list")


def unbundled(df: DataFrame, lists: dict[str, Sequence[str]]) -> DataFrame:
    """The rows of the arrays in ``lists`` (with their rows' columns), each with each, followed by the other columns that no row has."""
    own = {n: df.schema[n].dataType.elementType.names for n in lists}
    rows = [F.col(f"{n}.{c}" if c in own[n] else c) for n, columns in lists.items() for c in columns]
    rest = [c for c in df.columns if c not in lists and not any(c in columns for columns in lists.values())]
    for n in lists:
        df = df.withColumn(n, F.explode(n))
    return df.select(*rows, *rest)


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size)


def projected(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """(x, y, t, distance): the point of the segment a-b that is nearest to p, its share t of the way from a (0 for a segment without length)."""
    dx, dy = bx - ax, by - ay
    t = F.coalesce(F.try_divide((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    x, y = ax + t * dx, ay + t * dy
    return F.struct(x.alias("x"), y.alias("y"), t.alias("t"), F.sqrt((px - x) * (px - x) + (py - y) * (py - y)).alias("distance"))


def nearest_segments(points: DataFrame, segments: DataFrame, cell: float, radius: float) -> DataFrame:
    """(point_id, segment_id, x, y, t, distance): of each point (point_id, px, py) the nearest segment (segment_id, ax, ay, bx, by) within ``radius``
    (included); ties go to the smaller segment id. Points without one are left out.

    Points of one place are one point until the end, and of equal segments the one with the smallest id counts. A segment is sent to the cells that
    come within the radius of it, not to all cells of its box; a point has one cell. Before the exact distance a bound by the segment's box is taken.
    Cells with many points or segments are dealt over tasks.
    """
    number = lambda df, names: [F.col(n).cast("double").alias(n) for n in names]
    points = points.select("point_id", *number(points, ("px", "py"))).filter("px is not null and py is not null")
    ends = ("ax", "ay", "bx", "by")
    segments = segments.select("segment_id", *number(segments, ends)).filter(" and ".join(f"{n} is not null" for n in ends))
    segments = segments.groupBy(*ends).agg(F.min("segment_id").alias("segment_id"))
    low = lambda a, b: _cell(F.least(a, b) - radius, cell)
    high = lambda a, b: _cell(F.greatest(a, b) + radius, cell)
    sent = segments.withColumn("cx", F.explode(F.sequence(low("ax", "bx"), high("ax", "bx")))).withColumn("cy", F.explode(F.sequence(low("ay", "by"), high("ay", "by"))))
    middle = projected((F.col("cx") + 0.5) * cell, (F.col("cy") + 0.5) * cell, *(F.col(n) for n in ends))
    sent = sent.filter(middle["distance"] <= radius + cell * 0.7072)
    own = points.select("px", "py").distinct().withColumn("cx", _cell(F.col("px"), cell)).withColumn("cy", _cell(F.col("py"), cell))
    outside = lambda p, a, b: F.greatest(F.least(a, b) - F.col(p), F.col(p) - F.greatest(a, b))
    near = crowded_join(own, sent, ["cx", "cy"]).filter((outside("px", "ax", "bx") <= radius) & (outside("py", "ay", "by") <= radius))
    near = near.withColumn("at", projected(F.col("px"), F.col("py"), *(F.col(n) for n in ends))).filter(F.col("at.distance") <= radius)
    least = near.groupBy("px", "py").agg(F.min(F.struct("at.distance", "segment_id", "at")).alias("m"))
    best = crowded_join(points, least, ["px", "py"]).groupBy("point_id").agg(F.min("m").alias("m"))
    return best.select("point_id", "m.segment_id", "m.at.x", "m.at.y", "m.at.t", "m.distance")


def nearest_k(left: DataFrame, right: DataFrame, k: int, cell: float) -> DataFrame:
    """(left_id, rank, right_id, distance): the ``k`` rows of ``right`` (right_id, rx, ry) that are nearest to each row of ``left`` (left_id, lx, ly), all
    if there are fewer; ties go to the smaller id. There is no radius.

    Points of one place are one point until the end, and of the rows of one place only the ``k`` with the smallest ids can count. In each round a point
    meets the rows in the nine cells around it. If its k-th distance is not larger than a cell, nothing outside can be nearer, and
    the point is finished; the others go on with cells of twice the size, until nine cells hold everything. Only points in sparse places meet large
    cells; crowded cells are dealt over tasks.
    """
    left = left.select("left_id", F.col("lx").cast("double").alias("lx"), F.col("ly").cast("double").alias("ly")).filter("lx is not null and ly is not null")
    right = right.select("right_id", F.col("rx").cast("double").alias("rx"), F.col("ry").cast("double").alias("ry")).filter("rx is not null and ry is not null")
    place = Window.partitionBy("rx", "ry").orderBy("right_id")
    right = saved(right.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).drop("rank"))
    edges = lambda df, x, y: df.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    rows, left = left, saved(left.select("lx", "ly").distinct())
    a, b = edges(left, "lx", "ly"), edges(right, "rx", "ry")
    steps = F.explode(F.array(*map(F.lit, (-1, 0, 1))))
    out, size = None, float(cell)
    if a[0] is None or b[0] is None:
        size, extent = None, 0.0
    else:
        extent = max(max(a[1], b[1]) - min(a[0], b[0]), max(a[3], b[3]) - min(a[2], b[2]))
    while size is not None:
        last = size >= extent
        wide = left.withColumn("dx", steps).withColumn("dy", steps)
        wide = wide.withColumn("cx", _cell(F.col("lx"), size) + F.col("dx")).withColumn("cy", _cell(F.col("ly"), size) + F.col("dy")).drop("dx", "dy")
        own = right.withColumn("cx", _cell(F.col("rx"), size)).withColumn("cy", _cell(F.col("ry"), size))
        distance = F.sqrt((F.col("lx") - F.col("rx")) * (F.col("lx") - F.col("rx")) + (F.col("ly") - F.col("ry")) * (F.col("ly") - F.col("ry")))
        met = crowded_join(wide, own, ["cx", "cy"]).select("lx", "ly", "right_id", distance.alias("distance"))
        ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("lx", "ly").orderBy("distance", "right_id"))).filter(F.col("rank") <= k)
        ranked = saved(ranked)
        done = ranked
        if not last:
            full = ranked.filter((F.col("rank") == k) & (F.col("distance") <= size)).select("lx", "ly")
            done = ranked.join(full, ["lx", "ly"], "left_semi")
            left = saved(left.join(full, ["lx", "ly"], "left_anti"))
        part = done.select("lx", "ly", F.col("rank").cast("int").alias("rank"), "right_id", "distance")
        out = part if out is None else out.union(part)
        if last or left.isEmpty():
            break
        size *= 2
    if out is None:
        return rows.limit(0).join(right.limit(0)).select("left_id", F.lit(0).alias("rank"), "right_id", F.lit(0.0).alias("distance"))
    return crowded_join(rows, out, ["lx", "ly"]).select("left_id", "rank", "right_id", "distance")
