"""Windows, top-k, de-duplication and bucketed ranking."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.saving import saved

#: Vectors of one block, about.
BLOCK = 4096


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", rank).filter("_n = 1").drop("_n")


def category_quota(df: DataFrame, category: str, order: Sequence[Column], cap: int, budget: int) -> DataFrame:
    """At most ``cap`` rows of each category and ``budget`` in all, categories in their order.

    Rows over a category's cap go first, so the shared budget ranks at most cap rows per category.
    """
    own = Window.partitionBy(category).orderBy(*order)
    capped = df.withColumn("_n", F.row_number().over(own)).filter(F.col("_n") <= cap)
    return capped.orderBy(category, "_n").limit(budget).drop("_n")


def dynamic_sort(allowed: dict[str, Column], asked: Sequence[tuple[str, str]], fallback: str) -> list[Column]:
    """Sort columns from (name, direction): unknown names are left out, the first use of a name wins, the default is descending, ``fallback`` ends the list."""
    out, seen = [], set()
    for name, direction in [*asked, (fallback, "asc")]:
        if name in allowed and name not in seen:
            seen.add(name)
            out.append(allowed[name].asc_nulls_last() if direction.lower() == "asc" else allowed[name].desc_nulls_last())
    return out


def merged_buckets(histogram: Sequence[tuple[int, int]], most: int) -> list[tuple[int, int, int]]:
    """(least, largest, users) of buckets by decreasing count, from (count, users).

    While there are more than ``most`` buckets, the adjacent pair with the fewest users is merged; the
    first such pair wins. The histogram has one row per different count, after aggregation.
    """
    buckets = [(c, c, u) for c, u in sorted(histogram, reverse=True)]
    while len(buckets) > max(1, most):
        k = min(range(len(buckets) - 1), key=lambda i: buckets[i][2] + buckets[i + 1][2])
        (_, hi, u), (lo, _, v) = buckets[k], buckets[k + 1]
        buckets[k : k + 2] = [(lo, hi, u + v)]
    return buckets


def bucket_ranks(counts: DataFrame, user: str, count: str, buckets: Sequence[tuple[int, int, int]]) -> DataFrame:
    """user, count and rank (1 for the highest bucket, which has no upper end) by range join with a bounded bucket table."""
    table = counts.sparkSession.createDataFrame([(k + 1, lo, hi if k else None) for k, (lo, hi, _) in enumerate(buckets)], "rank int, least long, most long")
    return counts.join(F.broadcast(table), (F.col(count) >= F.col("least")) & (F.col("most").isNull() | (F.col(count) <= F.col("most")))).select(user, count, "rank")


def best_duplicates(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """For each item its most similar duplicate among items with a greater (score, id).

    ``pairs``: id, dup, similarity; ``scores``: id, score.
    """
    other = scores.select(F.col("id").alias("dup"), F.col("score").alias("dup_score"))
    better = pairs.join(scores, "id").join(other, "dup").filter(F.struct("dup_score", "dup") > F.struct("score", "id"))
    return newest(better, ["id"], [F.desc("similarity"), F.desc("dup_score"), F.desc("dup")]).select("id", "dup", "similarity")


def rank_percentiles(df: DataFrame, group: str, value: str, percents: Sequence[int]) -> DataFrame:
    """group, p and the value at rank p (n + 1) / 100 of each group, linear between neighbours, clamped to the ends; null without values.

    Equal values are counted first. The counts are range-partitioned by group and value and saved with their range; running counts
    come in two steps, over the sums of the ranges, then within the ranges that hold a wanted rank. So a group is no one task's work.
    """
    ranged = df.filter(F.col(value).isNotNull()).groupBy(F.col(group).alias("h"), F.col(value).alias("x")).agg(F.count("*").alias("n"))
    ranged = saved(ranged.repartitionByRange("h", "x").select("h", "x", "n", F.spark_partition_id().alias("part")))
    sums = ranged.groupBy("h", "part").agg(F.sum("n").alias("m"))  # one row a range, and one more for each group
    before = F.sum("m").over(Window.partitionBy("h").orderBy("part")) - F.col("m")
    sums = sums.select("h", "part", "m", before.alias("before"))
    sizes = df.groupBy(F.col(group).alias("g")).agg(F.count(value).alias("size"))
    wanted = sizes.select("g", "size", F.explode(F.array(*(F.lit(p) for p in percents))).alias("p")).withColumn("pos", F.col("p") * (F.col("size") + 1) / 100.0)
    low = F.greatest(F.lit(1), F.least(F.col("size"), F.floor("pos"))).cast("long")
    high = F.when((F.col("pos") < 1) | (F.col("pos") >= F.col("size")), F.col("low")).otherwise(F.col("low") + 1)
    wanted = wanted.withColumn("low", low).withColumn("high", high)
    same = F.col("g").eqNullSafe(F.col("h"))
    ends = wanted.select("g", "p", "size", "pos", "low", "high", F.posexplode(F.array("low", "high")).alias("end", "rank"))
    held = ends.join(F.broadcast(sums), same & (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("m")), "left").select("g", "p", "size", "pos", "low", "high", "end", "rank", "part", "before")
    held = saved(held)  # two rows for each percentile of a group
    parts = held.filter("part is not null").select(F.col("g").alias("k"), F.col("part").alias("q"), "before").distinct()
    inside = ranged.join(F.broadcast(parts), F.col("h").eqNullSafe(F.col("k")) & (F.col("part") == F.col("q")))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("h", "part").orderBy("x"))
    runs = inside.select("h", F.col("part").alias("q"), "x", "n", upto.alias("upto"))
    at = runs.join(F.broadcast(held.drop("before")), same & (F.col("q") == F.col("part")) & (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
    found = at.unionByName(held.filter("part is null").drop("before"), allowMissingColumns=True)
    end = lambda k: F.max(F.when(F.col("end") == k, F.col("x")))
    out = found.groupBy("g", "p", "size", "pos", "low", "high").agg(end(0).alias("a"), end(1).alias("b"))
    between = F.col("a") + (F.col("pos") - F.floor("pos")) * (F.col("b") - F.col("a"))
    return out.select(F.col("g").alias(group), "p", F.when(F.col("low") == F.col("high"), F.col("a")).otherwise(between).alias(value))


def _nearest(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> list[pa.RecordBatch]:
    order = np.argsort(x_ids, kind="stable")
    x, x_ids, out = x[order], x_ids[order], []
    for i in range(0, len(q), 256):
        ids = q_ids[i : i + 256]
        scores = np.floor(np.clip(q[i : i + 256] @ x.T, 0.0, 1.0) * 1e4 + 0.5) / 1e4
        scores[ids[:, None] == x_ids[None, :]] = -1.0
        for _ in range(min(k, len(x))):
            at = scores.argmax(1)
            best = scores[np.arange(len(ids)), at]
            real = best >= 0
            out.append(pa.record_batch([ids[real], x_ids[at[real]], best[real]], ["id", "other", "similarity"]))
            scores[np.arange(len(ids)), at] = -1.0
    return out


def nearest_vectors(vectors: DataFrame, key: str, group: str, vector: str, k: int, block: int = BLOCK) -> DataFrame:
    """id, other, similarity and rank of the ``k`` rows of the same group with the greatest cosine (0 to 1, four digits); ties go to the smaller key.

    A group's rows are dealt by hash into blocks of about ``block`` rows; each unordered pair of blocks is
    one task's work, and the best of all pairs are merged by a ranked window. Vectors that are null, or hold
    null or non-finite components, take no part; the cosine with a zero vector is 0.
    """
    fine = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.filter(F.col(key).isNotNull() & F.col(group).isNotNull() & fine).select(F.col(key).cast("long").alias("id"), F.col(group).alias("g"), F.col(vector).cast("array<double>").alias("v"))
    large = rows.groupBy("g").agg(F.count("*").alias("_n")).filter(F.col("_n") > block).select("g", F.ceil(F.col("_n") / block).cast("int").alias("blocks"))
    dealt = rows.join(F.broadcast(large), "g", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = dealt.select("g", F.least("own", "met").alias("lo"), F.greatest("own", "met").alias("hi"), "own", "id", "v")

    def meet(table: pa.Table) -> pa.Table:
        ids, own = table.column("id").to_numpy(), table.column("own").to_numpy()
        v = table.column("v").combine_chunks()
        sizes = np.diff(v.offsets.to_numpy())
        x = np.zeros((len(ids), max(1, int(sizes.max(initial=0)))))
        x[np.repeat(np.arange(len(ids)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = v.flatten().to_numpy(zero_copy_only=False)
        norm = np.sqrt((x * x).sum(1, keepdims=True))
        x /= np.where(norm > 0, norm, 1.0)
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        out = []
        for a, b in {(lo, hi), (hi, lo)}:
            out += _nearest(x[own == a], ids[own == a], x[own == b], ids[own == b], k)
        return pa.Table.from_batches(out, pa.schema([("id", pa.int64()), ("other", pa.int64()), ("similarity", pa.float64())]))

    found = pairs.groupBy("g", "lo", "hi").applyInArrow(meet, "id long, other long, similarity double")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "other"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)
