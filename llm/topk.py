"""Exact top-k inner products with multi-resolution segment statistics.

Vectors become integers. For queries against candidates, the means and deviations of 1, 4 and 16
segments of each vector bound the squared distance from below (for segments of length l:
``l * ((mean - mean')^2 + (dev - dev')^2)``), and so, with the norms, the inner product from above. Bounds
are taken coarse to fine; a candidate is dropped as soon as its bound is under the query's k-th best
exact score so far, and only survivors of the finest level get exact scores.

The stated query set meets all rows in blocks: queries and candidates are dealt by hash into groups of
bounded size, and each pair of groups is one task's work. The best k of each group pair are merged by a
ranked window per query.

Defined cases: vectors that are null, or hold null or non-finite components, take no part, nor do rows
without an id; shorter vectors count as filled up with zeros; rows that share an id are rows of their own:
each is a candidate, for the others, too, and each is a query if its id says so; ties go to the smaller id,
then to the smaller row; with fewer candidates than k all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.tables import saved

K = 5
SCALE = 256
EVERY = 50
#: Candidates and queries of one group, about.
CANDIDATES = 8192
QUERIES = 2048
LEVELS = (1, 4, 16)


def _statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products are the sums over segments of l * (mean mean' + dev dev')."""
    parts = x.reshape(len(x), segments, -1)
    return np.concatenate([parts.mean(2), parts.std(2)], 1) * math.sqrt(parts.shape[2])


def best(q: np.ndarray, q_rows: np.ndarray, x: np.ndarray, x_rows: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of each query's k best other rows, by decreasing score, then id, then row."""
    width = -(-q.shape[1] // LEVELS[-1]) * LEVELS[-1] or LEVELS[-1]
    qs, xs = (np.pad(a, ((0, 0), (0, width - a.shape[1]))) for a in (q, x))
    first = _statistics(qs, LEVELS[0]) @ _statistics(xs, LEVELS[0]).T
    first[q_rows[:, None] == x_rows[None, :]] = -np.inf
    m = min(k, len(x))
    seeds = np.argpartition(-first, m - 1, 1)[:, :m]
    scores = np.einsum("ijd,id->ij", x[seeds], q)
    scores[np.isinf(np.take_along_axis(first, seeds, 1))] = -np.inf
    least = scores.min(1) if m == k else np.full(len(q), -np.inf)
    slack = 1e-6 * (1 + np.abs(first[np.isfinite(first)]).max(initial=0))
    rows, cols = np.nonzero((first >= least[:, None] - slack) & np.isfinite(first))
    for level in LEVELS[1:]:
        a, b = _statistics(qs, level), _statistics(xs, level)
        keep = np.concatenate([np.einsum("ij,ij->i", a[rows[s : s + 65536]], b[cols[s : s + 65536]]) >= least[rows[s : s + 65536]] - slack for s in range(0, max(1, len(rows)), 65536)])
        rows, cols = rows[keep], cols[keep]
    exact = np.concatenate([np.einsum("ij,ij->i", q[rows[s : s + 65536]], x[cols[s : s + 65536]]) for s in range(0, max(1, len(rows)), 65536)])
    order = np.lexsort([x_rows[cols], x_ids[cols], -exact, rows])
    rows, cols, exact = rows[order], cols[order], exact[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], cols[place < k], exact[place < k].astype(np.int64)


def _meet(k: int):
    names = ("query_id", "query_row", "vec_id", "vec_row", "score")
    schema = pa.schema([(n, pa.int64()) for n in names])

    def meet(table: pa.Table) -> pa.Table:
        ids, keys, is_query = (table.column(c).to_numpy() for c in ("vec_id", "row_key", "is_query"))
        v = table.column("v").combine_chunks()
        sizes = np.diff(v.offsets.to_numpy())
        x = np.zeros((len(ids), max(1, int(sizes.max(initial=0)))))
        x[np.repeat(np.arange(len(ids)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = v.flatten().to_numpy(zero_copy_only=False)
        q, c = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        out = [[] for _ in names]
        for i in range(0, len(q) if len(c) else 0, 256):
            part = q[i : i + 256]
            rows, cols, score = best(x[part], keys[part], x[c], keys[c], ids[c], k)
            for o, values in zip(out, (ids[part][rows], keys[part][rows], ids[c][cols], keys[c][cols], score)):
                o.append(values)
        return pa.table([np.concatenate(o) if o else np.zeros(0, np.int64) for o in out], schema)

    return meet


def search(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row whose id is divisible by ``every``."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = saved(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fine)
        .select("vec_id", F.monotonically_increasing_id().alias("row_key"), F.transform("embedding", lambda x: F.floor(scale * x).cast("double")).alias("v"))
    )
    queries = rows.filter(F.col("vec_id") % every == 0)
    n, m = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    c_groups, q_groups = max(1, -(-n // CANDIDATES)), max(1, -(-m // QUERIES))
    spread = lambda groups: F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    group = lambda groups: F.pmod(F.xxhash64("row_key"), F.lit(groups)).cast("int")
    left = rows.select(group(c_groups).alias("c"), spread(q_groups).alias("q"), "vec_id", "row_key", "v", F.lit(False).alias("is_query"))
    right = queries.select(spread(c_groups).alias("c"), group(q_groups).alias("q"), "vec_id", "row_key", "v", F.lit(True).alias("is_query"))
    found = left.union(right).groupBy("c", "q").applyInArrow(_meet(k), "query_id long, query_row long, vec_id long, vec_row long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id", "vec_row"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
