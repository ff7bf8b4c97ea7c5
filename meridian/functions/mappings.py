"""Row mappings that are written down as data, and translations of tags as small classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mapped(df: DataFrame, config: Mapping[str, object]) -> DataFrame:
    """Rows and columns that a config asks for.

    ``where``: column -> value, list of values, or null for rows without one; ``select``: new name -> column, or a list of
    columns to join by a blank without the missing ones. What is left out asks nothing, or selects all columns.
    """
    out = df
    for column, value in dict(config.get("where") or {}).items():
        out = out.filter(F.col(column).isNull() if value is None else F.col(column).isin(list(value) if isinstance(value, list | tuple) else [value]))
    select = dict(config.get("select") or {})
    join = lambda c: F.concat_ws(" ", *(F.col(x).cast("string") for x in c)) if isinstance(c, list | tuple) else F.col(c)
    return out.select(*(join(c).alias(name) for name, c in select.items())) if select else out


class Translation:
    """How one layer's features become tagged objects; a layer overrides what it needs. ``df`` has a map column ``tags``."""

    def keep(self, tags: Column) -> Column:
        """Whether a feature is taken at all."""
        return F.lit(True)

    def translate(self, tags: Column) -> Column:
        """The tags that a feature gets."""
        return tags

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.filter(F.coalesce(self.keep(F.col("tags")), F.lit(False)))
        return out.withColumn("tags", self.translate(F.col("tags")))


def due_ids(closed: DataFrame, pending: DataFrame, cap: int) -> tuple[DataFrame, DataFrame]:
    """(ids to fetch next, high-water mark): ids still open are tried again first, then new ones after the largest closed id.

    ``closed``: id; ``pending``: id. At most ``cap`` ids, the smallest first; the mark is one row, 0 where nothing is closed.
    """
    mark = closed.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("mark"))
    new = mark.select(F.explode(F.sequence(F.col("mark"), F.col("mark") + cap - 1)).alias("id"))
    open_ = pending.select("id").distinct().join(closed.select("id"), "id", "left_anti").withColumn("first", F.lit(0))
    both = open_.union(new.join(pending.select("id"), "id", "left_anti").withColumn("first", F.lit(1)))
    return both.orderBy("first", "id").limit(cap).select("id"), mark


def window_seconds(behind: float, step: int = 600, factors: Sequence[int] = (1, 2, 3, 4), delay: int = 15) -> int:
    """Length of the next batch of a feed: a step, or up to four steps when so many are ready after the safety delay; 0 if none is."""
    ready = int(max(0.0, behind - delay) // step)
    return step * max((f for f in factors if f <= ready), default=0)
