"""Scalar expressions of names, scores, tags, codes and tracks."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType


def natural_join(values: Column, separator: str = ";") -> Column:
    """Array elements in natural order: by first number, then by what follows it ignoring case; pairs that are equal in
    both collapse to the one with the smaller code points. Elements without a number come last."""
    number = lambda v: F.coalesce(F.regexp_extract(v, "([0-9]{1,18})", 1).try_cast("long"), F.lit(2**62))
    suffix = lambda v: F.lower(F.regexp_extract(v, "[0-9]+(.*)$|^([^0-9]*)$", 0))
    keyed = F.array_sort(F.transform(F.array_compact(values), lambda v: F.struct(number(v).alias("n"), F.regexp_replace(suffix(v), "^[0-9]+", "").alias("s"), v.alias("v"))))
    first = F.filter(keyed, lambda x, i: (i == 0) | ~F.struct(x["n"], x["s"]).eqNullSafe(F.struct(F.get(keyed, i - 1)["n"], F.get(keyed, i - 1)["s"])))
    return F.array_join(F.transform(first, lambda x: x["v"]), separator)


def digits_only(text: Column) -> Column:
    """The first whole number of an elevation text; null without one."""
    return F.regexp_extract(text, "(-?[0-9]{1,9})", 1).try_cast("int")


def abbreviated(text: Column, names: Mapping[str, str]) -> Column:
    """Words replaced by their map entries, ignoring case."""
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.array_join(F.transform(F.split(text, " "), lambda w: F.coalesce(table[F.lower(w)], w)), " ")


def prefixes(name: Column, longest: int) -> Column:
    """Distinct lower-cased word prefixes of a name without its parts in brackets, as an index takes them."""
    words = F.filter(F.split(F.lower(F.regexp_replace(name, r"\([^)]*\)", " ")), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 0)
    return F.array_distinct(F.transform(words, lambda w: F.left(w, F.lit(longest))))


def curved_score(score: Column, base: float) -> Column:
    """``score`` clamped to 0..1, bent as base^(10 s - 10), as a whole percent (half even)."""
    return F.bround(F.pow(F.lit(float(base)), 10 * F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)) - 10) * 100, 0).cast("int")


def weighted_score(parts: Sequence[tuple[Column, float]]) -> Column:
    """Weighted sum of parts, where negative and missing ones count as 0, in thousandths, cut to whole ones."""
    total = sum((F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0)) * w for c, w in parts), F.lit(0.0))
    return F.floor(F.round(total * 1000, 6)).cast("int")


def shard(name: Column) -> Column:
    """Two-level folder of a name's MD5."""
    h = F.md5(name.cast("binary"))
    return F.concat_ws("/", F.substring(h, 1, 1), F.substring(h, 1, 2))


def added_tags(tags: Column, *sources: Column) -> Column:
    """``tags`` with entries of the source maps, in order, whose keys it lacks so far. Null maps add nothing."""
    none = F.from_json(F.lit("{}"), "map<string,string>")
    out = F.coalesce(tags, none)
    for source in sources:
        held = F.map_keys(out)
        out = F.map_concat(out, F.map_from_entries(F.filter(F.map_entries(F.coalesce(source, none)), lambda e: ~F.array_contains(held, e["key"]))))  # noqa: B023
    return out


def without_fields(text: Column, names: Sequence[str]) -> Column:
    """A JSON object without some of its fields; null where it isn't an object of scalars."""
    fields = F.from_json(text, "map<string,string>")
    return F.to_json(F.map_filter(fields, lambda k, v: ~k.isin(*names)))


def degrees_minutes(value: Column, width: int) -> Column:
    """DDMM.MMMM (``width`` 2) or DDDMM.MMMM (3) of an absolute angle."""
    a = F.abs(value)
    whole = F.floor(a)
    return F.concat(F.lpad(whole.cast("string"), width, "0"), F.lpad(F.format_string("%.4f", (a - whole) * 60), 7, "0"))


def quadkey(x: Column, y: Column, zoom: int) -> Column:
    """Digits 0 to 3 of a tile, from the coarsest level."""
    digit = lambda k: (F.shiftright(x, k).bitwiseAND(F.lit(1)) + 2 * F.shiftright(y, k).bitwiseAND(F.lit(1))).cast("string")
    return F.concat(*(digit(k) for k in range(zoom - 1, -1, -1))) if zoom else F.lit("")


def angle_between(a: Column, b: Column) -> Column:
    """Degrees between two bearings, 0 to 180."""
    return F.abs(F.pmod(a - b + 180, F.lit(360.0)) - 180)


def midpoints(length: Column, most: float) -> Column:
    """Shares of a line at which it is split by halving until no part is over ``most``, ends included."""
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(length, F.lit(1e-9)) / most))).cast("int")
    parts = F.pow(F.lit(2), level).cast("int")
    return F.transform(F.sequence(F.lit(0), parts), lambda i: i / parts)


def _simplified(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Places of the points that Douglas-Peucker keeps; without recursion, so long lines are no problem."""
    keep = np.zeros(len(x), bool)
    keep[[0, -1]] = True
    todo = [(0, len(x) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        dx, dy = x[b] - x[a], y[b] - y[a]
        px, py = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a]
        t = np.clip((px * dx + py * dy) / (dx * dx + dy * dy), 0, 1) if dx or dy else np.zeros(b - a - 1)
        d = np.hypot(px - t * dx, py - t * dy)
        k = int(d.argmax())
        if d[k] > tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return np.flatnonzero(keep)


def simplified(tolerance: float):
    """UDF (array of x, array of y) -> places of the points that are kept (0-based); null and empty lines keep none."""

    @pandas_udf(ArrayType(IntegerType()))
    def places(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xs, ys in batches:
            yield pd.Series([[] if x is None or len(x) == 0 else _simplified(np.asarray(x, float), np.asarray(y, float), tolerance).tolist() for x, y in zip(xs, ys)])

    return places


def _zigzag(values: np.ndarray) -> bytes:
    steps = np.diff(values, prepend=0)
    out = bytearray()
    for v in ((steps << 1) ^ (steps >> 63)).astype(np.uint64).tolist():
        while v > 127:
            out.append(v & 127 | 128)
            v >>= 7
        out.append(v)
    return bytes(out)


def _unzigzag(raw: bytes) -> list[int]:
    if not raw:
        return []
    data = np.frombuffer(raw, np.uint8).astype(np.uint64)
    last = np.flatnonzero(data < 128)
    first = np.append(0, last[:-1] + 1)
    place = np.arange(len(data)) - np.repeat(first, last - first + 1)
    values = np.add.reduceat((data & np.uint64(127)) << (7 * place).astype(np.uint64), first)
    return np.cumsum((values >> np.uint64(1)).astype(np.int64) ^ -(values & np.uint64(1)).astype(np.int64)).tolist()


@pandas_udf(BinaryType())
def packed_deltas(values: pd.Series) -> pd.Series:
    """Whole numbers as zigzag varints of their differences; null for null."""
    return values.map(lambda v: None if v is None else _zigzag(np.asarray(v, np.int64)))


@pandas_udf(ArrayType(LongType()))
def unpacked_deltas(raw: pd.Series) -> pd.Series:
    """What ``packed_deltas`` packed."""
    return raw.map(lambda b: None if b is None else _unzigzag(b))
