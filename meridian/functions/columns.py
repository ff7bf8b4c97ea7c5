"""Column expressions: text, arrays, JSON, statistics, geometry on the sphere and on the tile grid."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371000.0


def month_of(day: Column) -> Column:
    """First seven characters of an ISO day."""
    return F.substring(day, 1, 7)


def before_separator(text: Column, separator: str) -> Column:
    """Text before the first ``separator``; null where there is none."""
    return F.when(F.instr(text, separator) > 0, F.substring_index(text, separator, 1))


def endpoint(uri: Column) -> Column:
    """URI without its query; only the first segment, unless it is an API or a subscription call."""
    path = F.substring_index(uri, "?", 1)
    first = F.concat(F.lit("/"), F.split_part(path, F.lit("/"), F.lit(2)))
    return F.when(path.startswith("/api") | path.startswith("/subscription"), path).otherwise(first)


def folded_name(text: Column) -> Column:
    return F.lower(F.trim(F.translate(text, "’`´", "'''")))


def any_of(array: Column, wanted: Sequence[str]) -> Column:
    return F.arrays_overlap(array, F.array(*map(F.lit, wanted)))


def all_of(array: Column, wanted: Sequence[str]) -> Column:
    return F.size(F.array_except(F.array(*map(F.lit, wanted)), array)) == 0


def first_preferred(array: Column, preferred: Sequence[str]) -> Column:
    """First element of ``preferred`` that ``array`` holds; null if none."""
    return F.get(F.filter(F.array(*map(F.lit, preferred)), lambda x: F.array_contains(array, x)), 0)


def added_by_position(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def regexp_found(text: Column, pattern: str) -> Column:
    """Case-insensitive find; false for null."""
    return F.coalesce(text.rlike(f"(?i){pattern}"), F.lit(False))


def tolerant_not_in(value: Column, excluded: Sequence[str]) -> Column:
    """Null passes."""
    return F.coalesce(~value.isin(*excluded), F.lit(True))


def rank_percentile(values: Column, p: float) -> Column:
    """Percentile at rank p (n + 1) / 100 of a sorted array, linear between neighbours, clamped to the ends."""
    n = F.size(values)
    pos = F.lit(p) * (n + 1) / 100
    low = F.floor(pos).cast("int")
    at = lambda k: F.get(values, k - 1)
    between = at(low) + (pos - low) * (at(low + 1) - at(low))
    return F.when(n == 0, None).when(pos < 1, at(F.lit(1))).when(pos >= n, at(n)).otherwise(between)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Degrees from north, 0 to 360."""
    d = F.radians(lon2 - lon1)
    p, q = F.radians(lat1), F.radians(lat2)
    angle = F.degrees(F.atan2(F.sin(d) * F.cos(q), F.cos(p) * F.sin(q) - F.sin(p) * F.cos(q) * F.cos(d)))
    return F.pmod(angle, F.lit(360.0))


def tile_x(lon: Column, zoom: int) -> Column:
    return F.floor((lon + 180) / 360 * (1 << zoom))


def tile_y(lat: Column, zoom: int) -> Column:
    r = F.radians(lat)
    return F.floor((1 - F.asinh(F.tan(r)) / F.lit(3.141592653589793)) / 2 * (1 << zoom))


def boxes_overlap(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """(min x, min y, max x, max y), edges included."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def xor_checksum(text: Column) -> Column:
    return F.hex(F.aggregate(F.split(text, ""), F.lit(0), lambda a, c: a.bitwiseXOR(F.ascii(c))))


def activity_by_speed(avg: Column, top: Column) -> Column:
    """First activity whose average and top speed limits (km/h) hold."""
    out = F.when(avg.isNull() | (avg <= 0), "nospeed")
    for name, a, m in (("foot", 12, 25), ("cycling", 25, 45), ("driving", 130, 250), ("aviation", 1000, 1200)):
        out = out.when((avg <= a) & (top <= m), name)
    return out.otherwise("other")


def track_problem(points: Column, distance: Column, largest_gap: Column, top_speed: Column) -> Column:
    """Why a track is garbage; null if it isn't. The order of the tests matters."""
    return (
        F.when(points < 10, "sparse").when(distance < 200, "short").when((largest_gap > 1000) & (top_speed > 1200), "teleport")
    )


def box_relation(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """How box ``a`` lies to ``b``: equal, contains, inside, touches (edges or corners only), overlaps or disjoint; null where a side is."""
    known = (a[0] + a[1] + a[2] + a[3] + b[0] + b[1] + b[2] + b[3]).isNotNull()
    within = lambda p, q: (p[0] >= q[0]) & (p[1] >= q[1]) & (p[2] <= q[2]) & (p[3] <= q[3])
    edge = (a[2] == b[0]) | (b[2] == a[0]) | (a[3] == b[1]) | (b[3] == a[1])
    out = F.when(~boxes_overlap(a, b), "disjoint").when(within(a, b) & within(b, a), "equal").when(within(b, a), "contains").when(within(a, b), "inside")
    return F.when(known, out.when(edge, "touches").otherwise("overlaps"))


#: Tags that count for an island's rank, besides those with "name" in their key.
RANKED_TAGS = ("wikimedia_commons", "wikipedia", "website", "population", "contact:website", "ssr:stedsnr")


def important_tags(tags: Column) -> Column:
    """The number of tags that count for an island's rank."""
    key = lambda k: F.lower(k)
    return F.size(F.filter(F.map_keys(tags), lambda k: key(k).contains("name") | key(k).isin(*RANKED_TAGS)))


def island_rank(square_km: Column, tags: Column) -> Column:
    """0.3 times an area score (10 log10 of the area, 100 at most, 0 without area) and 0.7 times a tag score (9 a tag, 100 at most), to one decimal, ties to even."""
    area = F.when(square_km > 0, F.least(F.lit(100.0), 10 * F.log10(square_km))).otherwise(0.0)
    return F.bround(0.3 * area + 0.7 * F.least(F.lit(100.0), tags * 9.0), 1)


def has_extension(name: Column, extensions: Sequence[str]) -> Column:
    """Whether a file name ends with a dot and one of ``extensions`` (lower case), whatever its own case."""
    out = F.lit(False)
    for extension in extensions:
        out = out | F.lower(name).endswith(f".{extension}")
    return out


def iso_timestamp(text: Column) -> Column:
    """Time of a text such as 2024-01-31T10:20:30 or with a blank, a fraction or a zone; null where it is none."""
    return F.try_to_timestamp(F.replace(text, F.lit("T"), F.lit(" ")))


def gunzipped(hexadecimal: Column) -> Column:
    """Text of hexadecimal digits of a gzip stream; null where it is none. Python, by batches."""

    @F.pandas_udf("string")
    def unpack(values: pd.Series) -> pd.Series:
        def one(raw: str | None) -> str | None:
            try:
                return gzip.decompress(bytes.fromhex(raw)).decode() if raw is not None else None
            except (ValueError, OSError, EOFError, zlib.error):
                return None

        return values.map(one, na_action=None)

    return unpack(hexadecimal)
