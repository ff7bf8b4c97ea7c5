"""Sources and sinks. Paths are any URI that Spark's readers take."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

LOG_LINE = r'^(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+) [^"]*" (\d{3}) (\S+)(?: "([^"]*)" "([^"]*)")?'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jdbc(spark: SparkSession, url: str, name: str, column: str, lower: int, upper: int, parts: int, **options: str) -> DataFrame:
    """A database table, read in ``parts`` ranges of a numeric column."""
    return spark.read.jdbc(url, name, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=options)


def csv_cropped(spark: SparkSession, path: str, most: int = 255, prefixes: Sequence[str] = ()) -> DataFrame:
    """CSV (plain or gz) with a header, strings only, cropped; columns by name prefix where given."""
    df = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)
    names = [c for c in df.columns if not prefixes or any(c.startswith(p) for p in prefixes)]
    return df.select(*(F.substring(F.col(f"`{c}`"), 1, most).alias(c) for c in names))


def sampled(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (all, if fewer), chosen by seeded random order."""
    return df.orderBy(F.rand(seed)).limit(n)


def parsed_log(raw: DataFrame) -> DataFrame:
    """ip, time, method, uri, status, aid of lines (value) in the combined format; lines that don't parse are left out."""
    part = lambda k: F.regexp_extract("value", LOG_LINE, k)
    aid = F.nullif(F.regexp_extract(part(4), "aid=([a-z,0-9]*)", 1), F.lit(""))
    return raw.filter(F.col("value").rlike(LOG_LINE)).select(
        part(1).alias("ip"), F.to_timestamp(part(2), "dd/MMM/yyyy:HH:mm:ss Z").alias("time"), part(3).alias("method"), part(4).alias("uri"), part(5).cast("int").alias("status"), aid.alias("aid")
    )


def access_log(spark: SparkSession, path: str) -> DataFrame:
    """Combined-format lines: ip, time, method, uri, status, aid; lines that don't parse are left out."""
    return parsed_log(spark.read.text(path))


def osm_xml(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows of one element kind (node, way or relation) of an OSM XML file."""
    tag = "array<struct<_k:string,_v:string>>"
    fields = {
        "node": f"_id long, _lat double, _lon double, tag {tag}",
        "way": f"_id long, nd array<struct<_ref:long>>, tag {tag}",
        "relation": f"_id long, member array<struct<_type:string,_ref:long,_role:string>>, tag {tag}",
    }[kind]
    df = spark.read.format("xml").options(rowTag=kind).schema(fields).load(path)
    tags = F.map_from_entries(F.transform(F.coalesce("tag", F.array().cast(tag)), lambda t: F.struct(t["_k"], t["_v"])))
    rest = {"node": ["_lat", "_lon"], "way": [F.transform("nd", lambda n: n["_ref"]).alias("nodes")], "relation": ["member"]}[kind]
    return df.select(F.col("_id").alias("id"), *(F.col(c).alias(c.strip("_")) if isinstance(c, str) else c for c in rest), tags.alias("tags"))


_TOKEN = re.compile(r"""\s+|--\s[^\n]*|/\*.*?\*/|`[^`]*`|'(?P<single>(?:[^'\\]|\\.|'')*)'|"(?P<double>(?:[^"\\]|\\.|"")*)"|(?P<mark>[(),;])|(?P<bare>[^\s(),;'"`]+)|(?P<odd>.)""", re.S)


def dump_tuples(statements: str) -> Iterator[list[str | None]]:
    """Tuples of the INSERT statements in a stretch of a dump that may begin after the words INSERT INTO.

    NULL becomes null, a backslash or a doubled quote stands for the sign after it. Names, strings and comments may hold any sign,
    words such as VALUES among them; commas between tuples may be missing. A string without an end is an error.
    """
    place, fields, value, depth = "head", [], None, 0
    for m in _TOKEN.finditer(statements):
        kind = m.lastgroup
        if kind is None:  # space, comment or name
            continue
        if kind == "odd":
            raise ValueError(f"a quoted string of the dump has no end: {statements[m.start() : m.start() + 60]!r}")
        word = m["bare"].upper() if kind == "bare" else m["mark"] or ""
        if depth == 0:
            if word == "INSERT":
                place = "head"
            elif word == ";":
                place = "none"
            elif word == "VALUES" and place == "head":
                place = "tuples"
            elif word == "(":
                fields, value, depth = [], None, 1
            elif word not in (",", "") and place == "tuples":  # such as ON DUPLICATE KEY UPDATE
                place = "none"
        elif word == "(":
            depth += 1
        elif word == ")" and depth > 1:
            depth -= 1
        elif word == ")" or (word == "," and depth == 1):
            if value is not None:
                fields.append(value[0])
            value = None
            if word == ")":
                depth = 0
                if place == "tuples":
                    yield fields
        elif depth == 1 and kind == "bare":
            value = (None if word == "NULL" else m["bare"],)
        elif depth == 1:
            quote = "'" if kind == "single" else '"'
            value = (re.sub(r"\\(.)", r"\1", m[kind].replace(quote * 2, quote), flags=re.S) if "\\" in m[kind] or quote in m[kind] else m[kind],)


@udtf(returnType="fields: array<string>")
class DumpTuples:
    """One row per tuple."""

    def eval(self, statements: str) -> Iterator[tuple[list[str | None]]]:
        for fields in dump_tuples(statements or ""):
            yield (fields,)


def sql_dump(spark: SparkSession, path: str) -> DataFrame:
    """(fields) of all tuples of a dump's INSERT statements (plain or gz); a task takes the statements that begin in its part of a file.

    Statements may hold line breaks and semicolons in strings; a line that begins with ``INSERT INTO`` begins a statement.
    """
    spark.udtf.register("dump_tuples", DumpTuples)
    spark.read.text(path, lineSep="\nINSERT INTO ").createOrReplaceTempView("_dump")
    return spark.sql("SELECT t.fields FROM _dump, LATERAL dump_tuples(value) t")


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, length and modification time of all files below a folder."""
    return spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(path).select("path", "length", "modificationTime")


def overwrite_partitions(df: DataFrame, path: str, *keys: str) -> None:
    """Replaces only the partitions that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def upserted(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with rows of ``new`` inserted, or put in place of rows with the same keys."""
    return old.join(new, list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def geojson(df: DataFrame, lat: str, lon: str, properties: Sequence[str]) -> DataFrame:
    """One GeoJSON feature per row."""
    point = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct(*properties).alias("properties"))).alias("feature"))


def gpx_points(spark: SparkSession, path: str) -> DataFrame:
    """(track, seg, ord, lat, lon, ele, time) of the track points of GPX files; a track is known by its file and place there."""
    point = "array<struct<_lat:double,_lon:double,ele:double,time:timestamp>>"
    raw = spark.read.format("xml").options(rowTag="trk").schema(f"name string, trkseg array<struct<trkpt:{point}>>").load(path)
    tracks = raw.select(F.concat_ws("#", F.input_file_name(), F.monotonically_increasing_id().cast("string")).alias("track"), F.posexplode("trkseg").alias("seg", "s"))
    return tracks.select("track", "seg", F.posexplode("s.trkpt").alias("ord", "p")).select(
        "track", "seg", "ord", F.col("p._lat").alias("lat"), F.col("p._lon").alias("lon"), F.col("p.ele").alias("ele"), F.col("p.time").alias("time")
    )


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per JSON document, whole file or array of objects; files that don't parse give rows of nulls."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def dump_pages(spark: SparkSession, path: str) -> DataFrame:
    """(id, title, fields) of the pages of a wiki dump whose text is a JSON object; other pages have null fields."""
    schema = "id long, title string, revision struct<text:string>"
    pages = spark.read.format("xml").options(rowTag="page").schema(schema).load(path)
    return pages.select("id", "title", F.from_json("revision.text", "map<string,string>").alias("fields"))


def geojson_features(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """(tags, type, coordinates) of GeoJSON features, one per line; tags are the named properties that a feature has."""
    fields = ", ".join(f"{n}: string" for n in names)
    raw = spark.read.schema(f"properties struct<{fields}>, geometry struct<type: string, coordinates: string>").json(path)
    tags = F.map_filter(F.create_map(*(x for n in names for x in (F.lit(n), F.col(f"properties.{n}")))), lambda k, v: v.isNotNull())
    return raw.select(tags.alias("tags"), F.col("geometry.type").alias("type"), F.col("geometry.coordinates").alias("coordinates"))


def write_osm_nodes(nodes: DataFrame, path: str) -> None:
    """Nodes (id, lat, lon, tags) as XML elements, in the form that ``osm_xml`` reads."""
    tag = F.transform(F.map_entries("tags"), lambda e: F.struct(e["key"].alias("_k"), e["value"].alias("_v")))
    out = nodes.select(F.col("id").alias("_id"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), tag.alias("tag"))
    out.write.format("xml").options(rootTag="osm", rowTag="node", declaration="version='1.0'").save(path)


def write_csv_union(frames: Sequence[DataFrame], path: str) -> None:
    """Frames with different columns as one CSV, whose header is the union of their columns."""
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    first.write.csv(path, header=True, quote='"', escape='"')


def purged(df: DataFrame, time: str, before: str, referenced: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Rows that a rotation keeps: not older than ``before``, or still referenced by key. Rows without a time are kept."""
    old = F.coalesce(F.col(time) < F.lit(before).cast("timestamp"), F.lit(False))
    kept = df.filter(~old)
    return kept if referenced is None else kept.unionByName(df.filter(old).join(referenced.select(key).distinct(), key, "left_semi").select(*df.columns))


def without_blocked(tables: dict[str, tuple[DataFrame, str]], blocked: DataFrame, key: str) -> dict[str, DataFrame]:
    """Each table, given with the name of its key column, without the rows of blocked keys; null keys stay."""
    return {name: df.join(blocked.select(F.col(key).alias(column)).distinct(), column, "left_anti") for name, (df, column) in tables.items()}
