"""Queries on boxes, ranks, pages, rolling statistics and similar pairs, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import columns as C
from meridian.operators import etl, joins, ranking, reports
from meridian.plans.queries import _BOX, ORACLES, _boxes, query, r


@query(f"""WITH a AS (SELECT {_BOX.format(k='p_partkey')} FROM part), b AS (SELECT {_BOX.format(k='c_custkey')} FROM customer)
SELECT a.id AS a_id, b.id AS b_id, CASE WHEN a.x0 = b.x0 AND a.y0 = b.y0 AND a.x1 = b.x1 AND a.y1 = b.y1 THEN 'equal' WHEN a.x0 <= b.x0 AND a.y0 <= b.y0 AND a.x1 >= b.x1 AND a.y1 >= b.y1 THEN 'contains'
WHEN a.x0 >= b.x0 AND a.y0 >= b.y0 AND a.x1 <= b.x1 AND a.y1 <= b.y1 THEN 'inside' WHEN a.x1 = b.x0 OR b.x1 = a.x0 OR a.y1 = b.y0 OR b.y1 = a.y0 THEN 'touches' ELSE 'overlaps' END AS relation
FROM a JOIN b ON a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1""")
def box_relations(spark, load):
    """How boxes that meet lie to each other."""
    left, right = _boxes(load("part"), "p_partkey", "a_"), _boxes(load("customer"), "c_custkey", "b_")
    names = lambda p: [f"{p}{x}" for x in ("x0", "y0", "x1", "y1")]
    a, b = ([F.col(n) for n in names(p)] for p in ("a_", "b_"))
    return joins.grid_join(left, right, 25.0, C.boxes_overlap(a, b), names("a_"), names("b_"), {"relation": C.box_relation(a, b)}).select("a_id", "b_id", "relation")


@query("""SELECT c_custkey, round_even(0.3 * CASE WHEN c_acctbal > 0 THEN least(100.0::DOUBLE, 10 * log10(c_acctbal)) ELSE 0 END + 0.7 * least(100.0::DOUBLE, (1 + CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END) * 9.0::DOUBLE), 1) AS rank FROM customer""")
def island_ranks(spark, load):
    """A customer is an island: its balance the area, its name and every second one's website tags that count."""
    tags = F.create_map(F.lit("Name:en"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"))
    tags = F.when(F.col("c_custkey") % 2 == 0, F.map_concat(tags, F.create_map(F.lit("website"), F.lit("x")))).otherwise(tags)
    return load("customer").select("c_custkey", C.island_rank(F.col("c_acctbal"), C.important_tags(tags)).alias("rank"))


@query("""SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS at, event_id % 3 = 0 AS is_image FROM events""")
def names_and_times(spark, load):
    """ISO texts to times, and file names by extension."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    name = F.concat(F.lit("File "), F.col("event_id").cast("string"), F.when(F.col("event_id") % 3 == 0, ".JPG").otherwise(".jpg.txt"))
    return load("events").select("event_id", C.iso_timestamp(text).cast("timestamp_ntz").alias("at"), C.has_extension(name, ["jpg", "jpeg", "png"]).alias("is_image"))


@query("""WITH t AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents)
SELECT token, count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, token LIMIT 1000""")
def top_words_everywhere(spark, load):
    """The 1,000 most frequent words of all regions."""
    words = load("documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("token"))
    return words.groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(1000)


@query("SELECT c_custkey, c_name, (SELECT count(*) FROM customer) AS total FROM customer ORDER BY lower(c_name), c_name, c_custkey LIMIT 10 OFFSET 30")
def page_with_total(spark, load):
    rows = load("customer").select("c_custkey", "c_name")
    return reports.page_of(rows, [F.lower("c_name"), F.col("c_name"), F.col("c_custkey")], 10, 3)


@query("""WITH d AS (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS t FROM events), h AS (SELECT unnest([3, 24, 72, 168, 720]) AS hours),
v AS (SELECT t, hours, list_sort(list(value)) AS x, count(*) AS n, avg(value) AS mean FROM d, h, events WHERE ts <= t AND ts > t - to_hours(hours) AND value IS NOT NULL GROUP BY 1, 2),
q AS (SELECT *, 90 * (n + 1) / 100.0::DOUBLE AS pos FROM v)
SELECT t AS at, CAST(hours AS INTEGER) AS hours, n, round(mean, 8) AS mean, round(CASE WHEN pos < 1 THEN x[1] WHEN pos >= n THEN x[n] ELSE x[CAST(floor(pos) AS BIGINT)] + (pos - floor(pos)) * (x[CAST(floor(pos) AS BIGINT) + 1] - x[CAST(floor(pos) AS BIGINT)]) END, 4) AS value FROM q""")
def rolling_percentiles(spark, load):
    """90th percentiles and means of the last 3 hours to 30 days, at each midnight."""
    events = load("events")
    days = events.select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("t")).distinct()
    out = reports.rolling_statistics(events, "ts", "value", days, [3, 24, 72, 168, 720], 90)
    return out.select("at", "hours", "n", r("mean", 8).alias("mean"), r("value").alias("value"))


@query(f"""WITH k AS ({ORACLES["knn_embeddings"]}), b AS (SELECT id, other, similarity FROM k UNION ALL SELECT other, id, similarity FROM k) SELECT id, other, max(similarity) AS similarity FROM b GROUP BY 1, 2""")
def knn_symmetric(spark, load):
    """Nearest vectors of one label, both ways."""
    near = ranking.nearest_vectors(load("embeddings"), "vec_id", "label", "embedding", 2)
    return reports.symmetric(near)


@query("""WITH RECURSIVE n AS (SELECT min(doc_id) AS id, doc_id // 3 AS title, lang FROM documents GROUP BY 2, 3),
b AS (SELECT c.id, arg_min(p.id, struct_pack(a := p.lang <> c.lang, b := p.lang <> 'en', c := p.lang, d := p.id)) AS up FROM n c JOIN n p ON p.title = c.title // 5 AND c.title > 0 GROUP BY 1),
w AS (SELECT id, 0 AS depth, CAST(id AS VARCHAR) AS path FROM n WHERE title = 0 UNION ALL SELECT b.id, depth + 1, path || '/' || b.id FROM w JOIN b ON b.up = w.id WHERE depth < 30)
SELECT CAST(id AS VARCHAR) AS id, CAST(depth AS INTEGER) AS depth, path FROM w""")
def language_paths(spark, load):
    """Paths through parents in the own language, else in English, else in any."""
    title = F.floor(F.col("doc_id") / 3)
    nodes = load("documents").groupBy(title.alias("title"), "lang").agg(F.min("doc_id").alias("id"))
    nodes = nodes.withColumn("part_of", F.when(F.col("title") > 0, F.floor(F.col("title") / 5)))
    paths = etl.hierarchy_paths(etl.preferred_parents(nodes), "id", "parent")
    return paths.select(F.col("id").cast("string").alias("id"), F.col("depth").cast("int").alias("depth"), "path")


@query("""SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 250000 AND o.o_orderstatus <> 'P')""")
def not_exists_filter(spark, load):
    large = load("orders").filter("o_totalprice > 250000 and o_orderstatus <> 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return load("customer").join(large, "c_custkey", "left_anti").select("c_custkey")
