"""Queries with filter conditions and paging, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from meridian.functions import columns as C
from meridian.functions import search as S
from meridian.plans.queries import query, r


@query("""SELECT doc_id, CASE WHEN lang IS NULL THEN 'Error' WHEN lang NOT IN ('en', 'de') THEN 'Filtered' WHEN n_chars < 20 THEN 'Empty' ELSE 'Processed' END AS status FROM documents""")
def generated_row_status(spark, load):
    status = F.when(F.col("lang").isNull(), "Error").when(~F.col("lang").isin("en", "de"), "Filtered").when(F.col("n_chars") < 20, "Empty").otherwise("Processed")
    return load("documents").select("doc_id", status.alias("status"))


@query("""SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey * 37 % 1000 BETWEEN 100 AND 700 AND c_custkey * 91 % 1000 BETWEEN 50 AND 800 AND c_mktsegment IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT s_suppkey, 'supplier' FROM supplier WHERE s_suppkey * 37 % 1000 BETWEEN 100 AND 700 AND s_suppkey * 91 % 1000 BETWEEN 50 AND 800""")
def points_in_box_by_zoom(spark, load):
    """Detail zooms read the customers, overview zooms the suppliers; both are asked here."""

    def at(zoom: int):
        key, name, topic = ("c_custkey", "customer", F.col("c_mktsegment")) if zoom >= 9 else ("s_suppkey", "supplier", F.lit("supplier"))
        box = S.in_range(F.col(key) * 37 % 1000, 100, 700) & S.in_range(F.col(key) * 91 % 1000, 50, 800)
        rows = load(name).filter(box & topic.isin("BUILDING", "MACHINERY", "supplier"))
        return rows.select(F.col(key).alias("c_custkey"), topic.alias("c_mktsegment"))

    return at(12).union(at(5))


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= 500")
def optional_parameters(spark, load):
    asked = {"c_name": None, "c_mktsegment": "BUILDING", "c_nationkey": None}
    return load("customer").filter(S.every([S.when_given(F.col(c), v) for c, v in asked.items()]) & S.in_range(F.col("c_acctbal"), 500, None)).select("c_custkey")


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'cold%' OR p_name ILIKE '%WIDGET' OR p_name ILIKE '%a!_b%' ESCAPE '!'")
def like_with_escape(spark, load):
    name = F.col("p_name")
    return load("part").filter(S.like_literal(name, "cold", "prefix") | S.like_literal(name, "WIDGET", "suffix") | S.like_literal(name, "a_b")).select("p_partkey", "p_name")


@query("SELECT s_suppkey FROM supplier WHERE starts_with(lower(s_name), 'supplier#00000000') UNION ALL SELECT p_partkey FROM part WHERE contains(lower(p_name), 'gadget') UNION ALL SELECT n_nationkey FROM nation")
def prefix_or_contains(spark, load):
    suppliers = load("supplier").filter(S.prefix_or_contains(F.col("s_name"), "Supplier#00000000")).select("s_suppkey")
    parts = load("part").filter(S.prefix_or_contains(F.col("p_name"), "*GADGET")).select("p_partkey")
    return suppliers.union(parts).union(load("nation").filter(S.prefix_or_contains(F.col("n_name"), " ")).select(F.col("n_nationkey").cast("long")))


@query("SELECT p_partkey FROM part WHERE regexp_matches(p_brand, '^Brand#.3') OR starts_with(p_brand, 'Brand#5')")
def quad_wildcard(spark, load):
    return load("part").filter(S.in_quad(F.col("p_brand"), "Brand#*3") | S.in_quad(F.col("p_brand"), "Brand#5")).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE (p_brand = 'Brand#13' AND p_type IN ('ECONOMY', 'PROMO')) OR (p_type = 'STANDARD' AND CAST(p_size AS VARCHAR) IN ('1', '2', '3', '24'))")
def tag_rules(spark, load):
    tags = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"), F.lit("size"), F.col("p_size").cast("string"))
    rules = [{"brand": "Brand#13", "type": ["ECONOMY", "PROMO"]}, {"type": "STANDARD", "size": ["1", "2", "3", "24"]}]
    return load("part").withColumn("tags", tags).filter(S.tags_match(F.col("tags"), rules)).select("p_partkey")


@query("""SELECT doc_id, 'and' AS asked FROM documents WHERE contains(lower(text), 'licensed under') AND contains(lower(text), 'the') AND NOT contains(lower(text), 'mit license')
UNION ALL SELECT doc_id, 'or' FROM documents WHERE (contains(lower(text), 'thanedble') OR contains(lower(text), 'ciónas')) AND NOT contains(lower(text), 'zzz') AND NOT contains(lower(source), 'src7')""")
def search_grammar(spark, load):
    docs = load("documents")
    first = docs.filter(S.matches_search([F.col("text")], '"Licensed under" the -"MIT License"')).select("doc_id", F.lit("and").alias("asked"))
    # minus terms look at all fields, so the source counts, too
    text = docs.filter(S.matches_search([F.col("text")], "thanedble, ciónas -zzz") & S.matches_search([F.col("source")], "-src7"))
    return first.union(text.select("doc_id", F.lit("or")))


@query("""SELECT c_custkey FROM customer WHERE c_nationkey IN (1, 2, 3, 5, 8) AND c_custkey % 40 >= 3 AND c_custkey % 40 <= 30
AND (c_custkey % 5 > 2 OR (c_custkey % 5 = 2 AND c_custkey % 12 >= 9)) AND c_mktsegment <> 'FURNITURE' AND c_acctbal >= 0""")
def targeting_rules(spark, load):
    k = F.col("c_custkey")
    row = {
        "country": F.col("c_nationkey"), "starts": k % 40, "balance": F.col("c_acctbal"),
        "version": F.concat_ws(".", (k % 5).cast("string"), (k % 12).cast("string")), "features": F.array("c_mktsegment"),
    }
    rule = {"countries": [1, 2, 3, 5, 8], "least_starts": 3, "most_starts": 30, "least_version": "2.9", "features": ["-FURNITURE"], "least_balance": 0.0}
    return load("customer").filter(S.targeted(row, rule)).select("c_custkey")


@query("SELECT p_partkey FROM part WHERE p_size * p_retailprice > 20000 AND (p_type = 'ECONOMY' OR contains(p_name, 'widget'))")
def area_and_tags(spark, load):
    return load("part").filter((F.col("p_size") * F.col("p_retailprice") > 20000) & ((F.col("p_type") == "ECONOMY") | F.col("p_name").contains("widget"))).select("p_partkey")


@query("""SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-20' AND contains(props, '7') AND NOT (CAST(value AS INTEGER) % 500 BETWEEN 400 AND 499)
AND CAST(trunc(value) AS BIGINT) % 500 NOT BETWEEN 400 AND 499""")
def log_predicates(spark, load):
    status = F.col("value").cast("long") % 500
    rounded = F.rint("value").cast("long") % 500
    between = (F.col("ts") >= F.lit("2024-01-02").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return load("events").filter(between & F.col("props").contains("7") & ~status.between(400, 499) & ~rounded.between(400, 499)).select("event_id", "event_type")


@query("""WITH p AS (SELECT user_id, event_id, event_id * 37 % 120 - 60 AS lat, event_id * 91 % 300 - 150 AS lon FROM events),
s AS (SELECT user_id, lat, lon, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0 FROM p WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
d AS (SELECT user_id, 2 * 6371000 * asin(sqrt(least(1, pow(sin(radians(lat - lat0) / 2), 2) + cos(radians(lat0)) * cos(radians(lat)) * pow(sin(radians(lon - lon0) / 2), 2)))) AS m FROM s)
SELECT user_id, coalesce(bool_or(m > 10000000), false) AS suspicious, count(*) AS points, round(max(m) / 1000, 1) AS longest_km FROM d GROUP BY 1""")
def far_vertices(spark, load):
    w = Window.partitionBy("user_id").orderBy("event_id")
    k = F.col("event_id")
    points = load("events").select("user_id", "event_id", (k * 37 % 120 - 60).alias("lat"), (k * 91 % 300 - 150).alias("lon"))
    step = points.select("user_id", C.haversine(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon")).alias("m"))
    far = F.coalesce(F.bool_or(F.col("m") > 10_000_000), F.lit(False))
    return step.groupBy("user_id").agg(far.alias("suspicious"), F.count("*").alias("points"), r(F.max("m") / 1000, 1).alias("longest_km"))


@query("""SELECT c_custkey, round(pow(c_custkey * 37 % 1000 - 500, 2) + pow(c_custkey * 91 % 1000 - 500, 2), 1) AS d2 FROM customer ORDER BY 2, 1 LIMIT 25""")
def nearest_to_centre(spark, load):
    k = F.col("c_custkey")
    return load("customer").select("c_custkey", r(F.pow(k * 37 % 1000 - 500, F.lit(2)) + F.pow(k * 91 % 1000 - 500, F.lit(2)), 1).alias("d2")).orderBy("d2", "c_custkey").limit(25)


@query("""SELECT event_id, value, n FROM (SELECT event_id, value, row_number() OVER (ORDER BY CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END DESC NULLS FIRST, event_id) AS n FROM events) WHERE n <= 40""")
def nulls_first_descending(spark, load):
    """A nulls-last order turned around: nulls come first."""
    value = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    first = load("events").orderBy(value.desc_nulls_first(), "event_id").limit(40)
    return first.select("event_id", "value", F.row_number().over(Window.orderBy(value.desc_nulls_first(), "event_id")).alias("n"))


@query("""WITH f AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000), c AS (SELECT count(*) AS n FROM f)
SELECT o_orderkey, CASE WHEN (SELECT n FROM c) <= 500 THEN o_custkey END AS o_custkey FROM f ORDER BY o_orderkey LIMIT 2000""")
def adaptive_limit(spark, load):
    """Full rows up to a limit; beyond it more rows, but summaries of them."""
    found = load("orders").filter("o_totalprice > 100000").select("o_orderkey", "o_custkey")
    if found.limit(501).count() <= 500:
        return found.orderBy("o_orderkey").limit(500)
    return found.select("o_orderkey", F.lit(None).cast("long").alias("o_custkey")).orderBy("o_orderkey").limit(2000)


@query("""SELECT count(*) > 100 AS overflow, least(count(*), 100) AS n FROM (SELECT * FROM part WHERE p_size > 20 LIMIT 101)""")
def capped_scan(spark, load):
    return load("part").filter("p_size > 20").limit(101).agg((F.count("*") > 100).alias("overflow"), F.least(F.count("*"), F.lit(100)).alias("n"))


@query("""WITH a AS (SELECT p_partkey, 1 AS source FROM part WHERE p_brand = 'Brand#13' ORDER BY p_partkey LIMIT 30), b AS (SELECT p_partkey, 2 AS source FROM part WHERE p_type = 'ECONOMY' ORDER BY p_partkey LIMIT 20)
SELECT * FROM a UNION ALL SELECT * FROM (SELECT * FROM b WHERE p_partkey NOT IN (SELECT p_partkey FROM a) ORDER BY p_partkey LIMIT greatest(0, 50 - (SELECT count(*) FROM a)))""")
def two_source_quota(spark, load):
    """The second source is limited before its duplicates go, so fewer rows than the quota may come."""
    part = load("part")
    first = part.filter("p_brand = 'Brand#13'").orderBy("p_partkey").limit(30).select("p_partkey", F.lit(1).alias("source"))
    second = part.filter("p_type = 'ECONOMY'").orderBy("p_partkey").limit(20).select("p_partkey", F.lit(2).alias("source")).join(first, "p_partkey", "left_anti")
    both = first.union(second)
    return both.orderBy("source", "p_partkey").limit(50)


@query("""SELECT n, count(*) AS groups FROM (SELECT count(DISTINCT mail) AS n FROM (SELECT c_custkey AS mail FROM customer WHERE c_acctbal > 5000 UNION SELECT o_custkey FROM orders WHERE o_totalprice > 400000 UNION SELECT user_id FROM events WHERE event_type = 'purchase')) GROUP BY 1""")
def mailing_union(spark, load):
    mails = load("customer").filter("c_acctbal > 5000").select("c_custkey").union(load("orders").filter("o_totalprice > 400000").select("o_custkey")).union(load("events").filter("event_type = 'purchase'").select("user_id"))
    return mails.distinct().agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("groups"))
