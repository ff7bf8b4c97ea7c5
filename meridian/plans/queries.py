"""Queries on the driver's tables, one per operator, with the SQL that says the same.

``@query(sql)`` registers a function (spark, load) -> DataFrame under its own name, where ``load(name)``
reads a table. Doubles are rounded alike on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.functions import columns as C
from meridian.operators import etl, joins, ranking
from meridian.sources.readers import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark, lambda name: table(spark, sf_dir, name))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def r(column, digits: int = 4):
    return F.round(column, digits)


# --- contribution reports: user = customer, change set = order, region = nation

BUCKETS = [(20, 10_000, 0), (15, 19, 0), (10, 14, 0), (5, 9, 0), (1, 4, 0)]
BUCKET_SQL = "(VALUES (1,20,9223372036854775807),(2,15,19),(3,10,14),(4,5,9),(5,1,4)) b(rank, least, most)"


@query("""SELECT b.rank AS rank, count(*) AS users, CAST(sum(c.n) AS BIGINT) AS orders FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) c
JOIN (VALUES (1,20,9223372036854775807),(2,15,19),(3,10,14),(4,5,9),(5,1,4)) b(rank, least, most) ON c.n BETWEEN b.least AND b.most GROUP BY 1""")
def contrib_ranking(spark, load):
    counts = load("orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return ranking.bucket_ranks(counts, "o_custkey", "n", BUCKETS).groupBy("rank").agg(F.count("*").alias("users"), F.sum("n").alias("orders"))


@query("""SELECT count(DISTINCT c_custkey) AS users, count(DISTINCT o_orderkey) AS orders, round(sum(DISTINCT o_totalprice), 2) AS distinct_sum,
count(*) AS n, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders JOIN customer ON o_custkey = c_custkey""")
def contrib_totals(spark, load):
    both = load("orders").join(load("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return both.agg(
        F.count_distinct("c_custkey").alias("users"), F.count_distinct("o_orderkey").alias("orders"), r(F.sum_distinct("o_totalprice"), 2).alias("distinct_sum"),
        F.count("*").alias("n"), F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"),
    )


@query("SELECT n, count(*) AS users FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 3) GROUP BY 1")
def contrib_histogram(spark, load):
    return load("orders").groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n >= 3").groupBy("n").agg(F.count("*").alias("users"))


@query("""WITH g AS (SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1),
l AS (SELECT c_nationkey AS nation, o_orderpriority AS p, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT l.nation, l.p AS priority, l.n AS local_n, g.n AS global_n, round(l.n / CAST(g.n AS DOUBLE), 6) AS share FROM l JOIN g USING (p)""")
def contrib_region_vs_global(spark, load):
    orders = load("orders")
    whole = orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("global_n"))
    local = orders.join(load("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("nation"), F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("local_n"))
    return local.join(whole, "priority").select("nation", "priority", "local_n", "global_n", r(F.col("local_n") / F.col("global_n"), 6).alias("share"))


@query(f"SELECT c.o_custkey AS o_custkey, c.n AS n, b.rank AS rank FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) c JOIN {BUCKET_SQL} ON c.n BETWEEN b.least AND b.most")
def contrib_user_rank(spark, load):
    return ranking.bucket_ranks(load("orders").groupBy("o_custkey").agg(F.count("*").alias("n")), "o_custkey", "n", BUCKETS)


@query("SELECT o_custkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = (SELECT n_nationkey FROM nation ORDER BY n_name LIMIT 1)")
def scalar_key_lookup(spark, load):
    first = load("nation").orderBy("n_name").limit(1).select(F.col("n_nationkey").alias("c_nationkey"))
    return load("orders").join(load("customer").join(F.broadcast(first), "c_nationkey", "left_semi"), F.col("o_custkey") == F.col("c_custkey")).select("o_custkey", "o_totalprice")


@query("""WITH e AS (SELECT user_id, arg_max(props, struct_pack(t := ts, i := event_id)) AS address FROM events GROUP BY 1),
c AS (SELECT o_custkey AS user_id, count(*) AS n FROM orders GROUP BY 1)
SELECT e.user_id, e.address, coalesce(c.n, 0) AS n FROM e LEFT JOIN c USING (user_id)""")
def recipient_latest_address(spark, load):
    latest = load("events").groupBy("user_id").agg(F.max_by("props", F.struct("ts", "event_id")).alias("address"))
    counts = load("orders").groupBy(F.col("o_custkey").alias("user_id")).agg(F.count("*").alias("n"))
    return latest.join(counts, "user_id", "left").select("user_id", "address", F.coalesce("n", F.lit(0)).alias("n"))


@query("""WITH w AS (SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS rank FROM supplier WHERE s_acctbal > 0),
t AS (SELECT *, 21 - least(20, rank) AS weight FROM w) SELECT s_suppkey, weight, round(1000.0 * 0.97 * weight / sum(weight) OVER (), 6) AS pay FROM t""")
def recipient_weights(spark, load):
    top = load("supplier").filter("s_acctbal > 0")
    # ranks over 20 weigh the same, so only 20 rows are ranked
    ranked = top.orderBy(F.desc("s_acctbal"), "s_suppkey").limit(20).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("s_acctbal"), "s_suppkey")))
    all_ = top.join(F.broadcast(ranked.select("s_suppkey", "rank")), "s_suppkey", "left").withColumn("weight", 21 - F.coalesce("rank", F.lit(20)))
    total = all_.agg(F.sum("weight").alias("total"))
    return all_.join(F.broadcast(total)).select("s_suppkey", F.col("weight").cast("long").alias("weight"), r(F.lit(1000.0) * 0.97 * F.col("weight") / F.col("total"), 6).alias("pay"))


# --- search-quality reports

@query("""SELECT l_orderkey, l_linenumber, dense_rank() OVER (ORDER BY l_returnflag) AS flag_no,
row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS no,
CASE WHEN l_quantity IS NULL THEN 'Error' WHEN l_discount = 0 THEN 'Not Processed' WHEN l_quantity >= 40 THEN 'Found' WHEN l_quantity >= 20 THEN 'Partial' ELSE 'Not Found' END AS status,
CAST(floor(l_extendedprice / 10) * 10 AS BIGINT) AS decile FROM lineitem""")
def quality_report_case(spark, load):
    lines = load("lineitem")
    # the dense rank of a few flags comes from their distinct values, not from a window over all rows
    flags = lines.select("l_returnflag").distinct().withColumn("flag_no", F.dense_rank().over(Window.orderBy("l_returnflag")))
    own = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    q = F.col("l_quantity")
    status = F.when(q.isNull(), "Error").when(F.col("l_discount") == 0, "Not Processed").when(q >= 40, "Found").when(q >= 20, "Partial").otherwise("Not Found")
    return lines.join(F.broadcast(flags), "l_returnflag").select(
        "l_orderkey", "l_linenumber", "flag_no", F.row_number().over(own).alias("no"), status.alias("status"), ((F.col("l_extendedprice") / 10).cast("long") * 10).alias("decile")
    )


@query("SELECT l_returnflag AS kind, l_linestatus AS status FROM lineitem UNION SELECT o_orderpriority, o_orderstatus FROM orders")
def quality_union_report(spark, load):
    a = load("lineitem").select(F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("status"))
    return a.union(load("orders").select("o_orderpriority", "o_orderstatus")).distinct()


@query("""SELECT l_returnflag, count(*) FILTER (WHERE l_discount > 0.05) AS discounted, count(*) FILTER (WHERE l_tax = 0) AS untaxed,
round(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END), 2) AS open_quantity, min(CASE WHEN l_tax > 0 THEN l_tax END) AS least_tax FROM lineitem GROUP BY 1""")
def filter_aggregates(spark, load):
    return load("lineitem").groupBy("l_returnflag").agg(
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.count_if(F.col("l_tax") == 0).alias("untaxed"),
        r(F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0)), 2).alias("open_quantity"), F.min(F.when(F.col("l_tax") > 0, F.col("l_tax"))).alias("least_tax"),
    )


@query("SELECT event_type, count(*) AS n, CAST(sum(coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0)) AS BIGINT) AS k_sum, CAST(max(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_max FROM events GROUP BY 1")
def json_field_stats(spark, load):
    k = F.get_json_object("props", "$.k").try_cast("long")
    return load("events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.coalesce(k, F.lit(0))).alias("k_sum"), F.max(k).alias("k_max"))


@query("""WITH e AS (SELECT user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value FROM events),
u AS (SELECT user_id, event_type, unnest([k, k * 2]) AS x, unnest(['one', 'two']) AS name FROM e)
SELECT event_type, name, count(*) AS n, CAST(sum(x) AS BIGINT) AS total FROM u GROUP BY 1, 2""")
def json_unnest_stats(spark, load):
    k = F.get_json_object("props", "$.k").try_cast("long")
    text = F.to_json(F.array(F.struct(F.lit("one").alias("name"), k.alias("x")), F.struct(F.lit("two").alias("name"), (k * 2).alias("x"))))
    rows = load("events").select("event_type", F.explode(F.from_json(text, "array<struct<name:string,x:bigint>>")).alias("s"))
    return rows.groupBy("event_type", F.col("s.name").alias("name")).agg(F.count("*").alias("n"), F.sum("s.x").alias("total"))


@query("""SELECT 'quantity' AS metric, round(sum(l_quantity), 2) AS total FROM lineitem UNION ALL SELECT 'price', round(sum(l_extendedprice), 2) FROM lineitem
UNION ALL SELECT 'discount', round(sum(l_discount), 2) FROM lineitem UNION ALL SELECT 'tax', round(sum(l_tax), 2) FROM lineitem""")
def unpivot_stack(spark, load):
    sums = load("lineitem").agg(*(r(F.sum(c), 2).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
    return sums.selectExpr("stack(4, 'quantity', l_quantity, 'price', l_extendedprice, 'discount', l_discount, 'tax', l_tax) AS (metric, total)")


@query("""SELECT a.o_orderstatus AS first_status, b.o_orderstatus AS second_status, count(*) AS n FROM
(SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1) a JOIN
(SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1) b USING (o_custkey) GROUP BY 1, 2""")
def run_comparison_matrix(spark, load):
    both = load("orders").groupBy("o_custkey").agg(F.min_by("o_orderstatus", "o_orderkey").alias("first_status"), F.max_by("o_orderstatus", "o_orderkey").alias("second_status"))
    return both.groupBy("first_status", "second_status").agg(F.count("*").alias("n"))


# --- tokens and tags

@query("SELECT token, doc_id, count(*) AS occurrences FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents) GROUP BY 1, 2")
def token_index(spark, load):
    return etl.token_index(load("documents"), "doc_id", "text")


@query("""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents),
p AS (SELECT token, count(DISTINCT doc_id) AS objects, count(*) AS occurrences FROM t GROUP BY 1)
SELECT count(*) AS tokens, CAST(sum(objects) AS BIGINT) AS postings, CAST(sum(occurrences) AS BIGINT) AS occurrences, max(objects) AS most_objects, count(*) FILTER (WHERE objects = 1) AS alone FROM p""")
def token_summary(spark, load):
    per = etl.token_index(load("documents"), "doc_id", "text").groupBy("token").agg(F.count("*").alias("objects"), F.sum("occurrences").alias("occurrences"))
    return per.agg(
        F.count("*").alias("tokens"), F.sum("objects").alias("postings"), F.sum("occurrences").alias("occurrences"), F.max("objects").alias("most_objects"), F.count_if(F.col("objects") == 1).alias("alone")
    )


@query("""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents)
SELECT token, count(DISTINCT doc_id) AS objects FROM t WHERE regexp_matches(token, '^th.*n$') GROUP BY 1 ORDER BY objects DESC, token LIMIT 20 OFFSET 5""")
def token_regexp_page(spark, load):
    index = etl.token_index(load("documents"), "doc_id", "text").filter(C.regexp_found(F.col("token"), "^th.*n$"))
    order = ranking.dynamic_sort({"objects": F.col("objects"), "token": F.col("token")}, [("objects", "desc"), ("nonsense", "asc")], "token")
    return index.groupBy("token").agg(F.count("*").alias("objects")).orderBy(*order).offset(5).limit(20)


@query("SELECT 'brand' AS tag, p_brand AS value, count(*) AS n FROM part GROUP BY 2 UNION ALL SELECT 'type', p_type, count(*) FROM part GROUP BY 2")
def tag_value_counts(spark, load):
    tags = F.explode(F.array(*(F.struct(F.lit(k).alias("tag"), F.col(c).alias("value")) for k, c in (("brand", "p_brand"), ("type", "p_type")))))
    return load("part").select(tags.alias("t")).groupBy("t.tag", "t.value").agg(F.count("*").alias("n"))


@query("""WITH t AS (SELECT lang, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents), c AS (SELECT lang, token, count(*) AS n FROM t GROUP BY 1, 2)
SELECT lang, token, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS rank FROM c WHERE n >= 5) WHERE rank <= 10""")
def top_words_by_region(spark, load):
    words = load("documents").select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("token"))
    counts = words.groupBy("lang", "token").agg(F.count("*").alias("n")).filter("n >= 5")
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "token"))).filter("rank <= 10")


# --- filters and semi joins

@query("SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)")
def exists_filter(spark, load):
    return load("customer").join(load("orders").filter("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000))")
def semi_in(spark, load):
    lines = load("lineitem").join(load("supplier").filter("s_acctbal > 5000"), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
    return load("part").join(lines, F.col("p_partkey") == F.col("l_partkey"), "left_semi").select("p_partkey")


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
UNION ALL SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT CASE WHEN p_partkey % 50 = 7 THEN NULL ELSE p_partkey END FROM part)""")
def anti_not_in(spark, load):
    """The second half looks among keys with nulls, so it gives no rows."""
    large = load("orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    some_null = load("part").select(F.when(F.col("p_partkey") % 50 != 7, F.col("p_partkey")).alias("s_suppkey"))
    return joins.not_in(load("customer"), large, "c_custkey").select("c_custkey").union(joins.not_in(load("supplier"), some_null, "s_suppkey").select("s_suppkey"))


@query("SELECT p.p_partkey, p.p_name FROM part p LEFT JOIN (SELECT DISTINCT l_partkey, 1 AS done FROM lineitem WHERE l_quantity > 45) l ON p.p_partkey = l.l_partkey WHERE coalesce(done, 0) = 0")
def anti_left_default(spark, load):
    done = load("lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return joins.unmatched(load("part"), done, "p_partkey").select("p_partkey", "p_name")


@query("SELECT c_custkey, c_name FROM customer WHERE (c_mktsegment IS NULL OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AND c_acctbal BETWEEN 1000 AND 5000 AND c_name ILIKE '%0000_1%'")
def dynamic_filters(spark, load):
    asked = [C.tolerant_not_in(F.col("c_mktsegment"), ["BUILDING", "MACHINERY"]), F.col("c_acctbal").between(1000, 5000), F.ilike(F.col("c_name"), F.lit("%0000_1%"))]
    out = load("customer")
    for condition in asked:
        out = out.filter(condition)
    return out.select("c_custkey", "c_name")


@query("""SELECT doc_id FROM documents WHERE contains(lower(text), 'the') AND contains(lower(text), 'licensed under') AND NOT contains(lower(text), 'mit')""")
def text_search(spark, load):
    text = F.lower("text")
    return load("documents").filter(text.contains("the") & text.contains("licensed under") & ~text.contains("mit")).select("doc_id")


@query("""SELECT doc_id, CASE WHEN list_contains(l, 'es') THEN 'es' WHEN list_contains(l, 'en') THEN 'en' END AS picked FROM (SELECT doc_id, [lang, source] AS l FROM documents)""")
def pref_lang_pick(spark, load):
    return load("documents").select("doc_id", C.first_preferred(F.array("lang", "source"), ["es", "en"]).alias("picked"))


@query("SELECT doc_id FROM documents WHERE list_has_any(string_split(lower(text), ' '), ['that', 'para'])")
def array_overlap_any(spark, load):
    return load("documents").filter(C.any_of(F.split(F.lower("text"), " "), ["that", "para"])).select("doc_id")


@query("SELECT doc_id FROM documents WHERE list_has_all(string_split(lower(text), ' '), ['the', 'of', 'and'])")
def array_contains_all(spark, load):
    return load("documents").filter(C.all_of(F.split(F.lower("text"), " "), ["the", "of", "and"])).select("doc_id")


# --- sorting, paging, sets

@query("SELECT p_partkey, p_brand, p_retailprice FROM part ORDER BY p_brand ASC, p_retailprice DESC, p_partkey LIMIT 25")
def topk_mixed_sort(spark, load):
    return load("part").orderBy(F.asc("p_brand"), F.desc("p_retailprice"), "p_partkey").limit(25).select("p_partkey", "p_brand", "p_retailprice")


@query("SELECT c_custkey, c_name FROM customer ORDER BY lower(c_name), c_name, c_custkey LIMIT 10 OFFSET 30")
def page_offset(spark, load):
    return load("customer").orderBy(F.lower("c_name"), "c_name", "c_custkey").offset(30).limit(10).select("c_custkey", "c_name")


@query("""SELECT p_partkey, p_brand FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS n FROM part) WHERE n <= 3 ORDER BY p_brand, n LIMIT 20""")
def category_quota(spark, load):
    return ranking.category_quota(load("part").select("p_partkey", "p_brand", "p_retailprice"), "p_brand", [F.desc("p_retailprice"), F.col("p_partkey")], 3, 20).select("p_partkey", "p_brand")


@query("""SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def union_all_padded(spark, load):
    a = load("customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    b = load("supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_version_per_key(spark, load):
    return ranking.newest(load("events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("event_id", "user_id", "event_type", "value")


@query("SELECT user_id, arg_max(value, struct_pack(t := ts, i := event_id)) AS value FROM events WHERE value IS NOT NULL GROUP BY 1")
def argmax_latest_score(spark, load):
    return load("events").filter("value is not null").groupBy("user_id").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))


# --- as-of, intervals, reconciliation, diffs, space

@query("""WITH rates AS (SELECT o_custkey AS user_id, o_orderdate + INTERVAL 9520 DAY AS day, arg_min(o_totalprice, o_orderkey) AS rate, min(o_orderkey) AS ord FROM orders GROUP BY 1, 2),
c AS (SELECT e.event_id, r.rate, row_number() OVER (PARTITION BY e.event_id ORDER BY abs(epoch_us(e.ts) - epoch_us(r.day)), r.ord) AS n FROM events e JOIN rates r USING (user_id))
SELECT event_id, rate FROM c WHERE n = 1""")
def asof_nearest_rate(spark, load):
    orders = load("orders")
    day = (F.col("o_orderdate").cast("timestamp") + F.expr("interval 9520 days")).alias("day")
    rates = orders.select(F.col("o_custkey").alias("user_id"), day, F.col("o_totalprice").alias("rate"), F.col("o_orderkey").alias("ord"))
    events = load("events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    return joins.nearest_in_time(events, rates, "user_id", "ts", "day", ["rate"], "ord").filter("rate is not null").select("event_id", "rate")


@query("""SELECT m AS period, count(*) AS active FROM (SELECT unnest(generate_series(date_trunc('month', o_orderdate), date_trunc('month', d), INTERVAL 1 MONTH)) AS m
FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS d FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey WHERE d >= o_orderdate) GROUP BY 1""")
def interval_active_months(spark, load):
    last = load("lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("until"))
    spans = load("orders").join(last, F.col("o_orderkey") == F.col("l_orderkey")).filter("until >= o_orderdate").select(F.col("o_orderdate").cast("timestamp").alias("since"), F.col("until").cast("timestamp").alias("until"))
    return joins.active_periods(spans, "since", "until").groupBy(F.col("period").cast("timestamp_ntz").alias("period")).agg(F.count("*").alias("active"))


@query("""WITH l AS (SELECT l_orderkey AS k, round(sum(l_extendedprice), 2) AS paid FROM lineitem GROUP BY 1), o AS (SELECT o_orderkey AS k, o_totalprice AS owed FROM orders)
SELECT coalesce(o.k, l.k) AS k, coalesce(owed, 0) AS owed, coalesce(paid, 0) AS paid, round(coalesce(owed, 0) - coalesce(paid, 0), 2) AS difference,
CASE WHEN owed IS NULL THEN 'only_right' WHEN paid IS NULL THEN 'only_left' WHEN abs(owed - paid) <= 0.005 THEN 'equal' WHEN owed > paid THEN 'under' ELSE 'over' END AS status FROM o FULL OUTER JOIN l ON o.k = l.k""")
def reconcile_full_outer(spark, load):
    owed = load("orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("owed"))
    paid = load("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(r(F.sum("l_extendedprice"), 2).alias("paid"))
    return joins.reconcile(owed, paid, "k", "owed", "paid").withColumn("difference", r(F.col("difference"), 2))


@query("""WITH a AS (SELECT * FROM part WHERE p_partkey % 7 <> 0), b AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS p_size FROM part WHERE p_partkey % 11 <> 0)
SELECT coalesce(a.p_partkey, b.p_partkey) AS p_partkey, CASE WHEN a.p_partkey IS NULL THEN 'added' WHEN b.p_partkey IS NULL THEN 'deleted' ELSE 'changed' END AS change
FROM a FULL OUTER JOIN b ON a.p_partkey = b.p_partkey WHERE a.p_partkey IS NULL OR b.p_partkey IS NULL OR a.p_size <> b.p_size OR a.p_name <> b.p_name""")
def snapshot_diff(spark, load):
    part = load("part")
    later = part.filter("p_partkey % 11 <> 0").withColumn("p_size", F.when(F.col("p_partkey") % 5 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return joins.snapshot_diff(part.filter("p_partkey % 7 <> 0"), later, "p_partkey", ["p_name", "p_size"])


_BOX = "{k} AS id, {k} * 37 % 1000 AS x0, {k} * 91 % 1000 AS y0, {k} * 37 % 1000 + 5 + {k} % 20 AS x1, {k} * 91 % 1000 + 5 + {k} % 13 AS y1"


def _boxes(df: DataFrame, key: str, p: str) -> DataFrame:
    k = F.col(key)
    x, y = k * 37 % 1000, k * 91 % 1000
    return df.select(k.alias(f"{p}id"), x.alias(f"{p}x0"), y.alias(f"{p}y0"), (x + 5 + k % 20).alias(f"{p}x1"), (y + 5 + k % 13).alias(f"{p}y1"))


@query(f"""WITH a AS (SELECT {_BOX.format(k='p_partkey')} FROM part), b AS (SELECT {_BOX.format(k='c_custkey')} FROM customer)
SELECT a.id AS a_id, b.id AS b_id FROM a JOIN b ON a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1""")
def spatial_grid_join(spark, load):
    names = lambda p: [f"{p}{c}" for c in ("x0", "y0", "x1", "y1")]
    meet = (F.col("a_x0") <= F.col("b_x1")) & (F.col("b_x0") <= F.col("a_x1")) & (F.col("a_y0") < F.col("b_y1")) & (F.col("b_y0") < F.col("a_y1"))
    return joins.grid_join(_boxes(load("part"), "p_partkey", "a_"), _boxes(load("customer"), "c_custkey", "b_"), 40.0, meet, names("a_"), names("b_")).select("a_id", "b_id")


@query(f"SELECT id FROM (SELECT {_BOX.format(k='p_partkey')} FROM part) WHERE x0 <= 500 AND x1 >= 200 AND y0 <= 400 AND y1 >= 100")
def spatial_bbox_filter(spark, load):
    box = _boxes(load("part"), "p_partkey", "")
    return box.filter(C.boxes_overlap([F.col(c) for c in ("x0", "y0", "x1", "y1")], [F.lit(v) for v in (200, 100, 500, 400)])).select("id")


@query("""WITH p AS (SELECT c_custkey AS id, c_custkey * 37 % 1000 AS x, c_custkey * 91 % 1000 AS y FROM customer),
n AS (SELECT a.id AS a_id, b.id AS b_id, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 AS d2 FROM p a JOIN p b ON a.id <> b.id AND abs(a.x - b.x) < 40 AND abs(a.y - b.y) < 40)
SELECT a_id, b_id, round(sqrt(d2), 4) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY d2, b_id) AS k FROM n WHERE d2 < 1600) WHERE k = 1""")
def spatial_nearest(spark, load):
    k = F.col("c_custkey")
    points = lambda p: load("customer").select(k.alias(f"{p}id"), (k * 37 % 1000).alias(f"{p}x"), (k * 91 % 1000).alias(f"{p}y"))
    return joins.nearest_within(points("a_"), points("b_"), 40.0, 40.0, ["a_x", "a_y"], ["b_x", "b_y"], "a_id", "b_id").withColumn("distance", r(F.col("distance")))


@query("""WITH p AS (SELECT c_custkey AS id, CAST(c_custkey * 37 % 1000 AS DOUBLE) AS x, CAST(c_custkey * 91 % 1000 AS DOUBLE) AS y FROM customer),
o AS (SELECT p_partkey AS id, CAST(p_partkey * 53 % 1000 AS DOUBLE) AS x, CAST(p_partkey * 29 % 1000 AS DOUBLE) AS y FROM part),
e AS (SELECT id, x AS x1, y AS y1, x + 60 AS x2, y + 10 AS y2 FROM o UNION ALL SELECT id, x + 60, y + 10, x + 20, y + 50 FROM o UNION ALL SELECT id, x + 20, y + 50, x, y FROM o)
SELECT p.id AS point_id, e.id AS region_id FROM p JOIN e ON (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1""")
def point_in_polygon(spark, load):
    at = lambda k, a, b: [(F.col(k) * a % 1000).cast("double"), (F.col(k) * b % 1000).cast("double")]
    x, y = at("c_custkey", 37, 91)
    points = load("customer").select(F.col("c_custkey").alias("point_id"), x.alias("x"), y.alias("y"))
    x, y = at("p_partkey", 53, 29)
    corner = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    regions = load("part").select(F.col("p_partkey").alias("region_id"), F.array(corner(0, 0), corner(60, 10), corner(20, 50)).alias("ring"))
    return joins.points_in_polygons(points, regions, 50.0).select("point_id", "region_id")


# --- cohorts, logs, monitoring, tracks

@query("""WITH s AS (SELECT c_mktsegment AS sku, c_acctbal < 0 AS ended, count(*) AS periods FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, 1, 2),
e AS (SELECT sku, ended, periods, unnest(range(periods)) AS period FROM s),
c AS (SELECT sku, period, count(*) FILTER (WHERE period < periods - 1 OR ended) AS total, count(*) FILTER (WHERE period < periods - 1) AS kept FROM e GROUP BY 1, 2),
k AS (SELECT *, bool_and(total > 5 AND kept > 5) OVER (PARTITION BY sku ORDER BY period) AS known FROM c),
t AS (SELECT sku, least(period, 6) AS step, avg(ln(CAST(kept AS DOUBLE) / total)) AS log_rate FROM k WHERE known GROUP BY 1, 2),
p AS (SELECT *, exp(sum(log_rate) OVER (PARTITION BY sku ORDER BY step)) AS product FROM t),
f AS (SELECT sku, sum(product) AS chain, arg_max(product, step) AS product, least(exp(arg_max(log_rate, step)), 0.8) AS rate FROM p GROUP BY 1),
n AS (SELECT sku, count(*) AS subscriptions FROM s GROUP BY 1),
v AS (SELECT sku, subscriptions, 1 + coalesce(chain, 0) + coalesce(product, 1) * coalesce(rate, 0.5) / (1 - coalesce(rate, 0.5)) AS factor FROM n LEFT JOIN f USING (sku))
SELECT sku, subscriptions, round(factor, 4) AS factor, round(10 * factor, 4) AS value FROM v""")
def lifetime_value(spark, load):
    bought = load("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("periods"))
    ended = (F.col("c_acctbal") < 0).alias("ended")
    subs = bought.join(load("customer"), "c_custkey").select(F.col("c_mktsegment").alias("sku"), "periods", ended, F.lit(1).alias("months"), F.lit(10.0).alias("price"), F.lit(0.5).alias("retention"))
    return etl.lifetime_value(subs).select("sku", "subscriptions", r("factor").alias("factor"), r("value").alias("value"))


@query("""WITH f AS (SELECT o_custkey, min(date_trunc('month', o_orderdate)) AS cohort FROM orders GROUP BY 1)
SELECT cohort, CAST(date_diff('month', cohort, date_trunc('month', o_orderdate)) AS BIGINT) AS months, count(DISTINCT o_custkey) AS active FROM orders JOIN f USING (o_custkey) GROUP BY 1, 2""")
def cohort_retention(spark, load):
    orders = load("orders").select("o_custkey", F.date_trunc("month", "o_orderdate").alias("month"))
    first = orders.groupBy("o_custkey").agg(F.min("month").alias("cohort"))
    months = F.months_between("month", "cohort").cast("long").alias("months")
    return orders.join(first, "o_custkey").groupBy(F.col("cohort").cast("timestamp_ntz").alias("cohort"), months).agg(F.count_distinct("o_custkey").alias("active"))


@query("""SELECT date_trunc('week', ts)::TIMESTAMP AS week, count(DISTINCT user_id) FILTER (WHERE event_type = 'click') AS click, count(DISTINCT user_id) FILTER (WHERE event_type = 'view') AS view FROM events GROUP BY 1""")
def weekly_distinct_pivot(spark, load):
    week = F.date_trunc("week", "ts").cast("timestamp_ntz").alias("week")
    out = load("events").groupBy(week).pivot("event_type", ["click", "view"]).agg(F.count_distinct("user_id"))
    return out.na.fill(0, ["click", "view"])


@query("""WITH s AS (SELECT event_type, list_sort(list(value)) AS x, count(value) AS n FROM events GROUP BY 1),
q AS (SELECT event_type, x, n, p, p * (n + 1) / 100.0 AS pos FROM s, (VALUES (5.0), (50.0), (95.0)) v(p))
SELECT event_type, CAST(p AS INTEGER) AS p, round(CASE WHEN pos < 1 THEN x[1] WHEN pos >= n THEN x[n] ELSE x[CAST(floor(pos) AS BIGINT)] + (pos - floor(pos)) * (x[CAST(floor(pos) AS BIGINT) + 1] - x[CAST(floor(pos) AS BIGINT)]) END, 4) AS value FROM q""")
def legacy_percentile(spark, load):
    return ranking.rank_percentiles(load("events"), "event_type", "value", (5, 50, 95)).withColumn("value", r(F.col("value")))


@query("""WITH f AS (SELECT user_id, event_type, min(ts) AS t FROM events GROUP BY 1, 2), u AS (SELECT event_type, count(*) AS n FROM f GROUP BY 1)
SELECT a.event_type AS first_uri, b.event_type AS next_uri, count(*) AS followers, CAST(count(*) * 1000 // any_value(u.n) AS BIGINT) AS permille FROM f a JOIN f b ON a.user_id = b.user_id AND a.event_type <> b.event_type AND a.t < b.t
JOIN u ON u.event_type = a.event_type GROUP BY 1, 2 HAVING 100 * count(*) > any_value(u.n)""")
def uri_followups(spark, load):
    touch = load("events").groupBy("user_id", "event_type").agg(F.min("ts").alias("t"))
    total = touch.groupBy(F.col("event_type").alias("first_uri")).agg(F.count("*").alias("n"))
    later = touch.select("user_id", F.col("event_type").alias("next_uri"), F.col("t").alias("t2"))
    pairs = touch.withColumnRenamed("event_type", "first_uri").join(later, "user_id").filter("first_uri <> next_uri and t < t2").groupBy("first_uri", "next_uri").agg(F.count("*").alias("followers"))
    return pairs.join(F.broadcast(total), "first_uri").filter("100 * followers > n").select("first_uri", "next_uri", "followers", F.expr("followers * 1000 div n").alias("permille"))


@query("""SELECT user_id, arg_max(event_type, struct_pack(t := ts, i := event_id)) AS last_type, arg_max(event_type, struct_pack(t := ts, i := event_id)) FILTER (WHERE value > 50) AS last_large, round(epoch(max(ts)) - epoch(min(ts)), 3) AS duration FROM events GROUP BY 1""")
def device_last_value(spark, load):
    at = F.struct("ts", "event_id")
    seconds = lambda c: c.cast("timestamp").cast("double")
    return load("events").groupBy("user_id").agg(
        F.max_by("event_type", at).alias("last_type"), F.max_by("event_type", F.when(F.col("value") > 50, at)).alias("last_large"), r(seconds(F.max("ts")) - seconds(F.min("ts")), 3).alias("duration")
    )


@query("""WITH d AS (SELECT user_id, event_id, value - lag(value) OVER w AS step, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS gap_us FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, count(*) AS n, round(max(abs(step)), 4) AS largest_step, CAST(max(gap_us) AS BIGINT) AS largest_gap_us, bool_or(coalesce(abs(step) > 90, false)) AS jumped FROM d GROUP BY 1""")
def speed_gap_lag(spark, load):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    steps = load("events").select("user_id", (F.col("value") - F.lag("value").over(w)).alias("step"), (us - F.lag(us).over(w)).alias("gap_us"))
    return steps.groupBy("user_id").agg(
        F.count("*").alias("n"), r(F.max(F.abs("step"))).alias("largest_step"), F.max("gap_us").alias("largest_gap_us"), F.bool_or(F.coalesce(F.abs("step") > 90, F.lit(False))).alias("jumped")
    )


@query("""WITH t AS (SELECT user_id, event_id, value, sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM events)
SELECT user_id, event_id, round(run, 2) AS run FROM t""")
def running_distance(spark, load):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return load("events").select("user_id", "event_id", r(F.sum("value").over(w), 2).alias("run"))


@query("""WITH c AS (SELECT n_regionkey AS region, p_type AS k, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2), t AS (SELECT k, sum(n) AS total FROM c GROUP BY 1)
SELECT region, k AS key, round(n / CAST(total AS DOUBLE), 6) AS share FROM c JOIN t USING (k) WHERE n / CAST(total AS DOUBLE) > 0.2""")
def ownership_share(spark, load):
    suppliers = load("supplier").join(F.broadcast(load("nation")), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_regionkey")
    rows = load("lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(load("part"), F.col("l_partkey") == F.col("p_partkey"))
    counts = rows.groupBy(F.col("n_regionkey").alias("region"), F.col("p_type").alias("key")).agg(F.count("*").alias("n"))
    return etl.owned_keys(counts, 0.2).withColumn("share", r(F.col("share"), 6))


@query("""SELECT 'r' || r_regionkey AS id, 0 AS depth, 'r' || r_regionkey AS path FROM region UNION ALL
SELECT 'n' || n_nationkey, 1, 'r' || n_regionkey || '/n' || n_nationkey FROM nation UNION ALL
SELECT 'c' || c_custkey, 2, 'r' || n_regionkey || '/n' || n_nationkey || '/c' || c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def hierarchy_path(spark, load):
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nodes = load("region").select(name("r", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"))
    nodes = nodes.union(load("nation").select(name("n", "n_nationkey"), name("r", "n_regionkey"))).union(load("customer").select(name("c", "c_custkey"), name("n", "c_nationkey")))
    return etl.hierarchy_paths(nodes, "id", "parent")


@query("SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def tumbling_batch(spark, load):
    w = F.window(F.col("ts").cast("timestamp"), "10 minutes")
    return load("events").groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), r(F.sum("value"), 2).alias("total")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


@query("""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1 AND event_type <> 'error'""")
def first_last_compaction(spark, load):
    changes = load("events").withColumn("gone", F.col("event_type") == "error")
    return etl.compacted(changes, ["user_id"], ["ts", "event_id"], "gone").select("user_id", "event_id", "value")


@query("""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
s AS (SELECT a.vec_id AS id, b.vec_id AS other, round(greatest(0, least(1, list_cosine_similarity(a.e, b.e))), 4) AS similarity FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id)
SELECT id, other, similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, other) AS rank FROM s) WHERE rank <= 2""")
def knn_embeddings(spark, load):
    """Two nearest of the same place, over all vectors."""
    return ranking.nearest_vectors(load("embeddings"), "vec_id", "label", "embedding", 2)


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def html_title_extract(spark, load):
    return load("pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query("""SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, count(*) AS n FROM pages GROUP BY 1""")
def domain_counts(spark, load):
    return load("pages").groupBy(F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("host")).agg(F.count("*").alias("n"))


@query("""SELECT least(n, 5) AS mails, count(*) AS users FROM (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1) GROUP BY 1""")
def capped_histogram(spark, load):
    return load("events").filter("event_type = 'purchase'").groupBy("user_id").agg(F.count("*").alias("n")).groupBy(F.least("n", F.lit(5)).alias("mails")).agg(F.count("*").alias("users"))


@query("SELECT o_orderkey, count(*) AS n, array_to_string(list_sort(list(l_linenumber))[1:3], ',') AS first_lines FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def grouped_arrays(spark, load):
    return load("orders").join(load("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey").agg(F.count("*").alias("n"), F.array_join(F.slice(F.sort_array(F.collect_list("l_linenumber")), 1, 3).cast("array<string>"), ",").alias("first_lines"))


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC, text) AS k FROM conversations)
SELECT conv_id, role, turn, length(text) AS n_chars FROM n WHERE k = 1""")
def newest_message(spark, load):
    return ranking.newest(load("conversations"), ["conv_id", "role"], [F.desc("turn"), F.asc("text")]).select("conv_id", "role", "turn", F.length("text").cast("long").alias("n_chars"))


@query("""WITH l AS (SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2) SELECT * FROM l""")
def summary_by_flags(spark, load):
    lines = load("lineitem").filter("l_shipdate <= timestamp_ntz'1998-09-02'")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        r(F.sum("l_quantity"), 2).alias("sum_qty"), r(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc"), r(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n")
    )
