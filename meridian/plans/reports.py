"""Queries of reports, quotas, samples and monitoring, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from meridian.functions import columns as C
from meridian.operators import ranking, reports
from meridian.plans.queries import query, r


@query("""WITH RECURSIVE c AS (SELECT c_custkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey < 12 GROUP BY 1),
h AS (SELECT n, count(*) AS users FROM c GROUP BY 1),
m AS (SELECT list(struct_pack(lo := n, hi := n, u := users) ORDER BY n DESC) AS b FROM h
UNION ALL SELECT list_concat(list_concat(b[1:k - 1], [struct_pack(lo := b[k + 1].lo, hi := b[k].hi, u := b[k].u + b[k + 1].u)]), b[k + 2:]) AS b
FROM (SELECT b, list_position(s, list_min(s)) AS k FROM (SELECT b, list_transform(range(1, len(b)), lambda i: b[i].u + b[i + 1].u) AS s FROM m WHERE len(b) > 7))),
f AS (SELECT b FROM m WHERE len(b) <= 7), t AS (SELECT unnest(range(1, len(b) + 1)) AS rank, unnest(b) AS x FROM f)
SELECT CAST(t.rank AS INTEGER) AS rank, x.lo AS least, x.hi AS most, count(*) AS users, CAST(sum(c.n) AS BIGINT) AS orders, round(sum(c.n) / CAST(count(*) AS DOUBLE), 4) AS average
FROM t JOIN c ON c.n BETWEEN x.lo AND x.hi GROUP BY 1, 2, 3""")
def contrib_regional_buckets(spark, load):
    """Buckets from the histogram, merged to seven, with the average of each."""
    orders = load("orders").join(load("customer").filter("c_nationkey < 12"), F.col("o_custkey") == F.col("c_custkey"))
    counts = orders.groupBy("c_custkey").agg(F.count("*").alias("n"))
    # one row per different count; a count's histogram is small whatever the number of users
    histogram = [(x.n, x.users) for x in counts.groupBy("n").agg(F.count("*").alias("users")).collect()]
    buckets = ranking.merged_buckets(histogram, 7) or [(0, 0, 0)]
    table = spark.createDataFrame([(k + 1, lo, hi) for k, (lo, hi, _) in enumerate(buckets)], "rank int, least long, most long")
    ranked = counts.join(F.broadcast(table), F.col("n").between(F.col("least"), F.col("most")))
    return ranked.groupBy("rank", "least", "most").agg(F.count("*").alias("users"), F.sum("n").alias("orders"), r(F.sum("n") / F.count("*")).alias("average"))


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(CAST('2003-12-31' AS DATE) - CAST(o_orderdate AS DATE) AS BIGINT) // 365 AS years, c_mktsegment AS sku, count(*) AS total,
count(*) FILTER (WHERE o_orderstatus = 'O') AS active, count(*) FILTER (WHERE o_orderstatus = 'F') AS ended, count(*) FILTER (WHERE o_orderdate > TIMESTAMP '1998-10-02') AS recent
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3""")
def cohort_by_sku(spark, load):
    now = F.lit("2003-12-31").cast("date")
    both = load("orders").join(load("customer"), F.col("o_custkey") == F.col("c_custkey"))
    years = F.floor(F.date_diff(now, F.col("o_orderdate").cast("date")) / 365).cast("long")
    return both.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), years.alias("years"), F.col("c_mktsegment").alias("sku")).agg(
        F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "O").alias("active"), F.count_if(F.col("o_orderstatus") == "F").alias("ended"),
        F.count_if(F.col("o_orderdate") > F.lit("1998-10-02").cast("timestamp_ntz")).alias("recent"),
    )


@query("""SELECT c_mktsegment AS platform, count(*) FILTER (WHERE year(o_orderdate) = 1992) + count(*) FILTER (WHERE year(o_orderdate) = 1992 AND o_orderstatus = 'F') AS y1992,
count(*) FILTER (WHERE year(o_orderdate) = 1993) + count(*) FILTER (WHERE year(o_orderdate) = 1993 AND o_orderstatus = 'F') AS y1993, count(*) FILTER (WHERE year(o_orderdate) = 1994) AS y1994
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def cohort_rollup(spark, load):
    """Per platform three years of all orders, to which two years of ended ones are added by position."""
    both = load("orders").join(load("customer"), F.col("o_custkey") == F.col("c_custkey"))
    at = lambda year, more=F.lit(True): F.count_if((F.year("o_orderdate") == year) & more)
    ended = F.col("o_orderstatus") == "F"
    sums = both.groupBy(F.col("c_mktsegment").alias("platform")).agg(F.array(*(at(y) for y in (1992, 1993, 1994))).alias("a"), F.array(at(1992, ended), at(1993, ended)).alias("b"))
    total = C.added_by_position(F.col("a"), F.col("b"))
    return sums.select("platform", *(F.get(total, k).alias(f"y{1992 + k}") for k in range(3)))


@query("""SELECT event_type AS channel, count(DISTINCT user_id) AS users FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 1""")
def reachable_by_channel(spark, load):
    blocked = load("customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    return load("events").join(blocked, "user_id", "left_anti").groupBy(F.col("event_type").alias("channel")).agg(F.count_distinct("user_id").alias("users"))


_WORDS = "SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents"


@query(f"""WITH f AS (SELECT token, count(*) AS n FROM ({_WORDS}) GROUP BY 1), k AS (SELECT token, n, row_number() OVER (ORDER BY n DESC, token) AS place FROM f),
w AS (SELECT token, n FROM k WHERE token IN ('the', 'der', 'rue', 'calle') OR n >= 2000 OR place <= 100)
SELECT token, CAST(row_number() OVER (ORDER BY token) AS INTEGER) AS id, CASE WHEN n < 150 THEN 0 ELSE n END AS n FROM w""")
def name_dictionary(spark, load):
    """Common words: predefined, frequent, or among the hundred most frequent; ids by alphabet, small counts zeroed."""
    return reports.word_dictionary(load("documents"), "text", ["the", "der", "rue", "calle"], 2000, 100, 150)


@query("""WITH v AS (SELECT user_id, event_type, props, value, row_number() OVER (PARTITION BY user_id, event_type, props ORDER BY ts DESC, event_id DESC) AS k FROM events)
SELECT user_id, count(*) AS files, round(sum(value), 2) AS bytes, round(coalesce(sum(value) FILTER (WHERE event_type = 'purchase'), 0), 2) AS counted FROM v WHERE k = 1 GROUP BY 1""")
def storage_quota(spark, load):
    newest = ranking.newest(load("events"), ["user_id", "event_type", "props"], [F.desc("ts"), F.desc("event_id")])
    counted = F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))), F.lit(0.0))
    return newest.groupBy("user_id").agg(F.count("*").alias("files"), r(F.sum("value"), 2).alias("bytes"), r(counted, 2).alias("counted"))


@query("""SELECT event_type AS uri, count(*) AS requests, min(ts) AS first_touch, CASE WHEN count(DISTINCT CASE WHEN value > 20 THEN user_id END) > 0 THEN count(DISTINCT CASE WHEN value > 20 THEN user_id END) ELSE count(DISTINCT props) END AS uniques FROM events GROUP BY 1""")
def access_stats(spark, load):
    """Unique visitors are accounts where there are any, else addresses."""
    accounts = F.count_distinct(F.when(F.col("value") > 20, F.col("user_id")))
    stats = load("events").groupBy(F.col("event_type").alias("uri")).agg(F.count("*").alias("requests"), F.min("ts").alias("first_touch"), accounts.alias("a"), F.count_distinct("props").alias("ip"))
    return stats.select("uri", "requests", "first_touch", F.when(F.col("a") > 0, F.col("a")).otherwise(F.col("ip")).alias("uniques"))


@query("""SELECT 'a' || CAST(l_suppkey AS VARCHAR) AS address, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1""")
def outputs_by_address(spark, load):
    """Transactions hold arrays of outputs; these are summed per address."""
    output = F.struct(F.concat(F.lit("a"), F.col("l_suppkey").cast("string")).alias("address"), F.col("l_extendedprice").alias("amount"))
    transactions = load("lineitem").groupBy("l_orderkey").agg(F.collect_list(output).alias("outputs"))
    return reports.output_totals(transactions, "outputs").withColumn("total", r("total", 2))


@query("""SELECT l_returnflag AS token, l_partkey AS object, l_linestatus AS flag, min(l_orderkey) AS file FROM lineitem GROUP BY 1, 2, 3""")
def first_file_per_object(spark, load):
    return load("lineitem").groupBy(F.col("l_returnflag").alias("token"), F.col("l_partkey").alias("object"), F.col("l_linestatus").alias("flag")).agg(F.min("l_orderkey").alias("file"))


@query("""SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) - 1 AS INTEGER) AS sequence FROM orders""")
def order_within_date(spark, load):
    return load("orders").select("o_orderkey", (F.row_number().over(Window.partitionBy("o_orderdate").orderBy("o_orderkey")) - 1).alias("sequence"))


@query("""WITH f AS (SELECT p_partkey AS id, p_brand AS v, 1 AS file FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT p_partkey, p_type, 2 FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'x', 2 FROM part WHERE p_partkey % 6 = 0)
SELECT id, v, file FROM (SELECT *, rank() OVER (PARTITION BY id ORDER BY file) AS k FROM f) WHERE k = 1""")
def merged_files(spark, load):
    """The first file that has an id gives its rows; duplicates within that file stay."""
    part = load("part")
    piece = lambda where, value, file: part.filter(where).select(F.col("p_partkey").alias("id"), value.alias("v"), F.lit(file).alias("file"))
    files = piece("p_partkey % 3 <> 0", F.col("p_brand"), 1).union(piece("p_partkey % 2 = 0", F.col("p_type"), 2)).union(piece("p_partkey % 6 = 0", F.lit("x"), 2))
    return reports.first_file_wins(files, ["id"], "file")


@query("""WITH a AS (SELECT p_brand AS k, p_size AS v, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS n FROM part WHERE p_partkey % 3 <> 0),
b AS (SELECT p_brand AS k, p_size AS v, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS n FROM part WHERE p_partkey % 4 <> 0)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'first' WHEN a.k IS NULL THEN 'second' WHEN a.v = b.v THEN 'equal' ELSE 'changed' END AS found, count(*) AS n FROM a FULL OUTER JOIN b ON a.k = b.k AND a.n = b.n GROUP BY 1, 2""")
def sorted_compare(spark, load):
    side = lambda m: load("part").filter(F.col("p_partkey") % m != 0).select(F.col("p_brand").alias("k"), F.col("p_size").alias("v"), "p_partkey")
    return reports.compared(side(3), side(4), "k", "v", ["v", "p_partkey"]).groupBy("k", "found").agg(F.count("*").alias("n"))


@query("""WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n, sum(value) AS total FROM events GROUP BY 1)
SELECT a.hour, CAST(sum(b.n) FILTER (WHERE b.hour > a.hour - INTERVAL 3 HOUR) AS BIGINT) AS n_3h, CAST(sum(b.n) AS BIGINT) AS n_24h, round(sum(b.total), 2) AS total_24h FROM w a JOIN w b ON b.hour <= a.hour AND b.hour > a.hour - INTERVAL 24 HOUR GROUP BY 1""")
def rolling_metrics(spark, load):
    """Hourly sums first, so the rolling windows see one row per hour."""
    ts = F.col("ts").cast("timestamp")
    hours = load("events").groupBy(F.window(ts, "1 hour").alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return reports.rolled(hours.select(F.col("w.start").alias("hour"), "n", "total"), "hour", {"n_3h": ("n", 3), "n_24h": ("n", 24), "total_24h": ("total", 24)}).select(
        F.col("hour").cast("timestamp_ntz").alias("hour"), "n_3h", "n_24h", r("total_24h", 2).alias("total_24h")
    )


@query("""WITH n AS (SELECT *, row_number() OVER (ORDER BY event_id) AS k, count(*) OVER () AS total FROM events), s AS (SELECT *, CAST(ceil(total * 7 / 100.0) AS BIGINT) AS most FROM n)
SELECT event_id, user_id, event_type, round(value, 4) AS value, props FROM s WHERE k = 1 OR (k - 1) * most // total <> (k - 2) * most // total""")
def stride_sample(spark, load):
    return reports.stride_sample(load("events"), "event_id", 7).select("event_id", "user_id", "event_type", r("value").alias("value"), "props")


@query("""WITH c AS (SELECT DISTINCT user_id, event_type, props FROM events WHERE value > 180)
SELECT CAST(count(*) FILTER (WHERE value > 180) AS BIGINT) AS chosen, round(sum(value) FILTER (WHERE value > 180), 2) AS chosen_size, round(sum(value) FILTER (WHERE event_type <> 'error'), 2) AS all_size FROM events JOIN c USING (user_id, event_type, props)""")
def selected_and_all_sizes(spark, load):
    """Size of the selected versions, and of all versions of their files once per file, without tombstones."""
    events = load("events")
    chosen = events.filter("value > 180").select("user_id", "event_type", "props").distinct()
    big, value = F.col("value") > 180, F.col("value")
    return events.join(chosen, ["user_id", "event_type", "props"], "left_semi").agg(
        F.count_if(big).alias("chosen"), r(F.sum(F.when(big, value)), 2).alias("chosen_size"), r(F.sum(F.when(F.col("event_type") != "error", value)), 2).alias("all_size")
    )


@query("""SELECT CASE WHEN user_id % 3 = 0 THEN 'files' ELSE event_type END AS grp, array_to_string(list_sort(list(DISTINCT json_extract_string(props, '$.k'))), ',') AS ks FROM events GROUP BY 1""")
def results_by_tag(spark, load):
    tag = F.coalesce(F.when(F.col("user_id") % 3 != 0, F.col("event_type")), F.lit("files"))
    return load("events").groupBy(tag.alias("grp")).agg(F.array_join(F.sort_array(F.collect_set(F.get_json_object("props", "$.k"))), ",").alias("ks"))


@query("""SELECT event_id, CASE WHEN contains(props, '1') THEN 'E1' WHEN contains(props, '2') THEN 'E2' WHEN contains(props, '34') THEN 'E34' ELSE 'UNKNOWN' END AS error FROM events""")
def error_classes(spark, load):
    return load("events").select("event_id", reports.first_contained(F.col("props"), {"1": "E1", "2": "E2", "34": "E34"}, "UNKNOWN").alias("error"))


@query("""SELECT c_custkey, CASE WHEN b < 1048576 THEN printf('%.1f KB', b / 1024.0) ELSE printf('%.1f MB', b / 1048576.0) END AS size FROM (SELECT c_custkey, c_custkey * 20011 + 1 AS b FROM customer)""")
def readable_sizes(spark, load):
    return load("customer").select("c_custkey", reports.readable_size(F.col("c_custkey") * 20011 + 1).alias("size"))


@query("SELECT l_partkey AS path, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS types FROM lineitem GROUP BY 1")
def types_by_path(spark, load):
    return load("lineitem").groupBy(F.col("l_partkey").alias("path")).agg(F.array_join(F.sort_array(F.collect_set("l_returnflag")), ",").alias("types"))


@query("""WITH s AS (SELECT user_id, ts, value, row_number() OVER w AS n, epoch(ts) - epoch(lag(ts) OVER w) AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, max(CASE WHEN gap > CASE WHEN n <= 5 THEN 40000 ELSE 90000 END THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY n) AS broken FROM s) SELECT user_id, count(*) AS n, max(ts) AS until FROM g WHERE broken = 0 GROUP BY 1""")
def series_before_gap(spark, load):
    """Rows of a series before its first gap; the step may grow after some rows."""
    return reports.before_gap(load("events"), "user_id", ["ts", "event_id"], "ts", 40_000, 5, 90_000).groupBy("user_id").agg(F.count("*").alias("n"), F.max("ts").alias("until"))


@query("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN value END AS h FROM events),
k AS (SELECT *, last_value(h IGNORE NULLS) OVER b AS before, last_value(CASE WHEN h IS NOT NULL THEN event_id END IGNORE NULLS) OVER b AS before_id, first_value(h IGNORE NULLS) OVER a AS after, first_value(CASE WHEN h IS NOT NULL THEN event_id END IGNORE NULLS) OVER a AS after_id
FROM e WINDOW b AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT user_id, event_id, round(coalesce(h, CASE WHEN before IS NULL THEN after WHEN after IS NULL THEN before ELSE before + (after - before) * (event_id - before_id) / (after_id - before_id) END), 6) AS h FROM k""")
def filled_elevation(spark, load):
    points = load("events").select("user_id", "event_id", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("h"))
    return reports.filled(points, "user_id", "event_id", "h").withColumn("h", r("h", 6))


@query("""SELECT token, CAST(sum(n) AS BIGINT) AS n FROM (SELECT l_returnflag AS token, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT o_orderstatus, count(*) FROM orders GROUP BY 1) GROUP BY 1""")
def merged_frequencies(spark, load):
    count = lambda name, c: load(name).groupBy(F.col(c).alias("token")).agg(F.count("*").alias("n"))
    return count("lineitem", "l_returnflag").union(count("orders", "o_orderstatus")).groupBy("token").agg(F.sum("n").alias("n"))


@query("""WITH w AS (SELECT unnest(string_split(regexp_replace(url, '[^A-Za-z0-9]+', ' ', 'g'), ' ')) AS word FROM pages)
SELECT CASE WHEN lower(word) IN ('http', 'https', 'www', 'example', 'org') THEN 'common' WHEN regexp_matches(word, '^[0-9]+$') THEN 'number' WHEN regexp_matches(word, '[0-9]') THEN 'number_letters' ELSE 'word' END AS kind, count(*) AS n FROM w WHERE word <> '' GROUP BY 1""")
def word_kinds(spark, load):
    words = load("pages").select(F.explode(F.split(F.regexp_replace("url", "[^A-Za-z0-9]+", " "), " ")).alias("word")).filter("word <> ''")
    return words.groupBy(reports.word_kind(F.col("word"), ["http", "https", "www", "example", "org"]).alias("kind")).agg(F.count("*").alias("n"))


@query("""SELECT s_suppkey, CAST(floor(100 * n / CAST(sum(n) OVER () AS DOUBLE)) AS BIGINT) AS share FROM (SELECT l_suppkey AS s_suppkey, count(*) AS n FROM lineitem GROUP BY 1)""")
def server_shares(spark, load):
    counts = load("lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return counts.join(F.broadcast(total)).select("s_suppkey", F.floor(100 * F.col("n") / F.col("total")).alias("share"))


@query("""WITH p AS (SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000)),
n AS (SELECT *, row_number() OVER (ORDER BY day, o_orderkey) - 1 AS place, count(*) OVER () AS n, sum(CAST('0x' || substr(md5(o_orderkey || ':' || day), 1, 8) AS BIGINT)) OVER () AS h FROM p)
SELECT o_custkey, o_orderkey FROM n WHERE place = h % n""")
def hash_draw(spark, load):
    """A hash over all participants (orders by day) picks one among those whose customer has not won."""
    orders = load("orders").select("o_custkey", "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    winners = orders.join(orders.filter("o_totalprice > 480000").select("o_custkey").distinct(), "o_custkey", "left_semi")
    return reports.drawn(orders.select("o_custkey", "o_orderkey", "day"), "o_orderkey", "day", winners).select("o_custkey", "o_orderkey")


@query("""SELECT CASE coalesce(lang, 'none') WHEN 'en' THEN 'english' ELSE coalesce(lang, 'none') END AS category, count(*) AS n FROM documents WHERE list_has_any([source, lang], ['src1', 'src2', 'de']) GROUP BY 1""")
def category_summary(spark, load):
    lang = F.coalesce("lang", F.lit("none"))
    rows = load("documents").filter(F.arrays_overlap(F.array("source", "lang"), F.array(*map(F.lit, ("src1", "src2", "de")))))
    return rows.groupBy(F.when(lang == "en", "english").otherwise(lang).alias("category")).agg(F.count("*").alias("n"))


@query("""WITH n AS (SELECT user_id, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, first_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS name FROM events),
b AS (SELECT user_id, min(k) FILTER (WHERE event_type <> name) AS stop FROM n GROUP BY 1)
SELECT user_id, count(*) AS run, arg_min(event_id, struct_pack(v := value, k := k)) AS closest FROM n JOIN b USING (user_id) WHERE k < coalesce(stop, 1000000000) GROUP BY 1""")
def leading_run(spark, load):
    """The unbroken run of results that share the first one's name, and the closest of them."""
    return reports.leading_run(load("events"), "user_id", ["ts", "event_id"], "event_type", "value").select("user_id", "run", F.col("closest.event_id").alias("closest"))


@query("""WITH RECURSIVE l AS (SELECT event_id AS a, event_id + 1 + event_id % 5 AS b FROM events WHERE event_type = 'error'), both_ AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
w AS (SELECT a AS v, a AS r FROM both_ UNION SELECT b.b, w.r FROM w JOIN both_ b ON b.a = w.v) SELECT v, min(r) AS alias FROM w GROUP BY 1""")
def account_aliases(spark, load):
    """Accounts and addresses that were seen together are one visitor: the smallest id that each can reach."""
    k = F.col("event_id")
    seen = load("events").filter("event_type = 'error'").select(k.alias("a"), (k + 1 + k % 5).alias("b"))
    return reports.aliases(seen).select("v", F.col("label").alias("alias"))


@query("""SELECT doc_id, CASE WHEN epoch_ms(TIMESTAMP '2024-01-01' + to_minutes(doc_id % 500)) < epoch_ms(TIMESTAMP '2024-01-01 02:20:00') THEN 'drop' WHEN doc_id % 500 < 485 THEN 'refresh' ELSE 'keep' END AS action FROM documents""")
def cache_upkeep(spark, load):
    at = F.timestamp_add("MINUTE", (F.col("doc_id") % 500).cast("int"), F.lit("2024-01-01").cast("timestamp"))
    now = F.lit("2024-01-01 08:20:00").cast("timestamp")
    return load("documents").select("doc_id", reports.cache_action(at, now, 15, 6).alias("action"))
