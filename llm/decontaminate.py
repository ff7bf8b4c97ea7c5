"""Benchmark decontamination as a prefix-filtered set join of word windows, with DataFrame functions only.

1. Items are cut into windows of ten consecutive words; an item with fewer is one window. A window is a set of
   shingles of five words (of all its words, if there are fewer), and all of them must occur in a document that
   contains the window.
2. One pass over the documents keeps the (document, position, shingle) posts whose shingle occurs in an item.
3. Posts are counted by shingle. A window with a shingle that no document has is out. The others order their
   shingles by rarity; as all must be found, the prefix that must match is the rarest one alone.
4. Posts of prefix shingles are candidates, placed by the shingle's offset in the window. The length and
   positional bounds drop those that would begin before the document's first word or end after its last.
5. The texts that have candidates are cut into words again, and the words at each candidate's place are compared with
   the windows, word for word. Words in confirmed places are hit, and a window's items are an item list by join.

The item side is broadcast while it has at most ``BROADCAST_ROWS`` rows, which is counted each time; beyond that the
same joins shuffle. Documents are known by id and two hashes of the text, which are the same in each pass.

Defined cases: null and empty texts have no words; rows that repeat id and text get equal rows; a row with a null
id is reported with it; an item without words is in no document; repeated items and equal ids count once; windows of
an item with a null id hit words, but it is not listed; empty tables give no rows or no hits; other columns are not
read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.tables import saved

WINDOW = 10
SHINGLE = 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before A-Z are lower-cased; enough to count them.
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Rows of items' windows or shingles that are broadcast at most; a row has about a hundred bytes.
BROADCAST_ROWS = 200_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEY = ("who", "h", "g")


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; other capitals stay."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.coalesce(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _key(text: Column, doc_id: Column) -> list[Column]:
    return [F.coalesce(doc_id.cast("long"), F.lit(0)).alias("who"), F.xxhash64(text, doc_id.isNull()).alias("h"), F.xxhash64(F.lit("g"), text).alias("g")]


def _shingles(words: Column, n: Column, length: int) -> Column:
    """Hashes of all runs of ``length`` words."""
    each = F.transform(F.sequence(F.lit(0), n - length), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(length))))
    return F.when(n >= length, each).otherwise(F.array().cast("array<bigint>"))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a saved table, marked for broadcast if it is small enough."""
    return F.broadcast(df) if df.count() <= rows else df


def windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """((wid, words, m) of each different window, (wid, item_id) of the items that hold it)."""
    cut = items.select("item_id", words_of(F.col("text")).alias("words")).withColumn("n", F.size("words")).filter("n > 0").withColumn("m", F.least("n", F.lit(window)))
    places = F.explode(F.sequence(F.lit(1), F.col("n") - F.col("m") + 1)).alias("i")
    held = cut.select("item_id", "words", "m", places).select("item_id", F.slice("words", F.col("i"), F.col("m")).alias("words"), "m").distinct()
    held = saved(held)
    different = saved(held.select("words", "m").distinct().withColumn("wid", F.monotonically_increasing_id()))
    return different, saved(held.join(different.select("words", "wid"), "words").select("wid", "item_id").distinct())


def _posts(documents: DataFrame, shingles: DataFrame, lengths: list[int]) -> DataFrame:
    """(key, n, pos, shingle) of every place in a document where a known shingle stands."""
    n = F.col("n")
    cut = documents.select(*_key(F.col("text"), F.col("doc_id")), words_of(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    arrays = F.concat(*(_shingles(F.col("words"), n, k) for k in lengths))
    at, before = F.col("at"), F.lit(0)
    pos = at
    for k in lengths:  # the arrays of all lengths follow one another
        pos = F.when(at >= before, at - before).otherwise(pos)
        before = before + F.greatest(n - k + 1, F.lit(0))
    return cut.select(*_KEY, "n", F.posexplode(arrays).alias("at", "shingle")).join(shingles, "shingle").select(*_KEY, "n", pos.alias("pos"), "shingle")


def occurrences(documents: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """((key, start, m, wid) of every window in every document, (wid, item_id))."""
    different, owners = windows(items, window)
    lengths = sorted((r.k for r in different.select(F.least("m", F.lit(shingle)).alias("k")).distinct().collect()), reverse=True)  # five values at most
    parts = []
    for k in lengths:
        own = different.filter(F.least("m", F.lit(shingle)) == k)
        parts.append(own.select("wid", "m", F.posexplode(_shingles(F.col("words"), F.col("m"), k)).alias("off", "shingle")))
    if not parts:
        none = documents.sparkSession.createDataFrame([], "who long, h long, g long, start int, m int, wid long")
        return none, owners
    known = parts[0]
    for part in parts[1:]:
        known = known.union(part)
    known = saved(known)
    posts = saved(_posts(documents, _bounded(saved(known.select("shingle").distinct()), broadcast_rows), lengths))

    held = posts.groupBy("shingle").agg(F.count("*").alias("df"))
    rarest = F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "shingle", "off")).alias("rarest")
    prefix = known.join(held, "shingle", "left").groupBy("wid", "m").agg(rarest).filter("rarest.df > 0").select("rarest.shingle", "rarest.off", "m")
    prefix = _bounded(saved(prefix.distinct()), broadcast_rows)
    start = (F.col("pos") - F.col("off")).alias("start")
    placed = posts.join(prefix, "shingle").select(*_KEY, "n", start, "m").filter((F.col("start") >= 0) & (F.col("start") + F.col("m") <= F.col("n")))
    places = placed.groupBy(*_KEY).agg(F.collect_set(F.struct("start", "m")).alias("places"))

    texts = documents.select(*_key(F.col("text"), F.col("doc_id")), "text").join(places, list(_KEY)).select(*_KEY, words_of(F.col("text")).alias("words"), "places")
    there = texts.select(*_KEY, "words", F.explode("places").alias("x")).select(*_KEY, "x.start", "x.m", F.slice("words", F.col("x.start") + 1, F.col("x.m")).alias("words"))
    same = _bounded(different.select("words", "wid"), broadcast_rows)
    return there.join(same, "words").select(*_KEY, "start", "m", "wid"), owners


def _union_length(places: Column) -> Column:
    """Number of positions in the union of (start, m) intervals."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc, x):
        end = x["start"] + x["m"]
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + F.greatest(end - F.greatest(acc["end"], x["start"]), F.lit(0))).alias("n"))

    return F.aggregate(F.array_sort(places), zero, step)["n"]


def contamination(documents: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (strings, sorted) of every row."""
    found, owners = occurrences(documents, items, window, shingle, broadcast_rows)
    by_text = found.groupBy(*_KEY).agg(F.collect_set(F.struct("start", "m")).alias("places"), F.collect_set("wid").alias("wids"))
    hit = by_text.select(*_KEY, _union_length(F.col("places")).alias("n_hit"), F.explode("wids").alias("wid")).join(owners, "wid")
    hit = hit.groupBy(*_KEY).agg(F.max("n_hit").alias("n_hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    rows = documents.select("doc_id", *_key(F.col("text"), F.col("doc_id")), F.coalesce(F.regexp_count("text", F.lit(ANY_CASE)), F.lit(0)).cast("long").alias("n_words"))
    return rows.join(hit, list(_KEY), "left").select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    ids = F.col("item_ids")
    return contamination(documents, items).select(
        "doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def decontaminated(documents: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows, with all their columns, that hold no window of an item."""
    found, _ = occurrences(documents, items, window)
    rows = documents.select(F.struct("*").alias("row"), *_key(F.col("text"), F.col("doc_id")))
    return rows.join(found.select(*_KEY).distinct(), list(_KEY), "left_anti").select("row.*")
