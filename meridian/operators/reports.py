"""Operators of reports: dictionaries, samples, comparisons, series, visitors.

Unless said otherwise: rows with a null key form a group of their own, ties are broken by the given order, repeated rows
count as often as they occur, and empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.saving import saved


def word_dictionary(objects: DataFrame, text: str, predefined: Sequence[str], frequent: int, top: int, least: int) -> DataFrame:
    """(token, id, n) of common words: predefined, with ``frequent`` occurrences or more, or among the ``top`` most frequent.

    Ids follow the alphabet; counts under ``least`` are zeroed. Words are counted before anything is ranked. The
    ids are found among the words that were kept, which predefined and frequent words bound.
    """
    words = objects.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z]+"), F.lit(0))).alias("token"))
    counts = words.groupBy("token").agg(F.count("*").alias("n"))
    first = counts.orderBy(F.desc("n"), "token").limit(top).select("token")
    kept = counts.filter(F.col("token").isin(*predefined) | (F.col("n") >= frequent)).union(counts.join(F.broadcast(first), "token", "left_semi")).distinct()
    return kept.select("token", F.row_number().over(Window.orderBy("token")).alias("id"), F.when(F.col("n") < least, 0).otherwise(F.col("n")).alias("n"))


def output_totals(transactions: DataFrame, outputs: str) -> DataFrame:
    """(address, total) over arrays of (address, amount)."""
    return transactions.select(F.explode(outputs).alias("o")).groupBy("o.address").agg(F.sum("o.amount").alias("total"))


def first_file_wins(rows: DataFrame, keys: Sequence[str], file: str) -> DataFrame:
    """Rows of the first file (smallest ``file``) that holds their key; duplicates within it stay."""
    first = rows.groupBy(*keys).agg(F.min(file).alias(file))
    return rows.join(first, [*keys, file], "left_semi")


def compared(first: DataFrame, second: DataFrame, key: str, value: str, order: Sequence[str]) -> DataFrame:
    """(key, first value, second value, found) of two sorted files: rows of a key pair up by position.

    ``found`` is first, second (in one file only), equal or changed; null values are equal to each other.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order)).alias("_place")
    side = lambda df, name: df.select(F.col(key), place, F.struct(F.col(value).alias("v")).alias(name))
    both = side(first, "_a").join(side(second, "_b"), [key, "_place"], "full_outer")
    found = F.when(F.col("_b").isNull(), "first").when(F.col("_a").isNull(), "second").when(F.col("_a").eqNullSafe(F.col("_b")), "equal").otherwise("changed")
    return both.select(key, F.col("_a.v").alias("first"), F.col("_b.v").alias("second"), found.alias("found"))


def rolled(hours: DataFrame, time: str, sums: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Sums over the last hours of each row, itself included: name -> (column, hours). ``hours`` has one row per hour.

    Each row is sent to the hours that it counts for, so no window holds the whole series in one task.
    """
    most = max(n for _, n in sums.values())
    spread = hours.select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("_age"))
    spread = spread.withColumn("_hour", F.col(time) + F.make_dt_interval(F.lit(0), F.col("_age")))
    totals = spread.groupBy("_hour").agg(*(F.sum(F.when(F.col("_age") < n, F.col(c))).alias(name) for name, (c, n) in sums.items()), F.count_if(F.col("_age") == 0).alias("_own"))
    return totals.filter("_own > 0").drop("_own").withColumnRenamed("_hour", time)


def placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """(row, place, of): each row of ``df`` as a struct, its place (from 0) in ``order``, and the number of rows.

    Rows are range-partitioned and sorted once, with all their columns, and saved; places follow from the saved
    ranges and their sizes, so they don't depend on how a second plan would cut the ranges. Ties are placed in any order;
    nulls come first.
    """
    keys = [f"k{k}" for k in range(len(order))]
    ranged = df.select(F.struct(*df.columns).alias("row"), *(F.col(c).alias(k) for c, k in zip(order, keys))).repartitionByRange(*keys).sortWithinPartitions(*keys)
    parts = saved(ranged.select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")))
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))  # one row a partition
    starts = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("of"))
    return parts.join(F.broadcast(starts), "part").select("row", (F.col("before") + F.col("at")).alias("place"), "of")


def stride_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """``percent`` of the rows (rounded up) at even steps in the order of ``key``: the first row at or after each multiple of
    total / wanted. All columns are kept; repeated keys are rows of their own; an empty table gives no rows."""
    k, of = F.col("place"), F.col("of")
    wanted = F.ceil(of * percent / 100)
    step = lambda x: F.floor(x * wanted / of)
    return placed(df, [key]).filter((k == 0) | (step(k) != step(k - 1))).select("row.*")


def drawn(participants: DataFrame, key: str, time: str, winners: DataFrame) -> DataFrame:
    """One row of those that haven't won: with n of them in the order of (time, key), that at place h modulo n.

    ``h`` adds up the first 32 bits of the MD5 of each one's "key:time", so any change of the field changes the draw, and tasks
    add up their own share. A key that won is out with all its rows; rows without a key take no part; nobody left gives no row.
    """
    left = participants.filter(F.col(key).isNotNull()).join(winners.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.col(time).cast("string"))), 1, 8), 16, 10).cast("long")
    rows = placed(left.select(*participants.columns), [time, key])
    h = left.agg(F.sum(bits).alias("h"))  # one row
    return rows.join(F.broadcast(h)).filter(F.col("place") == F.col("h") % F.col("of")).select("row.*")


def run_pairs(results: DataFrame, key: str, run: str, group: str) -> DataFrame:
    """(first_run, second_run, first_group, second_group, n, share): for each two runs, how many keys were in one group in the first and in another in the
    second, and their share of the second group. A key that a run lacks, or whose group there is null, isn't counted for it; of several rows of a key in a run the largest group counts."""
    one = results.filter(F.col(group).isNotNull()).groupBy(F.col(key).alias("k"), F.col(run).alias("run")).agg(F.max(group).alias("found"))
    first, second = (one.select("k", F.col("run").alias(f"{s}_run"), F.col("found").alias(f"{s}_group")) for s in ("first", "second"))
    pairs = first.join(second, "k").filter("first_run < second_run").groupBy("first_run", "second_run", "first_group", "second_group").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("first_run", "second_run", "second_group"))
    return pairs.withColumn("share", F.col("n") / total)


def followups(touches: DataFrame, least_percent: int = 1) -> DataFrame:
    """(first_uri, next_uri, followers, delay): who touched one URI first and another later, and the median seconds between (truncated).

    ``touches``: uri, account, address, t (seconds). Visitors are accounts where both URIs have any, else addresses; of a visitor only the first touch of a URI counts, and pairs are
    kept with more than ``least_percent`` of the first URI's visitors. Null accounts, addresses, URIs and times are nobody's touch.
    """
    touches = touches.filter("uri is not null and t is not null")
    first = lambda c: touches.filter(F.col(c).isNotNull()).groupBy("uri", F.col(c).cast("string").alias("who")).agg(F.min("t").alias("t"))
    known = touches.groupBy("uri").agg(F.count_distinct("account").alias("accounts"), F.count_distinct("address").alias("addresses"))
    uris = known.select("uri", (F.col("accounts") > 0).alias("named"), F.when(F.col("accounts") > 0, F.col("accounts")).otherwise(F.col("addresses")).alias("visitors"))

    def pairs(c: str) -> DataFrame:
        seen = first(c)
        later = seen.select("who", F.col("uri").alias("next_uri"), F.col("t").alias("t2"))
        return seen.withColumnRenamed("uri", "first_uri").join(later, "who").filter("first_uri <> next_uri and t < t2").select("first_uri", "next_uri", (F.col("t2") - F.col("t")).alias("delay"), F.lit(c == "account").alias("by_account"))

    found = pairs("account").union(pairs("address")).groupBy("first_uri", "next_uri", "by_account").agg(F.count("*").alias("followers"), F.median("delay").cast("long").alias("delay"))
    sides = found.join(uris.select(F.col("uri").alias("first_uri"), F.col("named").alias("a"), "visitors"), "first_uri").join(uris.select(F.col("uri").alias("next_uri"), F.col("named").alias("b")), "next_uri")
    return sides.filter((F.col("by_account") == (F.col("a") & F.col("b"))) & (100 * F.col("followers") > least_percent * F.col("visitors"))).select("first_uri", "next_uri", "followers", "delay")


def storage_usage(files: DataFrame, user: str, name: Sequence[str], order: str, size: str) -> DataFrame:
    """(user, versions, files, newest_size, all_size): versions of files that aren't tombstones (a negative size), files whose newest version isn't one, and the sizes
    of either. The newest version is the one with the largest ``order``; null sizes count as tombstones."""
    real = F.coalesce(F.col(size) >= 0, F.lit(False))
    each = files.groupBy(user, *name).agg(F.max_by(F.struct(F.col(size).alias("s"), real.alias("real")), order).alias("_newest"), F.count_if(real).alias("_versions"), F.sum(F.when(real, F.col(size)).otherwise(0)).alias("_all"))
    newest = F.col("_newest.real")
    return each.groupBy(user).agg(
        F.sum("_versions").alias("versions"), F.count_if(newest).alias("files"), F.sum(F.when(newest, F.col("_newest.s")).otherwise(0)).alias("newest_size"), F.sum("_all").alias("all_size")
    )


def page_of(df: DataFrame, order: Sequence[Column], size: int, number: int) -> DataFrame:
    """Page ``number`` (from 0) of ``size`` rows, each with the number of all rows as ``total``; a page past the end is empty."""
    total = df.agg(F.count("*").alias("total"))  # one row
    return df.orderBy(*order).offset(size * number).limit(size).join(F.broadcast(total))


def symmetric(pairs: DataFrame) -> DataFrame:
    """(id, other, similarity) both ways; of several similarities of a pair the largest counts. Pairs of a row with itself, and with null ids, go."""
    there = pairs.select("id", "other", "similarity")
    back = pairs.select(F.col("other").alias("id"), F.col("id").alias("other"), "similarity")
    return there.union(back).filter("id <> other").groupBy("id", "other").agg(F.max("similarity").alias("similarity"))


def rolling_statistics(metrics: DataFrame, time: str, value: str, at: DataFrame, hours: Sequence[int], percent: int) -> DataFrame:
    """(at, hours, n, mean, value): of the values in the last ``hours`` before each time of ``at`` (t, included), their number, mean, and value at rank percent (n + 1) / 100,
    linear between neighbours, clamped to the ends. Times without values in a span are left out; null values and times don't count.

    Each value is sent to the times whose spans hold it, by hours; equal values are counted before they are ranked.
    """
    hour = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / 3_600_000_000)
    spans = at.select("t", F.explode(F.array(*map(F.lit, hours))).alias("hours")).distinct()
    slots = spans.withColumn("slot", F.explode(F.sequence(hour("t") - F.col("hours"), hour("t"))))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rows = metrics.select(F.col(time).alias("m_t"), F.col(value).alias("x")).filter("m_t is not null and x is not null").withColumn("slot", hour("m_t"))
    age = micros("t") - micros("m_t")
    counts = rows.join(slots, "slot").filter((age >= 0) & (age < F.col("hours") * 3_600_000_000)).groupBy("t", "hours", "x").agg(F.count("*").alias("n"))
    w = Window.partitionBy("t", "hours")
    runs = counts.withColumn("upto", F.sum("n").over(w.orderBy("x"))).withColumn("size", F.sum("n").over(w)).withColumn("pos", percent * (F.col("size") + 1) / 100.0)
    low = F.greatest(F.lit(1), F.least(F.col("size"), F.floor("pos")))
    high = F.when((F.col("pos") < 1) | (F.col("pos") >= F.col("size")), low).otherwise(low + 1)
    holds = lambda rank: F.max(F.when((rank <= F.col("upto")) & (rank > F.col("upto") - F.col("n")), F.col("x")))
    out = runs.groupBy("t", "hours", "size", "pos").agg((F.sum(F.col("x") * F.col("n")) / F.col("size")).alias("mean"), holds(low).alias("a"), holds(high).alias("b"))
    share = F.when(low == high, 0.0).otherwise(F.col("pos") - F.floor("pos"))
    return out.select(F.col("t").alias("at"), "hours", F.col("size").alias("n"), "mean", (F.col("a") + share * (F.col("b") - F.col("a"))).alias("value"))


def first_contained(text: Column, names: Mapping[str, str], default: str) -> Column:
    """The class of the first key, in the order given, that ``text`` contains."""
    out = F.when(F.lit(False), default)
    for needle, name in names.items():
        out = out.when(text.contains(needle), name)
    return out.otherwise(default)


def readable_size(size: Column) -> Column:
    """KB below 1 MiB, else MB, of a whole number of bytes, with one decimal; a half goes to the even digit, as printf has it.

    Tenths are found in whole numbers, since format_string rounds halves up.
    """
    size = size.cast("long")
    sign = F.when(size < 0, "-").otherwise("")

    def text(unit: int, name: str) -> Column:
        whole, rest = F.shiftright(F.abs(size), unit), F.abs(size).bitwiseAND((1 << unit) - 1) * 10
        down, left = whole * 10 + F.shiftright(rest, unit), rest.bitwiseAND((1 << unit) - 1)
        half = 1 << (unit - 1)
        tenths = down + F.when((left > half) | ((left == half) & (down % 2 == 1)), 1).otherwise(0)
        return F.concat(sign, ((tenths - tenths % 10) / 10).cast("long").cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit(name))

    return F.when(size < 1 << 20, text(10, " KB")).otherwise(text(20, " MB"))


def before_gap(df: DataFrame, key: str, order: Sequence[str], time: str, step: int, fine: int, coarse: int) -> DataFrame:
    """Rows of each series before its first gap: over ``step`` seconds among the first ``fine`` rows, over ``coarse`` after them."""
    w = Window.partitionBy(key).orderBy(*order)
    seconds = F.col(time).cast("timestamp").cast("double")
    gap = df.withColumn("_n", F.row_number().over(w)).withColumn("_gap", seconds - F.lag(seconds).over(w))
    broken = F.coalesce(F.col("_gap") > F.when(F.col("_n") <= fine, step).otherwise(coarse), F.lit(False))
    return gap.withColumn("_broken", F.max(broken).over(Window.partitionBy(key).orderBy("_n"))).filter("not _broken").drop("_n", "_gap", "_broken")


def filled(points: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Missing values by linear interpolation over ``order`` between known neighbours; ends take the nearest known one."""
    back = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(key).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col(order).alias("at")))
    both = points.withColumn("_b", F.last(known, ignorenulls=True).over(back)).withColumn("_a", F.first(known, ignorenulls=True).over(ahead))
    b, a = F.col("_b"), F.col("_a")
    between = b["v"] + F.try_divide((a["v"] - b["v"]) * (F.col(order) - b["at"]), a["at"] - b["at"])
    out = F.coalesce(F.col(value), F.when(b.isNull(), a["v"]).when(a.isNull(), b["v"]).otherwise(between))
    return both.withColumn(value, out).drop("_b", "_a")


def word_kind(word: Column, common: Sequence[str]) -> Column:
    """common, number, number_letters or word."""
    return F.when(F.lower(word).isin(*common), "common").when(word.rlike("^[0-9]+$"), "number").when(word.rlike("[0-9]"), "number_letters").otherwise("word")


def leading_run(df: DataFrame, key: str, order: Sequence[str], name: str, distance: str) -> DataFrame:
    """Per key the length of the unbroken run of rows with the first row's name, and the row of it with the least distance."""
    w = Window.partitionBy(key).orderBy(*order)
    rows = df.select(key, F.struct(*df.columns).alias("_row"), F.row_number().over(w).alias("_k"), F.first(name).over(w).alias("_name"))
    other = ~F.col(f"_row.{name}").eqNullSafe(F.col("_name"))
    stop = rows.withColumn("_stop", F.max(other).over(Window.partitionBy(key).orderBy("_k"))).filter("not _stop")
    return stop.groupBy(key).agg(F.count("*").alias("run"), F.min_by("_row", F.struct(F.col(f"_row.{distance}"), "_k")).alias("closest"))


def aliases(seen: DataFrame) -> DataFrame:
    """(v, label): the smallest id that each id of the pairs (a, b) can reach.

    Each round gives every id the smallest label among itself and its neighbours' labels, and follows labels to their
    labels, so a chain is halved; it ends when nothing changes. Rounds are saved.
    """
    edges = seen.select("a", "b").union(seen.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a is not null and b is not null").distinct()
    edges = saved(edges)
    labels = edges.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    while True:
        near = edges.join(labels.withColumnsRenamed({"v": "b"}), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        step = labels.join(near, "v").select("v", F.least("label", "near").alias("label"))
        jump = step.select(F.col("v").alias("label"), F.col("label").alias("far"))
        after = step.join(jump, "label", "left").select("v", F.coalesce("far", "label").alias("label"))
        after = saved(after)
        moved = after.withColumnRenamed("label", "now").join(labels, "v").filter("now <> label").limit(1).count()
        labels = after
        if not moved:
            return labels


def cache_action(accessed: Column, now: Column, fresh_minutes: int, kept_hours: int) -> Column:
    """drop when not accessed for ``kept_hours``, refresh when older than ``fresh_minutes``, else keep."""
    age = now.cast("double") - accessed.cast("double")
    return F.when(age > kept_hours * 3600, "drop").when(age > fresh_minutes * 60, "refresh").otherwise("keep")
