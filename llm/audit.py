"""Filter interaction audit: what each filter of a chain removes, in every order of the chain.

1. Rows are range-partitioned by the fingerprint of their text and by doc_id, and sorted in each partition by
   fingerprint, full text and doc_id. Nothing else travels with the texts; the other filters are evaluated
   behind this shuffle, in the same stage.
2. A pass over each sorted partition compares a row with its predecessor. A run of equal texts is a group, whose
   smallest id stands first; a row fails the duplicate filter if its id is larger. As doc_id is part of the range,
   a text that very many rows share is dealt over partitions. Therefore the groups of a partition's first and
   last fingerprint, two a partition but for equal fingerprints of different texts, are listed with a digest of
   their text; the smallest id by digest, over all partitions, then replaces the local one.
3. Each row is left with a mask of the filters that it fails. Masks are counted by (doc_id, part), met with the
   labels, and added up by (part, mask, labels); for a part there are at most 2^filters x 4 counters, whatever the
   number of its documents.
4. Every figure of every order follows from the counters of a part by a table over masks, orders and steps.

Defined cases: a null text is the empty text, which has no words; a null part counts as the empty string; rows with
a null id fail no duplicate filter, make none fail and have no labels; repeated rows of one id don't make each other fail (no id is
smaller), but each counts; a document has a label if any of its label rows says so; an empty table gives no rows;
other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.tables import saved

LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 3
WORD = r"[^\x20\x09-\x0D]+"
DUPLICATE = "E"


def conditions() -> dict[str, Column]:
    """Failure conditions over ``text`` and its ``words``, by letter."""
    n = F.size("words")
    return {
        "A": n < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct("words")) < LEAST_DISTINCT * n,
        "C": 100 * F.regexp_count("text", F.lit("[A-Z]")) > MOST_CAPITALS * F.length("text"),
        "D": F.col("text").rlike("[#$%&*|]"),
    }


class _Groups:
    """Runs of equal texts in a sorted partition, met batch by batch."""

    def __init__(self):
        self.text = self.fingerprint = self.first = None
        self.number, self.least, self.head, self.tail = -1, None, [], []

    def add(self, batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """(group number, fails the duplicate filter, smallest id of the group) by row."""
        texts, ids, fingerprints = batch.column("text"), batch.column("doc_id"), batch.column("fingerprint").to_numpy()
        n = len(texts)
        new = np.ones(n, bool)
        new[0] = self.text is None or texts[0].as_py() != self.text
        if n > 1:
            new[1:] = ~pc.equal(texts.slice(1), texts.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        groups = self.number + np.cumsum(new)
        firsts = pa.concat_arrays([pa.array([self.least], pa.int64()), ids.take(pa.array(starts))])
        least = firsts.take(pa.array(groups - self.number))
        for k in starts[fingerprints[starts] == fingerprints[-1]] if len(starts) else ():
            if fingerprints[k] != self.fingerprint:
                self.fingerprint, self.tail = fingerprints[k], []
            self.tail.append((int(groups[k]), texts[k], ids[k]))
        if self.first is None:
            self.first = fingerprints[0]
        self.head += [(int(groups[k]), texts[k], ids[k]) for k in starts[fingerprints[starts] == self.first]]
        self.text, self.number, self.least = texts[n - 1].as_py(), int(groups[-1]), least[n - 1].as_py()
        return groups, pc.fill_null(pc.greater(ids, least), False), least

    def edges(self) -> list[tuple[int, bytes, int | None]]:
        """(group, digest of its text, smallest id) of the groups that may go on in another partition."""
        found = {group: (text, least) for group, text, least in self.head + self.tail}
        return [(group, hashlib.sha256(text.as_py().encode()).digest(), least.as_py()) for group, (text, least) in found.items()]


_MARKED = "doc_id long, part string, mask int, task int, place long, digest binary"


def _mark(bit: int):
    def mark(batches):
        groups, task = _Groups(), TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                n = batch.num_rows
                group, fails, _ = groups.add(batch)
                mask = pc.add(batch.column("mask"), pc.multiply(fails.cast(pa.int32()), pa.scalar(bit, pa.int32())))
                columns = [batch.column("doc_id"), batch.column("part"), mask, pa.array(np.full(n, task, np.int32)), pa.array(group), pa.nulls(n, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "task", "place", "digest"])
        edges = groups.edges()
        if edges:
            place, digest, least = zip(*edges)
            n = len(edges)
            columns = [pa.array(least, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()), pa.array(np.full(n, task, np.int32)), pa.array(place, pa.int64()), pa.array(digest, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "task", "place", "digest"])

    return mark


def failure_masks(documents: DataFrame, part: str = "lang", fails: dict[str, Column] | None = None) -> tuple[DataFrame, str]:
    """((doc_id, part, mask) of every row, letters of the mask's bits from the lowest on); the duplicate filter comes last."""
    fails = conditions() if fails is None else fails
    letters, bit = "".join(fails) + DUPLICATE, 1 << len(fails)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = rows.withColumn("fingerprint", F.xxhash64("text")).repartitionByRange("fingerprint", "doc_id")
    ranged = ranged.sortWithinPartitions("fingerprint", "text", F.col("doc_id").asc_nulls_last())
    mask = sum((F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(fails.values())), F.lit(0)).cast("int").alias("mask")
    masked = ranged.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).select("doc_id", "part", "text", "fingerprint", mask)
    marked = saved(masked.mapInArrow(_mark(bit), _MARKED))
    edges = marked.filter("digest is not null").select("task", "place", "digest", "doc_id")
    least = edges.groupBy("digest").agg(F.min("doc_id").alias("least"))
    # two groups a partition, but for fingerprints that several texts share: the bound of what is broadcast
    known = F.broadcast(edges.join(least, "digest").select("task", "place", "least"))
    late = F.when((F.col("doc_id") > F.col("least")) & (F.col("mask").bitwiseAND(F.lit(bit)) == 0), F.lit(bit)).otherwise(F.lit(0))
    return marked.filter("digest is null").join(known, ["task", "place"], "left").select("doc_id", "part", (F.col("mask") + late).cast("int").alias("mask")), letters


def counters(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, documents, good, toxic): additive counts by part and mask."""
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*(F.coalesce(F.max((F.col(c) == 1).cast("long")), F.lit(0)).alias(t) for c, t in (("quality", "good"), ("toxic", "toxic"))))
    each = masks.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("documents"))
    return each.join(said, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("documents").alias("documents"), *(F.sum(F.col("documents") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic"))
    )


def rules(letters: str) -> list[tuple]:
    """(mask, filter_order, step, kept, removed, redundant, unique_fails, weight) for all masks, orders and steps; the
    weight is the number of orders in which the step's filter is the one that removes a row of this mask."""
    bit = {letter: 1 << k for k, letter in enumerate(letters)}
    out = []
    for order in permutations(letters):
        earlier = 0
        for step, letter in enumerate(order, 1):
            own = bit[letter]
            for mask in range(1 << len(letters)):
                fails, before = bool(mask & own), bool(mask & earlier)
                weight = factorial(len(letters)) // mask.bit_count() if fails else 0
                out.append((mask, "".join(order), step, int(not (mask & (earlier | own))), int(fails and not before), int(fails and before), int(mask == own), weight))
            earlier |= own
    return out


def audit(documents: DataFrame, labels: DataFrame, part: str = "lang", fails: dict[str, Column] | None = None) -> DataFrame:
    """part, filter_order, step and the counts kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    masks, letters = failure_masks(documents, part, fails)
    counted = counters(masks, labels)
    names = ("kept", "removed", "redundant", "unique_fails", "weight")
    table = documents.sparkSession.createDataFrame(rules(letters), "mask int, filter_order string, step int, " + ", ".join(f"{n} long" for n in names))
    # the table's size depends on the number of filters only
    every = counted.join(F.broadcast(table), "mask")
    n = F.col("documents")
    return every.groupBy("part", "filter_order", "step").agg(
        *(F.sum(n * F.col(c)).alias(c) for c in names[:4]),
        *(F.sum(F.col(c) * F.col("removed")).alias(f"{c}_lost") for c in ("good", "toxic")),
        F.sum(n * F.col("weight")).alias("shapley"),
    )
