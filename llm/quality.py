"""Quality rules with cross-document line frequency.

For each document: base counts over its words (runs of anything but ASCII white space), and the hashes
of its normalised lines (ASCII case folded, digits as 0, white space collapsed; lines without a word do
not count). For each host the documents that hold a line are counted over the whole corpus. A line is over
the limit when more than ``LINE_SHARE`` of the host's documents hold it, and more than ``LINE_FLOOR`` do; so
the limit follows the size of the host. Lines over it are removed. A document is depleted, and rejected,
when less than ``LEAST_SHARE`` of its words or fewer than ``LEAST_WORDS`` words remain; a document that fails
a base rule is rejected, too. Rows count as documents: exact copies on one host make their lines frequent.

Defined cases: a null text is the empty text (0 words, base rules fail, not kept); a null host is a host
of its own; repeated rows are judged one by one and equally; an empty table gives no rows; other columns of
the input are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import arrays as A
from llm.tables import per_batch, saved

LINE_SHARE = 0.05
LINE_FLOOR = 3
LEAST_SHARE = 0.5
LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8
#: Parts that a line's occurrences are dealt to when the limits are joined back.
SALTS = 32
SYMBOLS = A.lut("#*$%&|<>")
NEWLINE = A.lut("\n")
FOLD = A.LOWER.copy()
FOLD[48:58] = 48
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated(h: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Words by row that stand in a window of WINDOW words which the row has twice or more."""
    gram, at = A.grams(h, rows, WINDOW)
    if not len(at):
        return np.zeros(n_rows, np.int64)
    key = A.mix(gram + rows[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + WINDOW, -1)
    return np.bincount(rows, np.cumsum(edge[:-1]) > 0, n_rows).astype(np.int64)


def measure(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """(counts by row; row, hash and words of each row's distinct normalised lines) of a slice of texts."""
    n = len(offsets) - 1
    starts, ends, rows = A.runs(data, offsets, A.SPACE)
    counts = {"n_words": np.bincount(rows, minlength=n)}
    counts["word_chars"] = A.per_row(A.STARTS_CHAR[data] & ~A.SPACE[data], offsets)
    counts["n_symbols"] = A.per_row(SYMBOLS[data], offsets)
    line_from, line_to, line_row = A.runs(data, offsets, NEWLINE)
    first = np.searchsorted(starts, line_from)
    size = np.searchsorted(starts, line_to) - first
    full = size > 0
    line_from, line_to, line_row, first, size = (x[full] for x in (line_from, line_to, line_row, first, size))
    exact = A.mix(A.hashes(data, line_from, line_to) + line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, earliest = np.unique(exact, return_index=True)
    counts["n_dup_lines"] = np.bincount(line_row, minlength=n) - np.bincount(line_row[earliest], minlength=n)
    counts["n_repeat_words"] = _repeated(A.hashes(data, starts, ends), rows, n)

    folded = A.hashes(data, starts, ends, FOLD)
    if not len(first):
        return counts, {"row": line_row, "hash": np.zeros(0, np.int64), "words": size}
    place = np.arange(len(folded)) - np.repeat(first, size)
    normal = A.mix(np.add.reduceat(A.mix(folded + place.astype(np.uint64)), first))
    order = np.lexsort([normal, line_row])
    row, normal, size = line_row[order], normal[order], size[order]
    new = np.append(True, (row[1:] != row[:-1]) | (normal[1:] != normal[:-1]))
    at = np.flatnonzero(new)
    return counts, {"row": row[at], "hash": normal[at].view(np.int64), "words": np.add.reduceat(size, at)}


def _measured(batch: pa.RecordBatch):
    data, offsets = A.buffer(batch.column("text"))
    for i, j in A.slices(offsets):
        part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        counts, lines = measure(part, off)
        cut = pa.array(np.searchsorted(lines["row"], np.arange(j - i + 1)), pa.int32())
        yield {
            "doc_id": batch.column("doc_id").slice(i, j - i), "host": batch.column("host").slice(i, j - i),
            **{k: counts[k] for k in STATS},
            "lines": pa.ListArray.from_arrays(cut, pa.array(lines["hash"])), "line_words": pa.ListArray.from_arrays(cut, pa.array(lines["words"])),
        }


def judge(documents: DataFrame, host: str = "source", line_share: float = LINE_SHARE, line_floor: int = LINE_FLOOR, least_share: float = LEAST_SHARE) -> DataFrame:
    """doc_id, the counts, removed_words, base_failed and kept of every row."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), "text")
    schema = "doc_id long, host string, " + ", ".join(f"{k} long" for k in STATS) + ", lines array<long>, line_words array<long>"
    measured = saved(per_batch(rows, schema, _measured).withColumn("row_key", F.monotonically_increasing_id()))
    host_key = F.coalesce(F.concat(F.lit("="), "host"), F.lit("null")).alias("host")
    lines = measured.select("row_key", host_key, F.explode(F.arrays_zip("lines", "line_words")).alias("x")).select("row_key", "host", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words"))
    hosts = measured.groupBy(host_key).agg(F.greatest(F.count("*") * F.lit(float(line_share)), F.lit(float(line_floor))).alias("limit"))
    # a line's documents are counted before its host's limit is looked up, so a large host is not gathered anywhere
    held = lines.groupBy("host", "line").agg(F.count("*").alias("documents")).filter(F.col("documents") > line_floor)
    common = held.join(hosts, "host").filter(F.col("documents") > F.col("limit"))
    salted = common.select("host", "line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    removed = (
        lines.withColumn("salt", F.pmod(F.xxhash64("row_key"), F.lit(SALTS)).cast("int"))
        .join(salted, ["host", "line", "salt"]).groupBy("row_key").agg(F.sum("words").alias("removed_words"))
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    return (
        measured.select("row_key", "doc_id", *STATS).join(removed, "row_key", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long")).withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (left >= least_share * F.col("n_words")) & (left >= LEAST_WORDS))
        .select("doc_id", *STATS, "base_failed", "kept", "removed_words")
    )
