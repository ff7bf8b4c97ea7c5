"""Language identification by nearest centroid.

A text is the TF-IDF vector of its hashed byte 2-, 3- and 4-grams (ASCII case folded, everything in
ASCII but letters as one blank), with length 1. Each language has up to ``CENTROIDS`` centroids, found
by spherical k-means over its sample. The nearest centroid by cosine names the language and the cosine
is the score. A text farther from its centroid than the language's radius for texts of its length is
rejected: radii are low quantiles (``QUANTILE``) of the cosines of sampled texts and of stretches cut out of
them, by the power of two below their number of n-grams, as short texts have lower cosines than long ones.

Learning takes about ``SAMPLE`` documents of each language, chosen by a hash of the id among those that
are not held out; that is the documented bound for fitting. One in ``CUT_EVERY`` of them (all of a language with fewer
documents) gives stretches for the radii. Prediction covers every whole text.

Defined cases: a null text and a text without a letter are ``und`` with score 0, and rejected; ties of
centroids go to the first language by name; repeated rows get equal results; when nothing can be learnt
every text is ``und``. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import arrays as A
from llm.tables import fold_of, per_batch, saved

SIZE = 1 << 13
SAMPLE = 800
CENTROIDS = 4
ROUNDS = 12
#: The radius of a language at a length: this quantile of its sample's cosines there, less a tenth of it.
QUANTILE, SLACK = 0.01, 0.9
CUT_EVERY = 4
#: Lengths are powers of two of the number of n-grams; buckets with fewer cosines than LEAST_SEEN take the next shorter one's radius.
LENGTHS, LEAST_SEEN = 24, 25
UNKNOWN = "und"
_FOLD = A.LOWER.copy()
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32
_VALUES = np.random.default_rng(3).integers(0, 2**32, (4, 256), np.uint32)


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """n-gram counts, one row of SIZE by text."""
    n = len(offsets) - 1
    b = _FOLD[data]
    blank = b == 32
    rows = np.repeat(np.arange(n), np.diff(offsets))
    total = np.zeros(n * SIZE, np.float32)
    h = _VALUES[0][b]
    for k in (1, 2, 3):
        h = h[:-1] + _VALUES[k][b[k:]]
        if not len(h):
            break
        ok = (rows[k:] == rows[: len(h)]) & ~(blank[k:] & blank[k - 1 : -1])
        g = h * np.uint32(2654435761)
        g ^= g >> np.uint32(15)
        g *= np.uint32(2246822519)
        bucket = (g >> np.uint32(19)).astype(np.int64)
        total += np.bincount((rows[k:] * SIZE + bucket)[ok], minlength=n * SIZE).astype(np.float32)
    return total.reshape(n, SIZE)


def bucket_of(counts: np.ndarray) -> np.ndarray:
    """The power of two below each row's number of n-grams."""
    return np.minimum(np.log2(np.maximum(counts.sum(1), 1)).astype(np.int64), LENGTHS - 1)


class Centroids:
    """``radius``: by centroid and bucket of lengths."""

    def __init__(self, idf: np.ndarray, languages: list[str], centroids: np.ndarray, radius: np.ndarray):
        self.idf, self.languages, self.centroids, self.radius = idf, languages, centroids, radius

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(centroid, cosine, whether it is too far) by row."""
        bucket = bucket_of(counts)
        x = np.log1p(counts) * self.idf
        cosine = (x @ self.centroids.T) / np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-9)[:, None]
        best = np.argmax(cosine, 1)
        top = np.clip(cosine[np.arange(len(x)), best], 0, 1).astype(np.float64)
        return best, top, top < self.radius[best, bucket]


def _k_means(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical; clusters of less than a fiftieth of the rows are dropped, so stray texts found none."""
    c = x[np.random.default_rng(5).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        owner = np.argmax(x @ c.T, 1)
        c = np.stack([x[owner == i].mean(0) for i in range(len(c)) if (owner == i).sum() * 50 >= len(x)])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def _dense(sparse: list[bytes]) -> np.ndarray:
    counts = np.zeros((len(sparse), SIZE), np.float32)
    for i, raw in enumerate(sparse):
        both = np.frombuffer(raw, np.uint16)
        counts[i, both[: len(both) // 2]] = both[len(both) // 2 :]
    return counts


def _radii(cosines: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    out = np.zeros(LENGTHS)
    for k in range(LENGTHS):
        seen = cosines[buckets == k]
        out[k] = SLACK * np.quantile(seen, QUANTILE) if len(seen) >= LEAST_SEEN else out[k - 1] if k else 0
    return out


def _holding(table: pa.Table) -> pa.Table:
    """A language's whole texts, and how many of them hold each bucket."""
    holding, n = np.zeros(SIZE, np.int64), 0
    for raw, cut in zip(table.column("counts"), table.column("cut")):
        if not cut.as_py():
            both = np.frombuffer(raw.as_buffer(), np.uint16)
            holding[both[: len(both) // 2]] += 1
            n += 1
    return pa.table([pa.array([n]), pa.array([holding.tobytes()], pa.binary())], ["n", "holding"])


def _trained(idf: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    """Centroids and radii of one language; only its whole texts are dense at a time, and its stretches in small blocks."""

    def unit(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        x = _dense(rows)
        bucket = bucket_of(x)
        np.log1p(x, out=x)
        x *= idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        return x, bucket

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cut", "ascending"), ("counts", "ascending")])
        whole = table.filter(pc.invert(table.column("cut")))
        own, bucket = unit(whole.column("counts").to_pylist())
        c = _k_means(own, CENTROIDS).astype(np.float32)
        cosines, buckets = [(own @ c.T).max(1)], [bucket]
        del own
        stretches = table.slice(len(whole)).column("counts").to_pylist()
        for i in range(0, len(stretches), 256):
            x, bucket = unit(stretches[i : i + 256])
            cosines.append((x @ c.T).max(1))
            buckets.append(bucket)
        radius = _radii(np.concatenate(cosines), np.concatenate(buckets))
        return pa.table([whole.column("lang").slice(0, 1), *(pa.array([x.tobytes()], pa.binary()) for x in (c, radius))], ["lang", "centroids", "radius"])

    return train


def _slices(data: np.ndarray, offsets: np.ndarray):
    """Of at most 256 texts and 1 MB, or one text."""
    for i, j in A.slices(offsets, 1 << 20):
        for k in range(i, j, 256):
            m = min(j, k + 256)
            yield k, m, data[offsets[k] : offsets[m]], offsets[k : m + 1] - offsets[k]


def _sparse(counts: np.ndarray) -> bytes:
    at = np.flatnonzero(counts)
    return at.astype(np.uint16).tobytes() + np.minimum(counts[at], 65535).astype(np.uint16).tobytes()


def _pairs(batch: pa.RecordBatch):
    """Non-zero counts of sampled texts as bytes: buckets, then counts; and of stretches of some of them, one of
    each power of two of bytes, from the middle."""
    data, offsets = A.buffer(batch.column("text"))
    langs, ids = batch.column("lang"), batch.column("key").to_numpy()
    for i, j, part, off in _slices(data, offsets):
        rows = [_sparse(row) for row in vectors(part, off)]
        names, cut = langs.slice(i, j - i).to_pylist(), [False] * (j - i)
        for k in np.flatnonzero(ids[i:j] == 0):
            text = part[off[k] : off[k + 1]]
            sizes = [1 << p for p in range(3, 14) if 2 << p <= len(text)]
            pieces = [text[(len(text) - n) // 2 : (len(text) + n) // 2] for n in sizes]
            if pieces:
                rows += [_sparse(row) for row in vectors(np.concatenate(pieces), np.cumsum([0, *map(len, pieces)]))]
                names += [names[k]] * len(pieces)
                cut += [True] * len(pieces)
        yield {"lang": pa.array(names, pa.string()), "counts": pa.array(rows, pa.binary()), "cut": pa.array(cut)}


def fit(documents: DataFrame, sample: int = SAMPLE) -> Centroids:
    """Learns from about ``sample`` documents of each language that are not held out, each language in a task; only
    centroids, radii and counts by bucket come to the driver."""
    known = documents.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.coalesce(fold_of(F.col("doc_id")) != 1, F.lit(False)))
    per_language = known.groupBy("lang").agg(F.count("*").alias("n"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    share = F.broadcast(per_language.select("lang", (F.lit(float(sample)) / F.col("n")).alias("share")))
    chosen = known.join(share, "lang").filter(place < F.col("share")).select(F.col("lang").cast("string"), "text", F.when(F.col("share") < 1, F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CUT_EVERY))).otherwise(0).alias("key"))
    by_lang = saved(per_batch(chosen, "lang string, counts binary, cut boolean", _pairs)).groupBy("lang")
    seen = by_lang.applyInArrow(_holding, "n long, holding binary").toArrow().to_pylist()
    holding = sum((np.frombuffer(x["holding"], np.int64) for x in seen), np.zeros(SIZE, np.int64))
    idf = (np.log((1 + sum(x["n"] for x in seen)) / (1 + holding)) + 1).astype(np.float32)
    learnt = sorted(by_lang.applyInArrow(_trained(idf), "lang string, centroids binary, radius binary").toArrow().to_pylist(), key=lambda x: x["lang"])
    parts = [np.frombuffer(x["centroids"], np.float32).reshape(-1, SIZE) for x in learnt]
    names = [x["lang"] for x, c in zip(learnt, parts) for _ in c]
    radius = np.array([np.frombuffer(x["radius"]) for x, c in zip(learnt, parts) for _ in c]).reshape(-1, LENGTHS)
    return Centroids(idf, names, np.concatenate(parts) if parts else np.zeros((0, SIZE), np.float32), radius)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _predict(data: np.ndarray, offsets: np.ndarray, letter: np.ndarray, model: Centroids) -> tuple[list[str], np.ndarray, np.ndarray]:
    n = len(offsets) - 1
    pred, score, far = np.full(n, UNKNOWN, object), np.zeros(n), np.ones(n, bool)
    if model.languages:
        names = np.array(model.languages, object)
        for i, j, part, off in _slices(data, offsets):
            best, score[i:j], far[i:j] = model.nearest(vectors(part, off))
            pred[i:j] = names[best]
    pred[~letter], score[~letter], far[~letter] = UNKNOWN, 0, True
    return pred, score, far


def predict(documents: DataFrame, model: Centroids) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row."""
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    def predicted(batch: pa.RecordBatch):
        data, offsets = A.buffer(batch.column("text"))
        pred, score, far = _predict(data, offsets, batch.column("letter").to_numpy(zero_copy_only=False), shipped.value)
        yield {"doc_id": batch.column("doc_id"), "lang_pred": pa.array(pred, pa.string()), "score": score, "rejected": far}

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", has_letter(F.col("text")).alias("letter"))
    return per_batch(rows, "doc_id long, lang_pred string, score double, rejected boolean", predicted)


def without_rejected(documents: DataFrame, model: Centroids) -> DataFrame:
    """The documents whose language is recognised, with all their columns."""
    shipped, at, columns = documents.sparkSession.sparkContext.broadcast(model), documents.columns.index("text"), len(documents.columns)

    def kept(batches):
        for batch in batches:
            if batch.num_rows:
                data, offsets = A.buffer(batch.column(at))
                _, _, far = _predict(data, offsets, batch.column(columns).to_numpy(zero_copy_only=False), shipped.value)
                yield batch.filter(pc.invert(pa.array(far))).select(range(columns))

    unused = "_" * (1 + max(map(len, documents.columns)))
    return documents.select("*", has_letter(F.col("text")).alias(unused)).mapInArrow(kept, documents.schema)
