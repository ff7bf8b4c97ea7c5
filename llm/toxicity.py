"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words (ASCII case folded, cut at ASCII punctuation) and the first four to seven
bytes of longer words, each hashed into ``BUCKETS`` buckets, and once more where a term occurs twice or
more, and where it occurs four times or more; a text is the set of its buckets. Whole words have even ones.
The model is ``w0 + sum w_i + sum_{i<j} <v_i, v_j>`` over that set, squashed to (0, 1). The pairwise
part lets a group mention raise an insult, which additive weights miss.

Learning uses at most ``SAMPLE`` labelled rows (smallest hashes of the id) of the folds that are not
held out; that is the documented bound for fitting. Buckets get parameters if at least ``MIN_DOCUMENTS`` of
these hold them and either they say something alone (``STRONG`` deviations from the share of toxic texts)
or a pair of them does, beyond what its members say (``STRONG_PAIR``), so a pair counts whose members are
neutral alone. Pairs are looked for among whole words that at most ``COMMON`` of the texts and at least
``PAIR_SHARE`` of the toxic ones hold, in texts with up to ``PAIR_TERMS`` of those. Scoring runs over every whole text inside Spark tasks; the
model that is shipped has ``BUCKETS`` rows at most, whatever the size of the corpus.

Defined cases: a null text is the empty text; an empty text has no terms and scores ``sigmoid(w0)``;
repeated rows get equal scores; with no labels, or only one class among them, the score is the share
of toxic labels (0 where there are none); labels that are null are ignored, and where an id has several
labels the largest counts. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import arrays as A
from llm.tables import fold_of, per_batch, saved

BUCKETS = 1 << 18
#: Labelled rows that are learnt from, at most.
SAMPLE = 20_000
FACTORS = 6
MIN_DOCUMENTS = 8
STRONG, STRONG_PAIR, COMMON, PAIR_SHARE = 4.0, 5.0, 0.3, 0.02
#: Pairs of a text that are made at once.
PAIRS = 1 << 19
PREFIXES = (4, 5, 6, 7)
#: Passes over the sample; small samples get more, so that there are STEPS steps at least.
EPOCHS = 14
STEPS = 750
BATCH = 256
WEIGHT_DECAY, FACTOR_DECAY = 2e-5, 5e-5
REJECT = 0.7


def _again(bucket: np.ndarray, times: int) -> np.ndarray:
    """The bucket that says that another one's term occurs so many times or more."""
    return A.mix(bucket + np.uint64(0x5EED * times)) & np.uint64(BUCKETS - 1) | np.uint64(1)


def terms(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) pairs of a slice of texts; ``wanted`` says which first buckets are looked at."""
    starts, ends, rows = A.runs(data, offsets, A.NOT_ALNUM)
    parts, owners = [], []
    for n in (0, *PREFIXES):
        longer = slice(None) if n == 0 else ends - starts > n
        h = A.hashes(data, starts[longer], ends[longer] if n == 0 else starts[longer] + n, A.LOWER)
        bucket = A.mix(h ^ np.uint64(n)) & np.uint64(BUCKETS - 1)
        bucket = bucket | np.uint64(1) if n else bucket & np.uint64(BUCKETS - 2)
        row = rows[longer]
        if wanted is not None:
            hit = wanted[bucket]
            bucket, row = bucket[hit], row[hit]
        parts.append(bucket)
        owners.append(row)
    key, count = np.unique(np.concatenate(owners).astype(np.uint64) * np.uint64(BUCKETS) + np.concatenate(parts), return_counts=True)
    row, bucket = (key // np.uint64(BUCKETS)).astype(np.int64), key % np.uint64(BUCKETS)
    twice, often = count > 1, count > 3
    row, bucket = np.concatenate([row, row[twice], row[often]]), np.concatenate([bucket, _again(bucket[twice], 2), _again(bucket[often], 4)])
    key = np.unique(row.astype(np.uint64) * np.uint64(BUCKETS) + bucket)
    return (key // np.uint64(BUCKETS)).astype(np.int64), (key % np.uint64(BUCKETS)).astype(np.int64)


class Machine:
    """Parameters by feature; ``index`` maps a bucket to its feature or -1."""

    def __init__(self, buckets: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.buckets, self.w0, self.w, self.v = buckets, w0, w, v
        known = np.zeros(BUCKETS, bool)
        known[buckets] = True
        every = np.arange(BUCKETS, dtype=np.uint64)
        self.wanted = known | known[_again(every, 2)] | known[_again(every, 4)]

    def score(self, rows: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        index = np.full(BUCKETS, -1, np.int64)
        index[self.buckets] = np.arange(len(self.buckets))
        feature = index[buckets]
        rows, feature = rows[feature >= 0], feature[feature >= 0]
        z = self.w0 + np.bincount(rows, self.w[feature], n)
        for v in self.v.T:
            z += 0.5 * (np.bincount(rows, v[feature], n) ** 2 - np.bincount(rows, v[feature] ** 2, n))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(kept: np.ndarray, docs: list[np.ndarray], y: np.ndarray, seed: int = 1) -> Machine:
    """Fits by Adam on the logistic loss; each text is given by its features, which are places in ``kept``."""
    y, n_docs = y.astype(np.float32), len(docs)
    share = float(y.mean()) if n_docs else 0.0
    if not 0 < share < 1:
        logit = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Machine(np.zeros(0, np.int64), float(logit), np.zeros(0), np.zeros((0, FACTORS)))
    sizes = np.array([len(x) for x in docs])
    feature, at = np.concatenate(docs), np.concatenate([[0], np.cumsum(sizes)])

    rng = np.random.default_rng(seed)
    f = len(kept)
    # one row per feature: its weight, then its factors; the constant is apart
    p = np.concatenate([np.zeros((f, 1)), rng.normal(0, 0.02, (f, FACTORS))], 1).astype(np.float32)
    w0, m0, s0 = np.log(share / (1 - share)), 0.0, 0.0
    m, s = np.zeros_like(p), np.zeros_like(p)
    decay, step = np.array([WEIGHT_DECAY] + [FACTOR_DECAY] * FACTORS, np.float32), 0
    epochs = max(EPOCHS, -(-STEPS // -(-n_docs // BATCH)))
    for epoch in range(epochs):
        order, rate = rng.permutation(n_docs), 0.02 * 0.1 ** (epoch / epochs)
        for i in range(0, len(order), BATCH):
            batch = order[i : i + BATCH]
            lengths = sizes[batch]
            rows, cols = np.repeat(np.arange(len(batch)), lengths), feature[A.ragged(at[batch], lengths)]
            own = p[cols]
            sums = np.stack([np.bincount(rows, own[:, k], len(batch)) for k in range(FACTORS + 1)], 1).astype(np.float32)
            squares = np.bincount(rows, np.einsum("ij,ij->i", own[:, 1:], own[:, 1:]), len(batch))
            z = w0 + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - squares)
            g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]) / len(batch)).astype(np.float32)
            back = g[rows]
            own[:, 1:] = back[:, None] * (sums[rows, 1:] - own[:, 1:])
            own[:, 0] = back
            grad = np.stack([np.bincount(cols, own[:, k], f) for k in range(FACTORS + 1)], 1).astype(np.float32) + decay * p
            step += 1
            m += 0.1 * (grad - m)
            s += 0.001 * (grad * grad - s)
            p -= rate / (1 - 0.9**step) * m / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
            g0 = float(g.sum())
            m0, s0 = 0.9 * m0 + 0.1 * g0, 0.999 * s0 + 0.001 * g0 * g0
            w0 -= rate * (m0 / (1 - 0.9**step)) / (np.sqrt(s0 / (1 - 0.999**step)) + 1e-8)
    return Machine(kept, float(w0), p[:, 0].astype(np.float64), p[:, 1:].astype(np.float64))


def _features(batch: pa.RecordBatch):
    data, offsets = A.buffer(batch.column("text"))
    labels = batch.column("label")
    for i, j in A.slices(offsets):
        lo = offsets[i]
        rows, buckets = terms(data[lo : offsets[j]], offsets[i : j + 1] - lo)
        cut = np.searchsorted(rows, np.arange(j - i + 1))
        buckets = buckets.astype(np.int32)
        yield {"terms": pa.array([buckets[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()), "label": labels.slice(i, j - i)}


def _holders(batch: pa.RecordBatch):
    """How many texts of the batch, and toxic ones, hold each bucket."""
    sets, y = batch.column("terms").to_pylist(), batch.column("label").to_numpy()
    cols = np.frombuffer(b"".join(sets), np.int32)
    toxic = np.repeat(y, [len(x) // 4 for x in sets])
    n, n1 = np.bincount(cols, minlength=BUCKETS), np.bincount(cols, toxic, BUCKETS).astype(np.int64)
    at = np.flatnonzero(n)
    yield {"bucket": at.astype(np.int32), "n": n[at], "n1": n1[at]}


def deviations(n: np.ndarray, n1: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Standard deviations by which ``n1`` toxic ones of ``n`` are from what ``share`` lets expect."""
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return (n1 - n * share) / np.sqrt(np.maximum(n * share * (1 - share), 1e-9))


def _pair_counter(weak: np.ndarray, known: np.ndarray | None):
    """Counts texts of a batch by pairs of ``weak`` buckets; those of ``known`` pairs only, if given."""
    is_weak = np.zeros(BUCKETS, bool)
    is_weak[weak if known is None else np.concatenate([known >> 18, known & (BUCKETS - 1)])] = True

    def count(batch: pa.RecordBatch):
        found, gathered = [], 0

        def summed():
            pair, n = np.unique(np.concatenate(found), return_counts=True)
            return {"pair": pair, "n": n.astype(np.int64)}

        for raw in batch.column("terms").to_pylist():
            t = np.frombuffer(raw, np.int32).astype(np.int64)
            t = t[is_weak[t]]
            step = max(1, PAIRS // max(1, len(t)))
            for first in range(0, len(t), step):
                own = np.arange(first, min(first + step, len(t)))
                pair = ((t[own] << 18)[:, None] | t)[np.arange(len(t)) > own[:, None]]
                if known is not None and len(known):
                    pair = pair[known[np.minimum(np.searchsorted(known, pair), len(known) - 1)] == pair]
                found.append(pair)
                gathered += len(pair)
                if gathered > 2 * PAIRS:
                    yield summed()
                    found, gathered = [], 0
        if gathered:
            yield summed()

    return count


def pair_members(sets: DataFrame, n: np.ndarray, n1: np.ndarray, total: int, toxic_total: int, strong: np.ndarray) -> np.ndarray:
    """Buckets of pairs that are more often toxic than either member lets expect; pairs are counted in Spark, first among
    toxic texts, then those that enough of them hold among the others."""
    least = max(MIN_DOCUMENTS, PAIR_SHARE * toxic_total)
    weak = np.flatnonzero((n1 >= least) & (n <= COMMON * total) & ~strong & (np.arange(BUCKETS) % 2 == 0))

    def counted(label: int, known: np.ndarray | None) -> pa.Table:
        rows = per_batch(sets.filter(F.col("label") == label).select("terms"), "pair long, n long", _pair_counter(weak, known))
        rows = rows.groupBy("pair").agg(F.sum("n").alias("n"))
        return (rows.filter(F.col("n") >= float(least)) if known is None else rows).sort("pair").toArrow()

    toxic = counted(1, None)
    pair, toxic_n = toxic.column("pair").to_numpy(), toxic.column("n").to_numpy()
    if not len(pair):
        return pair
    rate = n1 / np.maximum(n, 1)
    expected = np.maximum(rate[pair >> 18], rate[pair & (BUCKETS - 1)])
    worth = deviations(toxic_n, toxic_n, expected) > STRONG_PAIR  # even if no other text held them
    pair, toxic_n, expected = pair[worth], toxic_n[worth], expected[worth]
    others, clean_n = counted(0, pair), np.zeros(len(pair), np.int64)
    clean_n[np.searchsorted(pair, others.column("pair").to_numpy())] = others.column("n").to_numpy()
    pair = pair[deviations(toxic_n + clean_n, toxic_n, expected) > STRONG_PAIR]
    return np.unique(np.concatenate([pair >> 18, pair & (BUCKETS - 1)]))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Learns from the labelled rows that are not held out, ``sample`` of them at most; equal sets of terms count once.

    Features are counted in Spark and only those of each sampled text come to the driver. Where a labelled id has
    several texts, the one with the smallest hash is learnt from.
    """
    chosen = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id")) != 1))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    sampled = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", F.xxhash64("text").alias("h"), "text", "label")
    one = sampled.groupBy("doc_id").agg(F.min_by(F.struct("text", "label"), "h").alias("one")).select("one.*")
    sets = saved(per_batch(one, "terms binary, label int", _features).distinct())
    total, toxic = sets.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    held = per_batch(sets, "bucket int, n long, n1 long", _holders).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
    held = held.filter(F.col("n") >= MIN_DOCUMENTS).toArrow()
    n, n1 = np.zeros(BUCKETS), np.zeros(BUCKETS)
    n[held.column("bucket")], n1[held.column("bucket")] = held.column("n"), held.column("n1")
    strong = (n >= MIN_DOCUMENTS) & (np.abs(deviations(n, n1, np.full(BUCKETS, toxic / max(total, 1)))) > STRONG)
    kept = np.union1d(np.flatnonzero(strong), pair_members(sets, n, n1, total, toxic, strong)).astype(np.int64)

    def featured(batch: pa.RecordBatch):
        index = np.full(BUCKETS, -1, np.int32)
        index[kept] = np.arange(len(kept))
        out = []
        for raw in batch.column("terms").to_pylist():
            f = index[np.frombuffer(raw, np.int32)]
            out.append(f[f >= 0].tobytes())
        yield {"key": batch.column("key"), "label": batch.column("label"), "features": pa.array(out, pa.binary())}

    rows = per_batch(sets.select(F.xxhash64("terms").alias("key"), "label", "terms"), "key long, label int, features binary", featured).toArrow()
    rows = rows.sort_by([("key", "ascending"), ("label", "ascending"), ("features", "ascending")])
    return train(kept, [np.frombuffer(x, np.int32) for x in rows.column("features").to_pylist()], rows.column("label").to_numpy())


def score(documents: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    def scored(batch: pa.RecordBatch):
        data, offsets = A.buffer(batch.column("text"))
        out = []
        for i, j in A.slices(offsets):
            rows, buckets = terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], shipped.value.wanted)
            out.append(shipped.value.score(rows, buckets, j - i))
        yield {"doc_id": batch.column("doc_id"), "score": np.concatenate(out)}

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return per_batch(rows, "doc_id long, score double", scored)


def without_toxic(documents: DataFrame, model: Machine, threshold: float = REJECT) -> DataFrame:
    """The documents whose score is below ``threshold``, with all their columns."""
    columns, shipped = documents.columns, documents.sparkSession.sparkContext.broadcast(model)
    at = columns.index("text")

    def kept(batches):
        for batch in batches:
            data, offsets = A.buffer(batch.column(at))
            for i, j in A.slices(offsets):
                rows, buckets = terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], shipped.value.wanted)
                yield batch.slice(i, j - i).filter(pa.array(shipped.value.score(rows, buckets, j - i) < threshold))

    return documents.mapInArrow(kept, documents.schema)
