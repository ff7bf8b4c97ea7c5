"""N-gram Jaccard join: which documents share 80 % or more of their distinct five-word shingles.

1. A pass over the whole texts gives each document the size of its shingle set and a 128-bit digest of it.
   Equal digests form classes of exact copies, which are joined without comparing them.
2. A second pass looks at the first shingles of each set only, in the order of their hashes: of n shingles
   the first n - ceil(0.8 n) + c(n), with c(n) = 1 + floor(n / 5). Two linked sets have at least c(m)
   shingles in common among those, m being the smaller size, so that a document with fewer than
   c(ceil(0.8 n)) of them held by others can't link and leaves. Nothing but these shingles travels.
3. The texts of the classes that are left are fetched once each, and the document frequency of all their
   shingles is counted among them. A set with under 80 % of shared shingles leaves.
4. The survivors order their shingles rarest first. The prefix (n - ceil(0.8 n) + 1 shingles) is what a
   linked pair must have in common; documents that share a prefix shingle are candidates if they also
   pass the length filter, the positional filter and a suffix filter (the hash space is cut into 256
   segments; segments in which one set holds an odd number of shingles and the other an even number
   bound the symmetric difference from below).
5. Candidates are verified once by a true intersection. A group of a prefix shingle is not expanded
   into all its pairs: in each round a few pivots of the group meet the others; whoever links joins
   the pivot's component, a group whose members are in one component is finished, and pivots that met
   the whole group leave it. Four times as many pivots are taken in the second round and sixteen times as many
   in each further one, so the rounds are few; every pair of a group is either compared, ruled out by a filter,
   or already connected.

Counting: a task gathers sets into chunks, and sends each different shingle of a chunk once, with its count
there, to the part of the hash space that owns it; what a shingle that very many documents hold costs a part
grows with the number of chunks only. Parts and chunks grow with the corpus: a part holds about ``PART``
entries, a chunk a few for each part.

Shingles are 64-bit hashes; the first count goes by 38 bits or more of them, which can only keep too much. Rows are
fetched by id and text, so that many texts of one id cost what those of many ids do, and tasks sort what they
fetched, so that a task that runs again makes the same chunks; the first pass relies on its input for that, as
files give it. Defined cases: null and empty texts, and texts without words, have no
shingles and link with nothing; texts of one to four words have one shingle, the whole sequence; repeated
rows and equal ids fall into one class; a row without an id belongs to the component of the rows that it
links with, which is null where none has an id; an empty table gives an empty result. Only doc_id and text
are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm import arrays as A
from llm.graph import components
from llm.tables import per_batch, saved

WORDS = 5
PERCENT = 80
#: Rows of a text slice, at most.
ROWS = 2048
SEGMENTS = 256
#: Entries that one part of the hash space should hold, about.
PART = 1 << 21
#: A chunk has fewer rows than this; it also stands for "no row".
NO_ROW = 65535
#: Rows of a table without texts that a task reads, about: the driver keeps and logs something for each task.
READ = 1 << 17
#: Classes with more than this share of all rows are joined by broadcast; there are fewer than its inverse.
HOT = 0.001


def least_common(n, percent: int):
    """Shingles of a set of n that a linked set must hold, too."""
    return -(-percent * n // 100)


def extra(n):
    """What the hash-order prefix holds beyond the n - ceil(0.8 n) shingles that may be missing."""
    return 1 + n // 5


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle) pairs, sorted."""
    starts, ends, rows = A.runs(data, offsets, A.SPACE)
    h = A.hashes(data, starts, ends, A.LOWER)
    gram, at = A.grams(h, rows, WORDS)
    owner = rows[at]
    per = np.bincount(rows, minlength=len(offsets) - 1)
    few = (per > 0) & (per < WORDS)
    if few.any():
        mine = few[rows]
        first = np.searchsorted(rows, rows[mine])
        place = np.flatnonzero(mine) - first
        short = np.zeros(len(per), np.uint64)
        np.add.at(short, rows[mine], A.mix(h[mine] + place.astype(np.uint64)))
        gram = np.concatenate([gram, A.mix(short[few] + per[few].astype(np.uint64))])
        owner = np.concatenate([owner, np.flatnonzero(few)])
    if few.any():
        order = np.argsort(owner, kind="stable")
        gram, owner = gram[order], owner[order]
    cut = np.searchsorted(owner, np.arange(len(offsets))).tolist()
    for a, b in zip(cut, cut[1:]):
        gram[a:b].sort()
    new = np.append(True, (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1]))[: len(gram)]
    return owner[new], gram[new]


def _sets(batch: pa.RecordBatch):
    """(first row, last row, row of each shingle, shingle, size and both digests of each row) by slice."""
    data, offsets = A.buffer(batch.column("text"))
    for a, b in A.slices(offsets, 2 * A.SLICE):
        for i in range(a, b, ROWS):
            j = min(b, i + ROWS)
            rows, tokens = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            cut = np.searchsorted(rows, np.arange(j - i + 1))
            digests = []
            for seed in (0x51ED, 0xC0FFEE):
                total = np.zeros(len(tokens) + 1, np.uint64)
                np.cumsum(A.mix(A.mix(tokens + np.uint64(seed)) + np.uint64(seed)), out=total[1:])
                digests.append(A.mix(total[cut[1:]] - total[cut[:-1]] + np.diff(cut).astype(np.uint64)).view(np.int64))
            yield i, j, rows, tokens, np.diff(cut), *digests


def _stats(batch: pa.RecordBatch):
    for i, j, _, _, n, d1, d2 in _sets(batch):
        yield {"doc_id": batch.column("doc_id").slice(i, j - i), "h": batch.column("h").slice(i, j - i), "n": n, "d1": d1, "d2": d2}


def _blobs(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """One binary value for each pair of consecutive positions in ``cut``."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer((cut * values.itemsize).astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())


def _parse(values: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """(all values, number of values by row) of a binary column."""
    raw = [x.as_py() for x in values]
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(raw), kind), np.array([len(x) // size for x in raw], np.int64)


_SENT = "part int, chunk long, rows binary, low binary, high binary, count binary"


class _Chunk:
    """Sets that a task has gathered: rows and shingles, and of each row its size and two facts."""

    def __init__(self):
        self.rows, self.tokens, self.facts, self.n_rows, self.n_tokens = [], [], [], 0, 0

    def add(self, rows: np.ndarray, tokens: np.ndarray, facts: np.ndarray) -> None:
        self.rows.append(rows + self.n_rows)
        self.tokens.append(tokens)
        self.facts.append(facts)
        self.n_rows += facts.shape[1]
        self.n_tokens += len(tokens)

    def batches(self, bits: int, number: int, first: bool):
        """Its different shingles by part, and one row with part < 0 for what stays with the chunk: the facts,
        and in the counting among survivors the rows of shingles that several of its sets hold."""
        rows, tokens, facts = np.concatenate(self.rows), np.concatenate(self.tokens), np.concatenate(self.facts, 1)
        order = np.lexsort([tokens, tokens & np.uint64((1 << bits) - 1)])
        rows, tokens = rows[order], tokens[order]
        new = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        count = np.diff(np.append(new, len(tokens)))
        several = np.repeat(count > 1, count)
        kept_rows, kept_tokens = rows[several], tokens[several]
        if first:
            kept_rows, kept_tokens = np.bincount(kept_rows, minlength=self.n_rows), kept_tokens[:0]
        rows, tokens = np.where(count > 1, NO_ROW, rows[new]), tokens[new]
        part, rest = (tokens & np.uint64((1 << bits) - 1)).astype(np.int64), tokens >> np.uint64(bits)
        names = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        cut = np.append(names, len(part))
        none = np.zeros(len(cut), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part[names], pa.int32()), pa.array(np.full(len(names), number)), _blobs(rows.astype(np.uint16), cut), _blobs(rest.astype(np.uint32), cut),
                _blobs((rest >> np.uint64(32)).astype(np.uint32), none if first else cut), _blobs(count.astype(np.uint16), none if first else cut),
            ],
            ["part", "chunk", "rows", "low", "high", "count"],
        )
        kept = [facts.astype(np.int64).tobytes(), kept_rows.astype(np.uint32).tobytes(), kept_tokens.tobytes(), b""]
        yield pa.RecordBatch.from_arrays([pa.array([-1 - (number & 1023)], pa.int32()), pa.array([number]), *(pa.array([x], pa.binary()) for x in kept)], ["part", "chunk", "rows", "low", "high", "count"])


def _sender(bits: int, percent: int, first: bool):
    """Sends shingles to 2**bits parts. ``first``: the start of each set in hash order, whose facts are its digests;
    else whole sets of the rows whose digests are as expected, whose facts are u and nothing."""
    most = max(1 << 19, 4 << bits)

    def send(batches):
        seen, chunk, number = set(), _Chunk(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, j, rows, tokens, n, d1, d2 in _sets(batch) if batch.num_rows else ():
                alive, u = n > 0, d1
                if not first:
                    own = batch.slice(i, j - i)
                    alive &= (d1 == own.column("d1").to_numpy()) & (d2 == own.column("d2").to_numpy())
                    u = own.column("u").to_numpy()
                for k in np.flatnonzero(alive):
                    name = (int(d1[k]), int(d2[k]))
                    alive[k] = name not in seen
                    seen.add(name)
                cut = np.searchsorted(rows, np.arange(len(n) + 1))
                length = n - least_common(n, percent) + extra(n) if first else n
                who = np.flatnonzero(alive)
                for a in range(0, len(who), 1024):
                    w = who[a : a + 1024]
                    if chunk.n_tokens > most or chunk.n_rows + len(w) >= NO_ROW:
                        yield from chunk.batches(bits, number, first)
                        chunk, number = _Chunk(), number + 1
                    length_w = np.minimum(length[w], n[w])
                    chunk.add(np.repeat(np.arange(len(w)), length_w), tokens[A.ragged(cut[w], length_w)], np.stack([n[w], u[w], d2[w]]))
        if chunk.n_tokens:
            yield from chunk.batches(bits, number, first)

    return send


_COUNTED = "chunk long, head boolean, rows binary, tokens binary, q binary"
_COUNTED_TYPES = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]


def _count(bits: int, first: bool):
    """Shingles of one part that two sets or more hold go back to their chunks: their rows, and among survivors
    the shingle and its document frequency, as a byte that grows with it."""

    def count(table: pa.Table) -> pa.Table:
        names = ["chunk", "head", "rows", "tokens", "q"]
        part = table.column("part")[0].as_py()
        if part < 0:
            return pa.table([table.column("chunk"), pa.array([True] * len(table)), table.column("rows"), table.column("low"), table.column("high")], names)
        rows, per = _parse(table.column("rows"), np.uint16)
        tokens = _parse(table.column("low"), np.uint32)[0]
        held = np.where(rows == NO_ROW, 2, 1)
        if not first:
            tokens = tokens.astype(np.uint64) | (_parse(table.column("high"), np.uint32)[0].astype(np.uint64) << np.uint64(32))
            held = _parse(table.column("count"), np.uint16)[0].astype(np.int64)
        order = np.argsort(tokens, kind="stable")
        ordered = tokens[order]
        new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        df = np.add.reduceat(held[order], new)
        each = np.empty(len(tokens), np.int64)
        each[order] = np.repeat(df, np.diff(np.append(new, len(ordered))))
        keep = each > 1
        if first:
            keep &= rows != NO_ROW
        cut = np.append(0, np.cumsum(keep))[np.append(0, np.cumsum(per))]
        tokens = (tokens[keep].astype(np.uint64) << np.uint64(bits)) | np.uint64(part)
        q = np.minimum(255, 8 * np.log2(each[keep])).astype(np.uint8)
        none = np.zeros(len(cut), np.int64)
        arrays = [table.column("chunk").combine_chunks(), pa.array([False] * len(table)), _blobs(rows[keep], cut), _blobs(tokens, none if first else cut), _blobs(q, none if first else cut)]
        return pa.table([a.cast(k) for a, k in zip(arrays, _COUNTED_TYPES)], names).filter(pa.array(np.diff(cut) > 0))

    return count


def _gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Table]:
    """(facts of a chunk's rows, what it kept: rows and shingles, what came back)."""
    is_head = table.column("head").to_numpy(zero_copy_only=False)
    head = table.filter(pa.array(is_head)).slice(0, 1).to_pylist()[0]
    return np.frombuffer(head["rows"], np.int64).reshape(3, -1), np.frombuffer(head["tokens"], np.uint32).astype(np.int64), np.frombuffer(head["q"], np.uint64), table.filter(pa.array(~is_head))


def _possible(percent: int):
    """Digests of one chunk's sets that hold enough shared shingles in their hash-order prefix."""

    def choose(table: pa.Table) -> pa.Table:
        (n, d1, d2), own, _, body = _gathered(table)
        shared = own + np.bincount(_parse(body.column("rows"), np.uint16)[0], minlength=len(n))
        alive = shared >= extra(least_common(n, percent))
        return pa.table([d1[alive], d2[alive]], ["d1", "d2"])

    return choose


def _survivors(percent: int):
    """Sets of one chunk that hold enough shared shingles: their prefix, segments and shared shingles."""

    def choose(table: pa.Table) -> pa.Table:
        names = ["u", "n", "own", "prefix", "s0", "s1", "s2", "s3", "tokens"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), *[pa.int64()] * 4, pa.binary()]
        (n, u, _), kept_rows, kept_tokens, body = _gathered(table)
        rows, tokens, df = _parse(body.column("rows"), np.uint16)[0].astype(np.int64), _parse(body.column("tokens"), np.uint64)[0], _parse(body.column("q"), np.uint8)[0]
        several = rows == NO_ROW
        order = np.argsort(tokens[several])
        at = order[np.searchsorted(tokens[several], kept_tokens, sorter=order)] if len(order) else order
        rows, tokens, df = (np.concatenate(x) for x in ((rows[~several], kept_rows), (tokens[~several], kept_tokens), (df[~several], df[several][at])))
        shared = np.bincount(rows, minlength=len(n))
        least = least_common(n, percent)
        alive = shared >= least
        keep = alive[rows]
        rows, tokens, df = rows[keep], tokens[keep], df[keep]
        if not len(rows):
            return pa.table([pa.array([], k) for k in kinds], names)
        segment = (A.mix(tokens + np.uint64(99)) & np.uint64(SEGMENTS - 1)).astype(np.int64)
        odd = (np.bincount(rows * SEGMENTS + segment, minlength=len(n) * SEGMENTS) & 1).astype(np.uint8)
        signature = np.packbits(odd.reshape(len(n), SEGMENTS), axis=1)
        who = np.flatnonzero(alive)
        own = (n - shared)[who]
        length = (n - least + 1)[who] - own
        order = np.lexsort([tokens, df, rows])
        first = np.searchsorted(rows[order], who)
        prefix = tokens[order][A.ragged(first, length)].view(np.int64)
        order = np.lexsort([tokens, rows])
        cut = np.append(np.searchsorted(rows[order], who), len(rows))
        packed = signature[who].view(np.int64)
        arrays = [
            pa.array(u[who]), pa.array(n[who], pa.int32()), pa.array(own, pa.int32()),
            pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(prefix)),
            *(pa.array(np.ascontiguousarray(packed[:, k])) for k in range(4)), _blobs(tokens[order], cut),
        ]
        return pa.table(arrays, names)

    return choose


def _verified(percent: int):
    def verify(batch: pa.RecordBatch):
        a, b = batch.column("tokens_a"), batch.column("tokens_b")
        common = np.array([len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), True)) for x, y in zip(a, b)], np.int64)
        union = batch.column("n_a").to_numpy().astype(np.int64) + batch.column("n_b").to_numpy() - common
        yield {"a": batch.column("a"), "b": batch.column("b"), "linked": 100 * common >= percent * union}

    return verify


def _differences(x: str, y: str):
    """Segments in which two signatures differ."""
    return sum((F.bit_count(F.col(f"{x}s{k}").bitwiseXOR(F.col(f"{y}s{k}"))) for k in range(1, 4)), F.bit_count(F.col(f"{x}s0").bitwiseXOR(F.col(f"{y}s0"))))


def _open(posts: DataFrame, facts: tuple[str, ...], percent: int) -> DataFrame:
    """Posts of groups that span components, without members whose shared shingles can't suffice even for
    the smallest set of their group."""
    groups = posts.groupBy("token").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.min("n").alias("n_least")).filter("least < most")
    enough = (100 + percent) * (F.col("n") - F.col("own")) >= percent * (F.col("n") + F.col("n_least"))
    return posts.join(groups, "token").filter(enough).select(*facts, "at", "token", "label")


def _place(first: bool, prefix: str = "") -> Column:
    """The order of a group's members: first the most typical one, then the smallest sets; once those are gone, the
    bound of ``_open`` is sharp."""
    by = ("own", "n") if first else ("n", "own")
    return F.struct(*(F.col(prefix + c).cast("long").alias(c) for c in by), F.xxhash64(prefix + "v").alias("h"), F.col(prefix + "v").alias("v"))


def _labels(survivors: DataFrame, percent: int) -> DataFrame | None:
    """(v, label) of survivors (v, n, own, prefix, s0.., tokens) that link with another: the smallest v of their component."""
    facts = ("v", "n", "own", "s0", "s1", "s2", "s3")
    posts = survivors.select(*facts, F.posexplode("prefix").alias("at", "token")).withColumn("at", F.col("at") + F.col("own"))
    posts = saved(_open(posts.withColumn("label", F.col("v")), facts, percent))
    sets, all_links, labels, pivots = survivors.select("v", "tokens"), None, None, 1
    while posts.take(1):
        # the pivots of a group are found by a limit that each task applies before the shuffle
        place = _place(pivots == 1)
        order = Window.partitionBy("token").orderBy(place)
        chosen = saved(posts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= pivots).select("token", *(F.col(c).alias(f"p_{c}") for c in (*facts, "at", "label"))))
        n, m = F.col("n"), F.col("p_n")
        need = F.ceil(percent * (n + m) / F.lit(100.0 + percent))  # of common shingles
        candidate = (
            (F.col("label") != F.col("p_label")) & (place > _place(pivots == 1, "p_"))
            & (100 * F.least(n, m) >= percent * F.greatest(n, m))
            & (F.least(n - F.col("at"), m - F.col("p_at")) + F.least(F.col("at") - F.col("own"), F.col("p_at") - F.col("p_own")) >= need)
            & (F.col("own") + F.col("p_own") + _differences("", "p_") <= n + m - 2 * need)
        )
        pairs = posts.join(chosen, "token").filter(candidate).select(F.col("p_v").alias("a"), F.col("v").alias("b"), m.alias("n_a"), n.alias("n_b")).distinct()
        full = pairs.join(sets.select(F.col("v").alias("a"), F.col("tokens").alias("tokens_a")), "a").join(sets.select(F.col("v").alias("b"), F.col("tokens").alias("tokens_b")), "b")
        # few rows of many tasks; b, as many share one pivot
        links = saved(per_batch(full, "a long, b long, linked boolean", _verified(percent)).filter("linked").select("a", "b").repartition("b"))
        last = chosen.groupBy("token").agg(F.max(_place(pivots == 1, "p_")).alias("last"))
        rest = posts.join(last, "token").filter(place > F.col("last")).drop("last")
        if links.take(1):
            all_links = links if all_links is None else all_links.union(links)
            labels = components(all_links)
            rest = rest.drop("label").join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
        posts = saved(_open(rest, facts, percent))
        pivots *= 4 if pivots == 1 else 16
    return labels


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; components by links of ``percent`` or more."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = saved(per_batch(texts.withColumn("h", F.xxhash64("text")), "doc_id long, h long, n long, d1 long, d2 long", _stats))
    n_rows, n_named, total = docs.agg(F.count("*"), F.count("doc_id"), F.coalesce(F.sum("n"), F.lit(0))).first()
    docs = docs.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, -(-n_rows // READ)))
    # a class is known by its smallest id; one without ids by a number that no usual id has
    unnamed = F.lit(1 << 62) + F.min("d1").bitwiseAND(F.lit((1 << 61) - 1))
    named_first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "h"))).alias("named")
    classes = saved(
        docs.filter("n > 0").groupBy("d1", "d2")
        .agg(named_first, F.min(F.when(F.col("doc_id").isNull(), F.col("h"))).alias("h"), F.count("*").alias("copies"), unnamed.alias("unnamed"))
        .select("d1", "d2", F.coalesce("named.doc_id", "unnamed").alias("u"), "named.doc_id", F.coalesce("named.h", "h").alias("h"), "copies")
    )

    def counted(df: DataFrame, entries: float, first: bool) -> DataFrame:
        bits = max(6, math.ceil(math.log2(max(1, entries / PART))))
        return df.mapInArrow(_sender(bits, percent, first), _SENT).groupBy("part").applyInArrow(_count(bits, first), _COUNTED).groupBy("chunk")

    possible = counted(texts.select("text"), total * (120 - percent) / 100, True).applyInArrow(_possible(percent), "d1 long, d2 long")
    possible = saved(classes.join(possible.distinct(), ["d1", "d2"]))
    facts = ("u", "d1", "d2")
    hashed = texts.withColumn("h", F.xxhash64("text"))
    fetched = possible.filter("doc_id is not null").select("doc_id", "h", *facts).join(hashed.filter("doc_id is not null"), ["doc_id", "h"]).select(*facts, "text")
    if n_named < n_rows:
        unnamed_texts = hashed.filter("doc_id is null").select("text", "h").distinct()
        fetched = fetched.union(possible.filter("doc_id is null").select("h", *facts).join(unnamed_texts, "h").select(*facts, "text"))
    chosen = counted(fetched.sortWithinPartitions("d1", "d2"), total / 2, False).applyInArrow(_survivors(percent), "u long, n int, own int, prefix array<long>, s0 long, s1 long, s2 long, s3 long, tokens binary")
    labels = _labels(saved(chosen).withColumnRenamed("u", "v"), percent)

    named = classes.filter("copies > 1")
    if labels is not None:
        named = classes.join(labels.withColumnRenamed("v", "u"), "u", "left").filter((F.col("copies") > 1) | F.col("label").isNotNull()).withColumn("u", F.coalesce("label", "u"))
    component = F.when(F.col("doc_id").isNotNull() | (F.col("u") < 1 << 62), F.col("u")).alias("component")
    named = saved(named.select("d1", "d2", component, "copies"))
    out = docs.select("doc_id", F.col("n").alias("n_shingles"), "d1", "d2")
    some = out.filter("n_shingles > 0")
    hot = F.broadcast(named.filter(F.col("copies") > HOT * n_rows).drop("copies"))
    parts = some.join(hot, ["d1", "d2"]), some.join(hot, ["d1", "d2"], "left_anti").join(named.drop("copies"), ["d1", "d2"], "left")
    alone = out.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return alone.union(parts[0].union(parts[1].select(parts[0].columns)).select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def without_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that with the smallest id, with all columns.

    Of rows that share an id one stays; rows with a null id, and rows without words, all stay.
    """
    groups = saved(near_duplicates(documents, percent).filter("n_shingles > 0 and doc_id is not null").select("doc_id", "component_id"))
    drop = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    kept = documents.join(drop, documents["doc_id"] == drop["doc_id"], "left_anti")
    twice = groups.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    if not twice.take(1):
        return kept
    again = kept.join(twice, kept["doc_id"] == twice["doc_id"], "left_semi").dropDuplicates(["doc_id"])
    return kept.join(twice, kept["doc_id"] == twice["doc_id"], "left_anti").unionByName(again)
