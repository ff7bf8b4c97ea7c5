"""Phrase collocation mining: candidates from a sketch, counted by automata.

1. A pass over the texts counts words by language. Another fills a sketch: each occurrence of a phrase of two or three words
   raises one of its one-byte counters, which stop at 255; a counter is an upper bound of the count of every phrase that it
   stands for. The sketch grows with the corpus (about eight counters an occurrence) and is never in one place: tasks
   send what they count in stretches, as sorted and compressed differences, to the part of the sketch that owns it.
   The counters that reach ``LEAST`` enter a Bloom filter at the levels that they reach (``LEAST`` times 1, 2, 4 ...), each part in its
   own region. The filter has ``MOST_BITS`` bits at most, whatever the corpus, so it may be broadcast.
2. A further pass collects the phrases that the filter knows. Tasks send them in compressed lists to the part of the sketch that
   owns their counter, where repeated ones fall together. Their counts are bounded by the filter's levels and by
   the counts of their words, and so are their scores.
3. Phrases are counted exactly in rounds, those of the highest bounds first, and with them the longer phrases that
   could drop them and the parts that their scores need. A round's phrases are dealt into automata of at most
   ``PATTERNS`` phrases each, which find them between delimiters, overlaps included, in each shard of the texts; the
   counts of shards are summed. When a language has its full list, candidates whose bounds are below the list's last
   entry can't enter it and need no count; the rounds end when no others are left.

A filter that is full prunes less, and more phrases are carried through step 2; the result is exact all the same. Scores are compared in decimals of 38 digits.

Defined cases: a null text is the empty text; a null language counts as ``und``; rows count one by one, copies too;
ties are ordered by phrase; fewer than ``LIMIT`` phrases give them all; an empty table gives no rows; other columns
are not read, whatever their names.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm import arrays as A
from llm.tables import per_batch, saved

LEAST = 10
HOLDS = 50
LIMIT = 2000
SIZES = (2, 3)
SCALE = 1_000_000
#: Bits of the filter, at most.
MOST_BITS = 1 << 29
#: Places of a key in the filter.
PROBES = 4
#: Counters of a part of the sketch, as a power of two.
PART = 25
#: Occurrences that a task counts before it sends them.
STRETCH = 1 << 22
#: Phrases of one automaton.
PATTERNS = 200_000
#: Candidates of a language in the first round; each round takes four times as many.
FIRST = 8_000
#: Phrases that a task remembers having sent.
SEEN = 1_000_000
#: Bytes of text that an automaton reads at once.
TEXT = 1 << 22
STOP = A.lut([*b".,;:!?", *range(0x0A, 0x0E)])
APART = A.lut([0x20, 0x09], STOP)
_AS_STOP = bytes(0x2E if STOP[b] else 0x20 if b == 9 else b for b in range(256))
_BY_LANGUAGE = np.uint64(0xD6E8FEB86659FD93)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(bytes, start, end, hash, piece and row of each word, first row) of slices of a batch of (lang, text, seed)."""
    whole, ends = A.buffer(batch.column("text"))
    for i, j in A.slices(ends):
        data, offsets = whole[ends[i] : ends[j]], ends[i : j + 1] - ends[i]
        starts, stops, rows = A.runs(data, offsets, APART)
        if len(starts):
            piece = np.cumsum(STOP[data])[starts] + rows
            yield data, starts, stops, A.hashes(data, starts, stops, A.LOWER), piece, rows, i


def _phrases(h: np.ndarray, piece: np.ndarray, seed: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place of the first word) of each run of ``size`` words of one piece; ``seed`` is that of each word's language."""
    gram, at = A.grams(h, piece, size)
    return A.mix(gram + (seed[at] + np.uint64(size)) * _BY_LANGUAGE), at


def _seeds(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("seed").to_numpy().view(np.uint64)


def _count_words(batch: pa.RecordBatch):
    """Words of a slice with their counts, by language."""
    seeds = _seeds(batch)
    for data, starts, ends, h, _, rows, first in _slices(batch):
        key = A.mix(h + seeds[first + rows] * _BY_LANGUAGE)
        _, at, count = np.unique(key, return_index=True, return_counts=True)
        raw = data.tobytes()
        words = [raw[a:b].lower() for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        yield {"lang": batch.column("lang").take(pa.array(first + rows[at])), "word": pa.array(words, pa.binary()).cast(pa.string()), "f": pa.array(count.astype(np.int64))}


def _sent(keys: np.ndarray, parts: int) -> pa.RecordBatch:
    """Counts of ``keys`` by part of the sketch, as differences of sorted counters and their counts, compressed."""
    keys, count = np.unique(keys, return_counts=True)
    cut = np.searchsorted(keys, np.arange(parts + 1, dtype=np.uint64) << np.uint64(PART))
    own = np.flatnonzero(np.diff(cut))
    blobs = []
    for k in own.tolist():
        inside = (keys[cut[k] : cut[k + 1]] & np.uint64((1 << PART) - 1)).astype(np.uint32)
        planes = np.ascontiguousarray(np.diff(inside, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T)
        blobs.append(zlib.compress(planes.tobytes() + np.minimum(count[cut[k] : cut[k + 1]], 255).astype(np.uint8).tobytes(), 1))
    return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(blobs, pa.binary())], ["part", "counts"])


def _fill(bits: int):
    """A task's share of a sketch of 2**bits counters."""
    parts = max(1, 1 << (bits - PART)) if bits > PART else 1

    def fill(batches):
        held, size = [], 0
        for batch in batches:
            seeds = _seeds(batch) if batch.num_rows else None
            for _, _, _, h, piece, rows, first in _slices(batch) if batch.num_rows else ():
                for words in SIZES:
                    held.append(_phrases(h, piece, seeds[first + rows], words)[0] >> np.uint64(64 - bits))
                    size += len(held[-1])
                if size > STRETCH:
                    yield _sent(np.concatenate(held), parts)
                    held, size = [], 0
        if size:
            yield _sent(np.concatenate(held), parts)

    return fill


def _sum_part(least: int):
    """The counters of one part that reach ``least``, and what they say."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << PART, np.uint8)
        for raw in table.column("counts"):
            data = np.frombuffer(zlib.decompress(raw.as_py()), np.uint8)
            n = len(data) // 5
            at = np.cumsum(np.ascontiguousarray(data[: 4 * n].reshape(4, n).T).view(np.uint32).ravel(), dtype=np.int64)
            total[at] = np.minimum(total[at].astype(np.uint16) + data[4 * n :], 255).astype(np.uint8)
        at = np.flatnonzero(total >= min(least, 255))
        return pa.table([pa.array([table.column("part")[0].as_py()], pa.int32()), pa.array([len(at)], pa.int64()), pa.array([at.astype(np.uint32).tobytes()]), pa.array([total[at].tobytes()])], ["part", "n", "counters", "counts"])

    return add


def _levels(least: int) -> list[int]:
    """Counts at which the filter is asked; a counter that reaches none but the first counts less than the second, and so on."""
    out = [min(least, 255)]
    while 2 * out[-1] < 255:
        out.append(2 * out[-1])
    return out


def _places(keys: np.ndarray, level: int, region: int) -> Iterator[np.ndarray]:
    """Bits of the filter that stand for each counter at a level."""
    h = A.mix(keys + np.full(1, level, np.uint64) * _BY_LANGUAGE)
    step = (h >> np.uint64(32)) | np.uint64(1)
    base = (keys >> np.uint64(PART)) * np.uint64(region)
    for k in range(PROBES):
        yield base + ((h + np.uint64(k) * step) & np.uint64(region - 1))


def _regions(least: int, region: int):
    """Each part's region of the filter, compressed."""

    def make(batch: pa.RecordBatch):
        out = []
        for part, at, count in zip(batch.column("part").to_pylist(), batch.column("counters"), batch.column("counts")):
            keys = np.frombuffer(at.as_py(), np.uint32).astype(np.uint64) | (np.uint64(part) << np.uint64(PART))
            count = np.frombuffer(count.as_py(), np.uint8)
            bits = np.zeros(region, np.uint8)
            for level in _levels(least):
                for place in _places(keys[count >= level], level, region):
                    bits[place & np.uint64(region - 1)] = 1
            out.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1))
        yield {"part": batch.column("part"), "bits": pa.array(out, pa.binary())}

    return make


#: What a Python worker keeps between tasks: the sketch, or the automata of one shard.
_kept: dict = {}


def _keep(name, make):
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def _promising(shared, bits: int, region: int, least: int):
    """Phrases whose counter reaches ``least``, in lists by part of the sketch: language, bound of the count, phrase."""
    name, levels = uuid.uuid4().hex, _levels(least)

    def load() -> np.ndarray:
        out = np.zeros(max(1, 1 << max(0, bits - PART)) * region // 8, np.uint8)
        for k, raw in shared.value:
            out[k * region // 8 : (k + 1) * region // 8] = np.frombuffer(zlib.decompress(raw), np.uint8)
        return out

    def known(held: np.ndarray, keys: np.ndarray, level: int) -> np.ndarray:
        """Numbers of the keys that the filter has at a level."""
        some = np.arange(len(keys))
        for k in range(PROBES):
            place = next(islice(_places(keys[some], level, region), k, None))
            some = some[(held[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0]
        return some

    def sent(lists: dict[int, list[bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(lists), pa.int32()), pa.array([zlib.compress(b"\n".join(x), 1) for x in lists.values()], pa.binary())], ["part", "phrases"])

    def find(batches):
        held, seen, lists, size = _keep(name, load), set(), {}, 0
        for batch in batches:
            seeds = _seeds(batch) if batch.num_rows else None
            langs = [json.dumps(x).encode() for x in batch.column("lang").to_pylist()]
            for data, starts, ends, h, piece, rows, first in _slices(batch) if batch.num_rows else ():
                raw = data.tobytes()
                for words in SIZES:
                    key, at = _phrases(h, piece, seeds[first + rows], words)
                    some = known(held, key >> np.uint64(64 - bits), levels[0])
                    keys, index = np.unique(key[some], return_index=True)
                    new = [k for k, x in enumerate(keys.tolist()) if x not in seen]
                    if len(seen) > SEEN:
                        seen.clear()
                    seen.update(keys[new].tolist())
                    some = some[index[new]]
                    if not len(some):
                        continue
                    counter, at = key[some] >> np.uint64(64 - bits), at[some]
                    bound = np.full(len(some), levels[0])
                    for level in levels[1:]:
                        bound[known(held, counter, level)] = level
                    part = (counter >> np.uint64(PART)).tolist()
                    for p, level, row, a, b in zip(part, bound.tolist(), rows[at].tolist(), starts[at].tolist(), ends[at + words - 1].tolist()):
                        lists.setdefault(p, []).append(b"%s\t%d\t%s" % (langs[first + row], level, b" ".join(raw[a:b].lower().split())))
                    size += len(some)
            if size > SEEN:
                yield sent(lists)
                lists, size = {}, 0
        if lists:
            yield sent(lists)

    return find


def _different(least: int):
    """(lang, phrase, size, bound) of the different phrases of a part; a bound is null where the filter has none."""
    last = _levels(least)[-1]

    def make(table: pa.Table) -> pa.Table:
        lines = set()
        for raw in table.column("phrases"):
            lines.update(zlib.decompress(raw.as_py()).split(b"\n"))
        langs, levels, phrases = zip(*(line.split(b"\t") for line in lines))
        bounds = [None if int(x) == last else 2 * int(x) - 1 for x in levels]
        sizes = [x.count(b" ") + 1 for x in phrases]
        return pa.table([pa.array([json.loads(x) for x in langs], pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(sizes, pa.int32()), pa.array(bounds, pa.int64())], ["lang", "phrase", "size", "bound"])

    return make


def _spaced(texts: list[str]) -> Iterator[str]:
    """Lower-cased words with single spaces between and around them, a stop as a word between pieces; in stretches that end with a piece."""
    data = ".".join(texts).encode().lower().translate(_AS_STOP)
    i = 0
    while i < len(data):
        j = data.find(b".", i + TEXT)
        j = len(data) if j < 0 else j
        yield " " + b" ".join(data[i:j].replace(b".", b" . ").split()).decode() + " "
        i = j


def _scan(shared):
    """Occurrences of a shard's phrases in a task's texts, by language."""
    name = uuid.uuid4().hex

    def load() -> dict:
        import ahocorasick

        out = {}
        for lang, phrases in shared.value.items():
            automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            for k, phrase in enumerate(phrases):
                automaton.add_word(f" {phrase} ", k)
            automaton.make_automaton()
            out[lang] = automaton
        return out

    def scan(batches):
        automata = _keep(name, load)
        counts = {lang: np.zeros(len(phrases), np.int64) for lang, phrases in shared.value.items()}
        for batch in batches:
            by_lang, size = {}, 0
            langs, texts = batch.column("lang").to_pylist(), batch.column("text")
            for k, lang in enumerate(langs):
                if lang in automata:
                    by_lang.setdefault(lang, []).append(texts[k].as_py() or "")
                    size += len(by_lang[lang][-1])
                if size > TEXT or k == len(langs) - 1:
                    for own, mine in by_lang.items():
                        for text in _spaced(mine):
                            found = np.fromiter((v for _, v in automata[own].iter(text)), np.int64)
                            counts[own] += np.bincount(found, minlength=len(counts[own]))
                    by_lang, size = {}, 0
        for lang, count in counts.items():
            at = np.flatnonzero(count)
            if len(at):
                phrases = shared.value[lang]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array([phrases[k] for k in at], pa.string()), pa.array(count[at])], ["lang", "phrase", "a"])

    return scan


def _exact(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(lang, phrase, a): exact counts of ``patterns`` (lang, phrase), a saved table."""
    spark = texts.sparkSession
    shards = -(-patterns.count() // PATTERNS)
    shard = F.pmod(F.xxhash64("lang", "phrase"), F.lit(max(1, shards)))
    parts = None
    for k in range(shards):
        names: dict[str, list[str]] = {}
        for r in patterns.filter(shard == k).select("lang", "phrase").toLocalIterator():
            names.setdefault(r.lang, []).append(r.phrase)
        shared = spark.sparkContext.broadcast(names)  # about PATTERNS phrases
        found = saved(texts.select("lang", "text").mapInArrow(_scan(shared), "lang string, phrase string, a long").groupBy("lang", "phrase").agg(F.sum("a").alias("a")))
        shared.unpersist()
        parts = found if parts is None else parts.union(found)
    return parts if parts is not None else spark.createDataFrame([], "lang string, phrase string, a long")


def _wide(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(14,0)")


def _score(a: str, l: str, r: str) -> Column:
    """floor(SCALE a a / (l r)) without overflow."""
    names = {c: f"CAST({c} AS DECIMAL(14,0))" for c in (a, l, r)}
    return F.expr(f"({names[a]} * {names[a]} * CAST({SCALE} AS DECIMAL(7,0))) div ({names[l]} * {names[r]})")


def _parts(phrase: str = "phrase") -> list[Column]:
    word = F.split(phrase, " ")
    return [F.get(word, F.lit(0)).alias("w1"), F.get(word, F.lit(1)).alias("w2"), F.get(word, F.lit(2)).alias("w3")]


def _with_word(df: DataFrame, words: DataFrame, word: str, name: str) -> DataFrame:
    """``df`` with the count of its column ``word``."""
    return df.join(words.select("lang", F.col("word").alias(word), F.col("f").alias(name)), ["lang", word], "left")


def _bounded(found: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """Candidates with upper bounds of their count (a_up) and score (s_up), from the filter and the counts of words."""
    rows = found.select("*", *_parts())
    common = words.filter(F.col("f") >= least)
    for k in (1, 2, 3):
        rows = _with_word(rows, common, f"w{k}", f"f{k}")
    rows = rows.filter("f1 is not null and f2 is not null and (w3 is null or f3 is not null)")
    rows = rows.withColumn("a_up", F.least("f1", "f2", "f3", "bound")).filter(F.col("a_up") >= least)
    # the part of two words of a phrase of three is as frequent as the phrase, at least
    rows = rows.withColumn("most", F.greatest("f1", F.coalesce("f3", "f2")))
    return rows.withColumn("s_up", F.when(F.col("size") == 2, _score("a_up", "f1", "f2")).otherwise(_score("a_up", "most", "a_up")))


def _scored(chosen: DataFrame, counted: DataFrame, least: int, holds: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the chosen phrases that are candidates and that no longer one drops."""
    exact = counted.select("lang", "phrase", "a")
    rows = chosen.join(exact, ["lang", "phrase"]).filter(F.col("a") >= least)
    two, three = rows.filter("size = 2"), rows.filter("size = 3")
    longer = counted.select("lang", "a", *_parts()).filter((F.col("a") >= least) & F.col("w3").isNotNull())
    inside = F.explode(F.array(F.concat_ws(" ", "w1", "w2"), F.concat_ws(" ", "w2", "w3"))).alias("phrase")
    longest = longer.select("lang", inside, "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    two = two.join(longest, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < holds * F.col("a")))
    two = two.select("lang", "phrase", "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"))
    for name, pair in (("front", ("w1", "w2")), ("back", ("w2", "w3"))):
        three = three.withColumn(name, F.concat_ws(" ", *pair)).join(exact.select("lang", F.col("phrase").alias(name), F.col("a").alias(f"f_{name}")), ["lang", name])
    cuts = [F.struct(_score("a", "f1", "f_back").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("f_back").alias("r")), F.struct(_score("a", "f_front", "f3").alias("score"), F.lit(2).alias("k"), F.col("f_front").alias("l"), F.col("f3").alias("r"))]
    three = three.withColumn("cut", F.least(*cuts)).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    return two.union(three)


def _top(rows: DataFrame, limit: int, *order: Column) -> DataFrame:
    """The first rows of each language; tasks apply the limit before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= limit)


def collocations(documents: DataFrame, least: int = LEAST, holds: int = HOLDS, limit: int = LIMIT, first: int = FIRST, bits: int | None = None, most_bits: int = MOST_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the phrases of two and three words with the highest scores, by language."""
    spark = documents.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = documents.select(lang.alias("lang"), F.col("text"), F.xxhash64(lang).alias("seed"))
    words = saved(per_batch(texts, "lang string, word string, f long", _count_words).groupBy("lang", "word").agg(F.sum("f").alias("f")))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    if bits is None:
        characters = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        bits = min(40, max(20, (2 * int(characters)).bit_length()))
    counted_parts = texts.mapInArrow(_fill(bits), "part int, counts binary").groupBy("part").applyInArrow(_sum_part(least), "part int, n long, counters binary, counts binary")
    counters = saved(counted_parts)
    parts = max(1, 1 << max(0, bits - PART))
    reached = counters.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    region = max(64, min(most_bits, 1 << (32 * int(reached)).bit_length()) // parts)
    regions = per_batch(counters.select("part", "counters", "counts"), "part int, bits binary", _regions(least, region))
    filter_ = spark.sparkContext.broadcast([(r.part, bytes(r.bits)) for r in regions.collect()])  # most_bits / 8 bytes at most
    lists = texts.mapInArrow(_promising(filter_, bits, region, least), "part int, phrases binary")
    found = lists.groupBy("part").applyInArrow(_different(least), "lang string, phrase string, size int, bound long")
    candidates = saved(_bounded(found, words, least))
    filter_.unpersist()

    bounds = (F.col("s_up").desc(), F.col("a_up").desc(), F.col("phrase"))
    place = F.struct((-F.col("s_up")).alias("s"), (-F.col("a_up")).alias("a"), F.col("phrase").alias("p"))
    pairs = F.explode(F.array(F.concat_ws(" ", "w1", "w2"), F.concat_ws(" ", "w2", "w3"))).alias("pair")
    chosen = counted = best = None
    left, take = candidates, first
    while True:
        new = saved(_top(left, take, *bounds).drop("rank"))
        if new.isEmpty():
            break
        two, three = new.filter("size = 2").select("lang", "phrase"), new.filter("size = 3")
        # longer phrases that may drop the chosen ones, and parts that scores need
        around = candidates.filter("size = 3").select("lang", "phrase", pairs).join(two.withColumnRenamed("phrase", "pair"), ["lang", "pair"]).select("lang", "phrase")
        parts = three.select("lang", pairs.alias("phrase"))
        patterns = two.union(three.select("lang", "phrase")).union(around).union(parts).distinct()
        if counted is not None:
            patterns = patterns.join(counted.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
        now = _exact(texts, saved(patterns))
        counted = now if counted is None else counted.union(now)
        chosen = new if chosen is None else chosen.union(new)
        best = saved(_top(_scored(chosen, counted, least, holds), limit, F.col("score").desc(), F.col("a").desc(), F.col("phrase")))
        # one row a language in each of these
        last = new.groupBy("lang").agg(F.max(place).alias("last"))
        floor = best.filter(F.col("rank") == limit).select("lang", F.struct((-F.col("score")).alias("s"), (-F.col("a")).alias("a")).alias("floor"))
        ends = F.broadcast(saved(last.join(floor, "lang", "left")))
        bound = F.struct((-F.col("s_up")).alias("s"), (-F.col("a_up")).alias("a"))
        left = left.join(ends, "lang").filter((place > F.col("last")) & (F.col("floor").isNull() | (bound <= F.col("floor")))).drop("last", "floor")
        take *= 4
    if best is None:
        return spark.createDataFrame([], "lang string, rank int, phrase string, a long, l long, r long, n long, score long")
    return best.join(F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
