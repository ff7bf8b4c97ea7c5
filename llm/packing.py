"""Best-fit packing of tokenized documents with swap-based local search.

Tokenizing: the byte-level BPE never merges over the start of a word that follows a single space or line
break, so texts are cut there and each different chunk of a slice is encoded once by the library.
Documents (ids and a final id 0) over the capacity are cut into full pieces; the first piece takes the
rest. Full pieces are sequences of their own.

Packing: pieces are dealt by hash into blocks of about ``BLOCK`` pieces. In a block best-fit decreasing
makes bins; then local search takes the least filled bin and moves its pieces into gaps, or exchanges one
of them for a shorter one, or two of them for a single shorter one, of an underfull bin that is at least
as full. Each step raises the sum of squared fills. The underfull bins are gone through again and again; the
search ends when no step helps for any of them, or when the block has as few bins as its lengths need. Bins
that stay underfull are dealt again, all blocks' together, until one block holds them or a round saves less than
``LEAST_SAVED`` of the bins that were left.

Defined cases: a null text is the empty text, whose only id is 0; repeated rows, equal ids and null ids are
packed row by row, dealt by a key of the row; pieces of equal length go by id, piece and row; an empty table
gives no sequences. Only doc_id and text are read.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import arrays as A
from llm.chunks import table_of
from llm.tables import per_batch, saved

CAPACITY = 2048
#: Pieces that a task packs at once, about.
BLOCK = 4096
#: Bins emptier than this share are packed again.
UNDERFULL = 0.995
#: Share of the left bins that a further round must save.
LEAST_SAVED = 0.001
SOLID = np.array([32 < b != 127 for b in range(256)])
LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
#: Second bytes of two-byte letters whose first byte is C3.
LATIN = np.array([0x80 <= b < 0xC0 and b not in (0x97, 0xB7) for b in range(256)])
STOP = A.lut(".,;:!?")
#: First bytes of characters that may be white space.
DOUBTFUL = A.lut([0xC2, 0xE1, 0xE2, 0xE3])


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of chunks, at places where a pre-token always starts: a text, a single space between words, a
    single line break and what follows it, a stop after a Latin letter."""
    solid = SOLID[data]
    doubtful = np.flatnonzero(DOUBTFUL[data])
    for k in range(3):
        solid[np.minimum(doubtful + k, len(data) - 1)] = False
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    between = before & after & ~first[:-1] & ~first[1:]
    line = between & (data == 10)
    letter = LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & LATIN[data[1:]]
    start = first[:-1] | line | (between & (data == 32))
    start[1:] |= line[:-1] | (letter[:-1] & STOP[data[1:]])
    return np.flatnonzero(start)


def segmenter(path: str):
    """Chunk to ids as bytes."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    whole = Tokenizer.from_file(path)
    merges, shown = whole.model, ByteLevel(add_prefix_space=False, use_regex=False)
    letters = {i: shown.pre_tokenize_str(bytes([i]).decode())[0][0] for i in range(128)}
    for i in range(128, 2048):  # every byte that two-byte characters have, as the tokenizer shows it
        letters.update(zip(chr(i).encode(), shown.pre_tokenize_str(chr(i))[0][0]))

    def segment(chunks: list[bytes]) -> list[bytes]:
        out, rest = [b""] * len(chunks), []
        for k, c in enumerate(chunks):
            text = c.decode()
            if (text[1:] if text[:1] == " " else text).isalpha() and max(c) < 0xE0:  # one pre-token
                out[k] = array("I", [t.id for t in merges.tokenize(c.decode("latin-1").translate(letters))]).tobytes()
            else:
                rest.append((k, text))
        for (k, _), x in zip(rest, whole.encode_batch_fast([t for _, t in rest], add_special_tokens=False)):
            out[k] = array("I", x.ids).tobytes()
        return out

    return segment


#: A text with each place at which ``cut`` cuts, and places at which it doesn't.
PROBE = "One, two; three. four\nfive\n\nsix  seven 8 nine's é. à! (ten) don't\tx \u00a0y ... z9 A-b c_d ÷ × zwölf,dreizehn"


def check_tokenizer(path: str) -> None:
    """Raises where a tokenizer's ids of a text aren't those of the chunks that ``cut`` makes of it."""
    from tokenizers import Tokenizer

    data = np.frombuffer(PROBE.encode(), np.uint8)
    starts = cut(data, np.array([0, len(data)]))
    chunks = [data[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(data)))]
    ids = [i for raw in segmenter(path)(chunks) for i in np.frombuffer(raw, np.uint32)]
    if ids != Tokenizer.from_file(path).encode(PROBE, add_special_tokens=False).ids:
        raise ValueError("this tokenizer has tokens over the places at which texts are cut")


def pieces(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row's pieces."""
    path = path or tokenizer_path()
    check_tokenizer(path)

    def split(batch: pa.RecordBatch):
        table = table_of("byte bpe", path, segmenter)
        ids = batch.column("doc_id").to_pylist()
        whole, ends = A.buffer(batch.column("text"))
        for i, j in A.slices(ends):
            data, offsets = whole[ends[i] : ends[j]], ends[i : j + 1] - ends[i]
            starts = cut(data, offsets) if len(data) else np.zeros(0, np.int64)
            values, at = table.values(data, starts, np.append(starts[1:], len(data))) if len(starts) else ([], np.zeros(0, np.int64))
            first, at = np.searchsorted(starts, offsets).tolist(), at.tolist()
            out = []
            for k in range(j - i):
                mine = memoryview(b"".join(map(values.__getitem__, at[first[k] : first[k + 1]])) + b"\0\0\0\0")
                n = len(mine) // 4
                start, length = 0, n % capacity or capacity
                for piece in range(-(-n // capacity)):
                    out.append((ids[i + k], piece, start, length, zlib.crc32(mine[4 * start : 4 * (start + length)])))
                    start, length = start + length, capacity
            yield dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), (pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())))))

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return per_batch(rows, "doc_id long, piece int, start long, length long, ids_crc32 long", split, "byte bpe")


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that has room."""
    gaps: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by gap
    used = []  # gaps that have bins, sorted
    bins: list[list[int]] = []
    for item in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[item])
        k = bisect_left(used, n)
        if k < len(used):
            gap = used[k]
            b = gaps[gap].pop()
            if not gaps[gap]:
                used.pop(k)
        else:
            gap, b = capacity, len(bins)
            bins.append([])
        bins[b].append(item)
        if not gaps[gap - n]:
            insort(used, gap - n)
        gaps[gap - n].append(b)
    return bins


class _Bins:
    """Bins under search: the bin of each piece, the fill of each bin."""

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, capacity: int):
        self.size, self.capacity, self.bins = np.asarray(lengths, np.int64), capacity, [list(b) for b in bins]
        self.owner = np.zeros(len(self.size), np.int64)
        for k, b in enumerate(self.bins):
            self.owner[b] = k
        self.fill = np.bincount(self.owner, self.size, len(self.bins)).astype(np.int64)
        by_fill = np.argsort(self.fill, kind="stable")
        self.open = by_fill[self.fill[by_fill] < capacity]
        self.items = np.flatnonzero(np.isin(self.owner, self.open))

    def put(self, victim: int, target: int, give: list[int], take: list[int]) -> bool:
        for source, goal, items in ((victim, target, give), (target, victim, take)):
            for i in items:
                self.bins[source].remove(i)
                self.bins[goal].append(i)
                self.owner[i] = goal
        moved = int(self.size[give].sum() - self.size[take].sum())
        self.fill[target] += moved
        self.fill[victim] -= moved
        return True

    def step(self, victim: int) -> bool:
        """One move, or else the exchange that raises another bin's fill most."""
        mine = sorted(self.bins[victim], key=lambda i: (-self.size[i], i))
        others = self.open[(self.open != victim) & (self.fill[self.open] >= max(1, self.fill[victim]))]
        gap = self.capacity - self.fill[others]
        for i in mine:
            room = np.flatnonzero(gap >= self.size[i])
            if len(room):
                return self.put(victim, int(others[room[np.argmin(gap[room])]]), [i], [])
        theirs = self.items[(self.owner[self.items] != victim) & (self.fill[self.owner[self.items]] >= self.fill[victim])]
        if not len(theirs) or not mine:
            return False
        # what the victim can give: one piece or two, by length; equal lengths are the same offer
        first, second = {}, {}
        for i in mine:
            (second if int(self.size[i]) in first else first).setdefault(int(self.size[i]), i)
        offers = {n: [i] for n, i in first.items()}
        names = sorted(first)
        for a, n in enumerate(names):
            for m in names[a:]:
                other = second.get(n) if m == n else first[m]
                if other is not None:
                    offers.setdefault(n + m, [first[n], other])
        totals = np.array(sorted(offers))
        most = self.size[theirs] + self.capacity - self.fill[self.owner[theirs]]
        at = np.searchsorted(totals, most, "right") - 1
        gain = np.where(at >= 0, totals[np.maximum(at, 0)] - self.size[theirs], 0)
        best = int(gain.argmax())
        if gain[best] <= 0:
            return False
        return self.put(victim, int(self.owner[theirs[best]]), offers[int(totals[at[best]])], [int(theirs[best])])


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Moves and exchanges between underfull bins, from the least filled one, until none helps or the bins are as few as can be."""
    state = _Bins(bins, lengths, capacity)
    least, alive, helped = -(-int(state.size.sum()) // capacity), len(state.bins), True
    while helped and alive > least:
        helped = False
        for victim in sorted(state.open.tolist(), key=lambda b: (state.fill[b], b)):
            was = state.fill[victim] > 0
            while state.fill[victim] and state.step(victim):
                helped = True
            alive -= int(was and not state.fill[victim])
            if alive <= least:
                break
        state.open = np.array([b for b in state.open if 0 < state.fill[b] < capacity], np.int64)
        state.items = state.items[np.isin(state.owner[state.items], state.open)]
    return [b for b in state.bins if b]


def _packer(capacity: int, level: int):
    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        order = np.lexsort([table.column("row_key").to_numpy(), table.column("piece").to_numpy(), table.column("doc_id").fill_null(-1).to_numpy(), -lengths])
        table, lengths = table.take(pa.array(order)), lengths[order]
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        sequence, offset, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
        base = (level << 53) + (int(table.column("block")[0].as_py()) << 24)
        for k, b in enumerate(bins):
            own = lengths[b]
            sequence[b], offset[b], fill[b] = base + k, np.cumsum(own) - own, own.sum()
        return table.select([*_COLUMNS, "row_key"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)).append_column("fill", pa.array(fill))

    return pack


_COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32")


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """``items`` (as from ``pieces``) with sequence_id and offset."""
    items = saved(items.select(*_COLUMNS, F.monotonically_increasing_id().alias("row_key")))
    full = items.filter(F.col("length") == capacity).select(*_COLUMNS, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest, done, level, before = items.filter(F.col("length") < capacity), full, 1, None
    blocks = max(1, -(-rest.count() // block))
    while True:
        dealt = rest.withColumn("block", F.pmod(F.xxhash64("row_key", F.lit(level)), F.lit(blocks)))
        packed = dealt.groupBy("block").applyInArrow(
            _packer(capacity, level), "doc_id long, piece int, start long, length long, ids_crc32 long, row_key long, sequence_id long, offset long, fill long"
        )
        if blocks == 1:
            return done.union(packed.select(*done.columns))
        packed = saved(packed)
        bins = packed.filter("offset = 0").agg(F.count("*").alias("all"), F.count(F.when(F.col("fill") < UNDERFULL * capacity, 1)).alias("left")).first()
        if before is not None and before - bins["all"] <= LEAST_SAVED * before:
            return done.union(packed.select(*done.columns))
        done = done.union(packed.filter(F.col("fill") >= UNDERFULL * capacity).select(*done.columns))
        rest, before, level = packed.filter(F.col("fill") < UNDERFULL * capacity).select(*_COLUMNS, "row_key"), bins["left"], level + 1
        blocks = max(1, -(-rest.count() // block))
