"""Numpy helpers that the operators of this package run inside Spark tasks.

Text arrives as Arrow string arrays. ``buffer`` exposes the UTF-8 bytes of a whole column without
making Python strings; ``words`` finds separator-delimited runs in those bytes and hashes each run to
64 bits. Everything works on blocks of bounded size, so memory does not follow the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are handled at a time.
SLICE = 4 << 20
BLOCK = 1 << 18


def lut(values: str | bytes | list[int], base: np.ndarray | None = None) -> np.ndarray:
    """Boolean table over byte values, true for ``values``."""
    table = np.zeros(256, bool) if base is None else base.copy()
    table[list(values.encode() if isinstance(values, str) else values)] = True
    return table


#: ``[\x20\x09-\x0D]``
SPACE = lut([0x20, *range(0x09, 0x0E)])
#: Everything in ASCII that is neither letter nor digit; bytes over 127 belong to words.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32
#: 1 for each byte that starts a code point.
STARTS_CHAR = np.array([(b & 0xC0) != 0x80 for b in range(256)])


def _spread(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


_SHIFTS = _spread(64, 11)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Keeps the first k of eight bytes.
_KEEP = np.array([2 ** (8 * k) - 1 for k in range(9)], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes each, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def runs(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each maximal run of bytes that aren't separators; runs end with their row."""
    inside = ~separator[data]
    before = np.empty_like(inside)
    if len(before):
        before[0] = False
        before[1:] = inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[first] = False
    starts = np.flatnonzero(inside & ~before)
    stop = inside.copy()
    if len(stop):
        stop[:-1] &= ~inside[1:]
        stop[first[1:] - 1] = inside[first[1:] - 1]
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _eights(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eight bytes each of spans of ``data``, the last filled up with zeros; place in its span; blocks of each span)."""
    count = (ends - starts + 7) // 8
    first = np.cumsum(count) - count
    place = np.arange(int(count.sum())) - np.repeat(first, count)
    at = np.repeat(starts, count) + 8 * place
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    every = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    return every[at] & _KEEP[np.minimum(np.repeat(ends, count) - at, 8)], place, count


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
    """64-bit hash of each span of bytes, after ``fold``. Spans are sorted, not empty, and do not overlap.

    Each eight bytes are mixed, mixed again with their place in the span, and summed, so that words which
    defeat a polynomial (those in the order of Thue and Morse, say) get different hashes.
    """
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        for a in range(base, int(ends[j - 1]), 8 * BLOCK):  # more than one step only for a long span, alone
            part = fold[data[a : min(int(ends[j - 1]), a + 8 * BLOCK)]]
            from_, to = np.maximum(starts[i:j], a) - a, np.minimum(ends[i:j] - a, len(part))
            values, place, count = _eights(part, from_, to)
            place = place + np.repeat((a + from_ - starts[i:j]) // 8, count)
            values = mix(mix(values) + (place + 1).astype(np.uint64) * _STEP)
            out[i:j] += np.add.reduceat(values, np.cumsum(count) - count)
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


def differing(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Numbers of the spans whose bytes aren't those of span ``like`` of the same list."""
    odd = (ends - starts) != (ends - starts)[like]
    out = [np.flatnonzero(odd)]
    check = np.flatnonzero(~odd & (like != np.arange(len(like))))
    total = np.cumsum((ends - starts)[check])
    i = 0
    while i < len(check):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + SLICE, "right")))
        mine = check[i:j]
        a, _, count = _eights(data, starts[mine], ends[mine])
        b, _, _ = _eights(data, starts[like[mine]], ends[like[mine]])
        out.append(mine[np.unique(np.repeat(np.arange(len(mine)), count)[a != b])])
        i = j
    return np.concatenate(out)


def grams(h: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position of the first word) of each window of n consecutive words of one row."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(rows[:m] == rows[n - 1 :])
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out += h[k : k + m] * _SHIFTS[k]
    return mix(out[at]), at


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each span, one span after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``mask`` between consecutive offsets."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
