"""Distinct-chunk tables: segment each different chunk of text once, then join the results by position.

A task keeps a table from chunk, by its bytes, to what a tokenizer made of it. Within a slice equal chunks are
found by hash and compared byte by byte, so that chunks of equal hashes stay apart. The table is bounded and
starts anew when full, so memory does not follow the vocabulary; a chunk that is met again later is
segmented again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from llm import arrays as A

#: Chunks that a task remembers.
KEPT = 400_000


class ChunkTable:
    """``segment`` makes a list of values from a list of chunks."""

    def __init__(self, segment: Callable[[list[bytes]], list]):
        self.segment, self.known = segment, {}

    def values(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list, np.ndarray]:
        """(value of each different chunk, index of the value of each chunk)."""
        _, first, inverse = np.unique(A.hashes(data, starts, ends), return_index=True, return_inverse=True)
        odd = A.differing(data, starts, ends, first[inverse])
        if len(odd):  # other bytes of the same hash are entries of their own
            inverse[odd] = len(first) + np.arange(len(odd))
            first = np.append(first, odd)
        raw = data.tobytes()
        names = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        missing = {name: None for name in names if name not in self.known}
        if len(self.known) + len(missing) > KEPT:
            self.known, missing = {}, dict.fromkeys(names)
        self.known.update(zip(missing, self.segment(list(missing)) if missing else ()))
        return [self.known[name] for name in names], inverse


_tables: dict[tuple, ChunkTable] = {}


def table_of(kind: str, path: str, make: Callable[[str], Callable[[list[bytes]], list]]) -> ChunkTable:
    """The table of this Python worker, which outlives a task."""
    if (kind, path) not in _tables:
        _tables[kind, path] = ChunkTable(make(path))
    return _tables[kind, path]


def forget(keep: str = "") -> None:
    """Drops this Python worker's tables of other kinds than ``keep``: the next stage of a pipeline needs their memory."""
    for key in [k for k in _tables if k[0] != keep]:
        del _tables[key]
