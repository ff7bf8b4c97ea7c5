"""SentencePiece encoding and decoding with a distinct-chunk table.

No piece of the model holds a white-space marker after another character (``check_model`` verifies it),
so a text, with its marker put in front, can be cut before each run of markers that follows another
character, and the chunks can be segmented one by one: each different chunk of a slice once, by the
library. Ids and decoded texts are joined back by position.

Defined cases: null and empty texts encode to the end id alone and decode to the empty text; a text of
spaces is one chunk; the marker character itself counts as a space, as in the library; repeated rows
get equal results. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import arrays as A
from llm.chunks import table_of
from llm.tables import per_batch

MARKER = "▁"


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_model(model) -> None:
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    if any(MARKER in p.lstrip(MARKER) for p in pieces):
        raise ValueError("a piece of this model crosses a white-space marker")


def segmenter(path: str):
    """Chunk (a run of spaces and what follows) to (number of ids, ids as text, decoded bytes)."""
    model = load(path)
    lone = model.encode("a ")[len(model.encode("a")) :]

    def segment(chunks: list[bytes]) -> list[tuple[int, bytes, bytes]]:
        texts = [c[1:].decode() for c in chunks]
        ids = [x if t else lone for x, t in zip(model.encode(texts, num_threads=1), texts)]
        return [(len(x), "".join(f" {i}" for i in x).encode(), b" " + d.encode()) for x, d in zip(ids, model.decode(ids, num_threads=1))]

    return segment


def cut(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with a space before each text that isn't empty, offsets of texts, chunk starts)."""
    nothing, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    texts = pc.replace_substring(pc.fill_null(column.cast(pa.large_string()), ""), MARKER, " ")
    texts = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(nothing, texts, space))
    data, offsets = A.buffer(texts)
    space = data == 32
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return data, offsets, np.flatnonzero(start)


def encoded(documents: DataFrame, path: str | None = None, digests: bool = True) -> DataFrame:
    """Of every row doc_id, n_tokens and, for ``digests``, the SHA-256 of ids and of the decoded text; else ids and decoded."""
    path = path or model_path()
    checked = load(path)
    check_model(checked)
    end = b" %d" % checked.eos_id()

    def encode(batch: pa.RecordBatch):
        table = table_of("sentencepiece", path, segmenter)
        text, ids = batch.column("text"), batch.column("doc_id")
        _, sizes = A.buffer(text)
        for i, j in A.slices(sizes):
            data, offsets, starts = cut(text.slice(i, j - i))
            values, at = table.values(data, starts, np.append(starts[1:], len(data)))
            first = np.searchsorted(starts, offsets).tolist()
            at = at.tolist()
            counts, names, parts = [v[0] for v in values], [v[1] for v in values], [v[2] for v in values]
            n, said, decoded = [], [], []
            for a, b in zip(first, first[1:]):
                mine = at[a:b]
                n.append(sum(map(counts.__getitem__, mine)) + 1)
                said.append((b"".join(map(names.__getitem__, mine)) + end)[1:])
                decoded.append(b"".join(map(parts.__getitem__, mine))[1:])
            if digests:
                said, decoded = ([hashlib.sha256(x).hexdigest() for x in y] for y in (said, decoded))
            yield {"doc_id": ids.slice(i, j - i), "n_tokens": pa.array(n, pa.int64()), "ids": pa.array(said, pa.string()), "decoded": pa.array(decoded, pa.string())}

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    out = per_batch(rows, "doc_id long, n_tokens long, ids string, decoded string", encode, "sentencepiece")
    return out.withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"}) if digests else out
