"""OSM files in the binary block format, as a data source whose partitions are runs of blocks.

The planner reads only the short headers between blocks, for their offsets and sizes, and puts blocks together to partitions of about
``split`` bytes. A task opens its file at its first offset, and turns one block at a time into rows: packed integers are decoded by
numpy (varints, zigzag, deltas), strings go through the block's table.

Rows are those of ``readers.osm_xml``: node (id, lat, lon, tags), way (id, nodes, tags), relation (id, member, tags). A file that asks for
a feature other than the two below, or a block that is packed in an unknown way, is an error. An element without tags has an empty
map; of a tag that an element repeats the last value counts. Paths are local ones or URIs that Arrow's file systems take; a folder stands for its .pbf files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FEATURES = {"OsmSchema-V0.6", "DenseNodes", "HistoricalInformation", "LocationsOnWays"}
SCHEMAS = {
    "node": "id long, lat double, lon double, tags map<string,string>",
    "way": "id long, nodes array<long>, tags map<string,string>",
    "relation": "id long, member array<struct<_type:string,_ref:long,_role:string>>, tags map<string,string>",
}
KINDS = ("node", "way", "relation")
#: Bytes that a header or a block may have, by the format's definition.
MOST_HEADER, MOST_BLOCK = 64 << 10, 32 << 20


def varint(data: bytes | memoryview, at: int) -> tuple[int, int]:
    """(value, place after it)."""
    out = shift = 0
    while True:
        b = data[at]
        at += 1
        out |= (b & 127) << shift
        if b < 128:
            return out, at
        shift += 7


def fields(data: bytes | memoryview) -> Iterator[tuple[int, int | memoryview]]:
    """(number, value) of a message's fields; strings, bytes, messages and packed lists as memory views."""
    data, at = memoryview(data), 0
    while at < len(data):
        key, at = varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = varint(data, at)
        elif wire == 2:
            size, at = varint(data, at)
            if at + size > len(data):
                raise ValueError("a field is cut off")
            value, at = data[at : at + size], at + size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"unknown wire type {wire}")
        yield key >> 3, value


def packed(data: memoryview | None) -> np.ndarray:
    """Unsigned values of a packed list of varints."""
    raw = np.frombuffer(data if data is not None else b"", np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(raw < 128)
    if not len(ends) or ends[-1] != len(raw) - 1:
        raise ValueError("a packed list is cut off")
    starts = np.append(0, ends[:-1] + 1)
    size = ends - starts + 1
    out = np.zeros(len(ends), np.uint64)
    for k in range(int(size.max())):
        own = np.flatnonzero(size > k)
        out[own] |= (raw[starts[own] + k].astype(np.uint64) & np.uint64(127)) << np.uint64(7 * k)
    return out


def signed(values: np.ndarray) -> np.ndarray:
    """Zigzag: 0, 1, 2, 3 are 0, -1, 1, -2."""
    return (values >> np.uint64(1)).view(np.int64) ^ -(values & np.uint64(1)).view(np.int64)


def deltas(data: memoryview | None) -> np.ndarray:
    """Values whose zigzag differences are packed."""
    return np.cumsum(signed(packed(data)))


def unpacked_blob(raw: bytes) -> bytes:
    """The content of a blob."""
    found = dict(fields(raw))
    if 1 in found:
        return bytes(found[1])
    if 3 in found:
        return zlib.decompress(found[3])
    if 7 in found:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(bytes(found[7]), max_output_size=found.get(2, MOST_BLOCK))
    raise ValueError("a block is packed in a way that is not known here")


class _Rows:
    """Columns of one kind of element under construction."""

    def __init__(self, kind: str):
        self.kind, self.ids, self.places, self.lists, self.keys, self.values, self.tags = kind, [], [], [], [], [], [0]

    def add_tags(self, pairs: dict[str, str]) -> None:
        self.keys += pairs
        self.values += pairs.values()
        self.tags.append(len(self.keys))

    def batch(self) -> pa.RecordBatch:
        tags = pa.MapArray.from_arrays(pa.array(self.tags, pa.int32()), pa.array(self.keys, pa.string()), pa.array(self.values, pa.string()))
        ids = pa.array(self.ids, pa.int64())
        if self.kind == "node":
            lat, lon = zip(*self.places)
            return pa.RecordBatch.from_arrays([ids, pa.array(lat, pa.float64()), pa.array(lon, pa.float64()), tags], ["id", "lat", "lon", "tags"])
        item = pa.int64() if self.kind == "way" else pa.struct([("_type", pa.string()), ("_ref", pa.int64()), ("_role", pa.string())])
        return pa.RecordBatch.from_arrays([ids, pa.array(self.lists, pa.list_(item)), tags], ["id", "nodes" if self.kind == "way" else "member", "tags"])


def _tags(strings: list[str], keys: memoryview | None, values: memoryview | None) -> dict[str, str]:
    return {strings[k]: strings[v] for k, v in zip(packed(keys).tolist(), packed(values).tolist())}


def _dense(group: memoryview, rows: _Rows, strings: list[str], degrees) -> None:
    found = dict(fields(group))
    ids, lat, lon = deltas(found.get(1)), deltas(found.get(8)), deltas(found.get(9))
    rows.ids += ids.tolist()
    rows.places += zip(degrees(lat, 0).tolist(), degrees(lon, 1).tolist())
    pairs, own = packed(found.get(10)).tolist(), {}
    if not pairs:
        for _ in range(len(ids)):
            rows.add_tags({})
        return
    at = 0
    for _ in range(len(ids)):
        own = {}
        while pairs[at]:
            own[strings[pairs[at]]] = strings[pairs[at + 1]]
            at += 2
        at += 1
        rows.add_tags(own)


def elements(block: bytes, kind: str) -> pa.RecordBatch | None:
    """The elements of a kind in a block of data; None where it has none."""
    table, groups, granularity, offset = b"", [], 100, [0, 0]
    for number, value in fields(block):
        if number == 1:
            table = value
        elif number == 2:
            groups.append(value)
        elif number == 17:
            granularity = value
        elif number in (19, 20):
            offset[number - 19] = value - (1 << 64) if value >> 63 else value
    wanted = {"node": (1, 2), "way": (3,), "relation": (4,)}[kind]
    parts = [(n, x) for g in groups for n, x in fields(g) if n in wanted]
    if not parts:
        return None
    strings = [str(x, "utf-8") for n, x in fields(table) if n == 1]
    degrees = lambda v, k: (offset[k] + granularity * v) / 1e9
    rows = _Rows(kind)
    for number, raw in parts:
        if number == 2:
            _dense(raw, rows, strings, degrees)
            continue
        found = dict(fields(raw))
        zigzag = lambda v: (v >> 1) ^ -(v & 1)
        if kind == "node":
            rows.ids.append(zigzag(found[1]))
            rows.places.append(tuple(degrees(zigzag(found.get(n, 0)), k) for k, n in enumerate((8, 9))))
        else:
            rows.ids.append(found[1] - (1 << 64) if found[1] >> 63 else found[1])
            if kind == "way":
                rows.lists.append(deltas(found.get(8)).tolist())
            else:
                members = zip(packed(found.get(10)).tolist(), deltas(found.get(9)).tolist(), packed(found.get(8)).tolist())
                rows.lists.append([{"_type": KINDS[t], "_ref": ref, "_role": strings[role]} for t, ref, role in members])
        rows.add_tags(_tags(strings, found.get(2), found.get(3)))
    return rows.batch() if rows.ids else None


@dataclass
class Blocks(InputPartition):
    """(offset, size) of blocks of one file, in their order."""

    path: str
    blocks: list[tuple[int, int]]


def _open(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    return system, inner


def _files(path: str) -> list[str]:
    from pyarrow import fs

    system, inner = _open(path)
    if system.get_file_info(inner).type != fs.FileType.Directory:
        return [path]
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(path.removesuffix(inner) + f.path for f in found if f.path.endswith(".pbf"))


def blocks_of(path: str) -> list[tuple[int, int]]:
    """(offset, size) of the blobs with data of a file; its own header block is checked."""
    system, inner = _open(path)
    out = []
    with system.open_input_file(inner) as f:
        at, size = 0, f.size()
        while at < size:
            f.seek(at)
            (length,) = struct.unpack(">I", f.read(4))
            header = dict(fields(f.read(length))) if length <= MOST_HEADER else {}
            if 1 not in header or header.get(3, MOST_BLOCK + 1) > MOST_BLOCK:
                raise ValueError(f"{path} has no block header at {at}")
            at += 4 + length
            kind = bytes(header[1])
            if kind == b"OSMData":
                out.append((at, header[3]))
            elif kind == b"OSMHeader":
                needed = {str(x, "utf-8") for n, x in fields(unpacked_blob(f.read(header[3]))) if n == 4}
                if needed - FEATURES:
                    raise ValueError(f"{path} needs {sorted(needed - FEATURES)}")
            at += header[3]
    return out


class PbfReader(DataSourceReader):
    def __init__(self, path: str, kind: str, split: int):
        self.path, self.kind, self.split = path, kind, split

    def partitions(self) -> list[Blocks]:
        out = []
        for path in _files(self.path):
            own, size = [], 0
            for block in blocks_of(path):
                if own and size + block[1] > self.split:
                    out.append(Blocks(path, own))
                    own, size = [], 0
                own.append(block)
                size += block[1]
            if own:
                out.append(Blocks(path, own))
        return out or [Blocks(self.path, [])]

    def read(self, partition: Blocks) -> Iterator[pa.RecordBatch]:
        if not partition.blocks:
            return
        system, inner = _open(partition.path)
        with system.open_input_file(inner) as f:
            for offset, size in partition.blocks:
                f.seek(offset)
                batch = elements(unpacked_blob(f.read(size)), self.kind)
                if batch is not None:
                    yield batch


class PbfSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "osm_pbf"

    def schema(self) -> str:
        return SCHEMAS[self.options["kind"]]

    def reader(self, schema) -> DataSourceReader:
        return PbfReader(self.options["path"], self.options["kind"], int(self.options.get("split", 64 << 20)))


def osm_pbf(spark: SparkSession, path: str, kind: str, split: int = 64 << 20) -> DataFrame:
    """Rows of one element kind (node, way or relation) of binary OSM files; partitions hold about ``split`` bytes."""
    spark.dataSource.register(PbfSource)
    return spark.read.format("osm_pbf").option("kind", kind).option("split", split).load(path)
