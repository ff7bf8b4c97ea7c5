"""Access logs from a start time on, without reading what lies before it.

Lines of a log file are in the order of their times. The planner looks for the start by bisection over byte offsets: a probe reads a few lines
after an offset, so it costs some kilobytes whatever the size of the file. Offsets from the start on are cut into partitions of about ``split``
bytes; a task reads its stretch only, and the line that begins in it as a whole. Lines without a time that can be read don't steer
the search and are left out of the rows, as ``readers.access_log`` does. Compressed files can't be entered in the middle; read those with
``readers.access_log``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from meridian.sources.pbf import _open
from meridian.sources.readers import parsed_log

TIME = re.compile(rb"\[(\d{2}/[A-Z][a-z]{2}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4})\]")
#: Bytes of a probe, and of a read.
PROBE, READ = 16 << 10, 1 << 20


def time_of(line: bytes) -> datetime | None:
    m = TIME.search(line)
    try:
        return datetime.strptime(m[1].decode(), "%d/%b/%Y:%H:%M:%S %z") if m else None
    except ValueError:
        return None


def first_time(f, at: int, end: int, probe: int = PROBE) -> datetime | None:
    """The time of the first line with one that begins after ``at``; at 0, of the first line."""
    f.seek(at)
    rest, skip = b"", at > 0
    while at < end:
        data = f.read(min(probe, end - at))
        if not data:
            break
        at += len(data)
        *lines, rest = (rest + data).split(b"\n")
        for line in lines[1:] if skip and lines else lines:
            if (found := time_of(line)) is not None:
                return found
        skip = skip and not lines
    return None if skip else time_of(rest)


def start_offset(f, size: int, start: datetime, probe: int = PROBE) -> int:
    """An offset before which no line has the time ``start`` or a later one, near the first line that has."""
    low, high = 0, size  # all lines that begin at low or before are earlier, or low is 0
    while high - low > probe:
        middle = (low + high) // 2
        found = first_time(f, middle, high, probe)
        if found is not None and found < start:
            low = middle
        else:
            high = middle
    return low


@dataclass
class Stretch(InputPartition):
    path: str
    begin: int
    end: int


def lines_of(f, begin: int, end: int, size: int, read: int = READ) -> Iterator[bytes]:
    """Lines that begin after ``begin`` (at 0, also the first) and not after ``end``; the last as a whole."""
    f.seek(begin)
    at, rest, skip = begin, b"", begin > 0
    while at < size:
        data = f.read(min(read, size - at))
        if not data:
            break
        pieces = (rest + data).split(b"\n")
        place = at - len(rest)
        at += len(data)
        for piece in pieces[:-1]:
            if skip:
                skip = False
            elif place > end:
                return
            else:
                yield piece
            place += len(piece) + 1
        rest = pieces[-1]
        if place > end and not skip:
            return
    if rest and not skip and at - len(rest) <= end:
        yield rest


class LogReader(DataSourceReader):
    def __init__(self, path: str, start: datetime, split: int):
        self.path, self.start, self.split = path, start, split

    def partitions(self) -> list[Stretch]:
        system, inner = _open(self.path)
        with system.open_input_file(inner) as f:
            size = f.size()
            begin = start_offset(f, size, self.start)
        cuts = [*range(begin, size, self.split), size]
        return [Stretch(self.path, a, b if b < size else size) for a, b in zip(cuts, cuts[1:])] or [Stretch(self.path, size, size)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        system, inner = _open(partition.path)
        with system.open_input_file(inner) as f:
            held = []
            for line in lines_of(f, partition.begin, partition.end, f.size()):
                held.append(line.decode(errors="replace"))
                if len(held) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(held)], ["value"])
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(held)], ["value"])


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sorted_log"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        start = datetime.fromisoformat(self.options["start"])
        return LogReader(self.options["path"], start if start.tzinfo else start.replace(tzinfo=timezone.utc), int(self.options["split"]))


def log_since(spark: SparkSession, path: str, start: str, text: str | None = None, split: int = 64 << 20) -> DataFrame:
    """Rows of ``readers.access_log`` from ``start`` (ISO, UTC unless it says otherwise) on, whose line holds ``text``; requests with a status of 400 to 499 are dropped."""
    spark.dataSource.register(LogSource)
    raw = spark.read.format("sorted_log").option("start", start).option("split", split).load(path)
    rows = parsed_log(raw if text is None else raw.filter(F.col("value").contains(text)))
    return rows.filter((F.col("time") >= F.lit(start).cast("timestamp")) & ~F.col("status").between(400, 499))
