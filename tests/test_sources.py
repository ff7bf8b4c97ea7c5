"""Binary map files, dumps, and samples over saved ranges."""

import hashlib
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridian.operators import reports
from meridian.sources import pbf, readers


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def zig(n: int) -> int:
    return n << 1 if n >= 0 else (-n << 1) - 1


def field(number: int, value) -> bytes:
    return varint(number << 3) + varint(value) if isinstance(value, int) else varint(number << 3 | 2) + varint(len(value)) + value


def list_of(values, delta: bool = False) -> bytes:
    if delta:
        values = [zig(v - w) for v, w in zip(values, [0, *values])]
    return b"".join(map(varint, values))


class Strings(list):
    def of(self, text: str) -> int:
        if text not in self:
            self.append(text)
        return self.index(text)


def tags_of(strings, tags) -> bytes:
    return field(2, list_of(strings.of(k) for k in tags)) + field(3, list_of(strings.of(v) for v in tags.values())) if tags else b""


def block(kind: str, part: list, dense: bool = True, granularity: int = 100, offset: tuple = (0, 0)) -> bytes:
    strings, group = Strings([""]), b""
    fine = lambda degrees, k: round((degrees * 1e9 - offset[k]) / granularity)
    if kind == "node" and dense:
        pairs = [x for _, _, _, t in part for x in (*(y for k, v in t.items() for y in (strings.of(k), strings.of(v))), 0)]
        content = field(1, list_of([n[0] for n in part], True)) + field(8, list_of([fine(n[1], 0) for n in part], True)) + field(9, list_of([fine(n[2], 1) for n in part], True))
        group = field(2, content + (field(10, list_of(pairs)) if any(pairs) else b""))
    else:
        for element in part:
            if kind == "node":
                i, lat, lon, t = element
                group += field(1, field(1, zig(i)) + tags_of(strings, t) + field(8, zig(fine(lat, 0))) + field(9, zig(fine(lon, 1))))
            elif kind == "way":
                i, nodes, t = element
                group += field(3, field(1, i) + tags_of(strings, t) + field(8, list_of(nodes, True)))
            else:
                i, members, t = element
                group += field(4, field(1, i) + tags_of(strings, t) + field(8, list_of(strings.of(m[2]) for m in members)) + field(9, list_of([m[1] for m in members], True)) + field(10, list_of(pbf.KINDS.index(m[0]) for m in members)))
    head = field(17, granularity) + field(19, offset[0]) + field(20, offset[1])
    return field(1, b"".join(field(1, s.encode()) for s in strings)) + field(2, group) + head


def blob(kind: bytes, content: bytes, packing: str = "zlib") -> bytes:
    body = field(1, content) if packing == "raw" else field(2, len(content)) + field(3, zlib.compress(content))
    header = field(1, kind) + field(3, len(body))
    return struct.pack(">I", len(header)) + header + body


def test_pbf_equals_xml(spark, tmp_path):
    rng = np.random.default_rng(2)
    words = ["name", "höhe", "ref", "highway", "", "日本", "a & b <c>"]
    tags = lambda: {words[k]: words[v] for k, v in rng.integers(0, len(words), (int(rng.integers(0, 4)), 2)).tolist() if words[k]}
    nodes = [(int(i), round(float(rng.uniform(-90, 90)), 7), round(float(rng.uniform(-180, 180)), 7), tags()) for i in rng.choice(2**40, 300, replace=False)] + [(-5, 0.0, -0.0000001, {}), (2**62, 90.0, 180.0, {"name": "end"})]
    ways = [(k * 7, [n[0] for n in nodes[k : k + k % 9]], tags()) for k in range(1, 60)]
    relations = [(k, [(pbf.KINDS[j % 3], nodes[j][0], words[j % 5]) for j in range(k % 6)], tags()) for k in range(1, 30)]
    parts = [blob(b"OSMHeader", field(4, b"OsmSchema-V0.6") + field(4, b"DenseNodes")), blob(b"Other", b"ignored")]
    parts += [blob(b"OSMData", block("node", nodes[k : k + 50], k % 100 == 0, 100 if k else 1, (0, 0) if k < 200 else (-(10**9), 7 * 10**8)), "raw" if k % 3 else "zlib") for k in range(0, len(nodes), 50)]
    parts += [blob(b"OSMData", block("way", ways[k : k + 20])) for k in range(0, 60, 20)] + [blob(b"OSMData", block("relation", relations))]
    path = str(tmp_path / "a.osm.pbf")
    (tmp_path / "a.osm.pbf").write_bytes(b"".join(parts))
    esc = lambda s: s.replace("&", "&amp;").replace("<", "&lt;")
    tag = lambda t: "".join(f'<tag k="{esc(k)}" v="{esc(v)}"/>' for k, v in t.items())
    xml = [f'<node id="{i}" lat="{lat:.7f}" lon="{lon:.7f}">{tag(t)}</node>' for i, lat, lon, t in nodes]
    xml += [f'<way id="{i}">{"".join(f"<nd ref={chr(34)}{n}{chr(34)}/>" for n in refs)}{tag(t)}</way>' for i, refs, t in ways]
    xml += [f'<relation id="{i}">' + "".join(f'<member type="{a}" ref="{b}" role="{c}"/>' for a, b, c in m) + f"{tag(t)}</relation>" for i, m, t in relations]
    (tmp_path / "a.osm").write_text("<osm>\n" + "\n".join(xml) + "\n</osm>")
    for kind, n in (("node", len(nodes)), ("way", len(ways)), ("relation", len(relations))):
        got = pbf.osm_pbf(spark, path, kind, split=3000)
        assert got.rdd.getNumPartitions() > 3
        plain = lambda rows: sorted((r.id, *(x or [] if isinstance(x, list) else x for x in (r[1:-1])), sorted((r.tags or {}).items())) for r in rows)
        rows = plain(got.collect())
        want = plain(readers.osm_xml(spark, str(tmp_path / "a.osm"), kind).collect())
        if kind == "way":  # an XML way without nodes has null nodes
            want = [(i, n or [], t) for i, n, t in want]
        if kind == "relation":
            want = [(i, m or [], t) for i, m, t in want]
        assert len(rows) == n and rows == want
    (tmp_path / "more").mkdir()
    for k in range(3):
        (tmp_path / "more" / f"{k}.pbf").write_bytes(b"".join(parts))
    assert pbf.osm_pbf(spark, str(tmp_path / "more"), "way").count() == 3 * len(ways)
    assert len(pbf.PbfReader(path, "way", 1).partitions()) == len(pbf.blocks_of(path)) == 7 + 3 + 1


def test_pbf_refuses_what_it_does_not_know(tmp_path):
    for name, raw in (("feature", blob(b"OSMHeader", field(4, b"Sparse"))), ("noise", b"\0\0\0\4abcd"), ("long", struct.pack(">I", 1 << 30))):
        (tmp_path / name).write_bytes(raw)
        with pytest.raises(ValueError):
            pbf.blocks_of(str(tmp_path / name))
    with pytest.raises(ValueError):
        pbf.unpacked_blob(field(4, b"lzma"))
    (tmp_path / "empty").write_bytes(b"")
    assert pbf.blocks_of(str(tmp_path / "empty")) == []


def test_packed_integers_round_trip():
    values = [0, -1, 1, 127, -128, 2**31, -(2**31), 2**62, -(2**62), 5]
    assert pbf.deltas(memoryview(list_of(values, True))).tolist() == values
    assert pbf.packed(memoryview(list_of([0, 127, 128, 2**64 - 1]))).tolist() == [0, 127, 128, 2**64 - 1] and len(pbf.packed(None)) == 0
    with pytest.raises(ValueError):
        pbf.packed(memoryview(b"\x80"))


def test_sql_dump(spark, tmp_path):
    text = r"""-- a dump; INSERT INTO `no` VALUES (0)
CREATE TABLE `t` (`values` int, `b` varchar(9) DEFAULT 'INSERT INTO x VALUES (9)');
INSERT INTO `langlinks` VALUES (11111,'aa','bbbb')
INSERT INTO `langlinks` VALUES (11111,'aa','bbbb'),(11112,'a\'a','bb\\\'b\'b')(11113,'a\\','b)b','c(c\')')
INSERT INTO `langlinks` VALUES (11111,'aa','bbb (bbb bb)'),(11112,'aa','bbbb (bbbb(bbbb))'),(11113,'a\'a\'a','b','((c,c)),');
INSERT INTO t_VALUES (`a`,`values`) VALUES (1,'a;
b'),(2,'c'), (NULL, 'it''s', '', -2.5) ON DUPLICATE KEY UPDATE a=VALUES(a);
insert into `x` values (7,"q""r",'INSERT INTO y VALUES (8)'); /* INSERT INTO z VALUES (1) */
"""
    for k in range(2):
        (tmp_path / f"{k}.sql").write_text(text)
    want = [
        ["11111", "aa", "bbbb"], ["11111", "aa", "bbbb"], ["11112", "a'a", "bb\\'b'b"], ["11113", "a\\", "b)b", "c(c')"], ["11111", "aa", "bbb (bbb bb)"],
        ["11112", "aa", "bbbb (bbbb(bbbb))"], ["11113", "a'a'a", "b", "((c,c)),"], ["1", "a;\nb"], ["2", "c"], [None, "it's", "", "-2.5"], ["7", 'q"r', "INSERT INTO y VALUES (8)"],
    ]
    assert sorted((r.fields for r in readers.sql_dump(spark, str(tmp_path)).collect()), key=str) == sorted(want * 2, key=str)
    assert list(readers.dump_tuples("")) == [] and list(readers.dump_tuples("t VALUES (),(1)")) == [[], ["1"]]
    with pytest.raises(ValueError):
        list(readers.dump_tuples("t VALUES (1,'a"))


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_stride_sample_of_wide_rows(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        n = 100_000
        wide = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("load"), F.lit("x").alias("_stride"))
        got = reports.stride_sample(wide, "k", 7).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(r.k for r in got) == [k for k in range(n) if k == 0 or k * 7000 // n != (k - 1) * 7000 // n] and len(got) == 7000
    assert all(r.load == hashlib.sha256(str(r.k * pow(7919, -1, n) % n).encode()).hexdigest() for r in got[:50])


def test_drawn(spark):
    rows = [(k, f"day {k % 7}", "p") for k in range(60)] + [(None, "day 1", "p")]
    field = spark.createDataFrame(rows, "id long, day string, _draw string")
    none = spark.createDataFrame([], "id long")

    def draw(won):
        left = sorted((d, i) for i, d, _ in rows if i is not None and i not in won)
        h = sum(int(hashlib.md5(f"{i}:{d}".encode()).hexdigest()[:8], 16) for d, i in left)
        return [left[h % len(left)][1]] if left else []

    assert [r.id for r in reports.drawn(field, "id", "day", none).collect()] == draw(set())
    won = {draw(set())[0], 3, 4}
    winners = spark.createDataFrame([(w,) for w in won] + [(None,)], "id long")
    assert [r.id for r in reports.drawn(field, "id", "day", winners).collect()] == draw(won)
    assert reports.drawn(field, "id", "day", field).count() == 0 and reports.drawn(field.limit(0), "id", "day", none).count() == 0
