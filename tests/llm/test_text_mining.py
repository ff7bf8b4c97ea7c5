"""Collocations, filter audit and decontamination against plain programs, with nulls, ties, repeats, hot keys and clashing columns."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from llm import audit, collocations, decontaminate


def prose(n: int, seed: int, vocabulary: int = 60) -> str:
    rng = np.random.default_rng(seed)
    marks = rng.choice(["", "", "", "", ".", ", ", "\n", "!"], n)
    return " ".join(f"W{w}{m}" if w % 7 else f"w{w}é{m}" for w, m in zip(rng.integers(0, vocabulary, n), marks))


def low(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


CLASH = ", n long, phrase string, words string, mask int, h long, who long, start int, part string, a long, rank int, seed long, fingerprint long, place long"


def wide(spark, rows, schema):
    extra = (1, "p", "w", 2, 3, 4, 5, "q", 6, 7, 8, 9, 10)
    return spark.createDataFrame([(*r, *extra) for r in rows], schema + CLASH).repartition(3)


def mined(rows, least, holds, limit):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if q in found and 100 * a >= holds * found[q]}
        scored = []
        for p, a in found.items():
            if p not in gone:
                score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:limit], 1)]
    return sorted(out)


@pytest.mark.parametrize("bits", [None, 27])
def test_collocations(spark, bits, monkeypatch):
    rows = [(i, prose(80, i), ("en", "fr", None)[i % 3]) for i in range(90)] + [(100 + i, "zwei Wörter immer zusammen. x\ta  a a", "en") for i in range(40)]
    rows += [(200, None, "en"), (201, "", None), (202, " \t.;", "fr"), (203, "only once here", "xx"), (100, "zwei Wörter immer zusammen. x\ta  a a", "en"), (None, prose(500, 7), "und"), (204, "solo. " * 3000 + "y" * 50_000, "fr")]
    monkeypatch.setattr(collocations, "PATTERNS", 40)  # several automata
    monkeypatch.setattr(collocations, "TEXT", 4000)
    monkeypatch.setattr(collocations, "STRETCH", 900)
    docs = wide(spark, rows, "doc_id long, text string, lang string")
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    for least, limit, first in ((10, 2000, 8000), (3, 25, 10)):  # the second ends by bounds, over several rounds
        got = collocations.collocations(docs, least=least, limit=limit, first=first, bits=bits).select(*names).collect()
        assert sorted(map(tuple, got)) == mined(rows, least, 50, limit)
    none = spark.createDataFrame([], docs.schema)
    assert collocations.collocations(none).count() == 0


def test_collocations_with_a_sketch_that_is_full(spark):
    """Four counters, or a filter of 64 bits, stand for all phrases, so that most are carried on; the result is the same."""
    rows = [(i, prose(60, i, 12), "en") for i in range(30)]
    for full in ({"bits": 2}, {"most_bits": 64}):
        got = collocations.collocations(spark.createDataFrame(rows, "doc_id long, text string, lang string"), limit=15, first=5, **full).collect()
        assert sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == mined(rows, 10, 50, 15)


def test_scores_beyond_64_bits(spark):
    big = 90_000_000_000
    df = spark.createDataFrame([(big, big + 1, big + 3)], "a long, l long, r long")
    assert df.select(collocations._score("a", "l", "r")).first()[0] == 1_000_000 * big * big // ((big + 1) * (big + 3))


def audited(rows, labels):
    good, toxic = ({d for d, *x in labels if x[k] == 1 and d is not None} for k in (0, 1))
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    masks = []
    for d, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search("[#$%&*|]", t)), d is not None and d > least[t])
        masks.append((lang or "", {x for x, f in zip("ABCDE", fails) if f}, d in good, d in toxic))
    out, shapley = {}, Counter()
    for order in permutations("ABCDE"):
        for step, f in enumerate(order, 1):
            for part in {m[0] for m in masks}:
                mine = [m for m in masks if m[0] == part]
                gone = [m for m in mine if f in m[1] and not m[1] & set(order[: step - 1])]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = (
                    sum(not m[1] & set(order[:step]) for m in mine), len(gone), sum(f in m[1] for m in mine) - len(gone), sum(m[1] == {f} for m in mine), sum(m[2] for m in gone), sum(m[3] for m in gone),
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark):
    long = " ".join(f"word{i}" for i in range(250))
    rows = [(i, long, "en") for i in range(50, 150)] + [(i, long + f" {i % 5}", "fr") for i in range(150, 200)] + [(7, long, None), (7, long, "de"), (7, long + " #", "de")]
    rows += [(1, None, "en"), (2, "", "en"), (3, "A B C", "fr"), (None, long, "en"), (None, "A B C", None), (4, "x " * 300, "en"), (5, "x " * 300, "fr"), (6, "é" * 20_000 + " $", "")]
    labels = [(50, 1, 0), (51, 1, 1), (52, None, 1), (7, 1, 0), (7, 0, 1), (3, 0, 0), (None, 1, 1), (999, 1, 1)]
    docs, said = wide(spark, rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    got = audit.audit(docs, said).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in got} == audited(rows, labels) and len(got) == 4 * 600
    assert audit.audit(spark.createDataFrame([], docs.schema), said).count() == 0
    assert audit.audit(docs, spark.createDataFrame([], said.schema)).filter("good_lost + toxic_lost > 0").count() == 0


def test_groups_over_partition_ends_and_equal_fingerprints(spark, monkeypatch):
    """Texts that share one fingerprint lie mixed over many partitions, and still only equal texts count as copies."""
    constant = audit.F.lit(5).cast("long")
    monkeypatch.setattr(audit.F, "xxhash64", lambda *_: constant)
    rows = [(i, f"text {i % 3}", "en") for i in range(400)] + [(i, f"text {i % 3}", "en") for i in range(0, 400, 5)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        masks, letters = audit.failure_masks(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5))
        got = masks.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert letters == "ABCDE" and sorted((r.doc_id, r.mask & 16) for r in got) == sorted((i, 16 * (i > i % 3)) for i, _, _ in rows)


def contaminated(docs, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))

    held = defaultdict(set)
    for i, t in items:
        w = words(t)
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if w else 0):
            held[tuple(w[k : k + m])].add(i)
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for m in {len(x) for x in held}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in held:
                    hit.update(range(k, k + m))
                    ids |= {str(i) for i in held[tuple(w[k : k + m])] if i is not None}
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_decontamination(spark, broadcast_rows):
    items = [(i, prose(5 + 3 * i, 50 + i, 500)) for i in range(20)] + [(30, "Ha " * 40), (31, "ha-ha ha ha"), (32, None), (33, "..."), (34, "Ünïque Wörd"), (10, prose(30, 99, 500)), (None, prose(14, 98, 500)), (35, items_text := prose(40, 97, 500)), (36, items_text)]
    by_id = {i: t for i, t in items if t}
    rng = np.random.default_rng(3)
    docs = [(k, prose(30, 200 + k, 500) + " " + str(by_id[k % 20]) + " " + prose(9, 300 + k, 500)) for k in range(40)]
    docs += [(60 + k, " ".join(str(by_id[35]).split()[k : k + 9 + k % 3])) for k in range(20)] + [(90, "HA, " * 200), (91, "ha " * 9), (92, None), (93, ""), (94, "the Ünïque wörd"), (95, "the Ünïque Wörd"), (96, by_id[19]), (96, by_id[19]), (96, prose(20, 5)), (None, by_id[18]), (97, by_id[17].replace(" ", "\n# ")), (98, str(by_id[15]) + " " + prose(30_000, 8, 500))]
    docs = [docs[k] for k in rng.permutation(len(docs))]
    frame, bench = wide(spark, docs, "doc_id long, text string"), wide(spark, items, "item_id long, text string")
    got = decontaminate.contamination(frame, bench, broadcast_rows=broadcast_rows)
    want = contaminated(docs, items)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, len(r.item_ids), hashlib.sha256(",".join(r.item_ids).encode()).hexdigest(), r.n_hit > 0) for r in got.collect()), key=str) == want
    if broadcast_rows:
        names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
        assert sorted((tuple(r[n] for n in names) for r in decontaminate.report(frame, bench).collect()), key=str) == want
        left = decontaminate.decontaminated(frame, bench)
        assert left.columns == frame.columns and sorted((r.doc_id for r in left.collect()), key=str) == [d for d, *_, bad in want if not bad]
        none, nothing = spark.createDataFrame([], frame.schema), spark.createDataFrame([], bench.schema)
        assert decontaminate.report(none, bench).count() == 0 and decontaminate.report(frame, nothing).filter("contaminated or n_items > 0").count() == 0


def test_decontamination_runs_no_python(spark):
    found, _ = decontaminate.occurrences(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([(1, "b c")], "item_id long, text string"))
    plan = found._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "MapPartitions"))
