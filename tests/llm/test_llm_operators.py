"""Operators against brute force on small fixtures, with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import arrays, html, jaccard, langid, licences, packing, pieces, pii, quality, topk, toxicity
from llm.tables import saved

BASE = "the of and to in is that it was for on are with as his they be at one have this from or had by hot word but what some we can out other were all there when up use your how said an each she which do their time if will way about many then them write would like so these her long make thing see him two has look more day could go come did number sound no most people my over know water than call first who may down side been now find".split()


def prose(n: int, seed: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(BASE, n))


LONG = prose(30_000, 1)
#: A word and its mirror, which have the same hash by any polynomial modulo a power of two.
THUE = "".join("ab"[i.bit_count() % 2] for i in range(1024))
SWAP = str.maketrans("ab", "ba")
ROWS = [
    (1, "mail a.b@x.org, ip 10.0.0.255 and 300.1.1.1; card 4111 1111 1111 1111 phone +1 (415) 555-0132."),
    (2, None), (3, ""), (4, " \n\t "), (5, "one two three"), (6, "ONE two Three"), (7, prose(60, 2)), (8, prose(60, 2)), (8, prose(60, 2)),
    (9, prose(60, 2).replace("the", "THE") + " end"), (10, LONG), (11, LONG + " tail"), (12, "x" * 300_000), (13, "é ß 日本 語\x85<|endoftext|> ▁x  y "),
    (20, THUE), (21, THUE.translate(SWAP)), (22, THUE + "\n" + THUE.translate(SWAP)),
    (14, "a b c d e f g h " * 5), (15, "line one here\nline one here\n\n  \nline two\n"), (None, "no id"), (16, "DE89 3704 0044 0532 0130 00 ssn 123-45-6789"), (17, prose(50, 3)), (18, prose(50, 3) + " z"),
]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    wide = [(i, t, "en", "s", len(t or ""), 1.0, "k") for i, t in ROWS]
    return spark.createDataFrame(wide, SCHEMA + ", lang string, source string, n_chars long, score double, row_key string").repartition(3)


@pytest.fixture(scope="module")
def none(spark, docs):
    return spark.createDataFrame([], docs.schema)


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, r)
    return out


def test_pii(spark, docs, none):
    def base(t):
        found = []
        for k, (kind, p) in enumerate({"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}.items()):
            for m in re.finditer(p, t) if {"email": "@", "ip": ".", "card": " ", "phone": "+"}[kind] in t else ():
                d = re.sub("[^0-9]", "", m[0])
                luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
                if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]:
                    found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
        return ",".join(x[2] for x in sorted(found))

    got = pii.report(docs).collect()
    assert len(got) == len(ROWS)
    for i, t in ROWS:
        assert by_id(got)[i].base_sha256 == hashlib.sha256(base(t or "").encode()).hexdigest()
    assert by_id(got)[16].spans == "iban:0:27,ssn:32:43"
    near = [(1, "ssn 123-45-6789, 234-56-7890 and 345-67-8901"), (2, "123-45-6789 is my ssn"), (3, "123-45-6789 " + "x" * 60 + " ssn"), (4, "order DE89 3704 0044 0532 0130 00"), (5, "call a@b.co+1 415 555 0132 " * 300)]
    near = spark.createDataFrame(near, SCHEMA)
    scored = by_id(pii.report(near).collect())
    assert scored[1].scores == "ssn:4:15:0.6,ssn:17:28:0.6,ssn:33:44:0.6" and scored[2].spans == "ssn:0:11" and scored[3].spans == scored[4].spans == ""
    assert scored[5].n_email == scored[5].n_phone == 300 and scored[5].spans.startswith("email:5:11,phone:11:26")
    hidden = by_id(pii.masked(near).collect())
    assert hidden[1].text == "ssn [SSN], [SSN] and [SSN]" and hidden[5].text == "call [EMAIL][PHONE] " * 300 and hidden[3].text == by_id(near.collect())[3].text
    assert pii.report(none).count() == 0
    masked = by_id(pii.masked(docs).collect())
    assert masked[1].text == "mail [EMAIL], ip [IP] and 300.1.1.1; card [CARD] phone [PHONE]." and masked[1].n_chars == len(masked[1].text)
    assert masked[2].text is None and masked[10].text == LONG


def test_pii_kinds_share_one_expression(spark):
    """The driver holds and rewrites the plan: with an expression for each kind it had 128 lambda functions."""
    mixed = [(1, "ssn 123-45-6789, mail a.b@x.org card 4111 1111 1111 1111 call +1 (415) 555-0132 order 10.0.0.255 bank DE89 3704 0044 0532 0130 00"), (2, "@1 +1"), (3, None)]
    mixed = spark.createDataFrame(mixed, SCHEMA)
    assert pii.masked(mixed)._jdf.queryExecution().analyzed().toString().count("lambdafunction(") < 100
    got = by_id(pii.report(mixed).collect())
    assert got[1].scores == "ssn:4:15:0.6,email:22:31:1.0,card:37:56:0.8,phone:62:79:0.7,ip:86:96:0.3,iban:102:129:0.7"
    assert got[2].spans == got[3].spans == ""
    assert by_id(pii.masked(mixed).collect())[1].text == "ssn [SSN], mail [EMAIL] card [CARD] call [PHONE] order [IP] bank [IBAN]"


def test_jaccard(docs, none):
    sets = {}
    for i, t in ROWS:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in sets:
        for b in sets:
            if a is not None and b is not None and a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    got = jaccard.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert r.n_shingles == len(sets[r.doc_id]) and r.component_id == root(r.doc_id)
    assert jaccard.near_duplicates(none).count() == 0
    kept = sorted((r.doc_id for r in jaccard.without_duplicates(docs).collect()), key=str)
    assert kept == sorted((i for i, t in dict(ROWS).items() if root(i) == i), key=str)


def test_jaccard_many_texts_of_one_id(spark):
    """All rows carry one id, as a hot key would; texts come in pairs of near copies."""
    words = [prose(60, k // 2).split() for k in range(400)]
    texts = [(7, " ".join(w[:-1] + [f"end{k % 2}"])) for k, w in enumerate(words)]
    got = jaccard.near_duplicates(spark.createDataFrame(texts, SCHEMA)).collect()
    assert len(got) == 400 and {(r.doc_id, r.component_id) for r in got} == {(7, 7)}
    names = [(k, t) for k, (_, t) in enumerate(texts)] + [(None, t) for _, t in texts[:40]]
    got = jaccard.near_duplicates(spark.createDataFrame(names, SCHEMA)).collect()
    assert all(r.component_id == r.doc_id // 2 * 2 for r in got if r.doc_id is not None)
    assert sorted(r.component_id for r in got if r.doc_id is None) == [k // 2 * 2 for k in range(40)]


def test_hashes_of_words_and_long_spans():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 3 << 20).astype(np.uint8)
    cuts = np.array([0, 1, 9, 17, 2_500_000, 2_500_003, 3 << 20])
    got = arrays.hashes(data, cuts[:-1], cuts[1:])
    again = np.concatenate([data[a:b] for a, b in zip(cuts[:-1], cuts[1:])][::-1])
    size = np.diff(cuts)[::-1]
    ends = np.cumsum(size)
    assert (arrays.hashes(again, ends - size, ends)[::-1] == got).all()
    pairs = np.frombuffer((THUE + THUE.translate(SWAP) + THUE).encode(), np.uint8)
    starts = np.array([0, 1024, 2048])
    h = arrays.hashes(pairs, starts, starts + 1024)
    assert h[0] == h[2] != h[1] and arrays.differing(pairs, starts, starts + 1024, np.array([0, 0, 0])).tolist() == [1]


def test_jaccard_chain_of_near_copies(spark):
    rng = np.random.default_rng(4)
    base = prose(150, 9).split()
    texts = []
    for k in range(40):
        w = list(base)
        for j in rng.choice(150, k % 6, replace=False):
            w[j] = f"new{k}x{j}"
        texts.append((k, " ".join(w)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(146)} for i, t in texts}
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(texts, SCHEMA)).collect()}
    assert got == label


def test_jaccard_tasks_and_jobs(spark):
    """The driver keeps something for each task: passes over texts have the input's partitions, little else does."""
    context, partitions = spark.sparkContext, 64
    texts = [(k, " ".join(prose(60, k // 2).split()[:-1] + [f"end{k % 2}"])) for k in range(512)]
    docs = saved(spark.createDataFrame(texts, SCHEMA).repartition(partitions, "doc_id"))
    context.setJobGroup("jaccard tasks", "test")
    try:
        got = jaccard.near_duplicates(docs).collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert all(r.component_id == r.doc_id // 2 * 2 for r in got) and len(got) == 512
    seen = context.statusTracker()
    jobs = seen.getJobIdsForGroup("jaccard tasks")
    stages = {k for j in jobs for k in seen.getJobInfo(j).stageIds}
    tasks = sum(x.numCompletedTasks for x in map(seen.getStageInfo, stages) if x)
    assert tasks < 6 * partitions and len(jobs) < 70


def test_pieces(docs, none):
    model = pieces.load(pieces.model_path())
    got = pieces.encoded(docs).collect()
    assert len(got) == len(ROWS)
    for i, t in ROWS:
        ids, r = model.encode(t or "", add_eos=True), by_id(got)[i]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    assert pieces.encoded(none).count() == 0


def test_packing(docs, none):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.pack(packing.pieces(docs), block=8).collect()
    want = sum(len(model.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ROWS)
    assert sum(r.length for r in got) == want
    for i, t in ROWS:
        if i != 8:
            ids = np.array(model.encode(t or "", add_special_tokens=False).ids + [0], np.uint32)
            mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
            assert [r.start for r in mine] == list(np.cumsum([0] + [r.length for r in mine])[:-1]) and mine[-1].start + mine[-1].length == len(ids)
            assert all(r.length == 2048 for r in mine[1:])
            assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in mine)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert all(o == sum(n for _, n in b[:k]) for k, (o, _) in enumerate(b)) and sum(n for _, n in b) <= 2048
    assert packing.pack(packing.pieces(none)).count() == 0


def test_local_search_ends_when_no_step_helps():
    rng = np.random.default_rng(1)
    for n, low, high in ((300, 700, 1100), (200, 400, 1500), (300, 1, 2047)):
        lengths = rng.integers(low, high, n)
        bins = packing.local_search(packing.best_fit(lengths, 2048), lengths, 2048)
        assert sorted(i for b in bins for i in b) == list(range(n)) and all(lengths[b].sum() <= 2048 for b in bins)
        state = packing._Bins(bins, lengths, 2048)
        assert len(bins) == -(-lengths.sum() // 2048) or not any(state.step(v) for v in state.open.tolist())


def test_packing_checks_its_tokenizer(docs):
    with pytest.raises(ValueError):
        packing.pieces(docs, packing.tokenizer_path().replace("byte_bpe_50k", "word_bpe_49k"))


def test_local_search_empties_bins():
    lengths = np.array([6, 6, 4, 4, 5, 5])
    bins = packing.local_search([[0, 2], [1], [3, 4], [5]], lengths, 10)
    assert len(bins) == 3 and sorted(i for b in bins for i in b) == list(range(6)) and all(lengths[b].sum() <= 10 for b in bins)


def test_topk(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 20)]) for i in range(230)] + [(300, None), (350, [1.0, None]), (400, [float("nan")] * 20), (401, [0.0] * 20), (402, [0.0] * 20), (7, [2.0] * 20), (7, [2.0] * 20), (None, [1.0] * 20)]
    got = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    fine = [(i, np.floor(256 * np.array(v))) for i, v in rows if i is not None and v is not None and None not in v and all(np.isfinite(v))]
    for no, (q, v) in enumerate(fine):
        if q % 50 == 0:
            best = sorted((-int(v @ w), c) for k, (c, w) in enumerate(fine) if k != no)[:5]
            assert [(-r.score, r.vec_id) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == best
    assert {r.query_id for r in got} == {i for i, _ in fine if i % 50 == 0}
    twice = topk.search(spark.createDataFrame([(50, [1.0]), (50, [2.0]), (3, [0.5])], "vec_id long, embedding array<double>")).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in twice) == [(1, 50, 131072), (1, 50, 131072), (2, 3, 32768), (2, 3, 65536)]
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert topk.search(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")).count() == 0


def test_quality(spark, docs, none):
    got = quality.judge(docs).collect()
    assert len(got) == len(ROWS)
    for i, t in ROWS:
        t, r = t or "", by_id(got)[i]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        at = {}
        for k in range(len(w) - 7):
            at.setdefault(tuple(w[k : k + 8]), []).append(k)
        repeated = {p for v in at.values() if len(v) > 1 for k in v for p in range(k, k + 8)}
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 20 or 100 * len(repeated) > 30 * len(w))
    assert quality.judge(none).count() == 0
    common = "subscribe to our news letter and read the terms of this site today for free with no ads at all times please now"
    rows = [(i, common + "\n" + (prose(40, 100 + i) if i % 2 else "x"), "h") for i in range(80)] + [(100 + i, common + "\n" + prose(9, i), "small") for i in range(3)]
    rows += [(200 + i, prose(30, 500 + i // 5), "copies") for i in range(60)] + [(300 + i, prose(30, 900 + i), None) for i in range(4)] + [(300, prose(30, 900), None)]
    held, size, lines_of = {}, {}, {}
    for i, t, h in rows:
        size[h] = size.get(h, 0) + 1
        for line in set(" ".join(re.sub("[0-9]", "0", x).lower().split()) for x in t.split("\n")):
            held[h, line] = held.get((h, line), 0) + 1
    judged = quality.judge(spark.createDataFrame(rows, SCHEMA + ", source string")).collect()
    assert len(judged) == len(rows)
    for (i, t, h), r in zip(sorted(rows, key=lambda x: x[0]), sorted(judged, key=lambda x: x.doc_id)):
        left = sum(len(x.split()) for x in t.split("\n") if held[h, " ".join(re.sub("[0-9]", "0", x).lower().split())] <= max(3, 0.05 * size[h]))
        assert r.removed_words == len(t.split()) - left and r.kept == (not r.base_failed and left >= 20 and 2 * left >= len(t.split()))
    kept = {r.doc_id: r.kept for r in judged}
    assert all(kept[i] == bool(i % 2) for i in range(80)) and all(kept[100 + i] for i in range(3)) and not kept[200] and kept[301]


def test_toxicity(spark, docs, none):
    rows = [(i, prose(40, i) + (" you moron and moron" if i % 4 == 0 else "")) for i in range(400)]
    d = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows] + [(0, None)], "doc_id long, toxic int")
    model = toxicity.fit(d, labels)
    held = [r for r in toxicity.score(d, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 100 and sum((r.score >= 0.7) == (r.doc_id % 4 == 0) for r in held) >= 0.95 * len(held)
    assert len(toxicity.score(docs, model).collect()) == len(ROWS) and toxicity.score(none, model).count() == 0
    assert toxicity.without_toxic(d, model).count() < 400 and toxicity.without_toxic(docs, model).columns == docs.columns
    pair = []
    for i in range(3000):  # "zorbling" and "quixmar": one in five texts with either is toxic, as of all texts; all with both are
        k, t = i % 20, prose(25, i).split()
        t += ["zorbling"] * (k < 5) + ["quixmar"] * (k in (0, 5, 6, 7, 8)) + ["moron"] * (k == 9) + ["vermin"] * (k in (10, 11))
        pair.append((i, " ".join(t), int(k in (0, 9, 10, 11))))
    both = spark.createDataFrame(pair, SCHEMA + ", toxic int")
    model = toxicity.fit(both, both.select("doc_id", "toxic"))
    held = [r for r in toxicity.score(both, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum((r.score >= 0.7) == (r.doc_id % 20 in (0, 9, 10, 11)) for r in held) >= 0.98 * len(held)
    assert sum(r.score >= 0.7 for r in held if r.doc_id % 20 == 0) >= 0.9 * sum(r.doc_id % 20 == 0 for r in held)
    nothing = toxicity.fit(docs, spark.createDataFrame([], labels.schema))
    assert all(0 <= r.score < 0.7 for r in toxicity.score(docs, nothing).collect())


def test_toxicity_counts_all_pairs_of_long_texts(monkeypatch):
    sets = [np.unique(np.random.default_rng(k).integers(0, 500, n) * 2).astype(np.int32) for k, n in enumerate((0, 1, 2, 90, 2000))]
    weak = np.arange(0, 1000, 4)
    want = {}
    for t in sets:
        t = [int(x) for x in t if x % 4 == 0]
        for k, a in enumerate(t):
            for b in t[k + 1 :]:
                want[a << 18 | b] = want.get(a << 18 | b, 0) + 1
    monkeypatch.setattr(toxicity, "PAIRS", 300)
    batch = pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in sets], pa.binary())], ["terms"])
    for known in (None, np.array(sorted(want)[::7])):
        got = {}
        for out in toxicity._pair_counter(weak, known)(batch):
            for p, n in zip(out["pair"].tolist(), out["n"].tolist()):
                got[p] = got.get(p, 0) + n
        assert got == {p: n for p, n in want.items() if known is None or p in set(known.tolist())}


def plain_score(model, text):
    """The machine's score by its definition: the constant, weights of the terms, and products of the factors of each two of them."""
    held = {}
    for word in re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
        for n in (0, *toxicity.PREFIXES):
            if n == 0 or len(word.encode()) > n:
                raw = np.frombuffer(word.encode()[: n or None], np.uint8)
                h = arrays.mix(arrays.hashes(raw, np.array([0]), np.array([len(raw)])) ^ np.uint64(n)) & np.uint64(toxicity.BUCKETS - 1)
                bucket = int(h[0]) | 1 if n else int(h[0]) & ~1
                held[bucket] = held.get(bucket, 0) + 1
    for bucket, count in list(held.items()):
        for times in (2, 4):
            if count >= times:
                held[int(toxicity._again(np.array([bucket], np.uint64), times)[0])] = 1
    place = {int(b): k for k, b in enumerate(model.buckets)}
    known = [place[b] for b in held if b in place]
    z = model.w0 + sum(model.w[k] for k in known) + sum(float(model.v[a] @ model.v[b]) for i, a in enumerate(known) for b in known[:i])
    return 1 / (1 + np.exp(-max(-30, min(30, z))))


def test_toxicity_score_is_that_of_a_plain_machine(spark):
    """A score by sums over all pairs of a text's terms, as the machine is defined."""
    rows = [(i, prose(20, i) + (" you moron" if i % 3 == 0 else "")) for i in range(200)]
    d = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.fit(d, spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    some = rows[:12] + [(900, ""), (901, "moron")]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(some, SCHEMA), model).collect()}
    for i, text in some:
        assert abs(got[i] - plain_score(model, text)) < 1e-4


def test_language(spark, docs, none):
    french = "le la de et les des un une est que pour dans qui sur pas au avec il elle nous vous être avoir faire plus tout comme mais ou où".split()
    rng = np.random.default_rng(0)
    rows = [(i, prose(30, i), "en") if i % 2 else (i, " ".join(rng.choice(french, 30)), "fr") for i in range(300)]
    d = spark.createDataFrame(rows, SCHEMA + ", lang string")
    model = langid.fit(d)
    assert all(r.lang_pred == ("en" if r.doc_id % 2 else "fr") and not r.rejected and 0 <= r.score <= 1 for r in langid.predict(d, model).collect())
    odd = by_id(langid.predict(docs, model).collect())
    assert odd[2].lang_pred == odd[3].lang_pred == odd[4].lang_pred == "und" and odd[2].score == 0
    assert langid.predict(none, model).count() == 0
    assert {r.lang_pred for r in langid.predict(d, langid.fit(none)).collect()} == {"und"}
    assert langid.without_rejected(d, model).count() == 300
    letters = list("abcdefghijklmnopqrstuvwxyz   ")
    noise = spark.createDataFrame([(i, "".join(rng.choice(letters, n)), "en", 1) for i, n in enumerate([60, 200, 600, 2000] * 20)], SCHEMA + ", lang string, _letter int")
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    broad = langid.fit(real)
    assert sum(r.rejected for r in langid.predict(noise, broad).collect()) >= 76
    assert langid.predict(real, broad).filter("rejected").count() <= 20
    assert langid.predict(real.filter("length(text) < 60"), broad).filter("rejected").count() <= 2
    left = langid.without_rejected(noise.limit(1).union(d.limit(5).withColumn("_letter", F.lit(1))), model)
    assert left.columns == noise.columns and {r._letter for r in left.collect()} == {1}
    short = spark.createDataFrame([(i, " ".join(BASE[i : i + 4])) for i in range(60)], SCHEMA)
    assert sum(r.rejected for r in langid.predict(short, model).collect()) <= 3


def test_language_is_learnt_in_tasks(spark, monkeypatch):
    """The driver gets a row for each language, not the sampled texts."""
    rows = [(k, ("un deux trois quatre cinq " if k % 2 else "one two three four five ") * (5 + k % 7), "fr" if k % 2 else "en") for k in range(600)]
    d, got = spark.createDataFrame(rows, SCHEMA + ", lang string"), []
    monkeypatch.setattr(type(d), "toArrow", lambda self, f=type(d).toArrow: got.append(f(self)) or got[-1])
    model = langid.fit(d)
    assert set(model.languages) == {"en", "fr"} and model.radius.shape == (len(model.languages), langid.LENGTHS)
    assert got and max(map(len, got)) <= 2


def test_licences(spark):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c.txt", "text"), (3, "a/b/d.txt", "Licensed under CC BY-NC 4.0.\n" + prose(100, 1)), (4, "e/f.txt", None), (5, None, ""), (2, "a/b/c.txt", "text")]
    got = {r.file_id: (r.licence, r.origin) for r in licences.scan(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()}
    assert got == {1: ("MIT", "own"), 2: ("MIT", "a"), 3: ("CC-BY-NC-4.0", "own"), 4: (None, None), 5: (None, None)}
    assert licences.scan(spark.createDataFrame([], "file_id long, path string, text string")).count() == 0


def test_licences_inside_text(spark):
    def at(text, length):
        before = prose(4000, 3)[: length // 2].rsplit(" ", 1)[0]
        line = f"{before} {text} "
        return line + "x" * (length - len(line))

    texts = []
    for name, text in ((name, text) for name, own in licences.TEMPLATES.items() for text in own):
        texts += [(name, text), (name, prose(40, 1) + " " + text + " " + prose(40, 2)), (name, at(text, 9_999)), (name, at(text, 10_001)), (name, prose(40, 1) + " " + text.replace(" ", "\n") + "\n" + prose(40, 2))]
    texts += [(None, prose(40, 1) + " the license of the hall " + prose(40, 2)), (None, "This work is licensed under the terms of the agreement that was made"), ("MIT", "a\nMIT License\n" + prose(100, 1))]
    rows = [(i, f"f{i}/{i}", text) for i, (_, text) in enumerate(texts)]
    schema = "file_id long, path string, text string"
    got = {r.file_id: r.licence for r in licences.scan(spark.createDataFrame(rows, schema)).collect()}
    assert [got[i] for i in range(len(texts))] == [name for name, _ in texts]
    gnu = [("AGPL-3.0", "GNU Affero General Public License, version 3"), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"), ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file'), (None, "Licensed under the Foo Public License, version 7.")]
    assert [licences.Matcher(licences.TEMPLATES).file(t)[1] for _, t in gnu] == [n for n, _ in gnu]
    rows = [(1, "a/COPYING", licences._MIT), (2, "a/b", "text"), (3, "c/d", "Released under the MIT License. " + prose(9, 1)), (4, "c/e", "text")]
    assert {r.file_id: r.licence for r in licences.scan(spark.createDataFrame(rows, schema)).collect()} == {1: "MIT", 2: "MIT", 3: "MIT", 4: None}
    rows = [(1, "LICENSE", "Released under the MIT License."), (2, "a/b/c.txt", "text"), (3, "/d/e.txt", "text"), (4, "f.txt", "text")]
    assert {r.file_id: (r.licence, r.origin) for r in licences.scan(spark.createDataFrame(rows, schema)).collect()} == {1: ("MIT", "own"), 2: ("MIT", ""), 3: ("MIT", ""), 4: ("MIT", "")}


def test_licence_expressions_and_no_false_inheritance(spark):
    known = {n.lower(): n for n in licences.TEMPLATES}
    said = {
        "GPL-2.0-or-later": "GPL-2.0-or-later", "gpl-2.0-ONLY */": "GPL-2.0-only", "Apache-2.0 or MIT": "Apache-2.0 OR MIT", "(MIT AND (ISC OR Zlib)) -->": "(MIT AND (ISC OR Zlib))",
        "GPL-2.0+ WITH Classpath-exception-2.0": "GPL-2.0+ WITH Classpath-exception-2.0", "Foo-1.0": None, "MIT OR Foo-1.0": None, "MIT OR": None, "(MIT": None, "": None, ") MIT": None,
    }
    assert {x: licences.expression(x, known) for x in said} == said
    rows = [(1, "a/x.c", "// SPDX-License-Identifier: GPL-2.0-or-later\n" + prose(50, 1)), (2, "a/y.c", prose(50, 2)), (3, "a/z.c", "Released under the MIT License."), (4, "a/b/LICENSE.txt", "Released under the MIT License."), (5, "a/b/c/d", "text"), (6, "a/b/LICENSE.md", prose(9, 1))]
    got = {r.file_id: (r.licence, r.origin) for r in licences.scan(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()}
    assert got == {1: ("GPL-2.0-or-later", "own"), 2: (None, None), 3: ("MIT", "own"), 4: ("MIT", "own"), 5: ("MIT", "a/b"), 6: ("MIT", "a/b")}


def test_licence_cosine_is_that_of_all_windows():
    """The best window's cosine against all windows of all lengths, by plain sums over words."""
    templates = {"One": "alpha beta gamma delta licence", "Two": "epsilon zeta licence eta", "Three": "licence alpha eta theta iota kappa"}
    matcher = licences.Matcher(templates)

    def cosine(a, b):
        dot = sum(a[w] * b.get(w, 0.0) for w in a)
        return dot / max(1e-12, np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())))

    rng = np.random.default_rng(8)
    for _ in range(30):
        words = rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa other words here".split(), 14).tolist()
        at = int(rng.integers(0, 14))
        words[at] = "licence"
        best = 0.0
        for k, bag in enumerate(matcher.bags):
            n = matcher.lengths[k]
            for s in range(15):
                for e in range(s + 1, 15):
                    if s <= at < e and -(-3 * n // 4) <= e - s <= 3 * n // 2:
                        best = max(best, cosine(matcher.vector(licences.Counter(words[s:e])), matcher.vector(bag)))
        assert abs(matcher.matches(words, (at, at + 1), [])[0] - best) < 1e-3


def test_html_long_and_deep_pages():
    began = time.time()
    for n in (100_000, 1_000_000):
        page = "<p>" + "<b>word</b> " * n
        assert html.render(page) == " ".join(["word"] * n)
    assert time.time() - began < 90
    deep = "<div>" * 3000
    table = "<table><tr><td>a<td>b<tr><td>c<td>d</table><ul><li>x<li>y</ul>"
    assert html.render(deep + table) == html.render(table)
    nested = "".join(f"<div>a{k}" for k in range(2000)) + "".join(f"</div>z{k}" for k in range(2000))
    assert html.render(nested).split("\n") == [f"a{k}" for k in range(2000)] + [f"z{k}" for k in range(2000)]
    assert html.render("<ul><li>x" * 1500).count("- ") == 1500
    wide = "<table>" + "".join(f"<tr><td>{'w' * (2000 if k == 0 else 1)}<td>e" for k in range(300)) + "</table>"
    lines = html.render(wide).split("\n")
    assert len(lines) == 300 and all(x.index("e") == 2002 for x in lines)
    for odd in ("<div>", "</b>", "<div></b>", "<p><span>", "<li><div>", "<b><button>"):
        html.render(odd * 20_000)
    assert time.time() - began < 180


def test_html(spark):
    page = "<html><head><title>t</title></head><body><p>One <b>two</b><p>three<ul><li>x<li>y<ul><li>z</ul></ul><table><tr><td>a<td>bb<tr><td>ccc<td>d</table><div style='display: none'>no</div><span hidden>no</span><pre>k\n  l</pre>&amp; end<script>no</script>"
    assert html.render(page) == "One two\n\nthree\n\n- x\n- y\n  - z\n\na    bb\nccc  d\n\nk\n  l\n\n& end"
    assert html.render(None) == html.render("") == "" and html.render("<b><i>x</b>y</i></p>") == "xy"
    assert "x" in html.render("<div>" * 5000 + "x")
    assert html.render("<div>" * 250 + "<div hidden>secret<div>x</div>y</div>seen") == "seen"
    assert html.render("a<br><br>b<br>c") == "a\n\nb\nc"
    assert html.render("<table><tr><td rowspan=2>aa<td colspan=2>wide cell text<tr><td>b<td>c<tr><td>1<td>2<td>3</table>") == "aa  wide cell text\n    b  c\n1   2  3"
    assert html.render('x <a href="y>z" w> link</a> 5 < 6 <b') == "x link 5 < 6 <b"
    began = time.time()
    for odd in ("<a ", '<a "', "<!", "<p>", "</b>", "<td rowspan=9>", "<title"):
        html.render(odd * 20_000)
    assert time.time() - began < 20
    df = spark.createDataFrame([(1, page), (2, None), (2, None)], "page_id long, html string")
    assert sorted(len(r.text) for r in html.extracted(df).collect())[:2] == [0, 0]
    assert html.extracted(spark.createDataFrame([], df.schema)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert out and {r.length <= 2048 for r in out} == {True} and len({(r.doc_id, r.piece) for r in out}) == len(out)


def test_workers_forget_tables_of_other_kinds():
    from llm import chunks

    make = lambda path: lambda names: names
    kept = chunks.table_of("kept", "p", make)
    chunks.table_of("other", "p", make)
    chunks.forget("kept")
    assert [k for k in chunks._tables] == [("kept", "p")] and chunks.table_of("kept", "p", make) is kept
    chunks.forget()
    assert not chunks._tables
