"""The numbered queries of this package, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import audit, collocations, decontaminate, html, jaccard, langid, licences, packing, pieces, pii, quality, topk, toxicity
from llm.tables import held_out, read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    model = toxicity.fit(documents, read(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(read(spark, sf_dir, "documents")))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(read(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is a file ``source/lang/doc_id``; none is named like a licence file, so none speaks for others."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.col("doc_id").cast("string"))
    files = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")
    return licences.scan(files).withColumnRenamed("file_id", "doc_id")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    predicted = langid.predict(documents, langid.fit(documents))
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(read(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_packing, op3_topk, op4_sentencepiece, op5_pii, op6_licences, op7_jaccard, op8_quality, op9_language, op10_html, op11_collocations, op12_filter_audit, op13_decontamination, pipeline)
}

#: The rest can't be said in SQL or would not end on whole tables; tests/llm hold them against brute force.
ORACLES: dict[str, str] = {
    "op3_topk": """
WITH fine AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS no, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.no AS query_no, c.no AS no, c.vec_id AS vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM fine q JOIN fine c ON q.no <> c.no WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id, query_no ORDER BY score DESC, vec_id, no) AS rank FROM scored) WHERE rank <= 5
""",
    "op12_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
earliest AS (SELECT text, min(doc_id) AS least FROM d GROUP BY text),
said AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
  FROM w JOIN earliest USING (text) LEFT JOIN said USING (doc_id)),
counted AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
f AS (SELECT i, 1 << i AS bit, substr('ABCDE', CAST(i AS INTEGER) + 1, 1) AS name FROM range(5) r(i)),
o AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
steps AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS earlier FROM o, range(1, 6) s(step)),
every AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM every
""",
    "op13_decontamination": r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS no,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[k:k + m - 1], ' ') AS win
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM (SELECT *, least(len(w), 10) AS m FROM i WHERE len(w) > 0))),
dw AS (
  SELECT no, m, k, array_to_string(w[k:k + m - 1], ' ') AS win
  FROM (SELECT no, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
hits AS (SELECT DISTINCT no, k, dw.m AS m FROM dw WHERE win IN (SELECT win FROM iw WHERE iw.m = dw.m)),
places AS (SELECT no, count(DISTINCT p) AS n_hit FROM (SELECT no, unnest(range(k, k + m)) AS p FROM hits) GROUP BY no),
held AS (SELECT DISTINCT no, item_id FROM dw JOIN iw USING (m, win) WHERE item_id IS NOT NULL),
ids AS (SELECT no, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM held GROUP BY no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (no) LEFT JOIN ids USING (no)
""",
    "op11_collocations": r"""
WITH t AS (SELECT row_number() OVER () AS no, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT no, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT no, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t)),
g AS (
  SELECT lang, k, w[i:i + k - 1] AS words
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 4) s(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, array_to_string(words, ' ') AS phrase, words, count(*) AS a FROM g GROUP BY lang, k, words),
n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT * FROM f WHERE k > 1 AND a >= 10),
cut AS MATERIALIZED (
  SELECT lang, phrase, a, j, array_to_string(words[1:j], ' ') AS front, array_to_string(words[j + 1:], ' ') AS back
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
fronts AS MATERIALIZED (SELECT cut.*, x.a AS l FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.front),
cuts AS (
  SELECT t.lang, t.phrase, t.a, l, y.a AS r, j, CAST(CAST(1000000 AS HUGEINT) * t.a * t.a // (CAST(l AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM fronts t JOIN f y ON y.lang = t.lang AND y.phrase = t.back),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM cuts),
inside AS (SELECT lang, a, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase FROM c WHERE k = 3),
dropped AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase AND 100 * i.a >= 50 * c.a),
ranked AS (
  SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM dropped d WHERE d.lang = lowest.lang AND d.phrase = lowest.phrase))
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
""",
}
