"""One query per operator, over whole tables, and the SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    cross_tokens,
    exact_dedup,
    fim,
    html_extract,
    knn,
    langid,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    pii,
    token_counts,
    toxicity,
)
from tessera.llm.common import held_out, scratch_path
from tessera.sources.io import read_table

TOKENIZER = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return exact_dedup.mark(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op1_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept,
       sha256(norm) AS text_sha256
FROM g"""


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    learn = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    model = langid.train(docs, learn=learn)
    return langid.predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mark(read_table(spark, sf_dir, "documents"))


ORACLE["op4_source_mix"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, md5('17:' || CAST(doc_id AS VARCHAR)) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, sum(size) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w
  FROM d GROUP BY source),
fill(step, level) AS (
  SELECT 0, CAST(0 AS DOUBLE)
  UNION ALL
  SELECT step + 1,
         (1.5 * (SELECT sum(source_size) FROM s)
          - (SELECT coalesce(sum(CASE WHEN w * level > 2 * source_size THEN 2 * source_size END), 0) FROM s))
         / nullif((SELECT sum(CASE WHEN w * level <= 2 * source_size AND source_size > 0 THEN w END) FROM s), 0)
  FROM fill WHERE step < 60),
t AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
         CAST(CASE WHEN source_size = 0 THEN 0
              ELSE least(2.0 * source_size, w * (SELECT max(level) FROM fill)) END AS DOUBLE) AS target
  FROM s),
r AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(round(target) AS BIGINT) // source_size END AS whole FROM t),
c AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.whole, CAST(round(r.target) AS BIGINT) - r.whole * r.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.digest, d.doc_id) - d.size AS before
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM c"""


@query
def op2_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own for each call: every distinct content is encoded
    cache = scratch_path(spark, "token-cache")
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path(), cache)


@query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.mark(read_table(spark, sf_dir, "documents"), k=3, percent=85)


ORACLE["op6_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id
                        GROUP BY ALL) p
  JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * p.i >= 85 * (x.n + y.n - p.i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id,
       coalesce(c.component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id"""


@query
def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


ORACLE["op10_topk_search"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    learn = F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), learn)
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents"))
    digest = F.sha2("base", 256).alias("base_sha256")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", digest, "spans")


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_lines(read_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return found.select("doc_id", "n_lines", "n_dropped", digest)


ORACLE["op11_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
h AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, h.key IS NOT NULL AS hot FROM k LEFT JOIN h ON h.key = k.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE hot) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT hot), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


@query
def op12_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokens.align(read_table(spark, sf_dir, "documents"), *map(tokenizer_path, ALIGNED))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.assemble(read_table(spark, sf_dir, "documents"))


ORACLE["op13_fill_in_middle"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents),
e AS (
  SELECT *, length(t) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM e),
c AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c"""
