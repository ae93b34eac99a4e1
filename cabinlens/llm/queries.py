"""Queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabinlens.llm import (
    ann_forest, byte_bpe, dart_minhash, decontaminate, jaccard_join, language_id, lexical_search, line_dedup, pii,
    substring_dedup, token_alignment, token_counts, toxicity,
)
from cabinlens.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return put


OP1_SQL = r"""
WITH wd AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
wi AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
  FROM wi, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS u(i) WHERE len(w) > 0),
spans AS (
  SELECT d.doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS t
  FROM wd d, (SELECT DISTINCT k FROM win) ks, unnest(range(1, len(w) - k + 2)) AS u(i) WHERE len(w) >= k),
hit AS (SELECT a.doc_id, a.i, a.k, w.item_id FROM spans a JOIN win w USING (t, k)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + k)) AS u(p) GROUP BY doc_id),
of_doc AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM wd d LEFT JOIN covered USING (doc_id) LEFT JOIN of_doc USING (doc_id)
"""


@query("op1_decontaminate", OP1_SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


OP9_SQL = r"""
WITH wd AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM wd, unnest(range(1, len(w) - 48)) AS u(i) WHERE len(w) >= 50),
firsts AS (SELECT h, min(doc_id) AS f FROM win GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, p FROM win JOIN firsts USING (h), unnest(range(i, i + 50)) AS u(p) WHERE doc_id > f),
cut AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (
  SELECT wd.doc_id, len(w) AS n, coalesce(len(ps), 0) AS c,
    CASE WHEN ps IS NULL THEN w ELSE (SELECT list(w[q] ORDER BY q) FROM unnest(range(1, len(w) + 1)) AS u(q) WHERE NOT list_contains(ps, q)) END AS k
  FROM wd LEFT JOIN cut USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(c AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept
"""


@query("op9_substring_dedup", OP9_SQL)
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))


@query("op6_minhash_near_dedup")
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op2_line_dedup")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def _vocabulary() -> tuple[str, str]:
    """Path and pattern of the public vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), *_vocabulary())


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(read_table(spark, sf_dir, "documents")))


@query("op3_ann_forest")
def op3_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_report(token_counts.lengths(read_table(spark, sf_dir, "documents"), *_vocabulary()))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE doc_id IS NOT NULL),
i AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
held AS (SELECT i, item_id, t, count(*) AS c FROM i, unnest(w) AS u(t) GROUP BY ALL),
total AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
tf AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, t, count(*) AS tf FROM d, unnest(w) AS u(t) WHERE t IN (SELECT t FROM held) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS g FROM df, total),
impacts AS (SELECT r, doc_id, t, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)) AS p FROM tf, total),
scores AS (
  SELECT i, item_id, r, doc_id, CAST(sum(c * g * p) AS BIGINT) AS score FROM held JOIN weights USING (t) JOIN impacts USING (t) GROUP BY ALL),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


@query("op11_lexical_search", OP11_SQL)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS t
  FROM w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
pairs AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.t = y.t AND x.r < y.r GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON a = x.r JOIN n y ON b = y.r WHERE 100 * c >= 85 * (x.n + y.n - c)),
either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT r, r FROM w UNION SELECT reach.a, either.b FROM reach JOIN either ON reach.b = either.a),
component AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN w ON b = w.r GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM w JOIN component USING (r) LEFT JOIN n USING (r)
"""


@query("op12_jaccard_join", OP12_SQL)
def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    return token_alignment.alignment(
        read_table(spark, sf_dir, "documents"), tokenizers.path("byte_bpe_50k.json"), tokenizers.PATTERN,
        tokenizers.path("piece_bpe_32k.model"))
