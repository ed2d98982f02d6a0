"""The queries of the corpus operators and the SQL that goes with them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, html_extract, mixing, ngram_join, packing, quality, token_files, toxicity, vector_dedup, warc
from .common import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(table(spark, sf_dir, "pages"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op8_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.shingle_components(table(spark, sf_dir, "documents"))


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


#: A reading of the mix without slots or blocks: each source's shuffled stream is
#: read up to its target, and a document is taken where the reading covers it.
OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '') AS src,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
s0 AS (SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY src = '', src) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s0),
s2 AS (
  SELECT *, row_number() OVER o AS rank,
         sum(source_size) OVER () * 1.5::DOUBLE - 2 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_rest
  FROM s1 WINDOW o AS (ORDER BY 2 * source_size / w::DOUBLE, src)),
bar AS (SELECT coalesce(arg_min(rest / w_rest, rank), 0)::DOUBLE AS lam FROM s2 WHERE rest / w_rest <= 2 * source_size / w::DOUBLE),
s AS (SELECT src, source_size, least(2.0::DOUBLE * source_size, lam * w)::DOUBLE AS target FROM s2, bar),
p AS (
  SELECT doc_id, src, size,
         coalesce(sum(size) OVER (PARTITION BY src ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM d)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(pos + size, floor(target)::BIGINT) - least(pos, floor(target)::BIGINT))
        + greatest(0, least(source_size + pos + size, floor(target)::BIGINT) - least(source_size + pos, floor(target)::BIGINT)))::BIGINT AS taken
FROM p JOIN s USING (src)
"""

OP6_SQL = r"""
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (w ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW w AS (PARTITION BY t)
"""


OP8_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS last FROM p)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(h, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM q
"""

OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) = 0 THEN []::VARCHAR[] WHEN len(a) < 5 THEN [array_to_string(a, ' ')]
    ELSE list_transform(range(1, len(a) - 3), lambda i: array_to_string(a[i:i + 4], ' ')) END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT p.a, p.b FROM (SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS c FROM s JOIN s t USING (x) WHERE s.doc_id <> t.doc_id GROUP BY ALL) p
  JOIN n ON n.doc_id = p.a JOIN n m ON m.doc_id = p.b WHERE 100 * c >= 75 * (n.n + m.n - c)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, least(doc_id, coalesce(min(r.b), doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = doc_id GROUP BY doc_id
"""

OP10_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
  WHERE list_inner_product(p.x, q.x) >= 0.93 * sqrt(list_inner_product(p.x, p.x)) * sqrt(list_inner_product(q.x, q.x))),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
d AS (SELECT a, count(*) AS n FROM e GROUP BY a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT vec_id, coalesce(d.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m.b, vec_id)) AS component_id, least(vec_id, coalesce(m.b, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN d ON d.a = vec_id LEFT JOIN m ON m.a = vec_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    operators = {
        f.__name__: f
        for f in (op1_packing, op2_quality, op3_main_text, op4_source_mix, op5_toxicity, op6_exact_dedup, op7_token_files, op8_warc_archives, op9_ngram_join, op10_vector_dedup)
    }
    return operators | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return whole | {"op4_source_mix": OP4_SQL, "op6_exact_dedup": OP6_SQL, "op8_warc_archives": OP8_SQL, "op9_ngram_join": OP9_SQL, "op10_vector_dedup": OP10_SQL}
