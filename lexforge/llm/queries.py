"""Queries p1, p4, p5, p7, p8 and p9, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm import bpe, lookalike, markup, packing, pieces, survivor
from lexforge.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    texts = lookalike.article_and_alias_texts(table(spark, d, "normal_articles"), table(spark, d, "aliases"))
    return lookalike.lookalike_pairs(texts, "key", "text")


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    texts = lookalike.article_and_alias_texts(table(spark, d, "normal_articles"), table(spark, d, "aliases"))
    return lookalike.look_classes(texts, "key", "text")


_BODY = ["source_table", "identifier", "version_identifier"]


def _bodies(spark: SparkSession, d: str) -> list[DataFrame]:
    return markup.article_bodies(table(spark, d, "normal_articles"), table(spark, d, "edge_case_articles"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.structural_elements(_bodies(spark, d), "body", _BODY)


def p4_text(spark: SparkSession, d: str) -> DataFrame:
    parts = [markup.parse_bodies(markup.distinct_bodies(b, "body", _BODY), "body", _BODY).select(*_BODY, "text") for b in _bodies(spark, d)]
    return parts[0].unionByName(parts[1])


def p4_paths(spark: SparkSession, d: str) -> DataFrame:
    """Ratios and verdict of each tag path of the corpus, with the nodes that it keeps or leaves out."""
    return markup.leaf_scores(markup.parsed_bodies(_bodies(spark, d), "body", _BODY))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.surviving_duplicates(table(spark, d, "article_states"), table(spark, d, "ingest_duplicates"))


def p5_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivor.surviving_states(table(spark, d, "article_states"), table(spark, d, "ingest_duplicates"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_documents(table(spark, d, "documents"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_all(table(spark, d, "documents"), table(spark, d, "token_limits"))


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.split_documents(table(spark, d, "documents"), table(spark, d, "token_limits"))


QUERIES = {
    "p1_found": p1_found, "p1_forms": p1_forms, "p4_found": p4_found, "p4_text": p4_text, "p4_paths": p4_paths, "p5_found": p5_found, "p5_survivors": p5_survivors, "p7_ids": p7_ids, "p8_containers": p8_containers, "p9_pieces": p9_pieces,
}

ORACLE = {
    "p5_found": r"""
WITH k AS (
  SELECT page_id, revision_id, source_hash AS h, source_sequence, 1 AS own FROM article_states
  UNION ALL SELECT page_id, kept_revision_id, kept_hash, source_sequence, 0 FROM ingest_duplicates),
c AS (
  SELECT page_id, revision_id, source_sequence, own, CASE WHEN regexp_full_match(lower(regexp_replace(h, '^\s+|\s+$', '', 'g')), '[0-9a-f]{64}') THEN lower(regexp_replace(h, '^\s+|\s+$', '', 'g')) END AS h FROM k),
t AS (SELECT page_id, max(revision_id) AS revision_id FROM c GROUP BY 1 HAVING sum(own) >= 2 AND max(revision_id) IS NOT NULL)
SELECT t.page_id, t.revision_id, (SELECT arg_min(c.h, c.source_sequence) FROM c WHERE c.page_id = t.page_id AND c.revision_id = t.revision_id AND c.h IS NOT NULL) AS source_hash FROM t""",
    "p5_survivors": r"""
WITH k AS (
  SELECT page_id, revision_id, source_hash AS h, source_sequence, 1 AS own, title, ingest_status, is_deleted, seen_at FROM article_states WHERE page_id IS NOT NULL
  UNION ALL SELECT page_id, kept_revision_id, kept_hash, source_sequence, 0, NULL, NULL, NULL, NULL FROM ingest_duplicates WHERE page_id IS NOT NULL),
c AS (
  SELECT * EXCLUDE h, CASE WHEN regexp_full_match(lower(regexp_replace(h, '^\s+|\s+$', '', 'g')), '[0-9a-f]{64}') THEN lower(regexp_replace(h, '^\s+|\s+$', '', 'g')) END AS h,
    {'a': (title IS NOT NULL)::INT + (seen_at IS NOT NULL)::INT + (is_deleted IS NOT NULL)::INT + (coalesce(ingest_status, '') = 'accepted')::INT, 'b': coalesce(epoch_us(seen_at), -1), 'c': -coalesce(source_sequence, 4611686018427387904)} AS worth FROM k),
t AS (SELECT page_id, sum(own) AS own_rows, max(revision_id) AS revision_id FROM c GROUP BY 1),
f AS (SELECT t.page_id, arg_min({'h': c.h, 's': c.source_sequence}, c.source_sequence) AS f FROM t JOIN c ON c.page_id = t.page_id AND c.revision_id = t.revision_id WHERE c.h IS NOT NULL GROUP BY 1),
d AS (
  SELECT t.page_id, c.* EXCLUDE page_id, row_number() OVER (PARTITION BY t.page_id ORDER BY c.revision_id IS NOT DISTINCT FROM t.revision_id DESC, c.worth DESC) AS rn FROM t JOIN c ON c.page_id = t.page_id AND c.own = 1)
SELECT t.page_id, t.own_rows::BIGINT AS own_rows, t.revision_id, f.f.h AS source_hash, f.f.s AS source_sequence, d.title, d.ingest_status, d.is_deleted, d.seen_at, d.revision_id AS detail_revision_id
FROM t LEFT JOIN f USING (page_id) LEFT JOIN d ON d.page_id = t.page_id AND d.rn = 1""",
}
