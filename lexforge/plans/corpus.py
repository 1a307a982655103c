"""Queries p2, p3 and p6: snapshot changes, repeated messages, orphan references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.operators import delivery, orphans, snapshots
from lexforge.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.article_snapshot_changes(table(spark, d, "normal_articles"), table(spark, d, "source_locks"))


def p2_validity(spark: SparkSession, d: str) -> DataFrame:
    articles = table(spark, d, "normal_articles")
    order = snapshots.snapshot_order(articles, table(spark, d, "source_locks"))
    return snapshots.validity_intervals(articles, order, key="identifier", version=F.col("version.identifier"), compared=[F.col("article_body.html"), F.col("article_body.wikitext")])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return delivery.repeated_messages(table(spark, d, "edge_case_articles"))


def p3_messages(spark: SparkSession, d: str) -> DataFrame:
    kept = delivery.distinct_messages(table(spark, d, "edge_case_articles"))
    return kept.select("source_sequence", "identifier", F.col("version.identifier").alias("version_identifier"), "name", F.col("article_body.wikitext").alias("wikitext"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_references(table(spark, d, "entries"), table(spark, d, "links"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(p6_found(spark, d))


QUERIES = {"p2_found": p2_found, "p2_validity": p2_validity, "p3_found": p3_found, "p3_messages": p3_messages, "p6_found": p6_found, "p6_report": p6_report}

_P2_STATES = """
WITH o AS (
  SELECT snapshot_identifier, row_number() OVER (ORDER BY min(date_modified), snapshot_identifier) AS no
  FROM source_locks WHERE snapshot_identifier IN (SELECT snapshot_identifier FROM normal_articles) AND date_modified IS NOT NULL GROUP BY 1),
f AS MATERIALIZED (
  SELECT snapshot_identifier, identifier, version.identifier AS version, article_body.html AS html, article_body.wikitext AS wikitext FROM normal_articles),
s AS (
  SELECT o.no, f.identifier, f.version, f.html, f.wikitext FROM f JOIN o USING (snapshot_identifier)
  WHERE f.identifier IS NOT NULL AND f.version IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY o.no, f.identifier ORDER BY f.version DESC) = 1)"""

INSTANT = r"""try_cast(CASE WHEN regexp_matches(u, '^\d{8}T\d{6}Z$') THEN regexp_replace(u, '^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})Z$', '\1-\2-\3T\4:\5:\6Z')
    WHEN regexp_matches(u, '(Z|[+-]\d{2}:\d{2})$') THEN u ELSE u || 'Z' END AS timestamptz)"""
_P3_RANKED = r"""
WITH t AS (
  SELECT *, upper(trim(date_modified)) AS u FROM edge_case_articles WHERE identifier IS NOT NULL AND version.identifier + 0 IS NOT NULL),
i AS (
  SELECT *, try_cast(CASE WHEN regexp_matches(u, '^\d{8}T\d{6}Z$') THEN regexp_replace(u, '^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})Z$', '\1-\2-\3T\4:\5:\6Z')
    WHEN regexp_matches(u, '(Z|[+-]\d{2}:\d{2})$') THEN u ELSE u || 'Z' END AS timestamptz) AS instant FROM t),
r AS (
  SELECT *, row_number() OVER (PARTITION BY identifier, version.identifier, instant, CASE WHEN instant IS NULL THEN date_modified END ORDER BY source_sequence) AS rn FROM i)"""

_P6 = r"""
WITH alive AS (
  SELECT tag, strftime(timezone('UTC', rendered_at), '%Y-%m') AS m, arg_max(coalesce(is_deleted, false), (rendered_at, coalesce(is_deleted, false))) AS gone
  FROM entries WHERE tag IS NOT NULL AND rendered_at IS NOT NULL GROUP BY 1, 2),
iv AS (
  SELECT * FROM (SELECT tag, m AS a, coalesce(lead(m) OVER (PARTITION BY tag ORDER BY m), '9999-99') AS b, gone FROM alive) WHERE NOT gone),
nm AS (
  SELECT DISTINCT tag, unnest(list_concat([title], coalesce(aliases, []))) AS name FROM entries WHERE tag IS NOT NULL),
refs AS (
  SELECT 'entries' AS table_name, source_page_id, target, target AS k, strftime(timezone('UTC', seen), '%Y-%m') AS ref_month
  FROM (SELECT page_id AS source_page_id, unnest(internal_targets) AS target, rendered_at AS seen FROM entries WHERE NOT coalesce(is_deleted, false)) WHERE target IS NOT NULL AND target <> ''
  UNION
  SELECT 'links', source_page_id, title, trim(replace(title, '_', ' '), ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(12288) || chr(8199) || chr(8239)), strftime(timezone('UTC', parsed_at), '%Y-%m')
  FROM links WHERE title IS NOT NULL AND namespace IS NULL),
par AS (
  SELECT 'entries' AS table_name, tag AS k, a, b FROM iv UNION SELECT 'links', name, a, b FROM nm JOIN iv USING (tag) WHERE name IS NOT NULL),
orphans AS (
  SELECT table_name, source_page_id, target, ref_month FROM refs r
  WHERE NOT EXISTS (SELECT 1 FROM par p WHERE p.table_name = r.table_name AND p.k = r.k AND p.a <= r.ref_month AND r.ref_month < p.b))"""

ORACLE = {
    "p2_found": _P2_STATES
    + """,
pairs AS (
  SELECT o.snapshot_identifier, coalesce(c.identifier, p.identifier) AS identifier,
    CASE WHEN p.identifier IS NULL THEN 'added' WHEN c.identifier IS NULL THEN 'removed'
         WHEN c.version <> p.version OR c.html IS DISTINCT FROM p.html OR c.wikitext IS DISTINCT FROM p.wikitext THEN 'changed' END AS change_kind
  FROM s c FULL JOIN (SELECT * REPLACE (no + 1 AS no) FROM s) p ON c.no = p.no AND c.identifier = p.identifier
  JOIN o ON o.no = coalesce(c.no, p.no) WHERE o.no > 1)
SELECT snapshot_identifier, identifier, change_kind FROM pairs WHERE change_kind IS NOT NULL""",
    "p3_found": _P3_RANKED + " SELECT source_sequence FROM r WHERE rn > 1",
    "p3_messages": _P3_RANKED + " SELECT source_sequence, identifier, version.identifier AS version_identifier, name, article_body.wikitext AS wikitext FROM r WHERE rn = 1",
    "p6_found": _P6 + " SELECT * FROM orphans",
    "p6_report": _P6 + " SELECT table_name, ref_month, count(*) AS orphans, count(DISTINCT source_page_id) AS sources FROM orphans GROUP BY 1, 2",
    "p2_validity": _P2_STATES
    + """,
m AS (SELECT *, CASE WHEN lag(no) OVER w = no - 1 AND lag(version) OVER w = version AND lag(html) OVER w IS NOT DISTINCT FROM html AND lag(wikitext) OVER w IS NOT DISTINCT FROM wikitext THEN 0 ELSE 1 END AS st
  FROM s WINDOW w AS (PARTITION BY identifier ORDER BY no)),
g AS (SELECT *, sum(st) OVER (PARTITION BY identifier ORDER BY no) AS isl FROM m)
SELECT identifier, min(version) AS version, min(no) AS valid_from, max(no) AS valid_to FROM g GROUP BY identifier, isl""",
}
