"""Queries on records: validation, deduplication, child tables, links, hashes, snapshots, integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexforge.functions import hashing, strings, urls
from lexforge.operators import compare, delivery, ingest, links, sampling, search, snapshots, verify
from lexforge.plans.sqltext import FOLDING, B, sql_strip, sql_title
from lexforge.session import materialize, table

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


LATEST_SQL = f"""{FOLDING},
base AS MATERIALIZED (SELECT identifier, name, version.identifier AS version, snapshot_identifier, article_body.html AS html, article_body.wikitext AS wikitext, categories, redirects, license, image, url FROM normal_articles),
pages AS (SELECT identifier AS page_id, name AS title, html, categories, redirects, license, image, url FROM base WHERE identifier IS NOT NULL AND version IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY version DESC, snapshot_identifier, name) = 1)"""


def pages(spark: SparkSession, d: str) -> DataFrame:
    """The newest row of each page, without its body: rows tied in version, snapshot and name do not differ in it."""
    rows = table(spark, d, "normal_articles").select("identifier", "name", F.col("version.identifier").alias("version"), "snapshot_identifier", "categories", "redirects", "license", "image", "url")
    order = Window.partitionBy("identifier").orderBy(F.desc("version"), F.asc_nulls_last("snapshot_identifier"), F.asc_nulls_last("name"))
    newest = rows.filter("identifier is not null and version is not null").withColumn("_rn", F.row_number().over(order)).filter("_rn = 1")
    return newest.select(F.col("identifier").alias("page_id"), F.col("name").alias("title"), "categories", "redirects", "license", "image", "url")


def page_bodies(spark: SparkSession, d: str) -> DataFrame:
    """The newest row of each page with its body; the winners are chosen on narrow columns and read where they lie."""
    rows = table(spark, d, "normal_articles").withColumn("_s", F.col("snapshot_identifier").isNull()).withColumn("_n", F.col("name").isNull())
    known = F.col("identifier").isNotNull() & F.col("version.identifier").isNotNull()
    newest = delivery.newest_rows(rows, key=F.col("identifier"), counted=known, revision=F.col("version.identifier"), arrival=["_s", "snapshot_identifier", "_n", "name"])
    return newest.select(F.col("identifier").alias("page_id"), F.col("name").alias("title"), F.col("article_body.html").alias("html"), "categories", "redirects", "license", "image", "url")


_PROBLEMS = """
r AS MATERIALIZED (SELECT source_sequence, identifier, name, url, namespace.identifier AS ns, article_body.html AS html, article_body.wikitext AS wikitext FROM edge_case_articles),
p AS (SELECT *, list_filter([CASE WHEN strlen(name) > 4096 THEN 'REC_TITLE_TOO_LONG' END, CASE WHEN strlen(url) > 16384 THEN 'REC_URL_TOO_LONG' END,
  CASE WHEN NOT coalesce(regexp_matches(url, '^(?i:https)://[^/?#\\s]+'), false) THEN 'REC_INVALID_URL' END, CASE WHEN NOT coalesce(ns = 0, false) THEN 'REC_UNEXPECTED_NAMESPACE' END,
  CASE WHEN strlen(html) > 67108864 THEN 'REC_HTML_TOO_LARGE' END, CASE WHEN strlen(wikitext) > 67108864 THEN 'REC_WIKITEXT_TOO_LARGE' END], lambda x: x IS NOT NULL) AS problems FROM r)"""


def _validated(spark: SparkSession, d: str) -> DataFrame:
    return ingest.validate(table(spark, d, "edge_case_articles"))


@query(f"WITH {_PROBLEMS} SELECT source_sequence, identifier AS page_id, unnest(problems) AS code FROM p")
def f01_record_problems(spark, d):
    return _validated(spark, d).select("source_sequence", F.col("identifier").alias("page_id"), F.explode("problems").alias("code"))


@query(f"WITH {_PROBLEMS} SELECT CASE WHEN len(problems) = 0 THEN 'accepted' ELSE 'rejected' END AS ingest_status, count(*) AS n FROM p GROUP BY 1")
def f02_status_counts(spark, d):
    return _validated(spark, d).groupBy("ingest_status").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_PROBLEMS} SELECT count(*) AS read, count(*) FILTER (WHERE len(problems) = 0) AS written, count(*) FILTER (WHERE len(problems) > 0) AS rejected, coalesce(sum(len(problems)), 0)::BIGINT AS errors FROM p")
def a03_ingest_metrics(spark, d):
    return ingest.ingest_metrics(_validated(spark, d))


_STATES = "s AS (SELECT page_id, revision_id, source_hash, source_sequence FROM article_states WHERE page_id IS NOT NULL AND revision_id IS NOT NULL GROUP BY ALL)"


def _states(spark, d) -> DataFrame:
    """Distinct states with a known revision, in delivery order."""
    return table(spark, d, "article_states").select("page_id", "revision_id", "source_hash", "source_sequence").filter("page_id is not null and revision_id is not null").distinct()


@query(f"WITH {_STATES} SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY revision_id DESC, source_sequence, source_hash NULLS FIRST) = 1")
def d01_accepted_states(spark, d):
    return ingest.latest_states(_states(spark, d), key="page_id", revision="revision_id", arrival=["source_sequence", "source_hash"])


_AUDIT = f"""{_STATES}, n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY source_sequence, source_hash NULLS FIRST) AS seq FROM s),
w AS (SELECT *, max({{'r': revision_id, 'a': -seq, 'h': coalesce(source_hash, '')}}) OVER (PARTITION BY page_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS o FROM n),
audit AS (SELECT page_id, greatest(revision_id, o.r) AS kept_revision_id, least(revision_id, o.r) AS dropped_revision_id, CASE WHEN revision_id > o.r THEN coalesce(source_hash, '') ELSE o.h END AS kept_hash,
  CASE WHEN revision_id > o.r THEN o.h ELSE coalesce(source_hash, '') END AS dropped_hash, CASE WHEN revision_id > o.r THEN 'newer_revision_replaced_older' WHEN revision_id < o.r THEN 'out_of_order_older_revision_dropped'
  WHEN coalesce(source_hash, '') = o.h THEN 'identical_duplicate_delivery' ELSE 'same_revision_conflicting_hash' END AS reason, source_sequence FROM w WHERE seq > 1)"""


@query(f"WITH {_AUDIT} SELECT * FROM audit")
def d02_dedup_audit(spark, d):
    states = _states(spark, d).withColumn("source_hash", F.coalesce("source_hash", F.lit("")))
    return ingest.dedup_audit(states, key="page_id", revision="revision_id", content_hash="source_hash", arrival=["source_sequence", "source_hash"]).drop("source_hash")


@query(f"WITH {_AUDIT} SELECT reason, count(*) AS n FROM audit GROUP BY 1")
def a01_reason_counts(spark, d):
    return d02_dedup_audit(spark, d).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT page_id, revision_id AS r, source_hash AS h, coalesce(ingest_status = 'accepted', false) AS v, source_sequence AS a FROM article_states WHERE page_id IS NOT NULL AND revision_id IS NOT NULL),
l AS (SELECT page_id, list({'r': r, 'h': h, 'ok': v, 'top': CASE WHEN v THEN r END} ORDER BY a, r, h, v) AS l, count(*) AS n FROM s GROUP BY 1),
f AS (SELECT page_id, n, list_reduce(l, lambda x, y: CASE WHEN x.top IS NULL OR y.r > x.top THEN {'r': y.r, 'h': y.h, 'ok': y.ok, 'top': CASE WHEN y.ok THEN y.r END} ELSE x END) AS w FROM l)
SELECT page_id, w.r AS revision_id, w.h AS source_hash, CASE WHEN w.top IS NOT NULL THEN 'accepted' ELSE 'rejected' END AS status, n AS arrivals FROM f""")
def d03_folded_states(spark, d):
    states = table(spark, d, "article_states").withColumn("valid", F.col("ingest_status") == "accepted")
    return ingest.fold_states(states.filter("page_id is not null and revision_id is not null"), arrival=["source_sequence"])


def _children(field: str, alias: str) -> str:
    return f"""WITH {LATEST_SQL}, e AS (SELECT page_id, unnest(range(len({field}))) AS pos, unnest({field}).name AS name FROM pages),
n AS (SELECT *, {sql_title('name')} AS normalized_name FROM e WHERE name IS NOT NULL), k AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY page_id, normalized_name ORDER BY pos) = 1)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS ordinal, name, normalized_name FROM k"""


@query(_children("redirects", "r"))
def proj02_redirects(spark, d):
    return ingest.explode_children(pages(spark, d), "redirects", page="page_id")


@query(_children("categories", "c"))
def proj02_categories(spark, d):
    return ingest.explode_children(pages(spark, d), "categories", page="page_id")


_LICENSE = f"WITH {LATEST_SQL}, e AS (SELECT page_id, unnest(range(len(license))) AS pos, unnest(license) AS l FROM pages)"


@query(f"{_LICENSE} SELECT l.identifier AS identifier, l.url AS url, arg_min(l.name, (page_id, pos)) AS name FROM e GROUP BY 1, 2")
def proj03_license_dimension(spark, d):
    return ingest.licenses(pages(spark, d).withColumn("at", F.col("page_id")), page="page_id", arrival="at")[0]


@query(f"{_LICENSE}, f AS (SELECT page_id, l.identifier AS identifier, l.url AS url, min(pos) AS pos FROM e GROUP BY 1, 2, 3) SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS ordinal, identifier, url FROM f")
def j05_license_bridge(spark, d):
    return ingest.licenses(pages(spark, d).withColumn("at", F.col("page_id")), page="page_id", arrival="at")[1].withColumnRenamed("_page", "page_id")


@query(f"WITH {LATEST_SQL} SELECT page_id, coalesce(nullif(image.content_url, ''), nullif(image.url, '')) AS content_url, image.width AS width, image.height AS height FROM pages WHERE coalesce(nullif(image.content_url, ''), nullif(image.url, '')) IS NOT NULL")
def s05_main_images(spark, d):
    return ingest.main_image(pages(spark, d), page="page_id")


@query(f"WITH {LATEST_SQL}, e AS (SELECT page_id, unnest(range(len(redirects))) AS pos, unnest(redirects).name AS name FROM pages), n AS (SELECT *, {sql_title('name')} AS k FROM e WHERE name IS NOT NULL), k AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY page_id, k ORDER BY pos) = 1), g AS (SELECT page_id, list(name ORDER BY pos) AS redirects FROM k GROUP BY 1) SELECT p.page_id, coalesce(g.redirects, []) AS redirects FROM pages p LEFT JOIN g USING (page_id)")
def j03_redirect_aliases(spark, d):
    all_pages = pages(spark, d)
    kids = ingest.explode_children(all_pages, "redirects", page="page_id")
    return ingest.hydrate(all_pages.select("page_id"), {"redirects": kids}, page="page_id")


_RESOLVED = f"""{LATEST_SQL}, ti AS (SELECT {sql_title('title')} AS k, page_id FROM pages WHERE title IS NOT NULL), t AS (SELECT k, min(page_id) AS p FROM ti GROUP BY 1), ai AS (SELECT {sql_title('title')} AS k, page_id FROM aliases WHERE title IS NOT NULL AND page_id IS NOT NULL), a AS (SELECT k, min(page_id) AS p FROM ai GROUP BY 1),
u AS (SELECT DISTINCT title, replace(title, '_', ' ') AS blank FROM links WHERE title IS NOT NULL), v AS (SELECT title, {sql_title('blank')} AS k FROM u),
l AS (SELECT links.*, CASE WHEN namespace IS NULL THEN v.k END AS k FROM links LEFT JOIN v USING (title)),
resolved AS (SELECT l.source_page_id, l.ordinal, l.namespace, l.title, l.fragment, coalesce(t.p, a.p) AS target_page_id, CASE WHEN l.namespace IS NOT NULL THEN 'externalized' WHEN coalesce(t.p, a.p) IS NOT NULL THEN 'resolved' ELSE 'missing' END AS resolution
  FROM l LEFT JOIN t ON l.k = t.k AND l.k <> '' LEFT JOIN a ON l.k = a.k AND l.k <> '')"""


def _resolved(spark, d) -> DataFrame:
    found = table(spark, d, "links").select("source_page_id", "ordinal", "namespace", "title", "fragment")
    redirects = table(spark, d, "aliases").select(F.col("page_id").alias("target_page_id"), "title")
    key = lambda c: strings.nfkc_title(F.replace(c, F.lit("_"), F.lit(" ")))
    return links.resolve(found, pages(spark, d), redirects, key=key)


@query(f"WITH {_RESOLVED} SELECT * FROM resolved")
def j01_resolved_links(spark, d):
    return _resolved(spark, d)


@query(f"WITH {_RESOLVED} SELECT resolution, count(*) AS n FROM resolved GROUP BY 1")
def j01_link_resolution_counts(spark, d):
    return links.resolution_counts(_resolved(spark, d))


@query("""SELECT source_page_id, ordinal, CASE WHEN resolution = 'resolved' AND target_page_id IS NULL THEN 'MODEL_LINK_RESOLVED_WITHOUT_PAGE_ID' ELSE 'MODEL_LINK_UNRESOLVED_WITH_PAGE_ID' END AS code FROM links
WHERE (resolution = 'resolved' AND target_page_id IS NULL) OR (resolution <> 'resolved' AND target_page_id IS NOT NULL)""")
def f03_inconsistent_links(spark, d):
    return links.inconsistent_links(table(spark, d, "links"))


@query(rf"""WITH {LATEST_SQL}, h AS (SELECT page_id, regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]*)"', 1) AS hs FROM pages), e AS (SELECT page_id, unnest(range(len(hs))) AS pos, replace(replace(unnest(hs), '&quot;', '"'), '&amp;', '&') AS u FROM h),
q AS (SELECT *, CASE WHEN starts_with(u, './') THEN u[3:] WHEN starts_with(u, '/wiki/') THEN u[7:] END AS p FROM e), r AS (SELECT *, split_part(p, '?', 1) AS p2 FROM q WHERE p IS NOT NULL),
t AS (SELECT *, {sql_strip("replace(url_decode(replace(split_part(p2, '#', 1), '+', '%2B')), '_', ' ')")} AS title0, CASE WHEN contains(p2, '#') THEN nullif(url_decode(regexp_extract(p2, '^[^#]*#(.*)$', 1)), '') END AS fragment FROM r)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS ordinal, title0 AS title, fragment FROM t WHERE title0 <> ''""")
def proj06_extracted_links(spark, d):
    found = links.extract_links(page_bodies(spark, d), page="page_id", html="html")
    whole = F.when(F.col("namespace").isNotNull(), F.concat("namespace", F.lit(":"), "title")).otherwise(F.col("title"))
    return found.select("page_id", "ordinal", whole.alias("title"), "fragment")


@query(f"WITH {LATEST_SQL} SELECT page_id, sha256(coalesce(html, '')) AS content_hash, regexp_extract(url, '^(https?://[^/]+)', 1) AS base FROM pages")
def x20_content_hashes(spark, d):
    return page_bodies(spark, d).select("page_id", hashing.content_hash(F.coalesce("html", F.lit(""))).alias("content_hash"), F.coalesce(urls.base_url(F.col("url")), F.lit("")).alias("base"))


_PARTS = "[coalesce(title, chr(0)), coalesce(html, chr(0)), sha256(to_json(list_sort(list_transform(coalesce(categories, []), lambda x: x.name)))::VARCHAR), sha256(to_json(list_sort(list_transform(coalesce(redirects, []), lambda x: x.name)))::VARCHAR)]"


@query(f"WITH {LATEST_SQL} SELECT page_id, sha256(array_to_string(list_transform({_PARTS}, lambda p: length(p)::VARCHAR || ':' || p), chr(31))) AS logical_hash FROM pages")
def a11_logical_hashes(spark, d):
    p = page_bodies(spark, d)
    names = lambda c: F.transform(c, lambda x: x["name"])
    return p.select("page_id", hashing.article_logical_hash(ordered=[F.col("title"), F.col("html")], unordered=[names("categories"), names("redirects")]).alias("logical_hash"))


_LIMBS = ", ".join(f"sum(('0x' || substr(h, {1 + 8 * k}, 8))::BIGINT)::VARCHAR" for k in range(8))


@query(f"""WITH f AS (SELECT source, sha256(length(title)::VARCHAR || ':' || title || ':' || sha256(coalesce(text, ''))) AS h FROM documents WHERE title IS NOT NULL),
g AS (SELECT source, concat_ws(',', count(*)::VARCHAR, {_LIMBS}) AS s FROM f GROUP BY 1) SELECT source, sha256(s) AS set_hash FROM g""")
def a12_stream_set_hash(spark, d):
    return hashing.stream_set_hash(table(spark, d, "documents").filter("title is not null"), name="title", content="text", by="source")


_FILES = "SELECT snapshot_identifier, downloaded_at, unnest(files) AS f FROM source_locks"


_CHUNKS = f"""f AS (SELECT project, snapshot_identifier, date_modified, regexp_extract(f.chunk_identifier, '(chunk_\\d+)$', 1) AS chunk_key, arg_max(f.size_bytes, downloaded_at) AS size_bytes, arg_max(f.sha256, downloaded_at) AS sha256
  FROM (SELECT project, snapshot_identifier, date_modified, downloaded_at, unnest(files) AS f FROM source_locks) GROUP BY ALL),
o AS (SELECT *, lead(snapshot_identifier) OVER (PARTITION BY project ORDER BY date_modified, snapshot_identifier) AS later FROM (SELECT DISTINCT project, snapshot_identifier, date_modified FROM f))"""


def _chunk_lists(spark, d) -> tuple[DataFrame, DataFrame]:
    """The files of each snapshot's latest lock, keyed by the later snapshot and the chunk's number: previous and new lists."""
    rows = compare.lock_files(table(spark, d, "source_locks"))
    key = F.regexp_extract("chunk_identifier", r"(chunk_\d+)$", 1)
    lists = rows.groupBy("project", "snapshot_identifier", "date_modified", key.alias("chunk_key")).agg(F.max_by("size_bytes", "downloaded_at").alias("size_bytes"), F.max_by("sha256", "downloaded_at").alias("sha256"))
    snapshots_ = lists.select("project", "snapshot_identifier", "date_modified").distinct()
    by_project = Window.partitionBy("project").orderBy("date_modified", "snapshot_identifier")
    # a handful of locks per project
    pairs = snapshots_.select("project", "snapshot_identifier", F.lead("snapshot_identifier").over(by_project).alias("later"), F.lag("snapshot_identifier").over(by_project).alias("earlier"))
    named = lists.join(pairs, ["project", "snapshot_identifier"])
    previous = named.filter("later is not null").select(F.col("later").alias("snapshot_identifier"), "chunk_key", "size_bytes", "sha256")
    return previous, named.filter("earlier is not null").select("snapshot_identifier", "chunk_key", "size_bytes", "sha256")


_DIFF = f"""{_CHUNKS}, a AS (SELECT o.later AS snapshot_identifier, f.chunk_key, f.size_bytes, f.sha256 FROM f JOIN o USING (project, snapshot_identifier) WHERE o.later IS NOT NULL), b AS (SELECT f.* FROM f WHERE snapshot_identifier IN (SELECT later FROM o)),
d AS (SELECT coalesce(a.snapshot_identifier, b.snapshot_identifier) AS snapshot_identifier, coalesce(a.chunk_key, b.chunk_key) AS chunk_key, CASE WHEN a.chunk_key IS NULL THEN 'added' WHEN b.chunk_key IS NULL THEN 'removed' WHEN a.sha256 <> b.sha256 THEN 'changed' ELSE 'unchanged' END AS change,
coalesce(b.size_bytes, 0) - coalesce(a.size_bytes, 0) AS size_delta FROM a FULL JOIN b ON a.chunk_key = b.chunk_key AND a.snapshot_identifier = b.snapshot_identifier)"""


def _diff(spark, d) -> DataFrame:
    return compare.chunk_diff(*_chunk_lists(spark, d), within=["snapshot_identifier"])


@query(f"WITH {_DIFF} SELECT * FROM d")
def j11_chunk_diff(spark, d):
    return _diff(spark, d)


@query(f"WITH {_DIFF} SELECT snapshot_identifier, count(*) FILTER (WHERE change = 'added') AS added, count(*) FILTER (WHERE change = 'removed') AS removed, count(*) FILTER (WHERE change = 'changed') AS changed, count(*) FILTER (WHERE change = 'unchanged') AS unchanged, coalesce(sum(size_delta), 0)::BIGINT AS size_delta FROM d GROUP BY 1")
def a09_diff_summary(spark, d):
    return compare.diff_summary(_diff(spark, d), within=["snapshot_identifier"])


@query("SELECT project, arg_max(snapshot_identifier, (date_modified, snapshot_version)) AS snapshot_identifier, max(date_modified) AS date_modified FROM source_locks GROUP BY 1")
def k07_latest_snapshots(spark, d):
    return compare.latest_snapshot(table(spark, d, "source_locks"))


@query(f"SELECT snapshot_identifier, f.relative_path AS relative_path, f.chunk_identifier AS chunk_identifier, f.size_bytes AS size_bytes, f.sha256 AS sha256 FROM ({_FILES})")
def s18_lock_files(spark, d):
    return compare.lock_files(table(spark, d, "source_locks")).select("snapshot_identifier", "relative_path", "chunk_identifier", "size_bytes", "sha256")


_ISSUES = """SELECT 'EMPTY_TAG' AS code, tag, '' AS detail FROM entries WHERE coalesce(tag, '') = ''
UNION ALL SELECT 'EMPTY_TITLE', tag, '' FROM entries WHERE coalesce(tag, '') <> '' AND coalesce(title, '') = ''
UNION ALL SELECT 'DUPLICATE_TAG', tag, '' FROM (SELECT tag, unnest(range(2, n + 1)) FROM (SELECT tag, count(*) AS n FROM entries WHERE coalesce(tag, '') <> '' GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'UNKNOWN_TARGET', tag, t FROM (SELECT tag, unnest(internal_targets) AS t FROM entries) WHERE t IS NULL OR t NOT IN (SELECT tag FROM entries WHERE coalesce(tag, '') <> '')"""


@query(_ISSUES)
def v02_entry_issues(spark, d):
    return verify.entry_issues(table(spark, d, "entries"), targets="internal_targets")


@query(f"SELECT code, count(*) AS n FROM ({_ISSUES}) GROUP BY 1")
def j09_issue_counts(spark, d):
    return v02_entry_issues(spark, d).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT identifier, version.identifier AS version, count(*) AS n FROM edge_case_articles GROUP BY 1, 2 HAVING count(*) > 1")
def v01_duplicate_keys(spark, d):
    return verify.duplicate_keys(table(spark, d, "edge_case_articles").select("identifier", F.col("version.identifier").alias("version")), ["identifier", "version"])


@query("SELECT page_id, count(*) AS n FROM ingest_duplicates WHERE page_id IS NOT NULL AND page_id NOT IN (SELECT page_id FROM article_states WHERE page_id IS NOT NULL) GROUP BY 1")
def v01_missing_parents(spark, d):
    return verify.missing_parents(table(spark, d, "ingest_duplicates"), "page_id", table(spark, d, "article_states"), "page_id")


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1")
def v01_lineitem_orphans(spark, d):
    return verify.missing_parents(table(spark, d, "lineitem"), "l_orderkey", table(spark, d, "orders"), "o_orderkey")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in ("normal_articles", "edge_case_articles", "aliases", "links", "entries", "documents")))
def a02_table_counts(spark, d):
    return verify.table_counts({t: table(spark, d, t) for t in ("normal_articles", "edge_case_articles", "aliases", "links", "entries", "documents")})


@query("SELECT source_url, min(media_id) AS media_id, count(*) AS uses FROM (SELECT identifier AS page_id, coalesce(nullif(image.content_url, ''), nullif(image.url, '')) AS source_url, sha256(coalesce(nullif(image.content_url, ''), nullif(image.url, ''))) AS media_id FROM normal_articles) WHERE source_url IS NOT NULL AND page_id IN (SELECT page_id FROM article_states WHERE ingest_status <> 'rejected') GROUP BY 1")
def j06_media_plan(spark, d):
    from lexforge.operators import media

    pictures = ingest.main_image(table(spark, d, "normal_articles")).select(F.col("identifier").alias("page_id"), F.col("content_url").alias("source_url"), F.sha2("content_url", 256).alias("media_id"))
    return media.plan(pictures, table(spark, d, "article_states").select("page_id", F.col("ingest_status").alias("normalize_status")))


@query("SELECT page_id, title, text FROM documents QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1 OR text IS NULL")
def d05_first_by_content(spark, d):
    from lexforge.operators import media

    return media.first_by_content(table(spark, d, "documents").withColumn("h", F.sha2("text", 256)), content_hash="h", order=["doc_id"]).select("page_id", "title", "text")


@query("SELECT tag, title FROM entries WHERE tag NOT IN (SELECT 'p' || page_id::VARCHAR FROM article_states WHERE page_id IS NOT NULL) AND tag IS NOT NULL")
def z05_pending_entries(spark, d):
    done = table(spark, d, "article_states").select(strings.entry_tag(F.col("page_id")).alias("tag"))
    return verify.unverified(done, table(spark, d, "entries").select("tag", "title").filter("tag is not null"), "tag")


_STRATA = rf"""{LATEST_SQL}, c AS (SELECT page_id, title, coalesce(html, '') AS body, list_transform(coalesce(categories, []), lambda x: x.name) AS cats, coalesce(nullif(image.content_url, ''), nullif(image.url, '')) IS NOT NULL AS img FROM pages),
s AS (SELECT page_id, list_filter([CASE WHEN strlen(body) >= 100000 THEN 'long_article' END, CASE WHEN len(regexp_extract_all(body, '(?i)<table\b')) >= 3 THEN 'table_heavy' END, CASE WHEN img THEN 'image_heavy' END,
  CASE WHEN regexp_matches(body, '(?i)<math\b') THEN 'math_heavy' END, CASE WHEN len(list_filter(cats, lambda x: contains(x, '曖昧さ回避'))) > 0 THEN 'disambiguation' END, CASE WHEN regexp_matches(title, '(?i)の一覧$|^List of ') THEN 'list_article' END,
  CASE WHEN len(list_filter(cats, lambda x: regexp_matches(x, '歴史|文学'))) > 0 THEN 'history_or_literature' END, CASE WHEN len(list_filter(cats, lambda x: regexp_matches(x, '技術|工学|コンピュータ|情報科学'))) > 0 THEN 'technical' END,
  CASE WHEN regexp_matches(coalesce(title, '') || body, '[\x{{3400}}-\x{{4DBF}}\x{{20000}}-\x{{10FFFF}}\p{{Co}}]') THEN 'rare_unicode' END], lambda x: x IS NOT NULL) AS f FROM c),
strata AS (SELECT page_id, CASE WHEN len(f) = 0 THEN ['baseline'] ELSE f END AS strata FROM s)"""


def _signals(spark, d) -> DataFrame:
    p = page_bodies(spark, d)
    picture = F.coalesce(F.nullif(F.col("image.content_url"), F.lit("")), F.nullif(F.col("image.url"), F.lit("")))
    return p.select("page_id", sampling.strata(title=F.col("title"), html=F.col("html"), categories=F.transform("categories", lambda c: c["name"]), has_image=picture.isNotNull()).alias("strata"))


@query(f"WITH {_STRATA} SELECT * FROM strata")
def x19_strata(spark, d):
    return _signals(spark, d)


_SPECIAL = ("long_article", "table_heavy", "image_heavy", "math_heavy", "disambiguation", "list_article", "history_or_literature", "technical", "rare_unicode")
_HAS = "list_transform([" + ", ".join(f"'{x}'" for x in _SPECIAL) + "], lambda x: list_contains(n.strata, x)::INT)"
# the greedy choice, one page after the other: counts by stratum, pages taken, whether this one is
_SAMPLE = f"""{_STRATA.replace("base AS MATERIALIZED", "base AS MATERIALIZED", 1)}, n AS MATERIALIZED (SELECT page_id, strata, row_number() OVER (ORDER BY page_id) AS i FROM strata),
walk AS (
  SELECT 0::BIGINT AS i, NULL::BIGINT AS page_id, list_transform(range(9), lambda x: 0) AS counts, 0 AS total, false AS chosen
  UNION ALL
  SELECT n.i, n.page_id, CASE WHEN t.take THEN list_transform(range(1, 10), lambda k: w.counts[k] + t.has[k]) ELSE w.counts END, w.total + t.take::INT, t.take
  FROM walk w JOIN n ON n.i = w.i + 1, LATERAL (SELECT {_HAS} AS has) h, LATERAL (SELECT h.has AS has, w.total < 100 AND len(list_filter(range(1, 10), lambda k: h.has[k] = 1 AND w.counts[k] < 10)) > 0 AS take) t),
rest AS (SELECT page_id, row_number() OVER (ORDER BY page_id) AS no FROM strata WHERE strata = ['baseline']),
sample AS (SELECT page_id FROM walk WHERE chosen UNION ALL SELECT page_id FROM rest WHERE no <= 100 - (SELECT max(total) FROM walk))"""


def _sample(spark, d, signals: DataFrame) -> DataFrame:
    return sampling.stratified(signals.withColumn("at", F.col("page_id")), key="page_id", arrival="at", total=100, per_stratum=10)


@query(f"WITH RECURSIVE {_SAMPLE} SELECT page_id FROM sample")
def m01_stratified_sample(spark, d):
    return _sample(spark, d, _signals(spark, d))


@query(f"WITH RECURSIVE {_SAMPLE}, e AS (SELECT unnest(strata) AS stratum, page_id IN (SELECT page_id FROM sample) AS sel FROM strata) SELECT stratum, count(*) AS found, count(*) FILTER (WHERE sel) AS selected FROM e GROUP BY 1")
def a08_stratum_counts(spark, d):
    signals = materialize(_signals(spark, d), "signals")  # the sample and the counts read them
    return sampling.stratum_counts(signals, _sample(spark, d, signals), key="page_id")


@query(f"WITH RECURSIVE {_SAMPLE} SELECT pages.page_id, title, url FROM pages JOIN sample USING (page_id)")
def m02_extracted_sample(spark, d):
    signals = materialize(_signals(spark, d), "signals")
    return sampling.extract(pages(spark, d), _sample(spark, d, signals), key="page_id").select("page_id", "title", "url")


@query("WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, greatest(1, count(*) OVER () // 64) AS stride FROM documents) SELECT doc_id FROM n WHERE i % stride = 0 AND i // stride < 64")
def w01_systematic_sample(spark, d):
    return sampling.systematic(table(spark, d, "documents"), key="doc_id", size=64)


_HITS = """r AS (SELECT source_page_id AS query_key, list(title ORDER BY ordinal, title) AS headings FROM (SELECT DISTINCT source_page_id, ordinal, title FROM links WHERE title IS NOT NULL AND source_page_id IS NOT NULL AND ordinal IS NOT NULL) GROUP BY 1),
c AS (SELECT source_page_id AS query_key, list(title ORDER BY ordinal, title) AS headings FROM (SELECT DISTINCT source_page_id, ordinal, title FROM links WHERE title IS NOT NULL AND source_page_id IS NOT NULL AND ordinal IS NOT NULL AND resolution = 'resolved') GROUP BY 1),
j AS (SELECT r.query_key, r.query_key % 10 <> 0 AS expected_presence, c.query_key IS NULL AS candidate_missing, r.headings AS a, coalesce(c.headings, []) AS b FROM r LEFT JOIN c USING (query_key)),
q AS (SELECT query_key, expected_presence, candidate_missing, len(b) > 0 AS candidate_present, (len(b) > 0) = expected_presence AS matches, len(list_intersect(list_distinct(a), list_distinct(b)))::DOUBLE / len(list_distinct(a)) AS overlap_at_n,
  len(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] = b[i]))::DOUBLE / len(a) AS rank_agreement_at_n FROM j)"""


def _hits(spark, d) -> DataFrame:
    rows = table(spark, d, "links").filter("title is not null and source_page_id is not null and ordinal is not null")
    pack = lambda df: df.select(F.col("source_page_id").alias("query_key"), "ordinal", "title").distinct().groupBy("query_key").agg(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "title"))), lambda x: x["title"]).alias("headings"))
    reference = pack(rows).withColumn("expected_presence", F.col("query_key") % 10 != 0)
    return compare.compare_hits(reference, pack(rows.filter("resolution = 'resolved'")))


@query(f"WITH {_HITS} SELECT * FROM q")
def j10_compared_hits(spark, d):
    return _hits(spark, d)


@query(f"""WITH {_HITS}, s AS (SELECT count(*) AS total, avg(matches::INT) AS target_coverage, count(*) FILTER (WHERE NOT expected_presence AND candidate_present) AS false_positives, avg(overlap_at_n) AS overlap_mean, avg(rank_agreement_at_n) AS rank_agreement_mean, count(*) FILTER (WHERE candidate_missing) AS missing FROM q)
SELECT *, target_coverage >= 0.95 AND false_positives <= 0 AND missing = 0 AS passed FROM s""")
def a07_evaluated_summary(spark, d):
    return compare.evaluate(compare.compare_summary(_hits(spark, d)))


@query()
def q09_compatibility_report(spark, d):
    return compare.compatibility_report(a07_evaluated_summary(spark, d), reference="links", candidate="resolved links")
