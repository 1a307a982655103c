"""Queries on functions, sinks and control tables that the other query modules do not reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions import strings, urls
from lexforge.operators import compare, html, media, render, search, wikitext
from lexforge.plans.corpus import INSTANT
from lexforge.plans.records_queries import LATEST_SQL, page_bodies, pages
from lexforge.plans.search_queries import _RUN, _SEARCH, _model, _run, _word_terms
from lexforge.plans.sqltext import FOLDING, sql_key, sql_strip
from lexforge.session import materialize, shared_folder, table
from lexforge.sources import records

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


# Terms out of lists

_HEADINGS = r"(?m)^(?:■|={2,6}|#{1,6})[ \t]+([^\n=]+)"
_VALUES = r"([^|:\n]+):[0-9]"
_BOLD = r"(?i)<b>([^<]*)</b>"


def _listed(source: str, kind: str, priority: int, origin: str) -> str:
    """SQL of search.list_terms for a table e(page_id, l)."""
    return f"""{FOLDING}, {source}, x AS (SELECT page_id, unnest(range(len(l))) AS pos, unnest(l) AS key FROM e), k AS (SELECT page_id, pos, key, {sql_key('key')} AS normalized_key FROM x WHERE key <> ''),
listed AS (SELECT page_id, key, normalized_key, '{kind}' AS kind, {priority} AS priority, '{origin}' AS source FROM k WHERE normalized_key <> '' QUALIFY row_number() OVER (PARTITION BY page_id, normalized_key ORDER BY pos) = 1)"""


def _of_documents(spark, d, pattern: str, name: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("page_id"), F.regexp_extract_all("text", F.lit(pattern), F.lit(1)).alias(name))


_T03 = _listed(f"e AS (SELECT doc_id AS page_id, regexp_extract_all(text, '{_HEADINGS}', 1) AS l FROM documents)", "keyword", 400, "heading")


@query(f"WITH {_T03} SELECT * FROM listed")
def t03_heading_terms(spark, d):
    return search.heading_terms(_of_documents(spark, d, _HEADINGS, "headings"))


@query(f"WITH {_listed(f"e AS (SELECT doc_id AS page_id, regexp_extract_all(text, '{_VALUES}', 1) AS l FROM documents)", 'keyword', 300, 'infobox')} SELECT * FROM listed")
def t04_infobox_terms(spark, d):
    return search.infobox_terms(_of_documents(spark, d, _VALUES, "infobox_values"))


_LEADS = LATEST_SQL.partition("base AS")[2]


@query(f"WITH {_listed(f"base AS{_LEADS}, e AS (SELECT page_id, regexp_extract_all(html, '{_BOLD}', 1) AS l FROM pages)", 'alias', 200, 'lead')}, own AS (SELECT page_id, {sql_key('title')} AS own FROM pages) SELECT listed.* FROM listed JOIN own USING (page_id) WHERE own IS NULL OR own <> normalized_key")
def t05_lead_terms(spark, d):
    found = page_bodies(spark, d).select("page_id", "title", F.regexp_extract_all("html", F.lit(_BOLD), F.lit(1)).alias("lead_bold"))
    return search.lead_terms(found)


_WORDS = ("later years", "overview")


@query(f"WITH {_T03} SELECT page_id FROM listed WHERE normalized_key IN {_WORDS} GROUP BY 1 HAVING count(DISTINCT normalized_key) = 2")
def q04_keyword_search(spark, d):
    return search.keyword_search(t03_heading_terms(spark, d), list(_WORDS))


_PATTERNS = {"Old *": "word", "*Ridge": "endword", "@Canal": "cross", "Old Canal": "exact"}
_Q06 = " UNION ALL ".join(
    f"SELECT DISTINCT '{p}' AS pattern, page_id FROM st WHERE " + {"word": "kind NOT IN ('keyword', 'cross_component') AND starts_with(normalized_key, 'old')", "endword": "kind NOT IN ('keyword', 'cross_component') AND ends_with(normalized_key, 'ridge')", "cross": "kind IN ('keyword', 'cross_component') AND normalized_key = 'canal'", "exact": "kind NOT IN ('keyword', 'cross_component') AND normalized_key = 'old canal'"}[m]
    for p, m in _PATTERNS.items()
)


@query(f"WITH {_SEARCH} {_Q06}")
def q06_lookup_patterns(spark, d):
    terms = materialize(_word_terms(spark, d), "terms")
    found = [search.lookup(terms, p).select(F.lit(p).alias("pattern"), "page_id") for p in _PATTERNS]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


# Text and address functions


@query(f"SELECT doc_id, regexp_replace(text, '^[ \\t\\n\\r\\f\\v\\x{{3000}}\\x{{A0}}]+|[ \\t\\n\\r\\f\\v\\x{{3000}}\\x{{A0}}]+$', '', 'g') AS text FROM documents")
def x09_stripped_texts(spark, d):
    return table(spark, d, "documents").select("doc_id", strings.strip_keeping_markers(F.col("text")).alias("text"))


_UNIT = "CASE WHEN {s} < 1024 THEN 0 WHEN {s} < 1048576 THEN 1 WHEN {s} < 1073741824 THEN 2 ELSE 3 END"


@query(f"WITH f AS (SELECT snapshot_identifier, downloaded_at, unnest(files) AS f FROM source_locks), s AS (SELECT snapshot_identifier, f.chunk_identifier AS chunk_identifier, f.size_bytes AS size, {_UNIT.format(s='f.size_bytes')} AS u FROM f) SELECT snapshot_identifier, chunk_identifier, format('{{:,.1f}}', size / pow(1024.0, u)) || [' B', ' KiB', ' MiB', ' GiB'][u + 1] AS shown FROM s")
def x26_human_sizes(spark, d):
    return compare.lock_files(table(spark, d, "source_locks")).select("snapshot_identifier", "chunk_identifier", strings.human_size(F.col("size_bytes")).alias("shown"))


_LABELLED = r"\[((?:https?:)?//[^\s\]]+)[ ]+([^\]\n]*)\]"


@query(rf"""WITH w AS (SELECT source_sequence, article_body.wikitext AS t FROM edge_case_articles), l AS (SELECT source_sequence, regexp_extract_all(t, '{_LABELLED}', 1) AS us, regexp_extract_all(t, '{_LABELLED}', 2) AS ls FROM w),
e AS (SELECT source_sequence, unnest(range(len(us))) AS ordinal, unnest(us) AS url, unnest(ls) AS label FROM l)
SELECT source_sequence, ordinal, CASE WHEN regexp_matches(url, '(?i)^(https?:)?//[^/?#\s]+') AND label <> url THEN label || ' (' || url || ')' ELSE label END AS label FROM e""")
def f09_external_labels(spark, d):
    found = table(spark, d, "edge_case_articles").select("source_sequence", F.col("article_body.wikitext").alias("t"))
    pairs = F.arrays_zip(F.regexp_extract_all("t", F.lit(_LABELLED), F.lit(1)).alias("url"), F.regexp_extract_all("t", F.lit(_LABELLED), F.lit(2)).alias("label"))
    each = found.select("source_sequence", F.posexplode(pairs).alias("ordinal", "p"))
    return each.select("source_sequence", "ordinal", urls.external_label(F.col("p.label"), F.col("p.url")).alias("label"))


@query(f"""WITH {LATEST_SQL}, u AS (SELECT page_id, url, regexp_extract(url, '^(https?://[^/]+)', 1) AS base FROM pages), p AS (SELECT page_id, CASE WHEN base <> '' AND starts_with(url, base || '/wiki/') THEN regexp_replace(url[length(base) + 7:], '\\?.*$', '') END AS p FROM u),
t AS (SELECT page_id, {sql_strip("replace(url_decode(replace(split_part(p, '#', 1), '+', '%2B')), '_', ' ')")} AS whole FROM p), z AS (SELECT *, contains(whole, ':') AND split_part(whole, ':', 1) IN ({", ".join("'" + x + "'" for x in urls.NAMESPACES)}) AND regexp_replace(whole, '^[^:]*:', '') <> '' AS spaced FROM t)
SELECT page_id, CASE WHEN whole = '' THEN NULL WHEN spaced THEN regexp_replace(whole, '^[^:]*:', '') ELSE whole END AS title FROM z""")
def j02_project_links(spark, d):
    from lexforge.operators import links

    return pages(spark, d).select("page_id", links.project_link(F.col("url"), F.col("url"))["title"].alias("title"))


@query(f"WITH {LATEST_SQL}, e AS (SELECT page_id, unnest(license).identifier AS identifier FROM pages) SELECT page_id, count(*) FILTER (WHERE identifier IS NOT NULL) AS licensed, count(*) AS n FROM e GROUP BY 1")
def f10_licensed_media(spark, d):
    each = pages(spark, d).select("page_id", F.explode("license").alias("l"))
    return each.groupBy("page_id").agg(F.count_if(media.is_licensed(F.col("l.identifier"))).alias("licensed"), F.count(F.lit(1)).alias("n"))


_MARKED = "list_filter(coalesce(internal_targets, []), lambda x: regexp_full_match(x, 'p[0-9]+'))"


@query(f"SELECT tag, page_id, rendered_at, list_filter({_MARKED}, lambda x, i: list_position({_MARKED}, x) = i) AS targets, CASE WHEN title IS NOT NULL AND page_id IS NOT NULL THEN ['g-' || page_id] ELSE [] END AS graphics FROM entries WHERE internal_targets IS NOT NULL")
def proj11_rendered_targets(spark, d):
    marks = F.transform(F.filter("internal_targets", lambda t: t.isNotNull()), lambda t: F.concat(F.lit("\x1eR:"), t, F.lit("\x1flabel\x1eE\x1f")))
    graphic = F.when(F.col("title").isNotNull() & F.col("page_id").isNotNull(), F.concat(F.lit("\x1eG:g-"), F.col("page_id").cast("string"), F.lit("\x1f"))).otherwise("")
    rows = table(spark, d, "entries").filter("internal_targets is not null").withColumn("marked", F.concat(F.array_join(marks, " "), graphic, graphic))
    return rows.select("tag", "page_id", "rendered_at", render.link_targets(F.col("marked")).alias("targets"), render.graphic_names(F.col("marked")).alias("graphics"))


_LEVELS = r"(?m)^(={2,6}|#{1,6}) "


@query(f"""WITH l AS (SELECT doc_id, list_transform(regexp_extract_all(text, '{_LEVELS}', 1), lambda x: length(x)) AS l FROM documents WHERE text IS NOT NULL), e AS (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM l),
p AS (SELECT doc_id, i, l, unnest(range(1, l[i] + 1)) AS v FROM e), s AS (SELECT doc_id, i, l, v, coalesce(list_max(list_filter(range(1, i + 1), lambda k: l[k] < v)), 0) AS since FROM p),
n AS (SELECT doc_id, i, v, len(list_filter(range(since + 1, i + 1), lambda k: l[k] = v)) AS n FROM s) SELECT doc_id, (i - 1)::INT AS ordinal, string_agg(n::VARCHAR, '.' ORDER BY v) AS number FROM n WHERE n > 0 GROUP BY 1, 2""")
def w06_section_numbers(spark, d):
    levels = F.transform(F.regexp_extract_all("text", F.lit(_LEVELS), F.lit(1)), lambda x: F.length(x))
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.posexplode(render.numbered(levels)).alias("ordinal", "number"))


# Fetch bookkeeping

_PLANNED = "pl AS (SELECT DISTINCT coalesce(nullif(image.content_url, ''), nullif(image.url, '')) AS source_url FROM normal_articles WHERE coalesce(nullif(image.content_url, ''), nullif(image.url, '')) IS NOT NULL)"
_OUTCOMES = "oc AS (SELECT coalesce(nullif(image.content_url, ''), nullif(image.url, '')) AS source_url, CASE WHEN version.identifier IS NULL OR length(name) % 2 = 1 THEN 'failed' ELSE 'ok' END AS status, sha256(name) AS content_sha256, printf('%s/%020d', snapshot_identifier, identifier) AS seen FROM normal_articles WHERE name IS NOT NULL AND identifier IS NOT NULL)"


def _fetches(spark, d) -> tuple[DataFrame, DataFrame]:
    """Planned addresses, and outcomes made of the rows that name them: failed for rows without a version or with a name of odd length."""
    url = F.coalesce(F.nullif(F.col("image.content_url"), F.lit("")), F.nullif(F.col("image.url"), F.lit("")))
    rows = table(spark, d, "normal_articles").withColumn("source_url", url)
    made = rows.filter("name is not null and identifier is not null").select(
        "source_url", F.when(F.col("version.identifier").isNull() | (F.length("name") % 2 == 1), "failed").otherwise("ok").alias("status"), F.sha2("name", 256).alias("content_sha256"), F.concat("snapshot_identifier", F.lit("/"), F.lpad(F.col("identifier").cast("string"), 20, "0")).alias("at")
    )
    return rows.select("source_url").filter("source_url is not null").distinct(), made


@query(f"WITH {_PLANNED}, {_OUTCOMES} SELECT source_url FROM pl WHERE source_url NOT IN (SELECT source_url FROM oc WHERE status = 'ok' AND source_url IS NOT NULL)")
def j12_unfetched(spark, d):
    return media.unfetched(*_fetches(spark, d))


@query(f"WITH {_PLANNED}, {_OUTCOMES}, o AS (SELECT source_url, arg_max(status, seen) AS status FROM oc GROUP BY 1) SELECT pl.source_url, coalesce(o.status, 'pending') AS status FROM pl LEFT JOIN o USING (source_url)")
def s29_fetch_report(spark, d):
    return media.rebuild_report(*_fetches(spark, d)).select("source_url", "status")


# Sources and sinks


@query("""WITH s AS (SELECT identifier, snapshot_identifier, sha256(coalesce(article_body.html, '')) AS h FROM normal_articles), a AS (SELECT * FROM s WHERE snapshot_identifier = (SELECT min(snapshot_identifier) FROM s)), b AS (SELECT * FROM s WHERE snapshot_identifier = (SELECT max(snapshot_identifier) FROM s))
SELECT DISTINCT b.identifier FROM a JOIN b ON a.identifier = b.identifier WHERE a.h <> b.h""")
def l05_conflicting_pages(spark, d):
    rows = table(spark, d, "normal_articles").select("identifier", "snapshot_identifier", F.sha2(F.coalesce("article_body.html", F.lit("")), 256).alias("h"))
    ends = rows.agg(F.min("snapshot_identifier").alias("a"), F.max("snapshot_identifier").alias("b")).first()
    return wikitext.conflicting_pages(rows.filter(F.col("snapshot_identifier") == ends["a"]), rows.filter(F.col("snapshot_identifier") == ends["b"]), key="identifier", content_hash="h")


@query("SELECT tag, title, heading, aliases, keywords, body, internal_targets AS targets FROM entries")
def s10_written_entries(spark, d):
    """Entries through the JSON sink and back."""
    path = f"{shared_folder(spark).rstrip('/')}/entries-{uuid.uuid4().hex}"
    render.write_entries(table(spark, d, "entries").withColumnRenamed("internal_targets", "targets"), path)
    return spark.read.schema("tag string, title string, heading string, aliases array<string>, keywords array<string>, body string, targets array<string>").json(path)


_NAMED = "({f} IS NOT NULL AND len(list_filter({f}, lambda x: x IS NULL OR coalesce(x.name, '') = '')) > 0)"
_REASONS = f"""t AS (SELECT *, upper(trim(date_modified)) AS u FROM edge_case_articles), i AS (SELECT *, {INSTANT} AS instant FROM t),
r AS (SELECT source_sequence, identifier, version.identifier AS version, name, CASE WHEN identifier IS NULL THEN 'identifier' WHEN version.identifier IS NULL THEN 'version.identifier' WHEN coalesce(name, '') = '' THEN 'name' WHEN namespace.identifier IS NULL THEN 'namespace.identifier' WHEN coalesce(url, '') = '' THEN 'url'
  WHEN instant IS NULL THEN 'date_modified' WHEN article_body IS NULL THEN 'article_body' WHEN {_NAMED.format(f='redirects')} THEN 'redirects' WHEN {_NAMED.format(f='categories')} THEN 'categories' WHEN {_NAMED.format(f='templates')} THEN 'templates'
  WHEN license IS NOT NULL AND len(list_filter(license, lambda x: x IS NULL OR coalesce(x.identifier, '') = '' OR coalesce(x.name, '') = '' OR coalesce(x.url, '') = '')) > 0 THEN 'license' END AS reject_reason FROM i)"""


def _lines(spark, d) -> DataFrame:
    rows = table(spark, d, "edge_case_articles")
    return rows.select("source_sequence", F.to_json(F.struct(*[c for c in rows.columns if c not in ("chunk_identifier", "delivered_at")])).alias("value"))


@query(f"WITH {_REASONS} SELECT source_sequence, reject_reason FROM r")
def s03_parsed_records(spark, d):
    """Every record as a JSON line through the strict parser."""
    return records.parse_records(_lines(spark, d), "source_sequence").select("source_sequence", "reject_reason")


@query(f"WITH {_REASONS} SELECT identifier, version, name, reject_reason FROM r")
def s01_chunk_round_trip(spark, d):
    """Every record through tar.gz chunks: written, read again and parsed."""
    folder = f"{shared_folder(spark).rstrip('/')}/chunks-{uuid.uuid4().hex}"
    paths = records.write_chunks(_lines(spark, d).select("value"), folder, chunks=4)
    parsed = records.parse_records(records.read_chunks(spark, paths), "chunk_ordinal", "line_no")
    return parsed.select("identifier", F.col("version.identifier").alias("version"), "name", "reject_reason")


# Readings of the document model


# The tree of a body as a fold over its tags: the elements around, and what has been met so far.
_TOKENS = r"(?is)<!--.*?-->|<!\w[^>]*>|<script\b.*?</script\s*>|<style\b.*?</style\s*>|</?[a-z][^<>]*>"
_TAG = r"lower(regexp_extract(x, '^</?([A-Za-z][^\s/>]*)', 1))"
_ALONE = "('area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'param', 'source', 'track', 'wbr')"
_TREE = rf"""{LATEST_SQL}, tk AS (SELECT page_id, regexp_extract_all(html, '{_TOKENS}') AS l FROM pages WHERE html IS NOT NULL),
ev AS (SELECT page_id, list_transform(list_filter(l, lambda x: NOT starts_with(x, '<!')), lambda x: {{'tag': {_TAG}, 'raw': x, 'kind': CASE WHEN regexp_matches(x, '(?i)^<(script|style)') THEN 'both' WHEN starts_with(x, '</') THEN CASE WHEN {_TAG} IN {_ALONE} THEN 'none' ELSE 'end' END
    WHEN ends_with(x, '/>') OR {_TAG} IN {_ALONE} THEN 'alone' ELSE 'start' END, 'stack': []::VARCHAR[], 'made': []::VARCHAR[], 'lost': []::VARCHAR[]}}) AS l FROM tk),
fo AS (SELECT page_id, list_reduce(list_prepend({{'tag': '', 'raw': '', 'kind': '', 'stack': []::VARCHAR[], 'made': []::VARCHAR[], 'lost': []::VARCHAR[]}}, l), lambda a, x: {{'tag': '', 'raw': '', 'kind': '',
  'stack': CASE WHEN x.kind = 'start' THEN list_append(a.stack, x.tag) WHEN x.kind = 'end' AND list_contains(a.stack, x.tag) THEN a.stack[1:len(a.stack) - list_position(list_reverse(a.stack), x.tag)] ELSE a.stack END,
  'made': CASE WHEN x.kind IN ('start', 'alone', 'both') THEN list_append(a.made, array_to_string(a.stack, '/') || chr(31) || x.tag || chr(31) || CASE WHEN x.tag = 'a' THEN x.raw ELSE '' END) ELSE a.made END,
  'lost': CASE WHEN x.kind = 'end' AND NOT list_contains(a.stack, x.tag) THEN list_append(a.lost, 'DOM_UNMATCHED_END_TAG ' || x.tag) WHEN x.kind = 'end' THEN list_concat(a.lost, list_transform(list_reverse(a.stack)[1:list_position(list_reverse(a.stack), x.tag) - 1], lambda t: 'DOM_UNCLOSED_TAG ' || t)) ELSE a.lost END}}) AS f FROM ev),
tree AS (SELECT page_id, f.made AS made, list_concat(f.lost, list_transform(list_reverse(f.stack), lambda t: 'DOM_UNCLOSED_TAG ' || t)) AS lost FROM fo)"""


@query(f"WITH {_TREE}, e AS (SELECT page_id, unnest(made) AS m FROM tree) SELECT page_id, len(list_filter(string_split(split_part(m, chr(31), 1), '/'), lambda x: x <> ''))::INT AS depth, split_part(m, chr(31), 2) AS tag, count(*) AS n FROM e GROUP BY ALL")
def h01_tree_elements(spark, d):
    """Elements of each body's tree by depth and tag."""
    return html.tree_elements(page_bodies(spark, d), key=["page_id"], html="html").groupBy("page_id", "depth", "tag").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_TREE}, e AS (SELECT page_id, unnest(lost) AS m FROM tree) SELECT page_id, split_part(m, ' ', 1) AS code, split_part(m, ' ', 2) AS element, count(*) AS n FROM e GROUP BY ALL")
def h01_tree_problems(spark, d):
    """What was wrong in the nesting of each body's tags."""
    found = _model(spark, d).select("page_id", F.explode("problems").alias("p")).select("page_id", "p.code", "p.element").filter("code in ('DOM_UNCLOSED_TAG', 'DOM_UNMATCHED_END_TAG')")
    return found.groupBy("page_id", "code", "element").agg(F.count(F.lit(1)).alias("n"))


# Where blocks stand, and what is no block of text there: headings keep their text only, other containers are not read.
_OUTER = "('html', 'body', 'section', 'blockquote', 'dl', 'dd', 'table', 'thead', 'tbody', 'tr', 'td', 'th')"
_UNREAD = "('h1', 'h2', 'h3', 'h4', 'h5', 'h6', 'div', 'figure', 'article', 'aside', 'nav', 'header', 'footer', 'form', 'fieldset', 'pre')"


@query(rf"""WITH {_TREE}, m AS (SELECT page_id, unnest(range(len(made))) AS pos, unnest(made) AS m FROM tree), w AS (SELECT page_id, pos, list_filter(string_split(split_part(m, chr(31), 1), '/'), lambda x: x <> '') AS path, regexp_extract(split_part(m, chr(31), 3), '(?i)\shref="([^"]*)"', 1) AS href FROM m WHERE split_part(m, chr(31), 2) = 'a'),
v AS (SELECT *, list_filter(path, lambda x: x NOT IN {_OUTER})[1] AS inner_tag FROM w), e AS (SELECT page_id, pos, replace(replace(href, '&quot;', '"'), '&amp;', '&') AS u FROM v WHERE inner_tag IS NULL OR inner_tag NOT IN {_UNREAD}),
q AS (SELECT *, CASE WHEN starts_with(u, './') THEN u[3:] WHEN starts_with(u, '/wiki/') THEN u[7:] END AS p FROM e), r AS (SELECT *, split_part(p, '?', 1) AS p2 FROM q WHERE p IS NOT NULL),
t AS (SELECT *, {sql_strip("replace(url_decode(replace(split_part(p2, '#', 1), '+', '%2B')), '_', ' ')")} AS title0, CASE WHEN contains(p2, '#') THEN nullif(url_decode(regexp_extract(p2, '^[^#]*#(.*)$', 1)), '') END AS fragment FROM r)
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1)::INT AS ordinal, title0 AS title, fragment FROM t WHERE title0 <> ''""")
def proj06_model_links(spark, d):
    """Internal links of the document model, in document order; a heading keeps its text only."""
    each = _model(spark, d).select("page_id", F.posexplode("links").alias("ordinal", "l"))
    whole = F.when(F.col("l.namespace").isNotNull(), F.concat("l.namespace", F.lit(":"), "l.title")).otherwise(F.col("l.title"))
    return each.select("page_id", "ordinal", whole.alias("title"), F.col("l.fragment").alias("fragment"))


_KINDS = "MAP {'h1': 'heading', 'h2': 'heading', 'h3': 'heading', 'h4': 'heading', 'h5': 'heading', 'h6': 'heading', 'ul': 'unordered_list', 'ol': 'ordered_list', 'dl': 'definition_list', 'table': 'table', 'pre': 'preformatted', 'blockquote': 'quote', 'hr': 'horizontal_rule'}"


@query(rf"""WITH {_TREE}, m AS (SELECT page_id, unnest(made) AS m FROM tree), w AS (SELECT page_id, list_filter(string_split(split_part(m, chr(31), 1), '/'), lambda x: x <> '') AS path, split_part(m, chr(31), 2) AS tag FROM m),
k AS (SELECT page_id, tag, array_to_string(list_filter(path, lambda x: x NOT IN {_OUTER}), '/') AS inner_path FROM w WHERE tag IN (SELECT unnest(map_keys({_KINDS}))))
SELECT page_id, element_at({_KINDS}, tag)[1] AS kind, count(*) AS n FROM k WHERE inner_path = '' OR (tag IN ('ul', 'ol') AND regexp_full_match(inner_path, '(?:[uo]l/li)(?:/[uo]l/li)*')) GROUP BY 1, 2""")
def h04_block_counts(spark, d):
    """Blocks of each page by kind, for the kinds that one tag makes."""
    each = _model(spark, d).select("page_id", F.explode("blocks").alias("b")).select("page_id", "b.kind")
    return each.filter(F.col("kind").isin("heading", "unordered_list", "ordered_list", "definition_list", "table", "preformatted", "quote", "horizontal_rule")).groupBy("page_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(r"WITH s AS (SELECT doc_id, regexp_extract_all(text, '[\x{FE00}-\x{FE0F}\x{E0100}-\x{E01EF}]') AS l FROM documents), e AS (SELECT doc_id, unnest(range(len(l)))::INT AS ordinal, unnest(l) AS c FROM s) SELECT doc_id, ordinal, printf('U+%04X', unicode(c)) AS code_point, 'TEXT_VARIATION_SELECTOR_REMOVED' AS code FROM e")
def x11_selector_diagnostics(spark, d):
    return strings.selector_diagnostics(table(spark, d, "documents"), "doc_id", "text")


@query(f"""WITH {_RUN}, bo AS (SELECT page_id, arg_max(body, (rendered_at, body)) AS body FROM entries WHERE body IS NOT NULL GROUP BY 1), hit AS (SELECT DISTINCT page_id FROM r WHERE rank = 1),
di AS (SELECT source_page_id AS page_id, list_sort(list(DISTINCT resolution)) AS codes FROM links WHERE resolution IS NOT NULL GROUP BY 1) SELECT bo.page_id, sha256(body) AS body_sha256, coalesce(codes, []) AS codes FROM bo JOIN hit USING (page_id) LEFT JOIN di USING (page_id)""")
def j07_sampled_diagnostics(spark, d):
    """Sampled entries with what is known of their pages' links."""
    bodies = table(spark, d, "entries").filter("body is not null").groupBy("page_id").agg(F.max_by("body", F.struct("rendered_at", "body")).alias("body"))
    notes = table(spark, d, "links").filter("resolution is not null").select(F.col("source_page_id").alias("page_id"), F.col("resolution").alias("code"))
    return search.sample_entries(_run(spark, d), bodies, diagnostics=notes).select("page_id", "body_sha256", "codes")


@query("""WITH u AS (SELECT identifier, coalesce(nullif(image.content_url, ''), nullif(image.url, '')) AS url, name FROM normal_articles), r AS (SELECT DISTINCT sha256(url) AS media_id, 'g-' || identifier AS name FROM u WHERE url IS NOT NULL AND identifier IS NOT NULL AND length(name) % 2 = 0)
SELECT media_id, min(name) AS name FROM r WHERE name IN (SELECT 'g-' || page_id FROM aliases) GROUP BY 1""")
def proj14_graphic_lookup(spark, d):
    """A conversion report made of the pages' pictures against a catalog of the pages that have aliases."""
    url = F.coalesce(F.nullif(F.col("image.content_url"), F.lit("")), F.nullif(F.col("image.url"), F.lit("")))
    report = table(spark, d, "normal_articles").select(F.sha2(url, 256).alias("media_id"), F.concat(F.lit("g-"), F.col("identifier").cast("string")).alias("name"), F.when(F.length("name") % 2 == 0, "ok").otherwise("failed").alias("status"))
    return render.graphic_lookup(report, table(spark, d, "aliases").select(F.concat(F.lit("g-"), F.col("page_id").cast("string")).alias("name")))
