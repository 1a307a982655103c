"""Queries on search terms, characters, text functions, the document model and the whole pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions import charset, strings, urls
from lexforge.operators import html, links, render, search, wikitext
from lexforge.plans import build
from lexforge.plans.records_queries import LATEST_SQL, page_bodies, pages
from lexforge.plans.sqltext import FOLDING, REPRESENTABLE, B, sql_class, sql_key, sql_strip, sql_title, sql_width
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


_HIRA = "".join(map(chr, range(0x3041, 0x3097)))
_KATA = "".join(map(chr, range(0x30A1, 0x30F7)))


def _spaceless(k: str) -> str:
    return f"nullif(regexp_replace({k}, '{B}', '', 'g'), {k})"


def _kana(k: str) -> str:
    return f"nullif(translate({k}, '{_HIRA + _KATA}', '{_KATA + _HIRA}'), {k})"


def _bare(k: str) -> str:
    return f"nullif(nullif(regexp_replace({k}, '\\p{{P}}', '', 'g'), {k}), '')"


_BASE = f"nullif({sql_strip(f"regexp_extract(title, '^(.+?){B}*[(（][^()（）]+[)）]$', 1)")}, '')"

#: Titles, bases and redirects with their keys, then terms and variants.
_TERMS = f"""{LATEST_SQL},
hop AS (SELECT DISTINCT page_id, title FROM aliases WHERE title IS NOT NULL AND page_id IS NOT NULL),
src AS (
  SELECT page_id, title AS key, {sql_key('title')} AS n, 'title' AS kind, 1000 AS priority, 'normalize' AS source FROM pages WHERE title IS NOT NULL
  UNION ALL SELECT page_id, b, {sql_key('b')}, 'alias', 800, 'parenthetical_base_title' FROM (SELECT page_id, {_BASE} AS b FROM pages) WHERE b IS NOT NULL
  UNION ALL SELECT page_id, title, {sql_key('title')}, 'redirect', 900, 'redirect' FROM hop),
terms AS (
  SELECT page_id, key, n AS normalized_key, kind, priority, source FROM src WHERE n IS NOT NULL AND n <> '' AND key <> ''
  UNION ALL SELECT page_id, v, v, 'alias', 800, 'nfkc_case_space_variant' FROM (SELECT page_id, {_spaceless('n')} AS v FROM src) WHERE v <> ''
  UNION ALL SELECT page_id, v, v, 'alias', 600, 'kana_variant' FROM (SELECT page_id, {_kana('n')} AS v FROM src) WHERE v <> ''
  UNION ALL SELECT page_id, v, v, 'alias', 800, 'punctuation_variant' FROM (SELECT page_id, {_bare('n')} AS v FROM src) WHERE v <> '')"""


def _hops(spark, d) -> DataFrame:
    return table(spark, d, "aliases").select("page_id", "title").filter("title is not null and page_id is not null").distinct()


def _terms(spark, d) -> DataFrame:
    return search.title_terms(pages(spark, d), _hops(spark, d))


@query(f"WITH {_TERMS} SELECT * FROM terms")
def t01_title_terms(spark, d):
    return _terms(spark, d)


@query(f"WITH {LATEST_SQL}, e AS (SELECT page_id, unnest(categories).name AS key FROM pages), k AS (SELECT page_id, key, {sql_key('key')} AS normalized_key FROM e WHERE key <> '') SELECT page_id, key, normalized_key, 'category' AS kind, 500 AS priority, 'category' AS source FROM k WHERE normalized_key <> ''")
def t02_category_terms(spark, d):
    p = pages(spark, d).select("page_id", F.transform("categories", lambda c: c["name"]).alias("categories"))
    return search.category_terms(p)


_CROSS = f"""{LATEST_SQL}, t AS (SELECT page_id, 0 AS o, title FROM pages WHERE title IS NOT NULL UNION ALL SELECT page_id, min(ordinal) + 1, title FROM aliases WHERE title IS NOT NULL AND page_id IS NOT NULL AND ordinal IS NOT NULL GROUP BY page_id, title),
w AS (SELECT page_id, o, title, regexp_split_to_array({sql_strip('title')}, '{B}+') AS ws FROM t), e AS (SELECT page_id, o, unnest(range(len(ws))) AS pos, unnest(ws) AS key FROM w WHERE len(ws) >= 2), k AS (SELECT *, {sql_key('key')} AS normalized_key FROM e),
f AS (SELECT page_id, normalized_key FROM k WHERE normalized_key <> '' GROUP BY 1, 2)"""


@query(f"WITH {_CROSS} SELECT page_id, normalized_key, 'cross_component' AS kind, 100 AS priority FROM f")
def t06_cross_terms(spark, d):
    titles = pages(spark, d).select("page_id", F.lit(0).alias("ordinal"), "title")
    hops = table(spark, d, "aliases").filter("title is not null and page_id is not null and ordinal is not null").groupBy("page_id", "title").agg((F.min("ordinal") + 1).alias("ordinal")).select("page_id", "ordinal", "title")
    return search.cross_terms(titles.unionByName(hops)).select("page_id", "normalized_key", "kind", "priority")


@query(f"WITH {_TERMS} SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY priority DESC, normalized_key, source, key) AS rank FROM terms")
def w02_ranked_terms(spark, d):
    return search.ranked(_terms(spark, d))


_BUDGET = f"""{_TERMS}, c AS (SELECT page_id, unnest(categories).name AS key FROM pages), k AS (SELECT DISTINCT page_id, key, {sql_key('key')} AS n FROM c WHERE key <> ''),
allt AS (SELECT * FROM terms UNION ALL SELECT page_id, key, n, 'keyword', 400, 'heading' FROM k WHERE n <> ''), fit AS (SELECT * FROM allt WHERE strlen(key) <= 255),
u AS (SELECT *, sum((kind = 'keyword')::INT) OVER (PARTITION BY page_id ORDER BY priority DESC, normalized_key, source, key ROWS UNBOUNDED PRECEDING) AS used FROM fit)"""


@query(f"WITH {_BUDGET} SELECT page_id, key, normalized_key, kind, priority, source FROM u WHERE kind <> 'keyword' OR used <= 64")
def t07_budgeted_terms(spark, d):
    each = pages(spark, d).select("page_id", F.explode("categories").alias("c")).select("page_id", F.col("c.name").alias("key")).filter("key != ''").distinct()
    keywords = each.select("page_id", "key", strings.index_key(F.col("key")).alias("normalized_key"), F.lit("keyword").alias("kind"), F.lit(400).alias("priority"), F.lit("heading").alias("source")).filter("normalized_key != ''")
    return search.budgeted(_terms(spark, d).unionByName(keywords), max_terms=64)


@query(f"""WITH {_TERMS}, o AS (SELECT page_id, key, min({{'p': -priority, 'n': normalized_key, 's': source, 'k': key}}) AS o FROM terms GROUP BY 1, 2), g AS (SELECT page_id, list(key ORDER BY o) AS ks FROM o GROUP BY 1)
SELECT p.page_id, list_concat([p.title], list_filter(coalesce(g.ks, []), lambda k: k IS DISTINCT FROM p.title)) AS headwords FROM pages p LEFT JOIN g USING (page_id)""")
def t08_headwords(spark, d):
    return search.headwords(_terms(spark, d), pages(spark, d))


@query(f"""WITH {_TERMS}, t AS (SELECT normalized_key, count(DISTINCT page_id) AS targets, arg_min({{'p': page_id, 's': source}}, {{'a': -priority, 'b': page_id, 'c': source}}) AS w FROM terms GROUP BY 1) SELECT normalized_key, targets, w.p AS winner, w.s AS winner_source FROM t WHERE targets > 1""")
def t09_collisions(spark, d):
    return search.collisions(_terms(spark, d))


@query(f"WITH {_TERMS} SELECT normalized_key, page_id, key, kind, priority, source FROM terms QUALIFY row_number() OVER (PARTITION BY normalized_key ORDER BY priority DESC, page_id, source, key, kind) = 1")
def t10_single_candidates(spark, d):
    return search.single_candidates(_terms(spark, d))


@query(f"""WITH {LATEST_SQL}, b AS (SELECT title AS headword, page_id, 0 AS o FROM pages WHERE title IS NOT NULL UNION SELECT title, page_id, 1 FROM aliases WHERE title IS NOT NULL),
g AS (SELECT headword, min({{'o': o, 'p': page_id}}) AS w, count(DISTINCT page_id) AS n FROM b GROUP BY 1) SELECT headword, w.p AS page_id, CASE WHEN w.o = 0 THEN 'title' ELSE 'alias' END AS origin, n - 1 AS conflicts FROM g""")
def t11_headword_index(spark, d):
    return search.headword_index(pages(spark, d), table(spark, d, "aliases"))


def _word_terms(spark, d) -> DataFrame:
    titles = pages(spark, d).select("page_id", F.lit(0).alias("ordinal"), "title")
    return _terms(spark, d).unionByName(search.cross_terms(titles))


_SEARCH = f"""{_TERMS}, x AS (SELECT page_id, regexp_split_to_array({sql_strip('title')}, '{B}+') AS ws FROM pages), xx AS (SELECT DISTINCT page_id, {sql_key('w')} AS n FROM (SELECT page_id, unnest(ws) AS w FROM x WHERE len(ws) >= 2)),
st AS (SELECT page_id, normalized_key, kind, priority FROM terms UNION ALL SELECT page_id, n, 'cross_component', 100 FROM xx WHERE n <> '')"""


@query(f"WITH {_SEARCH} SELECT DISTINCT page_id FROM st WHERE kind NOT IN ('keyword', 'cross_component') AND starts_with(normalized_key, 'old ')")
def q02_word_search(spark, d):
    return _word_terms(spark, d).filter(search.matches("word", F.col("normalized_key"), F.col("kind"), F.lit("old "))).select("page_id").distinct()


@query(f"WITH {_SEARCH} SELECT DISTINCT page_id FROM st WHERE kind NOT IN ('keyword', 'cross_component') AND ends_with(normalized_key, 'ridge')")
def q03_endword_search(spark, d):
    return search.lookup(_word_terms(spark, d), "*Ridge")


@query(f"WITH {_SEARCH} SELECT DISTINCT page_id FROM st WHERE kind = 'cross_component' AND normalized_key = 'canal'")
def q05_cross_search(spark, d):
    return search.lookup(_word_terms(spark, d), "@Canal")


@query(f"WITH {_SEARCH} SELECT DISTINCT page_id FROM st WHERE kind NOT IN ('keyword', 'cross_component') AND normalized_key IN (SELECT normalized_key FROM terms WHERE kind = 'title' ORDER BY normalized_key LIMIT 1)")
def q01_exact_search(spark, d):
    terms = _word_terms(spark, d)
    first = terms.filter("kind = 'title'").agg(F.min("normalized_key").alias("k")).first()["k"]
    return search.lookup(terms, first or "", key=lambda s: s)


#: A fixed query set: (key, normalized query, expected presence).
_SET = (("q1", "old ", True), ("q2", "new", True), ("q3", "ridge", True), ("q4", "湖", True), ("q5", "canal", True), ("q6", "の戦い", True), ("q7", "zzzz", False), ("q8", "g", True), ("q9", "(film)", True))
_SET_SQL = "(VALUES " + ", ".join(f"('{k}', '{q}', {e})" for k, q, e in _SET) + ") s(query_key, q, e)"
_RUN = f"""{_SEARCH}, qs AS (SELECT query_key, q, m AS mode, e FROM {_SET_SQL}, (VALUES ('word'), ('endword'), ('cross')) v(m)),
h AS (SELECT query_key, mode, page_id, normalized_key, priority FROM qs JOIN st ON (mode = 'word' AND kind NOT IN ('keyword', 'cross_component') AND starts_with(normalized_key, q)) OR (mode = 'endword' AND kind NOT IN ('keyword', 'cross_component') AND ends_with(normalized_key, q)) OR (mode = 'cross' AND kind = 'cross_component' AND normalized_key = q)),
b AS (SELECT query_key, mode, page_id, min({{'p': -priority, 'n': normalized_key}}) AS t FROM h GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY query_key, mode ORDER BY t.p, t.n, page_id) AS rank, count(*) OVER (PARTITION BY query_key, mode) > 50 AS truncated FROM b)"""


def _run(spark, d) -> DataFrame:
    terms = materialize(_word_terms(spark, d), "terms")  # searches read stored terms
    return search.run_queries(terms, search.query_frame(spark, list(_SET), ("word", "endword", "cross")), max_results=50)


@query(f"WITH {_RUN} SELECT query_key, mode, rank, page_id, truncated FROM r WHERE rank <= 50")
def q07_query_set(spark, d):
    return _run(spark, d).select("query_key", "mode", "rank", "page_id", "truncated")


@query(f"WITH {_RUN}, p AS (SELECT DISTINCT query_key, mode FROM r) SELECT qs.query_key, qs.mode, e AS expected_presence, p.mode IS NOT NULL AS present, 'REF_QUERY_EXPECTATION_MISMATCH' AS code FROM qs LEFT JOIN p ON p.query_key = qs.query_key AND p.mode = qs.mode WHERE (p.mode IS NOT NULL) <> e")
def f14_presence_mismatches(spark, d):
    return search.presence_mismatches(search.query_frame(spark, list(_SET), ("word", "endword", "cross")).select("query_key", "mode", "expected_presence"), _run(spark, d))


@query(f"""WITH {_RUN}, bo AS (SELECT page_id, arg_max(body, (rendered_at, body)) AS body FROM entries WHERE body IS NOT NULL GROUP BY 1), hit AS (SELECT DISTINCT page_id FROM r WHERE rank = 1)
SELECT page_id, substring(body, 1, 4096) AS excerpt, sha256(body) AS body_sha256, len(regexp_extract_all(body, chr(30) || 'R:')) AS links, len(regexp_extract_all(body, chr(30) || 'G:')) AS graphics, length(body) > 4096 AS truncated FROM bo JOIN hit USING (page_id)""")
def q08_sampled_entries(spark, d):
    bodies = table(spark, d, "entries").filter("body is not null").groupBy("page_id").agg(F.max_by("body", F.struct("rendered_at", "body")).alias("body"))
    return search.sample_entries(_run(spark, d), bodies)


# Characters


@query("SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> '' GROUP BY 1")
def a04_histogram(spark, d):
    return charset.histogram(table(spark, d, "documents"), "text")


_COUNTED = f"""{REPRESENTABLE}, h AS (SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> '' GROUP BY 1),
w AS (SELECT ch, n, {sql_class('ch', 'rep.c IS NOT NULL')} AS char_class, {sql_width('ch')} AS width_class FROM h LEFT JOIN rep ON rep.c = ch)"""
#: The code plan of a table of counted characters.
_PLAN = """r AS (SELECT *, row_number() OVER (PARTITION BY width_class ORDER BY n DESC, ch) <= {limit} AS kept FROM {source}),
plan AS (SELECT ch, n, width_class, CASE WHEN kept THEN width_class || '-' || lpad((row_number() OVER (PARTITION BY width_class, kept ORDER BY ch))::VARCHAR, 4, '0') END AS code FROM r)"""
_CODES = f"{_COUNTED}, {_PLAN.format(limit=charset.MAX_PER_WIDTH, source='(SELECT * FROM w WHERE ascii(ch) > 127)')}"
_RARE = f"{_COUNTED}, {_PLAN.format(limit=charset.MAX_PER_WIDTH, source="(SELECT * FROM w WHERE char_class = 'C')")}"


@query(f"WITH {_CODES} SELECT ch, n, width_class, code FROM plan")
def k03_code_plan(spark, d):
    counts = charset.classify(charset.histogram(table(spark, d, "documents"), "text").filter(F.ascii("ch") > 127)).drop("char_class")
    return charset.code_plan(counts)


@query(f"WITH {_RARE} SELECT ch, n, width_class, code FROM plan")
def k02_rare_plan(spark, d):
    rare = charset.classify(charset.histogram(table(spark, d, "documents"), "text")).filter("char_class = 'C'").drop("char_class")
    return charset.code_plan(rare)


@query(f"WITH {_CODES} SELECT width_class, count(code) AS kept, count(*) FILTER (WHERE code IS NULL) AS overflow_chars, coalesce(sum(n) FILTER (WHERE code IS NULL), 0)::BIGINT AS overflow_uses FROM plan GROUP BY 1")
def a10_overflow(spark, d):
    return charset.overflow(k03_code_plan(spark, d))


@query(f"""WITH {_COUNTED}, e AS (SELECT DISTINCT doc_id, ch FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents) WHERE ch IN (SELECT ch FROM w WHERE char_class <> 'A')),
f AS (SELECT ch, list(doc_id ORDER BY doc_id) AS ids FROM e GROUP BY 1) SELECT w.ch, w.n, f.ids[1:5] AS examples FROM w JOIN f USING (ch)""")
def a05_unrepresentable(spark, d):
    return charset.unrepresentable_examples(table(spark, d, "documents"), "doc_id", "text")


@query(f"WITH {_COUNTED} SELECT ch, n FROM w WHERE char_class <> 'A' QUALIFY row_number() OVER (ORDER BY n DESC, ch) <= 20")
def k08_most_frequent(spark, d):
    return charset.most_frequent(charset.unrepresentable_examples(table(spark, d, "documents"), "doc_id", "text"), 20).select("ch", "n")


@query(f"WITH {_COUNTED} SELECT ch, n, char_class, width_class FROM w")
def x13_character_classes(spark, d):
    return charset.classify(charset.histogram(table(spark, d, "documents"), "text"))


_EMBEDDED = """CASE WHEN {x} IS NOT NULL THEN coalesce((SELECT string_agg(CASE WHEN _r.c IS NOT NULL THEN _u._c ELSE {other} END, '' ORDER BY _u._i)
  FROM (SELECT unnest(string_split({x}, '')) AS _c, unnest(range(len(string_split({x}, '')))) AS _i) _u LEFT JOIN rep _r ON _r.c = _u._c{join} WHERE _u._c <> ''), '') END"""
_TEXT = _EMBEDDED.format(x="text", other="coalesce('[' || _p.code || ']', printf('[U+%04X]', unicode(_u._c)))", join=" LEFT JOIN plan _p ON _p.ch = _u._c")
_TITLE = _EMBEDDED.format(x="title", other="printf('[U+%04X]', unicode(_u._c))", join="")


@query(f"WITH {_RARE} SELECT doc_id, {_TEXT} AS text, {_TITLE} AS title FROM documents")
def x16_embedded_texts(spark, d):
    plan = k02_rare_plan(spark, d)
    return table(spark, d, "documents").select("doc_id", charset.embed(F.col("text"), plan).alias("text"), charset.title_fallback(F.col("title")).alias("title"))


@query(f"""WITH {REPRESENTABLE} SELECT alias_id, CASE WHEN title IS NOT NULL THEN coalesce((SELECT list(_u._c ORDER BY _u._i) FROM (SELECT unnest(string_split(title, '')) AS _c, unnest(range(len(string_split(title, '')))) AS _i) _u
  LEFT JOIN rep _r ON _r.c = _u._c WHERE _r.c IS NULL AND _u._c <> ''), []) END AS characters FROM aliases""")
def x18_unrepresentable(spark, d):
    return table(spark, d, "aliases").select("alias_id", charset.unrepresentable(F.col("title")).alias("characters"))


# Text functions


@query(f"WITH {FOLDING} SELECT alias_id, {sql_key('title')} AS index_key, {sql_title('title')} AS lookup_title FROM aliases")
def x01_index_keys(spark, d):
    return table(spark, d, "aliases").select("alias_id", strings.index_key(F.col("title")).alias("index_key"), strings.nfkc_title(F.col("title")).alias("lookup_title"))


@query(f"WITH {FOLDING}, k AS (SELECT alias_id, {sql_key('title')} AS k FROM aliases) SELECT alias_id, {_spaceless('k')} AS spaceless, {_kana('k')} AS kana, {_bare('k')} AS bare FROM k")
def x02_key_variants(spark, d):
    key = strings.index_key(F.col("title"))
    return table(spark, d, "aliases").select("alias_id", strings.without_spaces(key).alias("spaceless"), strings.kana_swapped(key).alias("kana"), strings.without_punctuation(key).alias("bare"))


@query(f"SELECT alias_id, {_BASE} AS base FROM aliases")
def x06_parenthetical_bases(spark, d):
    return table(spark, d, "aliases").select("alias_id", strings.parenthetical_base(F.col("title")).alias("base"))


_LEAD = r"regexp_replace(regexp_replace(regexp_replace(text, '(?ms)^```+[^\n]*\n.*?^```+[ \t]*$', '', 'g'), '(?ms)^~~~+[^\n]*\n.*?^~~~+[ \t]*$', '', 'g'), '(?s)\n[ \t]*\n(?:(?:#{1,6}|■)[ \t]+\S[^\n]*|={2,6}[ \t]*[^\s=][^\n]*=[ \t]*)(?:\n[ \t]*\n|\s*\z).*$', '')"
_NAME = sql_strip(f"regexp_replace(title, '{B}*[（(][^（）()]+[）)]$', '')")
# places of a name ``base`` in the lines of ``lead``, and the first part in brackets there that is all kana
_READ = f"""b AS (SELECT *, {_NAME} AS base FROM t), m AS (SELECT id, unnest(range(len(string_split(lead, chr(10))))) AS line, unnest(string_split(lead, chr(10))) AS p, base FROM b WHERE base <> ''),
f AS (SELECT id, line, regexp_extract_all(p, regexp_escape(base) || '[』」]?{B}*[（(]([^）)]{{1,128}})[）)]', 1) AS found FROM m), g AS (SELECT id, line, unnest(range(len(found))) AS no, unnest(found) AS x FROM f),
e AS (SELECT id, line, no, string_split_regex(regexp_replace(x, '\\[[0-9]+\\]', '', 'g'), '[、,，/／]') AS parts FROM g), k AS (SELECT id, line, no, unnest(range(len(parts))) AS part, unnest(parts) AS y FROM e),
r AS (SELECT id, arg_min(translate({sql_strip('y')}, '{_KATA}', '{_HIRA}'), (line, no, part)) AS reading FROM k WHERE regexp_full_match({sql_strip('y')}, '[ぁ-ゖァ-ヶー]+') GROUP BY 1)"""


@query(f"WITH t AS (SELECT doc_id AS id, title, {_LEAD} AS lead FROM documents), {_READ} SELECT doc_id, r.reading FROM documents LEFT JOIN r ON r.id = doc_id")
def x05_readings(spark, d):
    return table(spark, d, "documents").select("doc_id", strings.reading(F.col("title"), F.split(strings.lead_text(F.col("text")), "\n")).alias("reading"))


@query(f"""WITH t AS (SELECT alias_id AS id, title, 'x' || chr(10) || '『' || {_NAME} || '』（[1]' || title || '、' || coalesce(source, '') || '）は／' || title || ' (' || {_NAME} || ' / 12)' AS lead FROM aliases), {_READ}
SELECT alias_id, r.reading FROM aliases LEFT JOIN r ON r.id = alias_id""")
def x05_built_readings(spark, d):
    """Readings out of leads that are built from each title and its own text, so that kana titles have one."""
    name = strings.strip(F.regexp_replace("title", f"{strings.BLANK}*[（(][^（）()]+[）)]$", ""))
    second = F.concat(F.lit("『"), name, F.lit("』（[1]"), F.col("title"), F.lit("、"), F.coalesce("source", F.lit("")), F.lit("）は／"), F.col("title"), F.lit(" ("), name, F.lit(" / 12)"))
    return table(spark, d, "aliases").select("alias_id", strings.reading(F.col("title"), F.array(F.lit("x"), second)).alias("reading"))


_PLACE = r"regexp_extract(url, '^(?:https?://[^/]+/wiki/|/wiki/|\./)([^?]*)', 1)"
_SPACES = ", ".join("'" + x + "'" for x in urls.NAMESPACES)


@query(rf"""WITH u AS (SELECT DISTINCT url FROM normal_articles WHERE url IS NOT NULL UNION SELECT DISTINCT url FROM edge_case_articles WHERE url IS NOT NULL),
x AS (SELECT url, CASE WHEN regexp_matches(url, '^(?:https?://ja\.orbwiki\.example)?/wiki/|^\./') THEN {_PLACE} END AS p FROM u),
y AS (SELECT url, {sql_strip("replace(url_decode(replace(split_part(p, '#', 1), '+', '%2B')), '_', ' ')")} AS whole, CASE WHEN contains(p, '#') THEN nullif(url_decode(replace(regexp_extract(p, '^[^#]*#(.*)$', 1), '+', '%2B')), '') END AS fragment FROM x),
z AS (SELECT *, contains(whole, ':') AND split_part(whole, ':', 1) IN ({_SPACES}) AND regexp_replace(whole, '^[^:]*:', '') <> '' AS spaced FROM y)
SELECT url, CASE WHEN whole <> '' AND spaced THEN split_part(whole, ':', 1) END AS namespace, CASE WHEN whole = '' THEN NULL WHEN spaced THEN regexp_replace(whole, '^[^:]*:', '') ELSE whole END AS title, CASE WHEN whole <> '' THEN fragment END AS fragment FROM z""")
def x07_parsed_urls(spark, d):
    whole = table(spark, d, "normal_articles").select("url").unionByName(table(spark, d, "edge_case_articles").select("url")).filter("url is not null").distinct()
    parsed = urls.parse_internal(F.col("url"), ("https://ja.orbwiki.example", "http://ja.orbwiki.example"))
    return whole.select("url", parsed.alias("p")).select("url", "p.namespace", "p.title", "p.fragment")


@query(r"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[\x00-\x09\x0B-\x1F\x7F\x{80}-\x{9F}]', '', 'g'), '[\x{200B}\x{200C}\x{200D}\x{FEFF}]', '', 'g'), '[ \t\n\r\f\v]+', ' ', 'g') AS text FROM documents")
def h22_clean_whitespace(spark, d):
    return table(spark, d, "documents").select("doc_id", strings.normalize_whitespace(F.col("text")).alias("text"))


_SELECTORS = r"[\x{FE00}-\x{FE0F}\x{E0100}-\x{E01EF}]"


@query(f"SELECT doc_id, nfc_normalize(regexp_replace(translate(text, chr(160) || '‘’“”', ' ' || chr(39) || chr(39) || chr(34) || chr(34)), '{_SELECTORS}', '', 'g')) AS text, len(regexp_extract_all(text, '{_SELECTORS}')) AS selectors FROM documents")
def x10_safe_substitutions(spark, d):
    return table(spark, d, "documents").select("doc_id", strings.safe_substitutions(F.col("text")).alias("text"), F.size(strings.variation_selectors(F.col("text"))).alias("selectors"))


_NARROW = "".join(map(chr, range(0x21, 0x7F))).replace("'", "''")
_WIDE = "".join(chr(0xFEE0 + ord(x.upper())) for x in map(chr, range(0x21, 0x7F)))


@query(f"SELECT alias_id, nullif(translate(regexp_replace(title, '[ ''\\-・／＿‐−]', '', 'g'), '{_NARROW}', '{_WIDE}'), '') AS backend_key FROM aliases")
def x24_backend_keys(spark, d):
    return table(spark, d, "aliases").select("alias_id", strings.backend_key(F.col("title")).alias("backend_key"))


@query("SELECT alias_id, printf('[U+%04X]', unicode(title)) AS fallback FROM aliases WHERE title <> ''")
def x15_fallbacks(spark, d):
    return table(spark, d, "aliases").filter("title != ''").select("alias_id", strings.code_point_fallback(F.col("title")).alias("fallback"))


@query("SELECT doc_id, replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS escaped FROM documents")
def x26_escaped_titles(spark, d):
    return table(spark, d, "documents").select("doc_id", strings.html_escape(F.col("title")).alias("escaped"))


@query("SELECT doc_id, coalesce(strlen(text), 0) AS size FROM documents")
def proj12_estimated_sizes(spark, d):
    return table(spark, d, "documents").select("doc_id", F.coalesce(render.estimated_size(F.col("text")), F.lit(0)).alias("size"))


# Document model and pipeline


def _model(spark, d) -> DataFrame:
    return html.normalize_bodies(page_bodies(spark, d), key=["page_id"], html="html")


@query()
def h23_document_model(spark, d):
    return _model(spark, d).select("page_id", "status", "abstract", F.sha2("body_json", 256).alias("body_hash"), F.size("blocks").alias("blocks"), F.size("links").alias("links"), F.size("media").alias("media"), F.size("problems").alias("problems"))


@query()
def h04_blocks(spark, d):
    return _model(spark, d).select("page_id", F.explode("blocks").alias("b")).select("page_id", "b.*")


@query()
def h01_problem_counts(spark, d):
    return _model(spark, d).select(F.explode("problems").alias("p")).groupBy("p.code").agg(F.count(F.lit(1)).alias("n"))


@query()
def f07_selected_media(spark, d):
    return html.selected_media(_model(spark, d).select("page_id", F.posexplode("media").alias("ordinal", "m")).select("page_id", "ordinal", "m.*"))


@query(f"""WITH RECURSIVE {LATEST_SQL}, real AS (SELECT DISTINCT title FROM pages WHERE title IS NOT NULL), step AS (SELECT a.title, min(p.title) AS target FROM aliases a JOIN pages p USING (page_id) WHERE a.title IS NOT NULL AND p.title IS NOT NULL GROUP BY 1),
walk AS (SELECT title, target, 1 AS hops FROM step UNION ALL SELECT w.title, s.target, w.hops + 1 FROM walk w JOIN step s ON s.title = w.target WHERE w.hops <= (SELECT count(*) FROM step)),
ended AS (SELECT * FROM walk WHERE target NOT IN (SELECT title FROM step))
SELECT s.title, e.target, e.hops, CASE WHEN e.title IS NULL THEN 'cycle' WHEN e.target IN (SELECT title FROM real) THEN 'resolved' ELSE 'missing' END AS outcome FROM step s LEFT JOIN ended e USING (title)""")
def j13_redirect_chains(spark, d):
    """The target of a cycle is null: where in it the pointers have stopped tells nothing."""
    p = pages(spark, d).select("page_id", "title").filter("title is not null")
    hops = table(spark, d, "aliases").filter("title is not null").join(p.withColumnRenamed("title", "target"), "page_id").select("title", "target")
    chains = links.redirect_chains(p.select("title"), hops)
    return chains.withColumn("target", F.when(F.col("outcome") != "cycle", F.col("target")))


@query()
def l01_wikitext_blocks(spark, d):
    bodies = table(spark, d, "edge_case_articles").select("source_sequence", F.col("article_body.wikitext").alias("text"))
    return wikitext.read_bodies(bodies, key=["source_sequence"], wikitext="text").select("source_sequence", F.explode("blocks").alias("b")).select("source_sequence", "b.*")


@query(f"WITH {LATEST_SQL}, a AS (SELECT page_id, list_sort(list(DISTINCT title)) AS ts FROM aliases WHERE title IS NOT NULL GROUP BY 1) SELECT concat_ws(chr(9), regexp_replace(p.title, '[\\t\\n\\r]', ' ', 'g'), regexp_replace(coalesce(array_to_string(list_filter(a.ts, lambda x: x <> p.title), '|'), ''), '[\\t\\n\\r]', ' ', 'g')) AS record FROM pages p LEFT JOIN a USING (page_id) WHERE p.title IS NOT NULL")
def l06_title_records(spark, d):
    return wikitext.title_records(pages(spark, d), table(spark, d, "aliases"))


def _records(spark, d) -> DataFrame:
    rows = table(spark, d, "edge_case_articles")
    return rows.withColumn("source_hash", F.sha2(F.to_json(F.struct("name", "url", "date_modified", "article_body", "redirects", "categories")), 256))


@query()
def proj08_entries(spark, d):
    raw = build.stored(build.run_ingest(_records(spark, d), arrival=["source_sequence"], positions=True), arrival=["source_sequence"])
    made = build.run_generate(raw, build.run_normalize(raw))
    return made.entries


@query()
def proj13_entry_issues(spark, d):
    raw = build.stored(build.run_ingest(_records(spark, d), arrival=["source_sequence"], positions=True), arrival=["source_sequence"])
    return build.run_generate(raw, build.run_normalize(raw)).issues
