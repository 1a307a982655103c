"""Search terms: generation, ranking, budgets, collisions, headwords and lookup modes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexforge.functions.strings import BLANK, Key, index_key, kana_swapped, parenthetical_base, strip, without_punctuation, without_spaces

# Priorities, higher wins.
PRIORITY = {"title": 1000, "redirect": 900, "variant": 800, "kana": 600, "category": 500, "heading": 400, "infobox": 300, "lead": 200, "cross": 100}
#: Kinds that the per-article budget and the stop words apply to.
BUDGETED = ("keyword", "cross_component")

#: Variant generators: (key -> variant or null, priority, source). The one place meant to be extended.
VARIANTS: tuple[tuple[Callable[[Column], Column], int, str], ...] = (
    (without_spaces, PRIORITY["variant"], "nfkc_case_space_variant"),
    (kana_swapped, PRIORITY["kana"], "kana_variant"),
    (without_punctuation, PRIORITY["variant"], "punctuation_variant"),
)

_TERM = "array<struct<key:string,normalized_key:string,kind:string,priority:int,source:string>>"


def _term(text: Column, norm: Column, kind: str, priority: int, source: str) -> Column:
    term = F.struct(text.alias("key"), norm.alias("normalized_key"), F.lit(kind).alias("kind"), F.lit(priority).alias("priority"), F.lit(source).alias("source"))
    return F.when(norm.isNotNull() & (norm != "") & (text != ""), term)


def _with_variants(df: DataFrame, text: str, norm: str, first: Column) -> DataFrame:
    """(page_id, key, normalized_key, kind, priority, source): a term and the variants of its key, in generation order."""
    variants = [_term(v, v, "alias", priority, source) for make, priority, source in VARIANTS for v in (make(F.col(norm)),)]
    return df.select("page_id", F.explode(F.filter(F.array(first, *variants), lambda t: t.isNotNull())).alias("_t")).select("page_id", "_t.*")


def title_terms(articles: DataFrame, redirects: DataFrame, *, key: Key = index_key) -> DataFrame:
    """Terms of titles, their parenthesis-free bases and redirects, each with its variants.

    ``articles`` are (page_id, title), ``redirects`` (page_id, title). Titles whose key is empty give no terms.
    """
    titles = articles.select("page_id", "title").filter("title is not null").withColumn("_n", key(F.col("title")))
    bases = articles.select("page_id", parenthetical_base(F.col("title")).alias("title")).filter("title is not null").withColumn("_n", key(F.col("title")))
    hops = redirects.select("page_id", "title").filter("title is not null").withColumn("_n", key(F.col("title")))
    return (
        _with_variants(titles, "title", "_n", _term(F.col("title"), F.col("_n"), "title", PRIORITY["title"], "normalize"))
        .unionByName(_with_variants(bases, "title", "_n", _term(F.col("title"), F.col("_n"), "alias", PRIORITY["variant"], "parenthetical_base_title")))
        .unionByName(_with_variants(hops, "title", "_n", _term(F.col("title"), F.col("_n"), "redirect", PRIORITY["redirect"], "redirect")))
    )


def list_terms(pages: DataFrame, column: str, *, kind: str, priority: int, source: str, key: Key = index_key, distinct: bool = True) -> DataFrame:
    """Terms of an array column: categories (T02), headings (T03), infobox values (T04), bold lead aliases.

    With ``distinct`` the first of equal keys of a page is kept, in list order.
    """
    each = pages.select("page_id", F.posexplode(column).alias("_pos", "key")).filter("key is not null and key != ''").withColumn("normalized_key", key(F.col("key"))).filter("normalized_key is not null and normalized_key != ''")
    if distinct:
        each = each.withColumn("_rn", F.row_number().over(Window.partitionBy("page_id", "normalized_key").orderBy("_pos"))).filter("_rn = 1")
    return each.select("page_id", "key", "normalized_key", F.lit(kind).alias("kind"), F.lit(priority).alias("priority"), F.lit(source).alias("source"))


def category_terms(pages: DataFrame, column: str = "categories", *, key: Key = index_key) -> DataFrame:
    return list_terms(pages, column, kind="category", priority=PRIORITY["category"], source="category", key=key, distinct=False)


def heading_terms(pages: DataFrame, column: str = "headings", *, key: Key = index_key) -> DataFrame:
    return list_terms(pages, column, kind="keyword", priority=PRIORITY["heading"], source="heading", key=key)


def infobox_terms(pages: DataFrame, column: str = "infobox_values", *, key: Key = index_key) -> DataFrame:
    return list_terms(pages, column, kind="keyword", priority=PRIORITY["infobox"], source="infobox", key=key)


def lead_terms(pages: DataFrame, column: str = "lead_bold", title: str = "title", *, key: Key = index_key) -> DataFrame:
    """Bold texts of the lead paragraph that are not the title itself."""
    own = pages.select("page_id", key(F.col(title)).alias("_own"))
    terms = list_terms(pages, column, kind="alias", priority=PRIORITY["lead"], source="lead", key=key)
    return terms.join(own, "page_id").filter("_own is null or _own != normalized_key").drop("_own")


def cross_terms(titles: DataFrame, *, key: Key = index_key) -> DataFrame:
    """Single words of titles and redirects with at least two words, first of equal keys per page.

    ``titles`` are (page_id, ordinal, title): ordinal 0 for the title, then the redirects.
    """
    words = titles.filter("title is not null").select("page_id", "ordinal", F.split(strip(F.col("title")), f"{BLANK}+").alias("_w")).filter(F.size("_w") >= 2)
    each = words.select("page_id", "ordinal", F.posexplode("_w").alias("_pos", "key")).withColumn("normalized_key", key(F.col("key"))).filter("normalized_key is not null and normalized_key != ''")
    first = each.withColumn("_rn", F.row_number().over(Window.partitionBy("page_id", "normalized_key").orderBy("ordinal", "_pos"))).filter("_rn = 1")
    return first.select("page_id", "key", "normalized_key", F.lit("cross_component").alias("kind"), F.lit(PRIORITY["cross"]).alias("priority"), F.lit("cross_component").alias("source"))


ORDER = ("normalized_key", "page_id", "source", "key")


def ranked(terms: DataFrame) -> DataFrame:
    """Terms plus rank within their page: priority descending, then key, page and source."""
    return terms.withColumn("rank", F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("priority"), *ORDER)))


def budgeted(terms: DataFrame, *, max_terms: int, max_key_bytes: int = 255, stop_words: tuple[str, ...] = ()) -> DataFrame:
    """Terms within the budgets (T07, W03): the byte cap measures key and holds for all kinds; stop words and the cap of
    ``max_terms`` per page, by priority, only for keyword and cross_component terms."""
    counted = F.col("kind").isin(*BUDGETED)
    fit = terms.filter(F.octet_length("key") <= max_key_bytes).filter(~(counted & F.col("normalized_key").isin(*stop_words)) if stop_words else F.lit(True))
    within = F.sum(counted.cast("int")).over(Window.partitionBy("page_id").orderBy(F.desc("priority"), *ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return fit.withColumn("_used", within).filter(~counted | (F.col("_used") <= max_terms)).drop("_used")


def headwords(terms: DataFrame, articles: DataFrame) -> DataFrame:
    """(page_id, headwords): the title, then all distinct keys by rank (T08, D07). Bounded by a page's own terms."""
    packed = terms.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("priority")).alias("p"), "normalized_key", "source", "key"))).alias("_t"))
    keys = F.array_distinct(F.transform("_t", lambda t: t["key"]))
    return articles.select("page_id", "title").join(packed, "page_id", "left").select("page_id", F.array_union(F.array("title"), F.coalesce(keys, F.array().cast("array<string>"))).alias("headwords"))


def collisions(terms: DataFrame) -> DataFrame:
    """(normalized_key, targets, winner, winner_source): keys that name several pages, with the page that ranks first."""
    best = F.min_by(F.struct("page_id", "source"), F.struct((-F.col("priority")).alias("p"), "page_id", "source"))
    per_page = terms.groupBy("normalized_key", "page_id").agg(F.max("priority").alias("priority"), F.min_by("source", F.struct((-F.col("priority")).alias("p"), "source")).alias("source"))
    return per_page.groupBy("normalized_key").agg(F.count(F.lit(1)).alias("targets"), best.alias("w")).filter("targets > 1").select("normalized_key", "targets", F.col("w.page_id").alias("winner"), F.col("w.source").alias("winner_source"))


def single_candidates(terms: DataFrame) -> DataFrame:
    """One term per key, the first in term order (T10). Aggregated rather than ranked, so a hot key combines on the map side."""
    row = F.struct("page_id", "key", "kind", "priority", "source")
    order = F.struct((-F.col("priority")).alias("p"), "page_id", "source", "key", "kind")
    return terms.groupBy("normalized_key").agg(F.min_by(row, order).alias("t")).select("normalized_key", "t.*")


def headword_index(titles: DataFrame, aliases: DataFrame) -> DataFrame:
    """(headword, page_id, origin, conflicts): titles beat aliases, the lowest page wins, others are counted."""
    both = titles.select(F.col("title").alias("headword"), "page_id", F.lit(0).alias("o")).unionByName(aliases.select(F.col("title").alias("headword"), "page_id", F.lit(1).alias("o"))).filter("headword is not null").distinct()
    return both.groupBy("headword").agg(F.min(F.struct("o", "page_id")).alias("w"), F.countDistinct("page_id").alias("n")).select("headword", F.col("w.page_id").alias("page_id"), F.when(F.col("w.o") == 0, "title").otherwise("alias").alias("origin"), (F.col("n") - 1).alias("conflicts"))


MODES = ("exact", "word", "endword", "keyword", "cross")


def matches(mode: str, term: Column, kind: Column, query: Column) -> Column:
    """Whether a term answers a query in a mode (Q01-Q05)."""
    if mode == "exact":
        return ~kind.isin(*BUDGETED) & (term == query)
    if mode == "word":
        return ~kind.isin(*BUDGETED) & term.startswith(query)
    if mode == "endword":
        return ~kind.isin(*BUDGETED) & term.endswith(query)
    if mode == "keyword":
        return (kind == "keyword") & (term == query)
    if mode == "cross":
        return (kind == "cross_component") & (term == query)
    raise ValueError(f"unknown mode {mode!r}")


def lookup_mode(pattern: str) -> tuple[tuple[str, ...], str]:
    """Modes and key of a lookup pattern: ``x`` exact, ``x*`` prefix, ``*x`` suffix, ``@x`` keyword and cross (Q06)."""
    if pattern.startswith("@"):
        return ("keyword", "cross"), pattern[1:]
    if pattern.endswith("*"):
        return ("word",), pattern[:-1]
    if pattern.startswith("*"):
        return ("endword",), pattern[1:]
    return ("exact",), pattern


def lookup(terms: DataFrame, pattern: str, *, key: Callable[[str], str] = lambda s: " ".join(s.lower().split())) -> DataFrame:
    """(page_id) of the pages a pattern finds (Q06); the predicate reaches the scan of stored terms."""
    modes, text = lookup_mode(pattern)
    hit = F.lit(False)
    for mode in modes:
        hit = hit | matches(mode, F.col("normalized_key"), F.col("kind"), F.lit(key(text)))
    return terms.filter(hit).select("page_id").distinct()


def keyword_search(terms: DataFrame, words: list[str]) -> DataFrame:
    """(page_id) of pages that carry all ``words`` as keywords (Q04)."""
    wanted = sorted(set(words))
    return terms.filter((F.col("kind") == "keyword") & F.col("normalized_key").isin(*wanted)).groupBy("page_id").agg(F.countDistinct("normalized_key").alias("n")).filter(F.col("n") == len(wanted)).select("page_id")


#: Characters of a query that prefix and suffix search are hashed by; shorter queries use all of theirs.
GRAM = 4


def run_queries(terms: DataFrame, queries: DataFrame, *, max_results: int = 100) -> DataFrame:
    """(query_key, mode, rank, page_id, key, truncated): ranked hits of a query set in its modes.

    ``queries`` are (query_key, normalized_query, mode). Each mode is an equi-join: on the key, or on the first or last
    characters of it with the full test as a residual condition, so no query meets every term. Pages rank by their
    best term; max_results is the feature's result limit, and truncated tells whether a query had more.
    """
    slim = terms.select("page_id", "key", "normalized_key", "kind", "priority")
    q = queries.select("query_key", "mode", F.col("normalized_query").alias("_q")).filter("_q is not null and _q != ''")
    lengths = [r[0] for r in q.filter(F.col("mode").isin("word", "endword")).select(F.least(F.length("_q"), F.lit(GRAM))).distinct().collect()]  # at most GRAM values
    parts = []
    for mode in MODES:
        own = q.filter(F.col("mode") == mode)
        hit = matches(mode, F.col("normalized_key"), F.col("kind"), F.col("_q"))
        if mode in ("word", "endword"):
            for n in lengths:
                cut = (lambda c, n=n: F.left(c, F.lit(n))) if mode == "word" else (lambda c, n=n: F.right(c, F.lit(n)))
                some = own.filter(F.least(F.length("_q"), F.lit(GRAM)) == n)
                parts.append(some.join(slim, (cut(F.col("normalized_key")) == cut(F.col("_q"))) & hit))
        else:
            parts.append(own.join(slim, (F.col("normalized_key") == F.col("_q")) & hit))
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionByName(p)
    pages = hits.groupBy("query_key", "mode", "page_id").agg(F.min_by(F.struct("key", "normalized_key", "priority"), F.struct((-F.col("priority")).alias("p"), "normalized_key", "key")).alias("t"))
    order = Window.partitionBy("query_key", "mode").orderBy(F.desc("t.priority"), "t.normalized_key", "page_id")
    ranked_hits = pages.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max_results + 1)
    more = F.max("rank").over(Window.partitionBy("query_key", "mode")) > max_results
    return ranked_hits.withColumn("truncated", more).filter(F.col("rank") <= max_results).select("query_key", "mode", "rank", "page_id", F.col("t.key").alias("key"), "truncated")


def presence_mismatches(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """(query_key, mode, expected_presence, present, code) of queries whose result contradicts the expectation."""
    found = hits.select("query_key", "mode").distinct().withColumn("present", F.lit(True))
    joined = queries.join(found, ["query_key", "mode"], "left").withColumn("present", F.coalesce("present", F.lit(False)))
    return joined.filter("present != expected_presence").select("query_key", "mode", "expected_presence", "present", F.lit("REF_QUERY_EXPECTATION_MISMATCH").alias("code"))


def sample_entries(hits: DataFrame, entries: DataFrame, *, max_body: int = 4096, diagnostics: DataFrame | None = None) -> DataFrame:
    """(page_id, excerpt, body_sha256, links, graphics, truncated) of rank-1 hits, each page once.

    With ``diagnostics`` (page_id, code) also ``codes``, the sorted distinct codes of the page, empty for none (J07).
    """
    targets = hits.filter("rank = 1").select("page_id").distinct()
    body = F.coalesce(F.col("body"), F.lit(""))
    found = entries.join(targets, "page_id", "left_semi").select(
        "page_id", F.substring(body, 1, max_body).alias("excerpt"), F.sha2(body, 256).alias("body_sha256"), F.regexp_count(body, F.lit("\x1eR:")).alias("links"), F.regexp_count(body, F.lit("\x1eG:")).alias("graphics"), (F.length(body) > max_body).alias("truncated"),
    )
    if diagnostics is None:
        return found
    # distinct codes are few, however often a page has them
    codes = diagnostics.join(targets, "page_id", "left_semi").groupBy("page_id").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    return found.join(codes, "page_id", "left").withColumn("codes", F.coalesce("codes", F.array().cast("array<string>")))


def query_frame(spark: SparkSession, queries: list[tuple[str, str, bool]], modes: tuple[str, ...] = ("word", "endword")) -> DataFrame:
    """(query_key, normalized_query, mode, expected_presence): a fixed query set in each of its modes (Q07)."""
    return spark.createDataFrame([(k, q, m, e) for k, q, e in queries for m in modes], "query_key string, normalized_query string, mode string, expected_presence boolean")
