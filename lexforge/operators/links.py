"""Internal-link extraction and resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions.strings import Key, nfkc_title
from lexforge.functions.urls import base_url, parse_internal
from lexforge.operators.skew import attach
from lexforge.session import materialize


def extract_links(bodies: DataFrame, *, page: str, html: str, bases: tuple[str, ...] = ()) -> DataFrame:
    """(page, ordinal, namespace, title, fragment) of the internal anchors of each body in document order (P06, by pattern)."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r"""(?i)<a\s[^>]*?href="([^"]*)\""""), F.lit(1))
    each = bodies.select(F.col(page), F.posexplode(hrefs).alias("_pos", "_href"))
    # character references in attributes: the two that addresses hold
    url = F.replace(F.replace(F.col("_href"), F.lit("&quot;"), F.lit('"')), F.lit("&amp;"), F.lit("&"))
    parsed = each.select(page, "_pos", parse_internal(url, bases).alias("_p")).filter("_p is not null")
    return parsed.select(page, (F.row_number().over(Window.partitionBy(page).orderBy("_pos")) - 1).alias("ordinal"), "_p.namespace", "_p.title", "_p.fragment")


def title_lookup(titles: DataFrame, *, title: str, page: str, key: Key) -> DataFrame:
    """(lookup_key, target): lowest page of each normalized title; map-side combined, one row per key."""
    return titles.select(key(F.col(title)).alias("lookup_key"), F.col(page).alias("_page")).filter("lookup_key is not null and lookup_key != '' and _page is not null").groupBy("lookup_key").agg(F.min("_page").alias("target"))


def resolve(links: DataFrame, articles: DataFrame, redirects: DataFrame, *, title: str = "title", namespace: str = "namespace", key: Key = nfkc_title) -> DataFrame:
    """``links`` plus target_page_id and resolution.

    A namespaced link is externalized; else the lowest page with that normalized title resolves it, else the lowest
    target of a redirect with it (one hop, the target's state is not looked at), else it is missing. ``articles`` are
    (page_id, title), ``redirects`` (target_page_id, title).

    Distinct keys are resolved first, with the links that hold them counted; the verdicts return by a join in which hot
    titles are broadcast. Null titles are missing.
    """
    keyed = links.withColumn("_key", F.when(F.col(namespace).isNull(), key(F.col(title))))
    asked = keyed.filter("_key is not null").groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    by_title = title_lookup(articles, title="title", page="page_id", key=key)
    by_redirect = title_lookup(redirects, title="title", page="target_page_id", key=key)
    verdicts = asked.join(by_title.toDF("_key", "_direct"), "_key", "left").join(by_redirect.toDF("_key", "_hop"), "_key", "left").select("_key", "_n", F.coalesce("_direct", "_hop").alias("_target"))
    verdicts = materialize(verdicts, "titles")
    total = verdicts.agg(F.sum("_n")).first()[0] or 0
    joined = attach(keyed, verdicts, ["_key"], weight="_n", total=total)
    verdict = F.when(F.col(namespace).isNotNull(), "externalized").when(F.col("_target").isNotNull(), "resolved").otherwise("missing")
    drop = [c for c in ("target_page_id", "resolution") if c in links.columns]
    return joined.drop(*drop).select(*[c for c in links.columns if c not in drop], F.col("_target").alias("target_page_id"), verdict.alias("resolution"))


def resolution_counts(resolved: DataFrame) -> DataFrame:
    """(resolution, n)."""
    return resolved.groupBy("resolution").agg(F.count(F.lit(1)).alias("n"))


def project_link(url: Column, source_url: Column) -> Column:
    """An external address that points at the page's own project, parsed as an internal one; null otherwise."""
    base = base_url(source_url)
    own = url.startswith(F.concat(base, F.lit("/wiki/")))
    return F.when(own, parse_internal(F.concat(F.lit("./"), F.substring(url, F.length(base) + 7, F.length(url)))))


def inconsistent_links(links: DataFrame) -> DataFrame:
    """(source_page_id, ordinal, code): resolved links without a page, others with one."""
    code = F.when((F.col("resolution") == "resolved") & F.col("target_page_id").isNull(), "MODEL_LINK_RESOLVED_WITHOUT_PAGE_ID").when((F.col("resolution") != "resolved") & F.col("target_page_id").isNotNull(), "MODEL_LINK_UNRESOLVED_WITH_PAGE_ID")
    return links.select("source_page_id", "ordinal", code.alias("code")).filter("code is not null")


def redirect_chains(titles: DataFrame, redirects: DataFrame, *, max_hops: int | None = None) -> DataFrame:
    """(title, target, hops, outcome) of each redirect (J13): outcome resolved, cycle, missing or too_long.

    Pointer doubling: each round joins every pointer with its target's pointer and is written, so a chain of n hops takes
    log2(n) rounds of one shuffle join. Rounds end when no further pointer leaves the redirects: if a chain went on, the
    one of its redirects within the round's reach would have left, so the rest are cycles. Chains of more than ``max_hops``, if given, are too_long. ``titles`` is
    (title); ``redirects`` is (title, target); of several targets the lowest counts.
    """
    real = titles.select("title").distinct()
    step = materialize(redirects.filter("title is not null and target is not null").groupBy("title").agg(F.min("target").alias("target")), "redirects")
    total = step.count()

    def followed(rows: DataFrame, pointers: DataFrame) -> DataFrame:
        """``rows`` with what ``pointers`` (target, ...) tell of their targets; a target that many rows share is not shuffled."""
        asked = rows.groupBy("target").agg(F.count(F.lit(1)).alias("_n")).join(pointers, "target", "left")
        return attach(rows, materialize(asked, "targets"), ["target"], weight="_n", total=total)

    # a pointer that has left the redirects is done; the others go on, and their targets may be done or not
    again = step.select(F.col("title").alias("target"), F.lit(True).alias("_again"))
    state = materialize(followed(step, again).select("title", "target", F.lit(1).cast("bigint").alias("hops"), F.col("_again").isNotNull().alias("_on")), "hops")
    before, left = -1, state.filter("_on").count()
    while left and left != before:
        nxt = state.select(F.col("title").alias("target"), F.col("target").alias("_further"), F.col("hops").alias("_more"), F.col("_on").alias("_next"))
        further = followed(state, nxt)
        state = materialize(further.select("title", F.coalesce("_further", "target").alias("target"), (F.col("hops") + F.coalesce("_more", F.lit(0))).alias("hops"), F.coalesce("_next", F.lit(False)).alias("_on")), "hops")
        before, left = left, state.filter("_on").count()
    there = followed(state, real.select(F.col("title").alias("target"), F.lit(True).alias("_real")))
    outcome = F.when(F.col("_on"), "cycle").when(F.col("hops") > max_hops if max_hops is not None else F.lit(False), "too_long").when(F.col("_real"), "resolved").otherwise("missing")
    return there.select("title", "target", F.when(outcome != "cycle", F.col("hops").cast("int")).alias("hops"), outcome.alias("outcome"))
