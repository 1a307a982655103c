"""The pipeline: records -> accepted articles and child tables -> document model and links -> terms and entries."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.functions.strings import Key, index_key, nfkc_title
from lexforge.functions.times import iso_instant, utc_wall
from lexforge.functions.urls import base_url
from lexforge.operators import delivery, html, ingest, links, media, render, search, verify
from lexforge.session import materialize, shared_folder


@dataclass
class Raw:
    """Output of the ingest stage."""

    articles: DataFrame
    rejected: DataFrame
    redirects: DataFrame
    categories: DataFrame
    licenses: DataFrame
    audit: DataFrame
    diagnostics: DataFrame


@dataclass
class Model:
    """Output of the normalize stage."""

    articles: DataFrame
    links: DataFrame
    media: DataFrame
    problems: DataFrame


@dataclass
class Generated:
    """Output of the generate stage."""

    terms: DataFrame
    entries: DataFrame
    issues: DataFrame
    extras: dict[str, DataFrame] = field(default_factory=dict)


def run_ingest(records: DataFrame, *, arrival: list[str], limits: ingest.Limits = ingest.Limits(), key: Key = nfkc_title, positions: bool = False) -> Raw:
    """Validate, deduplicate by revision and part the child tables.

    ``records`` have the article columns, source_hash and the ``arrival`` columns; rows without identifier or
    version.identifier are rejected. Winners are chosen on narrow columns. With ``positions`` (records that come from a
    Parquet scan) the wide rows are read once against deletion vectors; else they are shuffled once to meet the winners.
    """
    checked = ingest.validate(records.withColumn("_known", F.col("identifier").isNotNull() & F.col("version.identifier").isNotNull()), limits)
    is_sound = F.col("_known") & (F.col("ingest_status") == "accepted")
    sound = checked.filter(is_sound).drop("_known")
    narrow = sound.select(F.col("identifier").alias("page_id"), F.col("version.identifier").alias("revision_id"), "source_hash", *arrival)
    if positions:
        accepted = delivery.newest_rows(checked, key=F.col("identifier"), counted=is_sound, revision=F.col("version.identifier"), arrival=arrival).drop("_known")
    else:
        winners = ingest.latest_states(narrow, key="page_id", revision="revision_id", arrival=arrival).select(F.col("page_id").alias("identifier"), *arrival)
        accepted = sound.join(winners, ["identifier", *arrival], "left_semi").select(*sound.columns)
    return Raw(
        accepted,
        checked.filter("not _known or ingest_status = 'rejected'").drop("_known"),
        *child_tables(accepted, arrival=arrival, key=key),
        ingest.dedup_audit(narrow, key="page_id", revision="revision_id", content_hash="source_hash", arrival=arrival),
        ingest.diagnostics(checked),
    )


def stored(raw: Raw, *, arrival: list[str], key: Key = nfkc_title) -> Raw:
    """``raw`` with the accepted articles written once; both later stages and all child tables read them."""
    columns = [c for c in ("identifier", "name", "url", "date_modified", "article_body", "redirects", "categories", "license", *arrival) if c in raw.articles.columns]
    articles = materialize(raw.articles.select(*columns).withColumn("article_body", F.struct("article_body.html")), "articles")
    redirects, categories, licenses = child_tables(articles, arrival=arrival, key=key)
    return Raw(articles, raw.rejected, redirects, categories, licenses, raw.audit, raw.diagnostics)


def child_tables(accepted: DataFrame, *, arrival: list[str], key: Key = nfkc_title) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(redirects, categories, licenses) of the accepted articles."""
    _, bridge = ingest.licenses(accepted, arrival=arrival[0])
    licenses = bridge.select(F.col("_page").alias("page_id"), "ordinal", F.col("identifier").alias("license_id"), "url")
    return ingest.explode_children(accepted, "redirects", key=key), ingest.explode_children(accepted, "categories", key=key), licenses


def run_normalize(raw: Raw, *, options: html.Options = html.Options(), key: Key = nfkc_title) -> Model:
    """Document model of the accepted articles, with links resolved against titles and redirects."""
    bodies = raw.articles.select(F.col("identifier").alias("page_id"), F.col("article_body.html").alias("html"), "url")
    parsed = materialize(html.normalize_bodies(bodies, key=["page_id"], html="html", base=base_url(F.col("url")), options=options), "model")
    found = parsed.select(F.col("page_id").alias("source_page_id"), F.posexplode("links").alias("ordinal", "l")).select("source_page_id", "ordinal", "l.namespace", "l.title", "l.fragment")
    titles = raw.articles.select(F.col("identifier").alias("page_id"), F.col("name").alias("title"))
    hops = raw.redirects.select(F.col("identifier").alias("target_page_id"), F.col("name").alias("title"))
    resolved = links.resolve(found, titles, hops, key=key)
    pictures = parsed.select("page_id", F.posexplode("media").alias("ordinal", "m")).select("page_id", "ordinal", "m.*")
    problems = parsed.select("page_id", F.explode("problems").alias("p")).select("page_id", "p.code", "p.element")
    slim = parsed.select("page_id", F.col("status").alias("normalize_status"), "abstract", "lead", "body_json", "headings", "infobox_values", "lead_bold", F.size("blocks").alias("block_count"))
    return Model(slim, resolved, html.selected_media(pictures), problems)


def run_generate(raw: Raw, model: Model, *, max_terms: int = 64, key: Key = index_key) -> Generated:
    """Search terms, headwords and rendered entries of the articles that were not rejected, with their issues."""
    pages = raw.articles.select(F.col("identifier").alias("page_id"), F.col("name").alias("title"), F.date_format(utc_wall(iso_instant(F.col("date_modified"))), "yyyy-MM-dd").alias("modified")).join(model.articles.filter("normalize_status != 'rejected'"), "page_id")
    redirects = raw.redirects.select(F.col("identifier").alias("page_id"), F.col("name").alias("title"))
    terms = search.title_terms(pages, redirects, key=key)
    keywords = search.budgeted(search.heading_terms(pages, key=key).unionByName(search.infobox_terms(pages, key=key)), max_terms=max_terms)
    words = keywords.groupBy("page_id").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("priority")).alias("p"), "normalized_key", "key"))), lambda t: t["key"]).alias("keywords"))
    heads = search.headwords(terms, pages)
    categories = raw.categories.groupBy(F.col("identifier").alias("page_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "name"))), lambda x: x["name"]).alias("categories"))
    licenses = raw.licenses.groupBy("page_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "license_id"))), lambda x: x["license_id"]).alias("license_ids"))
    targets = model.links.groupBy(F.col("source_page_id").alias("page_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "target_page_id"))), lambda x: x["target_page_id"]).alias("link_pages"))
    ready = pages.join(heads, "page_id").join(words, "page_id", "left").join(categories, "page_id", "left").join(targets, "page_id", "left").join(licenses, "page_id", "left")
    entries = render.render_entries(ready.withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>"))))
    return Generated(terms.unionByName(keywords), entries, verify.entry_issues(entries))


def build(spark: SparkSession, records: DataFrame, *, arrival: list[str], output: str | None = None) -> Generated:
    """All stages; with ``output`` the tables are written below it, see plans.pipeline."""
    if output:
        from lexforge.plans import pipeline

        made = pipeline.Build(spark, output, lambda: records, arrival)
        made.run(force="ingest", control=f"{shared_folder(spark).removeprefix('file:')}/build-{uuid.uuid4().hex}")
        return Generated(made.table("search_terms"), made.entries(), made.table("issues"))
    raw = stored(run_ingest(records, arrival=arrival), arrival=arrival)
    return run_generate(raw, run_normalize(raw))


def plan_media(model: Model) -> DataFrame:
    """Addresses to fetch."""
    return media.plan(model.media, model.articles)
