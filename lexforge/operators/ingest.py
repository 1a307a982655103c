"""Validation, revision-aware deduplication and child tables of article records."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.functions.strings import Key, nfkc_title
from lexforge.functions.urls import is_https


@dataclass(frozen=True)
class Limits:
    """Caps of the record validation, in UTF-8 bytes."""

    title: int = 4096
    url: int = 16384
    html: int = 64 << 20
    wikitext: int = 64 << 20
    namespace: int = 0


def record_problems(*, title: Column, url: Column, namespace: Column, html: Column, wikitext: Column, limits: Limits = Limits()) -> Column:
    """Array of the codes of all rules a record breaks, in rule order; empty for a valid one (F01). A null length breaks no cap."""
    over = lambda c, cap: F.coalesce(F.octet_length(c) > cap, F.lit(False))
    rules = (
        (over(title, limits.title), "REC_TITLE_TOO_LONG"),
        (over(url, limits.url), "REC_URL_TOO_LONG"),
        (~is_https(url), "REC_INVALID_URL"),
        (~F.coalesce(namespace == limits.namespace, F.lit(False)), "REC_UNEXPECTED_NAMESPACE"),
        (over(html, limits.html), "REC_HTML_TOO_LARGE"),
        (over(wikitext, limits.wikitext), "REC_WIKITEXT_TOO_LARGE"),
    )
    return F.filter(F.array(*[F.when(broken, code) for broken, code in rules]), lambda x: x.isNotNull())


def validate(articles: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``articles`` plus problems and ingest_status (accepted or rejected); rejected rows are kept."""
    problems = record_problems(title=F.col("name"), url=F.col("url"), namespace=F.col("namespace.identifier"), html=F.col("article_body.html"), wikitext=F.col("article_body.wikitext"), limits=limits)
    return articles.withColumn("problems", problems).withColumn("ingest_status", F.when(F.size("problems") == 0, "accepted").otherwise("rejected"))


def diagnostics(validated: DataFrame, stage: str = "ingest") -> DataFrame:
    """(code, severity, stage, page_id, title): one row for each broken rule."""
    return validated.select(F.explode("problems").alias("code"), F.lit("error").alias("severity"), F.lit(stage).alias("stage"), F.col("identifier").alias("page_id"), F.col("name").alias("title"))


def latest_states(states: DataFrame, *, key: str, revision: str, arrival: list[str]) -> DataFrame:
    """The accepted row of each key if all rows are valid: highest revision, earliest arrival of it (D01). Null revisions lose."""
    order = [F.desc_nulls_last(revision), *[F.asc(a) for a in arrival]]
    return states.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_rn = 1").drop("_rn")


#: Arrival ranges that the rows of one key are spread over.
RANGES = 64


def _arrival_range(states: DataFrame, column: str) -> Column:
    """Number of the arrival range of a row; the bounds are quantiles of the whole table (RANGES - 1 numbers on the driver)."""
    at = F.col(column).cast("double")
    cuts = states.select(at.alias("a")).agg(F.percentile_approx("a", [i / RANGES for i in range(1, RANGES)], 1000).alias("q")).first()["q"] or []
    passed = [F.when(at > c, 1).otherwise(0) for c in sorted(set(cuts))]
    return sum(passed[1:], passed[0]) if passed else F.lit(0)


def dedup_audit(states: DataFrame, *, key: str, revision: str, content_hash: str, arrival: list[str]) -> DataFrame:
    """One row for each arrival of a key after its first.

    The state before an arrival is the running minimum of (-revision, arrival, hash), so reason and both revisions follow
    without a fold. Columns: key, kept_revision_id, dropped_revision_id, kept_hash, dropped_hash, reason and the arrival.
    The first arrival column is a number. The rows of a key are spread over ranges of it: each range is folded for
    itself, the ranges' results (at most RANGES per key) are folded in turn and handed down, so no task gets all rows of
    a hot key. Null revisions and null keys are left out.
    """
    sound = states.filter(F.col(key).isNotNull() & F.col(revision).isNotNull())
    state = F.struct((-F.col(revision)).alias("r"), *[F.col(c).alias(f"a{i}") for i, c in enumerate(arrival)], F.col(content_hash).alias("h"))
    ranged = sound.select(key, revision, content_hash, *[c for c in arrival if c not in (key, revision, content_hash)], state.alias("_state"), _arrival_range(sound, arrival[0]).alias("_range"))
    inside = Window.partitionBy(key, "_range").orderBy(*arrival).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = ranged.groupBy(key, "_range").agg(F.min("_state").alias("_m")).select(key, "_range", F.min("_m").over(across).alias("_before"))
    joined = ranged.withColumn("_own", F.min("_state").over(inside)).join(handed, [key, "_range"])
    seen = joined.withColumn("_s", F.least("_own", "_before")).filter("_s is not null")
    new, old = F.col(revision), -F.col("_s.r")
    reason = F.when(new > old, "newer_revision_replaced_older").when(new < old, "out_of_order_older_revision_dropped").when(F.col(content_hash) == F.col("_s.h"), "identical_duplicate_delivery").otherwise("same_revision_conflicting_hash")
    wins = new > old
    return seen.select(
        F.col(key), F.when(wins, new).otherwise(old).alias("kept_revision_id"), F.when(wins, old).otherwise(new).alias("dropped_revision_id"), F.when(wins, F.col(content_hash)).otherwise(F.col("_s.h")).alias("kept_hash"),
        F.when(wins, F.col("_s.h")).otherwise(F.col(content_hash)).alias("dropped_hash"), reason.alias("reason"), *arrival,
    )


def fold_states(states: DataFrame, *, key: str = "page_id", revision: str = "revision_id", content_hash: str = "source_hash", valid: str = "valid", arrival: list[str]) -> DataFrame:
    """(key, revision, hash, status, arrivals): final state per key when invalid records may interfere.

    A newer but invalid record overwrites the accepted row as rejected, and what comes after it counts as first seen.
    Only keys that have both an invalid and another record need that fold; their narrow rows are sorted by key and
    arrival and folded as they stream by, with one state in memory, never a group. All other keys are aggregated on the
    map side. Null keys and revisions are left out.
    """
    narrow = states.select(F.col(key).alias("k"), F.col(revision).alias("r"), F.col(content_hash).alias("h"), F.coalesce(F.col(valid), F.lit(False)).alias("v"), F.struct(*arrival).alias("a")).filter("k is not null and r is not null")
    best = F.min(F.struct((-F.col("r")).alias("r"), "a", "h", "v"))
    keys = narrow.groupBy("k").agg((F.count_if(~F.col("v")) > 0).alias("odd"), F.count(F.lit(1)).alias("n"), best.alias("b"))
    simple = keys.filter("not (odd and n > 1)").select(F.col("k").alias(key), (-F.col("b.r")).alias(revision), F.col("b.h").alias(content_hash), F.when(F.col("b.v"), "accepted").otherwise("rejected").alias("status"), F.col("n").alias("arrivals"))
    mixed = narrow.join(keys.filter("odd and n > 1").select("k"), "k", "left_semi").repartition("k").sortWithinPartitions("k", "a").select("k", "r", "h", "v")
    columns = [key, revision, content_hash, "status", "arrivals"]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, row, accepted, n = None, None, None, 0
        for pdf in batches:
            done = []
            for k, r, h, v in pdf.itertuples(index=False):
                if at is None or k != at:
                    if at is not None:
                        done.append((at, *row, "accepted" if accepted is not None else "rejected", n))
                    at, row, accepted, n = k, None, None, 0
                n += 1
                if accepted is None or r > accepted:
                    row, accepted = (r, h), r if v else None
            if done:
                yield pd.DataFrame(done, columns=columns)
        if at is not None:
            yield pd.DataFrame([(at, *row, "accepted" if accepted is not None else "rejected", n)], columns=columns)

    kinds = dict(states.dtypes)
    schema = f"`{key}` {kinds[key]}, `{revision}` {kinds[revision]}, `{content_hash}` {kinds[content_hash]}, status string, arrivals bigint"
    return simple.unionByName(mixed.mapInPandas(fold, schema))


def explode_children(articles: DataFrame, field: str, *, page: str = "identifier", key: Key = nfkc_title) -> DataFrame:
    """(page, ordinal, name, normalized_name) of a named list: first of equal keys wins, ordinals count after that.

    Articles are expected once each (after deduplication); a null list gives no rows, null names are left out.
    """
    each = articles.select(F.col(page), F.posexplode(field).alias("_pos", "_item")).select(page, "_pos", F.col("_item.name").alias("name")).filter("name is not null")
    keyed = each.withColumn("normalized_name", key(F.col("name")))
    first = keyed.withColumn("_rn", F.row_number().over(Window.partitionBy(page, "normalized_name").orderBy("_pos"))).filter("_rn = 1")
    return first.select(page, (F.row_number().over(Window.partitionBy(page).orderBy("_pos")) - 1).alias("ordinal"), "name", "normalized_name")


def licenses(articles: DataFrame, *, page: str = "identifier", arrival: str) -> tuple[DataFrame, DataFrame]:
    """(license dimension, bridge): (identifier, url, name) with the first seen name, and (_page, ordinal, identifier, url)."""
    each = articles.select(page, arrival, F.posexplode("license").alias("_pos", "l")).select(page, arrival, "_pos", "l.identifier", "l.name", "l.url").toDF("_page", "_arrival", "_pos", "identifier", "name", "url")
    dimension = each.groupBy("identifier", "url").agg(F.min_by("name", F.struct("_arrival", "_pos", "name")).alias("name"))
    first = each.groupBy("_page", "identifier", "url").agg(F.min("_pos").alias("_pos"))
    bridge = first.select("_page", (F.row_number().over(Window.partitionBy("_page").orderBy("_pos")) - 1).alias("ordinal"), "identifier", "url")
    return dimension, bridge


def main_image(articles: DataFrame, *, page: str = "identifier") -> DataFrame:
    """(page, content_url, width, height): content_url falls back to url; articles without either have no row."""
    url = F.coalesce(F.nullif(F.col("image.content_url"), F.lit("")), F.nullif(F.col("image.url"), F.lit("")))
    return articles.select(page, url.alias("content_url"), F.col("image.width").alias("width"), F.col("image.height").alias("height")).filter("content_url is not null")


def hydrate(articles: DataFrame, children: dict[str, DataFrame], *, page: str = "identifier") -> DataFrame:
    """Articles with each child table as one ordered array of names (P04, J03); articles without children get empty arrays."""
    out = articles
    for name, child in children.items():
        # at most one row per list element of the page's own record
        packed = child.groupBy(page).agg(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "name"))), lambda x: x["name"]).alias(name))
        out = out.join(packed, page, "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))
    return out


def ingest_metrics(validated: DataFrame, audit: DataFrame | None = None) -> DataFrame:
    """One row: read, written, rejected, errors (A02, A03). written counts accepted rows, errors the broken rules."""
    return validated.agg(F.count(F.lit(1)).alias("read"), F.count_if(F.col("ingest_status") == "accepted").alias("written"), F.count_if(F.col("ingest_status") == "rejected").alias("rejected"), F.coalesce(F.sum(F.size("problems")), F.lit(0)).alias("errors"))
