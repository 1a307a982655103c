"""Comparison of snapshots and of search-result sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lock_files(locks: DataFrame) -> DataFrame:
    """One row per file of each lock, with the lock's snapshot."""
    return locks.select("project", "snapshot_identifier", "date_modified", "downloaded_at", F.explode("files").alias("f")).select("project", "snapshot_identifier", "date_modified", "downloaded_at", "f.*")


def latest_snapshot(locks: DataFrame) -> DataFrame:
    """(project, snapshot_identifier, date_modified): newest by date, then version."""
    return locks.groupBy("project").agg(F.max_by(F.struct("snapshot_identifier", "date_modified"), F.struct("date_modified", "snapshot_version")).alias("s")).select("project", "s.snapshot_identifier", "s.date_modified")


def chunk_diff(previous: DataFrame, new: DataFrame, *, within: list[str] | None = None) -> DataFrame:
    """(within, chunk_key, change, size_delta): full outer join of file lists on chunk_key.

    Inputs: (within, chunk_key, size_bytes, sha256); ``within`` are columns that name several comparisons at once.
    """
    on = [*(within or []), "chunk_key"]
    a = previous.select(*on, F.col("size_bytes").alias("_size_a"), F.col("sha256").alias("_sha_a"), F.lit(True).alias("_a"))
    b = new.select(*on, F.col("size_bytes").alias("_size_b"), F.col("sha256").alias("_sha_b"), F.lit(True).alias("_b"))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_sha_a") != F.col("_sha_b"), "changed").otherwise("unchanged")
    delta = F.coalesce("_size_b", F.lit(0)) - F.coalesce("_size_a", F.lit(0))
    return a.join(b, on, "full_outer").select(*on, change.alias("change"), delta.alias("size_delta"))


def diff_summary(diff: DataFrame, *, within: list[str] | None = None) -> DataFrame:
    """(within, added, removed, changed, unchanged, size_delta) (A09); one row without ``within``."""
    return diff.groupBy(*(within or [])).agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("added", "removed", "changed", "unchanged")], F.coalesce(F.sum("size_delta"), F.lit(0)).alias("size_delta"))


def compare_hits(reference: DataFrame, candidate: DataFrame) -> DataFrame:
    """Per query: presence and overlap of two hit sets.

    Inputs: (query_key, expected_presence, headings array). A query without a candidate row has candidate_missing true.
    Overlap and rank agreement are null for an empty reference.
    """
    c = candidate.select("query_key", F.col("headings").alias("_c"), F.lit(True).alias("_there"))
    j = reference.join(c, "query_key", "left").withColumn("_c", F.coalesce("_c", F.array().cast("array<string>"))).withColumn("headings", F.coalesce("headings", F.array().cast("array<string>")))
    n = F.size("headings")
    overlap = F.when(n > 0, F.size(F.array_intersect("headings", "_c")) / F.size(F.array_distinct("headings")))
    both = F.least(n, F.size("_c"))
    same = F.aggregate(F.zip_with(F.slice("headings", 1, both), F.slice("_c", 1, both), lambda x, y: F.coalesce((x == y).cast("int"), F.lit(0))), F.lit(0), lambda s, x: s + x)
    present = F.size("_c") > 0
    return j.select(
        "query_key", "expected_presence", F.col("_there").isNull().alias("candidate_missing"), present.alias("candidate_present"), (present == F.col("expected_presence")).alias("matches"),
        overlap.alias("overlap_at_n"), F.when(n > 0, same / n).alias("rank_agreement_at_n"),
    )


def compare_summary(per_query: DataFrame) -> DataFrame:
    """One row: total, target_coverage, false_positives and the means, nulls skipped."""
    return per_query.agg(
        F.count(F.lit(1)).alias("total"), F.coalesce(F.avg(F.col("matches").cast("double")), F.lit(0.0)).alias("target_coverage"), F.count_if(~F.col("expected_presence") & F.col("candidate_present")).alias("false_positives"),
        F.avg("overlap_at_n").alias("overlap_mean"), F.avg("rank_agreement_at_n").alias("rank_agreement_mean"), F.count_if("candidate_missing").alias("missing"),
    )


def evaluate(summary: DataFrame, *, min_coverage: float = 0.95, max_false_positives: int = 0) -> DataFrame:
    """summary plus passed."""
    return summary.withColumn("passed", (F.col("target_coverage") >= min_coverage) & (F.col("false_positives") <= max_false_positives) & (F.col("missing") == 0))


def compatibility_report(evaluated: DataFrame, *, reference: str, candidate: str) -> DataFrame:
    """One row (report_json): a report whose absent metrics are left out rather than zero (Q09)."""
    return evaluated.select(F.to_json(F.struct(F.lit(reference).alias("reference"), F.lit(candidate).alias("candidate"), *evaluated.columns)).alias("report_json"))
