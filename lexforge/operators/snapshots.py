"""Changes between consecutive full snapshots, by gaps-and-islands over key and row hash.

Plan: the scan reads key, version and the compared columns, replaces the latter by a 64-bit hash at once, and
pre-aggregates to one row per (key, snapshot) before the shuffle, so neither a wide column nor a hot key's copies travel.
Runs of consecutive snapshots with an equal hash become validity intervals; starts, ends and adjacencies of the
intervals become the change events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.session import broadcast_if_small


def row_hash(*columns: Column) -> Column:
    """64-bit hash of the columns in which null differs from every value and from its neighbours' nulls."""
    parts: list[Column] = []
    for c in columns:
        parts += [c, c.isNull()]
    return F.xxhash64(*parts)


def snapshot_order(rows: DataFrame, locks: DataFrame, *, snapshot: str = "snapshot_identifier", dated: str = "date_modified") -> DataFrame:
    """(snapshot, snapshot_no): the snapshots that have rows, numbered from 1 in the order of their lock dates.

    A snapshot locked several times counts once, at its earliest date; equal dates are ordered by name; a lock without
    rows and rows without a dated lock get no number. One row per snapshot, so the unpartitioned window is tiny.
    """
    dates = locks.filter(F.col(snapshot).isNotNull() & F.col(dated).isNotNull()).groupBy(snapshot).agg(F.min(dated).alias("_dated"))
    present = rows.select(snapshot).distinct()
    return dates.join(present, snapshot, "left_semi").select(snapshot, F.row_number().over(Window.orderBy("_dated", snapshot)).alias("snapshot_no"))


def validity_intervals(rows: DataFrame, order: DataFrame, *, key: str, version: Column, compared: list[Column], snapshot: str = "snapshot_identifier") -> DataFrame:
    """(key, version, valid_from, valid_to): maximal runs of consecutive snapshots in which a key's version and hash stay equal.

    Rows with a null key, null version or unnumbered snapshot do not count. Of several rows of a key in one snapshot the
    one with the highest version counts; rows tied in it are taken to be equal (the highest hash stands for them, so the
    result is deterministic).
    """
    slim = rows.select(F.col(key).alias("_key"), version.alias("_version"), row_hash(*compared).alias("_hash"), F.col(snapshot).alias("_snapshot")).filter("_key is not null and _version is not null")
    numbered = slim.join(broadcast_if_small(order.select(F.col(snapshot).alias("_snapshot"), "snapshot_no")), "_snapshot")
    # max_by keeps its buffer in two longs, which lets Spark use hash aggregation; a struct would force sorting.
    tied = numbered.groupBy("_key", "snapshot_no", "_version").agg(F.max("_hash").alias("_hash"))
    states = tied.groupBy("_key", "snapshot_no").agg(F.max_by("_hash", "_version").alias("_hash"), F.max("_version").alias("_version"))
    by_key = Window.partitionBy("_key").orderBy("snapshot_no")
    starts = (F.lag("snapshot_no").over(by_key).isNull()) | (F.lag("snapshot_no").over(by_key) + 1 != F.col("snapshot_no")) | (F.lag("_hash").over(by_key) != F.col("_hash")) | (F.lag("_version").over(by_key) != F.col("_version"))
    islands = states.withColumn("_start", starts.cast("int")).withColumn("_island", F.sum("_start").over(by_key))
    return (
        islands.groupBy("_key", "_island")
        .agg(F.first("_version").alias("version"), F.min("snapshot_no").alias("valid_from"), F.max("snapshot_no").alias("valid_to"))
        .select(F.col("_key").alias(key), "version", "valid_from", "valid_to")
    )


def change_events(intervals: DataFrame, order: DataFrame, *, key: str, snapshot: str = "snapshot_identifier") -> DataFrame:
    """(snapshot, key, change_kind) with change_kind added, removed or changed, from validity intervals.

    An interval that starts right after another one ends is a change; one that starts later than the first snapshot
    after a gap is an addition; one that ends before the last snapshot with a gap behind it is a removal. The first
    snapshot has no events.
    """
    by_key = Window.partitionBy(key).orderBy("valid_from")
    last = order.agg(F.max("snapshot_no").alias("_last"))
    last_no = last.first()[0] or 0
    framed = intervals.withColumn("_before", F.lag("valid_to").over(by_key)).withColumn("_after", F.lead("valid_from").over(by_key))
    adjacent = F.coalesce(F.col("_before") + 1 == F.col("valid_from"), F.lit(False))
    start = F.when(F.col("valid_from") > 1, F.struct(F.col("valid_from").alias("no"), F.when(adjacent, "changed").otherwise("added").alias("kind")))
    gap_behind = ~F.coalesce(F.col("_after") == F.col("valid_to") + 1, F.lit(False))
    end = F.when((F.col("valid_to") < last_no) & gap_behind, F.struct((F.col("valid_to") + 1).alias("no"), F.lit("removed").alias("kind")))
    events = framed.select(F.col(key), F.explode(F.filter(F.array(start, end), lambda e: e.isNotNull())).alias("_event"))
    names = broadcast_if_small(order)
    return events.join(names, F.col("_event.no") == F.col("snapshot_no")).select(F.col(snapshot), F.col(key), F.col("_event.kind").alias("change_kind"))


def article_snapshot_changes(articles: DataFrame, locks: DataFrame) -> DataFrame:
    """Pages added, removed and changed between consecutive snapshots of an article table."""
    order = snapshot_order(articles, locks)
    intervals = validity_intervals(articles, order, key="identifier", version=F.col("version.identifier"), compared=[F.col("article_body.html"), F.col("article_body.wikitext")])
    return change_events(intervals, order, key="identifier")
