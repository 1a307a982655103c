"""References to records that do not exist (yet), by a Bloom filter of parent keys and an exact join of its positives.

1. Parent presence: the last state per (tag, month) gives half-open month intervals in which a key exists.
2. A Bloom filter over all parent keys, built by a distributed bit_or and bounded in bits, proves most orphans at once.
3. Only filter-positive references, reduced to distinct (key, month), are verified by an exact equi-join with the
   intervals. The keys found missing return to the references by a broadcast if a count shows them few, else by a join
   in which hot keys (at most a fixed number) are broadcast, so a title that a third of all references name never moves.
4. Orphans are counted per table and month.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lexforge.functions.times import month_text, utc_month_number
from lexforge.operators.skew import attach
from lexforge.session import BROADCAST_ROWS, materialize

#: Most bits of the filter (32 MB). With more keys than fit, more references go to the exact join; the result is the same.
MAX_BITS = 1 << 28
PROBES = 5
#: A month number after every real one.
NEVER = 2**31 - 1
# Blanks that do not count at the ends of a link title.
BLANKS = " \t\n\v\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def presence_intervals(entries: DataFrame, *, tag: str = "tag", at: str = "rendered_at", deleted: str = "is_deleted") -> DataFrame:
    """(tag, month_from, month_to): half-open ranges of month numbers in which the last row of ``tag`` so far is no deletion.

    Of rows rendered at one instant a deletion counts as the later one; a null ``deleted`` is no deletion; rows without
    tag or instant have no effect.
    """
    is_deleted = F.coalesce(F.col(deleted), F.lit(False))
    moment = F.unix_micros(F.col(at)) * 2 + is_deleted.cast("int")
    monthly = (
        entries.filter(F.col(tag).isNotNull() & F.col(at).isNotNull())
        .select(F.col(tag).alias("tag"), utc_month_number(F.col(at)).alias("month_from"), moment.alias("_moment"), is_deleted.alias("_deleted"))
        .groupBy("tag", "month_from")
        .agg(F.max_by("_deleted", "_moment").alias("_deleted"))
    )
    nxt = F.lead("month_from").over(Window.partitionBy("tag").orderBy("month_from"))
    return monthly.select("tag", "month_from", F.coalesce(nxt, F.lit(NEVER)).alias("month_to"), "_deleted").filter(~F.col("_deleted")).drop("_deleted")


def entry_names(entries: DataFrame) -> DataFrame:
    """(tag, name): every title and alias on any row of a tag, nulls left out."""
    names = F.explode(F.concat(F.array("title"), F.coalesce("aliases", F.array().cast("array<string>"))))
    return entries.filter("tag is not null").select("tag", names.alias("name")).filter("name is not null").distinct()


def parent_spans(entries: DataFrame) -> DataFrame:
    """(table_name, key, spans): the keys that references of each table need, with the month ranges in which they exist.

    A key shared by many entries has their distinct ranges, which the number of months bounds.
    """
    slim = entries.select("tag", "title", "aliases", "rendered_at", "is_deleted")
    intervals = presence_intervals(slim)
    by_tag = intervals.select(F.lit("entries").alias("table_name"), F.col("tag").alias("key"), "month_from", "month_to")
    by_name = entry_names(slim).join(intervals, "tag").select(F.lit("links").alias("table_name"), F.col("name").alias("key"), "month_from", "month_to")
    return by_tag.unionByName(by_name).groupBy("table_name", "key").agg(F.collect_set(F.struct("month_from", "month_to")).alias("spans"))


def link_key(title: Column) -> Column:
    """A link title as a lookup key: underscores are blanks, blanks at the ends (of any kind) do not count."""
    return F.btrim(F.translate(title, "_", " "), F.lit(BLANKS))


def references(entries: DataFrame, links: DataFrame) -> DataFrame:
    """(table_name, source_page_id, target, ref_month, key) of both reference columns, as often as they occur."""
    inner = (
        entries.filter("not coalesce(is_deleted, false)")
        .select("page_id", "rendered_at", F.explode("internal_targets").alias("target"))
        .filter("target is not null and target != ''")
        .select(F.lit("entries").alias("table_name"), F.col("page_id").alias("source_page_id"), "target", utc_month_number(F.col("rendered_at")).alias("ref_month"), F.col("target").alias("key"))
    )
    outer = links.filter("title is not null and namespace is null").select(
        F.lit("links").alias("table_name"), "source_page_id", F.col("title").alias("target"), utc_month_number(F.col("parsed_at")).alias("ref_month"), link_key(F.col("title")).alias("key")
    )
    return inner.unionByName(outer)


def _hashes(*columns: Column) -> tuple[Column, Column]:
    return F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns)


def build_bloom(keys: DataFrame, columns: list[str], *, expected: int, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bloom filter over the rows of ``columns`` as an array of 64-bit words on the driver (at most max_bits / 8 bytes).

    The bits are set by a distributed bit_or per word, combined on the map side, so the driver receives the finished
    words, never the keys. Repeated rows set the same bits.
    """
    bits = min(max_bits, 1 << max(10, math.ceil(math.log2(max(1, expected) * 10))))
    a, b = _hashes(*[F.col(c) for c in columns])
    probe = F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(PROBES)]))
    position = (F.col("_a") + F.col("_b") * F.col("_i")).bitwiseAND(F.lit(bits - 1))
    # ANSI overflow is avoided by halving the hashes before they are combined
    with_hash = keys.select(F.shiftright(a, 8).alias("_a"), F.shiftright(b, 8).alias("_b"), probe.alias("_i"))
    words = with_hash.select(position.alias("_p")).select(F.shiftright("_p", 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_p") % 64).cast("int")).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    got = words.toArrow()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[got["word"].to_numpy()] = got["bits"].to_numpy()
    return out


def probe_bloom(spark, words: np.ndarray, columns: list[str]) -> Column:
    """Boolean column: false proves that the key is in no parent row."""
    shared = spark.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def probe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        w = shared.value
        mask = np.int64(w.size * 64 - 1)
        for a, b in batches:
            x, y = a.to_numpy(np.int64) >> np.int64(8), b.to_numpy(np.int64) >> np.int64(8)
            hit = np.ones(len(x), dtype=bool)
            for i in range(PROBES):
                p = (x + y * np.int64(i)) & mask
                hit &= (w[p >> np.int64(6)] >> (p & np.int64(63))) & np.int64(1) == 1
            yield pd.Series(hit)

    return probe(*_hashes(*[F.col(c) for c in columns]))


def orphan_references(entries: DataFrame, links: DataFrame, *, max_bits: int = MAX_BITS) -> DataFrame:
    """(table_name, source_page_id, target, ref_month): each distinct reference whose key names no entry present in its own month.

    A reference without a month (null timestamp) is an orphan with a null month only if its key never exists; else it is
    left out, since no period can be named for it.
    """
    spark = entries.sparkSession
    # one row per parent key with its spans; read by the filter and by the verification, so it is written once
    parents = materialize(parent_spans(entries), "parents")
    bloom = build_bloom(parents, ["table_name", "key"], expected=parents.count(), max_bits=max_bits)
    # both verdicts, the verification and its return read the probed references, so they are written once
    refs = references(entries, links).withColumn("ref_month", F.coalesce("ref_month", F.lit(NEVER)))
    probed = materialize(refs.withColumn("_maybe", probe_bloom(spark, bloom, ["table_name", "key"])), "references")
    definite = probed.filter("not _maybe").drop("_maybe")
    doubtful = probed.filter("_maybe").drop("_maybe")
    asked = doubtful.groupBy("table_name", "key", "ref_month").agg(F.count(F.lit(1)).alias("n"))
    inside = F.exists("spans", lambda s: (F.col("ref_month") == NEVER) | ((s["month_from"] <= F.col("ref_month")) & (F.col("ref_month") < s["month_to"])))
    on = ["table_name", "key", "ref_month"]
    # the exact equi-join of the distinct filter-positive keys, one row for each of them
    judged = asked.join(parents, ["table_name", "key"], "left").select(*on, "n", F.when(F.coalesce(inside, F.lit(False)), True).alias("there"))
    verdicts = materialize(judged, "verdicts")
    lost = verdicts.filter("there is null").select(*on)
    if lost.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        verified = doubtful.join(F.broadcast(lost), on, "left_semi")
    else:
        total = verdicts.agg(F.sum("n")).first()[0] or 0
        verified = attach(doubtful, verdicts, on, weight="n", total=total).filter("there is null")
    columns = ["table_name", "source_page_id", "target", "ref_month"]
    # repeated references are removed only among the orphans, which are the few
    found = definite.select(*columns).unionByName(verified.select(*columns)).distinct()
    return found.withColumn("ref_month", F.when(F.col("ref_month") != NEVER, month_text(F.col("ref_month"))))


def orphan_report(orphans: DataFrame) -> DataFrame:
    """(table_name, ref_month, orphans, sources): orphan references and the pages that hold them, per table and month."""
    per_source = orphans.groupBy("table_name", "ref_month", "source_page_id").agg(F.count(F.lit(1)).alias("_n"))
    return per_source.groupBy("table_name", "ref_month").agg(F.sum("_n").alias("orphans"), F.count(F.lit(1)).alias("sources"))
