"""Relational integrity checks of stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n) of keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def missing_parents(child: DataFrame, foreign: str, parent: DataFrame, primary: str) -> DataFrame:
    """(foreign, n): non-null foreign keys without a parent, with the rows that hold them.

    The child is reduced to distinct keys with counts first, so a hot key is one row in the join.
    """
    asked = child.filter(F.col(foreign).isNotNull()).groupBy(foreign).agg(F.count(F.lit(1)).alias("n"))
    return asked.join(parent.select(F.col(primary).alias("_p")), F.col(foreign) == F.col("_p"), "left_anti")


def entry_issues(entries: DataFrame, *, tag: str = "tag", title: str = "title", targets: str = "targets") -> DataFrame:
    """(code, tag, detail): EMPTY_TAG, DUPLICATE_TAG, EMPTY_TITLE and UNKNOWN_TARGET.

    A tag that occurs n times has n - 1 DUPLICATE_TAG rows; each missing target of an entry is one row per mention.
    """
    rows = entries.select(F.col(tag).alias("tag"), F.col(title).alias("title"), F.col(targets).alias("targets"))
    empty = F.coalesce(F.col("tag"), F.lit("")) == ""
    empty_tag = rows.filter(empty).select(F.lit("EMPTY_TAG").alias("code"), "tag", F.lit("").alias("detail"))
    tagged = rows.filter(~empty)
    empty_title = tagged.filter(F.coalesce(F.col("title"), F.lit("")) == "").select(F.lit("EMPTY_TITLE").alias("code"), "tag", F.lit("").alias("detail"))
    counts = tagged.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = counts.select(F.lit("DUPLICATE_TAG").alias("code"), "tag", F.lit("").alias("detail"), F.explode(F.sequence(F.lit(2), F.col("n").cast("int"))).alias("_i")).drop("_i")
    asked = rows.select("tag", F.explode("targets").alias("detail"))
    lost = asked.select("detail").distinct().join(tagged.select(F.col("tag").alias("_t")).distinct(), F.col("detail") == F.col("_t"), "left_anti")
    unknown = asked.join(lost, asked["detail"].eqNullSafe(lost["detail"]), "left_semi").select(F.lit("UNKNOWN_TARGET").alias("code"), "tag", "detail")
    return empty_tag.unionByName(empty_title).unionByName(repeated).unionByName(unknown)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) of several tables in one plan."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def unverified(done: DataFrame, planned: DataFrame, key: str) -> DataFrame:
    """Planned rows whose key is not done yet (J12, Z05, Z07): the resume form of a stage."""
    return planned.join(done.select(F.col(key).alias("_d")).distinct(), F.col(key) == F.col("_d"), "left_anti")
