"""Stratified and systematic samples."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.session import materialize

# Signals of the strata.
LONG_BYTES = 100_000
MANY_TABLES = 3
RARE = r"[\x{3400}-\x{4DBF}\x{20000}-\x{10FFFF}\p{Co}\p{Cn}]"


def strata(*, title: Column, html: Column, categories: Column, has_image: Column) -> Column:
    """Array of the strata of an article, ``baseline`` if none."""
    body = F.coalesce(html, F.lit(""))
    names = F.coalesce(categories, F.array().cast("array<string>"))
    any_name = lambda pattern: F.exists(names, lambda c: F.coalesce(c.rlike(pattern), F.lit(False)))
    tests = (
        (F.octet_length(body) >= LONG_BYTES, "long_article"),
        (F.regexp_count(body, F.lit(r"(?i)<table\b")) >= MANY_TABLES, "table_heavy"),
        (F.coalesce(has_image, F.lit(False)), "image_heavy"),
        (body.rlike(r"(?i)<math\b"), "math_heavy"),
        (any_name("曖昧さ回避"), "disambiguation"),
        (F.coalesce(title.rlike(r"(?i)の一覧$|^List of "), F.lit(False)), "list_article"),
        (any_name("歴史|文学"), "history_or_literature"),
        (any_name("技術|工学|コンピュータ|情報科学"), "technical"),
        (F.coalesce(title.rlike(RARE), F.lit(False)) | body.rlike(RARE), "rare_unicode"),
    )
    found = F.filter(F.array(*[F.when(t, n) for t, n in tests]), lambda x: x.isNotNull())
    return F.when(F.size(found) == 0, F.array(F.lit("baseline"))).otherwise(found)


def stratified(signals: DataFrame, *, key: str, arrival: str, total: int, per_stratum: int) -> DataFrame:
    """(key): greedy first-seen stratified sample.

    In arrival order an article is taken if one of its strata other than baseline is under its quota and the total
    allows; it counts toward all its strata. The rest is filled with baseline articles in arrival order.

    While a stratum is under its quota every row of it is taken, so only its first ``per_stratum`` rows in arrival order
    can ever be taken on its account. The ordered fold therefore runs on the driver over at most strata * per_stratum
    narrow rows, whatever the input, and the result is exact.
    """
    spark = signals.sparkSession
    each = signals.select(F.col(key).alias("k"), F.col(arrival).alias("a"), F.explode("strata").alias("s"))
    special = each.filter("s != 'baseline'")
    near = special.withColumn("r", F.row_number().over(Window.partitionBy("s").orderBy("a", "k"))).filter(F.col("r") <= per_stratum)
    rows = near.select("k").distinct().join(signals.select(F.col(key).alias("k"), F.col(arrival).alias("a"), "strata"), "k").orderBy("a", "k").collect()
    taken: list = []
    counts: Counter = Counter()
    for r in rows:
        if len(taken) < total and any(s != "baseline" and counts[s] < per_stratum for s in r["strata"]):
            taken.append(r["k"])
            counts.update(r["strata"])
    rest = [r["k"] for r in each.filter("s = 'baseline'").orderBy("a", "k").limit(max(0, total - len(taken))).collect()]
    kind = dict(signals.dtypes)[key]
    return spark.createDataFrame([(k,) for k in taken + rest], f"`{key}` {kind}")


def stratum_counts(signals: DataFrame, chosen: DataFrame, *, key: str) -> DataFrame:
    """(stratum, found, selected)."""
    marked = signals.join(chosen.select(key).withColumn("_in", F.lit(1)), key, "left")
    return marked.select(F.explode("strata").alias("stratum"), F.coalesce("_in", F.lit(0)).alias("_in")).groupBy("stratum").agg(F.count(F.lit(1)).alias("found"), F.sum("_in").alias("selected"))


def extract(raw: DataFrame, chosen: DataFrame, *, key: str) -> DataFrame:
    """The full rows of the chosen keys."""
    return raw.join(chosen.select(key), key, "left_semi")


def systematic(df: DataFrame, *, key: str, size: int) -> DataFrame:
    """Every (count // size)-th row in key order, ``size`` at most.

    Row numbers come from range partitions and their counts: two passes over the key, none of them in one task. The
    ranges are as many as shuffle partitions, so their offsets are a small broadcast.
    """
    total = df.count()
    stride = max(1, total // size)
    # range bounds are sampled anew whenever a plan runs, so the partitioned keys are written once
    parts = materialize(df.select(key).repartitionByRange(F.col(key)).withColumn("_p", F.spark_partition_id()), "ranges")
    inside = parts.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(key)))
    ranges = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_lo"))
    offsets = ranges.select("_p", (F.sum("_n").over(Window.orderBy("_lo")) - F.col("_n")).alias("_before"))
    numbered = inside.join(F.broadcast(offsets), "_p").withColumn("_rn", F.col("_i") + F.col("_before"))
    picked = numbered.filter(((F.col("_rn") - 1) % stride == 0) & ((F.col("_rn") - 1) / stride < size))
    return picked.select(key)
