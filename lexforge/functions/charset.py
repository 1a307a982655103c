"""Rare characters of a corpus: histogram, classes, bounded code plan and embedding.

Everything per character runs on distinct characters after the corpus-wide histogram (bounded by Unicode), so Python
sees some thousands of rows whatever the corpus; the histogram itself is a built-in, map-side combined aggregation.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.session import broadcast_if_small, materialize

#: Codes per width class of the dictionary format (fixed value).
MAX_PER_WIDTH = 8192


def characters(texts: DataFrame, column: str) -> DataFrame:
    """(ch): one row per code point of every text."""
    return texts.select(F.explode(F.split(F.col(column), "")).alias("ch")).filter("ch != ''")


def histogram(texts: DataFrame, column: str) -> DataFrame:
    """(ch, n): how often each character occurs in the whole corpus."""
    return characters(texts, column).groupBy("ch").agg(F.count(F.lit(1)).alias("n"))


def is_representable(ch: str) -> bool:
    """Whether the backend's character set (EUC-JP without its third plane) has the character."""
    try:
        return not ch.encode("euc_jp").startswith(b"\x8f")
    except UnicodeEncodeError:
        return False


def width_of(ch: str) -> str:
    """``wide`` for East Asian wide and full-width characters, else ``narrow``."""
    return "wide" if unicodedata.east_asian_width(ch[0]) in ("W", "F") else "narrow"


def class_of(ch: str) -> str:
    """A representable, B substitutable, C needs a glyph, D control, format, surrogate, private or unassigned."""
    if is_representable(ch):
        return "A"
    if ch in " ‘’“”" or 0xFE00 <= ord(ch) <= 0xFE0F or 0xE0100 <= ord(ch) <= 0xE01EF:
        return "B"
    return "D" if unicodedata.category(ch) in ("Cc", "Cf", "Cs", "Co", "Cn") else "C"


def classify(chars: DataFrame, column: str = "ch") -> DataFrame:
    """``chars`` plus char_class and width_class; meant for distinct characters."""

    @F.pandas_udf("struct<char_class:string,width_class:string>")
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"char_class": s.map(class_of), "width_class": s.map(width_of)})

    got = run(F.col(column))
    return chars.withColumn("_c", got).select("*", "_c.char_class", "_c.width_class").drop("_c")


def code_plan(counts: DataFrame, *, per_width: int = MAX_PER_WIDTH) -> DataFrame:
    """(ch, n, width_class, code): the most frequent characters of each width class with dense codes in code-point order.

    Beyond ``per_width`` characters have a null code (overflow). Rows are distinct characters, so the windows are bounded.
    """
    rank = F.row_number().over(Window.partitionBy("width_class").orderBy(F.desc("n"), "ch"))
    ranked = counts.withColumn("_kept", rank <= per_width)
    number = F.row_number().over(Window.partitionBy("width_class", "_kept").orderBy("ch"))
    code = F.when(F.col("_kept"), F.concat("width_class", F.lit("-"), F.lpad(number.cast("string"), 4, "0")))
    return ranked.select("ch", "n", "width_class", code.alias("code"))


def overflow(plan: DataFrame) -> DataFrame:
    """(width_class, kept, overflow_chars, overflow_uses) (A10)."""
    lost = F.col("code").isNull()
    return plan.groupBy("width_class").agg(F.count_if(~lost).alias("kept"), F.count_if(lost).alias("overflow_chars"), F.sum(F.when(lost, F.col("n")).otherwise(0)).alias("overflow_uses"))


def unrepresentable_examples(texts: DataFrame, key: str, column: str, *, examples: int = 5) -> DataFrame:
    """(ch, n, examples): unrepresentable characters by frequency, each with the first keys that hold it."""
    each = texts.select(F.col(key).alias("k"), F.explode(F.split(F.col(column), "")).alias("ch")).filter("ch != ''")
    rare = materialize(classify(each.groupBy("ch").agg(F.count(F.lit(1)).alias("n"))).filter("char_class != 'A'").select("ch", "n"), "rare")
    held = each.join(broadcast_if_small(rare.select("ch")), "ch", "left_semi").distinct()
    # the rank filter lets Spark keep the first few per character before the shuffle
    first = held.withColumn("_r", F.row_number().over(Window.partitionBy("ch").orderBy("k"))).filter(F.col("_r") <= examples)
    kept = first.groupBy("ch").agg(F.sort_array(F.collect_list("k")).alias("examples"))
    return rare.join(kept, "ch")


def most_frequent(examples: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` most frequent unrepresentable characters, most frequent first, then by code point."""
    return examples.orderBy(F.desc("n"), "ch").limit(limit)


def unrepresentable(text: Column) -> Column:
    """The unrepresentable characters of a text in order (X18); null for null."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else [] if t.isascii() else [c for c in t if not is_representable(c)])

    return run(text)


def embed(text: Column, plan: DataFrame) -> Column:
    """Text with planned characters as ``[code]`` tokens and the rest of the rare ones as ``[U+XXXX]``.

    ``plan`` holds at most two times MAX_PER_WIDTH codes; it is collected into the expression's translation table.
    """
    codes = {r["ch"]: f"[{r['code']}]" for r in plan.filter("code is not null").select("ch", "code").collect()}
    shared = text_context(plan).broadcast(codes)

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        known = shared.value

        def one(t):
            if t is None or t.isascii():
                return t
            return "".join(c if is_representable(c) else known.get(c, f"[U+{ord(c):04X}]") for c in t)

        return s.map(one)

    return run(text)


def text_context(df: DataFrame):
    return df.sparkSession.sparkContext


def title_fallback(text: Column) -> Column:
    """Titles and keys get code-point fallbacks only."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: t if t is None or t.isascii() else "".join(c if is_representable(c) else f"[U+{ord(c):04X}]" for c in t))

    return run(text)


def rewrite_tokens(text: Column, plan: DataFrame) -> Column:
    """``[narrow-0001]`` tokens whose code the plan no longer has, as code-point fallbacks (X17). Unknown codes fail.

    ``plan`` has (code, ch, kept).
    """
    table = {r["code"]: None if r["kept"] else f"[U+{ord(r['ch']):04X}]" for r in plan.select("code", "ch", "kept").collect()}
    shared = text_context(plan).broadcast(table)

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        import re

        def swap(m):
            if m[1] not in shared.value:
                raise ValueError(f"unknown code {m[1]}")
            return shared.value[m[1]] or m[0]

        return s.map(lambda t: None if t is None else re.sub(r"\[((?:narrow|wide)-\d{4})\]", swap, t))

    return run(text)
