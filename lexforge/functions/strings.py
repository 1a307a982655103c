"""Text keys, variants and clean-ups as column expressions.

Built-in functions wherever Spark has them; NFKC, NFC and case folding need Python and run as Arrow batches, with ASCII
text (for which they are trivial) short-cut.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of Unicode as a character class that both Java and RE2 read alike.
BLANK = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

#: A function from a text column to its lookup key.
Key = Callable[[Column], Column]

_HIRAGANA = "".join(map(chr, range(0x3041, 0x3097)))
_KATAKANA = "".join(map(chr, range(0x30A1, 0x30F7)))


def _mapped(function: Callable[[str], str | None]) -> Callable[[Column], Column]:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else function(t))

    return run


def strip(c: Column) -> Column:
    """``c`` without white space of any kind at its ends."""
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def nfkc_title(c: Column) -> Column:
    """Title as a lookup key: NFKC and strip, case kept."""
    return _mapped(lambda t: t.strip() if t.isascii() else unicodedata.normalize("NFKC", t).strip())(c)


def index_key(c: Column) -> Column:
    """Search key: NFKC, case folding, runs of white space as one blank, stripped; null where nothing is left."""
    return _mapped(lambda t: " ".join(unicodedata.normalize("NFKC", t).casefold().split()) or None)(c)


def basic_key(c: Column) -> Column:
    """``index_key`` in built-in functions: lower case instead of case folding, no NFKC. Equal for plain text."""
    return F.nullif(strip(F.regexp_replace(F.lower(c), f"{BLANK}+", " ")), F.lit(""))


def without_spaces(key: Column) -> Column:
    """Variant without white space; null if unchanged."""
    return F.nullif(F.regexp_replace(key, BLANK, ""), key)


def kana_swapped(key: Column) -> Column:
    """Variant with hiragana and katakana exchanged; null if unchanged."""
    return F.nullif(F.translate(key, _HIRAGANA + _KATAKANA, _KATAKANA + _HIRAGANA), key)


def without_punctuation(key: Column) -> Column:
    """Variant without punctuation of any category; null if unchanged or empty."""
    bare = F.regexp_replace(key, r"\p{P}", "")
    return F.nullif(F.nullif(bare, key), F.lit(""))


def parenthetical_base(title: Column) -> Column:
    """Title without a closing parenthesis group, e.g. ``Orb (film)`` -> ``Orb``; null if there is none."""
    base = strip(F.regexp_extract(title, rf"^(.+?){BLANK}*[(（][^()（）]+[)）]$", 1))
    return F.nullif(base, F.lit(""))


def normalize_whitespace(c: Column) -> Column:
    """Line ends as LF, control characters (but LF) and zero-width characters dropped, then white space runs as one blank.

    Controls go first, so a tab vanishes instead of becoming a blank.
    """
    lines = F.regexp_replace(c, "\r\n?", "\n")
    shown = F.regexp_replace(lines, r"[\x{00}-\x{09}\x{0B}-\x{1F}\x{7F}-\x{9F}]", "")
    return F.regexp_replace(F.regexp_replace(shown, r"[\x{200B}\x{200C}\x{200D}\x{FEFF}]", ""), r"[ \t\n\r\f\x{0B}]+", " ")


def safe_substitutions(c: Column) -> Column:
    """NFC, no-break blank as blank, curly quotes as ASCII, variation selectors dropped."""
    swapped = F.translate(c, " ‘’“”", " ''\"\"")
    bare = F.regexp_replace(swapped, r"[\x{FE00}-\x{FE0F}\x{E0100}-\x{E01EF}]", "")
    return _mapped(lambda t: t if t.isascii() else unicodedata.normalize("NFC", t))(bare)


def variation_selectors(c: Column) -> Column:
    """The variation selectors of a text in order, one diagnostic each (X11)."""
    return F.regexp_extract_all(c, F.lit(r"[\x{FE00}-\x{FE0F}\x{E0100}-\x{E01EF}]"), F.lit(0))


def selector_diagnostics(texts: DataFrame, key: str, column: str) -> DataFrame:
    """(key, ordinal, code_point, code): one row for each variation selector that ``safe_substitutions`` drops (X11)."""
    each = texts.select(key, F.posexplode(variation_selectors(F.col(column))).alias("ordinal", "_s"))
    return each.select(key, "ordinal", F.format_string("U+%04X", F.ascii("_s")).alias("code_point"), F.lit("TEXT_VARIATION_SELECTOR_REMOVED").alias("code"))


def strip_keeping_markers(c: Column) -> Column:
    """Strip white space but keep the control markers 0x1E and 0x1F, which Python's strip would take."""
    return F.regexp_replace(c, r"^[ \t\n\r\f\x{0B}\x{3000}\x{A0}]+|[ \t\n\r\f\x{0B}\x{3000}\x{A0}]+$", "")


# A line of its own between blank ones, as Markdown, wikitext and rendered entries write headings; a block of fenced code.
_HEADING_LINE = r"\n[ \t]*\n(?:(?:#{1,6}|■)[ \t]+\S[^\n]*|={2,6}[ \t]*[^\s=][^\n]*=[ \t]*)(?:\n[ \t]*\n|\s*\z)"
_FENCED = r"(?ms)^{0}{0}{0}+[^\n]*\n.*?^{0}{0}{0}+[ \t]*$"


def lead_text(text: Column) -> Column:
    """A plain text up to its first heading below the top, without fenced code (for X05)."""
    prose = F.regexp_replace(F.regexp_replace(text, _FENCED.format("`"), ""), _FENCED.format("~"), "")
    return F.regexp_replace(prose, rf"(?s){_HEADING_LINE}.*$", "")


def reading(title: Column, paragraphs: Column) -> Column:
    """Kana reading that the lead gives behind the title, ``title (reading, ...)``, as hiragana (X05); null if there is none.

    The title counts without a closing parenthesis group. Its places are tried in order in each of the lead's
    ``paragraphs`` (an array); of a parenthesis of at most 128 characters the first part that is all kana counts, with
    reference marks such as [1] left out.
    """
    base = strip(F.regexp_replace(title, rf"{BLANK}*[（(][^（）()]+[）)]$", ""))
    literal = F.concat(F.lit("\\Q"), F.replace(base, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    place = F.concat(literal, F.lit(rf"[』」]?{BLANK}*[（(]([^）)]{{1,128}})[）)]"))
    brackets = F.flatten(F.transform(paragraphs, lambda p: F.regexp_extract_all(p, place, F.lit(1))))
    parts = F.flatten(F.transform(brackets, lambda x: F.split(F.regexp_replace(x, r"\[[0-9]+\]", ""), "[、,，/／]")))
    kana = F.filter(F.transform(parts, strip), lambda x: x.rlike("^[ぁ-ゖァ-ヶー]+$"))
    return F.when(base != "", F.translate(F.get(kana, F.lit(0)), _KATAKANA, _HIRAGANA))


def code_point_fallback(c: Column) -> Column:
    """``[U+XXXX]`` of the first character."""
    return F.format_string("[U+%04X]", F.ascii(c))


# Signs a dictionary backend drops from keys.
_DROPPED = " '-・／＿‐−"


def backend_key(c: Column) -> Column:
    """Backend key: some signs dropped, ASCII in upper case and full width; null if nothing is left."""
    narrow = "".join(map(chr, range(0x21, 0x7F)))
    upper = "".join(chr(0xFEE0 + ord(x.upper())) for x in narrow)
    return F.nullif(F.translate(F.translate(c, _DROPPED, ""), narrow, upper), F.lit(""))


def entry_tag(page_id: Column) -> Column:
    """``p<page_id>``."""
    return F.concat(F.lit("p"), page_id.cast("string"))


def human_size(size: Column) -> Column:
    """Bytes in a readable unit, base 1024."""
    unit = F.when(size < 1024, 0).when(size < 1 << 20, 1).when(size < 1 << 30, 2).otherwise(3)
    value = size / F.pow(F.lit(1024.0), unit)
    return F.concat(F.format_number(value, 1), F.element_at(F.array(*[F.lit(u) for u in (" B", " KiB", " MiB", " GiB")]), unit + 1))


def html_escape(c: Column) -> Column:
    """``& < > " '`` as character references."""
    out = c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out
