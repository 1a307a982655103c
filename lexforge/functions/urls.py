"""Internal and external link addresses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexforge.functions.strings import strip

# Namespaces that a colon in a title can part off.
NAMESPACES = (
    "Category", "Template", "File", "Talk", "User", "Wikipedia", "Help", "Portal", "Module", "MediaWiki", "Special",
    "User talk", "Template talk", "Category talk", "File talk", "Wikipedia talk", "Help talk", "Portal talk", "Module talk", "MediaWiki talk",
    "カテゴリ", "テンプレート", "ファイル", "特別", "利用者", "利用者‐会話", "Wikipedia‐ノート", "ヘルプ", "ポータル", "モジュール",
)


def unquote(c: Column) -> Column:
    """Percent-decoding in which ``+`` stays a plus; a malformed text comes back as it is."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def base_url(url: Column) -> Column:
    """Scheme and host of an address; null if it has none."""
    return F.nullif(F.regexp_extract(url, r"^(https?://[^/]+)", 1), F.lit(""))


def parse_internal(url: Column, bases: tuple[str, ...] = ()) -> Column:
    """struct(namespace, title, fragment) of an internal address, null for any other.

    Internal are ``./x``, ``/wiki/x`` and ``<base>/wiki/x``. The query is cut off before the fragment is split; title and
    fragment are percent-decoded, underscores are blanks; a known namespace before a colon is parted off.
    """
    path = F.when(url.startswith("./"), F.substring(url, F.lit(3), F.length(url))).when(url.startswith("/wiki/"), F.substring(url, F.lit(7), F.length(url)))
    for base in bases:
        prefix = base.rstrip("/") + "/wiki/"
        path = path.when(url.startswith(prefix), F.substring(url, F.lit(len(prefix) + 1), F.length(url)))
    path = F.substring_index(path, "?", 1)
    fragment = F.nullif(F.when(path.contains("#"), unquote(F.regexp_extract(path, r"^[^#]*#(.*)$", 1))), F.lit(""))
    title = strip(F.replace(unquote(F.substring_index(path, "#", 1)), F.lit("_"), F.lit(" ")))
    prefix = F.substring_index(title, ":", 1)
    rest = F.regexp_replace(title, r"^[^:]*:", "")
    spaced = title.contains(":") & prefix.isin(*NAMESPACES) & (rest != "")
    parsed = F.struct(F.when(spaced, prefix).alias("namespace"), F.when(spaced, rest).otherwise(title).alias("title"), fragment.alias("fragment"))
    return F.when(F.coalesce(title, F.lit("")) != "", parsed)


def is_safe_external(url: Column) -> Column:
    """http, https or protocol-relative with a host."""
    return F.coalesce(url.rlike(r"(?i)^(https?:)?//[^/?#\s]+"), F.lit(False))


def external_label(label: Column, url: Column) -> Column:
    """An external link as plain text: the label, with the address behind it if that is safe and differs."""
    return F.when(is_safe_external(url) & (label != url), F.concat(label, F.lit(" ("), url, F.lit(")"))).otherwise(label)


def is_https(url: Column) -> Column:
    """https with a host."""
    return F.coalesce(url.rlike(r"^(?i:https)://[^/?#\s]+"), F.lit(False))


def source_name(url: Column) -> Column:
    """File name at the end of an address's path, decoded; null if empty."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*|^//[^/?#]*", ""), r"[?#].*$", "")
    return F.nullif(unquote(F.substring_index(path, "/", -1)), F.lit(""))
