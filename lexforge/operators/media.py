"""Media plans, fetch bookkeeping, content checks and deduplication."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Columns of a fetch's outcomes, one JSON line each.
OUTCOME = "source_url string, status string, content_sha256 string, at string"
_UNSAFE_SVG = ("script", "foreignobject")


def sniff(content: Column) -> Column:
    """Format by magic bytes: png, jpeg, gif, webp, bmp or svg; null for anything else."""
    head = F.hex(F.substring(content, 1, 16))
    text = F.lower(F.decode(F.substring(content, 1, 512), "ISO-8859-1"))
    return (
        F.when(head.startswith("89504E470D0A1A0A"), "png").when(head.startswith("FFD8FF"), "jpeg").when(head.startswith("474946383761") | head.startswith("474946383961"), "gif")
        .when(head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250"), "webp").when(head.startswith("424D"), "bmp").when(text.rlike(r"^\s*(<\?xml[^>]*>\s*)?(<!--.*?-->\s*)*<svg\b"), "svg")
    )


def png_pixels(content: Column) -> Column:
    """Pixels of a PNG header; null for other formats."""
    n = lambda at: F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("bigint")
    return F.when(sniff(content) == "png", n(17) * n(21))


def media_problem(content: Column, declared: Column, *, max_pixels: int = 50_000_000) -> Column:
    """Null for sound media, else why it is refused."""
    kind = sniff(content)
    said = F.regexp_replace(F.lower(F.regexp_extract(declared, r"^image/([A-Za-z0-9.+-]+)", 1)), r"\+xml$|^x-", "")
    return F.when(kind.isNull(), "unknown_format").when((said != "") & (F.replace(said, F.lit("jpg"), F.lit("jpeg")) != kind), "type_mismatch").when(png_pixels(content) > max_pixels, "too_many_pixels")


def sanitize_svg(content: bytes) -> bytes:
    """SVG without scripts, foreign objects, event attributes and javascript addresses (F12). Declarations are refused."""
    if re.search(rb"<!\s*(DOCTYPE|ENTITY)", content, re.I):
        raise ValueError("declarations are not allowed in SVG")
    root = ET.fromstring(content)
    local = lambda name: name.rsplit("}", 1)[-1].lower()
    for parent in list(root.iter()):
        for child in list(parent):
            if isinstance(child.tag, str) and local(child.tag) in _UNSAFE_SVG:
                parent.remove(child)
        for name in list(parent.attrib):
            if local(name).startswith("on") or (local(name) == "href" and parent.attrib[name].strip().lower().startswith("javascript:")):
                del parent.attrib[name]
    return ET.tostring(root)


def sanitized(content: Column) -> Column:
    """``sanitize_svg`` over a column; null where the content is refused."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(b):
            try:
                return None if b is None else sanitize_svg(bytes(b))
            except (ValueError, ET.ParseError):
                return None

        for s in batches:
            yield s.map(one)

    return run(content)


def plan(media: DataFrame, articles: DataFrame, *, pages: DataFrame | None = None) -> DataFrame:
    """(source_url, media_id, uses): addresses to fetch of articles that are not rejected (J06, F08). An empty ``pages`` frame selects nothing."""
    wanted = articles.filter("normalize_status != 'rejected'").select("page_id")
    if pages is not None:
        wanted = wanted.join(pages.select("page_id").distinct(), "page_id", "left_semi")
    return media.join(wanted, "page_id", "left_semi").groupBy("source_url").agg(F.min("media_id").alias("media_id"), F.count(F.lit(1)).alias("uses"))


def unfetched(planned: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Planned addresses without a successful outcome."""
    done = outcomes.filter("status = 'ok'").select(F.col("source_url").alias("_u")).distinct()
    return planned.join(done, F.col("source_url") == F.col("_u"), "left_anti")


def rebuild_report(planned: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Last outcome of each planned address; outcomes of unknown addresses are skipped (S29). Input: (source_url, status, content_sha256, at)."""
    last = outcomes.groupBy("source_url").agg(F.max_by(F.struct("status", "content_sha256"), "at").alias("o"))
    return planned.join(last, "source_url", "left").select(*planned.columns, F.coalesce("o.status", F.lit("pending")).alias("status"), F.col("o.content_sha256").alias("content_sha256"))


def first_by_content(media: DataFrame, *, content_hash: str, order: list[str]) -> DataFrame:
    """One row per content hash, the first in order (D05); rows without a hash stay."""
    known = media.filter(F.col(content_hash).isNotNull())
    first = known.withColumn("_rn", F.row_number().over(Window.partitionBy(content_hash).orderBy(*order))).filter("_rn = 1").drop("_rn")
    return first.unionByName(media.filter(F.col(content_hash).isNull()))


def is_licensed(license_identifier: Column) -> Column:
    """(F10)"""
    return license_identifier.isNotNull()
