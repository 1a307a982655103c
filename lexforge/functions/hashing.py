"""Content hashes, order-independent set hashes and canonical JSON."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_hash(c: Column) -> Column:
    """sha256 in lower-case hexadecimal digits."""
    return F.sha2(c, 256)


def sorted_hash(items: Column) -> Column:
    """Hash of an array that ignores its order; null counts as an empty array."""
    return F.sha2(F.to_json(F.array_sort(F.coalesce(items, F.array().cast("array<string>")))), 256)


def article_logical_hash(*, ordered: list[Column], unordered: list[Column]) -> Column:
    """Hash of a row in which array columns of ``unordered`` are compared as multisets."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in ordered] + [sorted_hash(c) for c in unordered]
    return F.sha2(F.concat_ws("\x1f", *[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]), 256)


def stream_set_hash(streams: DataFrame, *, name: str, content: str, by: str) -> DataFrame:
    """(by, set_hash): one hash per group that does not depend on the order of its streams.

    Each stream is reduced to a 64-digit hash before the shuffle. Hashes are added modulo 2**62 in two halves rather
    than collected, so a group of any size is combined on the map side.
    """
    framed = F.sha2(F.concat(F.length(name).cast("string"), F.lit(":"), F.col(name), F.lit(":"), F.sha2(F.coalesce(F.col(content), F.lit("")), 256)), 256)
    limb = lambda k: F.conv(F.substring("_h", 1 + 8 * k, 8), 16, 10).cast("bigint")
    sums = [F.sum(limb(k)).alias(f"_s{k}") for k in range(8)]
    grouped = streams.select(by, framed.alias("_h")).groupBy(by).agg(F.count(F.lit(1)).alias("_n"), *sums)
    return grouped.select(by, F.sha2(F.concat_ws(",", "_n", *[f"_s{k}" for k in range(8)]), 256).alias("set_hash"))


def canonical_json(value: object) -> str:
    """Sorted keys, compact separators, no ASCII escaping."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def file_fingerprint(path: str, chunk: int = 1 << 20) -> tuple[int, str]:
    """(size, sha256) of a local file, read in chunks."""
    h, size = hashlib.sha256(), 0
    with open(path, "rb") as f:
        while data := f.read(chunk):
            h.update(data)
            size += len(data)
    return size, h.hexdigest()


def combined_fingerprint(parts: Iterable[tuple[str, int, str]]) -> str:
    """Fingerprint of a set of files from sorted (relative path, size, sha256)."""
    return hashlib.sha256("\n".join(f"{p}\x1f{s}\x1f{h}" for p, s, h in sorted(parts)).encode()).hexdigest()
