"""Article records from newline-delimited JSON and from tar.gz chunks with one such member."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lexforge.functions.times import iso_instant
from lexforge.sources.schema import ARTICLE

#: Bytes a line may have beyond its two bodies (fixed value).
LINE_SLACK = 8 << 20


def max_line_bytes(max_html: int = 64 << 20, max_wikitext: int = 64 << 20) -> int:
    """Line cap that lets an oversized field reach its own check."""
    return max_html + max_wikitext + LINE_SLACK


def tar_lines(stream: io.BufferedIOBase, cap: int) -> Iterator[bytes]:
    """Lines of the single ``*.ndjson`` member of a tar.gz (S01); blank lines are skipped, only LF ends a line.

    Another member, a member that is no regular file, none at all, or a line over ``cap`` bytes is an error.
    """
    with tarfile.open(fileobj=stream, mode="r|gz") as archive:
        seen = False
        for member in archive:
            if seen or not member.isfile() or not member.name.endswith(".ndjson"):
                raise ValueError(f"unexpected archive member {member.name!r}")
            seen = True
            body = archive.extractfile(member)
            while line := body.readline(cap + 1):
                if len(line) > cap:
                    raise ValueError(f"a line of {member.name!r} exceeds {cap} bytes")
                if line.strip():
                    yield line.rstrip(b"\n")
        if not seen:
            raise ValueError("the archive has no member")


def open_stream(path: str) -> io.BufferedIOBase:
    """A file as a stream of bytes: a local path, or an address of a store that Arrow reads (file, hdfs, s3, gs)."""
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_stream(inner, compression=None)


def create_stream(path: str) -> io.BufferedIOBase:
    """A new file as a stream, with the folders above it; the counterpart of ``open_stream``."""
    if "://" not in path:
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        return open(path, "wb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    system.create_dir(inner.rsplit("/", 1)[0])
    return system.open_output_stream(inner, compression=None)


class _Chunk(InputPartition):
    def __init__(self, ordinal: int, path: str):
        self.ordinal, self.path = ordinal, path


class _ChunkReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = sorted(options["paths"].split(","))
        self.cap = int(options.get("maxLineBytes", max_line_bytes()))

    def partitions(self):
        return [_Chunk(i, p) for i, p in enumerate(self.paths)]

    def read(self, part: _Chunk):
        with open_stream(part.path) as f:
            for no, line in enumerate(tar_lines(f, self.cap)):
                yield part.ordinal, no, line.decode("utf-8", "replace")


class ChunkSource(DataSource):
    """Batch source ``ndjson_chunks``: option ``paths`` (comma separated, on storage all workers see), one task per chunk."""

    @classmethod
    def name(cls) -> str:
        return "ndjson_chunks"

    def schema(self) -> str:
        return "chunk_ordinal int, line_no bigint, value string"

    def reader(self, schema) -> DataSourceReader:
        return _ChunkReader(self.options)


def read_chunks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(chunk_ordinal, line_no, value) of tar.gz chunks; the two numbers are the arrival order."""
    spark.dataSource.register(ChunkSource)
    return spark.read.format("ndjson_chunks").option("paths", ",".join(paths)).load()


class _Lines(io.RawIOBase):
    """Lines as a readable stream, so that an archive member is written as they come."""

    def __init__(self, lines: Iterator[str]):
        self.lines, self.rest = lines, b""

    def read(self, size: int = -1) -> bytes:
        parts, n = [self.rest], len(self.rest)
        while (size < 0 or n < size) and (line := next(self.lines, None)) is not None:
            parts.append(line.encode() + b"\n")
            n += len(parts[-1])
        data = b"".join(parts)
        cut = len(data) if size < 0 else size
        self.rest = data[cut:]
        return data[:cut]


def write_chunks(lines: DataFrame, folder: str, *, chunks: int, column: str = "value") -> list[str]:
    """Write lines as at most ``chunks`` tar.gz files of one NDJSON member each below ``folder``; their paths in order.

    Lines are dealt out by their hash, each file is streamed by one task to storage that all workers see, and a repeated
    attempt writes the same file again. Null lines are left out.
    """
    base = folder.removeprefix("file://").removeprefix("file:")
    dealt = lines.filter(F.col(column).isNotNull()).select(F.pmod(F.xxhash64(column), F.lit(chunks)).cast("int").alias("_n"), F.col(column).alias("_line"))
    # a member's size stands before its bytes; one number per chunk reaches the driver
    sizes = {r["_n"]: r["s"] for r in dealt.groupBy("_n").agg(F.sum(F.octet_length("_line") + 1).alias("s")).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for number, own in groupby(rows, key=itemgetter(0)):
            path = f"{base}/chunk_{number:05d}.tar.gz"
            with create_stream(path) as out, tarfile.open(fileobj=out, mode="w|gz") as archive:
                info = tarfile.TarInfo(f"chunk_{number:05d}.ndjson")
                info.size = sizes[number]
                archive.addfile(info, _Lines(line for _, line in own))
            yield pa.RecordBatch.from_pydict({"path": [path]})

    spread = dealt.repartition(chunks, "_n").sortWithinPartitions("_n")
    return sorted(r["path"] for r in spread.mapInArrow(run, "path string").collect())


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """(value, chunk_ordinal, line_no) of plain NDJSON; only LF parts records, so U+2028 inside a string is safe.

    line_no is the position of the line within its file's split order; it orders lines of one file.
    """
    lines = spark.read.option("lineSep", "\n").text(path).filter("trim(value) != ''")
    at = F.col("_metadata.file_block_start") * F.lit(1 << 20) + F.monotonically_increasing_id() % F.lit(1 << 33)
    return lines.select("value", F.xxhash64(F.col("_metadata.file_path")).alias("chunk_ordinal"), at.alias("line_no"))


def parse_records(lines: DataFrame, *order: str) -> DataFrame:
    """Article columns, source_hash and reject_reason of raw lines.

    A record is rejected (reason not null, article columns may be null) if it is no JSON object, lacks a required field
    or holds a list of the wrong shape. Numbers written as strings or booleans are no integers: they do not parse.
    """
    parsed = lines.select(*order, "value", F.from_json("value", ARTICLE, {"mode": "PERMISSIVE"}).alias("r"), F.try_parse_json("value").alias("_v"))
    r = F.col("r")

    def kind(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get("_v", path, "variant"))

    def bad_names(field: str) -> Column:
        items = r[field]
        return (F.coalesce(kind(f"$.{field}"), F.lit("VOID")) != "VOID") & (items.isNull() | F.exists(items, lambda x: x.isNull() | (F.coalesce(x["name"], F.lit("")) == "")))

    def bad_license() -> Column:
        items = r["license"]
        hollow = lambda x: x.isNull() | (F.coalesce(x["identifier"], F.lit("")) == "") | (F.coalesce(x["name"], F.lit("")) == "") | (F.coalesce(x["url"], F.lit("")) == "")
        return (F.coalesce(kind("$.license"), F.lit("VOID")) != "VOID") & (items.isNull() | F.exists(items, hollow))

    reason = (
        F.when(F.col("_v").isNull(), "invalid_json")
        .when(~kind("$").startswith("OBJECT"), "not_an_object")
        .when(r["identifier"].isNull() | (kind("$.identifier") != "BIGINT"), "identifier")
        .when(r["version"]["identifier"].isNull() | (kind("$.version.identifier") != "BIGINT"), "version.identifier")
        .when(F.coalesce(r["name"], F.lit("")) == "", "name")
        .when(r["namespace"]["identifier"].isNull() | (kind("$.namespace.identifier") != "BIGINT"), "namespace.identifier")
        .when(F.coalesce(r["url"], F.lit("")) == "", "url")
        .when(iso_instant(r["date_modified"]).isNull(), "date_modified")
        .when(r["article_body"].isNull(), "article_body")
        .when(bad_names("redirects"), "redirects")
        .when(bad_names("categories"), "categories")
        .when(bad_names("templates"), "templates")
        .when(bad_license(), "license")
    )
    return parsed.select(*order, F.sha2("value", 256).alias("source_hash"), reason.alias("reject_reason"), "r.*")


def register_sources(spark: SparkSession) -> None:
    """Make the library's data sources available by name."""
    spark.dataSource.register(ChunkSource)


def read_xml_pages(spark: SparkSession, path: str, namespaces: tuple[int, ...] = (0,)) -> DataFrame:
    """(page_id, title, namespace_id, revision_id, text, redirect_title) of an XML dump (S13); compression by file name."""
    schema = "id bigint, title string, ns bigint, redirect struct<_title:string>, revision struct<id:bigint, text:struct<_VALUE:string>>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    named = pages.filter(F.col("ns").isin(*namespaces))
    text = F.col("revision.text._VALUE")
    target = F.coalesce("redirect._title", F.nullif(F.regexp_extract(text, r"(?i)^\s*#(?:redirect|転送)\s*:?\s*\[\[([^\]|#]+)", 1), F.lit("")))
    return named.select(F.col("id").alias("page_id"), "title", F.col("ns").alias("namespace_id"), F.col("revision.id").alias("revision_id"), text.alias("text"), target.alias("redirect_title"))
