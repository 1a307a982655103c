"""Source locks, query sets and settings: small control files of the driver."""

from __future__ import annotations

import json
import tarfile
import tomllib
from dataclasses import dataclass, field
from datetime import datetime, timezone
from itertools import islice
from pathlib import Path, PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lexforge.functions.hashing import canonical_json, file_fingerprint
from lexforge.sources.records import max_line_bytes, tar_lines
from lexforge.sources.schema import LOCK


def read_locks(spark: SparkSession, path: str) -> DataFrame:
    """Lock files as a table."""
    return spark.read.schema(LOCK).option("multiLine", True).json(path)


def validate_lock(lock: dict[str, Any]) -> list[str]:
    """Problems of a lock; empty if it is sound: concrete version, relative paths, sizes, 64-digit hashes, unique chunks."""
    out = []
    if lock.get("snapshot_version") in (None, "", "latest"):
        out.append("snapshot_version must be concrete")
    seen = set()
    for f in lock.get("files") or []:
        p = PurePosixPath(f.get("relative_path", ""))
        if p.is_absolute() or ".." in p.parts or not p.parts:
            out.append(f"unsafe path {str(p)!r}")
        if not isinstance(f.get("size_bytes"), int) or f["size_bytes"] < 0:
            out.append(f"bad size of {str(p)!r}")
        if len(f.get("sha256", "")) != 64 or any(c not in "0123456789abcdef" for c in f["sha256"]):
            out.append(f"bad sha256 of {str(p)!r}")
        if f.get("chunk_identifier") in seen:
            out.append(f"repeated chunk {f['chunk_identifier']!r}")
        seen.add(f.get("chunk_identifier"))
    if not lock.get("files"):
        out.append("no files")
    return out


def write_lock(lock: dict[str, Any], path: str) -> None:
    """Canonical JSON, written beside and renamed into place."""
    if problems := validate_lock(lock):
        raise ValueError("; ".join(problems))
    atomic_write(path, canonical_json(lock) + "\n")


def atomic_write(path: str, text: str) -> None:
    """All or nothing."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(target.name + ".part")
    part.write_text(text, encoding="utf-8")
    part.replace(target)


def register_local(files: list[str], *, project: str, namespace: int, snapshot_identifier: str, snapshot_version: str, date_modified: str, root: str, acquirer: dict[str, str] | None = None) -> dict[str, Any]:
    """A lock for local chunk files below ``root``."""
    entries = []
    for f in sorted(files):
        size, digest = file_fingerprint(f)
        entries.append({"relative_path": str(Path(f).relative_to(root)), "chunk_identifier": Path(f).name.split(".")[0], "size_bytes": size, "sha256": digest, "media_type": "application/gzip"})
    return {
        "schema_version": 1, "provider": "local", "project": project, "namespace": namespace, "snapshot_identifier": snapshot_identifier, "snapshot_version": snapshot_version, "date_modified": date_modified,
        "downloaded_at": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"), "files": entries, "supplements": [], "metadata_response_sha256": "0" * 64, "acquirer": acquirer or {"name": "lexforge", "version": "0.1.0", "git_commit": ""},
    }


def inspect_source(lock: dict[str, Any], root: str, *, sample: int = 0) -> list[dict[str, Any]]:
    """(relative_path, present, size_ok, sha256_ok) of each file of a lock.

    With a ``sample`` the archives are opened, too: ``problem`` says what is wrong with their members, null if nothing is,
    and ``records`` are the identifiers and names of the first ``sample`` records.
    """
    out = []
    for f in lock["files"]:
        p = Path(root, f["relative_path"])
        size, digest = file_fingerprint(str(p)) if p.is_file() else (None, None)
        problem, found = None, []
        if sample and p.is_file():
            try:
                with open(p, "rb") as stream:
                    for line in islice(tar_lines(stream, max_line_bytes()), sample):
                        record = json.loads(line)
                        found.append({"identifier": record.get("identifier"), "name": record.get("name")})
            except (ValueError, OSError, EOFError, tarfile.TarError, AttributeError) as e:
                problem = f"{type(e).__name__}: {e}"
        checked = {"relative_path": f["relative_path"], "present": p.is_file(), "size_ok": size == f["size_bytes"], "sha256_ok": digest == f["sha256"]}
        out.append(checked | ({"problem": problem, "records": found} if sample else {}))
    return out


MODES = ("word", "endword", "exact", "keyword", "cross")


def load_query_set(path: str, *, max_bytes: int = 64 << 10, max_query_bytes: int = 1024) -> list[dict[str, Any]]:
    """Queries of a TOML file: key, text, modes, expected_presence (S21). 1 to 1,000 with unique keys; other keys are errors."""
    raw = Path(path).read_bytes()
    if len(raw) > max_bytes:
        raise ValueError("the query set is too large")
    document = tomllib.loads(raw.decode("utf-8"))
    queries = document.get("queries")
    if not isinstance(queries, list) or not 1 <= len(queries) <= 1000:
        raise ValueError("a query set has 1 to 1,000 queries")
    out, seen = [], set()
    for q in queries:
        if extra := set(q) - {"key", "text", "modes", "expected_presence"}:
            raise ValueError(f"unknown keys {sorted(extra)}")
        if not q.get("key") or not q.get("text") or q["key"] in seen or len(q["text"].encode()) > max_query_bytes:
            raise ValueError(f"bad or repeated query {q.get('key')!r}")
        if bad := set(q.get("modes", ["word"])) - set(MODES):
            raise ValueError(f"unknown modes {sorted(bad)}")
        seen.add(q["key"])
        out.append({"key": q["key"], "text": q["text"], "modes": q.get("modes", ["word", "endword"]), "expected_presence": q.get("expected_presence", True)})
    return out


@dataclass(frozen=True)
class Settings:
    """Merged settings with the defaults that the stages use."""

    values: dict[str, Any] = field(default_factory=dict)

    def get(self, section: str, key: str, default: Any = None) -> Any:
        return self.values.get(section, {}).get(key, default)


def _merge(base: dict, over: dict) -> dict:
    return {k: _merge(base[k], over[k]) if k in over and isinstance(base.get(k), dict) and isinstance(over[k], dict) else over.get(k, base.get(k)) for k in {**base, **over}}


def is_within(path: Path, parent: Path) -> bool:
    """Whether ``path`` is ``parent`` or below it."""
    return path == parent or parent in path.parents


# Fixed values: (what must hold, message) of settings; a rule about a missing value holds.
_RULES = (
    (lambda g: not (g("images", "enabled") is True and g("images", "max_per_article") == 0), "images.max_per_article must be positive when images are enabled"),
    (lambda g: g("images", "fetch_concurrency") != 0, "images.fetch_concurrency must be positive"),
    (lambda g: not (g("distribution", "mode") == "public" and g("images", "missing_license_action") == "warn"), "images.missing_license_action cannot be warn in public distribution"),
    (lambda g: not (g("distribution", "mode") == "public" and g("distribution", "include_attribution_appendix") is not True), "distribution.include_attribution_appendix must be true in public distribution"),
    (lambda g: not (g("distribution", "mode") == "public" and g("distribution", "exclude_images_without_license") is not True), "distribution.exclude_images_without_license must be true in public distribution"),
)
PROFILES = ("lite", "mini", "full")


def load_settings(default: str, *overrides: str) -> Settings:
    """TOML settings, later files over earlier ones key by key.

    Relative ``paths`` are those of the file that names them. Negative numbers, unknown sections, unknown versions and
    profiles, sources or output inside the reference folder and combinations that contradict each other are errors.
    """


    def read(name: str) -> dict[str, Any]:
        at = Path(name).expanduser().resolve()
        found = tomllib.loads(at.read_text(encoding="utf-8"))
        if isinstance(found.get("paths"), dict):
            found["paths"] = {k: str((at.parent / Path(v).expanduser()).resolve()) for k, v in found["paths"].items()}
        return found

    values = read(default)
    known = set(values)
    for o in overrides:
        more = read(o)
        if extra := set(more) - known:
            raise ValueError(f"unknown sections {sorted(extra)}")
        values = _merge(values, more)

    def check(node: Any, at: str) -> None:
        if isinstance(node, dict):
            for k, v in node.items():
                check(v, f"{at}.{k}")
        elif isinstance(node, (int, float)) and not isinstance(node, bool) and node < 0:
            raise ValueError(f"{at} is negative")

    check(values, "settings")
    settings = Settings(values)
    if values.get("schema_version", 1) != 1:
        raise ValueError(f"unknown schema_version {values['schema_version']}")
    if values.get("profile", PROFILES[0]) not in PROFILES:
        raise ValueError(f"unknown profile {values['profile']!r}")
    for holds, message in _RULES:
        if not holds(settings.get):
            raise ValueError(message)
    paths = {k: Path(v) for k, v in values.get("paths", {}).items()}
    for name in ("sources", "output"):
        if name in paths and "reference" in paths and is_within(paths[name], paths["reference"]):
            raise ValueError(f"paths.{name} must not be inside paths.reference")
    return settings


def inventory(spark: SparkSession, root: str, *, max_depth: int = 16, max_entries: int = 100_000, max_path_bytes: int = 4096) -> DataFrame:
    """(path, relative, length, sha256) of all files below a folder (S26); deeper, more or longer names than allowed are an error."""
    from pyspark.sql import functions as F

    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = system.makeQualified(at).toString().rstrip("/") + "/"
    listed: list[tuple[str, str, int]] = []
    found = system.listFiles(at, True)
    while found.hasNext():
        f = found.next()
        path = f.getPath().toString()
        relative = path.removeprefix(base)
        for what, value, cap in (("entries", len(listed) + 1, max_entries), ("levels", relative.count("/") + 1, max_depth), ("bytes of a path", len(relative.encode()), max_path_bytes)):
            if value > cap:
                raise ValueError(f"{root} has {value} {what}, more than {cap}")
        listed.append((path, relative, f.getLen()))
    # Spark reads no files without bytes, so the listing leads
    rows = spark.createDataFrame(listed, "path string, relative string, length bigint")
    hashes = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.sha2("content", 256).alias("sha256"))
    return rows.join(hashes, "path", "left").withColumn("sha256", F.when(F.col("length") == 0, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("sha256")))


def folder_groups(files: DataFrame) -> DataFrame:
    """(folder, files, bytes): an inventory's files by the folder at its top, '' for files beside them."""
    from pyspark.sql import functions as F

    folder = F.when(F.col("relative").contains("/"), F.substring_index("relative", "/", 1)).otherwise("")
    return files.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def read_lock(path: str) -> dict[str, Any]:
    lock = json.loads(Path(path).read_text(encoding="utf-8"))
    if problems := validate_lock(lock):
        raise ValueError("; ".join(problems))
    return lock
