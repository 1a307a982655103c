"""Stage control on the driver: manifests, resume decisions, locks, retention, provenance and checks of the surroundings."""

from __future__ import annotations

import fcntl
import json
import shutil
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions.hashing import canonical_json, combined_fingerprint, file_fingerprint
from lexforge.sources.locks import atomic_write

STAGES = ("ingest", "normalize", "generate")
STATUSES = ("running", "complete", "failed")


@dataclass(frozen=True)
class Manifest:
    """What a stage was made of and how it ended."""

    stage: str
    stage_version: int
    status: str
    inputs: dict[str, str]
    output_fingerprint: str | None
    started_at: str
    ended_at: str | None = None
    metrics: dict[str, Any] | None = None


def read_manifest(path: str) -> Manifest | None:
    """None if there is none; an unreadable or incomplete one is an error."""
    p = Path(path)
    if not p.exists():
        return None
    payload = json.loads(p.read_text(encoding="utf-8"))
    manifest = Manifest(**payload)
    if manifest.status not in STATUSES or manifest.stage not in STAGES:
        raise ValueError(f"bad manifest {path}")
    return manifest


def write_manifest(manifest: Manifest, path: str) -> None:
    atomic_write(path, canonical_json(asdict(manifest)) + "\n")


def now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def dataset_fingerprint(directory: str) -> str:
    """Fingerprint of a written dataset: its part files by name, size and hash."""
    root = Path(directory)
    parts = [(str(p.relative_to(root)), *file_fingerprint(str(p))) for p in sorted(root.rglob("*")) if p.is_file() and not p.name.startswith((".", "_"))]
    return combined_fingerprint(parts)


def decide_resume(manifest: Manifest | None, *, stage_version: int, inputs: dict[str, str], output_fingerprint: str | None) -> tuple[bool, str]:
    """(run, reason), checked in this order (Z01): no manifest, not complete, version, inputs, output missing, output changed, up to date."""
    if manifest is None:
        return True, "no_manifest"
    if manifest.status != "complete":
        return True, "not_complete"
    if manifest.stage_version != stage_version:
        return True, "stage_version_changed"
    if manifest.inputs != inputs:
        return True, "inputs_changed"
    if output_fingerprint is None:
        return True, "output_missing"
    if manifest.output_fingerprint != output_fingerprint:
        return True, "output_changed"
    return False, "up_to_date"


def stages_from(first: str) -> tuple[str, ...]:
    """``first`` and the stages after it."""
    return STAGES[STAGES.index(first) :]


@contextmanager
def stage_lock(path: str) -> Iterator[None]:
    """Exclusive lock of a stage on this machine; taken already is an error."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError as e:
            raise RuntimeError(f"{path} is locked") from e
        try:
            yield
        finally:
            fcntl.flock(f, fcntl.LOCK_UN)


@contextmanager
def running(stage: str, path: str, *, stage_version: int, inputs: dict[str, str], output: str | None = None, fingerprint: Callable[[], str | None] | None = None) -> Iterator[dict[str, Any]]:
    """Manifest life cycle around a stage: running, then complete with the output's fingerprint, or failed.

    The fingerprint is that of the local folder ``output`` unless ``fingerprint`` gives another one.
    """
    began, metrics = now(), {}
    write_manifest(Manifest(stage, stage_version, "running", inputs, None, began), path)
    try:
        yield metrics
    except BaseException:
        write_manifest(Manifest(stage, stage_version, "failed", inputs, None, began, now(), metrics), path)
        raise
    made = fingerprint() if fingerprint else dataset_fingerprint(output)
    write_manifest(Manifest(stage, stage_version, "complete", inputs, made, began, now(), metrics), path)


def removable_runs(directory: str, *, keep: int) -> list[Path]:
    """All but the ``keep`` newest entries by modification time."""
    runs = sorted((p for p in Path(directory).iterdir() if p.is_dir()), key=lambda p: (p.stat().st_mtime, p.name), reverse=True)
    return runs[keep:]


def clean_runs(directory: str, *, keep: int, dry_run: bool = False) -> list[Path]:
    """Remove them."""
    gone = removable_runs(directory, keep=keep)
    if not dry_run:
        for p in gone:
            shutil.rmtree(p)
    return gone


def disk_usage(paths: dict[str, str]) -> list[dict[str, Any]]:
    """(name, path, exists, bytes) per configured path."""
    return [{"name": n, "path": p, "exists": Path(p).exists(), "bytes": sum(x.stat().st_size for x in Path(p).rglob("*") if x.is_file()) if Path(p).is_dir() else 0} for n, p in paths.items()]


def doctor(paths: dict[str, str]) -> list[dict[str, Any]]:
    """(check, ok, detail) of the surroundings."""
    import pyspark

    out = [{"check": "python", "ok": sys.version_info >= (3, 10), "detail": sys.version.split()[0]}, {"check": "pyspark", "ok": int(pyspark.__version__.split(".")[0]) >= 4, "detail": pyspark.__version__}, {"check": "java", "ok": shutil.which("java") is not None, "detail": shutil.which("java") or "missing"}]
    return out + [{"check": f"path {n}", "ok": Path(p).is_dir(), "detail": p} for n, p in paths.items()]


def preflight(checks: list[dict[str, Any]], lock: dict[str, Any] | None, gates: dict[str, bool | None], required: tuple[str, ...]) -> list[dict[str, Any]]:
    """Doctor, a concrete lock and all required gates; a missing gate fails."""
    out = list(checks)
    out.append({"check": "lock", "ok": bool(lock) and lock.get("snapshot_version") not in (None, "", "latest"), "detail": (lock or {}).get("snapshot_version", "missing")})
    return out + [{"check": f"gate {g}", "ok": bool(gates.get(g)), "detail": str(gates.get(g))} for g in required]


def build_info(lock: dict[str, Any], *, profile: str, software: dict[str, str]) -> dict[str, Any]:
    """Provenance of a build."""
    return {"profile": profile, "built_at": now(), "project": lock["project"], "snapshot_identifier": lock["snapshot_identifier"], "snapshot_version": lock["snapshot_version"], "files": len(lock["files"]), "software": software}


def update_report(summary: dict[str, Any]) -> dict[str, Any]:
    """Update report from a one-row diff summary."""
    return {"updated_at": now(), **summary, "has_changes": any(summary.get(k) for k in ("added", "removed", "changed"))}


def release_notes(report: dict[str, Any], *, project: str) -> str:
    """Markdown notes from an update report."""
    lines = [f"# {project}", "", f"Updated {report['updated_at']}.", ""]
    lines += [f"- {k}: {report[k]}" for k in ("added", "removed", "changed", "unchanged", "size_delta") if k in report]
    return "\n".join(lines) + ("\n" if report.get("has_changes") else "\n\nNo changes.\n")


def observed(df: DataFrame, name: str, *metrics: Any) -> tuple[DataFrame, Any]:
    """``df`` and an Observation that holds the row count and further metrics once it was written (Z09): no second pass."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), seen


_SECRET = ("authorization", "token", "password", "secret", "api_key")


def log_line(level: str, message: str, **fields: Any) -> str:
    """One JSON log line with secrets blanked out, by field name and by ``Bearer ...`` in texts."""
    import re

    hide = lambda k, v: "***" if any(s in k.lower() for s in _SECRET) else re.sub(r"(?i)(bearer\s+)\S+", r"\1***", v) if isinstance(v, str) else v
    return canonical_json({"at": now(), "level": level, "message": hide("", message), **{k: hide(k, v) for k, v in fields.items()}})


def pending(planned: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What an interrupted stage still has to do."""
    return planned.join(done.select(F.col(key).alias("_d")).distinct(), F.col(key) == F.col("_d"), "left_anti")


def deterministic_zip(source: str, target: str, *, root: str) -> None:
    """ZIP with sorted names, a fixed time and fixed modes."""
    import zipfile

    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(x for x in Path(source).rglob("*") if x.is_file()):
            info = zipfile.ZipInfo(f"{root}/{p.relative_to(source)}", (1980, 1, 1, 0, 0, 0))
            info.external_attr = 0o644 << 16
            info.compress_type = zipfile.ZIP_DEFLATED
            z.writestr(info, p.read_bytes())


def write_report(frames: dict[str, DataFrame], directory: str) -> list[Path]:
    """JSON, HTML and a Markdown checklist of small report frames (S27). Reports are aggregates; a frame over 10,000 rows is refused."""
    import html

    data: dict[str, list[dict[str, Any]]] = {}
    for name, df in frames.items():
        rows = df.limit(10_001).collect()
        if len(rows) > 10_000:
            raise ValueError(f"{name} is no report")
        data[name] = [r.asDict(recursive=True) for r in rows]
    out = Path(directory)
    out.mkdir(parents=True, exist_ok=True)
    atomic_write(str(out / "report.json"), json.dumps(data, ensure_ascii=False, sort_keys=True, default=str, indent=1))
    table = lambda rows: "<table>" + "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r.values()) + "</tr>" for r in rows) + "</table>"
    atomic_write(str(out / "report.html"), "<!DOCTYPE html><meta charset='utf-8'>" + "".join(f"<h2>{html.escape(n)}</h2>{table(r)}" for n, r in data.items()))
    atomic_write(str(out / "checklist.md"), "".join(f"- [ ] {n}: {len(r)} rows\n" for n, r in data.items()))
    return [out / "report.json", out / "report.html", out / "checklist.md"]
