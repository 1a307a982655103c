"""Command line: ``python -m lexforge.cli COMMAND``. Exit code 0 only if the command's checks hold.

Under ``spark-submit`` the master and all settings are those of the submission.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.functions.hashing import file_fingerprint
from lexforge.operators import compare, media, sampling, search, verify
from lexforge.plans import pipeline, stages
from lexforge.session import session
from lexforge.sources import locks, records

#: Options of each command; a star marks those that may be left out.
COMMANDS: dict[str, str] = {
    "doctor": "", "register-local-source": "files root project snapshot version date lock", "inspect-source": "lock root sample*", "ingest": "lock root output force-stage*", "normalize": "lock root output force-stage*",
    "generate": "lock root output force-stage*", "build": "lock root output from-stage* force-stage* max-terms*", "verify-raw": "output", "verify": "output", "search": "output pattern", "sample": "output target total* per-stratum*",
    "update": "previous new", "image-plan": "output target", "image-pending": "plan outcomes target", "rebuild-fetch-report": "plan outcomes target", "image-check": "plan folder target", "reference-inventory": "root target",
    "reference-search": "output queries target limit*", "reference-sample": "output hits target", "reference-report": "reference candidate report", "disk-usage": "path", "clean": "runs keep dry-run*", "report": "output report",
}


def say(x: Any) -> None:
    print(json.dumps(x, ensure_ascii=False, default=str))


def _build(a: argparse.Namespace, spark) -> pipeline.Build:
    lock = locks.read_lock(a.lock)

    def source() -> DataFrame:
        lines = records.read_chunks(spark, [f"{a.root.rstrip('/')}/{f['relative_path']}" for f in lock["files"]])
        return records.parse_records(lines, "chunk_ordinal", "line_no")

    return pipeline.Build(spark, a.output.rstrip("/"), source, ["chunk_ordinal", "line_no"], inputs={"lock": file_fingerprint(a.lock)[1], "snapshot": lock["snapshot_identifier"]}, max_terms=int(getattr(a, "max_terms", None) or 64))


def _stored(a: argparse.Namespace, spark) -> pipeline.Build:
    def nothing() -> DataFrame:
        raise ValueError("this command reads a finished build")

    return pipeline.Build(spark, a.output.rstrip("/"), nothing, ["chunk_ordinal", "line_no"])


def _put(df: DataFrame, target: str) -> int:
    df.write.mode("overwrite").parquet(target)
    return 0


def doctor(a) -> int:
    checks = stages.doctor({})
    say(checks)
    return int(not all(c["ok"] for c in checks))


def register_local_source(a) -> int:
    locks.write_lock(locks.register_local(a.files.split(","), project=a.project, namespace=0, snapshot_identifier=a.snapshot, snapshot_version=a.version, date_modified=a.date, root=a.root), a.lock)
    return 0


def inspect_source(a) -> int:
    found = locks.inspect_source(locks.read_lock(a.lock), a.root, sample=int(a.sample or 0))
    say(found)
    return int(not all(f["size_ok"] and f["sha256_ok"] and not f.get("problem") for f in found))


def run_stages(a) -> int:
    made = _build(a, session())
    if a.command == "build":
        say(made.run(first=a.from_stage, force=a.force_stage))
    else:
        # a single stage reuses those before it if they are up to date
        say(made.run(force=a.force_stage, last=a.command))
    if a.command not in ("build", "generate"):
        return 0
    say({k: v for k, v in (made.table("metrics").first() or {}).asDict().items()})
    return int(made.table("issues").limit(1).count() > 0)


def verify_raw(a) -> int:
    found = _stored(a, session()).verify_raw()
    say(found)
    return int(found["duplicate_identifiers"] > 0 or any(found["missing_parents"][t] for t in ("redirects", "categories", "licenses")))


def verify_entries(a) -> int:
    issues = verify.entry_issues(_stored(a, session()).entries())
    issues.show(truncate=False)
    return int(issues.limit(1).count() > 0)


def look_up(a) -> int:
    search.lookup(_stored(a, session()).table("search_terms"), a.pattern).show()
    return 0


def sample(a) -> int:
    """A stratified sample of the accepted articles, with their full rows."""
    articles = _stored(a, session()).table("raw/articles").withColumn("page_id", F.col("identifier"))
    picture = F.coalesce(F.nullif(F.col("image.content_url"), F.lit("")), F.nullif(F.col("image.url"), F.lit("")))
    signals = articles.select("page_id", "line_no", "chunk_ordinal", sampling.strata(title=F.col("name"), html=F.col("article_body.html"), categories=F.transform("categories", lambda c: c["name"]), has_image=picture.isNotNull()).alias("strata"))
    ordered = signals.withColumn("at", F.struct("chunk_ordinal", "line_no"))
    chosen = sampling.stratified(ordered, key="page_id", arrival="at", total=int(a.total or 100), per_stratum=int(a.per_stratum or 10))
    return _put(sampling.extract(articles, chosen, key="page_id").drop("page_id"), a.target)


def update(a) -> int:
    spark = session()
    files = lambda p: compare.lock_files(locks.read_locks(spark, p)).select(F.col("chunk_identifier").alias("chunk_key"), "size_bytes", "sha256")
    summary = compare.diff_summary(compare.chunk_diff(files(a.previous), files(a.new))).first().asDict()
    print(stages.release_notes(stages.update_report(summary), project="update"))
    return 0


def image_plan(a) -> int:
    return _put(_stored(a, session()).media_plan(), a.target)


def _outcomes(spark, path: str) -> DataFrame:
    return spark.read.schema(media.OUTCOME).json(path)


def image_pending(a) -> int:
    """Planned addresses that no outcome of an earlier fetch settles."""
    spark = session()
    return _put(media.unfetched(spark.read.parquet(a.plan), _outcomes(spark, a.outcomes)), a.target)


def rebuild_fetch_report(a) -> int:
    spark = session()
    return _put(media.rebuild_report(spark.read.parquet(a.plan), _outcomes(spark, a.outcomes)), a.target)


def image_check(a) -> int:
    """Fetched files checked for their format, one row per content; files are named by media_id."""
    spark = session()
    files = spark.read.format("binaryFile").load(a.folder).select(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("media_id"), "content")
    checked = files.select("media_id", media.sniff(F.col("content")).alias("format"), media.media_problem(F.col("content"), F.lit("")).alias("problem"), F.sha2("content", 256).alias("content_sha256"))
    return _put(media.first_by_content(spark.read.parquet(a.plan).join(checked, "media_id"), content_hash="content_sha256", order=["media_id"]), a.target)


def reference_inventory(a) -> int:
    return _put(locks.inventory(session(), a.root), a.target)


def reference_search(a) -> int:
    """Ranked hits of a query set in the build's search terms."""
    spark = session()
    wanted = locks.load_query_set(a.queries)
    # at most 1,000 queries by the rules of query sets
    rows = [(q["key"], q["text"], m, q["expected_presence"]) for q in wanted for m in q["modes"]]
    queries = spark.createDataFrame(rows, "query_key string, text string, mode string, expected_presence boolean").withColumn("normalized_query", search.index_key(F.col("text")))
    hits = search.run_queries(_stored(a, spark).table("search_terms"), queries, max_results=int(a.limit or 100))
    return _put(queries.drop("text").join(hits, ["query_key", "mode"], "left"), a.target)


def reference_sample(a) -> int:
    made = _stored(a, session())
    hits = made.spark.read.parquet(a.hits).filter("page_id is not null")
    return _put(search.sample_entries(hits, made.entries().select("page_id", "body")), a.target)


def reference_report(a) -> int:
    """Two result sets of one query set compared."""
    spark = session()

    def packed(path: str) -> DataFrame:
        hits = spark.read.parquet(path).withColumn("query_key", F.concat_ws("/", "query_key", "mode"))
        # at most max_results hits per query
        return hits.groupBy("query_key").agg(F.first("expected_presence").alias("expected_presence"), F.transform(F.sort_array(F.collect_list(F.when(F.col("key").isNotNull(), F.struct("rank", "key")))), lambda x: x["key"]).alias("headings"))

    verdict = compare.evaluate(compare.compare_summary(compare.compare_hits(packed(a.reference), packed(a.candidate))))
    stages.write_report({"summary": verdict, "report": compare.compatibility_report(verdict, reference=a.reference, candidate=a.candidate)}, a.report)
    return int(not verdict.first()["passed"])


def disk_usage(a) -> int:
    say(stages.disk_usage({"path": a.path}))
    return 0


def clean(a) -> int:
    say([str(p) for p in stages.clean_runs(a.runs, keep=int(a.keep), dry_run=a.dry_run is not None)])
    return 0


def report(a) -> int:
    made = _stored(a, session())
    frames = {"links": made.table("model/links").groupBy("resolution").count(), "problems": made.table("model/problems").groupBy("code").count(), "ingest": made.table("raw/metrics"), "generate": made.table("metrics")}
    info = stages.build_info({"project": "", "snapshot_identifier": "", "snapshot_version": "", "files": []}, profile="default", software={"python": sys.version.split()[0]})
    stages.write_report(frames, a.report)
    Path(a.report, "build.json").write_text(json.dumps(info), encoding="utf-8")
    return 0


_RUN: dict[str, Callable[[argparse.Namespace], int]] = {
    "doctor": doctor, "register-local-source": register_local_source, "inspect-source": inspect_source, "ingest": run_stages, "normalize": run_stages, "generate": run_stages, "build": run_stages, "verify-raw": verify_raw,
    "verify": verify_entries, "search": look_up, "sample": sample, "update": update, "image-plan": image_plan, "image-pending": image_pending, "rebuild-fetch-report": rebuild_fetch_report, "image-check": image_check,
    "reference-inventory": reference_inventory, "reference-search": reference_search, "reference-sample": reference_sample, "reference-report": reference_report, "disk-usage": disk_usage, "clean": clean, "report": report,
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lexforge")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, options in COMMANDS.items():
        p = sub.add_parser(name)
        for o in options.split():
            p.add_argument(f"--{o.rstrip('*')}", required=not o.endswith("*"))
    a = parser.parse_args(argv)
    return _RUN[a.command](a)


if __name__ == "__main__":
    sys.exit(main())
