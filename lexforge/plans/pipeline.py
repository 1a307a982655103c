"""The stages of a build on stored tables, each with a manifest, a resume decision and a lock.

A stage reads what the stage before wrote, so the source is parsed once, whatever is rebuilt later, and the winners of
the deduplication are chosen by deletion vectors over the stored records instead of a shuffle of wide rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.functions.hashing import combined_fingerprint
from lexforge.operators import html, ingest, media, render, verify
from lexforge.plans import build, stages

#: Version of each stage's output; another one makes it run again.
VERSIONS = {"ingest": 2, "normalize": 2, "generate": 2}
_TABLES = {
    "ingest": ("raw/records", "raw/articles", "raw/rejected", "raw/redirects", "raw/categories", "raw/licenses", "raw/duplicates", "raw/diagnostics", "raw/metrics"),
    "normalize": ("model/articles", "model/links", "model/media", "model/problems", "model/metrics"),
    "generate": ("search_terms", "entries", "issues", "metrics"),
}


def stored_fingerprint(spark: SparkSession, paths: list[str]) -> str | None:
    """Fingerprint of stored tables by the names and lengths of their files; None if one is missing.

    Spark never reuses the name of a part file, so the contents, which may be very large, need not be read.
    """
    jvm = spark.sparkContext._jvm
    parts: list[tuple[str, int, str]] = []
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        system = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(at):
            return None
        found = system.listFiles(at, True)
        while found.hasNext():
            f = found.next()
            name = f.getPath().getName()
            if not name.startswith((".", "_")):
                parts.append((f"{p.rsplit('/', 1)[-1]}/{name}", f.getLen(), ""))
    return combined_fingerprint(parts)


@dataclass
class Build:
    """A build below ``output``; ``records`` gives the article records, ``inputs`` names what they were made of.

    Tables are compressed by ``codec`` at ``level`` (S07).
    """

    spark: SparkSession
    output: str
    records: Callable[[], DataFrame]
    arrival: list[str]
    inputs: dict[str, str] = field(default_factory=dict)
    limits: ingest.Limits = ingest.Limits()
    options: html.Options = html.Options()
    max_terms: int = 64
    codec: str = "zstd"
    level: int = 6

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.output}/{name}")

    def put(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").option("compression", self.codec).option("parquet.compression.codec.zstd.level", str(self.level)).parquet(f"{self.output}/{name}")
        return self.table(name)

    def fingerprint(self, stage: str) -> str | None:
        return stored_fingerprint(self.spark, [f"{self.output}/{t}" for t in _TABLES[stage]])

    def stage_inputs(self, stage: str) -> dict[str, str]:
        """What a stage's result depends on: the source and settings, or the output of the stages before."""
        settings = {"limits": repr(self.limits)} if stage == "ingest" else {"options": repr(self.options)} if stage == "normalize" else {"max_terms": str(self.max_terms)}
        before = stages.STAGES[: stages.STAGES.index(stage)]
        return {**settings, **(self.inputs if stage == "ingest" else {b: self.fingerprint(b) or "" for b in before})}

    # stages

    def ingest(self) -> dict[str, Any]:
        """The source, read once; accepted articles with child tables, rejected ones, audit and diagnostics."""
        stored = self.put("raw/records", self.records())
        if "reject_reason" in stored.columns:  # lines that are no records are kept with their reason
            self.put("raw/unreadable", stored.filter("reject_reason is not null").select(*self.arrival, "source_hash", "reject_reason"))
            stored = stored.filter("reject_reason is null")
        checked = ingest.validate(stored, self.limits)
        raw = build.run_ingest(stored, arrival=self.arrival, limits=self.limits, positions=True)
        articles = self.put("raw/articles", raw.articles)
        made = build.child_tables(articles, arrival=self.arrival)
        for name, df in {"rejected": raw.rejected, "redirects": made[0], "categories": made[1], "licenses": made[2], "duplicates": raw.audit, "diagnostics": raw.diagnostics}.items():
            self.put(f"raw/{name}", df)
        return self.put("raw/metrics", ingest.ingest_metrics(checked)).first().asDict()

    def raw(self) -> build.Raw:
        return build.Raw(*[self.table(f"raw/{t}") for t in ("articles", "rejected", "redirects", "categories", "licenses", "duplicates", "diagnostics")])

    def normalize(self) -> dict[str, Any]:
        """Document model, resolved links, selected media and the problems met."""
        model = build.run_normalize(self.raw(), options=self.options)
        for name, df in {"articles": model.articles, "links": model.links, "media": model.media, "problems": model.problems}.items():
            self.put(f"model/{name}", df)
        by_status = self.table("model/articles").groupBy("normalize_status").agg(F.count(F.lit(1)).alias("articles"), F.sum("block_count").alias("blocks"))
        return {r["normalize_status"]: r["articles"] for r in self.put("model/metrics", by_status).collect()}

    def model(self) -> build.Model:
        return build.Model(*[self.table(f"model/{t}") for t in ("articles", "links", "media", "problems")])

    def generate(self) -> dict[str, Any]:
        """Search terms, rendered entries and their issues."""
        made = build.run_generate(self.raw(), self.model(), max_terms=self.max_terms)
        self.put("search_terms", made.terms)
        render.write_entries(made.entries, f"{self.output}/entries")
        stored = self.entries()
        self.put("issues", verify.entry_issues(stored))
        size = render.estimated_size(F.col("body"))
        return self.put("metrics", stored.agg(F.count(F.lit(1)).alias("entries"), F.sum(size).alias("bytes"), F.sum(F.size("targets")).alias("links"))).first().asDict()

    def entries(self) -> DataFrame:
        """The stored entries, with the page that each tag names."""
        stored = self.spark.read.schema("tag string, title string, heading string, aliases array<string>, keywords array<string>, body string, targets array<string>").json(f"{self.output}/entries")
        return stored.withColumn("page_id", F.expr("try_cast(substring(tag, 2) as bigint)"))

    # control

    def run(self, *, first: str | None = None, force: str | None = None, last: str | None = None, control: str | None = None) -> dict[str, str]:
        """Stage -> why it ran, or ``up_to_date``. ``first`` leaves earlier stages out, ``force`` runs one whatever its manifest says.

        ``control`` is a local folder for manifests and locks, by default ``output``.
        """
        chosen = stages.stages_from(first) if first else stages.STAGES
        if force is not None and force not in stages.STAGES:
            raise ValueError(f"unknown stage {force!r}; stages are {', '.join(stages.STAGES)}")
        if last is not None:
            chosen = tuple(s for s in chosen if stages.STAGES.index(s) <= stages.STAGES.index(last))
        folder = control or self.output
        out: dict[str, str] = {}
        for stage in chosen:
            inputs = self.stage_inputs(stage)
            manifest = f"{folder}/{stage}.json"
            with stages.stage_lock(f"{folder}/{stage}.lock"):
                needed, reason = stages.decide_resume(stages.read_manifest(manifest), stage_version=VERSIONS[stage], inputs=inputs, output_fingerprint=self.fingerprint(stage))
                if not needed and stage != force:
                    out[stage] = reason
                    continue
                with stages.running(stage, manifest, stage_version=VERSIONS[stage], inputs=inputs, fingerprint=lambda s=stage: self.fingerprint(s)) as metrics:
                    metrics.update(getattr(self, stage)())
                out[stage] = "forced" if stage == force else reason
        return out

    def verify_raw(self, *, sample: int = 5) -> dict[str, Any]:
        """Repeated articles, child rows without an article, row counts and a sample of decoded articles."""
        articles = self.table("raw/articles")
        children = {t: self.table(f"raw/{t}") for t in ("redirects", "categories", "licenses", "duplicates")}
        page = {t: "page_id" if "page_id" in df.columns else "identifier" for t, df in children.items()}
        rows = articles.select("identifier", "name", F.length("article_body.html").alias("characters")).orderBy("identifier").limit(sample).collect()
        return {
            "duplicate_identifiers": verify.duplicate_keys(articles, ["identifier"]).count(),
            "missing_parents": {t: verify.missing_parents(df, page[t], articles, "identifier").count() for t, df in children.items()},
            "counts": {r["table_name"]: r["n"] for r in verify.table_counts({t.split("/")[1]: self.table(t) for t in _TABLES["ingest"] if t != "raw/metrics"}).collect()},
            "sample": [r.asDict() for r in rows],
        }

    def media_plan(self) -> DataFrame:
        """Addresses to fetch."""
        return media.plan(self.table("model/media"), self.table("model/articles"))
