"""The command line over a small source of two chunks, from the lock to the reports."""

import io
import json
import tarfile

import pytest

from lexforge import cli
from lexforge.plans import pipeline
from lexforge.sources import records


def article(i, version=1, **more):
    html = f"<section><p><b>Page {i}</b> （ぺえじ） is, and was; <a href='./Page_{i + 1}'>next</a>.</p><h2>Part {i}</h2><ul><li>x</li></ul></section>"
    base = {"identifier": i, "name": f"Page {i}", "url": f"https://o.example/wiki/Page_{i}", "namespace": {"identifier": 0}, "version": {"identifier": version}, "date_modified": "2027-01-01T00:00:00Z", "article_body": {"html": html, "wikitext": ""}, "redirects": [{"name": f"Old {i}", "url": "u"}], "categories": [{"name": "C", "url": "u"}], "license": [{"identifier": "CC", "name": "cc", "url": "l"}], "image": {"content_url": f"https://o.example/{i}.png", "width": 9, "height": 9}}
    return base | more


@pytest.fixture()
def source(tmp_path):
    def chunk(name, rows):
        data = "\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in rows).encode()
        with tarfile.open(tmp_path / name, "w:gz") as t:
            info = tarfile.TarInfo("x.ndjson")
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
        return str(tmp_path / name)

    files = [chunk("chunk_0.tar.gz", [article(i) for i in range(1, 6)] + ["no json"]), chunk("chunk_1.tar.gz", [article(2, 5), article(3), article(9, url="ftp://x")])]
    lock = str(tmp_path / "lock.json")
    assert cli.main(["register-local-source", "--files", ",".join(files), "--root", str(tmp_path), "--project", "o", "--snapshot", "o_r1", "--version", "v1", "--date", "2027-01-01T00:00:00Z", "--lock", lock]) == 0
    return tmp_path, lock


def said(capsys):
    return [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith(("{", "["))]


def test_build_resumes_and_reads_the_source_once(spark, source, capsys, monkeypatch):
    folder, lock = source
    out = str(folder / "out")
    reads = []
    original = records.read_chunks
    monkeypatch.setattr(records, "read_chunks", lambda s, paths: reads.append(paths) or original(s, paths))
    common = ["--lock", lock, "--root", str(folder), "--output", out]
    cli.main(["build", *common])
    assert said(capsys)[0] == {"ingest": "no_manifest", "normalize": "no_manifest", "generate": "no_manifest"} and len(reads) == 1
    cli.main(["build", *common])
    assert said(capsys)[0] == {s: "up_to_date" for s in ("ingest", "normalize", "generate")} and len(reads) == 1
    cli.main(["build", *common, "--from-stage", "normalize", "--force-stage", "generate"])
    assert said(capsys)[0] == {"normalize": "up_to_date", "generate": "forced"} and len(reads) == 1
    cli.main(["build", *common, "--max-terms", "1"])
    assert said(capsys)[0] == {"ingest": "up_to_date", "normalize": "up_to_date", "generate": "inputs_changed"}
    cli.main(["normalize", *common, "--force-stage", "ingest"])
    assert said(capsys)[0] == {"ingest": "forced", "normalize": "inputs_changed"} and len(reads) == 2
    with pytest.raises(ValueError, match="unknown stage"):
        cli.main(["build", *common, "--force-stage", "later"])

    made = pipeline.Build(spark, out, lambda: None, ["chunk_ordinal", "line_no"])
    assert {r["identifier"]: r["version"]["identifier"] for r in made.table("raw/articles").collect()} == {1: 1, 2: 5, 3: 1, 4: 1, 5: 1}
    assert [r["reject_reason"] for r in made.table("raw/unreadable").collect()] == ["invalid_json"] and made.table("raw/rejected").count() == 1
    assert made.table("raw/metrics").first().asDict() == {"read": 8, "written": 7, "rejected": 1, "errors": 1}
    assert made.table("raw/duplicates").count() == 2 and made.table("raw/diagnostics").first()["code"] == "REC_INVALID_URL"
    cli.main(["generate", *common])
    capsys.readouterr()
    assert made.entries().filter("tag = 'p1'").first()["heading"] == "Page 1〔ぺえじ〕"
    assert {r["resolution"]: r["count"] for r in made.table("model/links").groupBy("resolution").count().collect()} == {"resolved": 4, "missing": 1}

    assert cli.main(["verify-raw", "--output", out]) == 0
    found = said(capsys)[0]
    assert (found["duplicate_identifiers"], found["counts"]["articles"], found["missing_parents"]["redirects"], found["sample"][0]["identifier"]) == (0, 5, 0, 1)
    assert cli.main(["verify", "--output", out]) == 0
    assert cli.main(["inspect-source", "--lock", lock, "--root", str(folder), "--sample", "2"]) == 0
    capsys.readouterr()

    # media and search chains over tables
    plan, hits = str(folder / "plan"), str(folder / "hits")
    assert cli.main(["image-plan", "--output", out, "--target", plan]) == 0
    (folder / "outcomes.json").write_text("")
    assert cli.main(["rebuild-fetch-report", "--plan", plan, "--outcomes", str(folder / "outcomes.json"), "--target", str(folder / "fetch")]) == 0
    assert cli.main(["image-pending", "--plan", plan, "--outcomes", str(folder / "outcomes.json"), "--target", str(folder / "pending")]) == 0
    assert spark.read.parquet(str(folder / "pending")).count() == spark.read.parquet(plan).count()
    (folder / "q.toml").write_text('[[queries]]\nkey = "a"\ntext = "Page"\nmodes = ["word"]\n[[queries]]\nkey = "b"\ntext = "zzz"\nexpected_presence = false\nmodes = ["exact"]\n')
    assert cli.main(["reference-search", "--output", out, "--queries", str(folder / "q.toml"), "--target", hits]) == 0
    assert cli.main(["reference-report", "--reference", hits, "--candidate", hits, "--report", str(folder / "r")]) == 0
    assert json.loads((folder / "r" / "report.json").read_text())["summary"][0]["target_coverage"] == 1.0
    assert cli.main(["reference-sample", "--output", out, "--hits", hits, "--target", str(folder / "s")]) == 0 and spark.read.parquet(str(folder / "s")).count() == 1
    assert cli.main(["sample", "--output", out, "--target", str(folder / "t"), "--total", "3"]) == 0 and spark.read.parquet(str(folder / "t")).count() == 3
    assert cli.main(["report", "--output", out, "--report", str(folder / "rep")]) == 0 and cli.main(["doctor"]) == 0


def test_damaged_archives_are_reported(source, capsys):
    folder, lock = source
    (folder / "chunk_1.tar.gz").write_bytes(b"no archive")
    assert cli.main(["inspect-source", "--lock", lock, "--root", str(folder), "--sample", "1"]) == 1
    found = said(capsys)[0]
    assert [f["problem"] is None for f in found] == [True, False] and [f["sha256_ok"] for f in found] == [True, False]


def test_streams_of_addresses(tmp_path):
    (tmp_path / "a b.gz").write_bytes(b"\x1f\x8bxyz")
    for path in (str(tmp_path / "a b.gz"), (tmp_path / "a b.gz").as_uri()):
        with records.open_stream(path) as f:
            assert f.read() == b"\x1f\x8bxyz"
