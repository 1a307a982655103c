import pytest
from pyspark.sql import functions as F

from lexforge.operators import media, verify
from lexforge.plans import stages
from lexforge.sources import locks


def test_resume_order(tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    (out / "part").write_text("x")
    path = str(tmp_path / "m.json")
    ask = lambda **k: stages.decide_resume(stages.read_manifest(path), **({"stage_version": 1, "inputs": {"a": "1"}, "output_fingerprint": stages.dataset_fingerprint(str(out))} | k))
    assert ask() == (True, "no_manifest")
    with pytest.raises(RuntimeError):
        with stages.running("ingest", path, stage_version=1, inputs={"a": "1"}, output=str(out)):
            raise RuntimeError
    assert ask() == (True, "not_complete")
    with stages.running("ingest", path, stage_version=1, inputs={"a": "1"}, output=str(out)):
        pass
    assert ask() == (False, "up_to_date")
    assert ask(stage_version=2)[1] == "stage_version_changed" and ask(inputs={})[1] == "inputs_changed" and ask(output_fingerprint=None)[1] == "output_missing"
    (out / "part").write_text("y")
    assert ask() == (True, "output_changed")
    assert stages.stages_from("normalize") == ("normalize", "generate")


def test_locks_retention_archives(tmp_path):
    with stages.stage_lock(str(tmp_path / "l")):
        with pytest.raises(RuntimeError):
            with stages.stage_lock(str(tmp_path / "l")):
                pass
    import os

    for i in range(4):
        (tmp_path / "runs" / f"r{i}").mkdir(parents=True)
        os.utime(tmp_path / "runs" / f"r{i}", (i, i))
    assert [p.name for p in stages.clean_runs(str(tmp_path / "runs"), keep=2)] == ["r1", "r0"]
    assert sorted(p.name for p in (tmp_path / "runs").iterdir()) == ["r2", "r3"]
    (tmp_path / "src").mkdir()
    (tmp_path / "src/a").write_text("1")
    stages.deterministic_zip(str(tmp_path / "src"), str(tmp_path / "1.zip"), root="d")
    stages.deterministic_zip(str(tmp_path / "src"), str(tmp_path / "2.zip"), root="d")
    assert (tmp_path / "1.zip").read_bytes() == (tmp_path / "2.zip").read_bytes()
    assert [c["ok"] for c in stages.preflight([], {"snapshot_version": "latest"}, {"a": True}, ("a", "b"))] == [False, True, False]
    assert "No changes" in stages.release_notes(stages.update_report({"added": 0}), project="p")


def test_source_locks(spark, tmp_path):
    (tmp_path / "c0.tar.gz").write_bytes(b"x")
    lock = locks.register_local([str(tmp_path / "c0.tar.gz")], project="p", namespace=0, snapshot_identifier="s", snapshot_version="v1", date_modified="2027-01-01T00:00:00Z", root=str(tmp_path))
    locks.write_lock(lock, str(tmp_path / "lock.json"))
    assert locks.read_lock(str(tmp_path / "lock.json")) == lock
    assert locks.inspect_source(lock, str(tmp_path)) == [{"relative_path": "c0.tar.gz", "present": True, "size_ok": True, "sha256_ok": True}]
    assert locks.read_locks(spark, str(tmp_path / "lock.json")).select(F.explode("files.size_bytes")).first()[0] == 1
    for bad in ({"snapshot_version": "latest"}, {"files": []}, {"files": [lock["files"][0] | {"relative_path": "../x"}]}):
        assert locks.validate_lock(lock | bad)
    assert locks.inventory(spark, str(tmp_path)).count() == 2


def test_settings_and_query_sets(tmp_path):
    (tmp_path / "a.toml").write_text("[s]\nx = 1\ny = 2\n")
    (tmp_path / "b.toml").write_text("[s]\ny = 3\n")
    assert locks.load_settings(str(tmp_path / "a.toml"), str(tmp_path / "b.toml")).values == {"s": {"x": 1, "y": 3}}
    (tmp_path / "c.toml").write_text("[t]\ny = 3\n")
    with pytest.raises(ValueError):
        locks.load_settings(str(tmp_path / "a.toml"), str(tmp_path / "c.toml"))
    (tmp_path / "q.toml").write_text('[[queries]]\nkey = "k"\ntext = "t"\n')
    assert locks.load_query_set(str(tmp_path / "q.toml"))[0]["modes"] == ["word", "endword"]
    (tmp_path / "q.toml").write_text('[[queries]]\nkey = "k"\ntext = "t"\n[[queries]]\nkey = "k"\ntext = "u"\n')
    with pytest.raises(ValueError):
        locks.load_query_set(str(tmp_path / "q.toml"))


def test_media(spark):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (300).to_bytes(4, "big") + (200).to_bytes(4, "big")
    rows = [(png, "image/png"), (png, "image/jpeg"), (b"\xff\xd8\xff\xe0", "image/jpg"), (b"<svg xmlns='x'/>", "image/svg+xml"), (b"junk", None), (None, None)]
    df = spark.createDataFrame(rows, "c binary, d string")
    got = df.select(media.sniff(F.col("c")).alias("s"), media.media_problem(F.col("c"), F.coalesce("d", F.lit("")), max_pixels=59_999).alias("p")).collect()
    assert [r["s"] for r in got] == ["png", "png", "jpeg", "svg", None, None]
    assert [r["p"] for r in got] == ["too_many_pixels", "type_mismatch", None, None, "unknown_format", "unknown_format"]
    clean = media.sanitize_svg(b"<svg xmlns='http://www.w3.org/2000/svg' onload='x'><script>1</script><a href='javascript:x'/><b/></svg>")
    assert b"script" not in clean and b"onload" not in clean
    with pytest.raises(ValueError):
        media.sanitize_svg(b"<!DOCTYPE x><svg/>")
    planned = spark.createDataFrame([("u1", "m1", 1), ("u2", "m2", 1)], "source_url string, media_id string, uses bigint")
    outcomes = spark.createDataFrame([("u1", "failed", None, 1), ("u1", "ok", "h", 2), ("zz", "ok", "h", 1)], "source_url string, status string, content_sha256 string, at int")
    assert [r["source_url"] for r in media.unfetched(planned, outcomes).collect()] == ["u2"]
    assert {(r["source_url"], r["status"]) for r in media.rebuild_report(planned, outcomes).collect()} == {("u1", "ok"), ("u2", "pending")}
    same = spark.createDataFrame([(1, "h"), (2, "h"), (3, None), (4, None)], "k int, h string")
    assert sorted(r["k"] for r in media.first_by_content(same, content_hash="h", order=["k"]).collect()) == [1, 3, 4]


def test_entry_issues(spark):
    df = spark.createDataFrame([("p1", "a", ["p1", "px", "px", None]), ("p1", "", None), ("", "x", ["p1"]), (None, "y", [])], "tag string, title string, targets array<string>")
    got = sorted((r["code"], r["tag"], r["detail"]) for r in verify.entry_issues(df).na.fill("-").collect())
    assert [g[0] for g in got] == ["DUPLICATE_TAG", "EMPTY_TAG", "EMPTY_TAG", "EMPTY_TITLE", "UNKNOWN_TARGET", "UNKNOWN_TARGET", "UNKNOWN_TARGET"]
    assert verify.entry_issues(df.limit(0)).count() == 0


def settings_of(tmp_path, text, *more):
    files = []
    for i, t in enumerate((text, *more)):
        (tmp_path / f"s{i}.toml").write_text(t, encoding="utf-8")
        files.append(str(tmp_path / f"s{i}.toml"))
    return locks.load_settings(*files)


SOUND = '[paths]\nsources = "src"\noutput = "/out"\nreference = "ref"\n[images]\nenabled = true\nmax_per_article = 3\nfetch_concurrency = 4\nmissing_license_action = "warn"\n[distribution]\nmode = "personal"\n'


def test_settings_resolve_paths_and_keep_rules(tmp_path):
    got = settings_of(tmp_path, SOUND, '[paths]\nsources = "other"\n')
    assert got.get("paths", "sources") == str(tmp_path / "other") and got.get("paths", "output") == "/out" and got.get("images", "max_per_article") == 3
    for bad, message in (
        ("[images]\nmax_per_article = 0\n", "max_per_article"), ("[images]\nfetch_concurrency = 0\n", "fetch_concurrency"), ('[distribution]\nmode = "public"\n', "missing_license_action"), ("[images]\nmax_per_article = -1\n", "negative"),
        ('[distribution]\nmode = "public"\n[images]\nmissing_license_action = "drop"\n', "attribution"), ('[paths]\nsources = "ref/x"\n', "paths.sources"), ('[paths]\noutput = "ref"\n', "paths.output"), ("[more]\na = 1\n", "unknown sections"),
    ):
        with pytest.raises(ValueError, match=message):
            settings_of(tmp_path, SOUND, bad)
    with pytest.raises(ValueError, match="profile"):
        settings_of(tmp_path, 'profile = "huge"\n' + SOUND)
    with pytest.raises(ValueError, match="schema_version"):
        settings_of(tmp_path, "schema_version = 2\n" + SOUND)


def test_inventory_keeps_its_caps(spark, tmp_path):
    (tmp_path / "book a" / "data").mkdir(parents=True)
    (tmp_path / "book a" / "data" / "x.bin").write_bytes(b"abc")
    (tmp_path / "book a" / "y.bin").write_bytes(b"")
    (tmp_path / "catalog").write_bytes(b"12")
    for root in (str(tmp_path), tmp_path.as_uri() + "/"):
        found = locks.inventory(spark, root)
        assert sorted((r["relative"], r["length"]) for r in found.collect()) == [("book a/data/x.bin", 3), ("book a/y.bin", 0), ("catalog", 2)]
    assert sorted(map(tuple, locks.folder_groups(found).collect())) == [("", 1, 2), ("book a", 2, 3)]
    for cap in ({"max_depth": 2}, {"max_entries": 2}, {"max_path_bytes": 10}):
        with pytest.raises(ValueError, match="more than"):
            locks.inventory(spark, str(tmp_path), **cap)


def test_graphics_of_a_conversion_report_are_rendered(spark):
    import json

    from lexforge.operators import render

    report = spark.createDataFrame([("m1", "g1", "ok"), ("m1", "g0", "ok"), ("m2", "g2", "failed"), ("m3", "g3", "ok"), (None, "g4", "ok")], "media_id string, name string, status string")
    lookup = render.graphic_lookup(report, spark.createDataFrame([("g1",), ("g2",), ("g0",)], "name string"))
    assert [tuple(r) for r in lookup.collect()] == [("m1", "g0")]
    body = json.dumps([{"type": "image", "media_id": m, "alt_text": m} for m in ("m1", "m2")])
    pages = spark.createDataFrame([(1, "T", ["T"], [], None, None, [], body, [], [], []), (2, "U", ["U"], [], None, None, [], body, [], [], [])], "page_id bigint, title string, headwords array<string>, keywords array<string>, modified string, abstract string, lead array<string>, body_json string, link_pages array<bigint>, categories array<string>, license_ids array<string>")
    media = spark.createDataFrame([(1, "m1"), (1, "m1"), (1, "m2")], "page_id bigint, media_id string")
    got = {r["page_id"]: r["body"] for r in render.render_entries(render.with_graphics(pages, media, lookup)).collect()}
    assert got == {1: "T\n\n\x1eG:g0\x1f\nm1\n\n[画像: m2]", 2: "U\n\n[画像: m1]\n\n[画像: m2]"}
