import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from lexforge.operators import ingest, links
from lexforge.sources import records


def record(**over):
    base = {"identifier": 1, "name": "Orb", "url": "https://w.example/wiki/Orb", "namespace": {"identifier": 0}, "version": {"identifier": 5}, "date_modified": "2027-01-01T00:00:00Z", "article_body": {"html": "<p>x</p>"}, "in_language": {"identifier": "ja"}}
    return {k: v for k, v in (base | over).items() if v is not ...}


def tar(path, members):
    with tarfile.open(path, "w:gz") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


REJECTED = [
    ({"identifier": "1"}, "identifier"), ({"identifier": True}, "identifier"), ({"version": {}}, "version.identifier"), ({"name": ""}, "name"), ({"namespace": ...}, "namespace.identifier"), ({"url": ...}, "url"),
    ({"date_modified": "soon"}, "date_modified"), ({"article_body": ...}, "article_body"), ({"redirects": "x"}, "redirects"), ({"categories": [{"name": ""}]}, "categories"), ({"license": [{"identifier": "a"}]}, "license"),
]


def test_chunks_are_read_and_parsed_strictly(spark, tmp_path):
    lines = [json.dumps(record(identifier=i + 1, name="a b")) for i in range(3)] + ["", "{broken", "[1]"] + [json.dumps(record(**o)) for o, _ in REJECTED]
    tar(tmp_path / "c0.tar.gz", [("c0.ndjson", "\n".join(lines).encode())])
    tar(tmp_path / "c1.tar.gz", [("c1.ndjson", json.dumps(record(identifier=9, redirects=None, image={"url": "u"})).encode() + b"\n")])
    raw = records.read_chunks(spark, [str(tmp_path / "c1.tar.gz"), str(tmp_path / "c0.tar.gz")])
    rows = records.parse_records(raw, "chunk_ordinal", "line_no").orderBy("chunk_ordinal", "line_no").collect()
    assert [r["reject_reason"] for r in rows] == [None] * 3 + ["invalid_json", "not_an_object"] + [w for _, w in REJECTED] + [None]
    assert rows[0]["name"] == "a b" and len(rows[0]["source_hash"]) == 64 and rows[-1]["chunk_ordinal"] == 1


@pytest.mark.parametrize("members", [[], [("a.txt", b"x")], [("a.ndjson", b"{}"), ("b.ndjson", b"{}")], [("a.ndjson", b"x" * 100)]])
def test_bad_archives(tmp_path, members):
    tar(tmp_path / "c.tar.gz", members)
    with pytest.raises(ValueError):
        with open(tmp_path / "c.tar.gz", "rb") as f:
            list(records.tar_lines(f, 50))


def _fold(rows):
    """Sequential form of the rules: state of each key after all arrivals, and the audit of valid-only keys."""
    state, audit = {}, []
    for k, r, h, v, a in sorted(rows, key=lambda x: x[4]):
        row, acc = state.get(k, (None, None))
        if not v:
            if acc is None or r > acc[0]:
                row, acc = (r, h), None
        elif acc is None or r > acc[0]:
            if acc is not None:
                audit.append((k, r, acc[0], "newer_revision_replaced_older", a))
            row = acc = (r, h)
        else:
            reason = "out_of_order_older_revision_dropped" if r < acc[0] else "identical_duplicate_delivery" if h == acc[1] else "same_revision_conflicting_hash"
            audit.append((k, acc[0], r, reason, a))
        state[k] = (row, acc)
    return {(k, row[0], row[1], "accepted" if acc else "rejected") for k, (row, acc) in state.items()}, set(audit)


@pytest.mark.parametrize("seed", range(3))
def test_states_and_audit_equal_a_sequential_fold(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randint(1, 40), rng.randint(1, 4), rng.choice("ab"), rng.random() < 0.85, i) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id bigint, revision_id bigint, source_hash string, valid boolean, source_sequence bigint")
    got = {(r["page_id"], r["revision_id"], r["source_hash"], r["status"]) for r in ingest.fold_states(df, arrival=["source_sequence"]).collect()}
    assert got == _fold(rows)[0]
    valid = [r for r in rows if r[3]]
    audit = ingest.dedup_audit(df.filter("valid"), key="page_id", revision="revision_id", content_hash="source_hash", arrival=["source_sequence"])
    assert {(r["page_id"], r["kept_revision_id"], r["dropped_revision_id"], r["reason"], r["source_sequence"]) for r in audit.collect()} == _fold(valid)[1]


def test_redirect_chains_end_in_pages_cycles_or_nothing(spark):
    titles = spark.createDataFrame([("Z",)], "title string")
    hops = [(f"h{i}", f"h{i + 1}") for i in range(9)] + [("h9", "Z"), ("c1", "c2"), ("c2", "c3"), ("c3", "c1"), ("m", "nowhere"), ("self", "self"), ("into", "c1")]
    got = {r["title"]: (r["target"], r["outcome"], r["hops"]) for r in links.redirect_chains(titles, spark.createDataFrame(hops, "title string, target string")).collect()}
    assert got["h0"] == ("Z", "resolved", 10) and got["h9"] == ("Z", "resolved", 1) and got["m"][1] == "missing"
    assert {got[k][1] for k in ("c1", "c2", "c3", "self", "into")} == {"cycle"}


def test_long_redirect_chains_end_in_their_pages(spark):
    titles = spark.createDataFrame([("Z",)], "title string")
    hops = [(f"h{i}", f"h{i + 1}") for i in range(19)] + [("h19", "Z")] + [(f"c{i}", f"c{(i + 1) % 21}") for i in range(21)] + [("into", "c3")]
    frame = spark.createDataFrame(hops, "title string, target string")
    got = {r["title"]: (r["target"], r["hops"], r["outcome"]) for r in links.redirect_chains(titles, frame).collect()}
    assert [got[f"h{i}"] for i in range(20)] == [("Z", 20 - i, "resolved") for i in range(20)]
    assert {got[k][1:] for k in got if k[0] != "h"} == {(None, "cycle")} and len(got) == 42
    capped = {r["title"]: r["outcome"] for r in links.redirect_chains(titles, frame, max_hops=16).collect()}
    assert (capped["h0"], capped["h3"], capped["h4"], capped["c0"]) == ("too_long", "too_long", "resolved", "cycle")
    alone = [(f"a{i}", f"a{i + 1}") for i in range(17)]
    ends = {r["title"]: (r["target"], r["hops"], r["outcome"]) for r in links.redirect_chains(titles, spark.createDataFrame(alone, "title string, target string")).collect()}
    assert ends["a0"] == ("a17", 17, "missing")
    assert links.redirect_chains(titles, frame.limit(0)).count() == 0


def test_pipeline_keeps_64_keywords_of_a_page(spark, small):
    from lexforge.plans import build

    html = "".join(f"<h2>Heading {i:03}</h2><p>x</p>" for i in range(70))
    rows = spark.read.parquet(f"{small}/edge_case_articles.parquet").filter("identifier is not null and article_body.html is not null and name != ''").orderBy("source_sequence").limit(1)
    one = rows.withColumn("article_body", F.col("article_body").withField("html", F.lit(html))).withColumn("source_hash", F.lit("h"))
    raw = build.run_ingest(one, arrival=["source_sequence"])
    terms = build.run_generate(raw, build.run_normalize(raw)).terms.filter("kind = 'keyword'")
    assert terms.count() == 64


def test_resolution_prefers_titles_then_redirects(spark):
    rows = [(1, 0, None, "Orb"), (1, 1, None, "Hop"), (1, 2, "Help", "Orb"), (1, 3, None, "Gone"), (1, 4, None, None), (1, 5, None, "Both")] + [(2, i, None, "Orb") for i in range(50)]
    frame = spark.createDataFrame(rows, "source_page_id bigint, ordinal int, namespace string, title string")
    articles = spark.createDataFrame([(9, "Orb"), (7, "Orb"), (5, "Both"), (4, None)], "page_id bigint, title string")
    hops = spark.createDataFrame([(3, "Hop"), (1, "Both")], "target_page_id bigint, title string")
    got = {(r["source_page_id"], r["ordinal"]): (r["target_page_id"], r["resolution"]) for r in links.resolve(frame, articles, hops).collect()}
    assert [got[1, i] for i in range(6)] == [(7, "resolved"), (3, "resolved"), (None, "externalized"), (None, "missing"), (None, "missing"), (5, "resolved")]
    assert len(got) == 56 and got[2, 3] == (7, "resolved")
    assert links.resolve(frame.limit(0), articles, hops).count() == 0


def test_children_keep_the_first_of_equal_keys(spark):
    df = spark.createDataFrame([(1, [("A", ""), ("Ａ", ""), (None, ""), ("B", "")]), (2, None), (3, [])], "identifier bigint, redirects array<struct<name:string,url:string>>")
    assert [tuple(r) for r in ingest.explode_children(df, "redirects").orderBy("ordinal").collect()] == [(1, 0, "A", "A"), (1, 1, "B", "B")]
    packed = ingest.hydrate(df.select("identifier"), {"redirects": ingest.explode_children(df, "redirects")}).orderBy("identifier").collect()
    assert [r["redirects"] for r in packed] == [["A", "B"], [], []]


def test_validation_reports_every_rule(spark):
    df = spark.createDataFrame([(1, "é" * 3, "http://x", (1,), ("h" * 9, None)), (2, "ok", "https://x/y", (0,), (None, None)), (3, None, None, None, None)], "identifier bigint, name string, url string, namespace struct<identifier:bigint>, article_body struct<html:string,wikitext:string>")
    got = {r["identifier"]: (r["problems"], r["ingest_status"]) for r in ingest.validate(df, ingest.Limits(title=5, html=8)).collect()}
    assert got[1] == (["REC_TITLE_TOO_LONG", "REC_INVALID_URL", "REC_UNEXPECTED_NAMESPACE", "REC_HTML_TOO_LARGE"], "rejected")
    assert got[2] == ([], "accepted") and got[3][1] == "rejected"


def test_xml_pages(spark, tmp_path):
    (tmp_path / "d.xml").write_text("<mediawiki><page><title>A</title><ns>0</ns><id>1</id><revision><id>5</id><text>#REDIRECT [[B|x]]</text></revision></page><page><title>T</title><ns>10</ns><id>2</id><revision><id>6</id><text>y</text></revision></page></mediawiki>")
    assert [(r["page_id"], r["title"], r["redirect_title"]) for r in records.read_xml_pages(spark, str(tmp_path / "d.xml")).collect()] == [(1, "A", "B")]


def test_plain_ndjson_keeps_line_separators_in_strings(spark, tmp_path):
    (tmp_path / "x.ndjson").write_text(json.dumps(record(name="a b"), ensure_ascii=False) + "\n\n" + json.dumps(record(identifier=2)) + "\n")
    rows = records.parse_records(records.read_ndjson(spark, str(tmp_path / "x.ndjson")), "line_no").orderBy("line_no").collect()
    assert [r["identifier"] for r in rows] == [1, 2] and rows[0]["name"] == "a b"


def test_incremental_states_equal_the_batch_audit(spark, tmp_path):
    from lexforge.streaming import incremental

    rng = random.Random(8)
    rows = [(rng.randint(1, 12), rng.randint(1, 4), rng.choice("ab"), i) for i in range(120)]
    schema = "page_id bigint, revision_id bigint, source_hash string, source_sequence bigint"
    for i in range(3):
        spark.createDataFrame(rows[40 * i : 40 * i + 40], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    batch = {(r["page_id"], r["source_sequence"]): r["reason"] for r in ingest.dedup_audit(spark.createDataFrame(rows, schema), key="page_id", revision="revision_id", content_hash="source_hash", arrival=["source_sequence"]).collect()}
    events = incremental.accepted_states(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    q = events.writeStream.format("memory").queryName("events_out").option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r["page_id"], r["source_sequence"]): r["action"] for r in spark.table("events_out").collect()}
    assert len(got) == 120 and {k for k, v in got.items() if v != "first_seen"} == set(batch)
    # files of one table may arrive in another order than written, so reasons are compared by their count of first sightings
    assert sum(v == "first_seen" for v in got.values()) == len({r[0] for r in rows})


def test_build_pipeline(spark, tmp_path):
    from lexforge.plans import build

    body = "<p><b>Orb</b> is near <a href='./Nem'>Nem</a> and <a href='./Old_Nem'>it</a>.</p><h2>History</h2><ul><li>a</li></ul>"
    base = {"url": "https://w.example/wiki/X", "namespace": (0,), "date_modified": "2027-01-02T00:00:00Z", "image": None, "templates": None}
    rows = [
        (5, "東京", (1,), ("<p><b>東京</b>（とうきょう、英: T）は</p>", None), [], [], [], "h5", 5), (1, "Orb (film)", (2,), (body, None), [], [("Cat", "")], [("L1", "Name", "u")], "h1", 1), (1, "Orb", (1,), ("<p>old</p>", None), [], [], [], "h0", 2), (2, "Nem", (1,), (None, "w"), [("Old Nem", "")], None, None, "h2", 3), (3, "", (1,), (None, None), None, None, None, "h3", 4),
    ]
    schema = "identifier bigint, name string, version struct<identifier:bigint>, article_body struct<html:string,wikitext:string>, redirects array<struct<name:string,url:string>>, categories array<struct<name:string,url:string>>, license array<struct<identifier:string,name:string,url:string>>, source_hash string, source_sequence bigint"
    df = spark.createDataFrame(rows, schema).withColumns({"url": F.lit(base["url"]), "namespace": F.struct(F.lit(0).cast("bigint").alias("identifier")), "date_modified": F.lit(base["date_modified"]), "image": F.lit(None).cast("struct<content_url:string,url:string,width:bigint,height:bigint>")})
    made = build.build(spark, df, arrival=["source_sequence"], output=str(tmp_path / "out"))
    entries = {r["page_id"]: r for r in made.entries.collect()}
    assert entries[1]["targets"] == ["p2"] and "■ History" in entries[1]["body"] and "・ a" in entries[1]["body"] and entries[1]["body"].endswith("出典情報\nL1")
    assert "Orb" in entries[1]["aliases"] and entries[1]["keywords"] == ["History"] and entries[2]["aliases"][0] == "Old Nem"
    assert entries[5]["heading"] == "東京〔とうきょう〕" and entries[1]["heading"] == "Orb (film)"
    assert made.issues.filter("code != 'EMPTY_TITLE'").count() == 0
    assert spark.read.json(str(tmp_path / "out/entries")).count() == len(entries)
    df.write.parquet(str(tmp_path / "in"))
    scan = spark.read.parquet(str(tmp_path / "in"))
    a, b = build.run_ingest(scan, arrival=["source_sequence"]), build.run_ingest(scan, arrival=["source_sequence"], positions=True)
    pick = lambda raw: sorted((r["identifier"], r["source_sequence"]) for r in raw.articles.collect())
    assert pick(a) == pick(b) != []
    assert b.articles.columns == a.articles.columns
