import pytest
from pyspark.sql import functions as F

from lexforge.functions import charset
from lexforge.operators import html, wikitext
from lexforge.plans import stages


def test_blocks_links_and_media():
    got = wikitext.read_body("<!-- x -->Intro '''b''' [[A|a]].\n[[File:P_q.png|thumb|A [[cap]]]]\n== H ==\n* i {{Stub}}\n{{Box|x|k = {{in|v}}}}\n{|\n! A !! B\n|-\n| style=x | 1 || 2\n|}\n<ref>r</ref>")
    assert [(b["kind"], b["text"]) for b in got["blocks"]] == [("paragraph", "Intro b a."), ("heading", "H"), ("list_item", "i"), ("paragraph", "x; k: v A | B 1 | 2")]
    assert got["links"] == [{"title": "A", "label": "a"}] and got["media"] == [{"name": "P q.png", "caption": "A [[cap]]"}]
    assert got["problems"] == ["TEMPLATE_UNSUPPORTED"] * 2


def test_tables():
    assert wikitext.parse_table("{|\n| 1\n")[1] == "TABLE_PARSE_FAILED"
    rows, why = wikitext.parse_table("{|\n" + "|-\n| a\n" * 101 + "|}")
    assert len(rows) == 100 and why == "TABLE_TRUNCATED"


def test_null_bodies_and_reruns(spark):
    df = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, "{{" * 200 + "x", "c")], "k bigint, text string, blocks string")
    assert {r["k"]: len(r["blocks"]) for r in wikitext.read_bodies(df, key=["k"], wikitext="text").collect()} == {1: 0, 2: 0, 3: 1}
    a = spark.createDataFrame([(1, "h"), (2, None)], "k int, h string")
    b = spark.createDataFrame([(1, "h"), (2, "x"), (3, "y")], "k int, h string")
    assert [r["k"] for r in wikitext.conflicting_pages(a, b, key="k", content_hash="h").collect()] == [2]


def test_codec_and_marks():
    blocks = html.normalize("<p>a</p><table><tr><td><p>b</p></td></tr></table>")[0]
    assert html.decode_blocks(html.canonical_json(blocks)) == blocks
    for bad in ('[{"type": "x"}]', '[{"type": "paragraph"}]', '[{"type": "quote", "blocks": [{"type": "code"}]}]'):
        with pytest.raises(ValueError):
            html.decode_blocks(bad)
    tree, _ = html.parse_tree("<sup class='reference'><a href='#n1'>[1]</a></sup>")
    assert html.reference_marker(tree.children[0]) == ("[1]", "n1")
    assert html.math_key(" a  b ") == html.math_key("a b")


def test_observation_and_log(spark):
    df, seen = stages.observed(spark.range(10), "n", F.max("id").alias("top"))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "top": 9}
    assert "***" in stages.log_line("info", "Bearer abc", token="t") and "abc" not in stages.log_line("info", "Bearer abc")


def test_unrepresentable(spark):
    df = spark.createDataFrame([("a𠀋あ€",), (None,), ("abc",)], "t string")
    assert [r["v"] for r in df.select(charset.unrepresentable(F.col("t")).alias("v")).collect()] == [["𠀋", "€"], None, []]


def test_bars_inside_links_and_templates_are_text():
    table = "{| class='x'\n|+ cap\n! a !! style='b' | c\n|-\n| [[d|e]] || {{f|g||h}} || class='i' | [[j|k]]\n|-\n|\n|}"
    assert wikitext.parse_table(table) == ([["+ cap", "a", "c"], ["[[d|e]]", "{{f|g||h}}", "[[j|k]]"], [""]], None)
    assert wikitext.parse_table("{|\n| a") == ([], "TABLE_PARSE_FAILED") and wikitext.parse_table("{|\n|}") == ([], None) and wikitext.parse_table("") == ([], "TABLE_PARSE_FAILED")
    rows, problem = wikitext.parse_table("{|\n" + "|-\n| x\n" * 101 + "|}")
    assert len(rows) == 100 and problem == "TABLE_TRUNCATED"
