import pytest

from lexforge.llm import markup as M

CASES = [
    # HTML
    ("<h2 id='a'><span>Big <b>one</b></span><br/></h2>", [("heading", "Big one")]),
    ("<ul><li>a &amp; b<ul><li>c</li></ul></li><li>d</ul><p>x</p>", [("list_item", "a & b"), ("list_item", "c"), ("list_item", "d")]),
    ("<UL><LI>a<LI><a href='./x'>b</a></UL>", [("list_item", "a"), ("list_item", "b")]),
    ("<dl><dt>t</dt><dd>d <math alttext='x^2'><mi>q</mi></math></dd></dl>", [("formula", "x^2")]),
    ("<pre><code class='language-c'>if (a &lt; 2 &amp;&amp; b) {\n  * x\n}</code></pre>", [("code", "if (a < 2 && b) { * x }")]),
    ("<div class='mw-highlight'><pre><span></span>== a ==\n</pre></div>", [("code", "== a ==")]),
    ("<p>k<sup class='reference'><a href='#n'>[1]</a></sup></p><figure><img src='q'/><figcaption>cap</figcaption></figure><table><tr><td><ul><li>no</li></ul></td></tr></table>", []),
    ("<script>var q='<li>no</li>';</script><style>.h2{}</style><!-- <h2>no</h2> -->", []),
    ("<math display='block'><semantics><mi>q</mi><annotation encoding='application/x-tex'>a_{1} &lt; b</annotation></semantics></math>", [("formula", "a_{1} < b")]),
    ('<img class="math-fallback" src="f.svg" alt="\\frac{a}{b}"/>', [("formula", "\\frac{a}{b}")]),
    ("&lt;h2&gt;A &amp;amp; B&lt;/h2&gt;&lt;pre&gt;x &amp;lt; 1&lt;/pre&gt;", [("heading", "A & B"), ("code", "x < 1")]),
    # wikitext
    ("== A '''b''' ==<!-- keep -->\n\n===[[c (x)|c]]===\n", [("heading", "A b"), ("heading", "c")]),
    ("* a ''b''\n** [[c]]\n#d\n#* [https://x.example/y e f]\n; t\n: d\n", [("list_item", "a b"), ("list_item", "c"), ("list_item", "d"), ("list_item", "e f")]),
    ("<nowiki>*</nowiki> no list\n", []),
    ("<syntaxhighlight lang='c'>\n* a < b\n</syntaxhighlight>\n\n {| x\n", [("code", "* a < b"), ("code", "{| x")]),
    ("text\n\n while x:\n     * y\n\nmore", [("code", "while x: * y")]),
    ("{{Box\n| a = {{b}}\n* no\n}}\n[[File:a.png|thumb|* no [[x]]]]\n[[Category:== no ==]]\n{| class\n* no\n|}\n<ref name='n'>* no</ref>", []),
    ("See [https://k.example/x the list], #4. :<math>a</math>", [("formula", "a")]),
    # Markdown
    ("## A *b*\n\n#### c\n\nTitle [d](./d)\n=====\n\nx", [("heading", "A b"), ("heading", "c"), ("heading", "Title d")]),
    ("- a __b__\n- c\n\n+ *d*e\n\n1. f\n2. g\n    * h", [("list_item", "a b"), ("list_item", "c"), ("list_item", "de"), ("list_item", "f"), ("list_item", "g"), ("list_item", "h")]),
    ("```c\n* a\n## b\n```\n\n~~~\n- c\n~~~\n", [("code", "* a ## b"), ("code", "- c")]),
    ("It costs $5 or $12, a &lt; b. $x_1$ Use `v * w` and 3 * 4 * 5. $$\ny\n$$", [("formula", "x_1"), ("formula", "y")]),
    ("| A | B |\n|---|---|\n| - x | y |\n", []),
    ("**Bold** start of a paragraph.\n\n*Soft* one.", []),
    # LaTeX
    ("\\section*{A \\textbf{b}}\n\n\\subsection{\\href{https://x}{c} \\& d}\n", [("heading", "A b"), ("heading", "c & d")]),
    ("\\begin{itemize}\n\\item a \\emph{b}\n\\item c\n\\end{itemize}\n\\begin{enumerate}\n\\item d\n\\end{enumerate}", [("list_item", "a b"), ("list_item", "c"), ("list_item", "d")]),
    ("\\begin{verbatim}\n# a\n\\end{verbatim}\n\\begin{lstlisting}\n\\item b\n\\end{lstlisting}", [("code", "# a"), ("code", "\\item b")]),
    ("\\( a \\) \\[ b \\] \\begin{equation}c\\end{equation} x\\footnote{\\( d \\)}", [("formula", "a"), ("formula", "b"), ("formula", "c")]),
    # nothing
    ("", []), ("   \n\n", []), ("plain text, no marks.", []), ("<<<>>> [[ {{ $ ``` \\", []),
]


@pytest.mark.parametrize(("body", "want"), CASES)
@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_elements(body, want, ends):
    assert sorted(e[:2] for e in M.parse(body.replace("\n", ends)).elements) == sorted(want)


def test_mixed_body_keeps_order_in_clean_text():
    text = M.clean_text("<h2>H</h2>\n\nIntro '''x'''.\n\n* a\n* b\n\n```\ncode\n```\n\n$y$ end")
    assert text == "## H\nIntro x.\n- a\n- b\n```\ncode\n```\ny end" and M.clean_text(None) is None


def test_long_texts_take_time_in_proportion():
    import time

    def took(n):
        t = time.time()
        M.parse("<p>abc [[d|e]] $x$ ''f'' " * n)
        M.parse("* a\n" * n + "{{" * 50 + "$" * 9)
        return time.time() - t

    took(100)
    assert took(20_000) < 40 * max(took(1000), 0.01)


@pytest.mark.parametrize("opener", ["<pre>", "<table>", "<h2>", "<ref name='a'>", "\\[", "\\begin{verbatim}", "\n{|", "<math>", "{{", "$x ", "<!--", "**a ", "__a ", "~~a ", "*a ", "[a](", "[https://x ", "[[File:", "<li>", "`", "'' "])
def test_openers_that_nothing_closes(opener):
    import time

    t = time.time()
    parsed = M.parse("<h3>A</h3>" + (opener + "word ") * 20_000)
    assert time.time() - t < 10 and parsed.elements[0][:2] == ("heading", "A")


def test_structural_elements(spark):
    schema = "identifier bigint, body string, kind string, content string"
    rows = [(1, "<h2>A</h2>", "k", "c"), (1, "<h2>A</h2>", "k", "d"), (1, "== A ==\n\n* x, y; z. And more text, to be sure.", "k", "c"), (2, None, None, None), (3, "", None, None), (None, "<p>" + "long, text. " * 30_000 + "</p><h3>Z</h3>", None, None)]
    df = spark.createDataFrame(rows, schema).drop("kind", "content")
    got = sorted((r["identifier"] or 0, r["kind"], r["content"]) for r in M.structural_elements(df, "body", ["identifier"]).collect())
    assert got == [(0, "heading", "Z"), (1, "heading", "A"), (1, "list_item", "x, y; z. And more text, to be sure.")]
    assert M.structural_elements(df.limit(0), "body", ["identifier"]).count() == 0


def test_boilerplate_containers_are_left_out(spark):
    page = "<body><div class='nav'><h3>Menu</h3><ul><li><a href='./a'>A</a></li><li>B</li></ul><pre>kept</pre></div><div class='main'><h2>H</h2><p>A sentence, with marks; and words. It goes on, and on.</p><ul><li>x</li></ul></div></body>"
    df = spark.createDataFrame([(i, page) for i in range(5)], "identifier bigint, body string")
    got = {(r["kind"], r["content"]) for r in M.structural_elements(df, "body", ["identifier"]).collect()}
    assert got == {("heading", "H"), ("list_item", "x")}  # code passes through the ratios like all other kinds
    assert {e[2] for e in M.parse(page).elements} == {"/body/div.nav", "/body/div.main"}


def test_paths_without_prose_score_low(spark):
    df = spark.createDataFrame([(i, "<p>A sentence, with marks; and words. It goes on, and on.</p>" * 5) for i in range(5)], "identifier bigint, body string")
    parsed = M.parse_bodies(df, "body", ["identifier"])
    assert all(r["is_content"] for r in M.path_scores(parsed).collect())


def test_a_leaf_path_is_dropped_by_its_ratio_alone(spark):
    # one container, well evidenced: its code and headings lean on its prose, the link lists of another one do not
    prose = "<p>A sentence, with marks; and words. It goes on, and on.</p>"
    page = f"<section><h2>H</h2>{prose * 3}<pre>x = 1</pre><ul><li>i</li></ul></section><aside class='links'><ul>" + "<li>A</li>" * 10 + "</ul><math alttext='q'></math></aside>"
    df = spark.createDataFrame([(i, page) for i in range(5)], "identifier bigint, body string")
    verdicts = {r["path"]: (r["nodes"], r["is_content"]) for r in M.leaf_scores(M.parse_bodies(df, "body", ["identifier"])).collect()}
    assert verdicts["/body/aside.links/list_item"] == (50, False) and verdicts["/body/aside.links/formula"] == (5, False)
    assert {k for k, v in verdicts.items() if v[1]} == {f"/body/section/{k}" for k in ("heading", "p", "code", "list_item")}
    assert {(r["kind"], r["content"]) for r in M.structural_elements(df, "body", ["identifier"]).collect()} == {("heading", "H"), ("code", "x = 1"), ("list_item", "i")}


def test_a_small_container_leans_on_its_parent(spark):
    prose = "<p>A sentence, with marks; and words. It goes on, and on.</p>" * 30
    few = spark.createDataFrame([(1, f"<article>{prose}<div class='x'><h2>A heading</h2></div></article>")], "identifier bigint, body string")
    many = spark.createDataFrame([(i, f"<article>{prose}<div class='x'>{'<h2>A heading</h2>' * 30}</div></article>") for i in range(3)], "identifier bigint, body string")
    found = lambda df: [r["content"] for r in M.structural_elements(df, "body", []).collect()]
    assert found(few) == ["A heading"] and found(many) == []


def test_nested_templates_take_time_in_proportion():
    import time

    t = time.time()
    parsed = M.parse("<h2>A</h2>\n" + "{{a " * 40_000 + "}}" * 40_000 + "\n* x {{b|{{c}}}} y\n* {{d\n* z }}")
    assert time.time() - t < 3
    assert [e[:2] for e in parsed.elements] == [("heading", "A"), ("list_item", "x y")]
    assert M._without_templates("a {{b {{c}} d") == "a {{b  d" and M._without_templates("}} {{{x}}}") == "}} }"


def test_bodies_of_a_scan_are_not_shuffled(spark, small):
    from lexforge.session import table

    bodies = M.article_bodies(table(spark, small, "normal_articles"), table(spark, small, "edge_case_articles"))
    for b in bodies:
        got = M.distinct_bodies(b, "body", ["source_table", "identifier", "version_identifier"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, b.distinct().collect()))


ORDINARY = "<section><h2>H</h2><p>A sentence, with marks; and words. It goes on, and on.</p><ul><li>x</li></ul></section>"


def test_one_outlier_container_drops_no_ordinary_ones(spark):
    bodies = [ORDINARY] * 20 + ["<div class='x'><p>" + "a" * 4900 + "." * 100 + "</p></div>"]
    df = spark.createDataFrame(list(enumerate(bodies)), "identifier bigint, body string")
    assert {r["container"] for r in M.path_scores(M.parse_bodies(df, "body", ["identifier"])).filter("is_content").collect()} == {"/body/section", "/body/div.x"}
    got = sorted((r["identifier"], r["kind"]) for r in M.structural_elements(df, "body", ["identifier"]).collect())
    assert got == [(i, kind) for i in range(20) for kind in ("heading", "list_item")]


@pytest.mark.parametrize("region", ["<table><tr><td>{}</td></tr></table>", "<style>{}</style>", "<!-- {} -->", "\n| {} | b |\n"])
def test_removed_regions_do_not_count(spark, region):
    df = spark.createDataFrame([(i, region.format("a, b; c. " * 2000) + ORDINARY) for i in range(5)], "identifier bigint, body string")
    assert [(r["container"], r["is_content"]) for r in M.path_scores(M.parse_bodies(df, "body", ["identifier"])).collect()] == [("/body/section", True)]
    assert {(r["kind"], r["content"]) for r in M.structural_elements(df, "body", ["identifier"]).collect()} == {("heading", "H"), ("list_item", "x")}


def test_a_corpus_without_prose_keeps_its_elements(spark):
    df = spark.createDataFrame([(1, "<ul><li>a, b</li></ul>")], "identifier bigint, body string")
    assert [r["content"] for r in M.structural_elements(df, "body", ["identifier"]).collect()] == ["a, b"]


@pytest.mark.parametrize("body", ["```\nre \\( a \\[ b\n```\n", "\\begin{verbatim}\\begin{foo} <table> <h2>\\end{verbatim}\n", "```\n<table> <h2> <pre>\n```\n", "* a \\[ b\n", "== a \\( b ==\n", "<h2>a \\[ b</h2>\n", "text\n{| x\n\n* i\n", "* a <ref name='n'/> b\n"])
def test_a_long_body_gives_the_elements_of_a_short_one(body):
    padding = "\n\n" + "Some prose, to fill. " * 2000
    short, long = M.parse(body), M.parse(body + padding)
    assert short.elements and long.elements == short.elements
    assert M.clean_text(body + padding).startswith(M.clean_text(body))


@pytest.mark.parametrize("opener", ["<pre>", "<table>", "<h2>", "<ref>", "\\[", "\\begin{equation}", "\n{|", "<math>"])
def test_openers_behind_closers_of_other_kinds(opener):
    import time

    t = time.time()
    M.parse((opener + "word ") * 20_000 + "</pre x> </h3> </gallery> \\end{align} \\)")
    assert time.time() - t < 10
