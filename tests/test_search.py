import random

from pyspark.sql import functions as F

from lexforge.functions import charset, hashing, strings, urls
from lexforge.operators import compare, sampling, search
from lexforge.plans import search_queries


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "c string").select(column(F.col("c")).alias("v")).first()["v"]


def test_keys_and_variants(spark):
    assert one(spark, " Ｇｎｕ　 Straße ", strings.index_key) == "gnu strasse"
    assert one(spark, " 　", strings.index_key) is None and one(spark, None, strings.index_key) is None
    assert one(spark, " ｱ B ", strings.nfkc_title) == "ア B"
    assert one(spark, "あイー", strings.kana_swapped) == "アいー" and one(spark, "abc", strings.kana_swapped) is None
    assert one(spark, "a-b!", strings.without_punctuation) == "ab" and one(spark, "!?", strings.without_punctuation) is None
    assert one(spark, "Orb （film）", strings.parenthetical_base) == "Orb" and one(spark, "Orb", strings.parenthetical_base) is None
    assert one(spark, "ab-c 1", strings.backend_key) == "ＡＢＣ１" and one(spark, "-' ", strings.backend_key) is None
    assert one(spark, "𠀋x", strings.code_point_fallback) == "[U+2000B]"
    r = spark.createDataFrame([("東京", "東京（とうきょう、英: Tokyo）は"), ("x", "y")], "t string, b string").select(strings.reading(F.col("t"), F.array("b")).alias("r")).collect()
    assert [x["r"] for x in r] == ["とうきょう", None]


def test_readings_anywhere_in_the_lead(spark, monkeypatch):
    rows = [
        ("X", "Lead. " * 1000 + "X（えっくす）", "えっくす"),
        ("X (film)", "X（エックス）", "えっくす"),
        ("X (film)", "X (film)（えっくす）", None),  # only the name without its bracket counts, as in the reference
        ("X", "X (1990), later 『X』（えっくす）", "えっくす"),
        ("X", "X (left open, X（えっくす）", None),  # one bracket up to its first closing sign
        ("X", "X（Ex／えっくす）", "えっくす"),
        ("X", "# X\n\nLead.\n\n## Name\n\nX（えっくす）", None),
        ("X", "Lead.\n\n■ Name\n\nX（えっくす）", None),
        ("X", "Lead.\n\n== Name ==\n\nX（えっくす）", None),
        ("X", "X (1) X（えっくす）", "えっくす"),
        ("X", "```\n\n# no heading\n\n```\n\nX（えっくす）", "えっくす"),
        ("", "（えっくす）", None), ("(film)", "（えっくす）", None), (None, "X", None), ("X", None, None),
    ]
    df = spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(rows)], "doc_id bigint, title string, text string")
    monkeypatch.setattr(search_queries, "table", lambda spark, d, name: df)
    got = {r["doc_id"]: r["reading"] for r in search_queries.x05_readings(spark, "").collect()}
    assert [got[i] for i in range(len(rows))] == [r[2] for r in rows]


def test_urls(spark):
    def parse(u):
        return one(spark, u, lambda c: urls.parse_internal(c, ("https://w.example/",)))

    assert tuple(parse("./A%20b_c?x#f%20")) == (None, "A b c", "f ") or tuple(parse("./A%20b_c#f"))[1] == "A b c"
    assert tuple(parse("/wiki/File:X.png")) == ("File", "X.png", None)
    assert tuple(parse("https://w.example/wiki/C++%")) == (None, "C++%", None)
    assert parse("https://other.example/wiki/A") is None and parse("./#x") is None and parse("") is None
    assert [one(spark, u, urls.is_safe_external) for u in ("https://a", "//a/b", "javascript:x", "http://")] == [True, True, False, False]


def test_ranks_budgets_and_collisions(spark):
    pages = spark.createDataFrame([(1, "Orb (film)"), (2, "Orb"), (3, None)], "page_id bigint, title string")
    hops = spark.createDataFrame([(1, "Old Orb")], "page_id bigint, title string")
    terms = search.title_terms(pages, hops)
    keys = {(r["page_id"], r["normalized_key"], r["kind"]) for r in terms.collect()}
    assert {(1, "orb (film)", "title"), (1, "orb", "alias"), (1, "old orb", "redirect"), (1, "oldorb", "alias"), (2, "orb", "title")} <= keys
    assert [tuple(r) for r in search.collisions(terms).collect()] == [("orb", 2, 2, "normalize")]
    heads = {r["page_id"]: r["headwords"] for r in search.headwords(terms, pages).collect()}
    assert heads[1][:2] == ["Orb (film)", "Old Orb"] and heads[3] == [None]
    kw = spark.createDataFrame([(1, ["a", "A", "b", "c", None, ""])], "page_id bigint, headings array<string>")
    budget = search.budgeted(search.heading_terms(kw), max_terms=1, stop_words=("a",))
    assert [r["key"] for r in budget.collect()] == ["b"]
    assert search.budgeted(search.heading_terms(kw), max_terms=9, max_key_bytes=0).count() == 0


def test_query_set_equals_brute_force(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(200)]
    rows = [(i, w, w, rng.choice(["title", "alias", "keyword", "cross_component"]), rng.choice([100, 800, 1000]), "s") for i, w in enumerate(words)]
    terms = spark.createDataFrame(rows, "page_id bigint, key string, normalized_key string, kind string, priority int, source string")
    qs = [(f"q{i}", q, True) for i, q in enumerate(["a", "ab", "abca", "abcab", "cc", "zzz", words[0], words[1]])]
    got = {(r["query_key"], r["mode"], r["page_id"]) for r in search.run_queries(terms, search.query_frame(spark, qs, search.MODES), max_results=500).collect()}
    free = lambda r: r[3] not in search.BUDGETED
    test = {"exact": lambda r, q: free(r) and r[2] == q, "word": lambda r, q: free(r) and r[2].startswith(q), "endword": lambda r, q: free(r) and r[2].endswith(q), "keyword": lambda r, q: r[3] == "keyword" and r[2] == q, "cross": lambda r, q: r[3] == "cross_component" and r[2] == q}
    assert got == {(k, m, r[0]) for k, q, _ in qs for m in search.MODES for r in rows if test[m](r, q)}
    few = search.run_queries(terms, search.query_frame(spark, [("q", "a", True)], ("word",)), max_results=3).collect()
    assert len(few) == 3 and all(r["truncated"] for r in few) and [r["rank"] for r in few] == [1, 2, 3]


def test_lookup_contract():
    assert search.lookup_mode("x") == (("exact",), "x") and search.lookup_mode("x*") == (("word",), "x") and search.lookup_mode("@x") == (("keyword", "cross"), "x")


def test_stratified_sample_equals_greedy(spark):
    rng = random.Random(4)
    kinds = ["long_article", "table_heavy", "technical", "list_article"]
    rows = [(i, i * 3, rng.sample(kinds, rng.randint(1, 2)) if rng.random() < 0.4 else ["baseline"]) for i in range(400)]
    taken, counts = [], {}
    for k, _, s in rows:
        if len(taken) < 40 and s != ["baseline"] and any(counts.get(x, 0) < 6 for x in s):
            taken.append(k)
            for x in s:
                counts[x] = counts.get(x, 0) + 1
    taken += [k for k, _, s in rows if s == ["baseline"]][: 40 - len(taken)]
    df = spark.createDataFrame(rows, "k bigint, a bigint, strata array<string>").repartition(5)
    assert {r["k"] for r in sampling.stratified(df, key="k", arrival="a", total=40, per_stratum=6).collect()} == set(taken)


def test_systematic_sample(spark):
    df = spark.range(0, 2000, 2).selectExpr("id as k", "'x' as _n").repartition(7)
    assert sorted(r["k"] for r in sampling.systematic(df, key="k", size=10).collect()) == [200 * i for i in range(10)]
    assert sampling.systematic(df.limit(0), key="k", size=10).count() == 0


def test_characters(spark):
    texts = spark.createDataFrame([(1, "aあ𠀋€"), (2, "𠀋"), (3, None), (4, "")], "k bigint, t string")
    assert {r["ch"]: r["n"] for r in charset.histogram(texts, "t").collect()} == {"a": 1, "あ": 1, "𠀋": 2, "€": 1}
    rare = charset.classify(charset.histogram(texts, "t"))
    assert {r["ch"]: (r["char_class"], r["width_class"]) for r in rare.collect()} == {"a": ("A", "narrow"), "あ": ("A", "wide"), "𠀋": ("C", "wide"), "€": ("C", "narrow")}
    plan = charset.code_plan(rare.filter("char_class = 'C'").drop("char_class"), per_width=1)
    assert {r["ch"]: r["code"] for r in plan.collect()} == {"𠀋": "wide-0001", "€": "narrow-0001"}
    got = texts.select("k", charset.embed(F.col("t"), plan).alias("t")).orderBy("k").collect()
    assert [r["t"] for r in got] == ["aあ[wide-0001][narrow-0001]", "[wide-0001]", None, ""]
    assert charset.unrepresentable_examples(texts, "k", "t", examples=1).filter("ch = '𠀋'").first()["examples"] == [1]
    kept = spark.createDataFrame([("wide-0001", "𠀋", False), ("narrow-0001", "€", True)], "code string, ch string, kept boolean")
    assert spark.createDataFrame([("x[wide-0001][narrow-0001]",)], "t string").select(charset.rewrite_tokens(F.col("t"), kept).alias("t")).first()["t"] == "x[U+2000B][narrow-0001]"


def test_hashes_ignore_order(spark):
    a = spark.createDataFrame([("g", "n1", "x"), ("g", "n2", None), ("h", "n1x", "")], "s string, n string, c string")
    b = spark.createDataFrame([("g", "n2", None), ("h", "n1x", ""), ("g", "n1", "x")], "s string, n string, c string").repartition(3)
    h = lambda df: {r["s"]: r["set_hash"] for r in hashing.stream_set_hash(df, name="n", content="c", by="s").collect()}
    assert h(a) == h(b) and len(set(h(a).values())) == 2
    lists = spark.createDataFrame([(["a", "b"],), (["b", "a"],), (None,), ([],)], "x array<string>").select(hashing.sorted_hash(F.col("x")).alias("v")).collect()
    assert lists[0] == lists[1] and lists[2] == lists[3] and lists[0] != lists[2]


def test_comparison(spark):
    ref = spark.createDataFrame([("a", True, ["x", "y"]), ("b", False, []), ("c", True, ["z"])], "query_key string, expected_presence boolean, headings array<string>")
    cand = spark.createDataFrame([("a", ["y", "x"]), ("b", ["w"])], "query_key string, headings array<string>")
    rows = {r["query_key"]: r for r in compare.compare_hits(ref, cand).collect()}
    assert (rows["a"]["overlap_at_n"], rows["a"]["rank_agreement_at_n"], rows["b"]["overlap_at_n"], rows["c"]["candidate_missing"]) == (1.0, 0.0, None, True)
    s = compare.evaluate(compare.compare_summary(compare.compare_hits(ref, cand))).first()
    assert (s["total"], s["false_positives"], s["missing"], s["passed"]) == (3, 1, 1, False)
    diff = compare.chunk_diff(spark.createDataFrame([("1", 5, "a"), ("2", 5, "b")], "chunk_key string, size_bytes bigint, sha256 string"), spark.createDataFrame([("2", 7, "c"), ("3", 1, "d")], "chunk_key string, size_bytes bigint, sha256 string"))
    assert tuple(compare.diff_summary(diff).first()) == (1, 1, 1, 0, -2)


READINGS = [
    ("東京", ["東京（とうきょう、英: Tokyo）は"], "とうきょう"), ("林檎 (果物)", ["林檎（りんご）は果物"], "りんご"), ("林檎（果物）", ["『林檎』（リンゴ）"], "りんご"), ("a", ["a (b) と a (あ)"], "あ"),
    ("a", ["x", "a（b[1]／[12]かな[3] , 後）"], "かな"), ("a", ["a（か・な）a（か な）"], None), ("a", ["a（b；かな）"], None), ("a", ["a（" + "b" * 126 + "、か）"], "か"), ("a", ["a（" + "b" * 127 + "、か）"], None),
    ("a\\E.b", ["a\\E.b（かな）"], "かな"), ("a.b", ["axb（かな）"], None), ("a", ["a\u3000（ ヴァヶ、x）"], "ゔぁゖ"), ("a", ["a[1]（かな）"], None), ("a (b)", ["a (b)（かな）"], None), ("(b)", ["(b)（かな）"], None),
    ("a", ["a", "（かな）"], None), ("a", [], None), (None, ["a（かな）"], None), ("a", None, None), ("a", ["言葉" * 5000 + "a（かな）"], "かな"), ("A", ["a（かな）"], None), ("a", ["a（[x]かな、かな）"], "かな"),
]


def test_readings(spark):
    df = spark.createDataFrame([(i, t, p) for i, (t, p, _) in enumerate(READINGS)], "i int, t string, p array<string>")
    got = {r["i"]: r["r"] for r in df.select("i", strings.reading(F.col("t"), F.col("p")).alias("r")).collect()}
    assert [got[i] for i in range(len(READINGS))] == [want for _, _, want in READINGS]


def test_lead_text(spark):
    texts = ["a\n\n## B\n\nc", "a\n\n== B ==\n\nc", "a\n```\nx（かな）\n```\nb", "a\n## no\nb", None, ""]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(strings.lead_text(F.col("t"))).collect()]
    assert got == ["a", "a", "a\n\nb", "a\n## no\nb", None, ""]
