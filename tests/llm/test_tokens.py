import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexforge.llm import bpe, packing, pieces

TEXTS = ["", None, "a", " ", "\n\n  x", "Hello world's end, don't!", "日本語のテキスト。カタカナー", "é" * 50, "xukabotifajalkanabihon" * 40, "a" * 3000, "ー" * 500, "🎉🎉 ok 𠀋", "<|endoftext|> is text", "\u200b\u3000１２３ ½", "tab\tand\r\nline", "ÀÉ" * 20 + "カ"]


@pytest.fixture(scope="module")
def reference():
    return packing.tokenizer("byte_bpe_50k")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load_vocabulary())


def test_ids_equal_the_tokenizer(encoder, reference):
    got = encoder.encode(TEXTS)
    assert got == [reference.encode_ordinary(t) if t else [] for t in TEXTS]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("abcdeあいカー ")), max_size=60))
def test_ids_of_random_texts(text):
    e = test_ids_of_random_texts.__dict__.setdefault("e", bpe.Encoder(bpe.load_vocabulary()))
    assert e.encode([text])[0] == packing.tokenizer("byte_bpe_50k").encode_ordinary(text)


@pytest.mark.parametrize("word", ["".join(random.Random(1).choice("aeioubcdfglmnprst") for _ in range(20_000)), "a" * 30_001, "ab" * 9_000 + "ba" * 777, "=-" * 3000 + "-" * 5000, " " * 4097 + "x", "".join(random.Random(2).choice("アイウエオカキクケコー") for _ in range(9_000))])
def test_long_words_without_blanks(encoder, reference, word):
    assert encoder.encode([word])[0] == reference.encode_ordinary(word)


def test_ids_equal_the_other_library(encoder):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{bpe.FOLDER}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    assert encoder.encode(TEXTS) == [t.encode(x, add_special_tokens=False).ids if x else [] for x in TEXTS]


def test_table_of_documents(spark, reference):
    df = spark.createDataFrame([(i, t, "clash", "x") for i, t in enumerate(TEXTS)] + [(0, "again", "c", "x")], "doc_id bigint, text string, ids string, lang string")
    got = sorted((r["doc_id"], tuple(r["ids"])) for r in bpe.encode_documents(df).collect())
    assert got == sorted([(i, tuple(reference.encode_ordinary(t)) if t else ()) for i, t in enumerate(TEXTS)] + [(0, tuple(reference.encode_ordinary("again")))])
    assert bpe.encode_documents(df.limit(0)).count() == 0


# packing


def _check(histogram, capacity):
    runs = packing.pack_histogram(histogram, capacity)
    held = {}
    for content, times in runs:
        assert times > 0 and sum(s * n for s, n in content) <= capacity
        for s, n in content:
            held[s] = held.get(s, 0) + n * times
    assert held == {s: n for s, n in histogram.items() if n}
    return sum(t for _, t in runs)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(0, 40), max_size=12))
def test_runs_hold_every_item(histogram):
    bins = _check(histogram, 30)
    total = sum(s * n for s, n in histogram.items())
    assert math.ceil(total / 30) <= bins <= max(1, math.ceil(2 * total / 30)) or total == 0


def _best(items, capacity):
    """Fewest containers by exhaustive search."""
    best = len(items)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for i in {r: i for i, r in enumerate(rooms) if r >= items[k]}.values():
            place(k + 1, rooms[:i] + [rooms[i] - items[k]] + rooms[i + 1 :])
        place(k + 1, [*rooms, capacity - items[k]])

    place(0, [])
    return best


def test_fixed_containers_cost_no_optimality():
    rng = random.Random(3)
    from collections import Counter

    for _ in range(60):
        items = sorted((rng.randint(1, 20) for _ in range(8)), reverse=True)
        left, runs = Counter(items), []
        packing._fix_dominating(left, sorted(left), 20, runs)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert sum(r.times for r in runs) + (_best(sorted(rest, reverse=True), 20) if rest else 0) == _best(items, 20)


def test_bad_sizes():
    with pytest.raises(ValueError):
        packing.pack_histogram({31: 1}, 30)


def test_documents_are_packed_whole(spark):
    rng = random.Random(5)
    sizes = [(i, rng.choice([0, 3, 5, 8, 10, 10, 10, 25, 30])) for i in range(400)] + [(7, 4), (7, 4), (None, 2)]
    df = spark.createDataFrame(sizes, "doc_id bigint, n_tokens int")
    rows = packing.pack_documents(df, 10).collect()
    load, seen = {}, {}
    for r in rows:
        load[r["container_id"]] = load.get(r["container_id"], 0) + r["token_end"] - r["token_start"]
        seen.setdefault(r["doc_id"], []).append((r["piece_no"], r["token_start"], r["token_end"]))
    assert max(load.values()) <= 10 and sorted(load) == list(range(1, len(load) + 1))
    assert len(load) <= math.ceil(sum(n for _, n in sizes) / 10) * 1.25
    assert sum(load.values()) == sum(n for _, n in sizes)
    for i, n in sizes:
        if i not in (7, None):
            assert len(seen[i]) == max(1, math.ceil(n / 10)) and sorted(seen[i])[-1][2] == n
    assert packing.pack_documents(df.limit(0), 10).count() == 0
    assert packing.pack_documents(df.filter("n_tokens = 0"), 10).select("container_id").distinct().count() == 1


# pieces


def _tree_check(level, limit):
    got = pieces.pack_tree(level, limit)
    assert [a for a, _, _ in got] == [0, *[b for _, b, _ in got][:-1]] and got[-1][1] == len(level) - 1
    return got


def test_tree_prefers_coarse_boundaries():
    import numpy as np

    level = np.full(101, 11, dtype=np.int8)
    level[[20, 60]] = 1
    level[[40, 80]] = 7
    assert [(a, b) for a, b, _ in _tree_check(level, 40)] == [(0, 20), (20, 60), (60, 100)]
    assert [(a, b) for a, b, _ in _tree_check(level, 60)] == [(0, 60), (60, 100)]
    assert all(b - a <= 7 for a, b, _ in _tree_check(level, 7))
    none = np.full(51, 12, dtype=np.int8)
    assert all(b - a <= 8 for a, b, _ in _tree_check(none, 8))


def test_pieces_cover_documents_and_overlap(spark, reference):
    long_ = "# One\n\n" + "A sentence here. Another one, with a clause; and more. " * 60 + "\n\n## Two\n\n- item one\n- item two\n\n" + "日本語の長い文章です。次の文、続き。" * 60 + "\n\n```\n" + "code line\n" * 80 + "```\n" + "無" * 700
    docs = [(1, long_), (2, "short"), (3, None), (4, ""), (5, "x" * 5000), (6, "🎉" * 400), (6, "🎉" * 400)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id bigint, text string, cut string")
    limits = spark.createDataFrame([(1, "piece", "byte_bpe_50k", 64, 16), (2, "piece", "byte_bpe_50k", 128, 0), (3, "container", "byte_bpe_50k", 64, 0)], "limit_id int, purpose string, tokenizer string, max_tokens int, overlap_tokens int")
    rows = pieces.split_documents(df, limits).collect()
    texts = dict(docs)
    for limit_id, most, overlap in ((1, 64, 16), (2, 128, 0)):
        for doc in {i for i, t in docs if t and len(reference.encode_ordinary(t)) > most}:
            own = sorted({(r["piece_no"], r["token_start"], r["token_end"], r["n_overlap"], r["text"]) for r in rows if (r["doc_id"], r["limit_id"]) == (doc, limit_id)})
            ids = reference.encode_ordinary(texts[doc])
            assert own[0][1] == 0 and own[-1][2] == len(ids)
            for p, q in zip(own, own[1:]):
                assert q[1] + q[3] == p[2] and (overlap <= q[3] or q[1] == p[1]) and q[3] <= overlap + 8 * bool(overlap)
            for _, s, e, _, text in own:
                assert e - s <= most and len(reference.encode_ordinary(text)) <= most
                assert b"".join(reference.decode_tokens_bytes(ids[s:e])).decode() == text
    assert {r["doc_id"] for r in rows} == {1, 5, 6} and len([r for r in rows if r["doc_id"] == 6]) % 2 == 0
    cuts = {r["cut"] for r in rows if r["doc_id"] == 1}
    assert {"start", "block"} <= cuts
    assert pieces.split_documents(df.limit(0), limits).count() == 0


def test_dominating_pairs_cost_no_optimality():
    from collections import Counter

    rng = random.Random(7)
    triples = 0
    for _ in range(300):
        items = sorted((rng.randint(5, 14) for _ in range(8)), reverse=True)  # three companions never fit
        left, runs = Counter(items), []
        packing._fix_dominating(left, sorted(left), 20, runs)
        triples += sum(r.times for r in runs if sum(n for _, n in r.content) == 3)
        rest = [s for s, n in left.items() for _ in range(n)]
        assert sum(r.times for r in runs) + (_best(sorted(rest, reverse=True), 20) if rest else 0) == _best(items, 20)
    assert triples > 20


def test_slots_in_ranges_give_the_same_containers(spark, monkeypatch):
    rng = random.Random(9)
    df = spark.createDataFrame([(i, rng.randint(0, 40)) for i in range(500)], "doc_id bigint, n_tokens int")
    want = sorted(map(tuple, packing.pack_documents(df, 32).collect()))
    monkeypatch.setattr(packing, "SLOT_ROWS", 5)
    assert sorted(map(tuple, packing.pack_documents(df, 32).collect())) == want


def test_vocabularies_of_two_folders_stay_apart(spark, tmp_path):
    import json

    source = json.loads(open(f"{bpe.FOLDER}/byte_bpe_50k.json", encoding="utf-8").read())
    source["model"]["merges"] = []
    (tmp_path / "byte_bpe_50k.json").write_text(json.dumps(source), encoding="utf-8")
    df = spark.createDataFrame([(1, "hello there")], "doc_id bigint, text string").coalesce(1)
    whole, bare = (bpe.encode_documents(df, folder=f).first()["ids"] for f in (bpe.FOLDER, str(tmp_path)))
    assert len(bare) == 11 > len(whole)


def _cuts(text, most, overlap=0):
    return pieces.cut_document(text, [(1, most, overlap)], packing.tokenizer("byte_bpe_50k"))


def test_nested_lists_are_cut_at_outer_items():
    sub = "".join(f"  - inner part {k} of it\n" for k in range(4))
    got = _cuts("".join(f"- outer item number {k}\n{sub}" for k in range(12)), 90)
    assert len(got) > 4 and {r[5] for r in got} == {"start", "item1"} and all(r[6].startswith("- outer") for r in got)
    # an item larger than a piece is cut at its inner items
    got = _cuts("- outer\n" + "".join(f"  - inner part {k} of it\n" for k in range(60)), 90)
    assert {r[5] for r in got} == {"start", "item2"}


def test_html_structure_is_read():
    item = "<li>some words of an item</li>"
    html = "".join(f"<h2>Part {k}</h2><p>Words of a paragraph, and more of them here.</p><ul>{item * 3}</ul>" for k in range(10))
    got = _cuts(html, 120)
    assert {r[5] for r in got} == {"start", "section2"} and all(r[6].lstrip(">").startswith("<h2>") for r in got)
    got = _cuts("<ul>" + "<li>outer<ul>" + item * 3 + "</ul></li>" * 1 + "<li>outer<ul>" + item * 30 + "</ul></li></ul>", 60)
    assert {r[5] for r in got} <= {"start", "item1", "item2"}


def test_a_heading_stays_with_its_text():
    text = "".join(f"## Part {k}\n\n" + "A sentence of some words here. " * 12 + "\n\n" + "Another one, a bit longer than that. " * 12 + "\n\n" for k in range(6))
    for r in _cuts(text, 100):
        assert not r[6].rstrip().rsplit("\n", 1)[-1].startswith("##")


def test_the_first_piece_is_as_long_as_the_overlap():
    text = "# T\n\n" + "Word after word without an end to it " * 100
    got = _cuts(text, 64, 32)
    assert got[0][3] >= 32 and all(r[4] >= 32 for r in got[1:])


def test_parts_of_opened_nodes_join_their_neighbours():
    text = "".join(f"# S{k}\n\n" + "Some words in here. " * 30 + "\n\n" + "Few words. " * 3 + "\n\n" for k in range(20))
    sizes = [r[3] - r[2] for r in _cuts(text, 128)]
    assert sum(sizes[:-1]) / len(sizes[:-1]) > 0.7 * 128 and min(sizes[:-1]) > 25
