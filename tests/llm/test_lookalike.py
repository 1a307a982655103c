import unicodedata

import pytest

from lexforge.llm import lookalike as L

SAME = [
    ("Orb", "Оrb"), ("Orb", "Ｏｒｂ"), ("Orb", "O\u200br\u00adb\ufe00\U000e0100"), ("a b", "a\u00a0b"), ("a b", "\u3000a\u2009b "), ("カ", "力"), ("ガ", "ｶﾞ"), ("パン", "ﾊﾟﾝ"), ("é", "e\u0301"), ("fi", "ﬁ"), ("山", "⼭"),
    ("A-B", "A‐B"), ("ニ", "二"), ("ソー", "ソ一"), ("(a)", "（ａ）"), ("Á", "Α\u0301"), ("カ゛", "ｶﾞ"), ("x\u2060y", "xy"), ("２", "2"),
]
DIFFERENT = [
    ("Orb", "orb"), ("e", "é"), ("ツ", "ッ"), ("あ", "ア"), ("x2", "x²"), ("1", "①"), ("ab", "a-b"), ("a", "a!"), ("ab", "a b"), ("ハ", "バ"), ("n", "ñ"), ("カー", "カ"), ("o", "ö"), ("ö", "о"), ("a", ""),
]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_equal_looks(a, b):
    assert L.skeleton(a) == L.skeleton(b)


@pytest.mark.parametrize(("a", "b"), DIFFERENT)
def test_different_looks(a, b):
    assert L.skeleton(a) != L.skeleton(b)


def test_skeletons_are_stable_and_empty_texts_defined():
    assert L.skeleton("") == "" and L.skeleton("\u200b \u00ad") == ""
    for pair in SAME:
        for t in pair:
            assert L.skeleton(L.skeleton(t)) == L.skeleton(t)


def test_reading_keeps_the_script_and_is_one_to_one():
    model = {"\x02" + L.mark("О"): 5.0, L.mark("О") + L.mark("р"): 9.0, L.mark("р") + L.mark("б"): 9.0, "\x02" + L.mark("O"): 50.0, L.mark("O") + L.mark("p"): 90.0}
    reader = L.Reader(model)
    assert reader.read(L.skeleton("Орех")) == reader.read(L.skeleton("Opex"))
    assert reader.read("カナ") == "カナ"
    looks = {L.skeleton(t) for p in SAME + DIFFERENT for t in p}
    assert len({reader.read(s) for s in looks}) == len(looks)
    assert all(L.skeleton(reader.read(s)) == s for s in looks)


def test_viterbi_equals_brute_force():
    import itertools
    import random

    rng = random.Random(1)
    letters = "АAOОοcсe"
    model = {a + b: float(rng.randint(0, 50)) for a in [*map(L.mark, letters), "\x02"] for b in [*map(L.mark, letters), "\x03"]}
    reader = L.Reader(model)
    for _ in range(20):
        look = L.skeleton("".join(rng.choice(letters) for _ in range(4)))
        score = lambda t: sum(reader.step(x, y) for x, y in zip("\x02" + t, t + "\x03"))
        best = max(score("".join(c)) for c in itertools.product(*(reader.members.get(ch, ch) for ch in look)))
        assert score(reader.read(look)) == pytest.approx(best)


def test_pairs_equal_brute_force(spark):
    texts = [(i, t) for i, t in enumerate(t for p in SAME + DIFFERENT for t in p)]
    rows = texts + [(0, "extra"), (1, texts[0][1]), (500, None), (501, ""), (502, " "), (None, "Orb")] + [(1000 + i, "Orb") for i in range(30)]
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], "key bigint, text string, skeleton string")
    known = [(k, t) for k, t in rows if k is not None and t is not None]
    want = {(min(a, b), max(a, b)) for a, x in known for b, y in known if a != b and x != y and L.skeleton(x) == L.skeleton(y)}
    got = [tuple(r) for r in L.lookalike_pairs(df, "key", "text").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert L.lookalike_pairs(df.limit(0), "key", "text").count() == 0


def test_forms_of_a_table(spark):
    df = spark.createDataFrame([(1, "Оrb"), (2, "Orb"), (3, None), (4, "\u200b"), (5, "あ" * 100_000)], "key bigint, text string")
    got = {r["key"]: r["canonical"] for r in L.canonical_forms(df, "text").collect()}
    assert got[1] == got[2] and got[3] is None and got[4] == "" and got[5] == "あ" * 100_000
    assert {r["skeleton"] for r in L.with_skeleton(df, df["text"]).filter("key < 3").collect()} == {"Orb"}
    assert unicodedata.normalize("NFC", got[1]) == got[1]


WORDS = "Paypal Capital Island Illinois Isabella alphabet policy people apple palace Ireland Berlin Lille Milan Italy local little village hill valley level royal imperial capital polar Ptolemy Google Oslo London Toronto 2010 1990 2001 1111 1101 rota wool Orb Iris Ilia".split()


def trained(words):
    from collections import Counter

    pairs = Counter(L.mark(a) + L.mark(b) for w in words for a, b in zip("\x02" + L.plain(w), L.plain(w) + "\x03"))
    return L.Reader({k: float(v) for k, v in pairs.items()})


def test_context_decides_between_letters_taken_for_each_other():
    reader = trained(WORDS * 200)
    form = lambda t: reader.read(L.skeleton(t))
    assert form("PaypaI") == form("Paypal") == "Paypal" and form("peoρle") == form("people") == "people" and form("Lond0n") == "London" and form("αlphabet") == "alphabet"
    # where both make sense they stay apart
    assert form("Iris") != form("Lris") and form("2010") == "2010" and form("1990") == "1990" and form("Illinois") == "Illinois"
    assert len({form(w) for w in WORDS}) == len(set(WORDS))


def test_planted_look_alikes_are_found_and_different_words_kept_apart():
    import random

    rng = random.Random(5)
    reader = trained(WORDS * 200)
    _, members = L.classes()
    # beyond the old Latin, Greek and Cyrillic letters: Cherokee, Armenian, small capitals, letter-like numerals
    swaps = {c: [m for m in members.get(c, c) if ord(m) > 0x52F] for c in set("".join(WORDS))}
    found = tried = 0
    for _ in range(500):
        word = rng.choice([w for w in WORDS if w.isalpha()])
        at = [i for i, c in enumerate(word) if swaps[c]]
        if at:
            i = rng.choice(at)
            tried += 1
            found += reader.read(L.skeleton(word[:i] + rng.choice(swaps[word[i]]) + word[i + 1 :])) == reader.read(L.skeleton(word))
    assert tried > 200 and found >= 0.99 * tried
    near = [(w, w[:i] + o + w[i + 1 :]) for w in WORDS if w.isalpha() for i, c in enumerate(w) for line in L.NEAR if c in line.split(" ") for o in line.split(" ") if o != c and i]
    assert sum(reader.read(L.skeleton(a)) == reader.read(L.skeleton(b)) for a, b in near) >= 0.9 * len(near)


def test_classes_count_spellings_and_keys(spark):
    rows = [(1, "Orb"), (2, "Orb"), (2, "Orb"), (3, "Оrb"), (4, "x"), (5, None), (None, "Orb"), (6, "")]
    got = {r["text"]: (r["keys"], r["spellings"], r["class_keys"]) for r in L.look_classes(spark.createDataFrame(rows, "key bigint, text string"), "key", "text").collect()}
    assert got == {"Orb": (2, 2, 3), "Оrb": (1, 2, 3), "x": (1, 1, 1), "": (1, 1, 1)}


def test_a_hot_class_is_spread(spark, monkeypatch):
    monkeypatch.setattr(L, "PAIR_KEYS", 7)
    rows = [(i, "Orb") for i in range(60)] + [(100 + i, "Оrb") for i in range(5)] + [(200, "Ｏrb"), (0, "Оrb")]
    got = {tuple(r) for r in L.lookalike_pairs(spark.createDataFrame(rows, "key bigint, text string"), "key", "text").collect()}
    assert got == {(min(a, b), max(a, b)) for a, x in rows for b, y in rows if a != b and x != y}
