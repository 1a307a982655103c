import random

import pytest
from pyspark.sql import functions as F

from lexforge.llm import survivor as S

STATES = "page_id bigint, revision_id bigint, source_hash string, source_sequence bigint, title string, ingest_status string, is_deleted boolean, seen_at timestamp, hash string, own int"
DUPLICATES = "page_id bigint, kept_revision_id bigint, kept_hash string, source_sequence bigint"
H = ["a" * 64, "B" * 64, " " + "c" * 64 + "\n", "d" * 63, "g" * 64, "", None]


def clean(h):
    h = (h or "").strip().lower()
    return h if len(h) == 64 and set(h) <= set("0123456789abcdef") else None


def enumerate_best(bundles, allowed):
    """All choices, a bundle empty only where nothing of it is allowed; the highest sum."""
    best = None

    def go(k, trust, chosen):
        nonlocal best
        if k == len(bundles):
            best = trust if best is None or trust > best else best
            return
        fit = [c for c in bundles[k] if allowed(chosen, k, c[1])]
        for t, v in fit or [((0, 0), None)]:
            go(k + 1, tuple(map(sum, zip(trust, t))), [*chosen, v])

    go(0, (0, 0), [])
    return best


def test_branch_and_bound_equals_enumeration():
    rng = random.Random(1)
    for _ in range(300):
        bundles = [[((rng.randint(0, 3), rng.randint(0, 3)), (i, rng.randint(0, 3))) for i in range(rng.randint(1, 5))] for _ in range(rng.randint(1, 4))]
        allowed = lambda chosen, k, v: not chosen or chosen[-1] is None or chosen[-1][1] + v[1] != 3
        found = S.branch_and_bound(bundles, allowed)
        trusts = [next(t for t, v in b if v == f) if f is not None else (0, 0) for b, f in zip(bundles, found)]
        assert tuple(map(sum, zip(*trusts))) == enumerate_best(bundles, allowed)
        assert all(allowed(found[:k], k, f) for k, f in enumerate(found) if f is not None)
    assert S.branch_and_bound([[]], lambda c, k, v: True) == [None]


ADDRESS = "person string, source string, city string, postcode string, street string, clash string"


def address_bundles():
    trust = S.source_trust(F.col("source"), {"register": 5, "shop": 3, "web": 1})
    return [
        S.Bundle("city", ("city",), ((0, trust),), F.col("city").isNotNull()),
        S.Bundle("place", ("postcode",), ((0, trust * 2),), F.col("postcode").isNotNull()),
        S.Bundle("street", ("street",), ((0, trust * 2),), F.col("street").isNotNull()),
    ], [S.Dependency("city", "place"), S.Dependency("city", "street")]


def test_the_best_of_each_bundle_is_inconsistent_and_greedy_choice_is_not_best(spark):
    # the most trusted city comes without the other parts, which only the less trusted sources have for another city
    rows = [("a", "register", "Orb", None, None, "x"), ("a", "shop", "Nem", "100", None, "x"), ("a", "shop", "Nem", None, "Mill Lane", "x"), ("a", "web", "Orb", "999", None, "x")]
    rows += [("b", "register", "Orb", "1", "S", "x"), ("b", "web", "Nem", "2", "T", "x"), (None, "web", "Nem", "2", "T", "x"), ("c", "nobody", None, None, None, None)]
    bundles, dependencies = address_bundles()
    df = spark.createDataFrame(rows + rows[:3], ADDRESS)
    got = {r["person"]: tuple(r)[1:] for r in S.consolidate(df, group="person", bundles=bundles, dependencies=dependencies, counts={"n": F.lit(1)}).collect()}
    # best of each: Orb, 100, Mill Lane (no such place); greedy: Orb, 999, none = 5 + 2; best: Nem, 100, Mill Lane = 3 + 6 + 6
    assert got == {"a": (7, "Nem", "100", "Mill Lane"), "b": (2, "Orb", "1", "S"), "c": (1, None, None, None)}


def test_consolidate_equals_enumeration(spark):
    rng = random.Random(3)
    sources = {"register": 5, "shop": 3, "web": 1}
    rows = [(rng.choice("abcdefgh"), rng.choice([*sources, "other"]), rng.choice([None, "Orb", "Nem", "Ulm"]), rng.choice([None, "1", "2"]), rng.choice([None, "S", "T"]), "x") for _ in range(60)]
    bundles, dependencies = address_bundles()
    got = S.consolidate(spark.createDataFrame(rows, ADDRESS), group="person", bundles=bundles, dependencies=dependencies).collect()
    assert len(got) == len({r[0] for r in rows})
    for r in got:
        own = [x for x in rows if x[0] == r["person"]]
        trust = lambda x: sources.get(x[1], 0)
        cities, codes, streets = ([((trust(x) * w, 0), (x[2], x[c])) for x in own if x[c] is not None] for c, w in ((2, 1), (3, 2), (4, 2)))
        allowed = lambda chosen, k, v: k == 0 or chosen[0] is None or chosen[0][0] == v[0]
        best = enumerate_best([cities, codes, streets], allowed)[0]
        value = lambda options, v, city: max((t[0] for t, o in options if o[1] == v and (city is None or o[0] == city)), default=None)
        found = [value(cities, r["city"], None), value(codes, r["postcode"], r["city"]), value(streets, r["street"], r["city"])]
        assert [f is None for f in found] == [r[c] is None for c in ("city", "postcode", "street")]
        assert sum(f or 0 for f in found) == best


def test_chained_dependencies_and_cycles(spark):
    rows = [(1, "x", "p", "u", 3), (1, "x", "q", "v", 2), (1, "y", "q", "w", 9)]
    df = spark.createDataFrame(rows, "g int, a string, b string, c string, n int")
    bundles = [S.Bundle("c", ("c",), ((0, F.col("n")),)), S.Bundle("b", ("b",), ((0, F.col("n")),)), S.Bundle("a", ("a",), ((0, F.when(F.col("a") == "x", 20)),))]
    chain = [S.Dependency("a", "b"), S.Dependency("b", "c")]
    # a = x brings 20; then b = p (3) with c = u (3), or b = q (2) with c = w (9)
    assert [tuple(r) for r in S.consolidate(df, group="g", bundles=bundles, dependencies=chain).collect()] == [(1, "w", "q", "x")]
    with pytest.raises(ValueError, match="cycle"):
        S.consolidate(df, group="g", bundles=bundles, dependencies=[*chain, S.Dependency("c", "a")]).collect()


def test_against_brute_force(spark):
    rng = random.Random(2)
    states = [(rng.randint(1, 30), rng.choice([None, 1, 2, 3]), rng.choice(H), i, rng.choice([None, "t"]), rng.choice(["accepted", "rejected"]), False, None, "clash", 7) for i in range(200)]
    states += [(99, rng.randint(1, 50), rng.choice(H), 1000 + i, "t", "accepted", False, None, "x", 1) for i in range(500)]
    states += states[:20] + [(None, 1, H[0], 1, None, None, None, None, None, None), (77, 4, H[0], None, None, None, None, None, None, None), (77, 4, H[1], 5, None, None, None, None, None, None)]
    dups = [(rng.randint(1, 35), rng.choice([None, 1, 2, 3, 4]), rng.choice(H), 300 + i) for i in range(80)]
    want = set()
    for p in {s[0] for s in states if s[0] is not None}:
        known = [(s[1], clean(s[2]), s[3]) for s in states if s[0] == p] + [(d[1], clean(d[2]), d[3]) for d in dups if d[0] == p]
        revisions = [k[0] for k in known if k[0] is not None]
        if sum(s[0] == p for s in states) >= 2 and revisions:
            top = max(revisions)
            hashes = [(k[2] if k[2] is not None else 2**62, k[1]) for k in known if k[0] == top and k[1]]
            want.add((p, top, min(hashes)[1] if hashes else None))
    a, b = spark.createDataFrame(states, STATES), spark.createDataFrame(dups, DUPLICATES)
    assert {tuple(r) for r in S.surviving_duplicates(a, b).collect()} == want


def test_bundles_stay_whole(spark):
    rows = [(1, 1, H[0], 1, "old", "accepted", False, "2027-01-01"), (1, 2, None, 2, None, "rejected", None, None), (2, 1, H[0], 1, "only", "accepted", True, "2027-02-01")]
    a = spark.createDataFrame(rows, "page_id bigint, revision_id bigint, source_hash string, source_sequence bigint, title string, ingest_status string, is_deleted boolean, s string").withColumn("seen_at", F.to_timestamp("s"))
    b = spark.createDataFrame([(2, 5, H[1], 9), (3, 1, H[1], 9)], DUPLICATES)
    got = {r["page_id"]: r for r in S.surviving_states(a, b).collect()}
    assert (got[1]["revision_id"], got[1]["source_hash"], got[1]["title"], got[1]["ingest_status"]) == (2, None, None, "rejected")
    assert (got[2]["revision_id"], got[2]["source_hash"], got[2]["title"], got[2]["is_deleted"], got[2]["source_sequence"]) == (5, "b" * 64, "only", True, 9)
    assert got[3]["title"] is None and got[3]["own_rows"] == 0
    assert str(got[2]["seen_at"]) == "2027-02-01 00:00:00"


def test_empty_tables(spark):
    a, b = spark.createDataFrame([], STATES), spark.createDataFrame([], DUPLICATES)
    assert S.surviving_duplicates(a, b).count() == 0
