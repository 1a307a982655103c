import random
from datetime import datetime, timezone

import pytest

from lexforge.operators import orphans, skew

E = "tag string, page_id bigint, title string, aliases array<string>, internal_targets array<string>, is_deleted boolean, rendered_at timestamp, key string"
L = "source_page_id bigint, namespace string, title string, parsed_at timestamp, key string"


def at(month, day=1):
    return datetime(2027, month, day, 12, tzinfo=timezone.utc)


def _frames(spark, entries, links):
    return spark.createDataFrame([(*e, "clash") for e in entries], E), spark.createDataFrame([(*x, "clash") for x in links], L)


def _brute(entries, links):
    def there(tags, month):
        for t in tags:
            past = sorted((e[6], bool(e[5])) for e in entries if e[0] == t and e[6] is not None and e[6].month <= month)
            if past and not past[-1][1]:
                return True
        return False

    out = set()
    for e in entries:
        if not e[5]:
            for t in e[4] or []:
                if t and not there({t}, e[6].month):
                    out.add(("entries", e[1], t, f"2027-{e[6].month:02d}"))
    for page, ns, title, when in links:
        if title is None or ns is not None:
            continue
        name = title.replace("_", " ").strip()
        tags = {e[0] for e in entries if e[2] == name or name in (e[3] or [])}
        if not there(tags, when.month):
            out.add(("links", page, title, f"2027-{when.month:02d}"))
    return out


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_against_brute_force_with_a_hot_title(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(orphans, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(skew, "LEAST", 100)
    rng = random.Random(5)
    entries = []
    for i in range(300):
        t = rng.randint(1, 40)
        gone = rng.random() < 0.2
        entries.append((f"p{t}", t, None if gone else f"T {t}", None if gone else rng.choice([None, [], [f"A{t}", f"A{t}"], [None]]), None if gone else rng.choice([None, [], [f"p{rng.randint(1, 60)}", None, "", f"p{t}"]]), gone, at(rng.randint(1, 6), rng.randint(1, 27))))
    links = [(rng.randint(1, 30), rng.choice([None, None, None, "Help"]), rng.choice([f"T {rng.randint(1, 60)}", f"T_{rng.randint(1, 60)} ", f"　A{rng.randint(1, 60)}", None, ""]), at(rng.randint(1, 7))) for _ in range(500)]
    links += [(i, None, "T_1", at(3)) for i in range(400)]
    e, x = _frames(spark, entries, links)
    want = _brute(entries, links)
    assert {tuple(r) for r in orphans.orphan_references(e, x).collect()} == want
    # a filter that is far too small only sends more references to the exact join
    assert {tuple(r) for r in orphans.orphan_references(e, x, max_bits=64).collect()} == want


def test_the_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).selectExpr("'t' as table_name", "cast(id as string) as key")
    words = orphans.build_bloom(keys, ["table_name", "key"], expected=5000)
    probed = spark.range(20000).selectExpr("'t' as table_name", "cast(id as string) as key", "id").withColumn("hit", orphans.probe_bloom(spark, words, ["table_name", "key"]))
    assert probed.filter("id < 5000 and not hit").count() == 0
    assert probed.filter("id >= 5000 and hit").count() < 600


def test_empty_tables_and_report(spark):
    e, x = _frames(spark, [], [])
    assert orphans.orphan_references(e, x).count() == 0
    e, x = _frames(spark, [], [(1, None, "a", at(1)), (1, None, "b", at(1)), (2, None, "a", at(1)), (2, None, "a", at(2))])
    got = {tuple(r) for r in orphans.orphan_report(orphans.orphan_references(e, x)).collect()}
    assert got == {("links", "2027-01", 3, 2), ("links", "2027-02", 1, 1)}


def test_a_deletion_at_the_same_instant_comes_last(spark):
    entries = [("p1", 1, "T", None, None, False, at(1)), ("p1", 1, None, None, None, True, at(1))]
    e, x = _frames(spark, entries, [(5, None, "T", at(1))])
    assert orphans.orphan_references(e, x).count() == 1
