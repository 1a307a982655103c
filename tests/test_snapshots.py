import random

from pyspark.sql import functions as F

from lexforge.operators import snapshots


def _frames(spark, rows, locks):
    schema = "snapshot_identifier string, identifier bigint, version struct<identifier:bigint>, article_body struct<html:string,wikitext:string>, change_kind string"
    a = spark.createDataFrame([(s, k, None if v is None else (v,), (h, w), "clash") for s, k, v, h, w in rows], schema)
    return a, spark.createDataFrame(locks, "snapshot_identifier string, date_modified timestamp, project string")


def _brute(rows, order):
    state = {s: {} for s in order}
    for s, k, v, h, w in rows:
        if s in state and k is not None and v is not None and (k not in state[s] or v > state[s][k][0]):
            state[s][k] = (v, h, w)
    out = set()
    for a, b in zip(order, order[1:]):
        for k in state[a].keys() | state[b].keys():
            kind = "added" if k not in state[a] else "removed" if k not in state[b] else "changed" if state[a][k] != state[b][k] else None
            if kind:
                out.add((b, k, kind))
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    order = ["s1", "s2", "s3", "s4"]
    rows = []
    for s in order:
        for k in range(40):
            if rng.random() < 0.7:
                v = rng.choice([1, 2, 3])
                body = rng.choice([None, "", "x", "y"])
                rows += [(s, k, v, body, None)] * rng.choice([1, 1, 2])
                if rng.random() < 0.2:
                    rows.append((s, k, None, "ignored", None))
                if rng.random() < 0.2:
                    rows.append((s, k, 0, "older", None))
    from datetime import datetime

    locks = [(s, datetime(2027, 1 + i, 1), "p") for i, s in enumerate(order)] + [("s2", datetime(2027, 2, 1), "p"), ("empty", datetime(2027, 1, 15), "p")]
    a, b = _frames(spark, rows + [("unlocked", 1, 9, "z", None), ("s1", None, 1, "z", None)], locks)
    got = {tuple(r) for r in snapshots.article_snapshot_changes(a, b).collect()}
    assert got == _brute(rows, order)


def test_null_differs_from_empty_and_moves_between_columns(spark):
    from datetime import datetime

    locks = [("s1", datetime(2027, 1, 1), "p"), ("s2", datetime(2027, 2, 1), "p")]
    rows = [("s1", 1, 1, None, "t"), ("s2", 1, 1, "t", None), ("s1", 2, 1, "", None), ("s2", 2, 1, None, None), ("s1", 3, 1, "x", None), ("s2", 3, 1, "x", None)]
    a, b = _frames(spark, rows, locks)
    assert {(r["identifier"], r["change_kind"]) for r in snapshots.article_snapshot_changes(a, b).collect()} == {(1, "changed"), (2, "changed")}


def test_empty_tables(spark):
    a, b = _frames(spark, [], [])
    assert snapshots.article_snapshot_changes(a, b).count() == 0


def test_intervals_part_at_gaps_and_changes(spark):
    from datetime import datetime

    locks = [(f"s{i}", datetime(2027, i, 1), "p") for i in range(1, 6)]
    rows = [("s1", 1, 1, "a", None), ("s2", 1, 1, "a", None), ("s4", 1, 1, "a", None), ("s5", 1, 2, "a", None), *[(f"s{i}", 9, 1, "k", None) for i in range(1, 6)]]
    a, b = _frames(spark, rows, locks)
    order = snapshots.snapshot_order(a, b)
    got = snapshots.validity_intervals(a, order, key="identifier", version=F.col("version.identifier"), compared=[F.col("article_body.html")])
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 1, 2), (1, 1, 4, 4), (1, 2, 5, 5), (9, 1, 1, 5)]
