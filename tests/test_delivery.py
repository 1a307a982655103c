import random
from datetime import datetime, timezone

from pyspark.sql import functions as F

from lexforge.functions.times import iso_instant
from lexforge.operators import delivery

SCHEMA = "source_sequence bigint, identifier bigint, version struct<identifier:bigint>, date_modified string, body string, _file string"


def _table(spark, path, rows, files=3):
    spark.createDataFrame([(s, i, None if v is None else (v,), d, b, "x") for s, i, v, d, b in rows], SCHEMA).repartition(files).write.mode("overwrite").parquet(str(path))
    return spark.read.parquet(str(path))


def test_notations_of_one_instant(spark):
    same = ["2027-01-03T22:04:23Z", "2027-01-03T22:04:23.000Z", "2027-01-04T07:04:23+09:00", "2027-01-03 18:34:23-03:30", "20270103T220423Z", "2027-01-03T22:04:23", "2027-01-03T22:04:23+0000", " 2027-01-03t22:04:23z "]
    got = spark.createDataFrame([(x,) for x in [*same, "2027-13-01T00:00:00Z", "soon", "", None]], "t string").select(iso_instant(F.col("t")).cast("long").alias("v")).collect()
    want = int(datetime(2027, 1, 3, 22, 4, 23, tzinfo=timezone.utc).timestamp())
    assert [r["v"] for r in got] == [want] * len(same) + [None] * 4


def _brute(rows):
    seen, gone = {}, set()
    for s, i, v, d, _ in sorted(rows, key=lambda r: r[0]):
        if i is None or v is None:
            continue
        if (i, v, d) in seen:
            gone.add(s)
        seen[i, v, d] = 1
    return gone


def test_against_brute_force_with_a_hot_message(spark, tmp_path):
    rng = random.Random(1)
    days = ["2027-01-01T00:00:00Z", "2027-01-02T00:00:00Z", None, "no date"]
    rows = [(s, rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2]), rng.choice(days), "b" * rng.randint(0, 9)) for s in range(9000)]
    rows += [(10_000 + s, 7, 7, days[0], "hot") for s in range(5000)]
    t = _table(spark, tmp_path / "t", rows)
    gone = _brute(rows)
    assert {r[0] for r in delivery.repeated_messages(t).collect()} == gone
    kept = delivery.distinct_messages(t)
    assert kept.columns == t.columns
    assert {r["source_sequence"] for r in kept.collect()} == {r[0] for r in rows if r[1] is not None and r[2] is not None} - gone


def test_vectors_beyond_the_broadcast_bound_are_applied_by_file_group(spark, tmp_path):
    rows = [(s, s % 50, 1, None, "b") for s in range(12_000)]
    t = _table(spark, tmp_path / "t", rows, files=4)
    vectors = delivery.article_deletion_vectors(t)
    one = delivery.with_deletions(t, vectors, ["source_sequence"])
    many = delivery.with_deletions(t, vectors, ["source_sequence"], limit_bytes=1200)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert many.filter("__lx_deleted").count() == 12_000 - 50


def test_columns_named_like_helpers(spark, tmp_path):
    schema = "source_sequence bigint, identifier bigint, version struct<identifier:bigint>, date_modified string, _row bigint, _deleted boolean, bits string, `_metadata_note` string, `a.b` int"
    spark.createDataFrame([(i, 1, (1,), None, 5, True, "x", "y", 1) for i in range(9)], schema).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    kept = delivery.distinct_messages(t)
    assert kept.columns == t.columns and [r["source_sequence"] for r in kept.collect()] == [0]


def test_empty_and_single(spark, tmp_path):
    t = _table(spark, tmp_path / "t", [(1, None, None, None, None), (2, 1, 1, None, "b")], files=1)
    assert delivery.repeated_messages(t).count() == 0
    assert delivery.distinct_messages(t).count() == 1
    e = _table(spark, tmp_path / "e", [], files=1)
    assert delivery.distinct_messages(e).count() == 0


def test_the_wide_read_is_not_shuffled(spark, tmp_path):
    t = _table(spark, tmp_path / "t", [(s, s % 5, 1, None, "b") for s in range(100)])
    plan = delivery.distinct_messages(t)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_distinct_by_keeps_one_row_of_each_message(spark, tmp_path):
    rows = [(i % 7, f"body {i % 7}", "clash") for i in range(50)] + [(None, None, None), (None, None, "clash")]
    spark.createDataFrame(rows, "k int, body string, __lx string").repartition(3).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert delivery.has_positions(df) and not delivery.has_positions(spark.createDataFrame(rows, "k int, body string, __lx string"))
    got = delivery.distinct_by(df.withColumn("n", df["k"] + 1), [df["k"], df["body"]])
    assert got.columns == ["k", "body", "__lx", "n"] and sorted((r["k"] is None, r["k"] or 0, r["body"]) for r in got.collect()) == sorted({(k is None, k or 0, b) for k, b, _ in rows})
    assert delivery.distinct_by(df.filter("k > 99"), [df["k"]]).count() == 0
