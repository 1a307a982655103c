import pytest
from pyspark.sql import functions as F

from lexforge.operators import skew


@pytest.mark.parametrize("broadcast_rows", [0, 100_000])
def test_attach_is_a_left_join(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(skew, "LEAST", 50)
    rows = [("hot", i) for i in range(500)] + [("hotmiss", i) for i in range(200)] + [(f"k{i}", i) for i in range(100)] + [(None, i) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, i int")
    lookup = {"hot": 1, **{f"k{i}": i for i in range(0, 100, 2)}}
    verdicts = df.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n")).join(spark.createDataFrame(list(lookup.items()), "k string, v int"), "k", "left")
    got = sorted(((r["k"] or "", r["i"], r["v"]) for r in skew.attach(df, verdicts, ["k"], weight="n", total=len(rows)).collect()), key=str)
    assert got == sorted(((k or "", i, lookup.get(k)) for k, i in rows), key=str)
