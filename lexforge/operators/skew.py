"""Joins with a keyed lookup that no hot key can skew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.session import BROADCAST_ROWS

#: A key that holds more than one HOT-th of all rows is hot, so there are at most HOT hot keys, however large the data.
HOT = 1000
#: Fewer rows than this never make a key hot.
LEAST = 1000


def attach(rows: DataFrame, verdicts: DataFrame, on: list[str], *, weight: str, total: int) -> DataFrame:
    """``rows`` plus the columns of ``verdicts`` (null where none fits), as a left join on ``on``.

    ``verdicts`` has one row for each key of ``rows``, matched or not, and tells in ``weight`` how many rows have it. If a
    count shows it to be small it is broadcast whole. Else hot keys, at most HOT of them, are broadcast and their rows stay where they are; all other rows are joined by a
    shuffle in which no key holds more than one HOT-th of the rows. Rows with a null in ``on`` match nothing and are not
    moved at all.
    """
    values = [c for c in verdicts.columns if c not in on and c != weight]
    columns = [*rows.columns, *values]
    if verdicts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(verdicts.drop(weight)), on, "left").select(*columns)
    least = max(LEAST, total // HOT)
    hot = F.broadcast(verdicts.filter(F.col(weight) >= least).drop(weight))
    cold = verdicts.filter(F.col(weight) < least).drop(weight)
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    known = rows.filter(whole)
    types = dict(verdicts.dtypes)
    parts = [
        known.join(hot, on, "inner"),
        known.join(hot.select(*on), on, "left_anti").join(cold, on, "left"),
        rows.filter(~whole).select("*", *[F.lit(None).cast(types[v]).alias(v) for v in values]),
    ]
    return reduce(DataFrame.unionAll, [p.select(*columns) for p in parts])
