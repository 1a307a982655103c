"""Compare a Spark query with its DuckDB SQL: same columns, same multiset of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _plain(x)) for k, x in v.asDict().items()))
    if hasattr(v, "isoformat"):
        return v.isoformat().split("+")[0]
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in Path(directory).glob("*.parquet"):
        glob = f"{p}/*.parquet" if p.is_dir() else str(p)
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{glob}'")
    return c


def compare(spark, directory: str, query, sql: str) -> tuple[bool, str]:
    df = query(spark, directory)
    names = sorted(df.columns)
    a = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    rel = duck(directory).sql(sql)
    cols = rel.columns
    if sorted(cols) != names:
        return False, f"columns {names} and {sorted(cols)}"
    at = [cols.index(n) for n in names]
    b = Counter(tuple(_plain(r[i]) for i in at) for r in rel.fetchall())
    if a == b:
        return True, f"{sum(a.values())} rows"
    return False, f"{sum(a.values())} and {sum(b.values())} rows; only Spark {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"
