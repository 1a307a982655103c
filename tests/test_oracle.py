"""Every core query with SQL gives the same rows as DuckDB; the others run."""

import pytest

from lexforge.plans import registry
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, small, name):
    same, why = compare(spark, small, registry.QUERIES[name], registry.ORACLE[name])
    assert same, why


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_query_runs(spark, small, name):
    df = registry.QUERIES[name](spark, small)
    assert len(df.columns) == len(set(df.columns))
    df.collect()


def test_entry():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
