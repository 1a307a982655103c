import pytest

from lexforge.llm import queries
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, small, name):
    if name in queries.ORACLE:
        same, why = compare(spark, small, queries.QUERIES[name], queries.ORACLE[name])
        assert same, why
    else:
        df = queries.QUERIES[name](spark, small)
        assert len(df.columns) == len(set(df.columns)) and df.collect()


def test_columns(spark, small):
    want = {
        "p1_found": [("key_1", "bigint"), ("key_2", "bigint")],
        "p4_found": [("source_table", "string"), ("identifier", "bigint"), ("version_identifier", "bigint"), ("kind", "string"), ("content", "string")],
        "p5_found": [("page_id", "bigint"), ("revision_id", "bigint"), ("source_hash", "string")],
        "p7_ids": [("doc_id", "bigint"), ("ids", "array<int>")],
    }
    for name, columns in want.items():
        assert queries.QUERIES[name](spark, small).dtypes == columns
