from pathlib import Path

import pytest

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_queries_equal_their_sql(spark):
    from test_contract import compare

    from skyloom.llm import queries

    for name in queries.QUERIES:
        compare(spark, name, queries.QUERIES[name], queries.SQL.get(name))
