"""Every registered query runs on the smallest data, and equals its SQL in DuckDB where it has one."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

DATA = Path("/root/testdata/sf0.001")


def plain(x):
    if isinstance(x, float):
        return None if x != x else float(f"{x:.9g}")
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


def compare(spark, name, query, sql):
    from skyloom.session import TABLES

    df = query(spark, str(DATA))
    cols = sorted(df.columns)
    got = Counter(tuple(plain(x) for x in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    if sql is None:
        return
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    rel = c.sql(sql)
    assert sorted(rel.columns) == cols, name
    want = Counter(tuple(plain(x) for x in r) for r in c.sql(f"SELECT {', '.join(f'"{k}"' for k in cols)} FROM ({sql})").fetchall())
    assert got == want, name


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_queries_equal_their_sql(spark):
    from skyloom.plans import data_quality, loading, verification

    for m in (data_quality, verification, loading):
        for name, f in m.QUERIES.items():
            compare(spark, name, f, m.SQL.get(name))


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
