"""Every registered query with SQL against that SQL."""

import math

import duckdb
import pytest

from tidefold.plans.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return c


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    key = lambda x: (x is None, str(x))
    cell = lambda x: round(x, 6) if isinstance(x, float) and math.isfinite(x) else x
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=lambda r: [key(x) for x in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, con, data, name):
    df = QUERIES[name](spark, data)
    want = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert plain(df.collect(), df.columns) == plain(want.fetchall(), want.columns)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
