"""Every registered query of the core against its SQL on the smallest tables."""

import duckdb
import pytest

from scrubline import queries as core

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query(spark, duck, name):
    df = core.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got[1]
    sql = core.oracle_sql().get(name)
    if sql:
        r = duck.execute(sql)
        assert got == rows_of([d[0] for d in r.description], r.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
