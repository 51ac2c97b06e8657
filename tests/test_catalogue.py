import os

import pytest

from sievework.plans.catalogue import ORACLE, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    return con


def plain(value):
    return repr(round(value, 9) + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, tables, name):
    got = QUERIES[name](spark, DIR)
    columns = sorted(got.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = tables.execute(f"SELECT {quoted} FROM ({ORACLE[name]})").fetchall()
    rows = got.select(*[f"`{c}`" for c in columns]).collect()
    assert sorted(tuple(map(plain, r)) for r in rows) == sorted(tuple(map(plain, r)) for r in want)


def test_queries_without_sql_are_tested_elsewhere():
    assert set(QUERIES) - set(ORACLE) == {"local_predictions"}  # tests/test_learned.py
