import math

import __spark_entry__ as entry
import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return db


def same(a, b):
    return a == b or isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    want = duck.sql(entry.oracle_sql()[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    at = [want.columns.index(c) for c in order]
    a = sorted((tuple(r) for r in df.select(*order).collect()), key=repr)
    b = sorted((tuple(r[k] for k in at) for r in want.fetchall()), key=repr)
    assert len(a) == len(b)
    assert all(same(x, y) for r, s in zip(a, b) for x, y in zip(r, s))


def test_flagship_query(spark):
    assert entry.entry(spark).count() == 10


def test_every_query_of_the_library_has_sql():
    assert {n for n in entry.queries() if n not in entry.oracle_sql() and not n.startswith("op") and n != "pipeline"} == set()
