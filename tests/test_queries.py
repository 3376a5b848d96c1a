"""Every registered query of the library's own operators, next to its SQL on the same tables."""

import decimal
import math

import duckdb
import pytest

from tracklode import queries as own

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(own.oracle_sql()))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    df = own.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(map(norm, r)) for r in df.select(*columns).collect()]
    cursor = duck.execute(own.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = [tuple(norm(r[names.index(c)]) for c in columns) for r in cursor.fetchall()]
    key = lambda r: [(x is None, str(x)) for x in r]
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("name", sorted(set(own.queries()) - set(own.oracle_sql())))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert own.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_works_without_the_subpackage(monkeypatch):
    import sys

    import __spark_entry__

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(__spark_entry__.queries()) == set(own.queries()) and set(__spark_entry__.oracle_sql()) == set(own.oracle_sql())
