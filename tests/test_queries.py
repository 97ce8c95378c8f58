import duckdb
import pytest

from metaenrich.plans import catalogue

NAMES = list(catalogue.queries())


@pytest.fixture(scope="module")
def connection(tables):
    con = duckdb.connect()
    for t in "customer supplier part orders events".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, connection, tables, name):
    found = catalogue.queries()[name](spark, tables)
    expected = connection.sql(catalogue.oracle_sql()[name])
    names = sorted(found.columns)
    assert names == sorted(expected.columns)
    order = [expected.columns.index(n) for n in names]
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=key) == sorted((tuple(r[i] for i in order) for r in expected.fetchall()), key=key)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(NAMES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
