"""Every query with SQL against DuckDB on the smallest tables."""
import duckdb
import pytest

from corpusloom.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    df, want = QUERIES[name](spark, SF), duck.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_without_llm(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.queries())
