"""Every registered query with SQL gives the same rows in DuckDB, at the smallest size."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    show = lambda v: repr(round(v, 9) + 0.0) if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    df, other = QUERIES[name](spark, SF), con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(other.columns)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(other.fetchall(), other.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {n for n in QUERIES if n.startswith("op") or n == "pipeline"}))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
