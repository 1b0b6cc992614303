"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from cellar.plans.queries import oracle_sql, queries
from check_oracle import TABLES, digest, type_diffs
from tests.conftest import SMALL

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(oracle_sql()[name])
    assert not type_diffs(df.schema, rel.columns, rel.types)
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "key"
