"""Driver contract: entry smoke run, registry consistency, Spark vs DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.check_oracle import TABLES, digest


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["city_name", "year", "month", "avg_monthly_aqi", "risk_index_pct",
                          "total_station_days", "risk_tier"]
    assert df.count() > 0


def test_registry_keys():
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert len(qs) >= 32


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]
