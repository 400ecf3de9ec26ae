"""Every registered query against its DuckDB oracle on the smallest scale
(the driver runs the same comparison at sf0.01)."""

import os

import duckdb
import pytest

from tools.check_oracles import TABLES, rows_of

from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"
NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_registered_has_callable():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) >= 60


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = queries()[name](spark, SF).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    c1, r1 = rows_of(got)
    c2, r2 = rows_of(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["section", "name", "value"]
    assert df.count() > 0
