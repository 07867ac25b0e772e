"""The correctness gate: every registered query vs its DuckDB oracle."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, rows_of
from tests.conftest import SF_SMALL

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_of_the_library_has_an_oracle():
    from pillbox.plans.catalogue import QUERIES as OWN

    assert set(OWN) <= set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["patient_id", "n_prescriptions", "total_cost_sum", "payer_coverage_sum", "coverage_ratio"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)
