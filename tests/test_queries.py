"""Every registered query against its oracle SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tripwright.plans.queries import QUERIES

TABLES = ("events", "supplier")


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, sf_dir, name):
    frame = contract.queries()[name](spark, sf_dir)
    rows = frame.collect()
    expected = oracle.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(frame.columns)
    order = [columns.index(c) for c in frame.columns]
    wanted = [tuple(r[i] for i in order) for r in expected.fetchall()]
    assert sorted(map(tuple, rows), key=repr) == sorted(wanted, key=repr)
    assert wanted


def test_entry(spark):
    assert contract.entry(spark).count() > 0
