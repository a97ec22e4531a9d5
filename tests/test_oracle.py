"""Every registered query against its SQL, every value of every row."""

import datetime as dt
import decimal
from pathlib import Path

import pytest

import __spark_entry__ as contract
from antecede.oracles import ORACLES
from antecede.registry import QUERIES

duckdb = pytest.importorskip("duckdb")


def canonical(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return value.isoformat() if isinstance(value, (dt.datetime, dt.date)) else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def sql(sf_dir_module):
    con = duckdb.connect()
    for path in Path(sf_dir_module).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.fixture(scope="module")
def sf_dir_module():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no test data here")
    return str(path)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, sf_dir_module, name):
    got = QUERIES[name](spark, sf_dir_module)
    want = sql.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert table(got.columns, got.collect()) == table(columns, want.fetchall())


def test_every_query_has_sql_and_the_other_way_round():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark, sf_dir_module):
    assert contract.entry(spark).count() > 0
