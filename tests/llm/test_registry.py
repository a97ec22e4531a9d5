"""Queries of this package that have SQL, every value of every row."""

from pathlib import Path

import pytest

from antecede.llm.registry import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", ORACLES)
def test_query_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    want = con.execute(ORACLES[name])
    columns = sorted(c[0] for c in want.description)
    order = [[c[0] for c in want.description].index(c) for c in columns]
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == columns
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)
    assert rows == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
