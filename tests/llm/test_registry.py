"""Queries with SQL give its rows."""

from pathlib import Path

import duckdb
import pytest

from siftlode.llm import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_rows(spark, name):
    con = duckdb.connect()
    for p in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    theirs = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in theirs.description]
    ours = registry.queries()[name](spark, FOLDER)
    assert sorted(ours.columns) == sorted(names)
    assert sorted(map(tuple, ours.select(*names).collect()), key=str) == sorted(theirs.fetchall(), key=str)
