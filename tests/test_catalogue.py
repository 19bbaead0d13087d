"""Every query with SQL gives the rows that DuckDB gives."""

import math
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

from siftlode.plans import catalogue, domain, flagship, runs

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalogue.queries() | domain.queries() | runs.queries()
SQL = catalogue.oracle_sql() | domain.oracle_sql() | runs.oracle_sql()


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    if isinstance(x, (datetime, date)):
        return str(x)
    return x


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER)
    theirs = duck.execute(SQL[name])
    names = [c[0] for c in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    want = sorted((tuple(map(plain, r)) for r in theirs.fetchall()), key=str)
    got = sorted((tuple(map(plain, r)) for r in ours.select(*names).collect()), key=str)
    assert got == want and got


def test_flagship(spark):
    assert flagship.placement_overview(spark, FOLDER).count() > 0
