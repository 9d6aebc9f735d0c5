"""Every query with DuckDB SQL gives the same rows as that SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from avmatch.plans.bindings import ORACLE_SQL, QUERIES

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def normal(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple("null" if r[k] is None else f"{r[k]:.6f}" if isinstance(r[k], float) else str(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, str(SF))
    want = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert normal(got.columns, got.collect()) == normal(columns, want.fetchall())
