"""Every query of the inventory with SQL gives what DuckDB gives on the same tables."""

import glob
import os

import duckdb
import pytest

from strandlake.plans.queries import oracle_sql, queries

from .conftest import DATA

SF = f"{DATA}/sf0.001"


def plain(v):
    if v is None or type(v).__name__ in ("NAType", "NaTType") or v != v:
        return None
    if hasattr(v, "item"):
        v = v.item()
    return round(float(v), 5) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def rows(df):
    df = df[sorted(df.columns)]
    return sorted((tuple(plain(v) for v in r) for r in df.itertuples(index=False, name=None)), key=repr)


def near(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 2e-5 * max(1, abs(a))
    return a == b


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    got, want = queries()[name](spark, SF).toPandas(), duck.sql(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    assert all(near(x, y) for r, s in zip(a, b, strict=True) for x, y in zip(r, s, strict=True))


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_others_run(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry_registers_everything():
    import __spark_entry__ as e

    assert set(queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
