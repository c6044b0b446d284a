"""Every registered query of the engine against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tidemark.plans import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(df: pd.DataFrame) -> list[str]:
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
            return None
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    return sorted(str([cell(v) for v in row]) for row in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from read_parquet('{DATA}/{name}')")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, DATA).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql:
        assert plain(got) == plain(duck.execute(sql).df())


def test_names_are_registered_with_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert registry.FLAGSHIP in registry.queries()
