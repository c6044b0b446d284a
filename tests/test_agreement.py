"""Queries against their SQL on tables made by hand, with the values at which the two once differed."""

import datetime as dt

import duckdb

import __spark_entry__ as entry
from tests.test_entry import plain


def agree(spark, folder, name, tables):
    """The query's rows, which must be those of its SQL; tables are (rows, schema) by name."""
    con = duckdb.connect()
    for table, (rows, schema) in tables.items():
        path = f"{folder}/{table}.parquet"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        con.execute(f"create view {table} as select * from '{path}/*.parquet'")
    got = entry.queries()[name](spark, str(folder)).toPandas()
    assert plain(got) == plain(con.execute(entry.oracle_sql()[name]).df())
    return got


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_rolling_windows_end_at_whole_milliseconds(spark, tmp_path):
    at = dt.datetime(2024, 1, 1, 0, 30)
    places = (0, 60_000_000, 60_000_999, 60_001_000, 120_000_400, 120_000_600, 180_000_700)
    rows = [(7 * i, at + dt.timedelta(microseconds=us), 1, ("error", "view")[i % 2], float(i), '{"k": 1}') for i, us in enumerate(places)]
    got = agree(spark, tmp_path, "rolling60s", {"events": (rows, EVENTS)}).sort_values("seq")
    assert got["completions"].tolist() == [1, 3, 3, 3, 5, 5, 3]


CUSTOMERS = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def test_imported_companies_of_any_size(spark, tmp_path):
    balances = ((4, 0.0), (5, 0.25), (7, -0.5), (8, -12.75), (1_000_000, 3.0), (1_000_001, 3.0), (1_000_002, 0.0), (1_000_004, 9999.99))
    rows = [(k, f"Customer#{k:09d}", 1, b, "BUILDING") for k, b in balances]
    got = agree(spark, tmp_path, "table_import", {"customer": (rows, CUSTOMERS)}).set_index("c_custkey")
    assert got["notes"].tolist() == ["no_domain", "", "", "no_domain", "no_domain", "odd_employees", "", "no_domain,odd_employees"]
    assert got["size"].isna().tolist() == [b == 0 for _, b in balances] and got.loc[5, "size"] == 0
