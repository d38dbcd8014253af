"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from asofspark.queries import QUERIES  # noqa: E402

SF = os.environ.get("ASOF_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("region nation customer supplier part orders lineitem events").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    from check_oracles import digest

    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL oracle")
    cur = duck.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    hs, cs, _ = digest(df.columns, rows)
    ho, co, _ = digest(ocols, orows)
    assert cs == co
    assert (len(rows), hs) == (len(orows), ho)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns
