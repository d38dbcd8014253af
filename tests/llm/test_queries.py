"""The registered queries on the smallest driver tables, against their SQL where there is one."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from asofspark.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = os.environ.get("ASOF_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_one_query_for_each_operator():
    names = list(QUERIES)
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(names) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    from check_oracles import digest

    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    got, cols, _ = digest(df.columns, rows)
    want, others, _ = digest([d[0] for d in cur.description], cur.fetchall())
    assert cols == others and got == want
