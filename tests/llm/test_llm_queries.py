"""The registered queries against their SQL, and what is registered."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", ["op1_quality", "op7_decontamination", "op12_prefix_trie", "op13_windows"])
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = con.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SF)
    order = sorted(got.columns)
    assert sorted(want.columns) == order
    assert sorted(map(tuple, got.select(order).collect())) == sorted(want.select(*order).fetchall())
