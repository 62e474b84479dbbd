"""Every named query against its SQL counterpart in DuckDB, on the smallest sample tables."""

import math
from decimal import Decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from cdcmart.samples.oracle import ORACLE
from cdcmart.samples.queries import QUERIES

SF = "/root/testdata/sf0.001"

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="sample tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return str(value) if isinstance(value, Decimal) else value


def normal(rows):
    return sorted((tuple(canonical(v) for v in r) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry_point.queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = normal(df.select(*columns).collect())
    cursor = duck.execute(entry_point.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert found == normal([tuple(r[i] for i in order) for r in cursor.fetchall()])


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 1500 and df.columns[0] == "order_id"


def test_known_sums(spark):
    """Control numbers of the landing views with constant rates."""
    from pyspark.sql import functions as F

    from cdcmart.plans import silver
    from cdcmart.samples import views

    sf = SF.replace("sf0.001", "sf0.01")
    raw = views.raw_orders(spark, sf)
    assert raw.count() == 16_200
    row = (
        silver.orders_clean(raw, views.raw_rates(spark, sf, jitter=False))
        .agg(F.count("*"), F.count("total_price_usd"), F.sum("total_price_usd"), F.sum("discount_usd"))
        .first()
    )
    assert tuple(row) == (15_000, 11_254, Decimal("2131640972.628400000"), Decimal("201979787.412348000"))
    row = (
        silver.order_items_clean(views.raw_order_items(spark, sf), views.ITEM_TIES)
        .agg(F.count("*"), F.sum("quantity"), F.sum("net_amount_local"), F.count_if("is_recommended"), F.count("product_id"))
        .first()
    )
    assert tuple(row) == (45_832, 1_160_714, Decimal("2429616911.620000000"), 8_181, 45_614)
