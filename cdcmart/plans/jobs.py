"""The two batch jobs. Any scheduler can call them; each step reads what the step before it wrote."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cdcmart.functions.times import AsOf, as_date, as_instant, micros_to_date
from cdcmart.operators.windows import on_or_after, retro_bound
from cdcmart.plans import gold, silver
from cdcmart.session import require_utc
from cdcmart.sinks.tables import ensure_target, high_water, read_target, write_table
from cdcmart.sinks.upserts import recover, upsert_into
from cdcmart.sources.schemas import FCT_ORDERS_SCHEMA, ITEMS_CLEAN_SCHEMA

# Cluster columns of the mart tables.
CLUSTER = {
    "orders_clean": ["store_id", "customer_id"],
    "order_items_clean": ["order_id"],
    "stores_clean": ["country_code", "store_id"],
    "fct_orders": ["store_id", "customer_id"],
    "fct_orders_incremental_merge": ["store_id", "customer_id"],
    "dim_stores": ["country_code", "store_id"],
}


@dataclass(frozen=True)
class MartConfig:
    """Where a mart reads and writes.

    ``raw`` holds the landing tables ``orders``, ``order_items``, ``stores`` and ``currency_exchange_rates``.
    ``items_window_col`` is the raw column the items' window is laid over. ``cap_future`` keeps rows dated after the run
    from moving that window. ``widen_target`` lets all partitions match that the source window reaches back to, after
    an outage for instance; without it such rows are inserted again.
    ``partition_unit`` is ``day`` or, for a mart whose days hold little data, ``month``.
    """

    raw: Mapping[str, DataFrame]
    silver: str = "silver"
    gold: str = "gold"
    items_window_days: int = 7
    items_target_days: int = 14
    items_window_col: str = "created_at"
    cap_future: bool = False
    widen_target: bool = False
    fact_window_days: int = 30
    partition_unit: str = "day"
    tie_breakers: Mapping[str, list[str]] = field(default_factory=dict)

    def ties(self, table: str) -> list[str] | None:
        return self.tie_breakers.get(table)


def _create_databases(spark: SparkSession, cfg: MartConfig) -> None:
    for name in (cfg.silver, cfg.gold):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def refresh_orders(spark: SparkSession, cfg: MartConfig) -> DataFrame:
    table = f"{cfg.silver}.orders_clean"
    df = silver.orders_clean(cfg.raw["orders"], cfg.raw["currency_exchange_rates"], cfg.ties("orders"))
    write_table(df, table, "created_at", CLUSTER["orders_clean"], unit=cfg.partition_unit)
    return spark.table(table)


def refresh_stores(spark: SparkSession, cfg: MartConfig, as_of: AsOf) -> DataFrame:
    write_table(
        silver.stores_clean(cfg.raw["stores"], cfg.ties("stores")),
        f"{cfg.silver}.stores_clean",
        cluster=CLUSTER["stores_clean"],
    )
    table = f"{cfg.gold}.dim_stores"
    dim = gold.dim_stores(spark.table(f"{cfg.silver}.stores_clean"), as_of)
    write_table(dim, table, cluster=CLUSTER["dim_stores"])
    return spark.table(table)


def refresh_items_full(spark: SparkSession, cfg: MartConfig) -> DataFrame:
    table = f"{cfg.silver}.order_items_clean"
    df = silver.order_items_clean(cfg.raw["order_items"], cfg.ties("order_items"))
    write_table(df, table, "created_at", CLUSTER["order_items_clean"], unit=cfg.partition_unit)
    return spark.table(table)


def refresh_items_increment(spark: SparkSession, cfg: MartConfig, as_of: AsOf) -> DataFrame:
    """Merge the events of the retroactive window; the first run, without a target, loads everything."""
    table = f"{cfg.silver}.order_items_clean"
    raw, ties = cfg.raw["order_items"], cfg.ties("order_items")
    if not spark.catalog.tableExists(table):
        return refresh_items_full(spark, cfg)
    recover(spark, table)
    top = high_water(spark, table)
    if top is None:
        return refresh_items_full(spark, cfg)
    target = read_target(spark, table, ITEMS_CLEAN_SCHEMA)
    cap = as_of if cfg.cap_future else None
    bound = micros_to_date(retro_bound(top, cfg.items_window_days, cap))
    behind = bound < as_date(as_of, cfg.items_target_days)
    if behind and not cfg.widen_target:
        warnings.warn(
            f"{table}: the source window starts {bound}, before the partitions that may match; rows between the two "
            "are inserted again instead of updated",
            stacklevel=2,
        )
    upsert_into(
        spark,
        table,
        silver.order_items_increment(
            raw, target, cfg.items_window_days, ties, window_col=cfg.items_window_col, high_water=top, cap=cap
        ),
        ["order_item_id"],
        target_filter=on_or_after(target, bound, 0) if behind and cfg.widen_target else on_or_after(target, as_of, cfg.items_target_days),
        cluster=CLUSTER["order_items_clean"],
    )
    return spark.table(table)


def merge_fact(spark: SparkSession, cfg: MartConfig, orders: DataFrame, items: DataFrame, as_of: AsOf) -> DataFrame:
    table = f"{cfg.gold}.fct_orders_incremental_merge"
    ensure_target(spark, table, FCT_ORDERS_SCHEMA, cfg.partition_unit)
    upsert_into(
        spark,
        table,
        gold.fct_orders_window(orders, items, as_of, cfg.fact_window_days),
        ["order_id"],
        target_filter=on_or_after(spark.table(table), as_of, cfg.fact_window_days),
        update_cols=gold.FCT_UPDATED,
        cluster=CLUSTER["fct_orders_incremental_merge"],
    )
    return spark.table(table)


def _check_windows(cfg: MartConfig) -> None:
    if cfg.items_target_days < 2 * cfg.items_window_days:
        warnings.warn("the target window of the items should be at least twice the source window", stacklevel=3)


def refresh_incremental(spark: SparkSession, cfg: MartConfig, as_of: AsOf = None) -> dict[str, DataFrame]:
    """Hot path: silver tables, the items increment, the fact merge and the store dimension."""
    require_utc(spark)
    as_of = as_instant(as_of)
    _check_windows(cfg)
    _create_databases(spark, cfg)
    orders = refresh_orders(spark, cfg)
    items = refresh_items_increment(spark, cfg, as_of)
    return {
        "orders_clean": orders,
        "order_items_clean": items,
        "fct_orders_incremental_merge": merge_fact(spark, cfg, orders, items, as_of),
        "dim_stores": refresh_stores(spark, cfg, as_of),
    }


def refresh_full(spark: SparkSession, cfg: MartConfig, as_of: AsOf = None) -> dict[str, DataFrame]:
    """Monthly safety net: rebuild orders, items and the fact from all events.

    The items are rebuilt in full mode first; a fact rebuilt from the incremental items would keep their gaps.
    """
    require_utc(spark)
    as_of = as_instant(as_of)
    _create_databases(spark, cfg)
    orders = refresh_orders(spark, cfg)
    items = refresh_items_full(spark, cfg)
    table = f"{cfg.gold}.fct_orders"
    fact = gold.fct_orders(orders, items)
    write_table(fact, table, "created_at", CLUSTER["fct_orders"], unit=cfg.partition_unit)
    return {
        "orders_clean": orders,
        "order_items_clean": items,
        "fct_orders": spark.table(table),
        "dim_stores": refresh_stores(spark, cfg, as_of),
    }
