"""Gold tables: the order fact and the store dimension."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.functions.labels import region_of, store_age_days, store_maturity
from cdcmart.functions.times import AsOf
from cdcmart.operators.rollup import item_rollup
from cdcmart.operators.upsert import upsert
from cdcmart.operators.windows import on_or_after, since
from cdcmart.sources.schemas import DIM_STORES, FCT_ORDERS

FCT_COLUMNS = [name for name, _ in FCT_ORDERS]
# On a match the merge leaves the key and the creation time as they are.
FCT_UPDATED = [c for c in FCT_COLUMNS if c not in ("order_id", "created_at")]


def dim_stores(stores: DataFrame, as_of: AsOf) -> DataFrame:
    derived = {
        "region": region_of(F.col("country_code")),
        "store_age_days": store_age_days(F.col("opening_date"), as_of).cast("bigint"),
        "store_maturity": store_maturity(F.col("opening_date"), as_of),
    }
    return stores.withColumns(derived).select(*DIM_STORES)


def _with_items(orders: DataFrame, rollup: DataFrame) -> DataFrame:
    counts = {"item_count": "item_count", "total_quantity": "total_quantity", "recommended_count": "recommended_item_count"}
    rolled = rollup.select("order_id", *[F.col(c).alias(name) for c, name in counts.items()])
    rolled_names = set(counts.values())
    return orders.join(rolled, "order_id", "left").select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in rolled_names else F.col(c) for c in FCT_COLUMNS]
    )


def fct_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Full refresh: one row per order with its item counts, 0 where it has no items."""
    return _with_items(orders, item_rollup(items))


def fct_orders_window(orders: DataFrame, items: DataFrame, as_of: AsOf, window_days: int = 30) -> DataFrame:
    """Source of the incremental merge: orders of the window, counting only items of the window."""
    return _with_items(since(orders, as_of, window_days), item_rollup(items, as_of, window_days))


def merge_fct_orders(
    target: DataFrame, source: DataFrame, as_of: AsOf, window_days: int = 30, merge: Callable[..., DataFrame] = upsert
) -> DataFrame:
    """Content of the fact after the incremental merge; only target rows of the window can match. For a target of files
    ``merge`` may be ``upsert_files``."""
    return merge(
        target,
        source,
        ["order_id"],
        target_filter=on_or_after(target, as_of, window_days),
        update_cols=FCT_UPDATED,
    )
