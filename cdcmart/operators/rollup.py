"""Order-level aggregates of the items."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.functions.times import AsOf
from cdcmart.operators import windows


def item_rollup(items: DataFrame, since: AsOf = None, days: int = 30) -> DataFrame:
    """Number of items, total quantity and number of recommended items for each order.

    With ``since`` only the items of the ``days`` days before that moment are counted. NULL quantities are skipped,
    a NULL flag counts as not recommended.
    """
    if since is not None:
        items = windows.since(items, since, days)
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum(F.when(F.col("is_recommended"), 1).otherwise(0)).alias("recommended_count"),
    )


# A rollup that can be kept up by differences has one column more: a sum over no quantity is NULL, not 0.
STATE = ("item_count", "quantity_sum", "quantity_rows", "recommended_count")


def _signed(items: DataFrame, sign: int) -> DataFrame:
    one, zero = F.lit(sign).cast("bigint"), F.lit(0).cast("bigint")
    return items.select(
        "order_id",
        one.alias("item_count"),
        F.coalesce(F.col("quantity") * sign, zero).cast("bigint").alias("quantity_sum"),
        F.when(F.col("quantity").isNotNull(), one).otherwise(zero).alias("quantity_rows"),
        F.when(F.col("is_recommended"), one).otherwise(zero).alias("recommended_count"),
    )


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("order_id").agg(*[F.sum(c).alias(c) for c in STATE])


def rollup_state(items: DataFrame) -> DataFrame:
    """``order_id`` and ``STATE``: the rollup in a form that differences can be added to."""
    return _summed(_signed(items, 1))


def rollup_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What changed items add to the state of their orders, given their rows ``before`` and ``after`` the change. An item
    that moves to another order is taken from one and added to the other; whatever did not change cancels out."""
    changes = _summed(_signed(before, -1).unionByName(_signed(after, 1)))
    return changes.where(reduce(or_, [F.col(c) != 0 for c in STATE]))


def rollup_changed(state: DataFrame, changes: DataFrame) -> DataFrame:
    """The state after ``changes``; orders without an item left are gone. Its cost follows the orders, not the items."""
    return _summed(state.unionByName(changes)).where("item_count > 0")


def rollup_of(state: DataFrame) -> DataFrame:
    """The rollup, as ``item_rollup`` gives it."""
    total = F.when(F.col("quantity_rows") > 0, F.col("quantity_sum"))
    return state.select("order_id", "item_count", total.alias("total_quantity"), "recommended_count")
