"""Silver tables: latest version of every record, typed, with USD amounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.functions.casts import cast_columns, safe_cast
from cdcmart.functions.times import AsOf
from cdcmart.operators.dedup import latest_by_key, with_source_ts
from cdcmart.operators.rates import BROADCAST_ROWS, convert_to_usd
from cdcmart.operators.windows import retro_window
from cdcmart.sources.schemas import ITEMS_SPEC, ORDERS_CLEAN, ORDERS_SPEC, STORES_SPEC

MONEY = {
    "total_price_local": "total_price_usd",
    "discount_local": "discount_usd",
    "net_amount_local": "net_amount_usd",
}
Ties = Sequence[str] | None


def latest_orders(raw: DataFrame, tie_breakers: Ties = None) -> DataFrame:
    """Latest version of each order, typed, in local currency."""
    return cast_columns(latest_by_key(with_source_ts(raw), ["id"], tie_breakers=tie_breakers), ORDERS_SPEC)


def orders_clean(
    raw: DataFrame, rates: DataFrame, tie_breakers: Ties = None, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    typed = latest_orders(raw, tie_breakers)
    day = F.to_date(typed["created_at"])
    return convert_to_usd(typed, rates, MONEY, date=day, broadcast_rows=broadcast_rows).select(*ORDERS_CLEAN)


def order_items_clean(raw: DataFrame, tie_breakers: Ties = None) -> DataFrame:
    """Full mode: every item in its latest version."""
    return cast_columns(latest_by_key(with_source_ts(raw), ["id"], tie_breakers=tie_breakers), ITEMS_SPEC)


def order_items_increment(
    raw: DataFrame,
    target: DataFrame | None,
    window_days: int = 7,
    tie_breakers: Ties = None,
    *,
    window_col: str = "created_at",
    target_col: str = "created_at",
    high_water: int | None = None,
    cap: AsOf = None,
) -> DataFrame:
    """Incremental mode: only events of the retroactive window before the target's newest row.

    ``window_col`` is the raw column the window is laid over. On ``created_at`` an update to a record older than the
    window is not seen; a table with a column for the moment of arrival can use that instead. ``target_col`` is the
    column of the target whose largest value the window goes back from.
    """
    events = retro_window(with_source_ts(raw), target, window_days, window_col, target_ts=target_col, high_water=high_water, cap=cap)
    return cast_columns(latest_by_key(events, ["id"], tie_breakers=tie_breakers), ITEMS_SPEC)


def exclude_flagged(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Drop rows with a true flag; a NULL flag, or one that is no boolean, keeps the row."""
    for flag in flags:
        df = df.where(~F.coalesce(safe_cast(flag, "boolean"), F.lit(False)))
    return df


def stores_clean(raw: DataFrame, tie_breakers: Ties = None) -> DataFrame:
    # Flags are looked at after ranking: only the latest version of a store decides.
    latest = latest_by_key(with_source_ts(raw), ["id"], tie_breakers=tie_breakers)
    return cast_columns(exclude_flagged(latest, ["is_dev", "is_excluded_from_dw"]), STORES_SPEC)
