"""Time windows for incremental runs.

Every bound is a literal on the driver, never a subquery in the plan, so that it reaches the scan: as a partition
filter where the table is partitioned on its creation time, and as row-group statistics otherwise.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.functions.casts import safe_cast
from cdcmart.functions.times import AsOf, as_date, as_micros, instant_lit, micros_lit, micros_to_date

# Partition column by unit. A table whose days hold little data is better partitioned by month: a partition should
# have at least some hundred megabytes.
PARTITION_BY = {"day": "created_date", "month": "created_month"}
_DAY = 86_400_000_000


def partition_column(df: DataFrame) -> str | None:
    """Name of the column ``df`` is partitioned on, None for a table without one."""
    return next((c for c in PARTITION_BY.values() if c in df.columns), None)


def partition_start(column: str, day: date) -> date:
    """Value of the partition that holds ``day``."""
    return day if column == PARTITION_BY["day"] else day.replace(day=1)


def partition_value(column: str, ts: str = "created_at") -> Column:
    day = F.to_date(ts)
    return (day if column == PARTITION_BY["day"] else F.trunc(day, "month")).alias(column)


def max_instant(df: DataFrame, ts: str = "created_at") -> int | None:
    """Largest ``ts`` of ``df`` in epoch microseconds, None for an empty table."""
    return df.agg(F.unix_micros(F.max(safe_cast(ts, "timestamp"))).alias("m")).first()["m"]


def _prune(df: DataFrame, ts: str, first: date, last: date | None = None) -> Column:
    """Partitions that can hold moments from ``first`` on, as far as ``df`` is partitioned on ``ts``."""
    column = partition_column(df) if ts == "created_at" else None
    if column is None:
        return F.lit(True)
    cond = F.col(column) >= F.lit(partition_start(column, first))
    return cond if last is None else cond & (F.col(column) <= F.lit(partition_start(column, last)))


def _from_micros(df: DataFrame, ts: str, bound: int, strict: bool = False) -> DataFrame:
    moment = safe_cast(ts, "timestamp")
    keep = moment > micros_lit(bound) if strict else moment >= micros_lit(bound)
    return df.where(_prune(df, ts, micros_to_date(bound)) & keep)


def retro_bound(high_water: int | None, days: int = 7, cap: AsOf = None) -> int:
    """Start of the retroactive window in epoch microseconds, for a target that reaches up to ``high_water``.

    ``cap`` guards against rows dated in the future, which would push the window past real late rows.
    """
    top = high_water or 0
    if cap is not None:
        top = min(top, as_micros(cap))
    return top - days * _DAY


def retro_window(
    df: DataFrame,
    target: DataFrame | None = None,
    days: int = 7,
    ts: str = "created_at",
    *,
    target_ts: str | None = None,
    high_water: int | None = None,
    cap: AsOf = None,
) -> DataFrame:
    """Rows of ``df`` not older than ``days`` before the newest row of ``target``, by its column ``target_ts`` (``ts``
    where that is not given).

    Without a target (first run) nothing is filtered. A caller who already knows the newest moment of the target,
    from partition metadata for instance, passes it as ``high_water`` to save the aggregate over the target.
    """
    if target is None and high_water is None:
        return df
    if high_water is None:
        high_water = max_instant(target, target_ts or ts)
    return _from_micros(df, ts, retro_bound(high_water, days, cap))


def naive_window(df: DataFrame, target: DataFrame, ts: str = "created_at") -> DataFrame:
    """Rows strictly newer than the target's newest row. Loses late rows; kept as the negative control."""
    return _from_micros(df, ts, max_instant(target, ts) or 0, strict=True)


def since(df: DataFrame, as_of: AsOf, days: int, ts: str = "created_at") -> DataFrame:
    """Rows with ``ts`` in the last ``days`` days before the moment ``as_of``."""
    return _from_micros(df, ts, as_micros(as_of, days))


def on_or_after(df: DataFrame, as_of: AsOf, days: int, ts: str = "created_at") -> Column:
    """Condition: the date of ``ts`` is at most ``days`` days before the date of ``as_of``."""
    first = as_date(as_of, days)
    prune = _prune(df, ts, first)
    if ts == "created_at" and partition_column(df) == PARTITION_BY["day"]:
        return prune
    # Midnight of the first day, on the bare column: a function around the column would hide it from the scan.
    return prune & (safe_cast(ts, "timestamp") >= instant_lit(first))


def since_date(df: DataFrame, as_of: AsOf, days: int, ts: str = "created_at") -> DataFrame:
    """Rows whose date lies in the last ``days`` days before the date of ``as_of``, whole first day included."""
    return df.where(on_or_after(df, as_of, days, ts))


def same_date_range(df: DataFrame, ref: DataFrame, ts: str = "created_at") -> DataFrame:
    """Rows whose date lies between the first and the last date of ``ref``, both included."""
    row = ref.agg(F.to_date(F.min(ts)).alias("lo"), F.to_date(F.max(ts)).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        return df.where(F.lit(False))
    return df.where(_prune(df, ts, lo, hi) & (F.col(ts) >= instant_lit(lo)) & (F.col(ts) < instant_lit(hi, -1)))
