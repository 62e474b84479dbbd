"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_TS = "datastream_metadata.source_timestamp"
_RN = "__rn"


def with_source_ts(df: DataFrame) -> DataFrame:
    """Drop change events without a source timestamp. Goes before ranking: such an event must never win."""
    return df.where(F.col(SOURCE_TS).isNotNull())


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str = SOURCE_TS,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the largest ``order_by`` for each combination of ``keys``.

    Rows equal in ``order_by`` are told apart by ``tie_breakers``, descending; by default all other columns, so
    that a task that is run again after a lost executor picks the same row.

    A hot key is safe: Spark cuts each key to one row per input partition before the shuffle (WindowGroupLimit), so
    a key's reducer sees at most one row per map task however many versions there are.
    """
    if tie_breakers is None:
        tie_breakers = [f.name for f in df.schema if f.name not in keys and not isinstance(f.dataType, T.MapType)]
    order = [F.col(c).desc_nulls_last() for c in [order_by, *tie_breakers]]
    ranked = df.withColumn(_RN, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RN) == 1).drop(_RN)
