"""Data-quality assertions. Each returns its violations; an empty result means it holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assert_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, failing_rows) for each column of ``cols`` that has NULLs; one pass for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("failing_rows")) for i, c in enumerate(cols)]
    )
    return counts.select(F.inline(rows)).where(F.col("failing_rows") > 0)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, failing_rows) for each key that occurs more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("failing_rows")).where(F.col("failing_rows") > 1)


def assert_ref(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(key, failing_rows) for each value of ``key`` without a row in ``parent``; NULL refers to nothing.

    Both sides are reduced to one row per value before the join, so a hot value costs no more than a rare one.
    """
    children = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("failing_rows"))
    parents = parent.select(F.col(parent_key).alias(key)).distinct()
    return children.join(parents, [key], "left_anti")
