"""Quantiles of the CDC lag from mergeable states: one small row per day of arrival, kept beside the table.

A quantile over any range of days is read from the states of these days, without another pass over the events, and new
events only add their own states. The exact way over all events is ``reconcile.lag_profile``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.functions.casts import safe_cast
from cdcmart.operators.dedup import SOURCE_TS, with_source_ts
from cdcmart.operators.reconcile import lag_seconds

# Items a state keeps on its highest level; some 10 kB a day.
K = 1_600
# Rank of an answer as a share of all rows: at most this far from the one asked for, in 99% of all states of that size.
RANK_ERROR = 0.004


def lag_states(raw: DataFrame, k: int = K) -> DataFrame:
    """``day, n, low, high, state`` for each day of arrival; rows without one of the two moments do not count."""
    lags = with_source_ts(raw).select(F.to_date(safe_cast(SOURCE_TS, "timestamp")).alias("day"), lag_seconds(raw).alias("lag"))
    return lags.where("lag IS NOT NULL").groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.min("lag").alias("low"), F.max("lag").alias("high"), F.kll_sketch_agg_bigint("lag", F.lit(k)).alias("state")
    )


def merged_states(states: DataFrame, *more: DataFrame, k: int = K) -> DataFrame:
    """States of several deliveries, late ones for earlier days included, as one row per day. Events must not be in two
    of them."""
    for other in more:
        states = states.unionByName(other)
    return states.groupBy("day").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_bigint("state", F.lit(k)).alias("state")
    )


def lag_profile_merged(
    states: DataFrame, quantiles: Sequence[float] = (0.5, 0.9, 0.99, 1.0), first: date | None = None, last: date | None = None, k: int = K
) -> DataFrame:
    """(quantile, lag_seconds, rows) over the days from ``first`` to ``last``, from their states alone. The least and
    the largest lag are exact; any other answer has a rank within ``RANK_ERROR`` of the quantile."""
    if first is not None:
        states = states.where(F.col("day") >= F.lit(first))
    if last is not None:
        states = states.where(F.col("day") <= F.lit(last))
    total = states.agg(F.sum("n").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_bigint("state", F.lit(k)).alias("state"))
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    found = F.arrays_zip(asked.alias("quantile"), F.kll_sketch_get_quantile_bigint("state", asked).alias("near"))
    rows = total.where("rows > 0").select("rows", "low", "high", F.inline(found))
    value = F.when(F.col("quantile") <= 0, F.col("low")).when(F.col("quantile") >= 1, F.col("high")).otherwise(F.col("near"))
    return rows.select("quantile", value.alias("lag_seconds"), "rows")


def rank_within(raw: DataFrame, profile: DataFrame, error: float = RANK_ERROR) -> DataFrame:
    """``profile`` with the flag ``within``: whether the rank of each answer among all lags of ``raw`` lies as near to
    its quantile as promised. A check of the states; it reads the events."""
    lags = with_source_ts(raw).select(lag_seconds(raw).alias("lag")).where("lag IS NOT NULL")
    counts = lags.groupBy("lag").agg(F.count(F.lit(1)).alias("n"))
    # The profile has one row per quantile asked for.
    against = counts.join(F.broadcast(profile), F.lit(True))
    below = F.sum(F.when(F.col("lag") < F.col("lag_seconds"), F.col("n")).otherwise(0))
    upto = F.sum(F.when(F.col("lag") <= F.col("lag_seconds"), F.col("n")).otherwise(0))
    q, n = F.col("quantile"), F.col("rows")
    ranks = against.groupBy("quantile", "lag_seconds", "rows").agg(below.alias("below"), upto.alias("upto"))
    return ranks.withColumn("within", (F.col("below") / n - error <= q) & (q <= F.col("upto") / n + error)).drop("below", "upto")
