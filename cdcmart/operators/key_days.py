"""Distinct keys that add up over days.

A key counts in a window of days if it occurs in one of them. Of its occurrences in the window, exactly the first has its
previous occurrence before the window. So the number of (key, day) pairs by day and by the previous day of the same key
is all that is needed: a table of numbers, whose size depends on the days and not on the keys, gives the distinct keys
of every window, and changes to it add up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def key_days(df: DataFrame, keys: Sequence[str], day: Column) -> DataFrame:
    """The distinct pairs ``keys, day``; a row with a NULL in either is in none. Partial sums keep a hot key small."""
    pairs = df.select(*keys, day.alias("day")).dropna()
    return pairs.distinct()


def returns(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``day, before, n``: pairs of a day by the day on which their key occurred last, NULL for the first time.

    The window runs over the days of one key, so no task holds more rows for a key than there are days."""
    before = F.lag("day").over(W.partitionBy(*keys).orderBy("day")).alias("before")
    return pairs.select("day", before).groupBy("day", "before").agg(F.count(F.lit(1)).alias("n"))


def added(numbers: DataFrame, pairs: DataFrame, new: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(numbers, pairs) after pairs of new rows, late ones included, have been taken up.

    Only keys that occur in ``new`` are looked at again: what they gave to the numbers is taken out, and what they give
    with their new days is put in."""
    fresh = new.select(*keys, "day").distinct().join(pairs, [*keys, "day"], "left_anti")
    touched = pairs.join(fresh.select(*keys).distinct(), list(keys), "left_semi")
    minus = returns(touched, keys).withColumn("n", -F.col("n"))
    plus = returns(touched.unionByName(fresh), keys)
    total = numbers.unionByName(minus).unionByName(plus).groupBy("day", "before").agg(F.sum("n").alias("n")).where("n <> 0")
    return total, pairs.unionByName(fresh)


def distinct_keys(numbers: DataFrame, windows: DataFrame) -> DataFrame:
    """``windows`` (columns ``first`` and ``last``, both days included) with ``distinct_keys``, from the numbers alone.

    The numbers have at most a row for each pair of days and stay where they are; the windows, which somebody asks for,
    are sent to them, and partial sums come back."""
    asked = windows.select("first", "last").distinct()
    inside = F.col("day").between(F.col("first"), F.col("last")) & (F.col("before").isNull() | (F.col("before") < F.col("first")))
    sums = numbers.join(F.broadcast(asked), inside).groupBy("first", "last").agg(F.sum("n").alias("distinct_keys"))
    return asked.join(sums, ["first", "last"], "left").select("first", "last", F.coalesce("distinct_keys", F.lit(0)).alias("distinct_keys"))
