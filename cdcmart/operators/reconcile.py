"""Reconciliation of two versions of a table.

The reports never join the two sides row by row. Both are put under one another with a side marker and summed up per
key, with partial sums before the one shuffle of all rows: repeated or hot keys cost nothing extra and no pairs are
formed. NULL keys match nothing, as in a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cdcmart.functions.casts import round_to_long, safe_cast
from cdcmart.operators.dedup import SOURCE_TS, with_source_ts
from cdcmart.operators.windows import same_date_range
from cdcmart.session import fresh_dir

# Names of the checks, in the order they are reported.
LOST = "C: rows lost (A but not B)"
ADDED = "D: rows wrongly added (B but not A)"
ROW_COUNT = "parity: total row count"
KEY_COUNT = "parity: distinct keys"
ONLY_BASELINE = "rows_only_in_baseline"
ONLY_LIVE = "rows_only_in_live"
DIVERGENT = "rows_with_field_divergence"

# Columns of the items table compared by default.
COMPARED = ("order_id", "product_id", "quantity", "net_amount_local", "default_code", "is_recommended")


_OWN = "__own_shuffle"


def only_in(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key does not occur in ``b``, duplicates kept.

    The keys of ``b`` are made distinct with partial aggregation, so a hot key of ``b`` is one row. The join has one
    more column, 0 on both sides, for a hot key of ``a``: the shuffle that made the keys distinct does not serve a
    join on it, and between a join and shuffles of its own adaptive execution can split the hot partition.
    """
    own = F.pmod(F.xxhash64(*keys), F.lit(1)).alias(_OWN)
    known = b.select(*keys).distinct().select(*keys, own)
    return a.select("*", own).join(known, [*keys, _OWN], "left_anti").select(*a.columns)


def profile(df: DataFrame, key: str, ts: str, amount: str) -> DataFrame:
    """One row: rows, distinct keys, first and last moment, exact sum of money."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct(key).alias("distinct_keys"),
        F.min(ts).alias("window_start"),
        F.max(ts).alias("window_end"),
        F.sum(amount).alias(f"sum_{amount}"),
    ).select(F.lit("baseline_snapshot").alias("check_name"), "*")


def _null_key(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _stacked(a: DataFrame, b: DataFrame, cols: Sequence[str], amount: str | None) -> DataFrame:
    """Both sides under one another: ``cols``, the row counters n_a and n_b, the money m_a and m_b."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def side(df: DataFrame, is_a: bool) -> DataFrame:
        money = F.col(amount) if amount else F.lit(None).cast("decimal(38,9)")
        nothing = F.lit(None).cast(money_type)
        return df.select(
            *cols,
            (one if is_a else zero).alias("n_a"),
            (zero if is_a else one).alias("n_b"),
            (money if is_a else nothing).alias("m_a"),
            (nothing if is_a else money).alias("m_b"),
        )

    money_type = a.schema[amount].dataType if amount else "decimal(38,9)"
    return side(a, True).unionByName(side(b, False))


def _counted(stacked: DataFrame, by: Sequence[str]) -> DataFrame:
    return stacked.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("n_a", "n_b", "m_a", "m_b")])


def _count(rows: Column, cond: Column | None = None) -> Column:
    # An aggregate over no rows is NULL, a count is 0.
    return F.coalesce(F.sum(rows if cond is None else F.when(cond, rows).otherwise(F.lit(0))), F.lit(0))


def _money_gap(a: Column, b: Column) -> Column:
    # Narrowed by one digit: the difference of two 38-digit decimals would give up its last decimal place.
    return F.abs(a.cast("decimal(37,9)") - b.cast("decimal(37,9)"))


def _cents(gap: Column) -> Column:
    """Rounded at the cent first: a product would give up decimal places and round them before."""
    return (F.round(gap, 2).cast("decimal(36,2)") * F.lit(100).cast("decimal(3,0)")).cast("decimal(38,0)").cast("bigint")


def _as_rows(totals: DataFrame, checks: dict[str, Column]) -> DataFrame:
    rows = F.array(
        *[F.struct(F.lit(name).alias("check_name"), v.alias("failing_rows")) for name, v in checks.items()]
    )
    return totals.select(F.inline(rows)).orderBy("check_name")


def abcd_verdict(
    a: DataFrame, b: DataFrame, keys: Sequence[str], amount: str = "net_amount_local", *, exact_sum: bool = False
) -> DataFrame:
    """Five checks of table ``b`` against the baseline ``a``, as (check_name, failing_rows); all must be 0.

    The sum check is rounded to whole units of money, so a gap below one half passes it; ``exact_sum`` adds a sixth
    row with the gap in the ninth decimal place. The sum checks are NULL where a side has no money at all, which is
    not a pass either.
    """
    per_key = _counted(_stacked(a, b, keys, amount), keys)
    no_match = _null_key(keys)
    lost = no_match | (F.col("n_b") == 0)
    added = no_match | (F.col("n_a") == 0)
    totals = per_key.agg(
        _count(F.col("n_a"), lost).alias("lost"),
        _count(F.col("n_b"), added).alias("added"),
        _count(F.col("n_a")).alias("rows_a"),
        _count(F.col("n_b")).alias("rows_b"),
        F.count_if(~no_match & (F.col("n_a") > 0)).alias("keys_a"),
        F.count_if(~no_match & (F.col("n_b") > 0)).alias("keys_b"),
        F.sum("m_a").alias("m_a"),
        F.sum("m_b").alias("m_b"),
    )
    gap = _money_gap(F.col("m_a"), F.col("m_b"))
    checks = {
        LOST: F.col("lost"),
        ADDED: F.col("added"),
        ROW_COUNT: F.abs(F.col("rows_a") - F.col("rows_b")),
        KEY_COUNT: F.abs(F.col("keys_a") - F.col("keys_b")),
        f"parity: sum({amount})": round_to_long(F.round(gap, 2)),
    }
    if exact_sum:
        checks[f"parity: sum({amount}), exact"] = (gap.cast("decimal(38,9)") * F.lit(10**9).cast("decimal(10,0)")).cast("decimal(38,0)")
    return _as_rows(totals, checks)


def _print(cols: Sequence[str]) -> Column:
    # A hash passes over NULL, so that is a value of its own beside every column.
    return F.xxhash64(*[c for name in cols for c in (F.col(name), F.col(name).isNull())]) if cols else F.lit(0).cast("bigint")


def _agreement(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str], amount: str | None) -> DataFrame:
    """Per key: rows and money on each side, and how many of the n_a x n_b pairs agree in all of ``cols``.

    All rows are shuffled once, after partial sums per key: of each side the rows, the money and a fingerprint, which
    adds up from 64-bit hashes of the rows in any order. Where a key has one row on each side, as most do, comparing
    the fingerprints compares the rows; one in 2^64 pairs that differ would be taken for equal.

    Keys with several rows go the exact way, and only the rows of these are read again: grouping treats NULL as equal
    to NULL, so the number of agreeing pairs is the sum, over the distinct versions of a key, of the product of their
    row counts: counted, not formed. Whether there are such keys is known from the written sums per key.
    """
    spark = a.sparkSession
    compared = [c for c in cols if c not in keys]
    stacked = _stacked(a, b, list(dict.fromkeys([*keys, *compared])), amount)
    marked = stacked.withColumn("print", _print(compared))
    sums = marked.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("n_a", "n_b", "m_a", "m_b")],
        F.bit_xor(F.when(F.col("n_a") > 0, F.col("print"))).alias("print_a"),
        F.bit_xor(F.when(F.col("n_b") > 0, F.col("print"))).alias("print_b"),
    )
    path = fresh_dir(spark, "reconcile/sums")
    sums.write.option("compression", "zstd").parquet(path)
    sums = spark.read.schema(sums.schema).parquet(path)

    one_each = (F.col("n_a") == 1) & (F.col("n_b") == 1) & (F.col("print_a") == F.col("print_b"))
    # A plain flag: NULL keys have pairs with nothing, however many rows they have.
    several = (F.col("n_a") > 0) & (F.col("n_b") > 0) & (F.col("n_a") + F.col("n_b") > 2) & ~_null_key(keys)
    by_print = sums.where(~several).select(*keys, "n_a", "n_b", "m_a", "m_b", one_each.cast("bigint").alias("agreeing"))
    repeated = sums.where(several).select(*keys)
    if repeated.isEmpty():
        return by_print
    own = F.pmod(F.xxhash64(*keys), F.lit(1)).alias(_OWN)
    rows = stacked.select("*", own).join(repeated.select("*", own), [*keys, _OWN], "left_semi")
    version = _counted(rows, list(dict.fromkeys([*keys, *compared])))
    counted = version.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("n_a", "n_b", "m_a", "m_b")],
        F.sum(F.col("n_a") * F.col("n_b")).alias("agreeing"),
    )
    return by_print.unionByName(counted)


def compared_columns(a: DataFrame, keys: Sequence[str], cols: Sequence[str] | str) -> list[str]:
    """``cols``, or every column that is not a key for ``"all"``."""
    return [c for c in a.columns if c not in keys] if cols == "all" else list(cols)


def diverging(
    a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str] | str = COMPARED
) -> DataFrame:
    """(keys, rows_a, rows_b, diverging_rows) for each key on both sides where some pair of rows differs in ``cols``.

    ``diverging_rows`` is the number of rows an inner join on the keys with a null-safe inequality would return.
    """
    per_key = _agreement(a, b, keys, compared_columns(a, keys, cols), None)
    pairs = F.col("n_a") * F.col("n_b") - F.col("agreeing")
    return (
        per_key.where(~_null_key(keys))
        .select(*keys, F.col("n_a").alias("rows_a"), F.col("n_b").alias("rows_b"), pairs.alias("diverging_rows"))
        .where(F.col("diverging_rows") > 0)
    )


def parity_report(
    baseline: DataFrame,
    live: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str] | str = COMPARED,
    amount: str = "net_amount_local",
    ts: str = "created_at",
) -> DataFrame:
    """Four checks of the live table against its baseline, as (check_name, failing_rows); all must be 0.

    The live table is restricted to the dates the baseline covers. The money gap is in cents.
    """
    live = same_date_range(live, baseline, ts)
    per_key = _agreement(baseline, live, keys, compared_columns(baseline, keys, cols), amount)
    no_match = _null_key(keys)
    totals = per_key.agg(
        _count(F.col("n_a"), no_match | (F.col("n_b") == 0)).alias("only_a"),
        _count(F.col("n_b"), no_match | (F.col("n_a") == 0)).alias("only_b"),
        _count(F.col("n_a") * F.col("n_b") - F.col("agreeing"), ~no_match).alias("divergent"),
        F.sum("m_a").alias("m_a"),
        F.sum("m_b").alias("m_b"),
    )
    gap = _money_gap(F.col("m_a"), F.col("m_b"))
    return _as_rows(
        totals,
        {
            ONLY_BASELINE: F.col("only_a"),
            ONLY_LIVE: F.col("only_b"),
            DIVERGENT: F.col("divergent"),
            f"sum_{amount.removesuffix('_local')}_diff_cents": _cents(gap),
        },
    )


def lag_seconds(df: DataFrame, ts: str = "created_at") -> Column:
    """Whole seconds between the event's own time and the moment the source recorded the change."""
    return F.unix_seconds(safe_cast(SOURCE_TS, "timestamp")) - F.unix_seconds(safe_cast(ts, "timestamp"))


def lag_profile(raw: DataFrame, quantiles: Sequence[float] = (0.5, 0.9, 0.99, 1.0)) -> DataFrame:
    """(quantile, lag_seconds): exact quantiles of the CDC lag, with linear interpolation between neighbours.

    Exact at any size: rows are first counted per distinct lag, the running count is taken over whole days of lag
    (as many rows as the largest lag has days), and only inside a day over its seconds (at most 86,400 rows). So no
    task ever holds more than one day's distinct lags.
    """
    lags = with_source_ts(raw).select(lag_seconds(raw).alias("lag")).where(F.col("lag").isNotNull())
    counts = lags.groupBy("lag").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("day", F.floor(F.col("lag") / 86_400).cast("bigint"))
    days = counts.groupBy("day").agg(F.sum("n").alias("n_day"))
    by_day = W.orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    days = days.select(
        "day",
        F.coalesce(F.sum("n_day").over(by_day), F.lit(0)).alias("before_day"),
        F.sum("n_day").over(W.partitionBy()).alias("total"),
    )
    in_day = W.partitionBy("day").orderBy("lag").rowsBetween(W.unboundedPreceding, 0)
    ranked = (
        counts.join(days, "day")
        .withColumn("upto", F.col("before_day") + F.sum("n").over(in_day))
        .withColumn("from", F.col("upto") - F.col("n"))
    )
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("quantile")
    position = F.col("quantile") * (F.col("total") - 1)
    low, high = F.floor(position), F.ceil(position)

    def holds(rank: Column) -> Column:
        return (F.col("from") <= rank) & (rank < F.col("upto"))

    hits = ranked.select("lag", "from", "upto", "total", wanted).where(holds(low) | holds(high))
    at = hits.groupBy("quantile").agg(
        F.max(F.when(holds(low), F.col("lag"))).alias("lo"),
        F.max(F.when(holds(high), F.col("lag"))).alias("hi"),
        F.max(position - low).alias("part"),
    )
    return at.select("quantile", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("lag_seconds"))


def lag_profile_approx(
    raw: DataFrame, quantiles: Sequence[float] = (0.5, 0.9, 0.99, 1.0), accuracy: int = 10_000
) -> DataFrame:
    """Like ``lag_profile`` with the relative rank error 1/accuracy, in a single pass without a shuffle of rows."""
    lags = with_source_ts(raw).select(lag_seconds(raw).alias("lag"))
    qs = F.array(*[F.lit(float(q)) for q in quantiles])
    found = lags.agg(F.percentile_approx("lag", [float(q) for q in quantiles], accuracy).alias("v"))
    return found.select(F.inline(F.arrays_zip(qs.alias("quantile"), F.col("v").alias("lag_seconds"))))
