"""Currency conversion at the rate of the order's own day."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.functions.casts import NUMERIC, RATE, safe_cast

# About 60 bytes a row in a broadcast table, so some 60 MB: every ISO currency for 15 years of days.
BROADCAST_ROWS = 1_000_000
# Copies of each rate beyond that bound, so that one currency and day is spread over as many tasks.
SALTS = 32

_RATE = "__rate_to_usd"
_CODE = "__rate_code"
_DAY = "__rate_day"
_SALT = "__rate_salt"


def one_rate_per_key(rates: DataFrame) -> DataFrame:
    """One rate for each (currency_code, exchange_date): the largest, where the feed sent several."""
    return (
        rates.select(
            safe_cast("currency_code", "string").alias("currency_code"),
            safe_cast("exchange_date", "date").alias("exchange_date"),
            safe_cast("rate_to_usd", RATE).alias("rate_to_usd"),
        )
        .groupBy("currency_code", "exchange_date")
        .agg(F.max("rate_to_usd").alias("rate_to_usd"))
    )


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows, found without counting further than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def _whole_and_rest(value: Column, unit: int, whole: str, rest: str) -> tuple[Column, Column]:
    """``value`` as a whole number of ``unit`` and a rest, both with the sign of ``value``. A remainder is exact; what
    is left is a multiple of the unit, so the decimal places that its type may lose are all zero."""
    part = (value % F.lit(unit).cast("decimal(10,0)")).cast(rest)
    share = F.lit(f"{1 / unit:.9f}").cast("decimal(10,9)") if unit > 1 else F.lit(1).cast("decimal(1,0)")
    return ((value - part) * share).cast(whole), part


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, outside generated code. For what few rows need: the generated code of
    all rows holds a call and not the whole expression, which would exceed the size up to which it is compiled."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _wide_product(amount: Column, rate: Column) -> Column:
    """Product over the full range of both types, from partial products that are all exact in 38 digits.

    The amount is a * 10^9 + b + c, with b whole and c below one, the rate p + q, with q below one; and q * 10^9 is
    u + v with u whole. The product then is (a*p) * 10^9 + a*u + b*p + a*v + c*p + (b + c)*q, and only the last term
    reaches behind the last place of money. Whole numbers and fractions are summed apart and put together as text, as
    a sum of decimals reserves a digit for a carry and would give up the last place for it. No term has a sign of its
    own, so none is larger than the product.
    """

    def parts(f: Column) -> Column:
        a, low = _whole_and_rest(f["amount"], 10**9, "decimal(20,0)", "decimal(18,9)")
        p, q = _whole_and_rest(f["rate"], 1, "decimal(20,0)", "decimal(18,18)")
        b, c = _whole_and_rest(low, 1, "decimal(9,0)", "decimal(9,9)")
        u, v = _whole_and_rest(q * F.lit(10**9).cast("decimal(10,0)"), 1, "decimal(9,0)", "decimal(9,9)")
        named = {"a": a, "b": b, "c": c, "p": p, "u": u, "v": v, "last": (low * q).cast("decimal(19,9)")}
        return F.struct(*[c.alias(n) for n, c in named.items()])

    def sums(s: Column) -> Column:
        # Each fraction has at most 21 digits before the point, so the sum of wholes takes up its whole part.
        carry, rest = _whole_and_rest(s["a"] * s["v"] + s["c"] * s["p"] + s["last"], 1, "decimal(23,0)", "decimal(9,9)")
        high = F.try_multiply(s["a"], s["p"]).try_cast("decimal(20,0)") * F.lit(10**9).cast("decimal(10,0)")
        whole = (high + s["a"] * s["u"] + s["b"] * s["p"] + carry).try_cast("decimal(29,0)")
        return F.struct(whole.alias("whole"), (rest * F.lit(10**9).cast("decimal(10,0)")).cast("bigint").alias("places"))

    def product(t: Column) -> Column:
        digits = F.replace(t["whole"].cast("string"), F.lit("-"), F.lit(""))
        places = F.lpad(F.replace(t["places"].cast("string"), F.lit("-"), F.lit("")), 9, "0")
        sign = F.when((t["whole"] < 0) | (t["places"] < 0), "-").otherwise("")
        failed = F.raise_error(F.concat(F.lit("amount in USD too large: "), amount.cast("string"), F.lit(" at "), rate.cast("string")))
        return F.when(t["whole"].isNull(), failed.cast(NUMERIC)).otherwise(F.concat(sign, digits, F.lit("."), places).cast(NUMERIC))

    return _with(_with(_with(F.struct(amount.alias("amount"), rate.alias("rate")), parts), sums), product)


def money_times_rate(amount: Column, rate: Column) -> Column:
    """Exact product, rounded once to the money type. It fails only where the result itself leaves that type.

    Amounts below 10^11 at rates of up to eight digits before and nine behind the point take the plain product, which
    is exact in 38 digits; all others are put together from partial products.
    """
    short = rate.try_cast("decimal(17,9)")
    limit = F.lit(10**11).cast("decimal(12,0)")
    plain = (amount > -limit) & (amount < limit) & (short == rate)
    return (
        F.when(amount.isNull() | rate.isNull(), F.lit(None).cast(NUMERIC))
        .when(plain, (amount.try_cast("decimal(20,9)") * short).cast(NUMERIC))
        .otherwise(_wide_product(amount, rate))
    )


def convert_to_usd(
    df: DataFrame,
    rates: DataFrame,
    cols: Mapping[str, str],
    currency: str = "currency_code",
    date: Column | str | None = None,
    *,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Append USD columns: ``cols`` maps a local amount column to the name of its USD column.

    A missing currency, date or rate gives NULL, never a silent rate of 1.

    All amounts share one left join. The rates are broadcast when a bounded count proves them small, which spares the
    shuffle of ``df`` and makes hot currencies harmless. Beyond the bound it is a shuffled join on the key and a salt,
    with a copy of the rates for every salt.
    """
    if date is None:
        date = F.to_date("created_at")
    elif isinstance(date, str):
        date = F.col(date)
    per_key = one_rate_per_key(rates).select(
        F.col("currency_code").alias(_CODE), F.col("exchange_date").alias(_DAY), F.col("rate_to_usd").alias(_RATE)
    )
    matches = (F.col(currency) == F.col(_CODE)) & (date == F.col(_DAY))
    if fits_broadcast(rates.select("currency_code"), broadcast_rows):
        joined = df.join(F.broadcast(per_key), matches, "left")
    else:
        salted = df.withColumn(_SALT, F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("__copy_salt")
        copied = per_key.select("*", copies).hint("merge")
        joined = salted.join(copied, matches & (F.col(_SALT) == F.col("__copy_salt")), "left")
    usd = [money_times_rate(F.col(c), F.col(_RATE)).alias(name) for c, name in cols.items()]
    return joined.select(*[F.col(c) for c in df.columns], *usd)
