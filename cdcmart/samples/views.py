"""Landing tables derived from the sample tables, by integer arithmetic on keys so that any engine gets the same rows.

The rules give what a change feed gives: several events per key, late events, text that is no number, missing rates,
flags that are NULL, and duplicate rates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.sources.schemas import METADATA

# The latest order date of the sample tables.
AS_OF = "2001-08-01 00:00:00"

# Fixed values of the sample data.
CURRENCIES = ["USD", "PLN", "CHF", "XXX"]
BASE_RATES = {"USD": "1.0", "PLN": "0.20", "CHF": "1.08"}
# One country at least for every region, Other included.
COUNTRIES = [
    ("ZA", "ZAR", "Africa/Johannesburg"),
    ("CA", "CAD", "America/Toronto"),
    ("PE", "PEN", "America/Lima"),
    ("IE", "EUR", "Europe/Dublin"),
    ("TH", "THB", "Asia/Bangkok"),
    ("RS", "RSD", "Europe/Belgrade"),
    ("NZ", "NZD", "Pacific/Auckland"),
    ("UY", "UYU", "America/Montevideo"),
    ("IT", "EUR", "Europe/Rome"),
    ("VN", "VND", "Asia/Ho_Chi_Minh"),
]
CHANNELS = ["web", "counter", "courier", "phone"]
STATUSES = ["open", "open", "closed", "closed", "returned", "void"]
ZONES = ["America/Sao_Paulo", "America/New_York", "Europe/London", "Asia/Tokyo", None]
# Columns that order events of one item with equal source timestamps.
ITEM_TIES = ["part_key", "supp_key", "net_amount"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def metadata(source_ts: Column) -> Column:
    return F.struct(source_ts.alias("source_timestamp")).alias(METADATA)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events: 8% of the orders have a second event a minute later, 3% of the orders arrive up to 36 h late."""
    k = F.col("o_orderkey")
    total = money(F.col("o_totalprice"))
    discount = (total * (k % 20).cast("decimal(2,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(20,4)")
    late = F.when(k % 100 < 3, k % 37).otherwise(0)
    seconds = F.explode(F.when(k % 25 < 2, F.array(F.lit(0), F.lit(60))).otherwise(F.array(F.lit(0)))).alias("again")
    created = F.col("created_at")
    return (
        table(spark, sf_dir, "orders")
        .select("*", F.col("o_orderdate").cast("timestamp").alias("created_at"), seconds)
        .select(
            k.cast("string").alias("id"),
            (F.col("o_custkey") % 100).alias("store_id"),
            F.col("o_custkey").alias("customer_id"),
            pick(CURRENCIES, (F.col("o_custkey") % 4).cast("int")).alias("currency_code"),
            total.alias("total_price"),
            discount.alias("discount"),
            (total - discount).alias("net_amount"),
            pick(CHANNELS, (k % 4).cast("int")).alias("channel"),
            F.when(F.col("again") > 0, "returned").otherwise(pick(STATUSES, (k % 6).cast("int"))).alias("status"),
            "created_at",
            F.timestamp_add("SECOND", F.col("again"), created).alias("updated_at"),
            metadata(F.timestamp_add("SECOND", late * 3600 + F.col("again"), created)),
        )
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item events: keys repeat in the line items; the ship date is the moment of the event."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("timestamp").alias("created_at")
    )
    part = F.col("l_partkey")
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, "l_orderkey")
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.when(part % 200 == 0, "").otherwise(part.cast("string")).alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            ((part % 3201 + 300).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)"))
            .cast("decimal(18,2)")
            .alias("unit_price"),
            money(F.col("l_extendedprice")).alias("net_amount"),
            F.concat(F.lit("SKU-"), (part % 9000 + 1000).cast("string")).alias("default_code"),
            (part % 50 < 9).alias("is_recommended"),
            "created_at",
            F.col("created_at").alias("updated_at"),
            metadata(F.col("l_shipdate").cast("timestamp")),
            part.alias("part_key"),
            F.col("l_suppkey").alias("supp_key"),
        )
    )


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store events: a tenth of the stores was a dev store in an older version."""
    k = F.col("s_suppkey")
    opened = F.date_add(F.lit("1995-01-01").cast("date"), (19 * k).cast("int"))
    country = (F.col("s_nationkey") % 10).cast("int")
    older = F.explode(F.when(k % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("older")
    as_of = F.lit(AS_OF).cast("timestamp")
    version = F.timestamp_add("DAY", -F.col("older"), as_of)
    return (
        table(spark, sf_dir, "supplier")
        .select("*", older)
        .select(
            k.alias("id"),
            F.concat(F.col("s_name"), F.when(F.col("older") > 0, " (old)").otherwise("")).alias("name"),
            pick([c for c, _, _ in COUNTRIES], country).alias("country_code"),
            pick([c for _, c, _ in COUNTRIES], country).alias("currency_code"),
            pick([z for _, _, z in COUNTRIES], country).alias("timezone"),
            (k % 20 < 13).alias("is_franchise"),
            F.when((k % 20 == 0) | (F.col("older") > 0), "True").otherwise("False").alias("is_dev"),
            F.when(k % 7 != 0, F.when(k % 50 == 1, "true").otherwise("false")).alias("is_excluded_from_dw"),
            opened.alias("opening_date"),
            opened.cast("timestamp").alias("created_at"),
            version.alias("updated_at"),
            metadata(version),
        )
    )


def raw_rates(spark: SparkSession, sf_dir: str, jitter: bool = True) -> DataFrame:
    """A rate per currency and order date, within 1% of its base; the first of a month has a second, lower rate."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("exchange_date")).distinct()
    codes = F.explode(
        F.array(
            *[
                F.struct(F.lit(code).alias("currency_code"), F.lit(rate).cast("decimal(9,6)").alias("base"))
                for code, rate in BASE_RATES.items()
            ]
        )
    )
    copies = F.explode(
        F.when(F.dayofmonth("exchange_date") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    )
    thousandths = F.lit(990) + F.dayofyear("exchange_date") % 21 if jitter else F.lit(1000)
    factor = (thousandths - 100 * F.col("copy")).cast("decimal(5,0)") * F.lit("0.001").cast("decimal(4,3)")
    return (
        days.select("exchange_date", codes.alias("c"))
        .select("exchange_date", "c.currency_code", "c.base", copies.alias("copy"))
        .select(
            "currency_code",
            "exchange_date",
            F.round(F.col("base") * factor, 6).cast("decimal(17,9)").alias("rate_to_usd"),
        )
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the time zone of their user; a fifth of the users has none."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), pick(ZONES, (F.col("user_id") % 5).cast("int")).alias("tz")
    )
