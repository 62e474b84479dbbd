from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdcmart.functions import (
    cast_columns,
    day_part,
    differs,
    local_hour,
    region_of,
    round_to_long,
    safe_cast,
    store_age_days,
    store_maturity,
)
from cdcmart.functions.casts import NUMERIC
from cdcmart.functions.times import as_date, as_micros, instant_lit


def cast_all(spark, values, source, to):
    df = spark.createDataFrame([(v,) for v in values], f"v {source}")
    out = safe_cast("v", to)
    if to == "timestamp":
        out = out.cast("timestamp_ntz")
    return [r[0] for r in df.select(out).collect()]


@pytest.mark.parametrize(
    ("to", "values", "expected"),
    [
        ("bigint", ["7", "-3", "", "12.5", "abc", None, "99999999999999999999"], [7, -3, None, None, None, None, None]),
        ("boolean", ["true", "FALSE", "yes", "1", "t", "", None], [True, False, None, None, None, None, None]),
        (
            NUMERIC,
            ["1.0000000005", "", "abc", "-2.5"],
            [Decimal("1.000000001"), None, None, Decimal("-2.500000000")],
        ),
        ("date", ["2024-03-01", "2024", "2024-03-01T00:00:00Z", "x", "2024-13-01"], [date(2024, 3, 1), None, None, None, None]),
        (
            "timestamp",
            ["2024-03-01T10:00:00Z", "2024-03-01T12:00:00+02:00", "2024-03-01 10:00:00.123456", "12:30", "2024", "junk"],
            [
                datetime(2024, 3, 1, 10),
                datetime(2024, 3, 1, 10),
                datetime(2024, 3, 1, 10, 0, 0, 123456),
                None,
                None,
                None,
            ],
        ),
        ("string", ["a", "", None], ["a", "", None]),
    ],
)
def test_text_casts(spark, to, values, expected):
    assert cast_all(spark, values, "string", to) == expected


def test_fractions_round_half_away_from_zero(spark):
    assert cast_all(spark, [12.5, -12.5, 12.4, float("nan"), float("inf"), None], "double", "bigint") == [
        13,
        -13,
        12,
        None,
        None,
        None,
    ]
    assert cast_all(spark, [Decimal("0.5")], "decimal(10,2)", "bigint") == [1]
    assert cast_all(spark, [7], "bigint", "bigint") == [7]
    assert cast_all(spark, [0, 2], "bigint", "boolean") == [False, True]


def test_cast_branch_is_chosen_at_planning_time(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("v")).select(safe_cast("v", "bigint").alias("n"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "typeof" not in plan and "round" not in plan


def test_cast_columns_keeps_rows(spark, rows):
    df = spark.createDataFrame([("1", "yes"), ("x", "true")], "a string, b string")
    out = cast_columns(df, [("a", "n", "bigint"), ("b", "flag", "boolean")])
    assert out.columns == ["n", "flag"]
    assert rows(out) == sorted([(1, None), (None, True)], key=repr)


def test_round_to_long(spark):
    df = spark.createDataFrame([(Decimal("2.50"),), (Decimal("2.49"),), (None,)], "v decimal(10,2)")
    assert [r[0] for r in df.select(round_to_long(F.col("v"))).collect()] == [3, 2, None]


def test_day_part_bounds(spark):
    hours = [5, 6, 10, 11, 14, 15, 18, 19, 22, 23]
    df = spark.createDataFrame([(h, "UTC") for h in hours] + [(8, None)], "h int, tz string").select(
        F.expr("timestamp'2024-03-01 00:00:00' + make_interval(0,0,0,0,h)").alias("ts"), "tz"
    )
    labels = [r[0] for r in df.select(day_part(F.col("ts"), F.col("tz"))).collect()]
    assert labels == [
        "Night",
        *["Morning"] * 2,
        *["Lunch"] * 2,
        *["Afternoon"] * 2,
        *["Evening"] * 2,
        "Night",
        "Night",
    ]


def test_local_hour_uses_the_zone_of_the_row(spark):
    df = spark.createDataFrame([("Asia/Tokyo",), ("America/Sao_Paulo",), (None,)], "tz string")
    ts = instant_lit("2024-03-01 20:00:00")
    assert [r[0] for r in df.select(local_hour(ts, F.col("tz"))).collect()] == [5, 17, None]


def test_unknown_zone_stops_the_job(spark):
    df = spark.createDataFrame([("Mars/Base",)], "tz string")
    with pytest.raises(Exception, match="(?i)zone"):
        df.select(local_hour(instant_lit("2024-03-01"), F.col("tz"))).collect()


def test_region(spark):
    df = spark.createDataFrame([(c,) for c in ["BR", "US", "GB", "JP", "ZZ", None]], "c string")
    assert [r[0] for r in df.select(region_of(F.col("c"))).collect()] == ["LATAM", "NA", "EMEA", "APAC", "Other", "Other"]


def test_store_maturity_bounds(spark):
    ages = [89, 90, 364, 365, 729, 730, None]
    df = spark.createDataFrame([(a,) for a in ages], "a int").select(
        F.date_sub(F.lit(date(2024, 6, 1)), F.col("a")).alias("opened")
    )
    got = df.select(store_age_days(F.col("opened"), "2024-06-01"), store_maturity(F.col("opened"), "2024-06-01"))
    assert [tuple(r) for r in got.collect()] == list(
        zip(ages, ["Ramp-Up", "Young", "Young", "Mature", "Mature", "Established", "Established"], strict=True)
    )


def test_differs_is_null_safe(spark):
    df = spark.createDataFrame(
        [(1, 1, None, None), (1, 2, None, None), (1, 1, None, 5), (None, None, 3, 3)], "ax int, bx int, ay int, by int"
    ).select(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")).alias("a"), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")).alias("b"))
    assert [r[0] for r in df.select(differs("a", "b", ["x", "y"])).collect()] == [False, True, True, False]


def test_as_of_is_utc_whatever_the_machine():
    assert as_micros("1970-01-02") == 86_400_000_000
    assert as_micros("1970-01-02T00:00:00+01:00") == 82_800_000_000
    assert as_micros(date(1970, 1, 2), 1) == 0
    assert as_date("2024-03-01 23:59:59", 1) == date(2024, 2, 29)
