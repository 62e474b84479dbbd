import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from cdcmart.functions.times import as_micros
from cdcmart.operators import quality
from cdcmart.operators.dedup import latest_by_key, with_source_ts
from cdcmart.operators.reconcile import only_in
from cdcmart.operators.rates import convert_to_usd, money_times_rate, one_rate_per_key
from cdcmart.operators.rollup import item_rollup
from cdcmart.operators.upsert import matches, upsert, upsert_files
from cdcmart.operators.windows import naive_window, retro_bound, retro_window, same_date_range, since, since_date


def events(spark, data):
    df = spark.createDataFrame(data, "id string, src string, v int, ts string")
    moment = F.col("ts").cast("timestamp").alias("source_timestamp")
    return df.select("id", "src", "v", F.struct(moment).alias("datastream_metadata"))


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_version_wins_and_events_without_source_time_are_dropped(spark, rows):
    df = events(
        spark,
        [
            ("a", "x", 1, "2024-01-01"),
            ("a", "x", 2, "2024-01-03"),
            ("a", "x", 3, "2024-01-02"),
            ("a", "x", 9, None),
            ("b", "x", 4, None),
            (None, "x", 5, "2024-01-01"),
            (None, "x", 6, "2024-01-02"),
        ],
    )
    assert rows(latest_by_key(with_source_ts(df), ["id"]), "id", "v") == sorted([("a", 2), (None, 6)], key=repr)


def test_ties_are_broken_the_same_way_in_any_order(spark, rows):
    data = [("a", "x", i % 7, "2024-01-01") for i in range(40)]
    first = rows(latest_by_key(events(spark, data), ["id"]), "id", "v")
    again = rows(latest_by_key(events(spark, data[::-1]).repartition(5), ["id"]), "id", "v")
    assert first == again == [("a", 6)]


def test_composite_key_keeps_colliding_ids(spark, rows):
    df = events(spark, [("a", "x", 1, "2024-01-01"), ("a", "y", 2, "2024-01-02")])
    assert rows(latest_by_key(df, ["id"]), "v") == [(2,)]
    assert rows(latest_by_key(df, ["id", "src"]), "v") == [(1,), (2,)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("x").alias("src"),
        F.col("id").alias("v"),
        F.struct(F.timestamp_seconds("id").alias("source_timestamp")).alias("datastream_metadata"),
    )
    latest = latest_by_key(df, ["id"])
    text = plan(latest)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text.split("Exchange")[1]
    assert latest.count() == 20_001
    assert latest.where("id = 'hot'").first()["v"] == 29_997


RATES = [("BRL", "2024-01-01", "0.2"), ("BRL", "2024-01-02", "0.25"), ("BRL", "2024-01-02", "0.3"), ("USD", "2024-01-01", "1.0")]


def orders(spark):
    return spark.createDataFrame(
        [
            ("o1", "BRL", "2024-01-01", Decimal("10.123456789")),
            ("o2", "BRL", "2024-01-02", Decimal("10")),
            ("o3", "EUR", "2024-01-01", Decimal("10")),
            ("o4", None, "2024-01-01", Decimal("10")),
            ("o5", "USD", None, Decimal("10")),
            ("o6", "USD", "2024-01-01", None),
        ],
        "order_id string, currency_code string, d string, amount decimal(38,9)",
    ).withColumn("d", F.col("d").cast("date"))


@pytest.mark.parametrize("broadcast_rows", [100, 2])
def test_conversion_with_and_without_broadcast(spark, rows, broadcast_rows):
    rates = spark.createDataFrame(RATES, "currency_code string, exchange_date string, rate_to_usd string")
    usd = convert_to_usd(orders(spark), rates, {"amount": "usd"}, date="d", broadcast_rows=broadcast_rows)
    assert rows(usd, "order_id", "usd") == [
        ("o1", Decimal("2.024691358")),
        ("o2", Decimal("3.000000000")),
        ("o3", None),
        ("o4", None),
        ("o5", None),
        ("o6", None),
    ]
    text = plan(usd)
    assert ("BroadcastHashJoin" in text) == (broadcast_rows == 100)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_rate_digits_survive(spark, rows):
    rates = spark.createDataFrame([("COP", "2024-01-01", "0.000261234")], "currency_code string, exchange_date string, rate_to_usd string")
    df = spark.createDataFrame([("COP", Decimal("10.123456789"))], "currency_code string, amount decimal(38,9)")
    usd = convert_to_usd(df, rates, {"amount": "usd"}, date=F.lit("2024-01-01").cast("date"))
    assert rows(usd, "usd") == [(Decimal("0.002644591"),)]


def test_only_a_result_too_large_stops_the_job(spark, rows):
    data = [("A", "2024-01-01", "0.0000000004"), ("B", "2024-01-01", "250000001"), ("C", "2024-01-01", "1"), ("D", "2024-01-01", "0.5")]
    rates = spark.createDataFrame(data, "currency_code string, exchange_date string, rate_to_usd string")
    top = Decimal("99999999999999999999999999999.999999999")
    low = Decimal("-99999999999999999999999999999.999999999")
    amounts = [("A", Decimal(10**10)), ("B", Decimal(-(10**11))), ("C", top), ("C", low), ("D", Decimal("0.000000001")), ("D", Decimal("-0.000000001"))]
    df = spark.createDataFrame(amounts, "currency_code string, amount decimal(38,9)")
    convert = lambda d: convert_to_usd(d, rates, {"amount": "usd"}, date=F.lit("2024-01-01").cast("date"))
    got = {(r["currency_code"], r["amount"]): r["usd"] for r in convert(df).collect()}
    want = [Decimal(4), Decimal("-25000000100000000000"), top, low, Decimal("0.000000001"), Decimal("-0.000000001")]
    assert [got[a] for a in amounts] == want
    with pytest.raises(Exception, match="amount in USD too large"):
        convert(spark.createDataFrame([("B", top)], df.schema)).collect()


def test_long_multiplication_against_exact_arithmetic(spark):
    getcontext().prec = 100
    rng = random.Random(1)
    data = []
    while len(data) < 300:
        a = Decimal(rng.choice((1, -1)) * rng.randrange(10 ** rng.randint(1, 38))).scaleb(-9)
        r = Decimal(rng.randrange(10 ** rng.randint(1, 38))).scaleb(-18)
        if abs(a * r) < 10**29 - 1:
            data.append((a, r))
    df = spark.createDataFrame(data, "a decimal(38,9), r decimal(38,18)")
    for a, r, got in df.select("a", "r", money_times_rate(F.col("a"), F.col("r"))).collect():
        assert got == (a * r).quantize(Decimal("1e-9"), ROUND_HALF_UP)


def test_one_rate_per_key_takes_the_larger(spark, rows):
    rates = spark.createDataFrame(RATES, "currency_code string, exchange_date string, rate_to_usd string")
    assert len(rows(one_rate_per_key(rates))) == 3


def test_rollup_nulls(spark, rows):
    items = spark.createDataFrame(
        [("o1", 2, True), ("o1", None, None), ("o2", None, False)], "order_id string, quantity bigint, is_recommended boolean"
    )
    assert rows(item_rollup(items)) == [("o1", 2, 2, 1), ("o2", 1, None, 0)]


def dated(spark, data):
    return spark.createDataFrame(data, "id string, t string").select("id", F.col("t").cast("timestamp").alias("created_at"))


def test_retro_window_boundary_is_inclusive(spark, rows):
    target = dated(spark, [("t", "2024-01-08 12:00:00")])
    raw = dated(spark, [("in", "2024-01-01 12:00:00"), ("out", "2024-01-01 11:59:59"), ("late", "2024-01-07"), ("null", None)])
    assert rows(retro_window(raw, target), "id") == [("in",), ("late",)]
    assert rows(naive_window(raw, target), "id") == []
    assert len(rows(retro_window(raw, None))) == 4
    assert len(rows(retro_window(raw, target.where("false")))) == 3


def test_future_rows_do_not_move_the_window(spark):
    future = as_micros("2030-01-01")
    assert retro_bound(future, 7, cap="2024-01-08") == as_micros("2024-01-01")
    assert retro_bound(None, 7) == -7 * 86_400_000_000


def test_since_variants(spark, rows):
    df = dated(spark, [("a", "2024-01-01 06:00:00"), ("b", "2024-01-01 18:00:00"), ("c", "2023-12-31 23:59:59")])
    assert rows(since(df, "2024-01-31 12:00:00", 30), "id") == [("b",)]
    assert rows(since_date(df, "2024-01-31 12:00:00", 30), "id") == [("a",), ("b",)]


def test_same_date_range(spark, rows):
    ref = dated(spark, [("r", "2024-01-02 13:00:00"), ("s", "2024-01-04 01:00:00")])
    df = dated(spark, [("a", "2024-01-02"), ("b", "2024-01-04 23:59:59.999999"), ("c", "2024-01-05"), ("d", "2024-01-01 23:59:59")])
    assert rows(same_date_range(df, ref), "id") == [("a",), ("b",)]
    assert rows(same_date_range(df, ref.where("false"))) == []


SCHEMA = "k string, v int, w int, day int"


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_upsert_updates_inserts_and_keeps(spark, rows):
    target = table(spark, [("a", 1, 1, 1), ("b", 2, 2, 1), ("c", 3, 3, 1)])
    source = table(spark, [("b", 20, 20, 2), ("d", 40, 40, 2)])
    expected = [("a", 1, 1, 1), ("b", 20, 20, 2), ("c", 3, 3, 1), ("d", 40, 40, 2)]
    once = upsert(target, source, ["k"])
    assert rows(once) == expected
    assert rows(upsert(once, source, ["k"])) == expected


def test_upsert_column_subset(spark, rows):
    target = table(spark, [("a", 1, 1, 1)])
    source = table(spark, [("a", 2, 2, 2), ("b", 5, 5, 5)])
    assert rows(upsert(target, source, ["k"], update_cols=["v"])) == [("a", 2, 1, 1), ("b", 5, 5, 5)]
    with pytest.raises(ValueError, match="nope"):
        upsert(target, source, ["k"], update_cols=["nope"])


def test_upsert_updates_to_null(spark, rows):
    assert rows(upsert(table(spark, [("a", 1, 1, 1)]), table(spark, [("a", None, 2, None)]), ["k"])) == [("a", None, 2, None)]


def test_row_outside_the_target_filter_is_inserted_again(spark, rows):
    target = table(spark, [("old", 1, 1, 1), ("new", 1, 1, 9), ("null", 1, 1, None)])
    source = table(spark, [("old", 2, 2, 9), ("new", 2, 2, 9), ("null", 2, 2, 9)])
    assert rows(upsert(target, source, ["k"], target_filter=F.col("day") >= 5)) == sorted(
        [("old", 1, 1, 1), ("old", 2, 2, 9), ("new", 2, 2, 9), ("null", 1, 1, None), ("null", 2, 2, 9)], key=repr
    )


def test_every_target_copy_of_a_key_is_updated(spark, rows):
    target = table(spark, [("a", 1, 1, 1), ("a", 2, 2, 1)])
    assert rows(upsert(target, table(spark, [("a", 7, 7, 7)]), ["k"])) == [("a", 7, 7, 7)] * 2


def test_source_with_a_key_twice_is_refused(spark):
    source = table(spark, [("a", 1, 1, 1), ("b", 1, 1, 1), ("a", 2, 2, 2)])
    for target in (table(spark, []), table(spark, [("a", 0, 0, 0)])):
        with pytest.raises(Exception, match="several rows for key: a"):
            upsert(target, source, ["k"]).collect()
        with pytest.raises(Exception, match="several rows for key: a"):
            upsert(target, source, ["k"]).select("v").count()


def test_null_keys(spark, rows):
    source = table(spark, [(None, 1, 1, 1), (None, 2, 2, 2)])
    with pytest.raises(Exception, match="NULL key"):
        upsert(table(spark, []), source, ["k"]).collect()
    once = upsert(table(spark, []), source, ["k"], allow_null_keys=True)
    assert len(rows(once)) == 2
    assert len(rows(upsert(once, source, ["k"], allow_null_keys=True))) == 4


def test_newer_target_row_is_kept(spark, rows):
    target = table(spark, [("a", 1, 1, 5), ("b", 1, 1, None)])
    source = table(spark, [("a", 2, 2, 4), ("b", 2, 2, 4)])
    assert rows(upsert(target, source, ["k"], newer_by="day")) == [("a", 1, 1, 5), ("b", 2, 2, 4)]


def test_upsert_plan_has_no_full_outer_or_nested_loop_join(spark):
    target = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    text = plan(upsert(target, target.limit(10), ["k"]))
    assert "FullOuter" not in text and "NestedLoop" not in text and "Cartesian" not in text


def test_upsert_with_a_hot_target_key(spark):
    target = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.lit(1).alias("v")
    )
    source = spark.createDataFrame([("hot", 2), ("1", 3), ("new", 4)], "k string, v int")
    out = upsert(target, source, ["k"]).groupBy("v").count()
    assert {r["v"]: r["count"] for r in out.collect()} == {1: 19_999, 2: 10_000, 3: 1, 4: 1}


def as_files(df, path, n=3):
    df.repartition(n).write.parquet(str(path))
    return df.sparkSession.read.schema(df.schema).parquet(str(path))


@pytest.mark.parametrize("listed", [0, 2000])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_by_place_equals_merge_by_key(spark, rows, tmp_path, seed, listed):
    """Repeated and NULL keys in the target, rows outside the filter, newer rows in the target."""
    rng = random.Random(seed)
    draw = lambda k: (k, rng.randint(0, 9), rng.choice([None, *range(5)]))
    target = as_files(spark.createDataFrame([draw(rng.choice([None, *"abcdefgh"])) for _ in range(30)], "k string, v int, t int"), tmp_path / "t")
    keys = [*rng.sample("abcdefghij", 6), None]
    source = as_files(spark.createDataFrame([draw(k) for k in keys], target.schema), tmp_path / "s")
    for options in ({}, {"target_filter": F.col("v") > 4}, {"update_cols": ["v"]}, {"newer_by": "t"}):
        options["allow_null_keys"] = True
        got = upsert_files(target, source, ["k"], listed_files=listed, **options)
        assert rows(got) == rows(upsert(target, source, ["k"], **options))
    with pytest.raises(Exception, match="NULL key"):
        upsert_files(target, source, ["k"]).collect()
    with pytest.raises(Exception, match="several rows"):
        upsert_files(target, source.where("k IS NOT NULL").unionAll(source), ["k"], allow_null_keys=True).collect()
    with pytest.raises(ValueError, match="not in the target"):
        upsert_files(target, source, ["k"], update_cols=["w"])


def test_merge_by_place_looks_at_the_keys_of_the_target_once(spark, tiny_skew, tmp_path):
    big = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") % 9_000).alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("t"))
    target = as_files(big.sortWithinPartitions("k"), tmp_path / "t", 1)
    extra = spark.range(5).select(F.concat(F.lit("other"), "id").alias("k"), F.col("id").alias("v"), F.lit("x").alias("t"))
    extra.write.mode("append").parquet(str(tmp_path / "t"))
    target = spark.read.schema(big.schema).parquet(str(tmp_path / "t"))
    source = as_files(spark.createDataFrame([("other1", 100, "y"), ("new", 1, "z")], big.schema), tmp_path / "s")
    found = matches(target, source, ["k"])
    text = plan(found)
    reads = [line for line in text.splitlines() if "FileScan" in line and "/t]" in line]
    assert len(reads) == 1 and "ReadSchema: struct<k:string,_tmp_metadata_row_index:bigint>" in reads[0]
    assert text.count("Exchange hashpartitioning") == 2  # the keys of the target and those of the source
    merged = upsert_files(target, source, ["k"])
    assert merged.count() == 20_006 and merged.where("k = 'other1'").first()["v"] == 100
    # The file without a match is left out of the scan whose rows are shuffled, by place, and copied by another one.
    text = plan(merged)
    shuffled = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("file_path" in line or "__file" in line for line in shuffled) == 1
    assert sum("FileScan" in line and "/t]" in line for line in text.splitlines()) == 2


def test_merge_by_place_with_a_hot_target_key(spark, tiny_skew, tmp_path):
    target = as_files(_hot(spark).select(F.col("currency_code").alias("k"), "order_id"), tmp_path / "t", 6)
    source = as_files(target.dropDuplicates(["k"]).withColumn("order_id", F.lit("new")), tmp_path / "s")
    found = matches(target, source, ["k"])
    assert len(found.collect()) == 60_000
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    assert upsert_files(target, source, ["k"]).where("order_id = 'new'").count() == 60_000


def test_assertions(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), (None, 2)], "k string, v int")
    assert rows(quality.assert_not_null(df, ["k", "v"])) == [("k", 1), ("v", 1)]
    assert rows(quality.assert_not_null(df.where("k = 'b'"), ["k", "v"])) == []
    assert rows(quality.assert_unique(df, ["k"])) == [("a", 2)]
    assert rows(quality.assert_unique(df, ["k", "v"])) == []
    parent = spark.createDataFrame([("a",), ("a",)], "id string")
    assert rows(quality.assert_ref(df, "k", parent, "id")) == [("b", 1)]


@pytest.fixture
def tiny_skew(spark):
    """Thresholds small enough for test data to count as skewed."""
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _hot(spark, n=60_000):
    return spark.range(0, n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("USD")).otherwise(F.concat(F.lit("C"), F.col("id") % 500)).alias("currency_code"),
        F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
        F.col("id").cast("decimal(38,9)").alias("amount"),
    )


def test_hot_currency_is_split_beyond_the_broadcast_bound(spark, tiny_skew):
    df = _hot(spark).withColumn("d", F.lit("2024-01-01").cast("date"))
    rates = spark.createDataFrame([("USD", "2024-01-01", "2"), ("C1", "2024-01-01", "3")], "currency_code string, exchange_date string, rate_to_usd string")
    usd = convert_to_usd(df, rates, {"amount": "usd"}, date="d", broadcast_rows=1)
    assert usd.count() == 60_000
    usd.collect()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        largest = usd.groupBy(F.spark_partition_id()).count().orderBy(F.desc("count")).first()["count"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert largest < 15_000


def test_hot_target_key_of_a_merge_is_split(spark, tiny_skew, tmp_path):
    target = _hot(spark).select(F.col("currency_code").alias("k"), "order_id")
    path = str(tmp_path / "source")
    target.dropDuplicates(["k"]).withColumn("order_id", F.lit("new")).write.parquet(path)
    merged = upsert(target, spark.read.schema(target.schema).parquet(path), ["k"])
    assert len(merged.collect()) == 60_000
    assert "skew=true" in merged._jdf.queryExecution().executedPlan().toString()
    assert merged.where("order_id = 'new'").count() == 60_000


def test_hot_key_of_lost_rows_is_split(spark, tiny_skew):
    a = _hot(spark)
    for other, left in ((a.where("currency_code <> 'USD'"), 20_000), (a.where("currency_code = 'USD'"), 40_000)):
        lost = only_in(a, other, ["currency_code"])
        assert len(lost.collect()) == left
        assert "skew=true" in lost._jdf.queryExecution().executedPlan().toString()
