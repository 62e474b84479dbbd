"""States that are kept beside tables: quantile states, rollups by differences, distinct keys by day, checks, buckets."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cdcmart.operators import key_days, lag_states
from cdcmart.operators.rollup import item_rollup, rollup_changed, rollup_changes, rollup_of, rollup_state
from cdcmart.operators.upsert import matches, merge_images, upsert
from cdcmart.plans import gold
from cdcmart.sinks.tables import RefusedContent, publish, publish_snapshot, versions, write_bucketed, write_table
from cdcmart.sources.schemas import FCT_ORDERS, ITEMS_CLEAN_SCHEMA, METADATA


def lagged(spark, data):
    """Events of (day of arrival, lag in seconds)."""
    df = spark.createDataFrame(data, "day int, lag bigint")
    ts = F.timestamp_seconds(F.lit(1_700_006_400).cast("bigint") + F.col("day") * 86_400)
    return df.select(F.timestamp_seconds(F.unix_seconds(ts) - F.col("lag")).alias("created_at"), F.struct(ts.alias("source_timestamp")).alias(METADATA))


def test_quantiles_from_states(spark):
    rng = random.Random(4)
    data = [(rng.randint(0, 9), int(rng.paretovariate(1.2) * 60) % 500_000) for _ in range(40_000)]
    states = [lag_states.lag_states(lagged(spark, data[k::3])) for k in range(3)]
    merged = lag_states.merged_states(*states).cache()
    assert merged.count() == 10
    profile = lag_states.lag_profile_merged(merged, [0.0, 0.01, 0.5, 0.9, 0.99, 1.0])
    got = {r["quantile"]: r for r in lag_states.rank_within(lagged(spark, data), profile).collect()}
    assert len(got) == 6 and all(r["within"] and r["rows"] == 40_000 for r in got.values())
    assert got[0.0]["lag_seconds"] == min(v for _, v in data) and got[1.0]["lag_seconds"] == max(v for _, v in data)
    some = [(d, v) for d, v in data if 3 <= d <= 5]
    first = date(2023, 11, 15) + timedelta(days=3)
    part = lag_states.lag_profile_merged(merged, [0.5], first, first + timedelta(days=2)).first()
    assert part["rows"] == len(some) and lag_states.rank_within(lagged(spark, some), lag_states.lag_profile_merged(merged, [0.5], first, first + timedelta(days=2))).first()["within"]
    wrong = spark.createDataFrame([(0.5, 10**6, 40_000)], "quantile double, lag_seconds bigint, rows bigint")
    assert not lag_states.rank_within(lagged(spark, data), wrong).first()["within"]
    assert lag_states.lag_profile_merged(merged.where("false")).count() == 0


def test_rollup_by_differences(spark, rows, tmp_path):
    rng = random.Random(7)

    def item(key):
        return (f"i{key}", f"o{rng.randint(0, 5)}", rng.choice([None, 1, 2, 3]), rng.choice([None, True, False]))

    schema = "order_item_id string, order_id string, quantity bigint, is_recommended boolean"
    held = {k: item(k) for k in range(40)}
    spark.createDataFrame(list(held.values()), schema).write.parquet(str(tmp_path / "t0"))
    state = rollup_state(spark.read.parquet(str(tmp_path / "t0")))
    for n in range(3):
        target = spark.read.parquet(str(tmp_path / f"t{n}"))
        source = spark.createDataFrame([item(k) for k in rng.sample(range(60), 15)], schema).cache()
        matched = matches(target, source, ["order_item_id"]).cache()
        before, after = merge_images(target, source, matched, ["order_item_id"])
        changes = rollup_changes(before, after)
        state = rollup_changed(state, changes).cache()
        merged = upsert(target, source, ["order_item_id"])
        assert rows(rollup_of(state), "order_id", "item_count", "total_quantity", "recommended_count") == rows(
            item_rollup(merged), "order_id", "item_count", "total_quantity", "recommended_count"
        )
        merged.write.parquet(str(tmp_path / f"t{n + 1}"))
    # The same rows again change nothing; an order that loses its last item goes.
    same = target.limit(5)
    assert rollup_changes(same, same).count() == 0
    one = spark.createDataFrame([("i", "o", None, None)], schema)
    assert rollup_changed(rollup_state(one), rollup_changes(one, one.limit(0))).count() == 0


def test_distinct_keys_of_any_window(spark):
    rng = random.Random(2)
    data = [(rng.choice(["hot", *"abcdefgh", None]), rng.choice([None, *range(20)])) for _ in range(150)]
    start = date(2024, 1, 1)
    day = lambda df: key_days.key_days(df, ["k"], F.date_add(F.lit(start), F.col("d")))
    parts = [spark.createDataFrame(data[k::3], "k string, d int") for k in range(3)]
    pairs = day(parts[0]).cache()
    numbers = key_days.returns(pairs, ["k"])
    for part in parts[1:]:
        numbers, pairs = key_days.added(numbers, pairs, day(part), ["k"])
        numbers, pairs = numbers.cache(), pairs.cache()
    windows = [(a, b) for a in range(0, 20, 3) for b in range(a, 20, 4)]
    asked = spark.createDataFrame([(start + timedelta(days=a), start + timedelta(days=b)) for a, b in windows], "first date, last date")
    got = {(r["first"], r["last"]): r["distinct_keys"] for r in key_days.distinct_keys(numbers, asked).collect()}
    for a, b in windows:
        want = len({k for k, d in data if k is not None and d is not None and a <= d <= b})
        assert got[start + timedelta(days=a), start + timedelta(days=b)] == want
    assert [r[2] for r in key_days.distinct_keys(numbers.where("false"), asked.limit(1)).collect()] == [0]


def test_content_that_fails_a_check_never_becomes_the_table(spark, database, rows, tmp_path):
    table, path = f"{database}.t", str(tmp_path / "files" / "t")
    good = spark.range(1000).withColumn("created_at", F.lit("2024-01-01").cast("timestamp"))
    checks = {"no row without id": F.count_if(F.col("id").isNull()) == 0, "enough rows": F.count(F.lit(1)) >= 1000}
    measures = {"n": F.count(F.lit(1)), "total": F.sum("id")}
    assert write_table(good, table, "created_at", path=path, checks=checks, measures=measures) == {"n": 1000, "total": 499_500}
    bad = good.withColumn("id", F.when(F.col("id") != 7, F.col("id") + 1))
    with pytest.raises(RefusedContent, match="no row without id$"):
        write_table(bad, table, "created_at", path=path, checks=checks)
    with pytest.raises(RefusedContent, match="enough rows"):
        write_table(good.limit(10), table, "created_at", path=path, checks=checks)
    assert spark.table(table).agg(F.sum("id")).first()[0] == 499_500
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect()] == ["t"]
    assert len(list((tmp_path / "files").iterdir())) == 1


def test_old_files_stay_for_one_refresh_and_orphans_go(spark, database, tmp_path):
    table, folder = f"{database}.t", tmp_path / "files"
    write = lambda n: write_table(spark.range(n), table, path=str(folder / "t"))
    write(3)
    reader = spark.table(table)
    (folder / f"t__{'0' * 32}").mkdir()  # left by a run that died
    (folder / "t__other").mkdir()
    write(4)
    assert reader.count() == 3 and spark.table(table).count() == 4
    assert len(list(folder.iterdir())) == 3
    write(5)
    assert spark.table(table).count() == 5 and len(list(folder.iterdir())) == 3


def test_versions_behind_a_name(spark, database, rows):
    name = f"{database}.baseline"
    frame = lambda *ids: spark.createDataFrame([(i, "2024-01-05") for i in ids], "order_id bigint, t string").select("order_id", F.col("t").cast("timestamp").alias("created_at"))
    publish(frame(1), name, "created_at", ["order_id"])
    reader = spark.table(name)
    publish(frame(1, 2), name, "created_at", ["order_id"])
    assert rows(spark.table(name), "order_id") == [(1,), (2,)]
    assert rows(reader, "order_id") == [(1,)]  # planned on the version before
    bad = frame(3).withColumn("order_id", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception, match="boom"):
        publish(bad, name, "created_at", ["order_id"])
    assert rows(spark.table(name), "order_id") == [(1,), (2,)]
    snap = publish_snapshot(frame(4).unionAll(frame(5).withColumn("created_at", F.lit("2023-01-01").cast("timestamp"))), name, "2024-02-01", 90)
    assert rows(snap, "order_id") == [(4,)] and len(versions(spark, name)) == 2
    assert "PartitionFilters: [isnotnull(created_date" in spark.table(name).where("created_date = date'2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        publish(frame(1), name, keep=0)


def test_fact_from_buckets_has_no_exchange(spark, database, rows):
    n = 300
    money = F.col("id").cast("decimal(38,9)")
    types = dict(FCT_ORDERS)
    orders = spark.range(n).select(*[
        (F.concat(F.lit("o"), F.col("id")) if c == "order_id" else F.lit(None).cast(t)).alias(c)
        for c, t in types.items() if c not in ("item_count", "total_quantity", "recommended_item_count")
    ])
    items = spark.range(3 * n).select(*[
        {"order_id": F.concat(F.lit("o"), F.col("id") % 200), "quantity": F.col("id"), "net_amount_local": money}.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
        for f in ITEMS_CLEAN_SCHEMA
    ])
    write_bucketed(orders, f"{database}.o", "order_id", 4)
    write_bucketed(items, f"{database}.i", "order_id", 4)
    fact = gold.fct_orders(spark.table(f"{database}.o"), spark.table(f"{database}.i"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = fact._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in text and "SortMergeJoin" in text
    assert rows(fact) == rows(gold.fct_orders(orders, items))
    write_bucketed(orders.limit(5), f"{database}.o", "order_id", 4)
    assert spark.table(f"{database}.o").count() == 5
