"""Silver, gold, jobs, validation, landing load and stream on small hand-made tables."""

import random
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdcmart.operators.upsert import upsert
from cdcmart.operators.windows import max_instant, retro_window
from cdcmart.operators.reconcile import abcd_verdict, parity_report
from cdcmart.plans import gold, jobs, silver, validation
from cdcmart.session import conf_set
from cdcmart.sinks.tables import finish_switch, write_table
from cdcmart.sources.raw import load_raw_csv, read_raw
from cdcmart.sources.schemas import FCT_ORDERS, METADATA, ORDERS_CLEAN, csv_columns, landing_schema
from cdcmart.streaming import items as stream
from cdcmart.streaming.items import append_events, compact, current_items, merge_batch, pending_events, stream_items


def cdc(spark, data, columns):
    """Landing rows from tuples of text whose last column is the source timestamp."""
    df = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))
    source_ts = F.col(columns[-1]).cast("timestamp").alias("source_timestamp")
    return df.select(*columns[:-1], F.struct(source_ts).alias(METADATA))


ITEM_COLUMNS = [
    "id", "order_id", "product_id", "quantity", "unit_price", "net_amount", "default_code", "is_recommended",
    "created_at", "updated_at", "ts",
]


def item(id, created, ts=None, quantity="1", order="o1", product="5", recommended="true"):
    return (id, order, product, quantity, "2.50", "2.50", "SKU-1", recommended, created, created, ts or created)


def items(spark, *data):
    return cdc(spark, list(data), ITEM_COLUMNS)


def store(id, ts, **flags):
    return (id, "n", "BR", "BRL", "America/Sao_Paulo", "true", flags.get("dev"), flags.get("excluded"), "2023-01-01", "2023-01-01", "2023-01-01", ts)


def stores(spark, *data):
    return cdc(spark, list(data), csv_columns("stores")[:-1] + ["ts"])


def order(id, created, ts=None, currency="USD", total="10", status="paid", store="1"):
    return (id, store, "7", currency, total, "1", "9", "app", status, created, created, ts or created)


def orders(spark, *data):
    return cdc(spark, list(data), csv_columns("orders")[:-1] + ["ts"])


def rates(spark, *data):
    return spark.createDataFrame(list(data), "currency_code string, exchange_date string, rate_to_usd string")


def test_store_flags(spark, rows):
    raw = stores(
        spark,
        store("1", "2024-01-01", dev=None, excluded=None),
        store("2", "2024-01-01", dev="false"),
        store("2", "2024-01-02", dev="true"),
        store("3", "2024-01-01", dev="true"),
        store("3", "2024-01-02", dev="false"),
        store("4", "2024-01-01", excluded="True"),
        store("5", "2024-01-01", dev="yes"),
    )
    assert rows(silver.stores_clean(raw), "store_id") == [(1,), (3,), (5,)]


def test_orders_clean_columns_and_missing_rates(spark, rows):
    raw = orders(spark, order("o1", "2024-01-01", currency="BRL"), order("o2", "2024-01-09", currency="BRL"), order("o3", "bad", ts="2024-01-01", total="x"))
    out = silver.orders_clean(raw, rates(spark, ("BRL", "2024-01-01", "0.2")))
    assert out.columns == ORDERS_CLEAN
    assert rows(out, "order_id", "total_price_usd") == [("o1", Decimal("2.000000000")), ("o2", None), ("o3", None)]


def test_items_with_bad_values_are_kept(spark, rows):
    raw = items(spark, item("i1", "2024-01-01", product=""), item("i2", "2024-01-01", quantity="12.5"), item("i3", "2024-01-01", recommended="yes"))
    out = silver.order_items_clean(raw)
    assert rows(out, "order_item_id", "product_id", "quantity", "is_recommended") == [("i1", None, 1, True), ("i2", 5, None, True), ("i3", 5, 1, None)]


def test_late_row_is_kept_by_the_window_and_lost_by_the_naive_filter(spark, rows):
    from cdcmart.operators.windows import naive_window

    target = silver.order_items_clean(items(spark, item("a", "2024-01-10")))
    raw = items(spark, item("a", "2024-01-10"), item("late", "2024-01-08 12:00:00", ts="2024-01-10"), item("old", "2024-01-01"))
    merged = upsert(target, silver.order_items_increment(raw, target), ["order_item_id"])
    assert rows(merged, "order_item_id") == [("a",), ("late",)]
    naive = upsert(target, silver.order_items_clean(naive_window(raw, target)), ["order_item_id"])
    assert rows(naive, "order_item_id") == [("a",)]


def test_null_creation_time_survives_full_mode_only(spark):
    raw = items(spark, item("a", None, ts="2024-01-01"))
    target = silver.order_items_clean(items(spark, item("b", "2024-01-01")))
    assert silver.order_items_clean(raw).count() == 1
    assert silver.order_items_increment(raw, target).count() == 0


def test_window_over_the_arrival_column(spark, rows):
    """An update to an old record is outside a window over its creation, inside one over its arrival."""
    target = silver.order_items_clean(items(spark, item("a", "2024-01-30"), item("b", "2024-01-01")))
    raw = items(spark, item("b", "2024-01-01", ts="2024-01-30", quantity="3"))
    assert silver.order_items_increment(raw, target).count() == 0
    arrived = raw.withColumn("arrived_at", F.col(f"{METADATA}.source_timestamp"))
    bound = 1706572800_000_000
    found = silver.order_items_increment(arrived, None, window_col="arrived_at", high_water=bound)
    assert rows(found, "order_item_id", "quantity") == [("b", 3)]


def test_fact_and_its_window(spark, rows):
    o = silver.orders_clean(orders(spark, order("o1", "2024-01-01"), order("o2", "2024-03-01"), order("o3", "2024-03-01")), rates(spark, ("USD", "2024-03-01", "1")))
    i = silver.order_items_clean(items(spark, item("i1", "2024-03-01", order="o2", quantity="2"), item("i2", "2024-01-05", order="o2"), item("i3", "2024-01-05", order="o1", recommended="")))
    full = gold.fct_orders(o, i)
    assert full.columns == [name for name, _ in FCT_ORDERS]
    counts = ["order_id", "item_count", "total_quantity", "recommended_item_count"]
    assert rows(full, *counts) == [("o1", 1, 1, 0), ("o2", 2, 3, 2), ("o3", 0, 0, 0)]
    assert rows(gold.fct_orders_window(o, i, "2024-03-02"), *counts) == [("o2", 1, 2, 1), ("o3", 0, 0, 0)]


def test_merge_keeps_the_creation_time_of_the_target(spark, rows):
    r = rates(spark)
    items_ = silver.order_items_clean(items(spark))
    old = gold.fct_orders(silver.orders_clean(orders(spark, order("o1", "2024-03-01"), order("far", "2023-01-01")), r), items_)
    new = gold.fct_orders_window(silver.orders_clean(orders(spark, order("o1", "2024-03-02", status="refunded"), order("far", "2024-03-02")), r), items_, "2024-03-03")
    merged = gold.merge_fct_orders(old, new, "2024-03-03").withColumn("d", F.date_format("created_at", "yyyy-MM-dd"))
    assert rows(merged, "order_id", "status", "d") == [("far", "paid", "2023-01-01"), ("far", "paid", "2024-03-02"), ("o1", "refunded", "2024-03-01")]


def test_strict_window_start_makes_the_first_day_look_lost(spark):
    raw = items(spark, item("early", "2024-01-01 06:00:00"), item("b", "2024-03-01"))
    as_of = "2024-03-31 12:00:00"
    a = validation.simulate_incremental(raw, as_of, 90)
    b = validation.simulate_incremental(raw, as_of, 90, whole_days=False)
    assert {r[1] for r in abcd_verdict(a, a, ["order_item_id"]).collect()} == {0}
    assert abcd_verdict(a, b, ["order_item_id"]).first()["failing_rows"] == 1


def day(n, hour=0):
    return (datetime(2024, 1, 1) + timedelta(days=n, hours=hour)).isoformat(sep=" ")


@pytest.mark.parametrize("moving", [False, True])
def test_replay_equals_a_run_for_every_day(spark, rows, moving):
    """The closed form against literal daily runs with merges."""
    rng = random.Random(11 + moving)
    data = []
    for n in range(60):
        key = f"k{rng.randint(0, 14)}"
        created = rng.randint(0, 9) if moving else int(key[1:]) % 10
        data.append(item(key, day(created), ts=day(created + rng.choice([0, 0, 1, 2, 3, 5]), n % 24), quantity=str(n)))
    raw = items(spark, *data).cache()
    window, first, last = 2, 1, 11
    table = silver.order_items_clean(raw.where("false"))
    for d in range(first, last + 1):
        arrived = raw.where(F.col(f"{METADATA}.source_timestamp") < F.lit(day(d + 1)).cast("timestamp"))
        seen = arrived.where(F.col("created_at").cast("timestamp") >= F.lit(day(d - window)).cast("timestamp"))
        table = upsert(table, silver.order_items_clean(seen), ["order_item_id"]).checkpoint()
    replayed = validation.replay_incremental(raw, day(first), day(last), window)
    assert rows(replayed) == rows(table)


def test_replay_equals_the_simulation_when_nothing_is_later_than_the_window(spark, rows):
    raw = items(spark, *[item(f"k{n % 9}", day(n % 5), ts=day(n % 5 + n % 3, n), quantity=str(n)) for n in range(30)])
    replayed = validation.replay_incremental(raw, day(0), day(12), 7)
    assert rows(replayed) == rows(validation.simulate_incremental(raw, day(12), 90))


@pytest.mark.parametrize("cap", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_to_target_equals_a_job_that_looks_at_its_target(spark, rows, cap, seed):
    """A feed with a gap of ten days, late events, rows dated in the future and rows without a creation time."""
    rng = random.Random(seed)
    data = []
    for n in range(90):
        created = rng.choice([k for k in range(30) if not 8 <= k < 18])
        key = f"k{created}-{rng.randint(0, 2)}"
        data.append(item(key, day(created), ts=day(created + rng.choice([0, 0, 1, 2, 4, 9, 12]), n % 24), quantity=str(n)))
    data += [item("none", None, ts=day(1), quantity="7"), item("none", None, ts=day(9), quantity="8")]
    if cap:
        data.append(item("future", day(400), ts=day(3)))
    raw = items(spark, *data).cache()
    window, first, last = 3, 2, 33
    table = silver.order_items_clean(raw.where("false"))
    for d in range(first, last + 1):
        arrived = raw.where(F.col(f"{METADATA}.source_timestamp") < F.lit(day(d + 1)).cast("timestamp"))
        top = max_instant(table)
        source = arrived if top is None else retro_window(arrived, high_water=top, days=window, cap=day(d + 1) if cap else None)
        table = upsert(table, silver.order_items_clean(source), ["order_item_id"]).checkpoint()
    replayed = validation.replay_to_target(raw, day(first), day(last), window, cap_future=cap)
    assert rows(replayed) == rows(table)
    # Counted from the day of the run, the window after the gap would be another one.
    if not cap:
        assert rows(replayed) != rows(validation.replay_incremental(raw, day(first), day(last), window))


def test_replay_to_target_of_nothing(spark):
    raw = items(spark, item("a", "2024-01-05"))
    assert validation.replay_to_target(raw.where("false"), "2024-01-01", "2024-01-09").count() == 0
    assert validation.replay_to_target(raw, "2024-01-01", "2024-01-09").count() == 1
    assert validation.replay_to_target(raw, "2024-01-01", "2024-01-04").count() == 0
    assert validation.replay_to_target(raw, "2024-01-09", "2024-01-01").count() == 0


def test_csv_landing_files(spark, rows, tmp_path):
    path = tmp_path / "orders"
    path.mkdir()
    header = ",".join(csv_columns("orders"))
    lines = [
        "o1,1,7,BRL,10.50,0.50,10.00,app,paid,2024-01-01T10:00:00+00:00,2024-01-01T10:00:00+00:00,2024-01-01T10:00:00.123456+00:00",
        "o1,1,7,BRL,10.50,0.50,10.00,app,refunded,2024-01-01T10:00:00+00:00,2024-01-01T10:00:00+00:00,2024-01-01T12:00:00+00:00",
        "o2,,7,BRL,abc,,1,app,paid,junk,,",
    ]
    (path / "a.csv").write_text("\n".join([header, *lines]) + "\n")
    raw = load_raw_csv(spark, str(path), "orders")
    assert raw.schema[METADATA].dataType["source_timestamp"].dataType.typeName() == "timestamp"
    assert raw.count() == 3
    out = silver.latest_orders(raw)
    assert rows(out, "order_id", "status", "total_price_local") == [("o1", "refunded", Decimal("10.500000000"))]
    assert read_raw(spark, str(path), "orders", "csv").count() == 3


def test_csv_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "rates.csv").write_text("exchange_date,currency_code,rate_to_usd\n2024-01-01,BRL,0.2\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_raw_csv(spark, str(tmp_path / "rates.csv"), "currency_exchange_rates").collect()


def test_parquet_scan_reads_only_what_is_used(spark, tmp_path):
    path = str(tmp_path / "items")
    spark.createDataFrame([], landing_schema("order_items")).write.parquet(path)
    df = read_raw(spark, path, "order_items").where(F.col("created_at") > F.lit("2024-01-01").cast("timestamp")).select("id")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(created_at" in text and "net_amount" not in text


def config(spark, database, *, items_=(), orders_=()):
    raw = {
        "orders": orders(spark, *orders_),
        "order_items": items(spark, *items_),
        "stores": stores(spark, store("1", "2024-01-01")),
        "currency_exchange_rates": rates(spark, ("USD", "2024-03-01", "1"), ("USD", "2024-03-08", "1")),
    }
    return jobs.MartConfig(raw, silver=database, gold=database)


def test_jobs_agree_on_recent_orders(spark, database, rows):
    first = {"orders_": [order("o1", "2024-03-01")], "items_": [item("i1", "2024-03-01")]}
    later = {
        "orders_": [*first["orders_"], order("o1", "2024-03-01", ts="2024-03-08", status="refunded"), order("o2", "2024-03-08")],
        "items_": [*first["items_"], item("late", "2024-03-03", ts="2024-03-08", order="o1"), item("i2", "2024-03-08", order="o2", quantity="4")],
    }
    jobs.refresh_incremental(spark, config(spark, database, **first), "2024-03-02")
    cfg = config(spark, database, **later)
    tables = jobs.refresh_incremental(spark, cfg, "2024-03-09")
    merged = tables["fct_orders_incremental_merge"]
    expected = [("o1", "refunded", 2), ("o2", "paid", 1)]
    assert rows(merged, "order_id", "status", "item_count") == expected
    # The same run again changes nothing.
    jobs.refresh_incremental(spark, cfg, "2024-03-09")
    assert rows(spark.table(f"{database}.fct_orders_incremental_merge"), "order_id", "status", "item_count") == expected

    full = jobs.refresh_full(spark, cfg, "2024-03-09")["fct_orders"]
    drift = parity_report(full, spark.table(f"{database}.fct_orders_incremental_merge"), ["order_id"], "all")
    assert {r["failing_rows"] for r in drift.collect()} == {0}
    assert spark.table(f"{database}.dim_stores").first()["region"] == "LATAM"


def test_full_refresh_repairs_rows_later_than_the_window(spark, database, rows):
    first = [item("i1", "2024-03-20")]
    jobs.refresh_incremental(spark, config(spark, database, items_=first), "2024-03-20")
    cfg = config(spark, database, items_=[*first, item("very_late", "2024-03-01", ts="2024-03-21")])
    jobs.refresh_incremental(spark, cfg, "2024-03-21")
    assert rows(spark.table(f"{database}.order_items_clean"), "order_item_id") == [("i1",)]
    jobs.refresh_full(spark, cfg, "2024-03-21")
    assert rows(spark.table(f"{database}.order_items_clean"), "order_item_id") == [("i1",), ("very_late",)]


def test_job_warns_when_the_source_window_reaches_behind_the_target_window(spark, database):
    cfg = config(spark, database, items_=[item("i1", "2024-01-01")])
    jobs.refresh_incremental(spark, cfg, "2024-01-01")
    with pytest.warns(UserWarning, match="inserted again"):
        jobs.refresh_incremental(spark, cfg, "2024-03-01")


def typed_items(spark, *data):
    raw = items(spark, *data)
    return raw.select(*[F.col(f.name).cast(f.dataType) for f in landing_schema("order_items")])


def test_stream_merges_files_and_goes_on_where_it_stopped(spark, database, rows, tmp_path):
    landing, checkpoint, table = str(tmp_path / "in"), str(tmp_path / "cp"), f"{database}.items"
    typed_items(spark, item("a", "2024-01-01", quantity="1"), item("a", "2024-01-01", ts="2024-01-02", quantity="2")).write.parquet(landing)
    stream_items(spark, landing, table, checkpoint)
    assert rows(spark.table(table), "order_item_id", "quantity") == [("a", 2)]
    # An older event that arrives later must not win; a newer one must.
    typed_items(spark, item("a", "2024-01-01", ts="2024-01-01 12:00:00", quantity="9"), item("b", "2024-01-03")).write.mode("append").parquet(landing)
    stream_items(spark, landing, table, checkpoint)
    assert rows(spark.table(table), "order_item_id", "quantity") == [("a", 2), ("b", 1)]
    stream_items(spark, landing, table, checkpoint)
    assert spark.table(table).count() == 2


def test_backlog_is_merged_once_and_read_before_it_is(spark, database, rows, tmp_path, monkeypatch):
    landing, checkpoint, table = str(tmp_path / "in"), str(tmp_path / "cp"), f"{database}.items"
    options = {"schema": landing_schema("order_items")}
    deliveries = [
        [item("a", "2024-01-01", quantity="1"), item("b", "2024-01-01", quantity="2")],
        [item("a", "2024-01-01", ts="2024-01-03", quantity="3")],
        [item("a", "2024-01-01", ts="2024-01-02", quantity="4"), item("c", "2024-01-02", quantity="5")],
    ]
    for d in [*deliveries, deliveries[0]]:
        typed_items(spark, *d).coalesce(1).write.mode("append").parquet(landing)
    append_events(spark, landing, checkpoint, max_files_per_batch=1, **options)
    assert not spark.catalog.tableExists(table) and pending_events(spark, checkpoint).count() == 7
    want = [("a", 3), ("b", 2), ("c", 5)]
    assert rows(current_items(spark, table, checkpoint), "order_item_id", "quantity") == want
    merges = []
    monkeypatch.setattr(stream, "merge_batch", lambda *a: merges.append(merge_batch(*a)))
    # A compaction whose driver dies before the folders go is repeated without harm.
    monkeypatch.setattr(stream, "delete_dir", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        compact(spark, table, checkpoint)
    monkeypatch.undo()
    monkeypatch.setattr(stream, "merge_batch", lambda *a: merges.append(merge_batch(*a)))
    assert rows(current_items(spark, table, checkpoint), "order_item_id", "quantity") == want
    assert compact(spark, table, checkpoint) == 4 and len(merges) == 2
    assert rows(spark.table(table), "order_item_id", "quantity") == want
    assert compact(spark, table, checkpoint) == 0 and pending_events(spark, checkpoint) is None
    assert rows(current_items(spark, table, checkpoint), "order_item_id", "quantity") == want


def test_repeated_batch_changes_nothing(spark, database, rows):
    batch = typed_items(spark, item("a", "2024-01-01"), item("b", "2024-01-02"))
    for _ in range(2):
        merge_batch(batch, f"{database}.items", target_days=None)
        assert rows(spark.table(f"{database}.items"), "order_item_id") == [("a",), ("b",)]


def test_redelivery_changes_nothing_for_items_without_creation_time(spark, database, rows):
    batch = typed_items(spark, item("a", "2024-01-01"), item("b", "2024-01-02"), item("c", "2024-01-03"))
    batch = batch.withColumn("created_at", F.when(F.col("id") != "b", F.col("created_at")))
    for _ in range(3):
        merge_batch(batch, f"{database}.items")
        assert rows(spark.table(f"{database}.items"), "order_item_id") == [("a",), ("b",), ("c",)]


def test_other_zones_are_refused(spark, database):
    batch = typed_items(spark, item("a", "2024-01-01"))
    with conf_set(spark, spark__sql__session__timeZone="America/Los_Angeles"):
        for act in (
            lambda: merge_batch(batch, f"{database}.items"),
            lambda: jobs.refresh_full(spark, config(spark, database, items_=[item("a", "2024-01-01")]), "2024-01-02"),
            lambda: jobs.refresh_incremental(spark, config(spark, database, items_=[item("a", "2024-01-01")]), "2024-01-02"),
        ):
            with pytest.raises(ValueError, match="must be UTC"):
                act()


def test_failed_refresh_leaves_the_table(spark, database, rows):
    table = f"{database}.t"
    good = spark.range(3).withColumn("created_at", F.lit("2024-01-01").cast("timestamp"))
    write_table(good, table, "created_at")
    bad = good.withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("boom")).cast("bigint")).otherwise(F.col("id") + 10))
    with pytest.raises(Exception, match="boom"):
        write_table(bad, table, "created_at")
    assert rows(spark.table(table), "id") == [(0,), (1,), (2,)]
    write_table(good.where("id > 0"), table, "created_at")
    assert rows(spark.table(table), "id") == [(1,), (2,)]
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect()] == ["t"]
    # A run that died between the two renames is repaired by the next one.
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__previous")
    finish_switch(spark, table)
    assert rows(spark.table(table), "id") == [(1,), (2,)]


def test_widened_target_updates_after_an_outage(spark, database, rows):
    first = [item("i1", "2024-01-01", quantity="1")]
    jobs.refresh_incremental(spark, config(spark, database, items_=first), "2024-01-01")
    cfg = config(spark, database, items_=[*first, item("i1", "2024-01-01", ts="2024-02-28", quantity="5")])
    jobs.refresh_incremental(spark, replace(cfg, widen_target=True), "2024-03-01")
    assert rows(spark.table(f"{database}.order_items_clean"), "order_item_id", "quantity") == [("i1", 5)]


def test_a_future_row_does_not_move_the_window_of_the_job(spark, database, rows):
    first = [item("i1", "2024-01-01"), item("future", "2030-01-01")]
    cfg = replace(config(spark, database, items_=first), cap_future=True)
    jobs.refresh_incremental(spark, cfg, "2024-01-01")
    cfg = replace(config(spark, database, items_=[*first, item("i2", "2024-01-02")]), cap_future=True)
    jobs.refresh_incremental(spark, cfg, "2024-01-02")
    assert rows(spark.table(f"{database}.order_items_clean"), "order_item_id") == [("future",), ("i1",), ("i2",)]
