"""Named queries over the sample tables, one per operator of the library."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.functions.casts import NUMERIC, cast_columns, safe_cast
from cdcmart.functions.labels import day_part, local_hour, region_of, store_age_days, store_maturity
from cdcmart.functions.times import instant_lit
from cdcmart.operators import key_days, lag_states, quality, reconcile, windows
from cdcmart.operators.dedup import SOURCE_TS, latest_by_key, with_source_ts
from cdcmart.operators.rates import convert_to_usd, one_rate_per_key
from cdcmart.operators.rollup import item_rollup, rollup_changed, rollup_changes, rollup_of, rollup_state
from cdcmart.operators.upsert import matches, merge_images, upsert, upsert_files
from cdcmart.plans import gold, jobs, silver, validation
from cdcmart.samples import views
from cdcmart.samples.views import AS_OF, ITEM_TIES
from cdcmart.session import fresh_dir, shuffles_removed, use_result_conf
from cdcmart.sinks.tables import delete_dir, publish_snapshot, snapshot, write_bucketed, write_table
from cdcmart.sources.raw import load_raw_csv, read_raw
from cdcmart.sources.schemas import ITEMS_CLEAN_SCHEMA, ITEMS_SPEC, METADATA, csv_columns, landing_schema
from cdcmart.streaming.items import stream_items

Query = Callable[[SparkSession, str], DataFrame]

# The feed up to this moment makes the earlier state that the upsert queries start from.
CUT = "2001-06-01 00:00:00"
FACT_FIELDS = ("store_id", "customer_id", "channel", "status", "total_price_usd", "item_count", "total_quantity")
ITEM_KEY = ["order_item_id"]
# First day without events of the feed of replay_target_window, and the first day with events again.
OUTAGE = ("1998-03-01", "1998-03-11")
BUCKETS = 8
# Tables between the steps of a query are written and read once or twice: small ones cost less.
SCRATCH_CODEC = "zstd"
# Sets of files that the stream query lands one after the other, most files of each, and the size of their row groups:
# a micro-batch takes up a number of files, and as many tasks share it as these have row groups.
DELIVERIES = 3
DELIVERY_FILES = 8
DELIVERY_BLOCK = 16 << 20


def _until(raw: DataFrame, moment: str) -> DataFrame:
    return raw.where(F.col(SOURCE_TS) <= F.lit(moment).cast("timestamp"))


def _landed_items(spark: SparkSession, sf: str) -> DataFrame:
    """The item events as a written table, for queries that read them several times: they are joined only once."""
    return _stored(views.raw_order_items(spark, sf))


def _items(spark: SparkSession, sf: str, raw: DataFrame | None = None) -> DataFrame:
    return silver.order_items_clean(views.raw_order_items(spark, sf) if raw is None else raw, ITEM_TIES)


def _items_before(spark: SparkSession, sf: str, raw: DataFrame | None = None) -> DataFrame:
    return silver.order_items_clean(_until(views.raw_order_items(spark, sf) if raw is None else raw, CUT), ITEM_TIES)


def _stored(df: DataFrame) -> DataFrame:
    """``df`` as a written table: the target of a merge is never a view on the raw events."""
    path = fresh_dir(df.sparkSession, "stored")
    df.write.option("compression", SCRATCH_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _items_target(spark: SparkSession, sf: str, raw: DataFrame | None = None) -> DataFrame:
    return _stored(_items_before(spark, sf, raw))


def _increment(spark: SparkSession, sf: str, target: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    return silver.order_items_increment(views.raw_order_items(spark, sf) if raw is None else raw, target, 7, ITEM_TIES)


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return silver.orders_clean(views.raw_orders(spark, sf), views.raw_rates(spark, sf))


def _stores(spark: SparkSession, sf: str) -> DataFrame:
    return silver.stores_clean(views.raw_stores(spark, sf))


def safe_casts(spark: SparkSession, sf: str) -> DataFrame:
    part, shipped = F.col("l_partkey"), F.col("l_shipdate")
    texts = [
        F.lit(""),
        F.lit("12.5"),
        F.lit("abc"),
        F.lit("yes"),
        F.lit("TRUE"),
        part.cast("string"),
        F.date_format(shipped, "yyyy-MM-dd"),
        F.date_format(shipped, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    ]
    t = F.col("as_text")
    messy = views.table(spark, sf, "lineitem").withColumn("as_text", F.get(F.array(*texts), (part % 8).cast("int")))
    return messy.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "as_text",
        safe_cast(t, "bigint").alias("as_long"),
        safe_cast(t, NUMERIC).alias("as_money"),
        safe_cast(t, "boolean").alias("as_flag"),
        safe_cast(t, "timestamp").alias("as_moment"),
        safe_cast(t, "date").alias("as_day"),
        safe_cast(F.col("l_extendedprice") / 8, "bigint").alias("rounded"),
        safe_cast(F.col("l_suppkey") + F.lit(0.4999999999), "bigint").alias("below_half"),
        safe_cast(F.col("l_suppkey").cast("decimal(20,0)") + F.lit("0.49999999999999").cast("decimal(14,14)"), "bigint").alias("below_half_wide"),
    )


def latest_orders(spark: SparkSession, sf: str) -> DataFrame:
    return silver.latest_orders(views.raw_orders(spark, sf))


def _latest_raw_items(raw: DataFrame, keys: list[str]) -> DataFrame:
    latest = latest_by_key(with_source_ts(raw), keys, tie_breakers=ITEM_TIES)
    return latest.select(
        *keys, "order_id", "product_id", "quantity", "net_amount", "created_at", F.col(SOURCE_TS).alias("source_ts")
    )


def latest_items(spark: SparkSession, sf: str) -> DataFrame:
    return _latest_raw_items(views.raw_order_items(spark, sf), ["id"])


def latest_items_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """Composite key: the same id from different source systems is a different item."""
    raw = views.raw_order_items(spark, sf).withColumn("source_system", F.col("supp_key") % 3)
    return _latest_raw_items(raw, ["id", "source_system"])


def usd_conversion(spark: SparkSession, sf: str) -> DataFrame:
    orders = silver.latest_orders(views.raw_orders(spark, sf))
    usd = convert_to_usd(orders, views.raw_rates(spark, sf), silver.MONEY)
    return usd.where(F.col("total_price_usd").isNotNull()).select(
        "order_id", "currency_code", "total_price_local", "total_price_usd", "discount_usd", "net_amount_usd"
    )


def usd_conversion_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts above 10^14 at rates far below and above those that plain decimals multiply exactly."""
    k = F.col("o_orderkey")
    whole = (k % 9973 + 1).cast("decimal(10,0)") * F.lit(10**13).cast("decimal(14,0)")
    part = F.col("o_custkey").cast("decimal(10,0)") * F.lit("0.000000001").cast("decimal(10,9)")
    orders = views.table(spark, sf, "orders").select(
        k.alias("order_id"),
        views.pick(["TINY", "VAST", "LEAST"], (k % 3).cast("int")).alias("currency_code"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        (whole + part).cast(NUMERIC).alias("amount"),
    )
    rates = {"TINY": "0.0000000004", "VAST": "250000001", "LEAST": "0.000000000007"}
    entry = F.explode(F.array(*[F.struct(F.lit(c).alias("currency_code"), F.lit(r).alias("rate_to_usd")) for c, r in rates.items()]))
    days = orders.select(F.to_date("created_at").alias("exchange_date")).distinct()
    usd = convert_to_usd(orders, days.select("exchange_date", entry.alias("e")).select("exchange_date", "e.*"), {"amount": "usd"})
    text = F.split(F.col("usd").cast("string"), "[.]")
    return usd.select("order_id", "currency_code", text[0].alias("usd_whole"), text[1].cast("bigint").alias("usd_fraction"))


def usd_missing_rate(spark: SparkSession, sf: str) -> DataFrame:
    missing = _orders(spark, sf).where(F.col("total_price_usd").isNull())
    return missing.groupBy("currency_code").agg(
        F.count(F.lit(1)).alias("orders_without_rate"), F.sum("total_price_local").alias("total_price_local")
    )


def day_parts(spark: SparkSession, sf: str) -> DataFrame:
    ts, tz = F.col("ts"), F.col("tz")
    return views.raw_events(spark, sf).select(
        "event_id", local_hour(ts, tz).alias("local_hour"), day_part(ts, tz).alias("day_part")
    )


def region(spark: SparkSession, sf: str) -> DataFrame:
    stores = views.raw_stores(spark, sf).select("id", "country_code").distinct()
    return stores.groupBy(region_of(F.col("country_code")).alias("region")).agg(F.count(F.lit(1)).alias("stores"))


def maturity(spark: SparkSession, sf: str) -> DataFrame:
    opened = F.col("opening_date")
    return latest_by_key(views.raw_stores(spark, sf), ["id"]).select(
        F.col("id").alias("store_id"),
        "opening_date",
        store_age_days(opened, AS_OF).cast("bigint").alias("store_age_days"),
        store_maturity(opened, AS_OF).alias("store_maturity"),
    )


def dim_stores(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_stores(_stores(spark, sf), AS_OF)


def item_rollups(spark: SparkSession, sf: str) -> DataFrame:
    return item_rollup(_items(spark, sf))


def item_rollup_30d(spark: SparkSession, sf: str) -> DataFrame:
    return item_rollup(_items(spark, sf), AS_OF, 30)


def item_rollup_by_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """The rollup of the items before a merge, kept up by what the merge changes."""
    raw = _landed_items(spark, sf)
    target = _items_target(spark, sf, raw)
    state = _stored(rollup_state(target))
    increment = _stored(_increment(spark, sf, target, raw))
    matched = _stored(matches(target, increment, ITEM_KEY))
    before, after = merge_images(target, increment, matched, ITEM_KEY)
    return rollup_of(rollup_changed(state, rollup_changes(before, after)))


def fct_orders(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fct_orders(_orders(spark, sf), _items(spark, sf))


def fct_orders_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The fact from tables that are bucketed on the order, joined and grouped without a shuffle."""
    database = _database(spark, "bucketed")
    write_bucketed(_orders(spark, sf), f"{database}.orders_clean", "order_id", BUCKETS)
    write_bucketed(_items(spark, sf), f"{database}.order_items_clean", "order_id", BUCKETS)
    return gold.fct_orders(spark.table(f"{database}.orders_clean"), spark.table(f"{database}.order_items_clean"))


def fct_orders_window(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fct_orders_window(_orders(spark, sf), _items(spark, sf), AS_OF)


def retro_window(spark: SparkSession, sf: str) -> DataFrame:
    return _increment(spark, sf, _items_before(spark, sf))


def retro_window_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """The increment by moment of arrival: late updates to old items are seen as well."""
    raw = views.raw_order_items(spark, sf).withColumn("arrived_at", F.col(SOURCE_TS))
    target = _items_target(spark, sf)
    return silver.order_items_increment(raw, target, 7, ITEM_TIES, window_col="arrived_at", target_col="created_at")


def naive_window_loss(spark: SparkSession, sf: str) -> DataFrame:
    """Items the retroactive window brings in and a filter on the target's maximum loses."""
    raw = _landed_items(spark, sf)
    target = _items_target(spark, sf, raw)
    fresh = windows.naive_window(raw, target)
    after = upsert(target, _stored(silver.order_items_clean(fresh, ITEM_TIES)), ITEM_KEY)
    return reconcile.only_in(_increment(spark, sf, target, raw), after, ITEM_KEY)


def items_upsert(spark: SparkSession, sf: str, target: DataFrame | None = None, raw: DataFrame | None = None) -> DataFrame:
    raw = _landed_items(spark, sf) if raw is None else raw
    target = _items_target(spark, sf, raw) if target is None else target
    return upsert_files(target, _increment(spark, sf, target, raw), ITEM_KEY)


def items_upsert_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The same increment merged a second time changes nothing."""
    raw = _landed_items(spark, sf)
    target = _items_target(spark, sf, raw)
    increment = _stored(_increment(spark, sf, target, raw))
    return upsert_files(_stored(upsert(target, increment, ITEM_KEY)), increment, ITEM_KEY)


def _merged_fct_orders(orders: DataFrame, items: DataFrame, items_before: DataFrame) -> DataFrame:
    """The fact of an earlier state after the merge of the window."""
    until = instant_lit(AS_OF, 10)
    before = gold.fct_orders(orders.where(F.col("created_at") <= until), items_before)
    return gold.merge_fct_orders(_stored(before), gold.fct_orders_window(orders, items, AS_OF), AS_OF, merge=upsert_files)


def fct_orders_merge(spark: SparkSession, sf: str) -> DataFrame:
    raw = _landed_items(spark, sf)
    return _merged_fct_orders(_stored(_orders(spark, sf)), _items(spark, sf, raw), _items_before(spark, sf, raw))


def _baseline(spark: SparkSession, sf: str, raw: DataFrame | None = None) -> DataFrame:
    """The baseline as written files, as it is used in practice."""
    return snapshot(_items(spark, sf, raw), fresh_dir(spark, "baseline"), AS_OF, 90)


def baseline_profile(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.profile(_baseline(spark, sf), "order_item_id", "created_at", "net_amount_local")


def baseline_named(spark: SparkSession, sf: str) -> DataFrame:
    """The baseline behind a name of the catalog, taken a second time a month later, and read by that name."""
    name = f"{_database(spark, 'baseline')}.items_baseline"
    publish_snapshot(_items_before(spark, sf), name, CUT, 90)
    publish_snapshot(_items(spark, sf), name, AS_OF, 90)
    return reconcile.profile(spark.table(name), "order_item_id", "created_at", "net_amount_local")


def simulate_incremental(spark: SparkSession, sf: str, total_days: int = 90) -> DataFrame:
    return validation.simulate_incremental(views.raw_order_items(spark, sf), AS_OF, total_days, ITEM_TIES)


def rows_lost(spark: SparkSession, sf: str) -> DataFrame:
    """C for a simulation that is 30 days too short."""
    baseline = windows.since_date(_items(spark, sf), AS_OF, 90)
    return reconcile.only_in(baseline, simulate_incremental(spark, sf, 60), ITEM_KEY)


def rows_added(spark: SparkSession, sf: str) -> DataFrame:
    """D of the table after an increment against the table before it."""
    raw = _landed_items(spark, sf)
    before = _items_target(spark, sf, raw)
    return reconcile.only_in(items_upsert(spark, sf, before, raw), before, ITEM_KEY)


def abcd_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.abcd_verdict(_baseline(spark, sf), simulate_incremental(spark, sf), ITEM_KEY)


def abcd_verdict_short_window(spark: SparkSession, sf: str) -> DataFrame:
    """The verdict on an incremental table that has missed late rows."""
    raw = _landed_items(spark, sf)
    return reconcile.abcd_verdict(_items(spark, sf, raw), items_upsert(spark, sf, raw=raw), ITEM_KEY)


def field_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.diverging(_items(spark, sf), _items_before(spark, sf), ITEM_KEY)


def field_divergence_events(spark: SparkSession, sf: str) -> DataFrame:
    """Divergence between two event tables whose keys repeat on both sides."""
    raw = _landed_items(spark, sf)
    even = F.col("supp_key") % 2 == 0
    return reconcile.diverging(raw.where(even), raw.where(~even), ["id"], ["product_id", "is_recommended"])


def parity_report(spark: SparkSession, sf: str) -> DataFrame:
    raw = _landed_items(spark, sf)
    return reconcile.parity_report(_baseline(spark, sf, raw), items_upsert(spark, sf, raw=raw), ITEM_KEY)


def drift_full_vs_incremental(spark: SparkSession, sf: str) -> DataFrame:
    raw, orders = _landed_items(spark, sf), _stored(_orders(spark, sf))
    items = _stored(_items(spark, sf, raw))
    full = _stored(gold.fct_orders(orders, items))
    merged = _merged_fct_orders(orders, items, _items_before(spark, sf, raw))
    return reconcile.parity_report(full, merged, ["order_id"], FACT_FIELDS)


def lag_profile(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.lag_profile(views.raw_order_items(spark, sf))


def lag_profile_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles from states per day, those of late events merged in, and whether they are as near as promised."""
    raw = views.raw_order_items(spark, sf)
    late = F.col("supp_key") % 5 == 0
    states = lag_states.merged_states(_stored(lag_states.lag_states(raw.where(~late))), lag_states.lag_states(raw.where(late)))
    profile = lag_states.lag_profile_merged(_stored(states), [0.0, 0.5, 0.9, 0.99, 1.0])
    exact = F.when(F.col("quantile").isin(0.0, 1.0), F.col("lag_seconds")).alias("exact_lag")
    return lag_states.rank_within(raw, profile).select("quantile", "rows", exact, "within")


def distinct_keys_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct items with events in each month, from numbers per day; a fifth of the events is taken up later."""
    raw = views.raw_order_items(spark, sf)
    late, day = F.col("supp_key") % 5 == 0, F.to_date(F.col(SOURCE_TS))
    pairs = _stored(key_days.key_days(raw.where(~late), ["id"], day))
    numbers = _stored(key_days.returns(pairs, ["id"]))
    numbers = _stored(key_days.added(numbers, pairs, key_days.key_days(raw.where(late), ["id"], day), ["id"])[0])
    months = numbers.select(F.trunc("day", "month").alias("first"), F.last_day("day").alias("last")).distinct()
    return key_days.distinct_keys(numbers, months)


def assert_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.assert_unique(views.raw_order_items(spark, sf), ["id"])


def assert_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.assert_not_null(_items(spark, sf), ["order_item_id", "order_id", "product_id", "created_at"])


def assert_ref(spark: SparkSession, sf: str) -> DataFrame:
    return quality.assert_ref(_orders(spark, sf), "store_id", _stores(spark, sf), "store_id")


def _csv(events: DataFrame, table: str) -> DataFrame:
    """``events`` written as landing files with a dotted header, and loaded."""
    path = fresh_dir(events.sparkSession, "landing")
    flat = events.withColumn(f"{METADATA}.source_timestamp", F.col(SOURCE_TS)) if METADATA in events.columns else events
    flat.select(*[F.col(f"`{c}`") for c in csv_columns(table)]).write.csv(path, header=True)
    return load_raw_csv(events.sparkSession, path, table)


def nested_csv_load(spark: SparkSession, sf: str) -> DataFrame:
    """Order events loaded from text and brought to their latest version."""
    return silver.latest_orders(_csv(views.raw_orders(spark, sf), "orders"))


def csv_load_items(spark: SparkSession, sf: str) -> DataFrame:
    """All item events, typed from text."""
    events = views.raw_order_items(spark, sf).withColumn("quantity", F.col("quantity").cast("bigint"))
    return cast_columns(_csv(events, "order_items"), [*ITEMS_SPEC, (SOURCE_TS, "source_ts", "timestamp")])


def csv_load_stores(spark: SparkSession, sf: str) -> DataFrame:
    return silver.stores_clean(_csv(views.raw_stores(spark, sf), "stores"))


def csv_load_rates(spark: SparkSession, sf: str) -> DataFrame:
    return one_rate_per_key(_csv(views.raw_rates(spark, sf), "currency_exchange_rates"))


def raw_parquet_load(spark: SparkSession, sf: str) -> DataFrame:
    """Order events as typed landing files, scanned with their explicit schema."""
    path = fresh_dir(spark, "landing")
    raw = views.raw_orders(spark, sf)
    raw.select(*[F.col(f.name).cast(f.dataType) for f in landing_schema("orders")]).write.parquet(path)
    return silver.latest_orders(read_raw(spark, path, "orders"))


def _typed(events: DataFrame, table: str) -> DataFrame:
    """``events`` as typed landing files, scanned with their explicit schema."""
    path = fresh_dir(events.sparkSession, "landing")
    events.select(*[F.col(f.name).try_cast(f.dataType) for f in landing_schema(table)]).write.parquet(path)
    return read_raw(events.sparkSession, path, table)


def raw_parquet_items(spark: SparkSession, sf: str) -> DataFrame:
    events = _typed(views.raw_order_items(spark, sf), "order_items")
    return cast_columns(events, [*ITEMS_SPEC, (SOURCE_TS, "source_ts", "timestamp")])


def raw_parquet_stores(spark: SparkSession, sf: str) -> DataFrame:
    return silver.stores_clean(_typed(views.raw_stores(spark, sf), "stores"))


def raw_parquet_rates(spark: SparkSession, sf: str) -> DataFrame:
    return one_rate_per_key(_typed(views.raw_rates(spark, sf), "currency_exchange_rates"))


def _database(spark: SparkSession, name: str) -> str:
    """A database of its own for one run of a query that writes tables."""
    path = fresh_dir(spark, name)
    database = f"{name}_{path.rsplit('/', 1)[1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    return database


def partitioned_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written with partitions and clustered files, read back for one year."""
    table = f"{_database(spark, 'sink')}.orders_clean"
    write_table(_orders(spark, sf), table, "created_at", ["store_id", "customer_id"], unit="month")
    year = windows.since_date(spark.table(table), AS_OF, 365)
    return year.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("net_amount_usd").alias("net_amount_usd")
    )


def checked_sink(spark: SparkSession, sf: str) -> DataFrame:
    """What the checks of a written table have seen of it on the way, beside what is in it."""
    table = f"{_database(spark, 'checked')}.orders_clean"
    measured = write_table(
        _orders(spark, sf),
        table,
        "created_at",
        ["store_id"],
        unit="month",
        checks={"every order has a key": F.count_if(F.col("order_id").isNull()) == 0, "some orders": F.count(F.lit(1)) > 0},
        measures={
            "rows_seen": F.count(F.lit(1)),
            "without_rate": F.count_if(F.col("total_price_usd").isNull()),
            "net_amount_usd": F.sum("net_amount_usd"),
        },
    )
    seen = spark.createDataFrame([tuple(measured.values())], "rows_seen bigint, without_rate bigint, net_amount_usd decimal(38,9)")
    written = spark.table(table).agg(F.count(F.lit(1)).alias("rows_written"))
    return seen.join(written, F.lit(True))  # one row each


def replay_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return validation.replay_incremental(
        views.raw_order_items(spark, sf), "1995-01-01", AS_OF, window_days=7, tie_breakers=ITEM_TIES
    )


def replay_target_window(spark: SparkSession, sf: str) -> DataFrame:
    """A daily job over years, whose feed stood still for ten days: nothing was created, late events came afterwards."""
    first, behind = (F.lit(day).cast("timestamp") for day in OUTAGE)
    created, ts = F.col("created_at"), F.col(SOURCE_TS)
    raw = views.raw_order_items(spark, sf).where((created < first) | (created >= behind))
    feed = raw.withColumn(METADATA, F.struct(F.when((ts >= first) & (ts < behind), behind).otherwise(ts).alias("source_timestamp")))
    return validation.replay_to_target(feed, "1995-01-01", AS_OF, window_days=7, tie_breakers=ITEM_TIES)


def _deliver(raw: DataFrame, landing: str) -> None:
    """Land all events in ``DELIVERIES`` sets of files, one after the other, and then all of these again.

    The events are put together once and dealt to the deliveries on the way, not once for every delivery."""
    dealt = fresh_dir(raw.sparkSession, "deliveries")
    events = raw.withColumn("delivery", F.pmod(F.xxhash64("id", SOURCE_TS), F.lit(DELIVERIES)))
    with shuffles_removed(raw.sparkSession):
        events.write.option("compression", SCRATCH_CODEC).partitionBy("delivery").parquet(dealt)
    events = raw.sparkSession.read.schema(events.schema).parquet(dealt)
    for n in [*range(DELIVERIES), *range(DELIVERIES)]:
        files = events.where(F.col("delivery") == n).drop("delivery").coalesce(DELIVERY_FILES)
        files.write.mode("append").option("compression", SCRATCH_CODEC).option("parquet.block.size", DELIVERY_BLOCK).parquet(landing)
    delete_dir(raw.sparkSession, dealt)


def stream_item_files(spark: SparkSession, sf: str) -> DataFrame:
    """All item events as a stream of deliveries, each of them twice, merged into one table.

    Events of an item are spread over the deliveries, so older ones arrive after newer ones; some lack their creation
    time."""
    database = _database(spark, "stream")
    landing, checkpoint = fresh_dir(spark, "stream_landing"), fresh_dir(spark, "stream_checkpoint")
    raw = views.raw_order_items(spark, sf)
    raw = raw.withColumn("created_at", F.when(F.col("part_key") % 97 > 0, F.col("created_at")))
    _deliver(raw, landing)
    table = f"{database}.order_items_clean"
    stream_items(
        spark,
        landing,
        table,
        checkpoint,
        schema=raw.schema,
        tie_breakers=ITEM_TIES,
        max_files_per_batch=2,
        unit="month",
    )
    delete_dir(spark, landing)
    return spark.table(table).select(
        "order_item_id", "order_id", "product_id", "quantity", "net_amount_local", "created_at"
    )


def _mart(
    spark: SparkSession, sf: str, database: str, moment: str | None = None, items: DataFrame | None = None
) -> jobs.MartConfig:
    raw = {
        "orders": views.raw_orders(spark, sf),
        "order_items": views.raw_order_items(spark, sf) if items is None else items,
        "stores": views.raw_stores(spark, sf),
    }
    if moment is not None:
        raw = {name: _until(df, moment) if name != "stores" else df for name, df in raw.items()}
    raw["currency_exchange_rates"] = views.raw_rates(spark, sf)
    return jobs.MartConfig(raw, silver=database, gold=database, tie_breakers={"order_items": ITEM_TIES}, partition_unit="month")


def refresh_full(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _mart(spark, sf, _database(spark, "full"))
    return jobs.refresh_full(spark, cfg, AS_OF)["fct_orders"].select(*gold.FCT_COLUMNS)


def refresh_by_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the items increment by moment of arrival, with the future capped and a target window of five days,
    which is widened to the seven of the source window."""
    database, landed = _database(spark, "arrival"), _landed_items(spark, sf)
    for moment, as_of in ((CUT, CUT), (None, AS_OF)):
        cfg = _mart(spark, sf, database, moment, landed)
        raw = {**cfg.raw, "order_items": cfg.raw["order_items"].withColumn("arrived_at", F.col(SOURCE_TS))}
        cfg = replace(cfg, raw=raw, items_window_col="arrived_at", items_target_days=5, cap_future=True, widen_target=True)
        items = jobs.refresh_items_increment(spark, cfg, as_of)
    return items.select(*ITEMS_CLEAN_SCHEMA.names)


def refresh_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the hot path: one on the feed up to CUT, one on the whole feed."""
    database, landed = _database(spark, "incremental"), _landed_items(spark, sf)
    jobs.refresh_incremental(spark, _mart(spark, sf, database, CUT, landed), CUT)
    tables = jobs.refresh_incremental(spark, _mart(spark, sf, database, None, landed), AS_OF)
    return tables["fct_orders_incremental_merge"].select(*gold.FCT_COLUMNS)


QUERIES: dict[str, Query] = {
    "safe_casts": safe_casts,
    "latest_orders": latest_orders,
    "latest_items": latest_items,
    "latest_items_by_source": latest_items_by_source,
    "usd_conversion": usd_conversion,
    "usd_conversion_wide": usd_conversion_wide,
    "usd_missing_rate": usd_missing_rate,
    "day_part": day_parts,
    "region": region,
    "store_maturity": maturity,
    "orders_clean": _orders,
    "order_items_clean": _items,
    "stores_clean": _stores,
    "dim_stores": dim_stores,
    "item_rollup": item_rollups,
    "item_rollup_30d": item_rollup_30d,
    "fct_orders": fct_orders,
    "item_rollup_by_deltas": item_rollup_by_deltas,
    "fct_orders_bucketed": fct_orders_bucketed,
    "fct_orders_window": fct_orders_window,
    "retro_window": retro_window,
    "retro_window_arrival": retro_window_arrival,
    "naive_window_loss": naive_window_loss,
    "items_upsert": items_upsert,
    "items_upsert_twice": items_upsert_twice,
    "fct_orders_merge": fct_orders_merge,
    "baseline_profile": baseline_profile,
    "baseline_named": baseline_named,
    "simulate_incremental": simulate_incremental,
    "rows_lost": rows_lost,
    "rows_added": rows_added,
    "abcd_verdict": abcd_verdict,
    "abcd_verdict_short_window": abcd_verdict_short_window,
    "field_divergence": field_divergence,
    "field_divergence_events": field_divergence_events,
    "parity_report": parity_report,
    "drift_full_vs_incremental": drift_full_vs_incremental,
    "lag_profile": lag_profile,
    "lag_profile_merged": lag_profile_merged,
    "distinct_keys_by_day": distinct_keys_by_day,
    "assert_unique": assert_unique,
    "assert_not_null": assert_not_null,
    "assert_ref": assert_ref,
    "nested_csv_load": nested_csv_load,
    "csv_load_items": csv_load_items,
    "csv_load_stores": csv_load_stores,
    "csv_load_rates": csv_load_rates,
    "raw_parquet_load": raw_parquet_load,
    "raw_parquet_items": raw_parquet_items,
    "raw_parquet_stores": raw_parquet_stores,
    "raw_parquet_rates": raw_parquet_rates,
    "checked_sink": checked_sink,
    "partitioned_sink": partitioned_sink,
    "replay_incremental": replay_incremental,
    "replay_target_window": replay_target_window,
    "stream_items": stream_item_files,
    "refresh_full": refresh_full,
    "refresh_incremental": refresh_incremental,
    "refresh_by_arrival": refresh_by_arrival,
}


def comparable(df: DataFrame) -> DataFrame:
    """Moments as zone-less timestamps, so that collecting them does not depend on the zone of the machine."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else f"`{f.name}`"
            for f in df.schema
        ]
    )


def prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(query(use_result_conf(spark), sf_dir))

    run.__doc__ = query.__doc__
    return run
