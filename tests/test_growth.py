"""Work of the sample queries that must not grow faster than their tables."""

from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cdcmart.samples import queries, views

ITEMS = 60


@pytest.fixture
def sf(spark, tmp_path):
    """Tables of a few orders and items of their own; every third item has a second event, some orders lie late."""
    days = [datetime(2001, 5 if k < 40 else 7, 1 + k % 28) for k in range(ITEMS)]
    orders = [(k, k % 7, "O", 10.5 + k, day) for k, day in enumerate(days)]
    lines = [(k, 1, k * 7, k % 5, 3, 20.25 + k, day) for k, day in enumerate(days)]
    lines += [(k, 1, k * 9 + 1, k % 5, 4, 30.25 + k, day) for k, day in enumerate(days) if k % 3 == 0]
    spark.createDataFrame(
        orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        lines,
        "l_orderkey bigint, l_linenumber bigint, l_partkey bigint, l_suppkey bigint, l_quantity bigint, "
        "l_extendedprice double, l_shipdate timestamp_ntz",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, f"store {k}", k % 5) for k in range(5)], "s_suppkey bigint, s_name string, s_nationkey bigint").write.parquet(
        f"{tmp_path}/supplier.parquet"
    )
    return str(tmp_path)


class Landed(Exception):
    pass


def test_deliveries_of_the_stream_are_few_files(spark, sf, monkeypatch):
    """A micro-batch takes up a fixed number of files, so their number must not follow the tasks that wrote them."""
    raw, seen = views.raw_order_items, {}

    def stop(_, landing, *args, **options):
        seen["files"] = len(list(Path(landing.removeprefix("file:")).glob("*.parquet")))
        seen["events"] = spark.read.parquet(landing).groupBy("id", "part_key").count().collect()
        raise Landed

    monkeypatch.setattr(views, "raw_order_items", lambda *args: raw(*args).repartition(40))
    monkeypatch.setattr(queries, "stream_items", stop)
    with pytest.raises(Landed):
        queries.stream_item_files(spark, sf)
    assert seen["files"] <= 2 * 3 * 8
    assert Counter(r["count"] for r in seen["events"]) == {2: ITEMS + ITEMS // 3}


@pytest.mark.parametrize(
    "name",
    [
        "naive_window_loss",
        "parity_report",
        "abcd_verdict_short_window",
        "refresh_incremental",
        "field_divergence_events",
        "rows_added",
        "items_upsert_twice",
        "drift_full_vs_incremental",
    ],
)
def test_events_are_joined_once(spark, sf, monkeypatch, name):
    """Queries that need the item events several times put them together a single time."""
    read, reads = views.table, Counter()

    def table(spark, sf, name):
        reads[name] += 1
        return read(spark, sf, name)

    monkeypatch.setattr(views, "table", table)
    queries.QUERIES[name](spark, sf).collect()
    assert reads["lineitem"] == 1


def test_rows_outside_the_matched_range_are_copied(spark, tmp_path, rows):
    """A merge joins only target rows from the range of the matched ones; rows without a moment are joined as well."""
    from cdcmart.operators.upsert import FILE, matches, upsert, upsert_files, upsert_located

    cols = "id bigint, v string, created_at timestamp"
    moments = [None, *(datetime(2001, 1, d) for d in range(1, 21))]
    spark.createDataFrame([(i, f"old {i}", m) for i, m in enumerate(moments)], cols).coalesce(1).write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    new = spark.createDataFrame([(0, "n", None), (18, "n", moments[3]), (19, "n", moments[19]), (99, "n", moments[1])], cols)
    assert rows(upsert_files(target, new, ["id"])) == rows(upsert(target, new, ["id"]))
    matched = matches(target, new, ["id"], also=["created_at"])
    files = matched.select(FILE).distinct()
    merged = upsert_located(target, new, ["id"], matched, files=files, range_col="created_at")
    assert rows(merged) == rows(upsert(target, new, ["id"]))
    none = new.where(F.col("id") == 0)
    assert rows(upsert_files(target, none, ["id"])) == rows(upsert(target, none, ["id"]))


def test_tables_are_written_small(spark, sf, database):
    """Tables of the jobs are compressed by more than the default."""
    import pyarrow.parquet as pq

    from cdcmart.sinks.tables import write_table

    write_table(spark.range(9).withColumn("created_at", F.lit("2001-01-01").cast("timestamp")), f"{database}.t", "created_at")
    files = [f.removeprefix("file://") for f in spark.table(f"{database}.t").inputFiles()]
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def _codecs(folder):
    import pyarrow.parquet as pq

    files = [f for f in Path(folder.removeprefix("file:")).rglob("*.parquet")]
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}


def test_the_stream_keeps_little_on_disk(spark, sf, monkeypatch):
    """Events that have landed or wait for a compaction are written small; what they were dealt from has gone by then."""
    from cdcmart.streaming import items

    merge, seen = items.merge_batch, {}

    def stop(_, landing, table, checkpoint, **options):
        folder = Path(landing.removeprefix("file:"))
        seen["landed"], seen["dealt"] = _codecs(landing), [*(folder.parents[1] / "deliveries").rglob("*.parquet")]
        monkeypatch.setattr(items, "merge_batch", lambda *args: seen.update(pending=_codecs(items.pending_dir(checkpoint))) or merge(*args))
        return items.stream_items(spark, landing, table, checkpoint, **options)

    monkeypatch.setattr(queries, "stream_items", stop)
    assert queries.stream_item_files(spark, sf).count() == ITEMS
    assert seen == {"landed": {"ZSTD"}, "pending": {"ZSTD"}, "dealt": []}


def test_a_merge_keeps_only_what_apply_reads(spark, database, monkeypatch):
    """Files of its shuffles go with each step, and its inputs before the table is written."""
    import time

    from cdcmart.sinks import upserts

    files = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    apply, seen = upserts.apply_staged, {}

    def record(spark_, table, staging):
        seen["staged"] = {f.name for f in Path(staging.removeprefix("file:")).iterdir()}
        apply(spark_, table, staging)

    monkeypatch.setattr(upserts, "apply_staged", record)
    source = spark.range(50).selectExpr("id as k", "id as v", "timestamp'2001-01-01' as created_at").repartition(4, "k")
    before = files()
    upserts.upsert_into(spark, f"{database}.t", source, ["k"])
    for _ in range(20):
        if files() <= before:
            break
        time.sleep(0.5)
    assert files() <= before
    assert seen["staged"] == {"content", "affected"}
    assert spark.table(f"{database}.t").count() == 50
