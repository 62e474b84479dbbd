from datetime import date

import pytest
from pyspark.sql import functions as F

from cdcmart.operators.windows import on_or_after, since
from cdcmart.sinks import upserts
from cdcmart.sinks.tables import ensure_target, high_water, partition_values, read_target, snapshot, write_table
from cdcmart.sinks.upserts import pending, recover, stage_upsert, upsert_into

SCHEMA = "k string, v int, t string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).select("k", "v", F.col("t").cast("timestamp").alias("created_at"))


def content(df):
    cols = ["k", "v", F.date_format("created_at", "yyyy-MM-dd")]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("unit", ["day", "month"])
def test_write_table_partitions_and_prunes(spark, database, unit):
    df = frame(spark, [("a", 1, "2024-01-01 05:00:00"), ("b", 2, "2024-01-20"), ("c", 3, "2024-02-02"), ("d", 4, None)])
    name = f"{database}.t"
    write_table(df, name, "created_at", ["v"], unit=unit)
    assert content(spark.table(name)) == content(df)
    expected = ["2024-01-01", "2024-01-20", "2024-02-02"] if unit == "day" else ["2024-01-01", "2024-02-01"]
    assert partition_values(spark, name) == expected
    recent = since(spark.table(name), "2024-02-03", 3)
    assert [r["k"] for r in recent.collect()] == ["c"]
    filters = plan(recent).split("PartitionFilters: [")[1].split("]")[0]
    assert f"created_{'date' if unit == 'day' else 'month'}" in filters
    # A full refresh replaces everything, partitions that no longer occur included.
    write_table(df.where("k = 'b'"), name, "created_at", ["v"], unit=unit)
    assert content(spark.table(name)) == [("b", 2, "2024-01-20")]


def test_hot_date_is_written_by_several_tasks(spark, database):
    df = spark.range(0, 200_000, numPartitions=8).select(
        "id", F.sha2(F.col("id").cast("string"), 512).alias("text"),
        F.when(F.col("id") % 3 > 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("timestamp").alias("created_at"),
    )
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        write_table(df, f"{database}.t", "created_at", ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = spark.table(f"{database}.t").where("created_date = date'2024-01-01'").select(F.input_file_name()).distinct().count()
    assert files > 1
    assert spark.table(f"{database}.t").count() == 200_000


def test_high_water_reads_one_partition(spark, database):
    name = f"{database}.t"
    ensure_target(spark, name, frame(spark, []).schema)
    assert high_water(spark, name) is None
    write_table(frame(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-03 07:00:00"), ("c", 1, None)]), name, "created_at")
    assert high_water(spark, name) == 1704265200_000_000


def test_read_target_before_the_first_run(spark, database):
    schema = frame(spark, []).schema
    assert read_target(spark, f"{database}.none", schema).count() == 0
    assert ensure_target(spark, f"{database}.t", schema) is True
    assert ensure_target(spark, f"{database}.t", schema) is False
    assert spark.table(f"{database}.t").columns == ["k", "v", "created_at", "created_date"]


def test_snapshot_keeps_whole_first_day_and_does_not_move(spark, tmp_path):
    df = frame(spark, [("a", 1, "2024-01-01 01:00:00"), ("b", 2, "2023-12-31 23:00:00"), ("c", 3, "2024-03-01")])
    kept = snapshot(df, str(tmp_path / "s"), "2024-03-31 12:00:00", 90, cluster=["k"])
    assert [r[0] for r in content(kept)] == ["a", "c"]


def test_upsert_into_creates_updates_and_is_idempotent(spark, database):
    name = f"{database}.t"
    upsert_into(spark, name, frame(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")]), ["k"])
    change = frame(spark, [("b", 2, "2024-01-02"), ("c", 2, "2024-01-03")])
    for _ in range(2):
        upsert_into(spark, name, change, ["k"])
        assert content(spark.table(name)) == [("a", 1, "2024-01-01"), ("b", 2, "2024-01-02"), ("c", 2, "2024-01-03")]
    upsert_into(spark, name, change.where("false"), ["k"])
    assert spark.table(name).count() == 3


def test_untouched_dates_are_not_rewritten(spark, database):
    name = f"{database}.t"
    upsert_into(spark, name, frame(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")]), ["k"])
    files = spark.table(name).where("created_date = date'2024-01-01'").select(F.input_file_name()).first()[0]
    upsert_into(spark, name, frame(spark, [("b", 2, "2024-01-02")]), ["k"])
    assert spark.table(name).where("created_date = date'2024-01-01'").select(F.input_file_name()).first()[0] == files


def test_key_that_moves_to_another_date_leaves_no_copy(spark, database):
    name = f"{database}.t"
    upsert_into(spark, name, frame(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")]), ["k"])
    upsert_into(spark, name, frame(spark, [("a", 2, "2024-01-05")]), ["k"])
    assert content(spark.table(name)) == [("a", 2, "2024-01-05"), ("b", 1, "2024-01-02")]
    upsert_into(spark, name, frame(spark, [("a", 3, None)]), ["k"])
    assert content(spark.table(name)) == [("a", 3, None), ("b", 1, "2024-01-02")]
    upsert_into(spark, name, frame(spark, [("a", 4, "2024-01-02")]), ["k"])
    assert content(spark.table(name)) == [("a", 4, "2024-01-02"), ("b", 1, "2024-01-02")]


def test_created_at_outside_the_update_list_keeps_the_partition(spark, database):
    name = f"{database}.t"
    upsert_into(spark, name, frame(spark, [("a", 1, "2024-01-01")]), ["k"])
    upsert_into(spark, name, frame(spark, [("a", 2, "2024-01-05")]), ["k"], update_cols=["v"])
    assert content(spark.table(name)) == [("a", 2, "2024-01-01")]
    assert [r[0] for r in spark.table(name).select("created_date").collect()] == [date(2024, 1, 1)]


@pytest.mark.parametrize("unit", ["day", "month"])
def test_target_filter_reinserts_old_keys(spark, database, unit):
    name = f"{database}.t"
    upsert_into(spark, name, frame(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-20")]), ["k"], unit=unit)
    only = on_or_after(spark.table(name), "2024-01-25", 10)
    upsert_into(spark, name, frame(spark, [("a", 2, "2024-01-24"), ("b", 2, "2024-01-24")]), ["k"], target_filter=only)
    assert content(spark.table(name)) == [("a", 1, "2024-01-01"), ("a", 2, "2024-01-24"), ("b", 2, "2024-01-24")]


def test_crash_inside_apply_is_repaired_by_the_next_run(spark, database, monkeypatch):
    name = f"{database}.t"
    upsert_into(spark, name, frame(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02")]), ["k"])

    def die_after_drop(spark_, table, staging):
        spark_.sql(f"ALTER TABLE {table} DROP PARTITION (created_date='2024-01-01')")
        raise RuntimeError("lost driver")

    monkeypatch.setattr(upserts, "apply_staged", die_after_drop)
    with pytest.raises(RuntimeError):
        upsert_into(spark, name, frame(spark, [("a", 2, "2024-01-05")]), ["k"])
    monkeypatch.undo()
    assert pending(spark, name) is not None
    assert content(spark.table(name)) == [("b", 1, "2024-01-02")]

    upsert_into(spark, name, frame(spark, [("c", 9, "2024-01-09")]), ["k"])
    assert content(spark.table(name)) == [("a", 2, "2024-01-05"), ("b", 1, "2024-01-02"), ("c", 9, "2024-01-09")]
    assert pending(spark, name) is None


def test_crash_after_overwrite_is_repaired_without_duplicates(spark, database, monkeypatch):
    name = f"{database}.t"
    upsert_into(spark, name, frame(spark, [("a", 1, "2024-01-01")]), ["k"])
    real = upserts.apply_staged

    def die_before_clearing(*args):
        real(*args)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(upserts, "apply_staged", die_before_clearing)
    with pytest.raises(RuntimeError):
        upsert_into(spark, name, frame(spark, [("a", 2, "2024-01-05")]), ["k"])
    monkeypatch.undo()
    assert recover(spark, name) is True
    assert recover(spark, name) is False
    assert content(spark.table(name)) == [("a", 2, "2024-01-05")]


def test_crash_while_staging_changes_nothing(spark, database):
    name = f"{database}.t"
    upsert_into(spark, name, frame(spark, [("a", 1, "2024-01-01")]), ["k"])
    stage_upsert(spark, name, frame(spark, [("a", 2, "2024-01-05")]), ["k"])
    assert recover(spark, name) is False
    assert content(spark.table(name)) == [("a", 1, "2024-01-01")]


def test_duplicate_source_leaves_the_table_alone(spark, database):
    name = f"{database}.t"
    upsert_into(spark, name, frame(spark, [("a", 1, "2024-01-01")]), ["k"])
    with pytest.raises(Exception, match="several rows"):
        upsert_into(spark, name, frame(spark, [("a", 2, "2024-01-01"), ("a", 3, "2024-01-01")]), ["k"])
    assert content(spark.table(name)) == [("a", 1, "2024-01-01")] and pending(spark, name) is None
