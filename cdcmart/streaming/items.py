"""The items increment as a stream over the landing files.

Arriving events are only appended, one folder per micro-batch, which costs as much as they are large. A compaction merges
all that is pending into the table at once, so a backlog of many batches touches the target one time. In between, a
reader takes the latest version per key over the table and what is pending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.functions.casts import cast_columns
from cdcmart.operators.dedup import SOURCE_TS, latest_by_key, with_source_ts
from cdcmart.operators.upsert import upsert
from cdcmart.operators.windows import on_or_after, partition_column
from cdcmart.session import conf_set, require_utc
from cdcmart.sinks.tables import CODEC, delete_dir, ensure_target, list_dir, read_target
from cdcmart.sinks.upserts import recover, upsert_into
from cdcmart.sources.schemas import ITEMS_CLEAN_SCHEMA, ITEMS_SPEC, landing_schema

SPEC = [*ITEMS_SPEC, (SOURCE_TS, "source_timestamp", "timestamp")]
# Row groups of pending events, and how much of them a task of a compaction takes up: it sorts these rows by key before
# they are shuffled, and as rows they are over ten times as large as in the files.
PENDING_BLOCK = 16 << 20
COMPACTED_TOGETHER = "32m"
TARGET_SCHEMA = T.StructType([*ITEMS_CLEAN_SCHEMA.fields, T.StructField("source_timestamp", T.TimestampType())])


def merge_batch(
    events: DataFrame,
    table: str,
    target_days: int | None = 14,
    tie_breakers: Sequence[str] | None = None,
    unit: str = "day",
) -> None:
    """Merge one batch of raw item events into ``table``.

    The target keeps ``source_timestamp``, so that an event that arrives after a newer one, in a later batch, does
    not overwrite it. Repeating a batch changes nothing, which makes the at-least-once delivery of ``foreachBatch``
    exact.
    """
    spark = require_utc(events.sparkSession)
    if not ensure_target(spark, table, TARGET_SCHEMA, unit):
        recover(spark, table)
    latest = cast_columns(latest_by_key(with_source_ts(events), ["id"], tie_breakers=tie_breakers), SPEC)
    only = None
    if target_days is not None:
        first = events.agg(F.to_date(F.min("created_at")).alias("d")).first()["d"]
        if first is not None:
            target = spark.table(table)
            # Items without a creation time lie in a partition of their own and match in every batch.
            only = on_or_after(target, first, target_days) | F.col(partition_column(target)).isNull()
    upsert_into(
        spark,
        table,
        latest,
        ["order_item_id"],
        target_filter=only,
        newer_by="source_timestamp",
        cluster=["order_id"],
    )


def pending_dir(checkpoint: str) -> str:
    """Where the stream of ``checkpoint`` keeps the events that no compaction has merged yet."""
    return f"{checkpoint.rstrip('/')}__pending"


def append_events(
    spark: SparkSession,
    raw_dir: str,
    checkpoint: str,
    *,
    schema: T.StructType | None = None,
    max_files_per_batch: int | None = None,
) -> None:
    """Take up all landing files that have arrived since the last call, then return.

    A micro-batch is written to the folder of its number, over what an earlier attempt may have left there, so every
    event is pending once however often a batch is repeated.
    """
    reader = spark.readStream.schema(schema or landing_schema("order_items"))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def append(batch: DataFrame, n: int) -> None:
        writer = batch.write.mode("overwrite").option("compression", CODEC).option("parquet.block.size", PENDING_BLOCK)
        writer.parquet(f"{pending_dir(checkpoint)}/batch={n}")

    query = (
        reader.parquet(raw_dir)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def pending_events(spark: SparkSession, checkpoint: str, schema: T.StructType | None = None) -> DataFrame | None:
    """All events that wait for a compaction; None if there are none."""
    folders = list_dir(spark, pending_dir(checkpoint))
    if not folders:
        return None
    return spark.read.schema(schema or landing_schema("order_items")).parquet(*folders)


def current_items(
    spark: SparkSession,
    table: str,
    checkpoint: str,
    *,
    schema: T.StructType | None = None,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The items as of the last event taken up: the latest version per key over the table and the pending events."""
    target = read_target(spark, table, TARGET_SCHEMA)
    events = pending_events(spark, checkpoint, schema)
    if events is None:
        return target.select(*TARGET_SCHEMA.names)
    latest = cast_columns(latest_by_key(with_source_ts(events), ["id"], tie_breakers=tie_breakers), SPEC)
    return upsert(target.select(*TARGET_SCHEMA.names), latest, ["order_item_id"], newer_by="source_timestamp", allow_null_keys=True)


def compact(
    spark: SparkSession,
    table: str,
    checkpoint: str,
    *,
    target_days: int | None = 14,
    schema: T.StructType | None = None,
    tie_breakers: Sequence[str] | None = None,
    unit: str = "day",
) -> int:
    """Merge all pending batches into ``table`` with one merge; returns their number.

    Folders go after the merge. If the driver dies in between, the next compaction merges them again, which changes
    nothing.
    """
    folders = list_dir(spark, pending_dir(checkpoint))
    if folders:
        events = spark.read.schema(schema or landing_schema("order_items")).parquet(*folders)
        with conf_set(spark, spark__sql__files__maxPartitionBytes=COMPACTED_TOGETHER):
            merge_batch(events, table, target_days, tie_breakers, unit)
        for folder in folders:
            delete_dir(spark, folder)
    return len(folders)


def stream_items(
    spark: SparkSession,
    raw_dir: str,
    table: str,
    checkpoint: str,
    *,
    target_days: int | None = 14,
    schema: T.StructType | None = None,
    tie_breakers: Sequence[str] | None = None,
    max_files_per_batch: int | None = None,
    unit: str = "day",
) -> None:
    """Merge all landing files that have arrived since the last call, then return.

    Called every two hours this is the hot path of the items; progress is kept in ``checkpoint``. Partitions of the
    target older than ``target_days`` before the oldest event of the backlog cannot match; None looks at all of them.
    """
    append_events(spark, raw_dir, checkpoint, schema=schema, max_files_per_batch=max_files_per_batch)
    compact(spark, table, checkpoint, target_days=target_days, schema=schema, tie_breakers=tie_breakers, unit=unit)
