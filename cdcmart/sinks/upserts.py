"""Upsert into a Parquet table partitioned on its creation time.

Parquet has no MERGE, so the partitions that change are rewritten, and only those:

1. *Stage.* The source is written to the shared folder, then the complete new content of the affected partitions
   (those of matched target rows and of incoming rows). Last of all, the table property ``cdcmart.pending`` is set.
2. *Apply.* Affected partitions without any staged row are dropped - a key may have moved away from a date and left
   it empty, which an overwrite of the other partitions would not notice - and the others are overwritten.
3. *Clear* the property and delete what was staged.

Apply only replaces whole partitions by fixed content, so it can be repeated. A run that finds the property set, left by
one that died inside apply, repeats apply first. One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdcmart.operators.upsert import FILE, has_moment, matches, upsert_located
from cdcmart.operators.windows import partition_column, partition_value
from cdcmart.session import conf_set, require_utc, shared_dir, shuffles_removed
from cdcmart.sinks.tables import delete_dir, ensure_target, laid_out

PENDING = "cdcmart.pending"


def _in_partitions(column: str, values: Sequence[date | None]) -> Column:
    known = [v for v in values if v is not None]
    cond = F.col(column).isin(known) if known else F.lit(False)
    return cond | F.col(column).isNull() if None in values else cond


def _values(df: DataFrame, column: str) -> list[date | None]:
    # One row per calendar day at most, so collecting is bounded.
    return [row[0] for row in df.select(column).distinct().collect()]


def _written(df: DataFrame, path: str, schema: StructType | None = None) -> DataFrame:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def pending(spark: SparkSession, table: str) -> str | None:
    """Staging folder of an apply that was begun and not finished."""
    for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect():
        if row[0] == PENDING:
            return row[1]
    return None


def apply_staged(spark: SparkSession, table: str, staging: str) -> None:
    """Replace the affected partitions by their staged content; safe to repeat."""
    target = spark.table(table)
    column = partition_column(target)
    affected = _values(spark.read.schema(f"`{column}` date").parquet(f"{staging}/affected"), column)
    staged = spark.read.schema(target.schema).parquet(f"{staging}/content")
    emptied = set(affected) - set(_values(staged, column))
    if emptied:
        values = ["null" if day is None else f"'{day.isoformat()}'" for day in emptied]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({column}={v})" for v in values))
    with conf_set(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        staged.select(*target.columns).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def recover(spark: SparkSession, table: str) -> bool:
    """Finish an apply that died. True if there was one."""
    staging = pending(spark, table)
    if staging is None:
        return False
    apply_staged(spark, table, staging)
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}')")
    delete_dir(spark, staging)
    return True


def stage_upsert(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    *,
    target_filter: Column | None = None,
    update_cols: Sequence[str] | None = None,
    newer_by: str | None = None,
    allow_null_keys: bool = False,
    partition_ts: str = "created_at",
    cluster: Sequence[str] = (),
) -> str | None:
    """Step 1; returns the staging folder, or None when the source is empty and nothing changes."""
    target = spark.table(table)
    column = partition_column(target)
    staging = shared_dir(spark, f"staging/{table}")

    # The source is typically a deduplicated window of raw events: written once, it is read several times below.
    incoming = source.withColumn(column, partition_value(column, partition_ts)).select(*target.columns)
    incoming = _written(incoming, f"{staging}/source", target.schema)

    # The one look at the keys of the target: it gives the partitions to rewrite, the places of the rows to update and
    # what is to be inserted.
    ranged = has_moment(target, partition_ts) and partition_ts not in keys
    also = [column, partition_ts] if ranged else [column]
    matched = _written(matches(target, incoming, keys, target_filter, also=also), f"{staging}/matched")
    files = _written(matched.select(FILE).distinct(), f"{staging}/files")
    affected = _values(matched.select(column).unionByName(incoming.select(column)), column)
    if not affected:
        return None

    touched = target.where(_in_partitions(column, affected))
    content = upsert_located(
        touched,
        incoming,
        keys,
        matched,
        range_col=partition_ts if ranged else None,
        files=files,
        # The partition follows the creation time, so it is updated exactly if that is.
        update_cols=update_cols if update_cols is None or partition_ts not in update_cols else [*update_cols, column],
        newer_by=newer_by,
        allow_null_keys=allow_null_keys,
    )
    laid_out(content, column, cluster).write.mode("overwrite").option("compression", "zstd").parquet(f"{staging}/content")
    listed = spark.createDataFrame([(d,) for d in affected], f"`{column}` date")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{staging}/affected")
    for used in ("source", "matched", "files"):  # apply reads none of them
        delete_dir(spark, f"{staging}/{used}")
    return staging


def upsert_into(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    target_filter: Column | None = None,
    update_cols: Sequence[str] | None = None,
    unit: str = "day",
    **options,
) -> None:
    """Merge ``source`` into the catalog table ``table``, created from the source's schema if absent.

    Columns and options are those of ``operators.upsert.upsert``; see there for what matches and what is updated. A
    ``target_filter`` on the partition column keeps the match to those partitions.
    """
    require_utc(spark)
    if not ensure_target(spark, table, source.schema, unit):
        # Another session may have written since this one last looked at the table's files.
        spark.catalog.refreshTable(table)
        recover(spark, table)
    with shuffles_removed(spark):
        staging = stage_upsert(
            spark, table, source, keys, target_filter=target_filter, update_cols=update_cols, **options
        )
    if staging is None:
        delete_dir(spark, shared_dir(spark, f"staging/{table}"))
        return
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PENDING}'='{staging}')")
    recover(spark, table)
