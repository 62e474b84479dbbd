"""Tables on Parquet: day partitions, clustered files, snapshots."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.functions.times import AsOf
from cdcmart.operators.windows import PARTITION_BY, partition_column, partition_value, since_date
from cdcmart.session import require_utc


# Tables are read more often than written, and smaller files are less to write and to move.
CODEC = "zstd"


class RefusedContent(ValueError):
    """New content of a table that fails one of its checks."""


def with_partition(df: DataFrame, ts: str = "created_at", unit: str = "day") -> DataFrame:
    column = PARTITION_BY[unit]
    return df.withColumn(column, partition_value(column, ts))


def laid_out(df: DataFrame, partition: str | None, cluster: Sequence[str]) -> DataFrame:
    """Arrange rows for writing: by partition value, sorted by the cluster columns within every file.

    A rebalance, not a plain repartition: adaptive execution splits a date that holds much of the table into several
    writers and packs small dates together, where hashing on the date would give the hot date to one task. The sort
    makes the row groups of a file narrow in the cluster columns, so that their statistics prune.
    """
    order = [*([partition] if partition else []), *cluster]
    arranged = df.hint("rebalance", partition) if partition else df.hint("rebalance")
    return arranged.sortWithinPartitions(*order) if order else arranged


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def _default_location(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    return f"{spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{name}"


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def delete_dir(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Folders right below ``path``, sorted; none if it does not exist."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    return sorted(f.getPath().toString() for f in files.listStatus(folder) if f.isDirectory())


def _plain(path: str) -> str:
    # file:/x, file:///x and /x are one folder.
    return re.sub(r"^file:/*", "/", path).rstrip("/")


def _sweep(spark: SparkSession, base: str, kept: Sequence[str]) -> None:
    """Delete the locations made for the table at ``base``, but for those in ``kept``: versions that no reader of the
    current one can still be on, and what a run that died has left."""
    parent, _, name = base.rpartition("/")
    version = re.compile(re.escape(name) + "__[0-9a-f]{32}$")
    wanted = {_plain(k) for k in kept}
    for folder in list_dir(spark, parent):
        if version.match(folder.rpartition("/")[2]) and _plain(folder) not in wanted:
            delete_dir(spark, folder)


def finish_switch(spark: SparkSession, table: str) -> None:
    """Repair after a run that died between the two renames of ``write_table``."""
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(f"{table}__previous"):
        spark.sql(f"ALTER TABLE {table}__previous RENAME TO {table}")


def write_table(
    df: DataFrame,
    table: str,
    partition_ts: str | None = None,
    cluster: Sequence[str] = (),
    path: str | None = None,
    unit: str = "day",
    checks: Mapping[str, Column] | None = None,
    measures: Mapping[str, Column] | None = None,
) -> dict[str, object]:
    """Full refresh: replace the catalog table ``table`` with ``df``, partitioned on the date of ``partition_ts``.

    The new content is written to a location of its own, below ``path`` or the database, under the name
    ``table__next``; only a complete table takes the name over, by two renames in the catalog. A failed write leaves
    the old table as it was, and readers meet no gap while a new one is written. The old files stay until the next
    refresh, for queries that were planned on them.

    ``checks`` are conditions on aggregates of the new content, by name, and ``measures`` aggregates of it, which are
    returned. Both are observed while the rows are written, in the same pass. If a check does not hold, the table is
    not switched and ``RefusedContent`` is raised; what was written is deleted.
    """
    spark = require_utc(df.sparkSession)
    out = with_partition(df, partition_ts, unit) if partition_ts else df
    partition = PARTITION_BY[unit] if partition_ts else None
    finish_switch(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}__next")
    base = (path or _default_location(spark, table)).rstrip("/")
    location = f"{base}__{uuid.uuid4().hex}"
    arranged, observed = laid_out(out, partition, cluster), None
    if checks or measures:
        # Behind the last shuffle, where only tasks that have succeeded report.
        observed = Observation()
        wanted = {**(checks or {}), **(measures or {})}
        arranged = arranged.observe(observed, *[c.alias(name) for name, c in wanted.items()])
    writer = arranged.write.format("parquet").option("compression", CODEC).option("path", location)
    if partition:
        writer = writer.partitionBy(partition)
    writer.saveAsTable(f"{table}__next")
    seen = observed.get if observed else {}
    failed = [name for name in checks or () if seen[name] is not True]
    if failed:
        spark.sql(f"DROP TABLE {table}__next")
        delete_dir(spark, location)
        raise RefusedContent(f"{table} is left as it was; its new content fails: {', '.join(failed)}")
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE IF EXISTS {table}__previous")
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}__previous")
    spark.sql(f"ALTER TABLE {table}__next RENAME TO {table}")
    old = []
    if spark.catalog.tableExists(f"{table}__previous"):
        old = [_location(spark, f"{table}__previous")]
        spark.sql(f"DROP TABLE {table}__previous")
    _sweep(spark, base, [location, *old])
    spark.catalog.refreshTable(table)
    return {name: seen[name] for name in measures or ()}


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Replace the catalog table ``table`` by ``df``, dealt into ``buckets`` files sorted by ``key``.

    Tables with the same number of buckets on the same key are joined and grouped by it without a shuffle. A bucket is
    read by one task, so this is for keys of which none holds a large share of the rows; the number of buckets should
    give each some hundred megabytes.
    """
    require_utc(df.sparkSession)
    dealt = df.repartition(buckets, key)  # as the buckets are, so that each is written by one task as one file
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)


def read_target(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The table's own current content, empty before the first run."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], schema)


def ensure_target(spark: SparkSession, table: str, schema: T.StructType, unit: str = "day") -> bool:
    """Create the partitioned table if it is absent, with exactly ``schema``. True if it was created."""
    if spark.catalog.tableExists(table):
        return False
    partition = PARTITION_BY[unit]
    fields = [f for f in schema.fields if f.name != partition]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, `{partition}` date) "
        f"USING parquet OPTIONS (compression '{CODEC}') PARTITIONED BY (`{partition}`)"
    )
    return True


def partition_values(spark: SparkSession, table: str) -> list[str]:
    """Partition values from the catalog, as ISO text; reads no data."""
    names = [row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return sorted(n for n in names if n != "__HIVE_DEFAULT_PARTITION__")


def high_water(spark: SparkSession, table: str, ts: str = "created_at") -> int | None:
    """Largest ``ts`` of a date-partitioned table in epoch microseconds, reading only its newest partition.

    The partition column is derived from ``ts``, so the newest moment lies in the newest partition that has rows.
    """
    df = spark.table(table)
    partition = F.col(partition_column(df))
    for day in reversed(partition_values(spark, table)):
        top = df.where(partition == F.lit(day).cast("date")).agg(F.unix_micros(F.max(ts)).alias("m")).first()["m"]
        if top is not None:
            return top
    return None


def versions(spark: SparkSession, name: str) -> list[str]:
    """Tables that hold the versions of ``name``, oldest first."""
    database, _, short = name.rpartition(".")
    where = f" IN {database}" if database else ""
    pattern = re.compile(re.escape(short.lower()) + r"__v\d{6}$")
    names = [row["tableName"] for row in spark.sql(f"SHOW TABLES{where}").collect()]
    return [f"{database}.{n}" if database else n for n in sorted(names) if pattern.match(n)]


def publish(
    df: DataFrame, name: str, partition_ts: str | None = None, cluster: Sequence[str] = (), unit: str = "day", keep: int = 2
) -> str:
    """Replace what ``name`` stands for by ``df``, in one statement, and return the table that now holds it.

    Every version is a table of its own, ``name__v000001`` and so on, and ``name`` is a view on one of them. The view
    is replaced only when the new version is complete, so a reader by name gets the old content or the new, never
    none; a query that runs on an older version goes on, as ``keep`` versions stay, the new one included. A version
    that a failed run has left unfinished is not on view and its number is not used again before it is dropped.
    """
    spark = require_utc(df.sparkSession)
    if keep < 1:
        raise ValueError("the current version is always kept")
    before = versions(spark, name)
    table = f"{name}__v{int(before[-1][-6:]) + 1 if before else 1:06d}"
    out = with_partition(df, partition_ts, unit) if partition_ts else df
    partition = PARTITION_BY[unit] if partition_ts else None
    location = f"{_default_location(spark, name).rstrip('/')}__{uuid.uuid4().hex}"
    writer = laid_out(out, partition, cluster).write.format("parquet").option("compression", CODEC).option("path", location)
    (writer.partitionBy(partition) if partition else writer).saveAsTable(table)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")
    for old in [*before, table][:-keep]:
        files = _location(spark, old)
        spark.sql(f"DROP TABLE {old}")
        delete_dir(spark, files)
    return table


def publish_snapshot(
    df: DataFrame, name: str, as_of: AsOf, window_days: int = 90, ts: str = "created_at", cluster: Sequence[str] = ("order_id",), keep: int = 2
) -> DataFrame:
    """``snapshot`` under a name of the catalog: the last ``window_days`` days of ``df`` as the new version of ``name``."""
    publish(since_date(df, as_of, window_days, ts), name, ts, cluster, keep=keep)
    return df.sparkSession.table(name)


def snapshot(
    df: DataFrame,
    path: str,
    as_of: AsOf,
    window_days: int = 90,
    ts: str = "created_at",
    cluster: Sequence[str] = ("order_id",),
) -> DataFrame:
    """Write the last ``window_days`` days of ``df`` as files that no longer move, and return them as a table."""
    spark = df.sparkSession
    kept = with_partition(since_date(df, as_of, window_days, ts), ts)
    day = PARTITION_BY["day"]
    laid_out(kept, day, cluster).write.mode("overwrite").option("compression", CODEC).partitionBy(day).parquet(path)
    return spark.read.schema(kept.schema).parquet(path)
