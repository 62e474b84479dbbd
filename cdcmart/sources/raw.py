"""Reading the landing zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.functions.casts import safe_cast
from cdcmart.sources.schemas import CDC_TABLES, LANDING, METADATA, csv_columns, landing_schema


def read_raw(
    spark: SparkSession, path: str, table: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Scan a landing table with its explicit schema. ``fmt`` is ``parquet`` or ``csv``."""
    if fmt == "csv":
        return load_raw_csv(spark, path, table)
    return spark.read.schema(schema or landing_schema(table)).format(fmt).load(path)


def text_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in csv_columns(table)])


def nest_metadata(df: DataFrame, table: str) -> DataFrame:
    """Turn the dotted CSV column into the nested metadata column; the other columns stay text."""
    if table not in CDC_TABLES:
        return df
    source_ts = safe_cast(F.col(f"`{METADATA}.source_timestamp`"), "timestamp").alias("source_timestamp")
    return df.select(*[name for name, _ in LANDING[table]], F.struct(source_ts).alias(METADATA))


def load_raw_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Landing files with a header. Every field is text, so that a bad value can never fail the load."""
    # enforceSchema off: a file whose header has other columns, or another order, is refused.
    read = spark.read.schema(text_schema(table)).option("header", True).option("enforceSchema", False)
    return nest_metadata(read.csv(path), table)
