"""What the operators share: intermediate tables, reading of the sample tables, text batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cdcmart.session import fresh_dir

# Word separators: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


_sent_to: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python, once per application: Spark fetches the archive from the driver."""
    app = spark.sparkContext.applicationId
    if app not in _sent_to:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="cdcmart-"), "cdcmart.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _sent_to.add(app)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read again: lineage ends there, so a lost executor
    costs a reread and not a recomputation, and later steps see the same rows whatever order tasks ran in."""
    path = fresh_dir(df.sparkSession, f"llm/{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """Arrow batches of ``df`` through a function made once per task; whole rows only, nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        yield from slices(step, batches)
        # What a step has kept for its task goes before the worker takes up another operator.
        getattr(step, "close", lambda: None)()

    def slices(step, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Slices keep what a step holds at once small, however long the texts are.
            start = 0
            while start < batch.num_rows:
                rows = min(batch.num_rows - start, 2000)
                while rows > 1 and batch.slice(start, rows).nbytes > 8 << 20:
                    rows //= 2
                out = step(batch.slice(start, rows))
                if out is not None and out.num_rows:
                    yield out
                start += rows

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def picked(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The key and the text under fixed names; whatever other columns are called, they cannot clash."""
    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
