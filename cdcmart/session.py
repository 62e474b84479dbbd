"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Settings the results depend on: timestamps are instants in UTC, overflow raises.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that only affect speed. Adaptive execution splits skewed join and rebalance partitions and
# merges small ones, so the initial number of shuffle partitions may be generous.
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app: str = "cdcmart", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RESULT_CONF, **SPEED_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_result_conf(spark: SparkSession) -> SparkSession:
    """Pin the settings the results depend on in a session somebody else made."""
    for key, value in RESULT_CONF.items():
        spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> SparkSession:
    """Refuse a session in another zone: partition dates are made in the session's zone and pruned in UTC, so rows
    near midnight would be lost. The caller's session is not changed behind their back."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in ("UTC", "ETC/UTC", "Z", "+00:00", "GMT", "UTC+0"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, is {zone}; see session.build_session")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder every executor can reach, below the one named by ``spark.checkpoint.dir``.

    Where that setting is absent the warehouse folder is used, if it is on shared storage; only a local session gets
    a folder of its own under the system's temporary directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and spark.sparkContext.master.startswith("local"):
        root = _local_root()
    elif not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_cdcmart"
        if ":" not in root or root.startswith("file:"):
            raise ValueError(f"executors do not share {root}; set spark.checkpoint.dir to a folder they all reach")
    return f"{root.rstrip('/')}/cdcmart/{name}"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="cdcmart-")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """Like ``shared_dir``, but new on every call."""
    return shared_dir(spark, f"{name}/{uuid.uuid4().hex}")


def shuffles_removed(spark: SparkSession):
    """Within the block, files of a shuffle go with the query that made them; else they stay until the driver happens to
    collect its garbage, those of every step of a job beside each other."""
    return conf_set(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


@contextmanager
def conf_set(spark: SparkSession, **settings: str):
    """Set session options for the length of a block; ``__`` in a name stands for a dot."""
    wanted = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
