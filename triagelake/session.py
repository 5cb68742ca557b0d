"""Session helpers: builder defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "triagelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    Shuffle partitions are left to AQE: start wide, coalesce at run time, split skewed join
    partitions. `conf` overrides any of the defaults.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Rank limits up to this size are applied before the shuffle; the default stops at 1000.
        "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: list[str] = []
_RUN = uuid.uuid4().hex


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (`spark.checkpoint.dir`).

    Where that is unset, a local session uses a folder of this process, which goes with it; on a cluster that
    would lose data, so it is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="triagelake-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in this process's part of it."""
    return f"{shared_dir(spark)}/triagelake/{_RUN}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this process has stored below the shared folder; frames that read it can no longer be used."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/triagelake/{_RUN}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


BROADCAST_ROWS = 2_000_000


def broadcast_if_small(stored: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table for broadcast after counting it; a larger one is left to a shuffle join."""
    return F.broadcast(stored) if stored.count() <= max_rows else stored


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a stage's result below the shared folder and read it back.

    Later stages then scan its columns instead of repeating its work, and a lost executor does not
    reach back beyond it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
