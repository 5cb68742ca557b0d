"""Latency sketches by service and time bucket, stored once and merged for any look-back.

A KLL sketch has a bounded size and a rank error that does not grow with what it has seen; sketches of buckets merge
to the sketch of all their values. A percentile over a window then reads one small row for each bucket, not the logs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.functions.scores import finite
from triagelake.functions.times import bucket_start, minutes, utc_day
from triagelake.session import scratch_path

#: Size of the sketches; the rank of what they give is within RANK_ERROR of the wanted one nearly always.
SKETCH_SIZE = 800
RANK_ERROR = 0.01


def latency_sketches(logs: DataFrame, bucket: str = "5 minutes", size: int = SKETCH_SIZE) -> DataFrame:
    """Per service and bucket: number of latencies and their sketch; values that are not finite are left out."""
    measured = logs.where(F.col("timestamp_dt").isNotNull() & finite(F.col("latency_ms")))
    return measured.groupBy("service_name", bucket_start(F.col("timestamp_dt"), bucket).alias("bucket_start")).agg(
        F.count("latency_ms").alias("n_latency"),
        F.kll_sketch_agg_double(F.col("latency_ms").cast("double"), F.lit(size)).alias("sketch"),
    )


def stored_sketches(sketches: DataFrame, path: str | None = None) -> DataFrame:
    """Write sketches by UTC day and read them back; a look-back then reads its days only."""
    path = path or scratch_path(sketches.sparkSession, "sketches")
    dated = sketches.withColumn("ds", utc_day(F.col("bucket_start")))
    dated.hint("rebalance", "ds").write.mode("append").partitionBy("ds").parquet(path)
    return sketches.sparkSession.read.schema(dated.schema).parquet(path)


def sketched_percentile(
    sketches: DataFrame, as_of: Column, percentile: int = 95, window_minutes: float = 60, service: str | None = None,
) -> DataFrame:
    """A latency percentile per service over the buckets that begin in the look-back, by merged sketches."""
    start = as_of - minutes(window_minutes)
    recent = sketches.where((F.col("bucket_start") >= start) & (F.col("bucket_start") <= as_of))
    if "ds" in sketches.columns:
        recent = recent.where(F.col("ds").between(utc_day(start), utc_day(as_of)))
    if service is not None:
        recent = recent.where(F.col("service_name") == service)
    merged = recent.groupBy("service_name").agg(
        F.sum("n_latency").alias("n_latency"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    return merged.select(
        "service_name", "n_latency",
        F.kll_sketch_get_quantile_double("sketch", F.lit(percentile / 100.0)).alias(f"p{percentile}"),
    )
