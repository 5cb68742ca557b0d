"""Statistical baselines per (service, metric)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.functions.scores import finite
from triagelake.operators.quantiles import grouped_profile
from triagelake.operators.upserts import dedup_keep_last

PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
KEY = ["service_name", "metric_name"]
COLUMNS = [*KEY, "mean", "stddev", "p50", "p95", "p99", "sample_count", "window_start", "window_end"]


def _statistics(samples: DataFrame, exact: bool) -> DataFrame:
    """Moments, bounds and percentiles of (service_name, metric_name, metric_value, timestamp) rows."""
    return grouped_profile(
        samples, KEY, "metric_value", PERCENTILES, exact=exact, moments=True,
        extremes={"window_start": (F.col("timestamp"), F.min), "window_end": (F.col("timestamp"), F.max)},
    ).withColumnRenamed("n_values", "sample_count").select(*COLUMNS)


def metric_baselines(
    metrics: DataFrame,
    min_samples: int = 100,
    min_metric_samples: int = 10,
    since: Column | None = None,
    exact: bool = True,
) -> DataFrame:
    """Baselines of all metric series.

    A service takes part with at least `min_samples` readings in total, a metric with at least
    `min_metric_samples`. `since` limits the history; the default is all of it. Values that are not
    finite are not samples.
    """
    history = metrics.where(finite(F.col("metric_value")))
    if since is not None:
        history = history.where(F.col("timestamp") >= since)
    return gated(_statistics(history.select(*KEY, "metric_value", "timestamp"), exact), min_samples, min_metric_samples)


def gated(stats: DataFrame, min_samples: int, min_metric_samples: int) -> DataFrame:
    """Baselines of services and metrics with enough samples."""
    total = F.sum("sample_count").over(Window.partitionBy("service_name"))
    return (
        stats.withColumn("_total", total)
        .where((F.col("_total") >= min_samples) & (F.col("sample_count") >= min_metric_samples))
        .drop("_total")
    )


def error_rate_baseline(logs: DataFrame, exact: bool = True) -> DataFrame:
    """Baseline of the error share per distinct timestamp."""
    rates = (
        logs.where(F.col("timestamp_dt").isNotNull())
        .groupBy("service_name", F.col("timestamp_dt").alias("timestamp"))
        .agg((F.avg(F.when(F.col("is_error"), 1.0).otherwise(0.0)) * 100.0).alias("metric_value"))
    )
    return _statistics(rates.withColumn("metric_name", F.lit("error_rate")), exact)


def latency_baseline(logs: DataFrame, exact: bool = True) -> DataFrame:
    """Baseline of raw latencies under the name of the latency metric; it has no window bounds."""
    samples = logs.where(finite(F.col("latency_ms"))).select(
        "service_name", F.lit("latency_p95").alias("metric_name"),
        F.col("latency_ms").alias("metric_value"), F.lit(None).cast("timestamp").alias("timestamp"),
    )
    return _statistics(samples, exact)


def latest_baseline(baselines: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The newest baseline per (service, metric)."""
    return dedup_keep_last(baselines, KEY, order or ["created_at", "window_start"])
