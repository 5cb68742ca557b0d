"""Roll-up of log entries and documents into metric series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.functions.scores import rounded
from triagelake.functions.text import is_error, safe_double, safe_long
from triagelake.functions.times import bucket_start, doc_timestamp
from triagelake.operators.quantiles import grouped_profile
from triagelake.schemas import METRIC_TYPES

BUCKET = "5 minutes"


def _count_if(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("bigint")


def _percent(part: str, whole: str) -> Column:
    return rounded(F.try_divide(F.col(part) * 100.0, F.col(whole)), 4)


def _bucketed(df: DataFrame, ts: str, bucket: str) -> DataFrame:
    return df.where(F.col(ts).isNotNull()).withColumn("bucket_start", bucket_start(F.col(ts), bucket))


def error_rate_by_bucket(logs: DataFrame, bucket: str = BUCKET) -> DataFrame:
    """Share of error entries per service and bucket, in percent."""
    return (
        _bucketed(logs, "timestamp_dt", bucket).groupBy("service_name", "bucket_start")
        .agg(F.sum(_count_if(F.col("is_error"))).alias("n_errors"), F.count(F.lit(1)).alias("n_logs"))
        .withColumn("error_rate", _percent("n_errors", "n_logs"))
    )


def latency_p95_by_bucket(logs: DataFrame, bucket: str = BUCKET, exact: bool = True) -> DataFrame:
    """95th latency percentile per service and bucket, over entries that report a latency."""
    measured = _bucketed(logs, "timestamp_dt", bucket).where(F.col("latency_ms").isNotNull())
    profile = grouped_profile(
        measured, ["service_name", "bucket_start"], "latency_ms", {"latency_p95": 0.95}, exact=exact,
    )
    return profile.select(
        "service_name", "bucket_start", F.col("n_values").alias("n_latency"),
        rounded(F.col("latency_p95"), 2).alias("latency_p95"),
    )


def http_5xx_rate_by_bucket(logs: DataFrame, bucket: str = BUCKET) -> DataFrame:
    """Share of 5xx among the entries that have a status, in percent."""
    return (
        _bucketed(logs, "timestamp_dt", bucket).where(F.col("status_code").isNotNull())
        .groupBy("service_name", "bucket_start")
        .agg(F.sum(_count_if(F.col("status_code") >= 500)).alias("n_5xx"), F.count(F.lit(1)).alias("n_status"))
        .withColumn("http_5xx_rate", _percent("n_5xx", "n_status"))
    )


def unpivot_buckets(buckets: DataFrame, values: dict[str, Column], source: str) -> DataFrame:
    """Wide bucket rows to long metric rows; null values give no row."""
    cells = F.array(*[
        F.struct(
            F.lit(name).alias("metric_name"),
            col.cast("double").alias("metric_value"),
            F.lit(METRIC_TYPES[name]).alias("metric_type"),
        )
        for name, col in values.items()
    ])
    return (
        buckets.select(F.col("bucket_start").alias("timestamp"), "service_name", F.explode(cells).alias("m"))
        .where(F.col("m.metric_value").isNotNull())
        .select("timestamp", "service_name", "m.*", F.lit(source).alias("source"))
    )


def aggregate_to_metrics(
    logs: DataFrame, bucket: str = BUCKET, source: str = "logs", exact: bool = True
) -> DataFrame:
    """Error rate, latency and 5xx series of parsed logs, as long metric rows."""
    wide = grouped_profile(
        _bucketed(logs, "timestamp_dt", bucket), ["service_name", "bucket_start"], "latency_ms", {"p95": 0.95},
        sums={
            "n_logs": F.lit(1).cast("bigint"),
            "n_errors": _count_if(F.col("is_error")),
            "n_status": _count_if(F.col("status_code").isNotNull()),
            "n_5xx": _count_if(F.col("status_code") >= 500),
        },
        exact=exact,
    )
    return unpivot_buckets(
        wide,
        {
            "error_rate": _percent("n_errors", "n_logs"),
            "latency_p95": rounded(F.col("p95"), 2),
            "http_5xx_rate": _percent("n_5xx", "n_status"),
        },
        source,
    )


def bucket_profile(
    docs: DataFrame,
    start: Column | None = None,
    end: Column | None = None,
    service: str | None = None,
    bucket: str = BUCKET,
    exact: bool = True,
) -> DataFrame:
    """Documents per service and time bucket: counts, errors, 5xx, mean and 95th percentile latency.

    The range is half open, so neighbouring ranges share no document. A bucket without any latency
    shows 0 for both latency figures.
    """
    kept = docs
    if start is not None:
        kept = kept.where(F.col("timestamp_dt") >= start)
    if end is not None:
        kept = kept.where(F.col("timestamp_dt") < end)
    if service is not None:
        kept = kept.where(F.col("service_name") == service)
    wide = grouped_profile(
        _bucketed(kept, "timestamp_dt", bucket), ["service_name", "bucket_start"], "latency_ms", {"p95": 0.95},
        sums={
            "doc_count": F.lit(1).cast("bigint"),
            "error_count": _count_if(is_error(F.col("log_level"), policy="docs")),
            "count_5xx": _count_if(F.col("status_code") >= 500),
            "latency_sum": F.col("latency_ms"),
        },
        exact=exact,
    )
    return wide.select(
        "service_name", "bucket_start", "doc_count", "error_count", "count_5xx",
        F.coalesce(F.try_divide("latency_sum", "n_values"), F.lit(0.0)).alias("avg_latency"),
        F.coalesce("p95", F.lit(0.0)).alias("p95_latency"),
    )


def buckets_to_metrics(buckets: DataFrame, source: str = "opensearch") -> DataFrame:
    """Bucket rows to metric rows; 5xx is measured against all documents, latency only when above 0."""
    return unpivot_buckets(
        buckets.where(F.col("doc_count") > 0),
        {
            "error_rate": _percent("error_count", "doc_count"),
            "latency_p95": F.when(F.col("p95_latency") > 0, rounded(F.col("p95_latency"), 2)),
            "http_5xx_rate": _percent("count_5xx", "doc_count"),
            "log_volume": F.col("doc_count"),
        },
        source,
    )


def scroll_to_metrics(
    docs: DataFrame,
    ts: str = "timestamp",
    unit: str = "ms",
    level: str = "log_level",
    latency: str = "latency_ms",
    status: str = "status_code",
    service: str = "service_name",
    bucket: str = BUCKET,
    source: str = "opensearch",
    exact: bool = True,
) -> DataFrame:
    """Raw documents with loosely typed fields to metric rows; documents without a valid time are dropped.

    `ts` names a time that is typed already, an epoch in `unit`, or ISO text.
    """
    typed_time = isinstance(docs.schema[ts].dataType, T.TimestampType)
    typed = docs.select(
        F.col(service).alias("service_name"),
        (F.col(ts) if typed_time else doc_timestamp(F.col(ts), unit)).alias("timestamp_dt"),
        is_error(F.col(level), policy="docs").alias("is_error"),
        safe_double(F.col(latency)).alias("latency_ms"),
        safe_long(F.col(status)).alias("status_code"),
    )
    return aggregate_to_metrics(typed, bucket, source, exact)


def pivot_metrics(metrics: DataFrame, names: list[str], keys: list[str] | None = None) -> DataFrame:
    """Time by metric matrix, the mean on repeated cells. Names are given, so no extra job looks for them."""
    return metrics.groupBy(*(keys or ["timestamp"])).pivot("metric_name", names).agg(F.avg("metric_value"))
