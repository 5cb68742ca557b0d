"""Incremental roll-up, detection and incident creation.

State is bounded by the watermark: a bucket is emitted and dropped once the watermark has passed
its end, and so is a run of anomalies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from triagelake.functions.scores import (
    classify_incident_type,
    confidence,
    finite,
    incident_severity,
    reading_severity,
    rounded,
    zscore,
)
from triagelake.operators.detect import join_latest_baseline
from triagelake.operators.rollup import unpivot_buckets
from triagelake.schemas import METRIC
from triagelake.sources.tables import append_batch


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def rollup_stream(
    logs: DataFrame, watermark: str = "10 minutes", bucket: str = "5 minutes", source: str = "logs"
) -> DataFrame:
    """A stream of parsed logs to metric rows, one set per closed bucket; late entries are dropped.

    The latency percentile comes from Spark's approximate sketch, whose state is bounded.
    """
    wide = (
        logs.withWatermark("timestamp_dt", watermark)
        .groupBy("service_name", F.window("timestamp_dt", bucket).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n_logs"),
            _count_if(F.col("is_error")).alias("n_errors"),
            F.count("status_code").alias("n_status"),
            _count_if(F.col("status_code") >= 500).alias("n_5xx"),
            F.percentile_approx("latency_ms", 0.95, 10000).alias("p95"),
        )
        .withColumn("bucket_start", F.col("w.start"))
    )
    return unpivot_buckets(
        wide,
        {
            "error_rate": rounded(F.try_divide(F.col("n_errors") * 100.0, F.col("n_logs")), 4),
            "latency_p95": rounded(F.col("p95"), 2),
            "http_5xx_rate": rounded(F.try_divide(F.col("n_5xx") * 100.0, F.col("n_status")), 4),
        },
        source,
    )


def detect_stream(metrics: DataFrame, baselines: DataFrame, sigma: float = 3.0) -> DataFrame:
    """A stream of metric rows against a stored baseline table: the readings far from their mean."""
    z = zscore(F.col("metric_value"), F.col("baseline_mean"), F.col("baseline_stddev"))
    return (
        join_latest_baseline(metrics, baselines)
        .withColumn("zscore", z)
        .where(finite(F.col("zscore")) & (F.abs("zscore") >= sigma))
        .select(
            "timestamp", "service_name", "metric_name", F.col("metric_value").alias("value"), "baseline_mean",
            "zscore", reading_severity(F.col("zscore")).alias("severity"), "source",
        )
    )


def first_incidents_stream(anomalies: DataFrame, quiet: str = "1 hour") -> DataFrame:
    """One incident per service and run of anomalies, as the batch job makes them; a run ends with the quiet time.

    Its time is that of the earliest anomaly, its class and scores come from all of them, so the order of arrival
    does not matter. It is emitted once the watermark, `quiet` behind the newest time, has passed the run's end.
    """
    runs = (
        anomalies.withWatermark("timestamp", quiet)
        .groupBy("service_name", F.session_window("timestamp", quiet).alias("run"))
        .agg(F.max(F.abs("zscore")).alias("max_z"), F.collect_set("metric_name").alias("metrics"))
    )
    return runs.select(
        F.col("run.start").alias("timestamp"), "service_name",
        classify_incident_type(F.col("metrics")).alias("incident_type"),
        incident_severity(F.col("max_z")).alias("severity"), confidence(F.col("max_z")).alias("confidence_score"),
    )


def append_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything that is available now into a parquet folder, exactly once."""
    return (
        stream.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def upsert_stream(metrics: DataFrame, path: str, checkpoint: str, first_seq: int = 1) -> StreamingQuery:
    """Process what is available now of a stream of metric rows into a metrics table, each micro-batch as one batch.

    The number of a batch follows from the micro-batch's, so one that is replayed after a failure replaces itself; where
    the streams of a table begin is for the caller to tell by `first_seq`.
    """
    def store(rows: DataFrame, batch_id: int) -> None:
        append_batch(rows.withColumn("created_at", F.current_timestamp()), path, first_seq + batch_id, METRIC)

    return (
        metrics.writeStream.outputMode("append").foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
