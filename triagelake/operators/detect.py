"""Anomalies against baselines, and the incidents made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.functions.scores import (
    classify_incident_type,
    confidence,
    finite,
    incident_description,
    incident_severity,
    reading_severity,
    zscore,
)
from triagelake.operators.baselines import KEY
from triagelake.operators.upserts import incident_id, insert_incidents_ignore
from triagelake.schemas import INCIDENT

SLICES = 32


def latest_readings(metrics: DataFrame, n: int = 5000, source: str | None = None) -> DataFrame:
    """The newest `n` readings of each service.

    A service is first cut down to `n` rows in each of its slices, so that no task sorts all
    readings of a heavy service; the newest of those are the newest of all.
    """
    kept = metrics if source is None else metrics.where(F.col("source") == source)
    order = [F.desc("timestamp"), F.col("metric_name")]
    sliced = Window.partitionBy("service_name", "_slice").orderBy(*order)
    newest = Window.partitionBy("service_name").orderBy(*order)
    return (
        kept.withColumn("_slice", F.pmod(F.xxhash64("timestamp", "metric_name"), F.lit(SLICES)))
        .withColumn("_rank", F.row_number().over(sliced)).where(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n)
        .drop("_slice", "_rank")
    )


def join_latest_baseline(metrics: DataFrame, baselines: DataFrame) -> DataFrame:
    """Readings with the mean and deviation of their series; readings without a baseline drop out.

    `baselines` holds one row per (service, metric). Its size is left to Spark to check: it is
    broadcast below the session's threshold and joined by shuffle above it.
    """
    stats = baselines.select(*KEY, F.col("mean").alias("baseline_mean"), F.col("stddev").alias("baseline_stddev"))
    return metrics.join(stats, KEY)


def services_with_baseline(metrics: DataFrame, baselines: DataFrame) -> DataFrame:
    """The readings of services that have any baseline."""
    return metrics.join(baselines.select("service_name").distinct(), "service_name", "left_semi")


def log_first(metrics: DataFrame, log_sources: tuple[str, ...] = ("logs",)) -> DataFrame:
    """Only log-derived readings if there are any, else all readings."""
    from_logs = F.col("source").isin(*log_sources)
    any_log = metrics.where(from_logs).select(F.lit(1)).exists()
    return metrics.where(from_logs | ~any_log)


def detect_anomalies(
    metrics: DataFrame,
    baselines: DataFrame,
    sigma: float = 3.0,
    n_latest: int | None = None,
    log_sources: tuple[str, ...] = ("logs",),
) -> DataFrame:
    """Readings at least `sigma` deviations away from the mean of their series.

    Every reading is looked at unless `n_latest` asks for the newest of each service only. Readings that are not
    finite are never anomalies.
    """
    readings = log_first(metrics.where(finite(F.col("metric_value"))), log_sources)
    if n_latest is not None:
        readings = latest_readings(readings, n_latest)
    z = zscore(F.col("metric_value"), F.col("baseline_mean"), F.col("baseline_stddev"))
    return (
        join_latest_baseline(readings, baselines)
        .withColumn("zscore", z)
        .where(finite(F.col("zscore")) & (F.abs("zscore") >= sigma))
        .select(
            "timestamp", "service_name", "metric_name", F.col("metric_value").alias("value"), "baseline_mean",
            "zscore", reading_severity(F.col("zscore")).alias("severity"), "source",
        )
    )


def incidents_from_anomalies(anomalies: DataFrame, created_at: Column | None = None) -> DataFrame:
    """One incident per service: earliest time, affected metrics, class, severity and confidence.

    The two sets hold metric and source names, a small vocabulary, and are combined map-side.
    """
    grouped = anomalies.groupBy("service_name").agg(
        F.min("timestamp").alias("timestamp"),
        F.max(F.abs("zscore")).alias("max_z"),
        F.array_sort(F.collect_set("metric_name")).alias("affected_metrics"),
        F.array_sort(F.collect_set("source")).alias("sources"),
    )
    typed = grouped.withColumn("incident_type", classify_incident_type(F.col("affected_metrics")))
    return typed.select(
        incident_id(F.col("timestamp"), F.col("service_name"), F.col("incident_type")).alias("id"),
        "timestamp", "service_name", "incident_type",
        incident_severity(F.col("max_z")).alias("severity"),
        incident_description(
            F.col("incident_type"), F.col("service_name"), F.col("affected_metrics"), F.col("sources")
        ).alias("description"),
        F.lit(None).cast("string").alias("root_cause"),
        "affected_metrics",
        confidence(F.col("max_z")).alias("confidence_score"),
        F.lit(False).alias("resolved"),
        (F.lit(None) if created_at is None else created_at).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
    ).select(*INCIDENT.fieldNames())


def create_incidents(anomalies: DataFrame, existing: DataFrame, created_at: Column | None = None) -> DataFrame:
    """The incidents of this run that are not in `existing` yet."""
    return insert_incidents_ignore(incidents_from_anomalies(anomalies, created_at), existing)


def run_summary(anomalies: DataFrame, created: DataFrame, incidents: DataFrame) -> DataFrame:
    """One row: anomalies and incidents of this run, incidents in total, diagnosed and not."""
    parts = [
        anomalies.select(F.lit("a").alias("kind"), F.lit(False).alias("diagnosed")),
        created.select(F.lit("c").alias("kind"), F.lit(False).alias("diagnosed")),
        incidents.select(F.lit("i").alias("kind"), F.col("root_cause").isNotNull().alias("diagnosed")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.agg(
        F.count_if(F.col("kind") == "a").alias("anomalies"),
        F.count_if(F.col("kind") == "c").alias("incidents_created"),
        F.count_if(F.col("kind") == "i").alias("incidents_total"),
        F.count_if((F.col("kind") == "i") & F.col("diagnosed")).alias("diagnosed"),
        F.count_if((F.col("kind") == "i") & ~F.col("diagnosed")).alias("undiagnosed"),
    )
