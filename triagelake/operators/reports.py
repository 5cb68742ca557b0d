"""Summaries, listings and drill-downs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.functions.scores import all_of, severity_name, severity_rank
from triagelake.functions.times import minutes
from triagelake.operators.baselines import latest_baseline
from triagelake.operators.diagnose import incident_metric_window, pending_incidents
from triagelake.operators.quantiles import grouped_profile


def filter_incidents(
    incidents: DataFrame, service: str | None = None, severity: str | None = None, status: str | None = None
) -> DataFrame:
    """Incidents of a service, a severity and a status (`open` or `resolved`); each is optional."""
    conditions = []
    if service:
        conditions.append(F.col("service_name") == service)
    if severity:
        conditions.append(F.col("severity") == severity)
    if status == "open":
        conditions.append(~F.col("resolved"))
    elif status == "resolved":
        conditions.append(F.col("resolved"))
    return incidents.where(all_of(conditions))


def filter_lookback(
    df: DataFrame,
    as_of: Column,
    window_minutes: float,
    service: str | None = None,
    metric: str | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Rows not older than the window before `as_of`."""
    conditions = [F.col(ts) >= as_of - minutes(window_minutes)]
    if service:
        conditions.append(F.col("service_name") == service)
    if metric:
        conditions.append(F.col("metric_name") == metric)
    return df.where(all_of(conditions))


def get_incident(incidents: DataFrame, incident_id: int | Column) -> DataFrame:
    """One incident by id; no row when there is none."""
    return incidents.where(F.col("id") == F.lit(incident_id))


def service_error_rate(logs: DataFrame, as_of: Column, window_minutes: float = 60, service: str | None = None) -> DataFrame:
    """Entries, errors and error percentage per service in the look-back."""
    recent = filter_lookback(logs, as_of, window_minutes, service, ts="timestamp_dt")
    return (
        recent.groupBy("service_name")
        .agg(F.count(F.lit(1)).alias("total_logs"), F.count_if("is_error").alias("error_count"))
        .withColumn("error_rate", F.try_divide(F.col("error_count") * 100.0, F.col("total_logs")))
    )


def service_latency_percentile(
    logs: DataFrame,
    as_of: Column,
    percentile: int = 95,
    window_minutes: float = 60,
    service: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """A latency percentile per service in the look-back, approximate unless `exact`."""
    recent = filter_lookback(logs, as_of, window_minutes, service, ts="timestamp_dt")
    measured = recent.where(F.col("latency_ms").isNotNull())
    return grouped_profile(
        measured, ["service_name"], "latency_ms", {f"p{percentile}": percentile / 100.0}, exact=exact,
    ).drop("n_values")


def discover_services(df: DataFrame) -> DataFrame:
    """All service names, sorted."""
    return df.select("service_name").distinct().orderBy("service_name")


def top_services(
    docs: DataFrame, start: Column, end: Column, size: int | None = None, ts: str = "timestamp_dt"
) -> DataFrame:
    """The services by their documents between `start` and `end`, most first; the first `size` if given."""
    ranked = (
        docs.where((F.col(ts) >= start) & (F.col(ts) <= end))
        .groupBy("service_name").agg(F.count(F.lit(1)).alias("doc_count"))
        .orderBy(F.desc("doc_count"), "service_name")
    )
    return ranked if size is None else ranked.limit(size)


def log_count(logs: DataFrame, as_of: Column, window_minutes: float = 60, service: str | None = None) -> DataFrame:
    recent = filter_lookback(logs, as_of, window_minutes, service, ts="timestamp_dt")
    return recent.agg(F.count(F.lit(1)).alias("total"))


def dataset_stats(stored: DataFrame) -> DataFrame:
    """Documents and stored bytes of a file-backed table."""
    files = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size")
    )
    return files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("doc_count"), F.coalesce(F.sum("size"), F.lit(0)).alias("size_bytes")
    )


def incident_kpis(incidents: DataFrame) -> DataFrame:
    """One row: total, per severity, resolved, mean confidence."""
    return incidents.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("severity") == s).alias(s) for s in ("critical", "high", "medium", "low")],
        F.count_if("resolved").alias("resolved"),
        F.avg("confidence_score").alias("avg_confidence"),
    )


def open_incidents_by_service(incidents: DataFrame) -> DataFrame:
    """Open incidents and the worst severity among them, busiest service first."""
    return (
        incidents.where(~F.col("resolved")).groupBy("service_name")
        .agg(F.count(F.lit(1)).alias("open_incidents"), F.max(severity_rank(F.col("severity"))).alias("_rank"))
        .select("service_name", "open_incidents", severity_name(F.col("_rank")).alias("worst_severity"))
        .orderBy(F.desc("open_incidents"), "service_name")
    )


def incident_trend_hourly(incidents: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    recent = filter_lookback(incidents, as_of, hours * 60)
    return (
        recent.groupBy(F.date_trunc("hour", "timestamp").alias("hour"))
        .agg(F.count(F.lit(1)).alias("count")).orderBy("hour")
    )


def metrics_by_source(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def severity_mix(incidents: DataFrame) -> DataFrame:
    return (
        incidents.groupBy("severity").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "severity")
    )


def incident_timeline(incidents: DataFrame) -> DataFrame:
    """Incidents per hour and severity."""
    return incidents.groupBy(F.date_trunc("hour", "timestamp").alias("hour"), "severity").agg(
        F.count(F.lit(1)).alias("count")
    )


def incidents_by_service_severity(incidents: DataFrame) -> DataFrame:
    """Incidents per service and severity; empty when there is only one service."""
    counts = incidents.groupBy("service_name", "severity").agg(F.count(F.lit(1)).alias("count"))
    bounds = incidents.agg((F.min("service_name") < F.max("service_name")).alias("several")).scalar()
    return counts.where(bounds)


def list_incidents(incidents: DataFrame, limit: int = 200, **filters) -> DataFrame:
    """The `limit` newest incidents, newest first."""
    return filter_incidents(incidents, **filters).orderBy(F.desc("timestamp"), "id").limit(limit)


def list_metrics(
    metrics: DataFrame, as_of: Column, hours: int = 24, service: str | None = None, metric: str | None = None
) -> DataFrame:
    """Recent readings in time order."""
    return (
        filter_lookback(metrics, as_of, hours * 60, service, metric)
        .select("timestamp", "service_name", "metric_name", "metric_value", "source")
        .orderBy("timestamp", "service_name", "metric_name")
    )


def list_baselines(baselines: DataFrame, service: str | None = None) -> DataFrame:
    """The newest baseline of each series, sorted by service and metric."""
    kept = baselines.where(F.col("service_name") == service) if service else baselines
    return latest_baseline(kept).orderBy("service_name", "metric_name")


def list_pending(incidents: DataFrame) -> DataFrame:
    """Incidents waiting for a diagnosis, newest first."""
    return pending_incidents(incidents).select(
        "id", "timestamp", "service_name", "incident_type", "severity"
    ).orderBy(F.desc("timestamp"), "id")


def incident_detail(
    incidents: DataFrame, metrics: DataFrame, baselines: DataFrame, incident_id: int | Column, window_minutes: int = 90
) -> dict[str, DataFrame]:
    """One incident, the readings around it in time order and the newest baselines of its service."""
    incident = get_incident(incidents, incident_id)
    around = incident_metric_window(incident, metrics, window_minutes)
    of_service = baselines.join(incident.select("service_name").distinct(), "service_name", "left_semi")
    return {
        "incident": incident,
        "metrics": around.orderBy("timestamp", "metric_name"),
        "baselines": latest_baseline(of_service).select(
            "metric_name", "mean", "stddev", "p95", "p99", "sample_count"
        ),
    }


def summary_report(incidents: DataFrame, metrics: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    return {
        "totals": incident_kpis(incidents),
        "services": open_incidents_by_service(incidents),
        "trend": incident_trend_hourly(incidents, as_of),
        "metric_sources": metrics_by_source(metrics),
    }
