"""Table schemas and fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, TS, B = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType(), T.BooleanType()


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(*field) for field in fields])


LOG = _schema(
    ("service_name", S), ("level", S), ("correlation_id", S), ("tenant_id", S), ("req_id", S),
    ("timestamp", S), ("ts_ms", S), ("log_text", S), ("timestamp_dt", TS),
    ("status_code", T.IntegerType()), ("latency_ms", D), ("is_error", B),
)
DOC = _schema(
    ("_timestamp", L), ("service_name", S), ("log_level", S), ("message", S), ("correlation_id", S),
    ("tenant_id", S), ("is_error", B), ("latency_ms", D), ("status_code", L), ("req_id", S),
)
METRIC = _schema(
    ("timestamp", TS, False), ("service_name", S, False), ("metric_name", S, False),
    ("metric_value", D, False), ("metric_type", S, False), ("source", S, False), ("created_at", TS, False),
)
BASELINE = _schema(
    ("service_name", S), ("metric_name", S), ("mean", D), ("stddev", D), ("p50", D), ("p95", D),
    ("p99", D), ("sample_count", L), ("window_start", TS), ("window_end", TS), ("created_at", TS),
)
ANOMALY = _schema(
    ("timestamp", TS), ("service_name", S), ("metric_name", S), ("value", D), ("baseline_mean", D),
    ("zscore", D), ("severity", S), ("source", S),
)
INCIDENT = _schema(
    ("id", L), ("timestamp", TS), ("service_name", S), ("incident_type", S), ("severity", S),
    ("description", S), ("root_cause", S), ("affected_metrics", T.ArrayType(S)),
    ("confidence_score", D), ("resolved", B), ("created_at", TS), ("resolved_at", TS),
)
GROUND_TRUTH = _schema(
    ("service_name", S), ("incident_type", S), ("window_start", TS), ("window_end", TS), ("label", S),
)
AUDIT = _schema(
    ("query_type", S), ("query_text", S), ("execution_time_ms", D), ("result_count", L),
    ("error", S), ("created_at", TS),
)
CLOUD_DATAPOINT = _schema(
    ("Timestamp", TS), ("Average", D), ("Sum", D), ("Maximum", D),
)
CLOUD_RESPONSE = _schema(
    ("Namespace", S), ("MetricName", S), ("Resource", S), ("Datapoints", T.ArrayType(CLOUD_DATAPOINT)),
)

METRIC_KEY = ["timestamp", "service_name", "metric_name"]
BASELINE_KEY = ["service_name", "metric_name", "window_start"]
INCIDENT_KEY = ["timestamp", "service_name", "incident_type"]

# Levels, keywords, metric names, sources and severities used by the data.
ERROR_LEVELS = ["error", "fatal", "critical", "warn", "warning"]
DOC_ERROR_LEVELS = ["ERROR", "FATAL", "CRITICAL"]
ERROR_KEYWORDS = [
    "error", "exception", "failed", "timeout", "refused", "denied", "fatal", "critical",
    "unhandled", "uncaught",
]
LOG_METRICS = ["error_rate", "latency_p95", "http_5xx_rate"]
INFRA_METRICS = ["cpu_usage", "memory_usage", "asg_capacity", "db_connections"]
INFRA_SOURCES = ["synthetic", "cloudwatch"]
SEVERITIES = ["low", "medium", "high", "critical"]
METRIC_TYPES = {
    "error_rate": "error_rate",
    "latency_p95": "latency",
    "http_5xx_rate": "error_rate",
    "log_volume": "count",
}

# Fixed values: (namespace, cloud metric, internal name, statistic, scale).
CLOUD_METRICS = [
    ("AWS/ECS", "CPUUtilization", "cpu_usage", "Average", 1.0),
    ("AWS/ECS", "MemoryUtilization", "memory_usage", "Average", 1.0),
    ("AWS/ECS", "RunningTaskCount", "asg_capacity", "Sum", 1.0),
    ("AWS/RDS", "DatabaseConnections", "db_connections", "Maximum", 1.0),
    ("AWS/RDS", "CPUUtilization", "rds_cpu", "Average", 1.0),
    ("AWS/RDS", "FreeableMemory", "rds_memory_mb", "Average", 1.0 / (1024 * 1024)),
    ("AWS/ApplicationELB", "HTTPCode_Target_5XX_Count", "http_5xx_count", "Sum", 1.0),
    ("AWS/ApplicationELB", "TargetResponseTime", "latency_p95", "Average", 1000.0),
    ("AWS/ApplicationELB", "RequestCount", "request_count", "Sum", 1.0),
]

# Diagnosis rules in priority order (name, required metrics, description, action, scenario).
RULES = [
    ("infrastructure_saturation", ["asg_capacity"],
     "ECS Auto Scaling Group at maximum capacity — new tasks cannot be placed",
     "Increase ASG max_size in the ECS capacity provider, or reduce task CPU/memory reservations", "A"),
    ("database_saturation", ["db_connections"],
     "RDS connection pool approaching saturation",
     "Scale RDS instance vertically or increase max_connections; review connection pooling (PgBouncer)", "C"),
    ("resource_contention", ["cpu_usage", "memory_usage"],
     "High CPU and memory pressure — service is resource-constrained",
     "Scale ECS task definition (CPU/memory limits) or investigate memory leak", "B"),
    ("cpu_pressure", ["cpu_usage"],
     "CPU utilisation significantly above baseline",
     "Profile CPU-intensive code paths; consider horizontal scaling", "B"),
    ("memory_pressure", ["memory_usage"],
     "Memory usage significantly above baseline — possible memory leak",
     "Restart container to reclaim memory; investigate heap growth", "B"),
    ("application_error", [],
     "Elevated error rate with no correlated infrastructure anomaly",
     "Review application logs for exception stack traces; check recent deployments", "app"),
]

# The labelled windows used when no manifest is given.
DEFAULT_GROUND_TRUTH = [
    ("External-core-ms-2", "db_saturation", "2024-03-01 05:30:00", "2024-03-01 07:00:00", "DB saturation (GT1)"),
    ("Internal-core-ms", "asg_capacity_limit", "2024-03-01 11:30:00", "2024-03-01 13:00:00",
     "ASG capacity limit (GT2)"),
]
