"""Logs, metrics, incidents and labels derived from the given event table.

An event becomes a log entry of the service `svc-<user_id % 8>`. `sql_views` states the same views
in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.functions.scores import confidence, incident_description, root_cause_text, rounded
from triagelake.functions.times import bucket_start, minutes
from triagelake.operators.rollup import aggregate_to_metrics
from triagelake.schemas import RULES
from triagelake.session import materialize

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ROWS_PER_BLOCK = 65536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a zoned time, the number `k` of their properties and their service."""
    return (
        table(spark, sf_dir, "events")
        .withColumn("ts", F.col("ts").cast("timestamp"))
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        .withColumn("service_name", F.concat(F.lit("svc-"), (F.col("user_id") % 8).cast("string")))
        .drop("props")
    )


def _level() -> Column:
    return F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "signup", "warn").otherwise("info")


def _status() -> Column:
    return F.when(F.col("k") % 10 != 0, 100 + 5 * F.col("k"))


def _latency() -> Column:
    return F.when(F.col("event_type") != "click", F.col("value"))


def _text() -> Column:
    return F.concat(
        F.lit("[End Request] GET /e/"), F.col("event_id").cast("string"),
        F.coalesce(F.concat(F.lit(" "), _status().cast("string")), F.lit("")), F.lit(" OK"),
        F.coalesce(F.concat(F.lit(" "), _latency().cast("string"), F.lit("ms")), F.lit("")),
    )


def event_lines(ev: DataFrame) -> DataFrame:
    """One raw log line per event, with colour codes and an optional request id."""
    req = F.when(F.col("k") % 3 == 0, F.concat(F.lit("[r"), F.col("k").cast("string"), F.lit("|]"))).otherwise("")
    line = F.concat(
        F.lit("\x1b[32m"), _level(), F.lit("\x1b[39m|c"), F.col("event_id").cast("string"), F.lit("|t"),
        (F.col("user_id") % 5).cast("string"), F.lit("|"), req, F.date_format("ts", ISO), F.lit(":\t"), _text(),
    )
    broken = F.concat(F.lit("garbage line "), F.col("event_id").cast("string"))
    return ev.select(
        "event_id", "service_name", "event_type", "k",
        F.unix_millis("ts").cast("string").alias("ts_ms"),
        F.when(F.col("k") % 17 == 0, broken).otherwise(line).alias("message"),
    )


def event_rows(ev: DataFrame) -> DataFrame:
    """Raw rows of log files, one file per service: some events are continuation rows without a time."""
    lines = event_lines(ev)
    continues = (F.col("event_type") == "view") & (F.col("k") % 4 == 0)
    frame = F.concat(
        F.lit("    at frame.e"), F.col("event_id").cast("string"),
        F.when(F.col("k") % 8 == 0, " Caused by: Timeout").otherwise(""),
    )
    return lines.select(
        F.col("service_name"), F.floor(F.col("event_id") / ROWS_PER_BLOCK).cast("bigint").alias("block"),
        F.col("event_id").alias("rid"),
        F.when(continues, "").otherwise(F.col("ts_ms")).alias("ts_ms"),
        F.when(continues, frame).otherwise(F.col("message")).alias("message"),
    )


def event_logs(ev: DataFrame) -> DataFrame:
    """Parsed logs, straight from the events."""
    return ev.select(
        "event_id", "service_name", _level().alias("level"),
        F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("correlation_id"),
        F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string")).alias("tenant_id"),
        F.when(F.col("k") % 3 == 0, F.concat(F.lit("r"), F.col("k").cast("string"))).otherwise("").alias("req_id"),
        _text().alias("log_text"), F.col("ts").alias("timestamp_dt"), _status().alias("status_code"),
        _latency().alias("latency_ms"), (F.col("event_type") == "error").alias("is_error"),
    )


def infra_metrics(ev: DataFrame, bucket: str) -> DataFrame:
    """Infrastructure series of the services, derived from other event types."""
    def only(kind: str, col: Column) -> Column:
        return F.when(F.col("event_type") == kind, col)

    wide = ev.groupBy("service_name", bucket_start(F.col("ts"), bucket).alias("bucket_start")).agg(
        F.avg(only("view", F.col("k"))).alias("cpu_usage"),
        F.avg(only("purchase", F.col("value"))).alias("memory_usage"),
        F.nullif(F.count(only("signup", F.col("k"))), F.lit(0)).alias("db_connections"),
        F.max(only("click", F.col("k"))).alias("asg_capacity"),
    )
    cells = F.array(*[
        F.struct(F.lit(name).alias("metric_name"), F.col(name).cast("double").alias("metric_value"))
        for name in ("cpu_usage", "memory_usage", "db_connections", "asg_capacity")
    ])
    return (
        wide.select(F.col("bucket_start").alias("timestamp"), "service_name", F.explode(cells).alias("m"))
        .where(F.col("m.metric_value").isNotNull())
        .select(
            "timestamp", "service_name", "m.metric_name", rounded(F.col("m.metric_value"), 4).alias("metric_value"),
            F.col("m.metric_name").alias("metric_type"), F.lit("synthetic").alias("source"),
        )
    )


def log_metrics(ev: DataFrame, bucket: str) -> DataFrame:
    return aggregate_to_metrics(event_logs(ev), bucket)


def event_metrics(ev: DataFrame, bucket: str) -> DataFrame:
    """Log-derived and infrastructure series together."""
    return log_metrics(ev, bucket).unionByName(infra_metrics(ev, bucket))


def stored_metrics(ev: DataFrame, bucket: str) -> DataFrame:
    """The same as a stored table, the form in which later stages find metrics."""
    return materialize(event_metrics(ev, bucket), "metrics")


def _incident_type() -> Column:
    return (
        F.when(F.col("k") % 4 == 0, "error_spike").when(F.col("k") % 4 == 1, "latency_spike")
        .when(F.col("k") % 4 == 2, "db_saturation").otherwise("unknown_anomaly")
    )


def event_incidents(ev: DataFrame) -> DataFrame:
    """Incidents: slow error events."""
    rule = RULES[1]
    affected = F.when(F.col("k") % 2 == 0, F.array(F.lit("error_rate"))).otherwise(
        F.array(F.lit("http_5xx_rate"), F.lit("latency_p95"))
    )
    base = ev.where((F.col("event_type") == "error") & (F.col("value") >= 100)).select(
        F.col("event_id").alias("id"), F.col("ts").alias("timestamp"), "service_name",
        _incident_type().alias("incident_type"),
        F.when(F.col("value") >= 300, "critical").when(F.col("value") >= 200, "high")
        .when(F.col("value") >= 150, "medium").otherwise("low").alias("severity"),
        "k", "value", affected.alias("affected_metrics"),
        confidence(F.col("value") / 60).alias("confidence_score"),
        (F.col("k") % 3 == 0).alias("resolved"),
    )
    cause = root_cause_text(
        F.lit(rule[2]), F.lit(rule[1][0]),
        F.when(F.col("k") % 4 == 0, F.array(F.lit("cpu_usage"), F.lit("latency_p95")))
        .otherwise(F.array().cast("array<string>")),
        F.lit(rule[3]),
    )
    return base.select(
        "id", "timestamp", "service_name", "incident_type", "severity",
        incident_description(
            F.col("incident_type"), F.col("service_name"), F.col("affected_metrics"), F.array(F.lit("logs"))
        ).alias("description"),
        F.when(F.col("k") % 2 == 0, cause).alias("root_cause"),
        "affected_metrics", "confidence_score", "resolved",
        F.col("timestamp").alias("created_at"),
        F.when(F.col("resolved"), F.col("timestamp") + minutes(30)).alias("resolved_at"),
    )


def event_labels(ev: DataFrame) -> DataFrame:
    """Labelled windows: around large purchases."""
    return ev.where((F.col("event_type") == "purchase") & (F.col("value") >= 150)).select(
        F.col("event_id").alias("gt_pos"), "service_name", _incident_type().alias("incident_type"),
        (F.col("ts") - minutes(15)).alias("window_start"), (F.col("ts") + minutes(45)).alias("window_end"),
        F.when(F.col("k") % 2 == 1, F.concat(F.lit("L"), F.col("event_id").cast("string"))).alias("label"),
    )


def as_of(ev: DataFrame) -> Column:
    """A fixed point in time inside the events' range."""
    return F.lit("2024-01-30 12:00:00").cast("timestamp")

