"""The jobs a user runs: ingest, baselines, detection, diagnosis, evaluation.

`run_all` writes every stage to a table and reads the next stage's input back from it, so a lost
executor repeats one stage at most and no stage is computed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.functions.scores import finite
from triagelake.functions.times import bucket_start, doc_timestamp, minutes
from triagelake.operators import detect, evaluation
from triagelake.operators.baselines import (
    error_rate_baseline,
    latency_baseline,
    latest_baseline,
    metric_baselines,
)
from triagelake.operators.diagnose import diagnose_incidents, pending_incidents
from triagelake.operators.rollup import aggregate_to_metrics, bucket_profile, buckets_to_metrics, scroll_to_metrics
from triagelake.operators.upserts import set_root_cause, union_sources
from triagelake.schemas import BASELINE, INCIDENT, LOG, METRIC
from triagelake.session import materialize
from triagelake.sources import table_log, tables
from triagelake.sources.cloud import normalize_cloud_metric, read_cloud_datapoints
from triagelake.sources.day_partials import baselines_from_partials, read_day_partials, update_day_partials
from triagelake.sources.documents import FIELDS
from triagelake.sources.log_files import entries_from_rows, newest_change, parse_entries, read_logs


def ingest_rows(rows: DataFrame, file: list[str], bucket: str = "5 minutes", aligned: bool = False) -> DataFrame:
    """Raw (file, block, rid, ts_ms, message) rows to metric rows; entries are parsed and stored once."""
    logs = parse_entries(entries_from_rows(rows, file, aligned)).where("parsed")
    narrow = logs.select("service_name", "timestamp_dt", "status_code", "latency_ms", "is_error")
    return aggregate_to_metrics(materialize(narrow, "parsed-logs"), bucket)


def ingest_logs(
    spark: SparkSession, path: str, parsed_path: str, bucket: str = "5 minutes", service_from: str = "stem"
) -> DataFrame:
    """Log files to metric rows.

    Parsed entries are stored once at `parsed_path`; the roll-up, which looks at them twice, reads
    only the columns it needs from there.
    """
    read_logs(spark, path, service_from).write.mode("overwrite").parquet(parsed_path)
    return aggregate_to_metrics(spark.read.schema(LOG).parquet(parsed_path), bucket)


def ingest_docs(
    docs: DataFrame,
    start: Column | None = None,
    end: Column | None = None,
    bucket: str = "5 minutes",
    raw: bool = False,
    service: str | None = None,
    fields: dict[str, str] | None = None,
    unit: str = "ms",
) -> DataFrame:
    """Documents to metric rows, by bucket profile or from loosely typed fields (`raw`).

    Both ways take a half open range, a service and the store's own field names by role (see
    `sources.documents.FIELDS`); raw times may be typed, epochs in `unit` or ISO text.
    """
    names = {"timestamp": "timestamp" if raw else "timestamp_dt", **{k: v for k, v in FIELDS.items() if k != "timestamp"}, **(fields or {})}
    if service is not None:
        docs = docs.where(F.col(names["service"]) == service)
    if not raw:
        renamed = {names[k]: v for k, v in {**FIELDS, "timestamp": "timestamp_dt"}.items() if names[k] != v}
        return buckets_to_metrics(bucket_profile(docs.withColumnsRenamed(renamed), start, end, bucket=bucket))
    if not isinstance(docs.schema[names["timestamp"]].dataType, T.TimestampType):
        docs = docs.withColumn(names["timestamp"], doc_timestamp(F.col(names["timestamp"]), unit))
    if start is not None:
        docs = docs.where(F.col(names["timestamp"]) >= start)
    if end is not None:
        docs = docs.where(F.col(names["timestamp"]) < end)
    return scroll_to_metrics(
        docs, names["timestamp"], level=names["level"], latency=names["latency"], status=names["status_code"],
        service=names["service"], bucket=bucket,
    )


def ingest_cloud_metrics(spark: SparkSession, path: str, service: Column | None = None) -> DataFrame:
    """Landed responses to metric rows. `service` names the service that a response of a database or a load balancer
    belongs to, as an expression over the response; the default is the last part of its resource."""
    return normalize_cloud_metric(read_cloud_datapoints(spark, path, service))


def reopened(fresh: DataFrame, stored: DataFrame, bucket: str, ts: str = "timestamp_dt", service: str = "service_name") -> DataFrame:
    """Of all stored rows those in buckets (service and time) that fresh rows have touched, late ones included.

    Only the span of the touched buckets is read from the stored rows, so late rows cost what they reach back to.
    """
    start = bucket_start(F.col(ts), bucket)
    touched = materialize(
        fresh.where(F.col(ts).isNotNull()).select(F.col(service).alias("_service"), start.alias("_bucket")).distinct(), "touched"
    )
    first, last = touched.agg(F.min("_bucket"), F.max("_bucket")).first()
    if first is None:
        return stored.limit(0)
    end = F.lit(last).cast("timestamp") + F.expr(f"interval {bucket}")
    near = stored.where((F.col(ts) >= F.lit(first).cast("timestamp")) & (F.col(ts) < end)).withColumn("_start", start)
    return near.join(
        touched, near[service].eqNullSafe(touched["_service"]) & (near["_start"] == touched["_bucket"]), "left_semi"
    ).drop("_start")


def compute_baselines(metrics: DataFrame, logs: DataFrame | None = None, min_samples: int = 100) -> DataFrame:
    """Baselines of all metric series, and of raw logs when given."""
    found = metric_baselines(metrics, min_samples)
    if logs is not None:
        found = found.unionByName(error_rate_baseline(logs)).unionByName(latency_baseline(logs))
    return found


def evaluate(incidents: DataFrame, ground_truth: DataFrame, tolerance_minutes: int = 30) -> dict[str, DataFrame]:
    return evaluation.evaluation_report(incidents, ground_truth, tolerance_minutes)


def sql(spark: SparkSession, query: str, tables_by_name: dict[str, DataFrame], args: dict | list | None = None) -> DataFrame:
    """An ad-hoc SELECT over named tables with bound parameters."""
    for name, table in tables_by_name.items():
        table.createOrReplaceTempView(name)
    return spark.sql(query, args=args) if args else spark.sql(query)


def triage(
    metrics: DataFrame,
    min_samples: int = 100,
    sigma: float = 3.0,
    window_minutes: int = 60,
    elevated_sigma: float | None = None,
    elevated_by: str = "mean",
) -> DataFrame:
    """Metrics to diagnosed incidents: baselines, anomalies, incidents, root causes.

    Metrics, baselines and incidents are each used several times, so each is stored once.
    """
    metrics = materialize(metrics, "metrics")
    baselines = materialize(metric_baselines(metrics, min_samples), "baselines")
    found = detect.incidents_from_anomalies(detect.detect_anomalies(metrics, baselines, sigma))
    incidents = materialize(found, "incidents")
    causes = diagnose_incidents(
        incidents, metrics, baselines, window_minutes, elevated_sigma or sigma, elevated_by=elevated_by
    )
    return set_root_cause(incidents, causes)


def run_all(
    spark: SparkSession,
    base: str,
    ingest_seq: int,
    log_path: str | None = None,
    docs: DataFrame | None = None,
    cloud_path: str | None = None,
    extra_metrics: DataFrame | None = None,
    ground_truth: str | None = None,
    bucket: str = "5 minutes",
    service_from: str = "stem",
    min_samples: int = 100,
    sigma: float = 3.0,
    window_minutes: int = 60,
    start: Column | None = None,
    end: Column | None = None,
    raw: bool = False,
    fields: dict[str, str] | None = None,
    unit: str = "ms",
    arrived: str | None = None,
    cloud_service: Column | None = None,
    detect_since: Column | None = None,
    tolerance_minutes: int = 30,
    elevated_sigma: float | None = None,
    compact_after: int = 16,
) -> dict[str, str]:
    """Run every stage into tables below `base`; a failing stage stops the run.

    Sources are optional and later ones win on equal keys. The same `ingest_seq` again replaces that run's batches.

    * Documents: `start` and `end` look back over a half open range, `raw`, `fields` and `unit` are those of
      `ingest_docs`. With `arrived`, a column that tells when a document came in, a run looks only at the buckets that
      documents newer than the last run's have touched, late ones included, and rolls these up again as a whole.
    * Log files: a run parses the files written since the last one (a landed file is complete and stays as it is), and
      rolls up the buckets they touch again from all parsed entries.
    * How far a source has been read is stored in the same commit as the metrics, so a run that fails repeats it.
    * Baselines are kept by day and read changed days only. `detect_since` leaves older readings out of detection.
    * After `compact_after` batches the metrics are merged into a base.

    Row counts in the audit come from the writes themselves.
    """
    paths = {name: f"{base}/{name}" for name in (
        "parsed_logs", "metrics", "metric_days", "baselines", "anomalies", "incidents", "evaluation", "audit"
    )}
    now = F.current_timestamp()

    def audited(stage: str, text: str, work) -> None:
        tables.stage_audit(spark, paths["audit"], stage, text, work)

    def marks_before() -> dict[str, int | str]:
        """How far the sources were read before this run; a run that is repeated begins where it began."""
        state = table_log.current(spark, paths["metrics"])
        again = any(x.seq == ingest_seq for x in state.live)
        return {
            name: value for name in ("logs", "docs")
            if (value := state.marks.get(f"{name}_before" if again else name)) is not None
        }

    def new_logs(before: dict, marks: dict) -> DataFrame | None:
        upto = newest_change(spark, log_path, service_from)
        if upto is None:
            return None
        parsed = read_logs(spark, log_path, service_from, after=before.get("logs"), upto=upto)
        tables.append_batch(parsed, paths["parsed_logs"], ingest_seq, LOG)
        marks["logs"] = upto
        stored = tables.read_batches(spark, paths["parsed_logs"], LOG, upto=ingest_seq)
        if "logs" not in before:
            return aggregate_to_metrics(stored, bucket)
        return aggregate_to_metrics(reopened(stored.where(F.col("ingest_seq") == ingest_seq), stored, bucket), bucket)

    def new_docs(before: dict, marks: dict) -> DataFrame:
        kept = docs
        if arrived is not None:
            at = F.unix_micros(F.col(arrived).cast("timestamp"))
            upto = docs.agg(F.max(at)).first()[0]
            if upto is not None:
                kept, marks["docs"] = docs.where(at <= upto), upto
            if "docs" in before:
                ts = (fields or {}).get("timestamp", "timestamp" if raw else "timestamp_dt")
                service = {**FIELDS, **(fields or {})}["service"]
                if not isinstance(docs.schema[ts].dataType, T.TimestampType):
                    kept = kept.withColumn(ts, doc_timestamp(F.col(ts), unit))
                kept = reopened(kept.where(at > before["docs"]), kept, bucket, ts, service)
        return ingest_docs(kept, start, end, bucket, raw, fields=fields, unit=unit)

    def ingest() -> int:
        before, marks, parts = marks_before(), {}, []
        if log_path and (found := new_logs(before, marks)) is not None:
            parts.append(found)
        if docs is not None:
            parts.append(new_docs(before, marks))
        if cloud_path:
            parts.append(ingest_cloud_metrics(spark, cloud_path, cloud_service))
        if extra_metrics is not None:
            parts.append(extra_metrics)
        names = [c for c in METRIC.fieldNames() if c != "created_at"]
        empty = spark.createDataFrame([], T.StructType([f for f in METRIC if f.name in names]))
        merged = union_sources(*([part.select(*names) for part in parts] or [empty])).where(finite(F.col("metric_value")))
        marks = {**{f"{name}_before": value for name, value in before.items()}, **before, **marks}
        rows = tables.append_batch(merged.withColumn("created_at", now), paths["metrics"], ingest_seq, METRIC, marks)
        if len(table_log.current(spark, paths["metrics"]).live) > compact_after:
            tables.compact_metrics(spark, paths["metrics"], ingest_seq - 1)
        return rows

    def learn() -> int:
        update_day_partials(spark, paths["metrics"], paths["metric_days"])
        found = baselines_from_partials(read_day_partials(spark, paths["metric_days"]), min_samples)
        return tables.append_batch(found.withColumn("created_at", now), paths["baselines"], ingest_seq, BASELINE)

    def incidents_upto(seq: int) -> DataFrame:
        """Incidents as they stood after a batch."""
        batches = tables.read_batches(spark, paths["incidents"], INCIDENT, upto=seq)
        return tables.dedup_keep_last(batches, ["id"], ["ingest_seq"]).drop("ingest_seq")

    def find() -> int:
        metrics = tables.read_metrics(spark, paths["metrics"], detect_since)
        baselines = latest_baseline(tables.read_baselines(spark, paths["baselines"]))
        folder = f"{paths['anomalies']}/ingest_seq={ingest_seq}"
        detect.detect_anomalies(metrics, baselines, sigma).write.mode("overwrite").parquet(folder)
        new = detect.create_incidents(spark.read.parquet(folder), incidents_upto(2 * ingest_seq - 1), now)
        return tables.append_batch(new, paths["incidents"], 2 * ingest_seq, INCIDENT)

    def diagnose() -> int:
        incidents = incidents_upto(2 * ingest_seq)
        # Only the days around the open incidents are read.
        first, last = pending_incidents(incidents).agg(
            F.min("timestamp") - minutes(window_minutes), F.max("timestamp") + minutes(window_minutes)
        ).first()
        causes = diagnose_incidents(
            incidents,
            tables.read_metrics(spark, paths["metrics"], F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")),
            latest_baseline(tables.read_baselines(spark, paths["baselines"])),
            window_minutes, elevated_sigma or sigma,
        )
        updated = set_root_cause(incidents.join(causes.select("id"), "id", "left_semi"), causes)
        return tables.append_batch(updated, paths["incidents"], 2 * ingest_seq + 1, INCIDENT)

    def score() -> int:
        incidents = tables.read_incidents(spark, paths["incidents"])
        labels = tables.read_ground_truth(spark, ground_truth)
        tables.write_evaluation_report(evaluate(incidents, labels, tolerance_minutes), paths["evaluation"])
        return tables.read_evaluation_summary(spark, paths["evaluation"]).count()

    audited("ingest", f"bucket={bucket}", ingest)
    audited("baselines", f"min_samples={min_samples}", learn)
    audited("detect", f"sigma={sigma}", find)
    audited("diagnose", f"window_minutes={window_minutes}", diagnose)
    audited("evaluate", f"tolerance_minutes={tolerance_minutes}", score)
    return paths
