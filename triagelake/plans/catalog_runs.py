"""Queries of whole runs, stored tables under maintenance, baselines by day and stored sketches."""

from pyspark.sql import functions as F

from triagelake.functions.scores import rounded
from triagelake.functions.times import minutes
from triagelake.operators import diagnose, sketches
from triagelake.plans import event_views as views
from triagelake.plans import jobs
from triagelake.plans import sql_views as q
from triagelake.plans.catalog_incidents import AROUND, DIAGNOSIS, _inputs
from triagelake.plans.catalog_rollup import TO_METRICS, _profile_sql
from triagelake.plans.catalog_streams import _as_stream
from triagelake.plans.catalog_tables import BASELINE_OUT_SQL, BATCHES, FILE_MESSAGE, _csv_folder, _metric_batches, rounded_baselines
from triagelake.plans.registry import query
from triagelake.schemas import METRIC
from triagelake.session import scratch_path
from triagelake.sources import day_partials, tables
from triagelake.streaming import streams

BUCKET = "6 hours"

# Metrics of a run: parsed log files (svc-*), documents (doc-*) and cloud responses (svc-*).
FROM_FILES = f"""c AS (SELECT event_id, service_name, ts_ms, {q.clean('(' + FILE_MESSAGE + ')')} AS clean FROM lines), p AS (
  SELECT service_name, lower({q.part(1)}) AS level, {q.part(5)} AS timestamp, {q.part(6)} AS log_text
  FROM c WHERE regexp_matches(clean, '{q.LINE}')), file_logs AS (
  SELECT service_name, {q.utc('timestamp')} AS timestamp_dt, {q.status_of('log_text')} AS status_code,
    {q.latency_of('log_text')} AS latency_ms,
    level IN ('error','fatal','critical','warn','warning') OR {q.keyword('log_text')} AS is_error FROM p)"""
CLOUD = q.infra_metrics(BUCKET).replace("'synthetic'", "'cloudwatch'")
RUN_METRICS = q.LINES + q.LOGS.removeprefix(q.EV) + f""", {FROM_FILES}, b AS (
  SELECT * REPLACE ('doc-' || service_name AS service_name) FROM ({_profile_sql(BUCKET)})), metrics AS (
  {q.log_metrics(BUCKET, 'file_logs')}
  UNION ALL SELECT * FROM ({TO_METRICS})
  UNION ALL SELECT * FROM ({CLOUD}))"""


def _documents(ev):
    return views.event_logs(ev).withColumn("log_level", F.upper("level")).withColumn(
        "service_name", F.concat(F.lit("doc-"), "service_name")
    )


def _cloud_folder(ev):
    """The infrastructure series as landed responses, one JSON line for each service and metric."""
    known = {"cpu_usage": ("AWS/ECS", "CPUUtilization", "Average"), "memory_usage": ("AWS/ECS", "MemoryUtilization", "Average"),
             "asg_capacity": ("AWS/ECS", "RunningTaskCount", "Sum"), "db_connections": ("AWS/RDS", "DatabaseConnections", "Maximum")}

    def part(i):
        return F.element_at(F.create_map(*[F.lit(x) for name, parts in known.items() for x in (name, parts[i])]), F.col("metric_name"))

    def value(stat):
        return F.when(part(2) == stat, F.col("metric_value")).alias(stat)

    point = F.struct(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("Timestamp"), *map(value, ("Average", "Sum", "Maximum")))
    path = scratch_path(ev.sparkSession, "cloud")
    views.infra_metrics(ev, BUCKET).select(
        part(0).alias("Namespace"), part(1).alias("MetricName"), F.concat(F.lit("arn/"), "service_name").alias("Resource"), point.alias("p"),
    ).groupBy("Namespace", "MetricName", "Resource").agg(F.collect_list("p").alias("Datapoints")).write.json(path)
    return path


@query("run_all_sources", "WITH " + q.incidents(BUCKET).replace(q.metrics(BUCKET), RUN_METRICS)
       + ", keyed AS (SELECT *, service_name AS id FROM found)" + q.diagnosis("keyed", "24 HOUR", 1.0)
       + f""" SELECT k.timestamp, k.service_name, k.incident_type, k.severity, k.confidence_score, {q.CAUSE_TEXT} AS root_cause
FROM keyed k LEFT JOIN causes c ON c.incident_id = k.id""")
def run_all_sources(spark, sf):
    """A run over log files, documents and cloud responses; the stored incidents with their root causes."""
    ev = views.events(spark, sf)
    paths = jobs.run_all(
        spark, scratch_path(spark, "run"), 1, log_path=_csv_folder(spark, sf), service_from="dir", docs=_documents(ev),
        cloud_path=_cloud_folder(ev), bucket=BUCKET, window_minutes=24 * 60, elevated_sigma=1.0,
    )
    return tables.read_incidents(spark, paths["incidents"]).select(
        "timestamp", "service_name", "incident_type", "severity", "confidence_score", "root_cause"
    )


@query("run_all_split", f"WITH {RUN_METRICS} SELECT * FROM metrics WHERE source = 'opensearch'")
def run_all_split(spark, sf):
    """Two runs, the second with documents that came later, many of them for buckets that were closed already."""
    ev = views.events(spark, sf)
    late = (F.col("event_id") % 7 == 0) | (F.col("event_id") % 1000 > 900)
    docs = _documents(ev).withColumn("arrived", F.when(late, F.lit("2024-03-02")).otherwise(F.lit("2024-03-01")).cast("timestamp"))
    base = scratch_path(spark, "run")
    for seq, part in ((1, docs.where(~late)), (2, docs)):
        paths = jobs.run_all(spark, base, seq, docs=part, arrived="arrived", bucket=BUCKET)
    return tables.read_metrics(spark, paths["metrics"]).drop("created_at")


@query("run_audit", """SELECT * FROM (VALUES ('ingest', true), ('baselines', true), ('detect', true), ('diagnose', true),
  ('evaluate', true)) t(query_type, agrees)""")
def run_audit(spark, sf):
    """The rows that a run's audit tells, counted while they were written, next to those of the stored batches."""
    ev = views.events(spark, sf)
    paths = jobs.run_all(spark, scratch_path(spark, "run"), 1, extra_metrics=views.event_metrics(ev, BUCKET), bucket=BUCKET)
    incidents = tables.read_batches(spark, paths["incidents"], tables.INCIDENT).groupBy("ingest_seq").count()
    counts = {
        "ingest": tables.read_batches(spark, paths["metrics"], METRIC).count(),
        "baselines": tables.read_baselines(spark, paths["baselines"]).count(), "evaluate": 1,
        **{("detect", "diagnose")[r["ingest_seq"] - 2]: r["count"] for r in incidents.collect()},
    }
    told = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])
    return spark.read.parquet(paths["audit"]).select(
        "query_type", (F.coalesce(F.try_element_at(told, "query_type"), F.lit(0)) == F.col("result_count")).alias("agrees")
    )


@query("compact_metrics", f"WITH {BATCHES} SELECT * FROM current_")
def compact_metrics(spark, sf):
    """Batches merged into a base, and one more batch after it."""
    path, stamp = scratch_path(spark, "metrics"), F.lit("2024-02-01").cast("timestamp")
    parts = [part.withColumn("created_at", stamp) for part in _metric_batches(views.events(spark, sf))]
    for seq, part in enumerate(parts[:2]):
        tables.append_batch(part, path, seq, METRIC)
    tables.compact_metrics(spark, path)
    tables.append_batch(parts[2], path, 2, METRIC)
    return tables.read_metrics(spark, path).drop("created_at")


@query("baselines_by_day", f"""WITH {BATCHES}, stats AS ({q.statistics('current_')})
SELECT {BASELINE_OUT_SQL} FROM stats QUALIFY sum(sample_count) OVER (PARTITION BY service_name) >= 100 AND sample_count >= 10""")
def baselines_by_day(spark, sf):
    """Day partials brought up to date after each of three overlapping batches, and the baselines of all days."""
    metrics, days = scratch_path(spark, "metrics"), scratch_path(spark, "metric-days")
    stamp = F.lit("2024-02-01").cast("timestamp")
    for seq, part in enumerate(_metric_batches(views.events(spark, sf))):
        tables.append_batch(part.withColumn("created_at", stamp), metrics, seq, METRIC)
        day_partials.update_day_partials(spark, metrics, days)
    return rounded_baselines(day_partials.baselines_from_partials(day_partials.read_day_partials(spark, days)))


@query("upsert_stream", f"WITH {BATCHES} SELECT * FROM current_")
def upsert_stream(spark, sf):
    """Three streams of metric rows into one table, one after the other."""
    path = scratch_path(spark, "metrics")
    for i, part in enumerate(_metric_batches(views.events(spark, sf))):
        state = scratch_path(spark, "stream-state")
        streams.upsert_stream(_as_stream(part, "stream-metrics"), path, state, first_seq=1000 * i).awaitTermination()
    return tables.read_metrics(spark, path).drop("created_at")


SKETCH_AS_OF = "TIMESTAMP '2024-01-20 12:00:00'"


def _window_sql(hours: int) -> str:
    return f"""SELECT service_name, {hours} AS hours, count(latency_ms) AS n_latency, true AS within_bound FROM logs
  WHERE latency_ms IS NOT NULL AND time_bucket(INTERVAL '1 hour', timestamp_dt) BETWEEN {SKETCH_AS_OF} - INTERVAL {hours} HOUR
    AND {SKETCH_AS_OF} GROUP BY service_name"""


@query("sketched_percentile", f"WITH {q.LOGS} " + " UNION ALL ".join(map(_window_sql, (6, 48, 240))))
def sketched_percentile(spark, sf):
    """Percentiles over three look-backs from stored sketches; the rank of each among the raw values is held to the bound."""
    logs = views.event_logs(views.events(spark, sf))
    kept = sketches.stored_sketches(sketches.latency_sketches(logs, "1 hour"))
    as_of = F.lit("2024-01-20 12:00:00").cast("timestamp")
    found = None
    for hours in (6, 48, 240):
        estimate = sketches.sketched_percentile(kept, as_of, 95, hours * 60)
        start = F.date_trunc("hour", "timestamp_dt")
        raw = logs.where(F.col("latency_ms").isNotNull() & start.between(as_of - minutes(hours * 60), as_of))
        below = raw.join(estimate, "service_name").groupBy("service_name", "n_latency").agg(
            F.avg(F.when(F.col("latency_ms") < F.col("p95"), 1.0).otherwise(0.0)).alias("low"),
            F.avg(F.when(F.col("latency_ms") <= F.col("p95"), 1.0).otherwise(0.0)).alias("high"),
        )
        within = (F.col("low") - sketches.RANK_ERROR <= 0.95) & (F.col("high") + sketches.RANK_ERROR >= 0.95)
        part = below.select("service_name", F.lit(hours).alias("hours"), "n_latency", within.alias("within_bound"))
        found = part if found is None else found.unionByName(part)
    return found


@query("elevated_by_bin", f"""WITH {DIAGNOSIS} SELECT incident_id, service_name, metric_name,
  {q.fixed('window_mean', 4)} AS window_mean, {q.fixed('z', 2)} AS zscore FROM elevated""")
def elevated_by_bin(spark, sf):
    """Elevated infra metrics from sums by time bin, readings looked at in edge bins only."""
    incidents, metrics, baselines = _inputs(spark, sf)
    figures = diagnose.window_figures_by_bin(diagnose.pending_incidents(incidents), metrics, AROUND)
    found = diagnose.elevated_infra(figures, baselines, sigma=1.0)
    return found.withColumn("window_mean", rounded(F.col("window_mean"), 4))
