"""Queries of roll-ups, baselines, detection and time-series helpers."""

from pyspark.sql import functions as F

from triagelake.functions.scores import rounded
from triagelake.operators import baselines, detect, rollup, timeseries
from triagelake.plans import event_views as views
from triagelake.plans import jobs
from triagelake.plans import sql_views as q
from triagelake.plans.catalog_tables import BASELINE_OUT_SQL, rounded_baselines
from triagelake.plans.registry import query
from triagelake.session import materialize

BUCKET = "6 hours"
START = f"time_bucket(INTERVAL '{BUCKET}', timestamp_dt)"


@query("error_rate_by_bucket", f"""WITH {q.LOGS} SELECT service_name, {START} AS bucket_start,
  CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS n_errors, count(*) AS n_logs,
  {q.fixed('100.0 * sum(CASE WHEN is_error THEN 1 ELSE 0 END) / count(*)', 4)} AS error_rate FROM logs GROUP BY 1, 2""")
def error_rate(spark, sf):
    return rollup.error_rate_by_bucket(views.event_logs(views.events(spark, sf)), BUCKET)


@query("latency_p95_by_bucket", f"""WITH {q.LOGS} SELECT service_name, {START} AS bucket_start, count(*) AS n_latency,
  {q.fixed('quantile_cont(latency_ms, 0.95)', 2)} AS latency_p95 FROM logs WHERE latency_ms IS NOT NULL GROUP BY 1, 2""")
def latency_p95(spark, sf):
    return rollup.latency_p95_by_bucket(views.event_logs(views.events(spark, sf)), BUCKET)


@query("http_5xx_rate_by_bucket", f"""WITH {q.LOGS} SELECT service_name, {START} AS bucket_start,
  CAST(sum(CASE WHEN status_code >= 500 THEN 1 ELSE 0 END) AS BIGINT) AS n_5xx, count(*) AS n_status,
  {q.fixed('100.0 * sum(CASE WHEN status_code >= 500 THEN 1 ELSE 0 END) / count(*)', 4)} AS http_5xx_rate
FROM logs WHERE status_code IS NOT NULL GROUP BY 1, 2""")
def http_5xx(spark, sf):
    return rollup.http_5xx_rate_by_bucket(views.event_logs(views.events(spark, sf)), BUCKET)


@query("aggregate_to_metrics", f"WITH {q.LOGS} SELECT * FROM ({q.log_metrics('5 minutes')})")
def aggregate(spark, sf):
    return rollup.aggregate_to_metrics(views.event_logs(views.events(spark, sf)))


def _profile_sql(bucket: str, where: str = "TRUE") -> str:
    start = f"time_bucket(INTERVAL '{bucket}', timestamp_dt)"
    return f"""SELECT service_name, {start} AS bucket_start, count(*) AS doc_count,
  count(*) FILTER (WHERE upper(level) IN ('ERROR','FATAL','CRITICAL')) AS error_count,
  count(*) FILTER (WHERE status_code >= 500) AS count_5xx, coalesce(avg(latency_ms), 0) AS avg_latency,
  coalesce(quantile_cont(latency_ms, 0.95), 0) AS p95_latency FROM logs WHERE {where} GROUP BY 1, 2"""


def _docs(spark, sf):
    return views.event_logs(views.events(spark, sf)).withColumn("log_level", F.upper("level"))


RANGE = "timestamp_dt >= TIMESTAMP '2024-01-03' AND timestamp_dt < TIMESTAMP '2024-01-28'"


@query("bucket_profile", f"""WITH {q.LOGS}, b AS ({_profile_sql(BUCKET, RANGE)})
SELECT service_name, bucket_start, doc_count, error_count, count_5xx, {q.fixed('avg_latency', 4)} AS avg_latency,
  {q.fixed('p95_latency', 4)} AS p95_latency FROM b""")
def bucket_profile(spark, sf):
    found = rollup.bucket_profile(
        _docs(spark, sf), F.lit("2024-01-03").cast("timestamp"), F.lit("2024-01-28").cast("timestamp"), bucket=BUCKET,
    )
    return found.withColumns({c: rounded(F.col(c), 4) for c in ("avg_latency", "p95_latency")})


TO_METRICS = f"""SELECT bucket_start AS timestamp, service_name, 'error_rate' AS metric_name,
    {q.fixed('100.0 * error_count / doc_count', 4)} AS metric_value, 'error_rate' AS metric_type, 'opensearch' AS source FROM b
  UNION ALL SELECT bucket_start, service_name, 'latency_p95', {q.fixed('p95_latency', 2)}, 'latency', 'opensearch' FROM b
    WHERE p95_latency > 0
  UNION ALL SELECT bucket_start, service_name, 'http_5xx_rate', {q.fixed('100.0 * count_5xx / doc_count', 4)}, 'error_rate',
    'opensearch' FROM b
  UNION ALL SELECT bucket_start, service_name, 'log_volume', CAST(doc_count AS DOUBLE), 'count', 'opensearch' FROM b"""


@query("buckets_to_metrics", f"WITH {q.LOGS}, b AS ({_profile_sql(BUCKET)}) {TO_METRICS}")
def buckets_to_metrics(spark, sf):
    return rollup.buckets_to_metrics(rollup.bucket_profile(_docs(spark, sf), bucket=BUCKET))


@query("ingest_docs", f"WITH {q.LOGS}, b AS ({_profile_sql('5 minutes')}) {TO_METRICS}")
def ingest_docs(spark, sf):
    return jobs.ingest_docs(_docs(spark, sf))


@query("scroll_to_metrics", f"""WITH {q.LOGS}, raw AS (SELECT * FROM logs WHERE event_id % 10 <> 3)
SELECT * FROM ({q.log_metrics(BUCKET, 'raw', source='opensearch')})""")
def scroll_to_metrics(spark, sf):
    """Documents with text-typed fields and some broken times."""
    docs = _docs(spark, sf).select(
        "service_name", "log_level",
        F.when(F.col("event_id") % 10 == 3, "broken")
        .otherwise(F.date_format("timestamp_dt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("timestamp"),
        F.coalesce(F.col("latency_ms").cast("string"), F.lit("nan")).alias("latency_ms"),
        F.coalesce(F.col("status_code").cast("string"), F.lit("None")).alias("status_code"),
    )
    return jobs.ingest_docs(docs, bucket=BUCKET, raw=True)


@query("ingest_logs", f"""WITH {q.PARSED}, parsed_only AS (SELECT * FROM parsed_logs WHERE parsed)
SELECT * FROM ({q.log_metrics('5 minutes', 'parsed_only')})""")
def ingest_logs(spark, sf):
    """Raw rows to metric rows: merge, parse, enrich, roll up."""
    return jobs.ingest_rows(views.event_rows(views.events(spark, sf)), ["service_name"])


@query("unpivot_buckets", f"WITH {q.LOGS}, b AS ({_profile_sql(BUCKET)}) {TO_METRICS}")
def unpivot(spark, sf):
    wide = rollup.bucket_profile(_docs(spark, sf), bucket=BUCKET)
    percent = {"error_rate": "error_count", "http_5xx_rate": "count_5xx"}
    values = {name: rounded(F.col(part) * 100.0 / F.col("doc_count"), 4) for name, part in percent.items()}
    values["latency_p95"] = F.when(F.col("p95_latency") > 0, rounded(F.col("p95_latency"), 2))
    values["log_volume"] = F.col("doc_count")
    return rollup.unpivot_buckets(wide, values, "opensearch")


@query("pivot_metrics", f"""WITH {q.metrics(BUCKET)} SELECT timestamp,
  {q.fixed("avg(metric_value) FILTER (WHERE metric_name = 'error_rate')", 4)} AS error_rate,
  {q.fixed("avg(metric_value) FILTER (WHERE metric_name = 'cpu_usage')", 4)} AS cpu_usage,
  {q.fixed("avg(metric_value) FILTER (WHERE metric_name = 'db_connections')", 4)} AS db_connections
FROM metrics GROUP BY timestamp""")
def pivot(spark, sf):
    names = ["error_rate", "cpu_usage", "db_connections"]
    wide = rollup.pivot_metrics(views.stored_metrics(views.events(spark, sf), BUCKET), names)
    return wide.select("timestamp", *[rounded(F.col(n), 4).alias(n) for n in names])


@query("metric_baselines", f"WITH {q.baselines(BUCKET)} SELECT {BASELINE_OUT_SQL} FROM baselines")
def metric_baselines(spark, sf):
    return rounded_baselines(baselines.metric_baselines(views.stored_metrics(views.events(spark, sf), BUCKET)))


@query("value_baselines", f"""WITH items AS (SELECT l_shipdate AS timestamp, l_returnflag AS service_name,
  l_linestatus AS metric_name, l_extendedprice AS metric_value FROM lineitem), stats AS ({q.statistics('items')})
SELECT {BASELINE_OUT_SQL} FROM stats QUALIFY sum(sample_count) OVER (PARTITION BY service_name) >= 100 AND sample_count >= 10""")
def value_baselines(spark, sf):
    """Baselines over a large value table with few, heavy groups."""
    items = views.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("timestamp"), F.col("l_returnflag").alias("service_name"),
        F.col("l_linestatus").alias("metric_name"), F.col("l_extendedprice").alias("metric_value"),
    )
    return rounded_baselines(baselines.metric_baselines(items))


RATE_STATS = f"""rates AS (SELECT service_name, 'error_rate' AS metric_name, timestamp_dt AS timestamp,
  100.0 * avg(CASE WHEN is_error THEN 1.0 ELSE 0.0 END) AS metric_value FROM minute_logs GROUP BY 1, 2, 3),
stats AS ({q.statistics('rates')})"""


def _hourly_logs(spark, sf):
    logs = views.event_logs(views.events(spark, sf))
    return logs.withColumn("timestamp_dt", F.date_trunc("hour", "timestamp_dt"))


@query("error_rate_baseline", f"""WITH {q.LOGS}, minute_logs AS (
  SELECT * REPLACE (date_trunc('hour', timestamp_dt) AS timestamp_dt) FROM logs), {RATE_STATS}
SELECT {BASELINE_OUT_SQL} FROM stats""")
def error_rate_baseline(spark, sf):
    return rounded_baselines(baselines.error_rate_baseline(_hourly_logs(spark, sf)))


LATENCY_STATS = f"""samples AS (SELECT service_name, 'latency_p95' AS metric_name, CAST(NULL AS TIMESTAMP) AS timestamp,
  latency_ms AS metric_value FROM logs WHERE latency_ms IS NOT NULL), lat AS ({q.statistics('samples')})"""


@query("latency_baseline", f"WITH {q.LOGS}, {LATENCY_STATS} SELECT {BASELINE_OUT_SQL} FROM lat")
def latency_baseline(spark, sf):
    return rounded_baselines(baselines.latency_baseline(views.event_logs(views.events(spark, sf))))


@query("compute_baselines", f"""WITH {q.baselines(BUCKET)}, minute_logs AS (
  SELECT * REPLACE (date_trunc('hour', timestamp_dt) AS timestamp_dt) FROM logs),
{RATE_STATS.replace('stats AS', 'rate_stats AS')}, {LATENCY_STATS}, all_ AS (
  SELECT * FROM baselines UNION ALL SELECT * FROM rate_stats UNION ALL SELECT * FROM lat)
SELECT {BASELINE_OUT_SQL} FROM all_""")
def compute_baselines(spark, sf):
    metrics = views.stored_metrics(views.events(spark, sf), BUCKET)
    return rounded_baselines(jobs.compute_baselines(metrics, _hourly_logs(spark, sf)))


@query("latest_baseline", f"""WITH {q.LOGS}, metrics AS ({q.log_metrics(BUCKET)}), weekly AS (
  SELECT service_name, metric_name, time_bucket(INTERVAL '7 days', timestamp) AS created_at, avg(metric_value) AS mean,
    count(*) AS sample_count, min(timestamp) AS window_start FROM metrics GROUP BY 1, 2, 3)
SELECT service_name, metric_name, {q.fixed('mean', 4)} AS mean, sample_count, created_at FROM weekly
QUALIFY row_number() OVER (PARTITION BY service_name, metric_name ORDER BY created_at DESC) = 1""")
def latest_baseline(spark, sf):
    """Weekly baselines of every series, the newest one kept."""
    metrics = views.log_metrics(views.events(spark, sf), BUCKET)
    # The SQL side aligns weeks to Monday 2000-01-03, which is four days off the epoch's Thursday.
    week = F.window("timestamp", "7 days", "7 days", "4 days")["start"]
    weekly = metrics.groupBy("service_name", "metric_name", week.alias("created_at")).agg(
        F.avg("metric_value").alias("mean"), F.count(F.lit(1)).alias("sample_count"),
        F.min("timestamp").alias("window_start"),
    )
    newest = baselines.latest_baseline(weekly)
    return newest.select("service_name", "metric_name", rounded(F.col("mean"), 4).alias("mean"), "sample_count", "created_at")


@query("latest_readings", f"""WITH {q.metrics(BUCKET)} SELECT timestamp, service_name, metric_name, metric_value FROM metrics
WHERE source = 'logs' QUALIFY row_number() OVER (PARTITION BY service_name ORDER BY timestamp DESC, metric_name) <= 50""")
def latest_readings(spark, sf):
    metrics = views.stored_metrics(views.events(spark, sf), BUCKET)
    return detect.latest_readings(metrics, 50, "logs").select("timestamp", "service_name", "metric_name", "metric_value")


@query("join_latest_baseline", f"""WITH {q.baselines(BUCKET, 600)} SELECT m.timestamp, m.service_name, m.metric_name, m.metric_value,
  {q.fixed('b.mean', 4)} AS baseline_mean, {q.fixed('b.stddev', 4)} AS baseline_stddev
FROM metrics m JOIN baselines b USING (service_name, metric_name)""")
def join_baseline(spark, sf):
    metrics = views.stored_metrics(views.events(spark, sf), BUCKET)
    joined = detect.join_latest_baseline(metrics, baselines.metric_baselines(metrics, 600))
    return joined.select(
        "timestamp", "service_name", "metric_name", "metric_value",
        rounded(F.col("baseline_mean"), 4).alias("baseline_mean"),
        rounded(F.col("baseline_stddev"), 4).alias("baseline_stddev"),
    )


SEMI_GATE = 780


@query("services_with_baseline", f"""WITH {q.baselines(BUCKET, SEMI_GATE)} SELECT timestamp, service_name, metric_name FROM metrics m
WHERE EXISTS (SELECT 1 FROM baselines b WHERE b.service_name = m.service_name)""")
def services_with_baseline(spark, sf):
    metrics = views.stored_metrics(views.events(spark, sf), BUCKET)
    kept = detect.services_with_baseline(metrics, baselines.metric_baselines(metrics, SEMI_GATE))
    return kept.select("timestamp", "service_name", "metric_name")


def _anomaly_sql(head: str) -> str:
    return f"""WITH {head} SELECT timestamp, service_name, metric_name, value, {q.fixed('baseline_mean', 4)} AS baseline_mean,
  {q.fixed('zscore', 4)} AS zscore, CASE WHEN abs(zscore) >= 4 THEN 'high' ELSE 'medium' END AS severity, source FROM anomalies"""


def _rounded_anomalies(found):
    return found.withColumns({c: rounded(F.col(c), 4) for c in ("baseline_mean", "zscore")})


@query("detect_anomalies", _anomaly_sql(q.anomalies(BUCKET)))
def detect_anomalies(spark, sf):
    metrics = views.stored_metrics(views.events(spark, sf), BUCKET)
    return _rounded_anomalies(detect.detect_anomalies(metrics, baselines.metric_baselines(metrics)))


@query("detect_anomalies_infra", _anomaly_sql(
    q.anomalies(BUCKET, 2.5).replace(q.metrics(BUCKET), f"{q.EV}, metrics AS ({q.infra_metrics(BUCKET)})")
))
def detect_anomalies_infra(spark, sf):
    """Without log-derived readings all other readings are scanned."""
    metrics = materialize(views.infra_metrics(views.events(spark, sf), BUCKET), "metrics")
    return _rounded_anomalies(detect.detect_anomalies(metrics, baselines.metric_baselines(metrics), sigma=2.5))


def _incidents(spark, sf, sigma=3.0):
    metrics = views.stored_metrics(views.events(spark, sf), BUCKET)
    return detect.incidents_from_anomalies(
        detect.detect_anomalies(metrics, baselines.metric_baselines(metrics), sigma)
    )


@query("incidents_from_anomalies", f"WITH {q.incidents(BUCKET)} SELECT * FROM found")
def incidents(spark, sf):
    return _incidents(spark, sf).select(
        "timestamp", "service_name", "incident_type", "severity", "description", "affected_metrics", "confidence_score"
    )


@query("create_incidents", f"""WITH {q.incidents(BUCKET)} SELECT timestamp, service_name, incident_type, severity, confidence_score
FROM found WHERE severity <> 'low'""")
def create_incidents(spark, sf):
    """The incidents of a run next to those an earlier run stored: only new keys are added."""
    metrics = views.stored_metrics(views.events(spark, sf), BUCKET)
    anomalies = materialize(detect.detect_anomalies(metrics, baselines.metric_baselines(metrics)), "anomalies")
    earlier = detect.incidents_from_anomalies(anomalies).where("severity = 'low'")
    return detect.create_incidents(anomalies, earlier).select(
        "timestamp", "service_name", "incident_type", "severity", "confidence_score"
    )


@query("run_summary", f"""WITH {q.incidents(BUCKET)}, {q.EVENT_INCIDENTS.split('), base AS', 1)[1].join(['base AS', ''])}
SELECT (SELECT count(*) FROM anomalies) AS anomalies, (SELECT count(*) FROM found) AS incidents_created,
  count(*) AS incidents_total, count(root_cause) AS diagnosed, count(*) - count(root_cause) AS undiagnosed FROM incidents""")
def run_summary(spark, sf):
    ev = views.events(spark, sf)
    metrics = views.stored_metrics(ev, BUCKET)
    anomalies = materialize(detect.detect_anomalies(metrics, baselines.metric_baselines(metrics)), "anomalies")
    return detect.run_summary(anomalies, detect.incidents_from_anomalies(anomalies), views.event_incidents(ev))


GRID = """grid AS (SELECT g.timestamp, s.service_name, m.metric_name FROM (SELECT DISTINCT service_name FROM ev) s,
  (SELECT unnest(generate_series(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-09' - INTERVAL 1 MICROSECOND,
    INTERVAL 6 HOUR)) AS timestamp) g,
  (SELECT unnest(['error_rate', 'latency_p95']) AS metric_name) m)"""


def _grid(ev):
    return timeseries.time_grid(
        ev.select("service_name").distinct(), ["error_rate", "latency_p95"], F.lit("2024-01-02").cast("timestamp"),
        F.lit("2024-01-09").cast("timestamp"), step_minutes=360,
    )


@query("time_grid", f"WITH {q.EV}, {GRID} SELECT * FROM grid")
def time_grid(spark, sf):
    return _grid(views.events(spark, sf))


@query("grid_gaps", f"""WITH {q.LOGS}, metrics AS ({q.log_metrics('1 hour')}), {GRID}
SELECT * FROM grid g WHERE NOT EXISTS (SELECT 1 FROM metrics m WHERE m.timestamp = g.timestamp
  AND m.service_name = g.service_name AND m.metric_name = g.metric_name)""")
def grid_gaps(spark, sf):
    ev = views.events(spark, sf)
    return timeseries.grid_gaps(_grid(ev), views.log_metrics(ev, "1 hour"))


@query("override_in_windows", f"""WITH {q.metrics('1 hour')}, {q.LABELS}, o AS (
  SELECT service_name, 'latency_p95' AS metric_name, window_start, window_end + INTERVAL 6 HOUR AS window_end,
    CAST(gt_pos AS DOUBLE) AS new_value, gt_pos AS priority FROM labels_)
SELECT m.timestamp, m.service_name, m.metric_name, coalesce(arg_max(o.new_value, o.priority), any_value(m.metric_value)) AS metric_value
FROM metrics m LEFT JOIN o ON m.service_name = o.service_name AND m.metric_name = o.metric_name
  AND m.timestamp BETWEEN o.window_start AND o.window_end GROUP BY 1, 2, 3""")
def override(spark, sf):
    ev = views.events(spark, sf)
    windows = views.event_labels(ev).select(
        "service_name", F.lit("latency_p95").alias("metric_name"), "window_start",
        (F.col("window_end") + F.expr("interval 6 hours")).alias("window_end"),
        F.col("gt_pos").cast("double").alias("new_value"), F.col("gt_pos").alias("priority"),
    )
    metrics = views.event_metrics(ev, "1 hour").select("timestamp", "service_name", "metric_name", "metric_value")
    return timeseries.override_in_windows(metrics, windows)


@query("sub_windows", f"""WITH {q.EV}, {q.LABELS}, s AS (SELECT gt_pos, window_start AS s, window_end + INTERVAL 95 MINUTE AS e FROM labels_),
p AS (SELECT gt_pos, e, unnest(generate_series(s, e - INTERVAL 1 MICROSECOND, INTERVAL 1 HOUR)) AS win_start FROM s)
SELECT gt_pos, win_start, least(win_start + INTERVAL 1 HOUR, e) AS win_end FROM p""")
def sub_windows(spark, sf):
    spans = views.event_labels(views.events(spark, sf)).select(
        "gt_pos", F.col("window_start").alias("s"), (F.col("window_end") + F.expr("interval 95 minutes")).alias("e")
    )
    return timeseries.sub_windows(spans, "s", "e").select("gt_pos", "win_start", "win_end")
