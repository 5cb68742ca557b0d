"""Queries of the streaming forms, each run over a stored table until it is used up."""

from triagelake.operators import baselines
from triagelake.plans import event_views as views
from triagelake.plans import sql_views as q
from triagelake.plans.catalog_rollup import _anomaly_sql, _rounded_anomalies
from triagelake.plans.registry import query
from triagelake.session import materialize, scratch_path
from triagelake.streaming import streams

BUCKET = "6 hours"


def _run(stream, schema):
    """Process a stream into a folder below the shared one and read that folder."""
    spark = stream.sparkSession
    out = scratch_path(spark, "stream")
    streams.append_to_table(stream, out, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema(schema or stream.schema).parquet(out)


def _as_stream(df, name):
    """A stored copy of a table, read as a stream."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


@query("rollup_stream", f"""WITH {q.LOGS} SELECT * FROM ({q.log_metrics(BUCKET, quantile='quantile_disc')})
WHERE timestamp + INTERVAL 6 HOUR <= (SELECT max(timestamp_dt) FROM logs) - INTERVAL 10 MINUTE""")
def rollup_stream(spark, sf):
    """Buckets closed by the watermark. Up to some thousand values the latency sketch holds them all."""
    logs = views.event_logs(views.events(spark, sf)).drop("event_id")
    return _run(streams.rollup_stream(_as_stream(logs, "stream-logs"), bucket=BUCKET), None)


@query("detect_stream", _anomaly_sql(q.anomalies(BUCKET)))
def detect_stream(spark, sf):
    """Log metrics as a stream against stored baselines."""
    ev = views.events(spark, sf)
    metrics = views.stored_metrics(ev, BUCKET)
    known = materialize(baselines.metric_baselines(metrics), "baselines")
    stream = _as_stream(metrics.where("source = 'logs'"), "stream-metrics")
    return _rounded_anomalies(_run(streams.detect_stream(stream, known), None))


@query("first_incidents_stream", f"""WITH {q.anomalies(BUCKET, 2.0)}, ordered AS (
  SELECT *, CASE WHEN timestamp - lag(timestamp) OVER w <= INTERVAL 20 HOUR THEN 0 ELSE 1 END AS opens
  FROM anomalies WINDOW w AS (PARTITION BY service_name ORDER BY timestamp, metric_name)), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY service_name ORDER BY timestamp, metric_name) AS run FROM ordered), runs AS (
  SELECT service_name, min(timestamp) AS timestamp, max(timestamp) AS last, max(abs(zscore)) AS max_z,
    list(DISTINCT metric_name) AS affected FROM numbered GROUP BY service_name, run)
SELECT timestamp, service_name, {q.INCIDENT_TYPE.format('affected')} AS incident_type,
  {q.SEVERITY.format('max_z')} AS severity, {q.fixed('least(max_z / 6.0, 1.0)', 3)} AS confidence_score
FROM runs WHERE last + INTERVAL 40 HOUR <= (SELECT max(timestamp) FROM anomalies)""")
def first_incidents_stream(spark, sf):
    """Runs of anomalies with at most 20 hours between them, as far as the watermark has passed them."""
    ev = views.events(spark, sf)
    metrics = views.stored_metrics(ev, BUCKET)
    known = materialize(baselines.metric_baselines(metrics), "baselines")
    anomalies = streams.detect_stream(metrics.where("source = 'logs'"), known, 2.0)
    return _run(streams.first_incidents_stream(_as_stream(anomalies, "stream-anomalies"), "20 hours"), None)
