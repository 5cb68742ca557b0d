"""Queries of diagnosis, evaluation and reports."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.functions.scores import rounded
from triagelake.operators import diagnose, evaluation, reports
from triagelake.operators.baselines import metric_baselines
from triagelake.plans import event_views as views
from triagelake.plans import jobs
from triagelake.plans import sql_views as q
from triagelake.plans.catalog_tables import BASELINE_OUT_SQL, rounded_baselines
from triagelake.plans.registry import query
from triagelake.session import materialize

HOUR = "1 hour"
AROUND = 360
AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"

# Baselines over hourly series, pending incidents and the readings around them.
EVENT_BASE = q.baselines(HOUR) + ", base AS" + q.EVENT_INCIDENTS.split(", base AS", 1)[1]
PENDING = EVENT_BASE + ", pending AS (SELECT * FROM incidents WHERE NOT resolved AND root_cause IS NULL)"
DIAGNOSIS = PENDING + q.diagnosis("pending", "6 HOUR", 1.0)


def _inputs(spark, sf):
    ev = views.events(spark, sf)
    metrics = views.stored_metrics(ev, HOUR)
    return views.event_incidents(ev), metrics, materialize(metric_baselines(metrics), "baselines")


def _window(spark, sf):
    incidents, metrics, baselines = _inputs(spark, sf)
    return diagnose.incident_metric_window(diagnose.pending_incidents(incidents), metrics, AROUND), baselines


@query("pending_incidents", f"""WITH {q.EVENT_INCIDENTS} SELECT id, timestamp, service_name, incident_type, severity FROM incidents
WHERE NOT resolved AND root_cause IS NULL""")
def pending(spark, sf):
    return reports.list_pending(views.event_incidents(views.events(spark, sf)))


@query("incident_metric_window", f"WITH {DIAGNOSIS} SELECT * FROM win")
def window(spark, sf):
    return _window(spark, sf)[0]


@query("window_metric_mean", f"""WITH {DIAGNOSIS} SELECT incident_id, service_name, metric_name,
  {q.fixed('window_mean', 4)} AS window_mean, {q.fixed('z_mean', 4)} AS z_mean, {q.fixed('z_max_abs', 4)} AS z_max_abs FROM scored""")
def window_mean(spark, sf):
    scored = diagnose.window_metric_mean(*_window(spark, sf))
    return scored.withColumns({c: rounded(F.col(c), 4) for c in ("window_mean", "z_mean", "z_max_abs")})


@query("elevated_infra", f"""WITH {DIAGNOSIS} SELECT incident_id, service_name, metric_name, {q.fixed('window_mean', 4)} AS window_mean,
  {q.fixed('z', 2)} AS zscore FROM elevated""")
def elevated(spark, sf):
    found = diagnose.elevated_infra(*_window(spark, sf), sigma=1.0)
    return found.withColumn("window_mean", rounded(F.col("window_mean"), 4))


@query("elevated_infra_max", f"""WITH {PENDING + q.diagnosis('pending', '6 HOUR', 2.0, 'max_abs')}
SELECT incident_id, service_name, metric_name, {q.fixed('z', 2)} AS zscore FROM elevated""")
def elevated_max(spark, sf):
    return diagnose.elevated_infra(*_window(spark, sf), sigma=2.0, elevated_by="max_abs").drop("window_mean")


@query("match_rule", f"WITH {DIAGNOSIS} SELECT incident_id, array_to_string(names, ',') AS elevated, rule, primary_metric FROM prim")
def match_rule(spark, sf):
    window, baselines = _window(spark, sf)
    ruled = diagnose.match_rule(window, diagnose.elevated_infra(window, baselines, sigma=1.0))
    return ruled.select("incident_id", "elevated", F.col("rule.name").alias("rule"), "primary_metric")


def _pairs(spark, sf):
    window, baselines = _window(spark, sf)
    ruled = diagnose.match_rule(window, diagnose.elevated_infra(window, baselines, sigma=1.0))
    return diagnose.co_observed_pairs(window, ruled.select("incident_id", "primary_metric"))


@query("co_observed_pairs", f"WITH {DIAGNOSIS} SELECT * FROM co")
def co_observed(spark, sf):
    return _pairs(spark, sf)


@query("correlated_metrics", f"WITH {DIAGNOSIS} SELECT incident_id, primary_metric, metric_name, n, {q.fixed('r', 4)} AS r FROM correlated")
def correlated(spark, sf):
    return diagnose.correlated_metrics(_pairs(spark, sf)).withColumn("r", rounded(F.col("r"), 4))


@query("diagnose_incidents", f"""WITH {DIAGNOSIS} SELECT incident_id AS id, rule, scenario, primary_metric,
  array_to_string(names, ',') AS elevated, array_to_string(listed, ',') AS correlated, {q.CAUSE_TEXT} AS root_cause FROM causes""")
def diagnosed(spark, sf):
    incidents, metrics, baselines = _inputs(spark, sf)
    return diagnose.diagnose_incidents(incidents, metrics, baselines, AROUND, sigma=1.0)


TRIAGE = q.incidents("6 hours") + ", keyed AS (SELECT *, service_name AS id FROM found)" + q.diagnosis("keyed", "24 HOUR", 1.0)


@query("triage", f"""WITH {TRIAGE} SELECT k.timestamp, k.service_name, k.incident_type, k.severity, k.confidence_score,
  {q.CAUSE_TEXT} AS root_cause FROM keyed k LEFT JOIN causes c ON c.incident_id = k.id""")
def triage(spark, sf):
    """Events to diagnosed incidents in one plan."""
    metrics = views.event_metrics(views.events(spark, sf), "6 hours")
    done = jobs.triage(metrics, window_minutes=24 * 60, elevated_sigma=1.0)
    return done.select("timestamp", "service_name", "incident_type", "severity", "confidence_score", "root_cause")


def _matched(spark, sf):
    ev = views.events(spark, sf)
    incidents, labels = views.event_incidents(ev), views.event_labels(ev)
    return incidents, labels, evaluation.match_ground_truth(incidents, labels)


@query("match_ground_truth", f"WITH {q.PAIRS} SELECT * FROM pairs")
def match_labels(spark, sf):
    return _matched(spark, sf)[2]


@query("match_ground_truth_type", f"""WITH {q.PAIRS} SELECT p.* FROM pairs p JOIN labels_ g USING (gt_pos)
WHERE p.incident_type = g.incident_type""")
def match_labels_type(spark, sf):
    ev = views.events(spark, sf)
    return evaluation.match_ground_truth(views.event_incidents(ev), views.event_labels(ev), match_type=True)


@query("first_label", f"WITH {q.PAIRS} SELECT * FROM credited")
def first_label(spark, sf):
    return evaluation.first_label(_matched(spark, sf)[2])


@query("matched_incidents", f"WITH {q.PAIRS} SELECT id, timestamp, service_name FROM incidents WHERE id IN (SELECT id FROM pairs)")
def matched_incidents(spark, sf):
    incidents, _, pairs = _matched(spark, sf)
    return evaluation.matched_incidents(incidents, pairs).select("id", "timestamp", "service_name")


@query("unmatched_incidents", f"WITH {q.PAIRS} SELECT id, timestamp, service_name FROM incidents WHERE id NOT IN (SELECT id FROM pairs)")
def unmatched_incidents(spark, sf):
    incidents, _, pairs = _matched(spark, sf)
    return evaluation.unmatched_incidents(incidents, pairs).select("id", "timestamp", "service_name")


MISSED = f"""WITH {q.PAIRS} SELECT gt_pos, service_name, window_start, window_end FROM labels_
WHERE gt_pos NOT IN (SELECT gt_pos FROM credited)"""


@query("missed_ground_truth", MISSED)
def missed(spark, sf):
    _, labels, pairs = _matched(spark, sf)
    return evaluation.missed_ground_truth(labels, evaluation.first_label(pairs)).select(
        "gt_pos", "service_name", "window_start", "window_end"
    )


@query("labels_not_matched", f"""WITH {q.PAIRS} SELECT gt_pos FROM labels_ EXCEPT ALL SELECT gt_pos FROM (
  SELECT DISTINCT gt_pos FROM credited)""")
def not_matched(spark, sf):
    _, labels, pairs = _matched(spark, sf)
    credited = evaluation.first_label(pairs).select("gt_pos").distinct()
    return labels.select("gt_pos").exceptAll(credited)


SCORES = """coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS r"""


def _scores_sql(key: str) -> str:
    select = f"{key}, " if key else ""
    group = f"GROUP BY {key}" if key else ""
    return f"""flags AS (
  SELECT service_name, 'label' AS kind, gt_pos IN (SELECT gt_pos FROM credited) AS hit FROM labels_
  UNION ALL SELECT service_name, 'incident', id IN (SELECT id FROM credited) FROM incidents), counts AS (
  SELECT {select}count(*) FILTER (WHERE kind = 'label') AS ground_truth_count,
    count(*) FILTER (WHERE kind = 'incident') AS detected_count, count(*) FILTER (WHERE kind = 'label' AND hit) AS tp,
    count(*) FILTER (WHERE kind = 'incident' AND NOT hit) AS fp, count(*) FILTER (WHERE kind = 'label' AND NOT hit) AS fn
  FROM flags {group}), rates AS (SELECT *, {SCORES} FROM counts)
SELECT {select}ground_truth_count, detected_count, tp, fp, fn, {q.fixed('p', 4)} AS precision, {q.fixed('r', 4)} AS recall,
  {q.fixed('coalesce(2 * p * r / nullif(p + r, 0), 0)', 4)} AS f1 FROM rates"""


@query("evaluate_detections", f"WITH {q.PAIRS}, {_scores_sql('')}")
def evaluate_detections(spark, sf):
    incidents, labels, pairs = _matched(spark, sf)
    return evaluation.evaluate_detections(incidents, labels, evaluation.first_label(pairs))


@query("evaluate_by_service", f"WITH {q.PAIRS}, {_scores_sql('service_name')}")
def evaluate_by_service(spark, sf):
    incidents, labels, pairs = _matched(spark, sf)
    return evaluation.evaluate_by_service(incidents, labels, evaluation.first_label(pairs))


@query("evaluate", f"WITH {q.PAIRS}, {_scores_sql('')}")
def evaluate(spark, sf):
    """The whole report, written part by part; its stored summary is read back."""
    from triagelake.session import scratch_path
    from triagelake.sources.tables import read_evaluation_summary, write_evaluation_report

    ev = views.events(spark, sf)
    path = scratch_path(spark, "evaluation")
    write_evaluation_report(jobs.evaluate(views.event_incidents(ev), views.event_labels(ev)), path)
    return read_evaluation_summary(spark, path).drop("status")


@query("union_distinct_services", f"""WITH {q.EVENT_INCIDENTS}, {q.LABELS} SELECT service_name FROM incidents
UNION SELECT service_name FROM labels_""")
def union_services(spark, sf):
    incidents, labels, _ = _matched(spark, sf)
    return evaluation.union_distinct_services(incidents, labels)


RECENT = f"timestamp_dt >= {AS_OF} - INTERVAL 2 DAY"


def _logs(spark, sf):
    ev = views.events(spark, sf)
    return views.event_logs(ev), views.as_of(ev)


@query("service_error_rate", f"""WITH {q.LOGS} SELECT service_name, count(*) AS total_logs,
  count(*) FILTER (WHERE is_error) AS error_count, {q.fixed('100.0 * count(*) FILTER (WHERE is_error) / count(*)', 4)} AS error_rate
FROM logs WHERE {RECENT} GROUP BY service_name""")
def service_error_rate(spark, sf):
    logs, as_of = _logs(spark, sf)
    found = reports.service_error_rate(logs, as_of, 2 * 24 * 60)
    return found.withColumn("error_rate", rounded(F.col("error_rate"), 4))


@query("service_latency_percentile", f"""WITH {q.LOGS} SELECT service_name, {q.fixed('quantile_cont(latency_ms, 0.95)', 4)} AS p95
FROM logs WHERE {RECENT} AND latency_ms IS NOT NULL GROUP BY service_name""")
def service_latency(spark, sf):
    logs, as_of = _logs(spark, sf)
    found = reports.service_latency_percentile(logs, as_of, 95, 2 * 24 * 60, exact=True)
    return found.withColumn("p95", rounded(F.col("p95"), 4))


@query("service_latency_percentile_approx", f"""WITH {q.LOGS} SELECT service_name, quantile_disc(latency_ms, 0.99) AS p99
FROM logs WHERE {RECENT} AND latency_ms IS NOT NULL GROUP BY service_name""")
def service_latency_approx(spark, sf):
    """Up to some thousand values the sketch holds them all, so its answer is one of them."""
    logs, as_of = _logs(spark, sf)
    return reports.service_latency_percentile(logs, as_of, 99, 2 * 24 * 60)


@query("discover_services", f"WITH {q.EV} SELECT DISTINCT service_name FROM ev")
def discover_services(spark, sf):
    return reports.discover_services(_logs(spark, sf)[0])


@query("top_services", f"""WITH {q.LOGS} SELECT service_name, count(*) AS doc_count FROM logs
WHERE timestamp_dt BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' GROUP BY service_name
ORDER BY doc_count DESC, service_name LIMIT 5""")
def top_services(spark, sf):
    return reports.top_services(
        _logs(spark, sf)[0], F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-20").cast("timestamp"), size=5,
    )


@query("log_count", f"WITH {q.LOGS} SELECT count(*) AS total FROM logs WHERE {RECENT} AND service_name = 'svc-1'")
def log_count(spark, sf):
    logs, as_of = _logs(spark, sf)
    return reports.log_count(logs, as_of, 2 * 24 * 60, "svc-1")


def _event_incidents(spark, sf):
    return views.event_incidents(views.events(spark, sf))


KPIS = """SELECT count(*) AS total, count(*) FILTER (WHERE severity = 'critical') AS critical,
  count(*) FILTER (WHERE severity = 'high') AS high, count(*) FILTER (WHERE severity = 'medium') AS medium,
  count(*) FILTER (WHERE severity = 'low') AS low, count(*) FILTER (WHERE resolved) AS resolved,
  """ + q.fixed("avg(confidence_score)", 4) + " AS avg_confidence FROM incidents"


@query("incident_kpis", f"WITH {q.EVENT_INCIDENTS} {KPIS}")
def incident_kpis(spark, sf):
    found = reports.incident_kpis(_event_incidents(spark, sf))
    return found.withColumn("avg_confidence", rounded(F.col("avg_confidence"), 4))


OPEN = """SELECT service_name, count(*) AS open_incidents,
  ['low','medium','high','critical'][max(list_position(['low','medium','high','critical'], severity))] AS worst_severity
FROM incidents WHERE NOT resolved GROUP BY service_name"""


@query("open_incidents_by_service", f"WITH {q.EVENT_INCIDENTS} {OPEN}")
def open_incidents(spark, sf):
    return reports.open_incidents_by_service(_event_incidents(spark, sf))


TREND = f"""SELECT date_trunc('hour', timestamp) AS "hour", count(*) AS "count" FROM incidents
WHERE timestamp >= {AS_OF} - INTERVAL 24 HOUR GROUP BY 1"""


@query("incident_trend_hourly", f"WITH {q.EVENT_INCIDENTS} {TREND}")
def trend(spark, sf):
    ev = views.events(spark, sf)
    return reports.incident_trend_hourly(views.event_incidents(ev), views.as_of(ev))


@query("metrics_by_source", f"WITH {q.metrics('6 hours')} SELECT source, count(*) AS n FROM metrics GROUP BY source")
def by_source(spark, sf):
    return reports.metrics_by_source(views.event_metrics(views.events(spark, sf), "6 hours"))


@query("severity_mix", f'WITH {q.EVENT_INCIDENTS} SELECT severity, count(*) AS "count" FROM incidents GROUP BY severity')
def severity_mix(spark, sf):
    return reports.severity_mix(_event_incidents(spark, sf))


@query("incident_timeline", f"""WITH {q.EVENT_INCIDENTS} SELECT date_trunc('hour', timestamp) AS "hour", severity, count(*) AS "count"
FROM incidents GROUP BY 1, 2""")
def timeline(spark, sf):
    return reports.incident_timeline(_event_incidents(spark, sf))


@query("incidents_by_service_severity", f"""WITH {q.EVENT_INCIDENTS} SELECT service_name, severity, count(*) AS "count" FROM incidents
WHERE (SELECT count(DISTINCT service_name) FROM incidents) > 1 GROUP BY 1, 2""")
def by_service_severity(spark, sf):
    return reports.incidents_by_service_severity(_event_incidents(spark, sf))


@query("list_incidents", f"""WITH {q.EVENT_INCIDENTS} SELECT id, timestamp, service_name, severity, root_cause FROM incidents
WHERE NOT resolved ORDER BY timestamp DESC, id LIMIT 100""")
def list_incidents(spark, sf):
    listed = reports.list_incidents(_event_incidents(spark, sf), 100, status="open")
    return listed.select("id", "timestamp", "service_name", "severity", "root_cause")


@query("list_metrics", f"""WITH {q.metrics('6 hours')} SELECT timestamp, service_name, metric_name, metric_value, source FROM metrics
WHERE timestamp >= {AS_OF} - INTERVAL 72 HOUR AND service_name = 'svc-4' ORDER BY timestamp, metric_name""")
def list_metrics(spark, sf):
    ev = views.events(spark, sf)
    return reports.list_metrics(views.event_metrics(ev, "6 hours"), views.as_of(ev), 72, "svc-4")


@query("list_baselines", f"WITH {q.baselines('6 hours')} SELECT {BASELINE_OUT_SQL} FROM baselines WHERE service_name = 'svc-5'")
def list_baselines(spark, sf):
    metrics = views.stored_metrics(views.events(spark, sf), "6 hours")
    stored = metric_baselines(metrics).withColumn("created_at", F.lit("2024-02-01").cast("timestamp"))
    return rounded_baselines(reports.list_baselines(stored, "svc-5"))


NEWEST = "(SELECT max(id) FROM incidents)"


@query("incident_detail", f"""WITH {EVENT_BASE}, one AS (SELECT * FROM incidents WHERE id = {NEWEST})
SELECT m.timestamp, m.metric_name, m.metric_value, m.source, {q.fixed('b.mean', 4)} AS mean, {q.fixed('b.p95', 4)} AS p95,
  b.sample_count
FROM one o JOIN metrics m ON m.service_name = o.service_name
  AND m.timestamp BETWEEN o.timestamp - INTERVAL 90 MINUTE AND o.timestamp + INTERVAL 90 MINUTE
LEFT JOIN baselines b ON b.service_name = m.service_name AND b.metric_name = m.metric_name""")
def incident_detail(spark, sf):
    """The newest incident: readings around it, each with the newest baseline of its series."""
    incidents, metrics, baselines = _inputs(spark, sf)
    newest = incidents.agg(F.max("id").alias("id")).scalar()
    stamped = baselines.withColumn("created_at", F.lit("2024-02-01").cast("timestamp"))
    parts = reports.incident_detail(incidents, metrics, stamped, newest)
    joined = parts["metrics"].join(parts["baselines"], "metric_name", "left")
    return joined.select(
        "timestamp", "metric_name", "metric_value", "source", rounded(F.col("mean"), 4).alias("mean"),
        rounded(F.col("p95"), 4).alias("p95"), "sample_count",
    )


@query("summary_report", f"""WITH {q.EVENT_INCIDENTS.replace(q.EV, q.LOGS, 1)}, kpis AS ({KPIS}), open_ AS ({OPEN}), trend AS ({TREND})
SELECT 'totals' AS part, 'total' AS item, CAST(total AS DOUBLE) AS value FROM kpis
UNION ALL SELECT 'totals', name, CAST(n AS DOUBLE) FROM (UNPIVOT (
  SELECT critical, high, medium, low, resolved FROM kpis) ON critical, high, medium, low, resolved INTO NAME name VALUE n)
UNION ALL SELECT 'totals', 'avg_confidence', avg_confidence FROM kpis
UNION ALL SELECT 'metric_sources', source, CAST(count(*) AS DOUBLE) FROM ({q.log_metrics('6 hours')}) GROUP BY source
UNION ALL SELECT 'services', service_name || '/' || worst_severity, CAST(open_incidents AS DOUBLE) FROM open_
UNION ALL SELECT 'trend', strftime("hour", '%Y-%m-%dT%H:%M:%S'), CAST("count" AS DOUBLE) FROM trend""")
def summary(spark, sf):
    """The parts of the summary as (part, item, value) rows."""
    ev = views.events(spark, sf)
    parts = reports.summary_report(views.event_incidents(ev), views.log_metrics(ev, "6 hours"), views.as_of(ev))

    def rows(part, item, value):
        return parts[part].select(
            F.lit(part).alias("part"), item.alias("item"), value.cast("double").alias("value")
        )

    counts = ["total", "critical", "high", "medium", "low", "resolved"]
    return (
        reduce(DataFrame.unionByName, [rows("totals", F.lit(name), F.col(name)) for name in counts])
        .unionByName(rows("metric_sources", F.col("source"), F.col("n")))
        .unionByName(rows("totals", F.lit("avg_confidence"), rounded(F.col("avg_confidence"), 4)))
        .unionByName(rows("services", F.concat_ws("/", "service_name", "worst_severity"), F.col("open_incidents")))
        .unionByName(rows("trend", F.date_format("hour", "yyyy-MM-dd'T'HH:mm:ss"), F.col("count")))
    )


@query("sql", f"""WITH {q.EVENT_INCIDENTS} SELECT service_name, severity, count(*) AS n FROM incidents
WHERE confidence_score >= 0.4 GROUP BY 1, 2""")
def ad_hoc_sql(spark, sf):
    return jobs.sql(
        spark,
        "SELECT service_name, severity, count(*) AS n FROM triage_incidents WHERE confidence_score >= :least GROUP BY 1, 2",
        {"triage_incidents": _event_incidents(spark, sf)}, {"least": 0.4},
    )


@query("run_all", f"""WITH {q.incidents('6 hours')} SELECT timestamp, service_name, incident_type, severity, confidence_score FROM found""")
def run_all(spark, sf):
    """Every stage written to tables below the shared folder; the stored incidents are read back."""
    from triagelake.session import scratch_path
    from triagelake.sources.tables import read_incidents

    ev = views.events(spark, sf)
    paths = jobs.run_all(
        spark, scratch_path(spark, "run"), 1, extra_metrics=views.event_metrics(ev, "6 hours"), bucket="6 hours",
    )
    return read_incidents(spark, paths["incidents"]).select(
        "timestamp", "service_name", "incident_type", "severity", "confidence_score"
    )

