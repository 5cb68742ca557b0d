"""Queries of the scalar functions: text, times, scores, labels and filters."""

from pyspark.sql import functions as F

from triagelake.functions import scores, text, times
from triagelake.functions.scores import rounded
from triagelake.operators import reports
from triagelake.plans import event_views as views
from triagelake.plans import sql_views as q
from triagelake.plans.registry import query
from triagelake.sources.cloud import explode_datapoints, normalize_cloud_metric
from triagelake.sources.log_files import parse_entries

S = text.strip


@query("strip_ansi", f"WITH {q.LINES} SELECT event_id, {q.clean('message')} AS message FROM lines")
def strip_ansi(spark, sf):
    lines = views.event_lines(views.events(spark, sf))
    return lines.select("event_id", text.strip_ansi(S(F.col("message"))).alias("message"))


@query("parse_log_line", f"""WITH {q.LINES}, c AS (SELECT event_id, {q.clean('message')} AS clean FROM lines)
SELECT event_id, lower({q.part(1)}) AS level, {q.part(2)} AS correlation_id, {q.part(3)} AS tenant_id,
  {q.part(4)} AS req_id, {q.part(5)} AS timestamp, {q.part(6)} AS log_text
FROM c WHERE regexp_matches(clean, '{q.LINE}')""")
def parse_log_line(spark, sf):
    parsed = text.parse_lines(views.event_lines(views.events(spark, sf))).where("parsed")
    return parsed.select("event_id", "level", "correlation_id", "tenant_id", "req_id", "timestamp", "log_text")


@query("extract_latency_ms", f"WITH {q.LINES} SELECT event_id, {q.latency_of('message')} AS latency_ms FROM lines")
def extract_latency_ms(spark, sf):
    lines = views.event_lines(views.events(spark, sf))
    return lines.select("event_id", text.extract_latency_ms(F.col("message")).alias("latency_ms"))


@query("extract_status_code", f"WITH {q.LINES} SELECT event_id, {q.status_of('message')} AS status_code FROM lines")
def extract_status_code(spark, sf):
    lines = views.event_lines(views.events(spark, sf))
    return lines.select("event_id", text.extract_status_code(F.col("message")).alias("status_code"))


@query("is_error", f"""SELECT doc_id, (lang IN ('error','warn') OR {q.keyword('text')}) AS logs_policy,
  upper(source) IN ('ERROR','FATAL','CRITICAL') AS docs_policy FROM documents""")
def is_error(spark, sf):
    """Keywords anywhere in whole documents."""
    docs = views.table(spark, sf, "documents")
    return docs.select(
        "doc_id", text.is_error(F.col("lang"), F.lower("text")).alias("logs_policy"),
        text.is_error(F.col("source"), policy="docs").alias("docs_policy"),
    )


@query("is_error_levels", f"""WITH {q.EV} SELECT event_id,
  ({q.LEVEL}) IN ('error','fatal','critical','warn','warning') AS logs_policy,
  upper({q.LEVEL}) IN ('ERROR','FATAL','CRITICAL') AS docs_policy FROM ev""")
def is_error_levels(spark, sf):
    logs = views.event_logs(views.events(spark, sf))
    return logs.select(
        "event_id", text.is_error(F.col("level")).alias("logs_policy"),
        text.is_error(F.col("level"), policy="docs").alias("docs_policy"),
    )


ISO_TEXT = """CASE WHEN k % 5 = 0 THEN 'not a time'
    WHEN k % 5 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30'
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END"""
MS_TEXT = "CASE WHEN k % 7 = 0 THEN 'n/a' ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END"


def _time_texts(ev):
    iso = (
        F.when(F.col("k") % 5 == 0, "not a time")
        .when(F.col("k") % 5 == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30")))
        .otherwise(F.date_format("ts", views.ISO))
    )
    ms = F.when(F.col("k") % 7 == 0, "n/a").otherwise(F.unix_millis("ts").cast("string"))
    return ev.select("event_id", "k", iso.alias("iso"), ms.alias("ms"))


@query("resolve_timestamp", f"""WITH {q.EV}, t AS (SELECT event_id, {ISO_TEXT} AS iso, {MS_TEXT} AS ms FROM ev)
SELECT event_id, coalesce({q.utc('iso')}, epoch_ms(TRY_CAST(ms AS BIGINT))) AS timestamp_dt FROM t""")
def resolve_timestamp(spark, sf):
    texts = _time_texts(views.events(spark, sf))
    return texts.select("event_id", times.resolve_timestamp(F.col("iso"), F.col("ms")).alias("timestamp_dt"))


@query("doc_timestamp", f"""WITH {q.EV}, t AS (
  SELECT event_id, CASE WHEN k % 2 = 0 THEN {ISO_TEXT} ELSE {MS_TEXT} END AS raw FROM ev)
SELECT event_id, coalesce(epoch_ms(TRY_CAST(raw AS BIGINT)), {q.utc('raw')}) AS timestamp_dt FROM t
WHERE coalesce(epoch_ms(TRY_CAST(raw AS BIGINT)), {q.utc('raw')}) IS NOT NULL""")
def doc_timestamp(spark, sf):
    texts = _time_texts(views.events(spark, sf))
    raw = F.when(F.col("k") % 2 == 0, F.col("iso")).otherwise(F.col("ms"))
    return texts.select("event_id", times.doc_timestamp(raw).alias("timestamp_dt")).where("timestamp_dt IS NOT NULL")


@query("to_epoch", f"""WITH {q.EV} SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, epoch_us(ts) AS epoch_us,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM ev""")
def to_epoch(spark, sf):
    ev = views.events(spark, sf)
    ms = times.to_epoch_ms(F.col("ts"))
    return ev.select(
        "event_id", ms.alias("epoch_ms"), times.to_epoch_us(F.col("ts")).alias("epoch_us"),
        times.epoch_ms_to_iso(ms).alias("iso"),
    )


@query("clean_service_name", f"""WITH {q.EV} SELECT event_id, regexp_replace(service_name, '-\\d+$', '') AS service,
  regexp_replace(service_name || '-ms', '-\\d+$', '') AS kept FROM ev""")
def clean_service_name(spark, sf):
    ev = views.events(spark, sf)
    return ev.select(
        "event_id", text.clean_service_name(F.col("service_name")).alias("service"),
        text.clean_service_name(F.concat("service_name", F.lit("-ms"))).alias("kept"),
    )


NUMBER_TEXT = """CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN 'None' WHEN 3 THEN '12abc'
    WHEN 4 THEN ' ' || CAST(value AS VARCHAR) || ' ' ELSE CAST(value AS VARCHAR) END"""


@query("safe_numeric", f"""WITH {q.EV}, t AS (SELECT event_id, trim({NUMBER_TEXT}) AS raw FROM ev), n AS (
  SELECT event_id, CASE WHEN isnan(TRY_CAST(raw AS DOUBLE)) THEN NULL ELSE TRY_CAST(raw AS DOUBLE) END AS as_double FROM t)
SELECT event_id, as_double, CAST(trunc(as_double) AS BIGINT) AS as_long FROM n""")
def safe_numeric(spark, sf):
    ev = views.events(spark, sf)
    value, k = F.col("value").cast("string"), F.col("k") % 6
    raw = (
        F.when(k == 0, "").when(k == 1, "nan").when(k == 2, "None").when(k == 3, "12abc")
        .when(k == 4, F.concat(F.lit(" "), value, F.lit(" "))).otherwise(value)
    )
    return ev.select("event_id", text.safe_double(raw).alias("as_double"), text.safe_long(raw).alias("as_long"))


@query("valid_epoch_ms", f"""WITH {q.ROWS} SELECT rid, regexp_matches(trim(ts_ms), '^[0-9]{{13}}$') AS valid,
  regexp_matches(trim(' ' || ts_ms || '0'), '^[0-9]{{13}}$') AS too_long FROM rows_""")
def valid_epoch_ms(spark, sf):
    rows = views.event_rows(views.events(spark, sf))
    return rows.select(
        "rid", text.valid_epoch_ms(F.col("ts_ms")).alias("valid"),
        text.valid_epoch_ms(F.concat(F.lit(" "), "ts_ms", F.lit("0"))).alias("too_long"),
    )


@query("last_path_segment", "SELECT page_id, string_split(url, '/')[-1] AS segment FROM pages")
def last_path_segment(spark, sf):
    pages = views.table(spark, sf, "pages")
    return pages.select("page_id", text.last_path_segment(F.col("url")).alias("segment"))


def _responses(ev):
    """Cloud metric responses with one datapoint each, derived from the events."""
    from triagelake.schemas import CLOUD_METRICS

    named = F.array(*[
        F.struct(F.lit(m[0]).alias("ns"), F.lit(m[1]).alias("name")) for m in [*CLOUD_METRICS, ("AWS/ECS", "Other")]
    ])
    chosen = ev.withColumn("m", F.get(named, F.col("k") % 10))
    is_memory = F.col("k") % 10 == 5
    point = F.struct(
        F.col("ts").alias("Timestamp"), F.when(F.col("k") % 9 != 0, F.col("value") * F.when(is_memory, 1048576.0).otherwise(1.0)).alias("Average"),
        F.col("k").cast("double").alias("Sum"), (F.col("value") + F.col("k")).alias("Maximum"),
    )
    return chosen.select(
        F.col("m.ns").alias("Namespace"), F.col("m.name").alias("MetricName"),
        F.concat(F.lit("arn:x:service/cluster/"), "service_name").alias("Resource"),
        F.array(point).alias("Datapoints"),
    )


CLOUD = q.EV + """, points AS (
  SELECT ts AS timestamp, service_name, k % 10 AS m, CASE WHEN k % 9 <> 0 THEN value * CASE WHEN k % 10 = 5 THEN 1048576.0 ELSE 1.0 END END AS average,
    CAST(k AS DOUBLE) AS sum_, value + k AS maximum FROM ev)"""


@query("read_cloud_datapoints", f"""WITH {CLOUD} SELECT timestamp, service_name, average, sum_ AS "sum", maximum FROM points""")
def read_cloud_datapoints(spark, sf):
    points = explode_datapoints(_responses(views.events(spark, sf)))
    return points.select("timestamp", "service_name", "average", "sum", "maximum")


def _cloud_sql() -> str:
    from triagelake.schemas import CLOUD_METRICS

    name = " ".join(f"WHEN {i} THEN '{m[2]}'" for i, m in enumerate(CLOUD_METRICS))
    source = {"Average": "average", "Sum": "sum_", "Maximum": "maximum"}
    value = " ".join(f"WHEN {i} THEN coalesce({source[m[3]]}, 0) * {m[4]!r}" for i, m in enumerate(CLOUD_METRICS))
    rounded_value = (
        f"CASE WHEN v < 1e11 THEN {q.fixed('CASE WHEN v < 1e11 THEN v END', 4)} ELSE round(v, 4) END"
    )
    return f"""WITH {CLOUD}, named AS (
  SELECT timestamp, service_name, CASE m {name} END AS metric_name, CASE m {value} END AS v FROM points WHERE m < 9)
SELECT timestamp, service_name, metric_name, {rounded_value} AS metric_value, metric_name AS metric_type,
  'cloudwatch' AS source FROM named"""


@query("normalize_cloud_metric", _cloud_sql())
def normalize(spark, sf):
    return normalize_cloud_metric(explode_datapoints(_responses(views.events(spark, sf))))


@query("ingest_cloud_metrics", _cloud_sql())
def ingest_cloud(spark, sf):
    """Responses landed as JSON lines, read back and normalised."""
    from triagelake.plans.jobs import ingest_cloud_metrics
    from triagelake.session import scratch_path

    path = scratch_path(spark, "cloud")
    _responses(views.events(spark, sf)).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    return ingest_cloud_metrics(spark, path)


ORDER_Z = """base AS (SELECT o_orderpriority, avg(o_totalprice) AS mean, stddev_pop(o_totalprice) AS sd FROM orders GROUP BY 1),
z AS (SELECT o_orderkey, CASE WHEN sd = 0 THEN 0 ELSE (o_totalprice - mean) / sd END * 2 AS z
  FROM orders JOIN base USING (o_orderpriority))"""


def _order_z(spark, sf):
    orders = views.table(spark, sf, "orders")
    base = orders.groupBy("o_orderpriority").agg(
        F.avg("o_totalprice").alias("mean"), F.stddev_pop("o_totalprice").alias("sd")
    )
    z = scores.zscore(F.col("o_totalprice"), F.col("mean"), F.col("sd"))
    return orders.join(base, "o_orderpriority").select("o_orderkey", (z * 2).alias("z"))


@query("zscore", f"WITH {ORDER_Z} SELECT o_orderkey, {q.fixed('z', 4)} AS z FROM z")
def zscore(spark, sf):
    return _order_z(spark, sf).select("o_orderkey", rounded(F.col("z"), 4).alias("z"))


@query("reading_severity", f"WITH {ORDER_Z} SELECT o_orderkey, CASE WHEN abs(z) >= 4 THEN 'high' ELSE 'medium' END AS severity FROM z")
def reading_severity(spark, sf):
    return _order_z(spark, sf).select("o_orderkey", scores.reading_severity(F.col("z")).alias("severity"))


@query("incident_severity", f"WITH {ORDER_Z} SELECT o_orderkey, {q.SEVERITY.format('abs(z)')} AS severity FROM z")
def incident_severity(spark, sf):
    return _order_z(spark, sf).select("o_orderkey", scores.incident_severity(F.abs("z")).alias("severity"))


@query("confidence", f"WITH {ORDER_Z} SELECT o_orderkey, {q.fixed('least(abs(z) / 6.0, 1.0)', 3)} AS confidence FROM z")
def confidence(spark, sf):
    return _order_z(spark, sf).select("o_orderkey", scores.confidence(F.abs("z")).alias("confidence"))


NAMES = ["error_rate", "http_5xx_rate", "latency_p95", "db_connections", "asg_capacity", "cpu_usage", "memory_usage", "log_volume"]
NAMES_SQL = "list_filter([" + ", ".join(
    f"CASE WHEN user_id % {i + 3} = 0 THEN '{name}' END" for i, name in enumerate(NAMES)
) + "], lambda m : m IS NOT NULL)"


def _name_sets(ev):
    cells = [F.when(F.col("user_id") % (i + 3) == 0, name) for i, name in enumerate(NAMES)]
    return ev.withColumn("names", F.array_compact(F.array(*cells)))


@query("classify_incident_type", f"""WITH {q.EV}, t AS (SELECT event_id, {NAMES_SQL} AS names FROM ev)
SELECT event_id, {q.INCIDENT_TYPE.format('names')} AS incident_type FROM t""")
def classify_incident_type(spark, sf):
    sets = _name_sets(views.events(spark, sf))
    return sets.select("event_id", scores.classify_incident_type(F.col("names")).alias("incident_type"))


@query("first_rule", f"""WITH {q.EV}, t AS (SELECT event_id, {NAMES_SQL} AS names FROM ev)
SELECT event_id, {q.rule_case('names', 0)} AS rule, {q.rule_case('names', 4)} AS scenario FROM t""")
def first_rule(spark, sf):
    sets = _name_sets(views.events(spark, sf)).withColumn("r", scores.first_rule(F.col("names")))
    return sets.select("event_id", F.col("r.name").alias("rule"), F.col("r.scenario").alias("scenario"))


@query("incident_description", f"WITH {q.EVENT_INCIDENTS} SELECT id, description FROM incidents")
def incident_description(spark, sf):
    return views.event_incidents(views.events(spark, sf)).select("id", "description")


@query("root_cause_text", f"WITH {q.EVENT_INCIDENTS} SELECT id, root_cause FROM incidents")
def root_cause_text(spark, sf):
    return views.event_incidents(views.events(spark, sf)).select("id", "root_cause")


def _names_of(pattern: str) -> str:
    items = f"list_transform(string_split(regexp_extract(root_cause, '{pattern}', 1), ','), lambda m : trim(m))"
    return f"array_to_string(list_filter({items}, lambda m : m <> '' AND lower(m) <> 'none'), ',')"


@query("parse_root_cause", f"""WITH {q.EVENT_INCIDENTS}
SELECT id, trim(regexp_extract(root_cause, '^([^.]+\\.)', 1)) AS summary,
  {_names_of('Primary metrics?:[ ]*([^.]+)')} AS primary_metrics,
  {_names_of('Correlated metrics?:[ ]*([^.]+)')} AS correlated_metrics,
  trim(regexp_extract(root_cause, 'Recommended actions?:[ ]*(.+)$', 1)) AS action
FROM incidents WHERE root_cause IS NOT NULL""")
def parse_root_cause(spark, sf):
    caused = views.event_incidents(views.events(spark, sf)).where("root_cause IS NOT NULL")
    parts = scores.parse_root_cause(F.col("root_cause"))
    return caused.select("id", *[col.alias(name) for name, col in parts.items()])


@query("incident_label", f"""WITH {q.EVENT_INCIDENTS}
SELECT id, array_to_string(list_transform(string_split(incident_type, '_'),
    lambda w : upper(w[1]) || lower(w[2:])), ' ') AS type_label,
  strftime(timestamp, '%b %d, %Y  %H:%M') AS time_label,
  CAST(CAST(round(CAST(confidence_score * 100 AS DECIMAL(18,6)), 0) AS BIGINT) AS VARCHAR) || '%' AS confidence_label,
  CASE WHEN resolved THEN 'Resolved' ELSE 'Open' END AS status_label FROM incidents""")
def incident_label(spark, sf):
    parts = scores.incident_label(
        F.col("incident_type"), F.col("timestamp"), F.col("confidence_score"), F.col("resolved")
    )
    found = views.event_incidents(views.events(spark, sf))
    return found.select("id", *[col.alias(name) for name, col in parts.items()])


@query("metric_rounding", f"""SELECT o_orderkey, {q.fixed('o_totalprice / 7', 2)} AS two, {q.fixed('o_totalprice / 7', 4)} AS four
FROM orders""")
def metric_rounding(spark, sf):
    seventh = F.col("o_totalprice") / 7
    return views.table(spark, sf, "orders").select(
        "o_orderkey", rounded(seventh, 2).alias("two"), rounded(seventh, 4).alias("four")
    )


@query("filter_incidents", f"""WITH {q.EVENT_INCIDENTS} SELECT id, service_name, severity, resolved FROM incidents
WHERE service_name = 'svc-3' AND NOT resolved""")
def filter_incidents(spark, sf):
    found = reports.filter_incidents(views.event_incidents(views.events(spark, sf)), "svc-3", status="open")
    return found.select("id", "service_name", "severity", "resolved")


@query("filter_incidents_severity", f"""WITH {q.EVENT_INCIDENTS} SELECT id, service_name, severity, resolved
FROM incidents WHERE severity = 'high' AND resolved""")
def filter_incidents_severity(spark, sf):
    found = reports.filter_incidents(
        views.event_incidents(views.events(spark, sf)), severity="high", status="resolved"
    )
    return found.select("id", "service_name", "severity", "resolved")


@query("filter_lookback", f"""WITH {q.LOGS}, metrics AS ({q.log_metrics('6 hours')})
SELECT timestamp, service_name, metric_name, metric_value FROM metrics
WHERE timestamp >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 5 DAY AND metric_name = 'error_rate'""")
def filter_lookback(spark, sf):
    ev = views.events(spark, sf)
    recent = reports.filter_lookback(
        views.log_metrics(ev, "6 hours"), views.as_of(ev), 5 * 24 * 60, metric="error_rate"
    )
    return recent.select("timestamp", "service_name", "metric_name", "metric_value")


@query("get_incident", f"""WITH {q.EVENT_INCIDENTS} SELECT id, timestamp, service_name, severity FROM incidents
WHERE id = (SELECT max(id) FROM incidents)""")
def get_incident(spark, sf):
    """Point lookup of the newest incident."""
    found = views.event_incidents(views.events(spark, sf))
    newest = found.agg(F.max("id").alias("id")).scalar()
    return reports.get_incident(found, newest).select("id", "timestamp", "service_name", "severity")


@query("parse_entries", f"""WITH {q.PARSED} SELECT service_name, rid, level, timestamp_dt, status_code, latency_ms, is_error
FROM parsed_logs WHERE parsed""")
def parse_all(spark, sf):
    """All parsed and enriched fields of merged entries."""
    from triagelake.sources.log_files import entries_from_rows

    rows = views.event_rows(views.events(spark, sf))
    parsed = parse_entries(entries_from_rows(rows, ["service_name"])).where("parsed")
    return parsed.select("service_name", "rid", "level", "timestamp_dt", "status_code", "latency_ms", "is_error")
