"""The event views and the stages built on them, as SQL common table expressions."""

from __future__ import annotations

from triagelake.schemas import ERROR_KEYWORDS, RULES

LINE = (
    r"(?s)^([^|]+)\|([^|]+)\|([^|]+)\|(?:\[?([^|\]]+)\|\]?)?(.+?):\s+(.*)$"
)
BLANKS = "' ' || chr(9) || chr(10) || chr(13)"


def fixed(expr: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(18,6)), {digits}) AS DOUBLE)"


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         'svc-' || (user_id % 8) AS service_name
  FROM events)"""

TEXT = """'[End Request] GET /e/' || event_id || CASE WHEN k % 10 <> 0 THEN ' ' || (100 + 5 * k) ELSE '' END
  || ' OK' || CASE WHEN event_type <> 'click' THEN ' ' || value || 'ms' ELSE '' END"""
LEVEL = "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warn' ELSE 'info' END"

LINES = EV + f""", lines AS (
  SELECT event_id, service_name, event_type, k, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ts_ms,
    CASE WHEN k % 17 = 0 THEN 'garbage line ' || event_id ELSE
      chr(27) || '[32m' || {LEVEL} || chr(27) || '[39m|c' || event_id || '|t' || (user_id % 5) || '|'
      || CASE WHEN k % 3 = 0 THEN '[r' || k || '|]' ELSE '' END
      || strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') || ':' || chr(9) || {TEXT} END AS message
  FROM ev)"""

ROWS = LINES + """, rows_ AS (
  SELECT service_name, event_id AS rid, (event_type = 'view' AND k % 4 = 0) AS continues,
    CASE WHEN event_type = 'view' AND k % 4 = 0 THEN '' ELSE ts_ms END AS ts_ms,
    CASE WHEN event_type = 'view' AND k % 4 = 0
      THEN '    at frame.e' || event_id || CASE WHEN k % 8 = 0 THEN ' Caused by: Timeout' ELSE '' END
      ELSE message END AS message
  FROM lines)"""

ENTRIES = ROWS + """, numbered AS (
  SELECT *, sum(CASE WHEN continues THEN 0 ELSE 1 END) OVER (PARTITION BY service_name ORDER BY rid) AS entry
  FROM rows_), entries AS (
  SELECT service_name, max(CASE WHEN NOT continues THEN rid END) AS rid,
    max(CASE WHEN NOT continues THEN ts_ms END) AS ts_ms, string_agg(message, chr(10) ORDER BY rid) AS message,
    count(*) - 1 AS n_continuations
  FROM numbered WHERE entry > 0 GROUP BY service_name, entry)"""


def clean(col: str) -> str:
    return f"regexp_replace(trim({col}, {BLANKS}), chr(27) || '\\[[0-9;]*m', '', 'g')"


def part(i: int, col: str = "clean") -> str:
    return f"trim(regexp_extract({col}, '{LINE}', {i}), {BLANKS})"


KEYWORDS = " OR ".join(f"contains(lower({{0}}), '{word}')" for word in ERROR_KEYWORDS)


def keyword(col: str) -> str:
    return "(" + KEYWORDS.format(col) + ")"


LATENCY_OF = r"TRY_CAST(regexp_extract({0}, '\[End Request\].*?([\d.]+)\s*ms', 1, 'i') AS DOUBLE)"
STATUS_OF = r"TRY_CAST(regexp_extract({0}, '\[End Request\]\s+(\w+)\s+(\S+)\s+(\d{{3}})', 3) AS INTEGER)"


def latency_of(col: str) -> str:
    return LATENCY_OF.format(col)


def status_of(col: str) -> str:
    code = STATUS_OF.format(col)
    return f"CASE WHEN {code} BETWEEN 100 AND 599 THEN {code} END"


def utc(expr: str) -> str:
    return f"(TRY_CAST({expr} AS TIMESTAMPTZ) AT TIME ZONE 'UTC')"


PARSED = ENTRIES + f""", cleaned AS (SELECT *, {clean('message')} AS clean FROM entries), split AS (
  SELECT service_name, rid, ts_ms, n_continuations, regexp_matches(clean, '{LINE}') AS parsed,
    lower({part(1)}) AS level, {part(2)} AS correlation_id, {part(3)} AS tenant_id, {part(4)} AS req_id,
    {part(5)} AS timestamp, {part(6)} AS log_text FROM cleaned), parsed_logs AS (
  SELECT *, {utc('timestamp')} AS timestamp_dt, {status_of('log_text')} AS status_code,
    {latency_of('log_text')} AS latency_ms,
    (level IN ('error','fatal','critical','warn','warning') OR {keyword('log_text')}) AS is_error
  FROM split)"""

LOGS = EV + f""", logs AS (
  SELECT event_id, service_name, {LEVEL} AS level, 'c' || event_id AS correlation_id, 't' || (user_id % 5) AS tenant_id,
    CASE WHEN k % 3 = 0 THEN 'r' || k ELSE '' END AS req_id, {TEXT} AS log_text, ts AS timestamp_dt,
    CASE WHEN k % 10 <> 0 THEN 100 + 5 * k END AS status_code,
    CASE WHEN event_type <> 'click' THEN value END AS latency_ms, event_type = 'error' AS is_error
  FROM ev)"""


def log_metrics(bucket: str, logs: str = "logs", where: str = "TRUE", source: str = "logs", quantile: str = "quantile_cont") -> str:
    """Rows of (timestamp, service_name, metric_name, metric_value, metric_type, source)."""
    start = f"time_bucket(INTERVAL '{bucket}', timestamp_dt)"
    src = f"FROM {logs} WHERE timestamp_dt IS NOT NULL AND {where}"
    error = fixed("100.0 * sum(CASE WHEN is_error THEN 1 ELSE 0 END) / count(*)", 4)
    p95 = fixed(f"{quantile}(latency_ms, 0.95)", 2)
    http = fixed("100.0 * sum(CASE WHEN status_code >= 500 THEN 1 ELSE 0 END) / count(*)", 4)
    return f"""
  SELECT {start} AS timestamp, service_name, 'error_rate' AS metric_name, {error} AS metric_value,
    'error_rate' AS metric_type, '{source}' AS source {src} GROUP BY ALL
  UNION ALL SELECT {start}, service_name, 'latency_p95', {p95}, 'latency', '{source}'
    {src} AND latency_ms IS NOT NULL GROUP BY {start}, service_name
  UNION ALL SELECT {start}, service_name, 'http_5xx_rate', {http}, 'error_rate', '{source}'
    {src} AND status_code IS NOT NULL GROUP BY {start}, service_name"""


def infra_metrics(bucket: str) -> str:
    start = f"time_bucket(INTERVAL '{bucket}', ts)"
    parts = []
    for name, value, kind in (
        ("cpu_usage", "avg(k)", "view"), ("memory_usage", "avg(value)", "purchase"),
        ("db_connections", "count(*)", "signup"), ("asg_capacity", "max(k)", "click"),
    ):
        parts.append(
            f"SELECT {start} AS timestamp, service_name, '{name}' AS metric_name, {fixed(value, 4)} AS metric_value, "
            f"'{name}' AS metric_type, 'synthetic' AS source FROM ev WHERE event_type = '{kind}' "
            f"GROUP BY {start}, service_name"
        )
    return "\n  UNION ALL ".join(parts)


def metrics(bucket: str) -> str:
    return LOGS + f", metrics AS ({log_metrics(bucket)}\n  UNION ALL {infra_metrics(bucket)})"


def statistics(source: str, key: str = "service_name, metric_name", value: str = "metric_value") -> str:
    return f"""SELECT {key}, avg({value}) AS mean, stddev_pop({value}) AS stddev,
    quantile_cont({value}, 0.5) AS p50, quantile_cont({value}, 0.95) AS p95, quantile_cont({value}, 0.99) AS p99,
    count({value}) AS sample_count, min(timestamp) AS window_start, max(timestamp) AS window_end
  FROM {source} GROUP BY {key}"""


def baselines(bucket: str, min_samples: int = 100, min_metric_samples: int = 10) -> str:
    return metrics(bucket) + f""", stats AS ({statistics('metrics')}), baselines AS (
  SELECT * FROM stats
  QUALIFY sum(sample_count) OVER (PARTITION BY service_name) >= {min_samples}
    AND sample_count >= {min_metric_samples})"""


def anomalies(bucket: str, sigma: float = 3.0) -> str:
    return baselines(bucket) + f""", readings AS (
  SELECT * FROM metrics WHERE source = 'logs' OR NOT EXISTS (SELECT 1 FROM metrics WHERE source = 'logs')),
anomalies AS (
  SELECT r.timestamp, r.service_name, r.metric_name, r.metric_value AS value, b.mean AS baseline_mean,
    CASE WHEN b.stddev = 0 THEN 0 ELSE (r.metric_value - b.mean) / b.stddev END AS zscore, r.source
  FROM readings r JOIN baselines b USING (service_name, metric_name)
  WHERE abs(CASE WHEN b.stddev = 0 THEN 0 ELSE (r.metric_value - b.mean) / b.stddev END) >= {sigma})"""


SEVERITY = "CASE WHEN {0} >= 5 THEN 'critical' WHEN {0} >= 4 THEN 'high' WHEN {0} >= 3.5 THEN 'medium' ELSE 'low' END"
INCIDENT_TYPE = """CASE WHEN list_has_any({0}, ['error_rate','http_5xx_rate']) THEN 'error_spike'
    WHEN list_has_any({0}, ['latency_p95']) THEN 'latency_spike'
    WHEN list_has_any({0}, ['db_connections']) THEN 'db_saturation'
    WHEN list_has_any({0}, ['asg_capacity']) THEN 'asg_capacity_limit'
    WHEN list_has_any({0}, ['cpu_usage','memory_usage']) THEN 'resource_exhaustion'
    ELSE 'unknown_anomaly' END"""


def incidents(bucket: str, sigma: float = 3.0) -> str:
    description = (
        "'Detected anomalous ' || replace(incident_type, '_', ' ') || ' on ' || service_name || '. Affected metrics: ' "
        "|| array_to_string(affected, ', ') || '. Signal source(s): ' || array_to_string(sources, ', ') || '.'"
    )
    return anomalies(bucket, sigma) + f""", by_service AS (
  SELECT service_name, min(timestamp) AS timestamp, max(abs(zscore)) AS max_z,
    list_sort(list(DISTINCT metric_name)) AS affected, list_sort(list(DISTINCT source)) AS sources
  FROM anomalies GROUP BY service_name), typed AS (
  SELECT *, {INCIDENT_TYPE.format('affected')} AS incident_type FROM by_service), found AS (
  SELECT timestamp, service_name, incident_type, {SEVERITY.format('max_z')} AS severity, {description} AS description,
    array_to_string(affected, ',') AS affected_metrics, {fixed('least(max_z / 6.0, 1.0)', 3)} AS confidence_score
  FROM typed)"""


TYPE_OF_K = """CASE k % 4 WHEN 0 THEN 'error_spike' WHEN 1 THEN 'latency_spike' WHEN 2 THEN 'db_saturation'
    ELSE 'unknown_anomaly' END"""
_RULE = RULES[1]

EVENT_INCIDENTS = EV + f""", base AS (
  SELECT event_id AS id, ts AS timestamp, service_name, {TYPE_OF_K} AS incident_type,
    CASE WHEN value >= 300 THEN 'critical' WHEN value >= 200 THEN 'high' WHEN value >= 150 THEN 'medium' ELSE 'low' END
      AS severity, k,
    CASE WHEN k % 2 = 0 THEN ['error_rate'] ELSE ['http_5xx_rate','latency_p95'] END AS affected,
    {fixed('least(value / 60 / 6.0, 1.0)', 3)} AS confidence_score, k % 3 = 0 AS resolved
  FROM ev WHERE event_type = 'error' AND value >= 100), incidents AS (
  SELECT id, timestamp, service_name, incident_type, severity,
    'Detected anomalous ' || replace(incident_type, '_', ' ') || ' on ' || service_name || '. Affected metrics: '
      || array_to_string(affected, ', ') || '. Signal source(s): logs.' AS description,
    CASE WHEN k % 2 = 0 THEN {text_literal(_RULE[2] + '. Primary metric: ' + _RULE[1][0] + '. Correlated metrics: ')}
      || CASE WHEN k % 4 = 0 THEN 'cpu_usage, latency_p95' ELSE 'None' END
      || {text_literal('. Recommended action: ' + _RULE[3])} END AS root_cause,
    array_to_string(affected, ',') AS affected_metrics, confidence_score, resolved, timestamp AS created_at,
    CASE WHEN resolved THEN timestamp + INTERVAL 30 MINUTE END AS resolved_at
  FROM base)"""

LABELS = f"""labels_ AS (
  SELECT event_id AS gt_pos, service_name, {TYPE_OF_K} AS incident_type, ts - INTERVAL 15 MINUTE AS window_start,
    ts + INTERVAL 45 MINUTE AS window_end, CASE WHEN k % 2 = 1 THEN 'L' || event_id END AS label
  FROM ev WHERE event_type = 'purchase' AND value >= 150)"""

PAIRS = EVENT_INCIDENTS + ", " + LABELS + """, pairs AS (
  SELECT i.id, i.service_name, i.timestamp, i.incident_type, g.gt_pos,
    coalesce(g.label, 'GT' || (g.gt_pos + 1)) AS label
  FROM incidents i JOIN labels_ g ON i.service_name = g.service_name
    AND i.timestamp BETWEEN g.window_start - INTERVAL 30 MINUTE AND g.window_end + INTERVAL 30 MINUTE),
credited AS (
  SELECT id, service_name, timestamp, incident_type, min(gt_pos) AS gt_pos, arg_min(label, gt_pos) AS gt_label
  FROM pairs GROUP BY ALL)"""


def rule_case(elevated: str, field: int) -> str:
    """A field of the first rule whose metrics are all in the list `elevated`."""
    arms = []
    for rule in RULES:
        value = rule[field] if field != 1 else (rule[1][0] if rule[1] else None)
        literal = "NULL" if value is None else text_literal(value)
        condition = " AND ".join(f"list_contains({elevated}, '{m}')" for m in rule[1]) or "TRUE"
        arms.append(f"WHEN {condition} THEN {literal}")
    return "CASE " + " ".join(arms) + " END"


def diagnosis(incident_cte: str, window: str, sigma: float, elevated_by: str = "mean", correlation: float = 0.7) -> str:
    """CTEs from (incidents, metrics, baselines) to `causes`; the incident table has columns id, timestamp, service_name."""
    z = "z_mean" if elevated_by == "mean" else "z_max_abs"
    return f""", win AS (
  SELECT i.id AS incident_id, m.service_name, m.timestamp, m.metric_name, m.metric_value, m.source
  FROM {incident_cte} i JOIN metrics m ON i.service_name = m.service_name
    AND m.timestamp BETWEEN i.timestamp - INTERVAL {window} AND i.timestamp + INTERVAL {window}),
infra AS (
  SELECT *, max(CASE WHEN source IN ('synthetic','cloudwatch') THEN 1 ELSE 0 END) OVER (PARTITION BY incident_id) AS has
  FROM win),
means AS (
  SELECT incident_id, service_name, metric_name, avg(metric_value) AS window_mean, min(metric_value) AS lo,
    max(metric_value) AS hi
  FROM infra WHERE CASE WHEN has = 1 THEN source IN ('synthetic','cloudwatch')
    ELSE metric_name IN ('cpu_usage','memory_usage','asg_capacity','db_connections') END
  GROUP BY ALL),
scored AS (
  SELECT m.*, (window_mean - mean) / stddev AS z_mean,
    greatest(abs((lo - mean) / stddev), abs((hi - mean) / stddev)) AS z_max_abs
  FROM means m JOIN baselines b USING (service_name, metric_name) WHERE stddev <> 0),
elevated AS (SELECT *, {z} AS z FROM scored WHERE abs({z}) >= {sigma}),
ruled AS (
  SELECT s.incident_id, coalesce(e.names, []) AS names
  FROM (SELECT DISTINCT incident_id FROM win) s
  LEFT JOIN (SELECT incident_id, list_sort(list(metric_name)) AS names FROM elevated GROUP BY incident_id) e
    USING (incident_id)),
prim AS (
  SELECT *, {rule_case('names', 1)} AS primary_metric, {rule_case('names', 0)} AS rule,
    {rule_case('names', 4)} AS scenario, {rule_case('names', 2)} AS cause, {rule_case('names', 3)} AS action
  FROM ruled),
cells AS (
  SELECT incident_id, timestamp, metric_name, avg(metric_value) AS value FROM win GROUP BY ALL),
co AS (
  SELECT a.incident_id, a.timestamp, p.primary_metric, a.metric_name, b.value AS primary_value, a.value
  FROM cells a JOIN prim p USING (incident_id) JOIN cells b ON a.incident_id = b.incident_id
    AND a.timestamp = b.timestamp AND b.metric_name = p.primary_metric
  WHERE a.metric_name <> p.primary_metric),
corr_ AS (
  SELECT incident_id, primary_metric, metric_name, count(*) AS n,
    covar_pop(value, primary_value) / nullif(stddev_pop(value) * stddev_pop(primary_value), 0) AS r
  FROM co GROUP BY ALL),
correlated AS (SELECT * FROM corr_ WHERE abs(r) >= {correlation} AND NOT isnan(r)),
causes AS (
  SELECT p.*, coalesce(c.names, []) AS found,
    list_concat(coalesce(c.names, []), list_filter(p.names, lambda m : NOT list_contains(coalesce(c.names, []), m)
      AND m IS DISTINCT FROM p.primary_metric)) AS listed
  FROM prim p LEFT JOIN (
    SELECT incident_id, list_sort(list(metric_name)) AS names FROM correlated GROUP BY incident_id) c USING (incident_id))"""


CAUSE_TEXT = """cause || '. Primary metric: ' || coalesce(primary_metric, 'error_rate') || '. Correlated metrics: '
  || CASE WHEN len(listed) > 0 THEN array_to_string(listed, ', ') ELSE 'None' END
  || '. Recommended action: ' || action"""
