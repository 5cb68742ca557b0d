"""Column functions on hand-made cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from triagelake.functions import scores, text, times
from triagelake.schemas import ERROR_KEYWORDS, RULES
from triagelake.sources.cloud import explode_datapoints, normalize_cloud_metric, read_cloud_datapoints


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).collect()[0]


def parse(spark, message):
    df = spark.createDataFrame([(message, "1709287200000")], "message string, ts_ms string")
    return text.parse_lines(df).collect()[0]


def test_strip_ansi(spark):
    raw = "\x1b[32minfo\x1b[39m|correlation|tenant|timestamp:\tlog text"
    got = one(spark, x=text.strip_ansi(F.lit(raw)), y=text.strip_ansi(F.lit("no codes")))
    assert got.x == "info|correlation|tenant|timestamp:\tlog text" and got.y == "no codes"


@pytest.mark.parametrize("message,want", [
    ("info|abc123|tenant1|2024-03-01T10:00:00.000Z:\tTest log message",
     ("info", "abc123", "tenant1", "", "2024-03-01T10:00:00.000Z", "Test log message")),
    ("info|abc|tenant|[req123|]2024-03-01T10:00:00.000Z:\tMessage",
     ("info", "abc", "tenant", "req123", "2024-03-01T10:00:00.000Z", "Message")),
    ("info|a|t|rq1|2024-03-01T10:00:00.000Z:\tm: x", ("info", "a", "t", "rq1", "2024-03-01T10:00:00.000Z", "m: x")),
    (" \x1b[32mINFO\x1b[39m | c |t|timestamp:\tlog text\nmore ", ("info", "c", "t", "", "timestamp", "log text\nmore")),
    ("warn|a|t|odd]b|c: rest", ("warn", "a", "t", "", "odd]b|c", "rest")),
])
def test_parse_line(spark, message, want):
    row = parse(spark, message)
    assert row.parsed
    assert (row.level, row.correlation_id, row.tenant_id, row.req_id, row.timestamp, row.log_text) == want


@pytest.mark.parametrize("message", ["plain text", "", "a|b|c", "a||c|ts: text", "a|b|c|no colon here"])
def test_unparsable_line(spark, message):
    row = parse(spark, message)
    assert row.parsed is False and row.level is None and row.log_text is None


@pytest.mark.parametrize("line,status,latency", [
    ("[End Request] GET /api/users 200 OK 145ms", 200, 145.0),
    ("[End Request] GET /x 999 1ms", None, 1.0),
    ("[End Request] GET /x 200 OK 1.2.3ms", 200, None),
    ("[end request] get /x 1 ms", None, 1.0),
    ("[End Request] GET /x 503 Down", 503, None),
    ("took 12ms", None, None),
    ("[End Request] GET /x 200 OK\n12ms", 200, None),
])
def test_http_extraction(spark, line, status, latency):
    df = spark.createDataFrame([("info", line)], "level string, log_text string")
    row = text.enrich(df).collect()[0]
    assert (row.status_code, row.latency_ms) == (status, latency)
    direct = one(spark, s=text.extract_status_code(F.lit(line)), l=text.extract_latency_ms(F.lit(line)))
    assert (direct.s, direct.l) == (status, latency)


@pytest.mark.parametrize("level,line,logs,docs", [
    ("error", "Something went wrong", True, True), ("info", "Connection timeout error", True, False),
    ("info", "User logged in successfully", False, False), ("warn", "slow", True, False),
    ("FATAL", "x", False, True), (None, "fine", False, False),
] + [("info", f"a {word.upper()} b", True, False) for word in ERROR_KEYWORDS])
def test_is_error(spark, level, line, logs, docs):
    col = F.lit(level).cast("string")
    got = one(spark, a=text.is_error(col, F.lower(F.lit(line))), b=text.is_error(col, policy="docs"))
    assert (got.a, got.b) == (logs, docs)


def test_times(spark):
    stamp = dt.datetime(2024, 3, 1, 10, 0)
    got = one(
        spark,
        iso=times.resolve_timestamp(F.lit("2024-03-01T10:00:00.000Z"), F.lit("5")),
        offset=times.resolve_timestamp(F.lit("2024-03-01T15:30:00+05:30"), F.lit(None)),
        fallback=times.resolve_timestamp(F.lit("timestamp"), F.lit("1709287200000")),
        neither=times.resolve_timestamp(F.lit("x"), F.lit("y")),
        doc_ms=times.doc_timestamp(F.lit(1709287200000)), doc_iso=times.doc_timestamp(F.lit("2024-03-01T10:00:00Z")),
        back=times.epoch_ms_to_iso(F.lit(1709287200000)),
    )
    assert got.iso == got.offset == got.fallback == got.doc_ms == got.doc_iso == stamp
    assert got.neither is None and got.back == "2024-03-01T10:00:00"


def test_small_text_helpers(spark):
    got = one(
        spark,
        a=text.clean_service_name(F.lit("User-ms-4")), b=text.clean_service_name(F.lit("api")),
        c=text.last_path_segment(F.lit("arn:x/cluster/svc")), d=text.safe_double(F.lit("nan")),
        e=text.safe_double(F.lit(" 2.5 ")), f=text.safe_long(F.lit("7.9")), g=text.safe_double(F.lit("None")),
        h=text.valid_epoch_ms(F.lit(" 1709287200000 ")), i=text.valid_epoch_ms(F.lit("170928720000")),
    )
    assert tuple(got) == ("User-ms", "api", "svc", None, 2.5, 7, None, True, False)


def test_scores(spark):
    got = one(
        spark,
        z=scores.zscore(F.lit(5.0), F.lit(2.0), F.lit(1.5)), flat=scores.zscore(F.lit(5.0), F.lit(2.0), F.lit(0.0)),
        none=scores.zscore(F.lit(None).cast("double"), F.lit(2.0), F.lit(1.0)),
        tie=scores.rounded(F.lit(2.345), 2), big=scores.rounded(F.lit(3.0e15), 2),
        c1=scores.confidence(F.lit(3.0)), c2=scores.confidence(F.lit(9.0)),
        worst=scores.severity_name(F.greatest(*[scores.severity_rank(F.lit(s)) for s in ("medium", "critical", "low")])),
    )
    assert tuple(got) == (2.0, 0.0, None, 2.35, 3.0e15, 0.5, 1.0, "critical")


@pytest.mark.parametrize("z,reading,incident", [
    (3.0, "medium", "low"), (3.5, "medium", "medium"), (4.0, "high", "high"), (5.0, "high", "critical"),
])
def test_severity_edges(spark, z, reading, incident):
    got = one(spark, a=scores.reading_severity(F.lit(-z)), b=scores.incident_severity(F.lit(z)))
    assert tuple(got) == (reading, incident)


@pytest.mark.parametrize("names,kind,rule", [
    (["http_5xx_rate", "latency_p95"], "error_spike", "application_error"),
    (["latency_p95", "cpu_usage"], "latency_spike", "cpu_pressure"),
    (["db_connections", "cpu_usage", "memory_usage"], "db_saturation", "database_saturation"),
    (["asg_capacity", "db_connections"], "db_saturation", "infrastructure_saturation"),
    (["cpu_usage", "memory_usage"], "resource_exhaustion", "resource_contention"),
    (["memory_usage"], "resource_exhaustion", "memory_pressure"),
    (["log_volume"], "unknown_anomaly", "application_error"),
    ([], "unknown_anomaly", "application_error"),
])
def test_classes_and_rules(spark, names, kind, rule):
    col = F.array(*map(F.lit, names)).cast("array<string>")
    got = one(spark, kind=scores.classify_incident_type(col), rule=scores.first_rule(col)["name"])
    assert tuple(got) == (kind, rule)


def test_root_cause_round_trip(spark):
    rule = RULES[2]
    made = scores.root_cause_text(
        F.lit(rule[2]), F.lit(rule[1][0]), F.array(F.lit("latency_p95"), F.lit("memory_usage")), F.lit(rule[3])
    )
    parts = one(spark, t=made, **scores.parse_root_cause(made))
    assert parts.t == (
        f"{rule[2]}. Primary metric: cpu_usage. Correlated metrics: latency_p95, memory_usage. "
        f"Recommended action: {rule[3]}"
    )
    assert parts.summary == rule[2] + "." and parts.action == rule[3]
    assert parts.primary_metrics == ["cpu_usage"] and parts.correlated_metrics == ["latency_p95", "memory_usage"]
    none = scores.root_cause_text(F.lit("d"), F.lit(None), F.array().cast("array<string>"), F.lit("a"))
    got = one(spark, t=none, **scores.parse_root_cause(none))
    assert got.t == "d. Primary metric: error_rate. Correlated metrics: None. Recommended action: a"
    assert got.correlated_metrics == []


def test_cloud_metrics(spark, tmp_path):
    stamp = dt.datetime(2024, 3, 1, 10, 0)
    rows = [
        ("AWS/RDS", "FreeableMemory", "rds", [(stamp, 3.0 * 1024 * 1024, None, None)]),
        ("AWS/ApplicationELB", "TargetResponseTime", "alb", [(stamp, 0.25, None, None)]),
        ("AWS/ECS", "RunningTaskCount", "a/b/svc", [(stamp, 9.0, 4.0, None), (stamp, 1.0, None, None)]),
        ("AWS/RDS", "DatabaseConnections", "rds", [(stamp, 1.0, 2.0, 80.0)]),
        ("AWS/ECS", "Unmapped", "svc", [(stamp, 1.0, 1.0, 1.0)]),
    ]
    schema = (
        "Namespace string, MetricName string, Resource string, "
        "Datapoints array<struct<Timestamp: timestamp, Average: double, Sum: double, Maximum: double>>"
    )
    responses = spark.createDataFrame(rows, schema)
    responses.write.json(str(tmp_path / "cloud"))
    want = [
        ("alb", "latency_p95", 250.0), ("rds", "db_connections", 80.0), ("rds", "rds_memory_mb", 3.0),
        ("svc", "asg_capacity", 0.0), ("svc", "asg_capacity", 4.0),
    ]
    for points in (explode_datapoints(responses), read_cloud_datapoints(spark, str(tmp_path / "cloud"))):
        got = normalize_cloud_metric(points).select("service_name", "metric_name", "metric_value").collect()
        assert sorted(map(tuple, got)) == want
