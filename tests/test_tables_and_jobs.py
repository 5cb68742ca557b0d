"""Stored tables, documents, whole runs, streams, plans and the query catalogue."""

import datetime as dt
import json
import re
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import connect, difference
from triagelake.operators import baselines, detect, reports
from triagelake.operators.intervals import interval_join
from triagelake.plans import event_views as views
from triagelake.plans import jobs
from triagelake.schemas import INCIDENT, METRIC
from triagelake.sources import documents, tables
from triagelake.streaming import streams

SMALL = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 3, 1)


def metric_rows(spark, value, source="logs"):
    stamp = F.lit("2024-03-01").cast("timestamp")
    return spark.range(3).select(
        (stamp + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("timestamp"), F.lit("s").alias("service_name"),
        F.lit("m").alias("metric_name"), (F.col("id") + value).cast("double").alias("metric_value"),
        F.lit("latency").alias("metric_type"), F.lit(source).alias("source"), stamp.alias("created_at"),
    )


def test_batches_replace_themselves_only(spark, tmp_path):
    path = str(tmp_path / "metrics")
    assert tables.read_metrics(spark, path).count() == 0
    tables.append_batch(metric_rows(spark, 0), path, 1, METRIC)
    tables.append_batch(metric_rows(spark, 10, "cloudwatch"), path, 2, METRIC)
    tables.append_batch(metric_rows(spark, 20, "cloudwatch"), path, 2, METRIC)
    got = tables.read_metrics(spark, path).collect()
    assert sorted(r.metric_value for r in got) == [20.0, 21.0, 22.0]
    assert tables.read_batches(spark, path, METRIC).count() == 6
    tables.replace_all_metrics(metric_rows(spark, 5), path)
    assert sorted(r.metric_value for r in tables.read_metrics(spark, path).collect()) == [5.0, 6.0, 7.0]


def test_ground_truth_manifest(spark, tmp_path):
    manifest = tmp_path / "labels.json"
    manifest.write_text(json.dumps([
        {"service_name": "a", "incident_type": "x", "window_start": "2024-03-01T05:00:00", "window_end": "2024-03-01T07:00:00"},
        {"service_name": "b", "incident_type": "y", "window_start": "2024-03-01T05:00:00", "window_end": "2024-03-01T07:00:00",
         "label": "named"},
    ], indent=1))
    got = tables.read_ground_truth(spark, str(manifest)).orderBy("gt_pos").collect()
    assert [(r.gt_pos, r.service_name, r.label) for r in got] == [(0, "a", None), (1, "b", "named")]
    assert got[0].window_start == dt.datetime(2024, 3, 1, 5)
    assert tables.read_ground_truth(spark).count() == 2


def test_evaluation_placeholder_and_audit(spark, tmp_path):
    row = tables.read_evaluation_summary(spark, str(tmp_path / "none")).collect()[0]
    assert (row.tp, row.f1, row.status) == (0, 0.0, "pending")
    path = str(tmp_path / "audit")
    tables.stage_audit(spark, path, "ok", "text", lambda: 7)
    with pytest.raises(ValueError):
        tables.stage_audit(spark, path, "bad", "text", lambda: int("x"))
    got = {r.query_type: r for r in spark.read.parquet(path).collect()}
    assert got["ok"].result_count == 7 and got["ok"].error is None
    assert got["bad"].result_count is None and "invalid literal" in got["bad"].error


def test_documents_store_and_scan(spark, tmp_path):
    logs = views.event_logs(views.events(spark, SMALL))
    docs = documents.to_log_documents(logs)
    line = json.loads(documents.to_json_lines(docs.where("status_code IS NULL AND req_id IS NULL")).first()[0])
    assert "status_code" not in line and "req_id" not in line and isinstance(line["_timestamp"], int)
    path = str(tmp_path / "docs")
    documents.write_log_documents(docs, path)
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-01-05 06:00:00", "2024-01-06 06:00:00"))
    scan = documents.read_log_docs(spark, path, "svc-1", start, end, ["service_name", "timestamp_dt"])
    want = logs.where("service_name = 'svc-1' AND timestamp_dt BETWEEN '2024-01-05 06:00:00' AND '2024-01-06 06:00:00'")
    assert scan.count() == want.count() > 0
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan and "EqualTo(service_name,svc-1)" in plan
    renamed = str(tmp_path / "renamed")
    docs.withColumnRenamed("service_name", "svc").write.parquet(renamed)
    mapped = documents.read_log_docs(spark, renamed, fields={"service": "svc"})
    assert mapped.select("service_name").distinct().count() == 8
    assert reports.dataset_stats(spark.read.parquet(path)).collect()[0].doc_count == docs.count()


def test_run_all(spark, tmp_path):
    ev = views.events(spark, SMALL)
    raw = tmp_path / "raw"
    raw.mkdir()
    for service, rows in {
        name: views.event_lines(ev).where(F.col("service_name") == name).orderBy("event_id").collect()
        for name in ("svc-1", "svc-2")
    }.items():
        body = "".join(f'{r.ts_ms},"{r.message}"\n' for r in rows)
        (raw / f"{service}.csv").write_text("timestamp,message\n" + body)
    paths = jobs.run_all(
        spark, str(tmp_path / "base"), 1, log_path=str(raw), extra_metrics=views.infra_metrics(ev, "6 hours"),
        bucket="6 hours", sigma=2.5, window_minutes=720,
    )
    audit = spark.read.parquet(paths["audit"]).orderBy("created_at").collect()
    assert [r.query_type for r in audit] == ["ingest", "baselines", "detect", "diagnose", "evaluate"]
    assert all(r.error is None for r in audit)
    incidents = tables.read_incidents(spark, paths["incidents"]).collect()
    assert incidents and {r.service_name for r in incidents} <= {"svc-1", "svc-2"}
    assert all(r.root_cause for r in incidents)
    jobs.run_all(
        spark, str(tmp_path / "base"), 2, log_path=str(raw), extra_metrics=views.infra_metrics(ev, "6 hours"),
        bucket="6 hours", sigma=2.5, window_minutes=720,
    )
    again = tables.read_incidents(spark, paths["incidents"]).collect()
    assert sorted(r.id for r in again) == sorted(r.id for r in incidents)


def test_streams_match_batch(spark, tmp_path):
    logs = views.event_logs(views.events(spark, SMALL)).drop("event_id")
    source = str(tmp_path / "logs")
    logs.orderBy("timestamp_dt").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(logs.schema).parquet(source)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    streams.append_to_table(streams.rollup_stream(stream, "1 minute", "1 day"), out, check).awaitTermination()
    got = spark.read.parquet(out).where("metric_name <> 'latency_p95'")
    from triagelake.operators.rollup import aggregate_to_metrics

    batch = aggregate_to_metrics(logs, "1 day").where("metric_name <> 'latency_p95' AND timestamp < '2024-01-30'")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))

    metrics = spark.read.parquet(out)
    base = baselines.metric_baselines(metrics, min_samples=10)
    anomalies = streams.detect_stream(spark.readStream.schema(metrics.schema).parquet(out), base, 2.0)
    found, first = str(tmp_path / "found"), str(tmp_path / "first")
    streams.append_to_table(anomalies, found, str(tmp_path / "c2")).awaitTermination()
    want = detect.detect_anomalies(metrics, base, 2.0)
    assert spark.read.parquet(found).count() == want.count() > 0


def test_incidents_do_not_depend_on_arrival(spark, tmp_path):
    """Runs of anomalies are the same in whatever order these come, and scored like the batch job's incidents."""
    at = "2024-01-01 0{}:00:00"
    rows = [(at.format(2), "a", "latency_p95", 5.5), (at.format(0), "a", "latency_p95", 3.2), (at.format(1), "a", "error_rate", -4.2),
            (at.format(0), "b", "cpu_usage", 3.6), ("2024-01-01 20:00:00", "a", "latency_p95", 3.1), ("2024-01-09 00:00:00", "a", "cpu_usage", 9.0)]
    want = [("2024-01-01 00:00:00", "a", "error_spike", "critical"), ("2024-01-01 00:00:00", "b", "resource_exhaustion", "medium"),
            ("2024-01-01 20:00:00", "a", "latency_spike", "low")]
    for name, arrival in [("forth", rows), ("back", [*rows[4::-1], rows[5]])]:
        folder = str(tmp_path / name)
        for row in arrival:
            time.sleep(0.01)
            spark.createDataFrame([row], "ts string, service_name string, metric_name string, zscore double").select(
                F.col("ts").cast("timestamp").alias("timestamp"), "service_name", "metric_name", "zscore"
            ).coalesce(1).write.mode("append").parquet(folder)
        schema = spark.read.parquet(folder).schema
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(folder)
        out = str(tmp_path / f"{name}-out")
        streams.append_to_table(streams.first_incidents_stream(source, "12 hours"), out, f"{out}-state").awaitTermination()
        got = [(str(r.timestamp), *r[1:4]) for r in spark.read.parquet(out).collect()]
        assert sorted(got) == want, name


def test_metrics_of_a_range_read_their_days_only(spark, tmp_path):
    path = str(tmp_path / "metrics")
    days = spark.range(10).select(F.timestamp_seconds(F.col("id") * 86400 + F.lit(86399)).alias("timestamp"), F.col("id").cast("double").alias("v"))
    stamp = F.lit("2024-02-01").cast("timestamp")
    for seq in (1, 2):
        rows = days.select(
            "timestamp", F.lit("s").alias("service_name"), F.lit("m").alias("metric_name"), (F.col("v") * seq).alias("metric_value"),
            F.lit("t").alias("metric_type"), F.lit("logs").alias("source"), stamp.alias("created_at"),
        )
        tables.append_batch(rows, path, seq, METRIC)
    start, end = (F.lit(x).cast("timestamp") for x in ("1970-01-03 23:59:59", "1970-01-05 00:00:00"))
    some = tables.read_metrics(spark, path, start, end)
    assert some.columns == METRIC.fieldNames()
    assert sorted(r.metric_value for r in some.collect()) == [4.0, 6.0]
    assert tables.read_metrics(spark, path).count() == 10
    assert re.search(r"PartitionFilters: \[[^\]]*ds#\d+ >= 1970-01-03[^\]]*ds#\d+ <= 1970-01-05", plan_of(some))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    ev = views.events(spark, SMALL)
    logs = views.event_logs(ev)
    from triagelake.operators import rollup

    plan = plan_of(rollup.error_rate_by_bucket(logs))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    assert "WindowGroupLimit" in plan_of(detect.latest_readings(spark.createDataFrame([], METRIC)))
    joined = interval_join(
        spark.createDataFrame([], METRIC), views.event_labels(ev), ["service_name"], "timestamp", "window_start",
        "window_end", 3600,
    )
    assert "CartesianProduct" not in plan_of(joined) and "NestedLoop" not in plan_of(joined)
    everything = [rollup.aggregate_to_metrics(logs), detect.incidents_from_anomalies(
        detect.detect_anomalies(spark.createDataFrame([], METRIC), baselines.metric_baselines(spark.createDataFrame([], METRIC)))
    )]
    for df in everything:
        text = plan_of(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.columns == ["timestamp", "service_name", "incident_type", "severity", "confidence_score", "root_cause"]
    df.collect()
    assert set(entry.oracle_sql()) <= set(entry.queries())


FAST = [
    "strip_ansi", "parse_log_line", "resolve_timestamp", "safe_numeric", "normalize_cloud_metric", "merge_continuations",
    "merge_document_lines", "error_rate_by_bucket", "bucket_profile", "latest_readings", "incident_metric_window",
    "evaluate_detections", "evaluate_by_service", "summary_report", "parse_root_cause", "sub_windows", "read_logs",
]


@pytest.mark.parametrize("name", FAST)
def test_catalogue_matches_sql(spark, name):
    frame = entry.queries()[name](spark, SMALL)
    assert difference(frame, connect(SMALL), entry.oracle_sql()[name]) is None


def test_incident_schema(spark):
    df = detect.incidents_from_anomalies(spark.createDataFrame([], "timestamp timestamp, service_name string, metric_name string, zscore double, source string"))
    assert df.columns == INCIDENT.fieldNames()
