"""Operators against brute force and hand-made cases."""

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagelake.functions import scores
from triagelake.functions.text import valid_epoch_ms
from triagelake.operators import baselines, detect, diagnose, evaluation, quantiles, reports, rollup, timeseries, upserts
from triagelake.operators.intervals import interval_join
from triagelake.operators.quantiles import grouped_profile, value_bin
from triagelake.operators.segments import merge_continuations
from triagelake.plans import jobs

T0 = dt.datetime(2024, 3, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


METRIC = "timestamp timestamp, service_name string, metric_name string, metric_value double, source string"


def test_percentiles_match_numpy(spark):
    """Small and large groups, repeated, negative, tiny and missing values, a group without any value."""
    rng = random.Random(7)
    groups = {
        "hot": [round(rng.expovariate(0.01), 2) for _ in range(600)],
        "equal": [5.0] * 40,
        "signed": [rng.uniform(-1e-3, 1e6) * rng.choice([-1, 1]) for _ in range(60)] + [0.0] * 5,
        "one": [3.25], "two": [1.0, 2.0], "none": [], None: [1.0, 4.0, 9.0],
    }
    rows = [(k, v, 1) for k, vs in groups.items() for v in vs] + [("none", None, 1), ("hot", None, 1)]
    df = spark.createDataFrame(rows, "k string, v double, one int")
    points = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    got = {
        r.k: r for r in grouped_profile(df, ["k"], "v", points, {"total": F.col("one")}).collect()
    }
    assert set(got) == set(groups)
    for key, values in groups.items():
        assert got[key].n_values == len(values)
        assert got[key].total == len(values) + (key in ("none", "hot"))
        for name, p in points.items():
            if values:
                assert got[key][name] == pytest.approx(np.percentile(values, p * 100), rel=1e-12, abs=1e-12)
            else:
                assert got[key][name] is None


def test_refinement_settles_values_that_lie_close_together(spark):
    """One bin with very many different values, and one whose values halve their distance again and again."""
    close = [1000.0 + i / 4096 for i in range(5000)]
    nested = [1000.0 + 0.5 ** i for i in range(40)]
    rows = [("close", v) for v in close] + [("nested", v) for v in nested] + [("ties", v) for v in [1000.0] * 50 + close[:7]]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    points = {f"p{i}": i / 40 for i in range(41)}
    for row in grouped_profile(df, ["k"], "v", points, moments=True).collect():
        values = [v for k, v in rows if k == row.k]
        assert row["mean"] == pytest.approx(np.mean(values), rel=1e-12)
        assert row["stddev"] == pytest.approx(np.std(values), rel=1e-9)
        for name, p in points.items():
            assert row[name] == pytest.approx(np.percentile(values, p * 100), rel=1e-13), (row.k, name)


def test_value_bins_are_monotone(spark):
    values = sorted([-1e300, -5.0, -1e-320, 0.0, 1e-320, 1e-9, 0.999, 1.0, 1.0000001, 2.0, 1e300])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    bins = [r[0] for r in df.orderBy("v").select(value_bin(F.col("v"))).collect()]
    assert bins == sorted(bins) and bins[3] == 0


def test_approximate_profile(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(100)], "k string, v double")
    row = grouped_profile(df, ["k"], "v", {"p95": 0.95}, exact=False).collect()[0]
    assert row.n_values == 100 and abs(row.p95 - 94) <= 1


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_merge_across_blocks(spark, block_rows):
    rng = random.Random(block_rows)
    rows = []
    for file in ("a", "b", "c"):
        for i in range(60):
            opens = rng.random() < 0.3 and file != "c"
            rows.append((file, i // block_rows, i, "1709287200000" if opens else "", f"{file}{i}"))
    want, current = [], None
    for file, _, i, ts, message in rows:
        if current and current[0] != file:
            current = None
        if ts:
            current = [file, i, message, 0]
            want.append(current)
        elif current:
            current[2] += "\n" + message
            current[3] += 1
    df = spark.createDataFrame(rows, "file string, block bigint, rid bigint, ts_ms string, message string").repartition(5)
    got = merge_continuations(df, valid_epoch_ms(F.col("ts_ms")), ["file"]).collect()
    assert sorted((r.file, r.rid, r.message, r.n_continuations) for r in got) == sorted(map(tuple, want))


def test_interval_join_brute_force(spark):
    rng = random.Random(3)
    points = [(i, rng.choice("ab"), at(rng.randrange(2000))) for i in range(80)]
    spans = [(i, rng.choice("ab"), at(s), at(s + rng.choice([-5, 0, 3, 400]))) for i, s in enumerate(rng.choices(range(2000), k=30))]
    want = {(p[0], s[0]) for p in points for s in spans if p[1] == s[1] and s[2] <= p[2] <= s[3]}
    pdf = spark.createDataFrame(points, "p int, k string, ts timestamp")
    sdf = spark.createDataFrame(spans, "s int, k string, a timestamp, b timestamp")
    joined = interval_join(pdf, sdf, ["k"], "ts", "a", "b", 600)
    assert sorted((r.p, r.s) for r in joined.collect()) == sorted(want)
    kept = interval_join(pdf, sdf, ["k"], "ts", "a", "b", 600, how="left").collect()
    assert {r.p for r in kept} == {p[0] for p in points}


def test_rollup_hand_case(spark):
    logs = spark.createDataFrame(
        [("s", at(0), True, 10.0, 500), ("s", at(1), False, 20.0, 200), ("s", at(4), False, None, None),
         ("s", at(5), False, None, None), ("s", None, True, 1.0, 500), ("t", at(0), False, 7.0, 404)],
        "service_name string, timestamp_dt timestamp, is_error boolean, latency_ms double, status_code int",
    )
    got = {(r.service_name, r.timestamp, r.metric_name): r.metric_value for r in rollup.aggregate_to_metrics(logs).collect()}
    assert got == {
        ("s", at(0), "error_rate"): 33.3333, ("s", at(0), "latency_p95"): 19.5, ("s", at(0), "http_5xx_rate"): 50.0,
        ("s", at(5), "error_rate"): 0.0, ("t", at(0), "error_rate"): 0.0, ("t", at(0), "latency_p95"): 7.0,
        ("t", at(0), "http_5xx_rate"): 0.0,
    }
    docs = logs.withColumn("log_level", F.when(F.col("is_error"), "ERROR").otherwise("INFO"))
    bucket = {(r.service_name, r.bucket_start): r for r in rollup.bucket_profile(docs, F.lit(T0), F.lit(at(5))).collect()}
    first = bucket[("s", at(0))]
    assert (first.doc_count, first.error_count, first.count_5xx, first.avg_latency, first.p95_latency) == (3, 1, 1, 15.0, 19.5)
    assert ("s", at(5)) not in bucket
    rows = rollup.buckets_to_metrics(rollup.bucket_profile(docs)).where("service_name = 's'").collect()
    values = {(r.timestamp, r.metric_name): r.metric_value for r in rows}
    assert values[(at(0), "http_5xx_rate")] == 33.3333 and values[(at(0), "log_volume")] == 3.0
    assert (at(5), "latency_p95") not in values


def test_baseline_gates(spark):
    rows = [(at(i), "big", "m10", float(i % 7), "logs") for i in range(10)]
    rows += [(at(i), "big", "m9", 1.0, "logs") for i in range(9)]
    rows += [(at(i), "big", "rest", 4.0, "logs") for i in range(81)]
    rows += [(at(i), "small", "m", 1.0, "logs") for i in range(99)]
    got = {(r.service_name, r.metric_name): r for r in baselines.metric_baselines(spark.createDataFrame(rows, METRIC)).collect()}
    assert set(got) == {("big", "m10"), ("big", "rest")}
    values = [float(i % 7) for i in range(10)]
    row = got[("big", "m10")]
    assert row.mean == pytest.approx(statistics.fmean(values)) and row.stddev == pytest.approx(statistics.pstdev(values))
    assert row.p99 == pytest.approx(np.percentile(values, 99)) and row.sample_count == 10
    assert (row.window_start, row.window_end) == (at(0), at(9)) and got[("big", "rest")].stddev == 0.0


BASELINE = "service_name string, metric_name string, mean double, stddev double, created_at timestamp, window_start timestamp"


def test_latest_baseline_and_readings(spark):
    rows = [("s", "m", 1.0, 1.0, at(0), at(0)), ("s", "m", 2.0, 1.0, at(9), at(0)), ("s", "n", 3.0, 1.0, at(1), at(0))]
    newest = baselines.latest_baseline(spark.createDataFrame(rows, BASELINE)).collect()
    assert sorted((r.metric_name, r.mean) for r in newest) == [("m", 2.0), ("n", 3.0)]
    readings = [(at(i), "s", "m", float(i), "logs") for i in range(5001)] + [(at(0), "t", "m", 1.0, "logs")]
    kept = detect.latest_readings(spark.createDataFrame(readings, METRIC))
    assert kept.where("service_name = 's'").count() == 5000 and kept.where("service_name = 't'").count() == 1
    assert kept.where("service_name = 's'").agg(F.min("metric_value")).collect()[0][0] == 1.0


def test_detection_and_log_first(spark):
    base = spark.createDataFrame(
        [("s", "error_rate", 0.0, 1.0, at(0), at(0)), ("s", "cpu_usage", 0.0, 1.0, at(0), at(0)),
         ("s", "flat", 0.0, 0.0, at(0), at(0))], BASELINE,
    )
    infra = [(at(3), "s", "cpu_usage", 9.0, "synthetic")]
    logs = [
        (at(2), "s", "error_rate", 3.0, "logs"), (at(1), "s", "error_rate", -4.0, "logs"),
        (at(0), "s", "error_rate", 2.99, "logs"), (at(0), "s", "flat", 99.0, "logs"), (at(0), "u", "error_rate", 9.0, "logs"),
    ]
    found = detect.detect_anomalies(spark.createDataFrame(logs + infra, METRIC), base)
    assert sorted((r.timestamp, r.zscore, r.severity) for r in found.collect()) == [
        (at(1), -4.0, "high"), (at(2), 3.0, "medium")
    ]
    incident = detect.incidents_from_anomalies(found).collect()[0]
    assert (incident.timestamp, incident.incident_type, incident.severity) == (at(1), "error_spike", "high")
    assert incident.confidence_score == 0.667 and incident.affected_metrics == ["error_rate"]
    assert incident.description == (
        "Detected anomalous error spike on s. Affected metrics: error_rate. Signal source(s): logs."
    )
    fallback = detect.detect_anomalies(spark.createDataFrame(infra, METRIC), base).collect()
    assert [(r.metric_name, r.zscore) for r in fallback] == [("cpu_usage", 9.0)]
    again = detect.create_incidents(found, detect.incidents_from_anomalies(found))
    assert again.count() == 0


def test_upserts(spark):
    rows = [(at(0), "s", "m", 1.0, "logs", 0), (at(0), "s", "m", 2.0, "cloudwatch", 1), (at(1), "s", "m", 3.0, "logs", 0)]
    df = spark.createDataFrame(rows, METRIC + ", ingest_seq int")
    assert sorted(r.metric_value for r in upserts.upsert_metrics(df, ["ingest_seq"]).collect()) == [2.0, 3.0]
    a, b = (df.where(f"ingest_seq = {i}").drop("ingest_seq") for i in (0, 1))
    assert sorted(r.source for r in upserts.union_sources(a, b).collect()) == ["cloudwatch", "logs"]
    schema = "timestamp timestamp, service_name string, incident_type string, severity string, description string"
    new = spark.createDataFrame([(at(0), "s", "x", "low", "b"), (at(0), "s", "x", "low", "a"), (at(1), "s", "x", "low", "c")], schema)
    old = spark.createDataFrame([(at(1), "s", "x", "high", "old")], schema)
    assert [r.description for r in upserts.insert_incidents_ignore(new, old).collect()] == ["a"]


LABELS = "gt_pos bigint, service_name string, incident_type string, window_start timestamp, window_end timestamp, label string"
DETECTED = "id bigint, timestamp timestamp, service_name string, incident_type string"


def test_evaluation_cases(spark):
    labels = spark.createDataFrame([
        (0, "a", "x", at(60), at(120), None), (1, "a", "y", at(90), at(150), "second"), (2, "b", "x", at(0), at(10), "b"),
        (3, "c", "x", at(0), at(10), "c"),
    ], LABELS)
    incidents = spark.createDataFrame([
        (1, at(100), "a", "x"), (2, at(30), "a", "x"), (3, at(30) - dt.timedelta(seconds=1), "a", "x"),
        (4, at(40), "b", "x"), (5, at(5), "d", "x"), (6, None, "c", "x"),
    ], DETECTED)
    pairs = evaluation.match_ground_truth(incidents, labels)
    assert sorted((r.id, r.gt_pos) for r in pairs.collect()) == [(1, 0), (1, 1), (2, 0), (4, 2)]
    credited = evaluation.first_label(pairs)
    assert sorted((r.id, r.gt_label) for r in credited.collect()) == [(1, "GT1"), (2, "GT1"), (4, "b")]
    total = evaluation.evaluate_detections(incidents, labels, credited).collect()[0]
    assert (total.tp, total.fp, total.fn, total.precision, total.recall, total.f1) == (2, 3, 2, 0.4, 0.5, 0.4444)
    by = {r.service_name: r for r in evaluation.evaluate_by_service(incidents, labels, credited).collect()}
    assert set(by) == {"a", "b", "c", "d"}
    assert (by["a"].tp, by["a"].fp, by["a"].fn, by["a"].recall) == (1, 1, 1, 0.5)
    assert (by["d"].precision, by["d"].recall, by["d"].f1) == (0.0, 0.0, 0.0)
    typed = evaluation.match_ground_truth(incidents, labels, match_type=True)
    assert sorted((r.id, r.gt_pos) for r in typed.collect()) == [(1, 0), (2, 0), (4, 2)]
    empty = evaluation.evaluation_report(incidents.limit(0), labels.limit(0))["summary"].collect()[0]
    assert (empty.tp, empty.fp, empty.fn, empty.precision, empty.f1) == (0, 0, 0, 0.0, 0.0)


def _scenario():
    """Four services, four infra metrics, 288 points every five minutes, two injected incidents."""
    ranges = {"cpu_usage": (20, 60), "memory_usage": (40, 70), "db_connections": (50, 150), "asg_capacity": (2, 8)}
    rows = []
    for s, service in enumerate(["Internal-core-ms", "External-core-ms-2", "User-ms-3", "Chargebee-EH-4"]):
        for m, (metric, (low, high)) in enumerate(ranges.items()):
            for i in range(288):
                wave = ((i * (7 + 2 * m) + 13 * s) % 41) / 40
                value = low + (high - low) * (0.4 + 0.2 * wave)
                if service == "External-core-ms-2" and 72 <= i <= 78 and metric == "db_connections":
                    value = 300 + (i % 3)
                if service == "Internal-core-ms" and 144 <= i <= 150 and metric != "db_connections":
                    value = {"asg_capacity": 20, "cpu_usage": 92, "memory_usage": 87}[metric] + (i % 3)
                rows.append((at(5 * i), service, metric, float(value), "synthetic"))
    return rows


def test_two_incident_scenario(spark):
    from triagelake.sources.tables import read_ground_truth

    metrics = spark.createDataFrame(_scenario(), METRIC).cache()
    base = baselines.metric_baselines(metrics).cache()
    assert base.count() == 16
    incidents = detect.incidents_from_anomalies(detect.detect_anomalies(metrics, base)).cache()
    found = {r.service_name: r for r in incidents.collect()}
    assert set(found) == {"External-core-ms-2", "Internal-core-ms"}
    assert found["External-core-ms-2"].incident_type == "db_saturation"
    assert found["External-core-ms-2"].timestamp == at(360)
    assert found["Internal-core-ms"].incident_type == "asg_capacity_limit"
    assert found["Internal-core-ms"].affected_metrics == ["asg_capacity", "cpu_usage", "memory_usage"]
    by_max = {r.id: r for r in diagnose.diagnose_incidents(incidents, metrics, base, elevated_by="max_abs").collect()}
    internal = by_max[found["Internal-core-ms"].id]
    assert internal.rule == "infrastructure_saturation" and internal.primary_metric == "asg_capacity"
    assert internal.correlated == ["cpu_usage", "memory_usage"]
    assert by_max[found["External-core-ms-2"].id].rule == "database_saturation"
    diluted = diagnose.diagnose_incidents(incidents, metrics, base).collect()
    assert {r.rule for r in diluted} <= {"application_error", "database_saturation", "infrastructure_saturation"}
    score = evaluation.evaluation_report(incidents, read_ground_truth(spark))["summary"].collect()[0]
    assert (score.tp, score.fp, score.fn, score.f1) == (2, 0, 0, 1.0)


def test_incident_without_readings_stays_undiagnosed(spark):
    metrics = spark.createDataFrame([(at(0), "s", "cpu_usage", 1.0, "synthetic")], METRIC)
    base = spark.createDataFrame([("s", "cpu_usage", 1.0, 0.0, at(0), at(0))], BASELINE)
    incidents = spark.createDataFrame(
        [(1, at(60), "s", False, None), (2, at(61), "s", False, None), (3, at(0), "s", True, None), (4, at(0), "s", False, "known")],
        "id bigint, timestamp timestamp, service_name string, resolved boolean, root_cause string",
    )
    got = diagnose.diagnose_incidents(incidents, metrics, base).collect()
    assert [(r.id, r.rule, r.correlated) for r in got] == [(1, "application_error", [])]


def test_constant_series_never_correlates(spark):
    rows = [(1, "s", at(i), "cpu_usage", float(i), "synthetic") for i in range(5)]
    rows += [(1, "s", at(i), "flat", 3.0, "logs") for i in range(5)]
    rows += [(1, "s", at(i), "down", -2.0 * i, "logs") for i in range(5)]
    rows += [(1, "s", at(0), "single", 1.0, "logs")]
    window = spark.createDataFrame(
        rows, "incident_id bigint, service_name string, timestamp timestamp, metric_name string, metric_value double, source string"
    )
    primary = spark.createDataFrame([(1, "cpu_usage")], "incident_id bigint, primary_metric string")
    got = diagnose.correlated_metrics(diagnose.co_observed_pairs(window, primary)).collect()
    assert [(r.metric_name, round(r.r, 6)) for r in got] == [("down", -1.0)]


def test_infra_fallback_by_name(spark):
    rows = [(1, "s", at(i), "cpu_usage", 9.0, "logs") for i in range(3)] + [(1, "s", at(0), "error_rate", 50.0, "logs")]
    rows += [(2, "s", at(i), "cpu_usage", 9.0, "logs") for i in range(3)] + [(2, "s", at(0), "queue", 7.0, "cloudwatch")]
    window = spark.createDataFrame(
        rows, "incident_id bigint, service_name string, timestamp timestamp, metric_name string, metric_value double, source string"
    )
    base = spark.createDataFrame(
        [("s", m, 0.0, 1.0, at(0), at(0)) for m in ("cpu_usage", "error_rate", "queue")], BASELINE
    )
    got = diagnose.elevated_infra(window, base).collect()
    assert sorted((r.incident_id, r.metric_name, r.zscore) for r in got) == [(1, "cpu_usage", 9.0), (2, "queue", 7.0)]


def test_time_helpers(spark):
    services = spark.createDataFrame([("s",), ("t",)], "service_name string")
    grid = timeseries.time_grid(services, ["m", "n"], F.lit(T0), F.lit(at(12)))
    assert grid.count() == 12
    metrics = spark.createDataFrame([(at(5 * i), "s", "m", float(i), "logs") for i in range(5)], METRIC)
    assert timeseries.grid_gaps(grid, metrics).count() == 9
    overrides = spark.createDataFrame(
        [("s", "m", at(5), at(10), 100.0, 1), ("s", "m", at(10), at(15), 200.0, 2), ("t", "m", at(0), at(99), 9.0, 3)],
        "service_name string, metric_name string, window_start timestamp, window_end timestamp, new_value double, priority int",
    )
    got = timeseries.override_in_windows(metrics, overrides).orderBy("timestamp").collect()
    assert [r.metric_value for r in got] == [0.0, 100.0, 200.0, 200.0, 4.0]
    span = spark.createDataFrame([(at(0), at(150)), (at(0), at(0)), (at(0), at(60))], "a timestamp, b timestamp")
    pieces = [(r.win_start, r.win_end) for r in timeseries.sub_windows(span, "a", "b").collect()]
    assert sorted(pieces) == sorted([(at(0), at(60)), (at(60), at(120)), (at(120), at(150)), (at(0), at(60))])


INCIDENT = "id bigint, timestamp timestamp, service_name string, incident_type string, severity string, root_cause string, confidence_score double, resolved boolean"


def test_reports(spark):
    rows = [(i, at(i), "s" if i % 2 else "t", "x", ["low", "medium", "critical"][i % 3], None, 0.5, i % 4 == 0) for i in range(12)]
    df = spark.createDataFrame(rows, INCIDENT)
    kpi = reports.incident_kpis(df).collect()[0]
    assert (kpi.total, kpi.critical, kpi.high, kpi.medium, kpi.low, kpi.resolved, kpi.avg_confidence) == (12, 4, 0, 4, 4, 3, 0.5)
    top = reports.open_incidents_by_service(df).collect()
    assert [(r.service_name, r.open_incidents, r.worst_severity) for r in top] == [("s", 6, "critical"), ("t", 3, "critical")]
    listed = reports.list_incidents(df, 9999, status="open", service="t").collect()
    assert [r.id for r in listed] == [10, 6, 2]
    assert reports.filter_incidents(df, status="anything").count() == 12
    assert reports.get_incident(df, 3).count() == 1 and reports.get_incident(df, 99).count() == 0
    assert reports.incidents_by_service_severity(df.where("service_name = 's'")).count() == 0
    assert reports.incidents_by_service_severity(df).count() == 6
    trend = reports.incident_trend_hourly(df, F.lit(at(24 * 60 + 6)))
    assert trend.agg(F.sum("count")).collect()[0][0] == 6
    assert [r.id for r in reports.list_pending(df).collect()][:2] == [11, 10]


def _readings(spark, values, start="2024-01-01 00:00:00"):
    rows = [(i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i long, metric_value double").select(
        (F.lit(start).cast("timestamp") + F.make_dt_interval(mins=F.col("i"))).alias("timestamp"),
        F.lit("a").alias("service_name"), F.lit("error_rate").alias("metric_name"), "metric_value",
        F.lit("error_rate").alias("metric_type"), F.lit("logs").alias("source"),
    )


def test_old_extremes_are_found_among_many_readings(spark):
    readings = _readings(spark, [1000.0 if i < 3 else i % 10 for i in range(6000)])
    known = baselines.metric_baselines(_readings(spark, [i % 10 for i in range(200)]))
    assert detect.detect_anomalies(readings, known).count() == 3
    assert detect.detect_anomalies(readings, known, n_latest=5000).count() == 0


def test_readings_that_are_not_finite_change_nothing(spark):
    clean = [i % 10 for i in range(200)] + [500]
    mixed = [*clean, float("nan"), float("inf"), float("-inf")]
    known = baselines.metric_baselines(_readings(spark, clean))
    assert baselines.metric_baselines(_readings(spark, mixed)).drop("window_end").collect() == known.drop("window_end").collect()
    found = detect.detect_anomalies(_readings(spark, mixed), known)
    assert [r.value for r in found.collect()] == [500.0]


@pytest.mark.parametrize("extra", [[], [float("nan")], [float("inf")], [float("-inf")], [1e9 + i / 1000 for i in range(3000)]])
def test_percentiles_do_not_depend_on_group_size(spark, extra):
    rows = spark.createDataFrame([("a", float(v)) for v in [*range(20), *extra]], "k string, v double")
    got = quantiles.grouped_profile(rows, ["k"], "v", {"p50": 0.5, "p99": 0.99}).first()
    want = rows.groupBy("k").agg(F.percentile("v", 0.5).alias("p50"), F.percentile("v", 0.99).alias("p99")).first()
    for x, y in ((got.p50, want.p50), (got.p99, want.p99)):
        assert x == pytest.approx(y, nan_ok=True)


def test_overrides_keep_every_reading_and_empty_grids_are_empty(spark):
    readings = _readings(spark, [1, 2]).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    none = spark.createDataFrame(
        [], "service_name string, metric_name string, window_start timestamp, window_end timestamp, new_value double, priority int"
    )
    assert sorted(r.metric_value for r in timeseries.override_in_windows(readings, none).collect()) == [1.0, 2.0]
    day = F.lit("2024-01-01").cast("timestamp")
    assert timeseries.time_grid(readings.select("service_name"), ["m"], day, day).count() == 0


def test_raw_documents_take_a_range_and_floating_epochs(spark):
    docs = spark.createDataFrame(
        [(1709287200000.0, "a"), (1709290800000.0, "a"), (1709290800000.0, "b")], "at double, svc string"
    ).select(F.col("at"), F.col("svc"), F.lit("info").alias("log_level"), F.lit("5").alias("latency_ms"), F.lit("200").alias("status_code"))
    start = F.lit("2024-03-01 10:30:00").cast("timestamp")
    found = jobs.ingest_docs(docs, start=start, raw=True, service="a", fields={"timestamp": "at", "service": "svc"})
    assert {str(r.timestamp) for r in found.collect()} == {"2024-03-01 11:00:00"}
    assert {r.service_name for r in found.collect()} == {"a"}


def test_limits_are_the_callers(spark):
    names = spark.range(600).select(F.concat(F.lit("s"), "id").alias("service_name"), F.lit("2024-01-01").cast("timestamp").alias("timestamp_dt"))
    day = F.lit("2024-01-01").cast("timestamp")
    assert reports.top_services(names, day, day).count() == 600
    assert reports.top_services(names, day, day, size=7).count() == 7


def test_rounding_of_large_values(spark):
    row = spark.range(1).select(
        scores.rounded(F.lit(123456789012.34565), 2).alias("a"), scores.rounded(F.lit(1e300), 2).alias("b"),
        scores.rounded(F.lit(2.5), 0).alias("c"),
    ).first()
    assert (row.a, row.b, row.c) == (123456789012.35, 1e300, 3.0)
