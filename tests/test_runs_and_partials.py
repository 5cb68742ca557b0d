"""Commit log, compaction, day partials, runs over split input, streams into tables, cuts in log files of any shape."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from test_log_files import expected_entries, expected_rows, random_file
from triagelake.operators import timeseries
from triagelake.operators.baselines import metric_baselines
from triagelake.plans import event_views as views
from triagelake.plans import jobs
from triagelake.schemas import INCIDENT, LOG, METRIC
from triagelake.sources import day_partials, documents, table_log, tables
from triagelake.sources.log_files import entries_from_rows, read_log_csv
from triagelake.streaming import streams

SMALL = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 3, 1)


def readings(spark, rows):
    """Metric rows from (hours since T0, service, value)."""
    made = [(T0 + dt.timedelta(hours=h), s, "m", float(v), "latency", "logs", T0) for h, s, v in rows]
    return spark.createDataFrame(made, METRIC)


def stored(spark, path):
    return sorted((r.timestamp, r.service_name, r.metric_value) for r in tables.read_metrics(spark, path).collect())


def test_a_reader_sees_one_state_during_compaction(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for seq in (1, 2, 3):
        rows = tables.append_batch(readings(spark, [(h, "s", seq * 100 + h) for h in range(0, 24 * seq, 5)]), path, seq, METRIC)
        assert rows == len(range(0, 24 * seq, 5))
    before = tables.read_metrics(spark, path)
    want = stored(spark, path)
    assert tables.compact_metrics(spark, path) == 2  # the third day lies in one batch only and stays where it is
    assert sorted((r.timestamp, r.service_name, r.metric_value) for r in before.collect()) == want == stored(spark, path)
    state = table_log.current(spark, path)
    assert len(state.live) == 2 and state.base == 3
    files = " ".join(tables.read_metrics(spark, path).inputFiles())
    assert "ingest_seq=1" not in files and "ingest_seq=2" not in files
    assert state.changed == {"2024-03-01": 3, "2024-03-02": 3, "2024-03-03": 3}
    with pytest.raises(ValueError, match="compacted base"):
        tables.append_batch(readings(spark, [(0, "s", 1)]), path, 2, METRIC)
    tables.append_batch(readings(spark, [(0, "s", -1)]), path, 4, METRIC)
    assert (T0, "s", -1.0) in stored(spark, path)
    gone = table_log.vacuum(spark, path, versions=1)
    assert len(gone) == 2 and len(stored(spark, path)) == len(want)


def test_commits_of_two_writers_both_count(spark, tmp_path):
    path = str(tmp_path / "metrics")
    added = [tables.write_batch(readings(spark, [(seq, "s", seq)]), path, seq, METRIC)[0] for seq in (1, 2)]
    tried = []

    def slow(state):
        if not tried:  # another writer commits between this one's look and its commit
            tried.append(1)
            table_log.commit(spark, path, lambda s: table_log.with_batch(s, added[1]))
        return table_log.with_batch(state, added[0])

    table_log.commit(spark, path, slow)
    assert [x[2] for x in stored(spark, path)] == [1.0, 2.0]


def test_an_incomplete_version_does_not_count(spark, tmp_path):
    path = str(tmp_path / "metrics")
    tables.append_batch(readings(spark, [(0, "s", 1)]), path, 1, METRIC)
    (tmp_path / "metrics" / "_log" / "000000000002").write_text('{"version": 2, "live": [')
    assert len(stored(spark, path)) == 1
    tables.append_batch(readings(spark, [(1, "s", 2)]), path, 2, METRIC)
    assert table_log.current(spark, path).version == 3 and len(stored(spark, path)) == 2


def test_compaction_gives_way_to_a_replaced_batch(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for seq in (1, 2):
        tables.append_batch(readings(spark, [(0, "s", seq)]), path, seq, METRIC)
    seen = table_log.current(spark, path)
    tables.append_batch(readings(spark, [(0, "s", 7)]), path, 2, METRIC)
    with pytest.raises(RuntimeError, match="compact it again"):
        table_log.compacted(table_log.current(spark, path), seen, table_log.Live(2, "x", ["2024-03-01"]), 2)


def test_tables_without_days_are_compacted(spark, tmp_path):
    path = str(tmp_path / "incidents")
    ev = views.events(spark, SMALL)
    found = views.event_incidents(ev)
    tables.append_batch(found, path, 0, INCIDENT)
    tables.append_batch(found.where("id % 2 = 0").withColumn("resolved", F.lit(True)), path, 1, INCIDENT)
    want = sorted((r.id, r.resolved) for r in tables.read_incidents(spark, path).collect())
    tables.compact(spark, path, INCIDENT, ["id"], ["ingest_seq"])
    assert len(table_log.current(spark, path).live) == 1
    assert sorted((r.id, r.resolved) for r in tables.read_incidents(spark, path).collect()) == want


def rows_of(df):
    return {(r.service_name, r.metric_name): r for r in df.collect()}


def test_baselines_by_day_equal_those_of_all_readings(spark, tmp_path):
    """Three batches: a history, later days with some corrected readings, and one that takes back what it replaces."""
    draw = random.Random(4)
    metrics, days = str(tmp_path / "metrics"), str(tmp_path / "days")
    history = [(h, s, round(draw.expovariate(0.01), 2)) for h in range(240) for s in ("a", "b")] + [(h, "few", 1) for h in range(4)]
    batches = [
        history,
        [(h, "a", round(draw.expovariate(0.01), 2)) for h in range(240, 290)] + [(h, "a", 7777) for h in range(30, 40)],
        [(31, "a", float("nan")), (32, "b", 12.5)],
    ]
    read = []
    for seq, batch in enumerate(batches, 1):
        tables.append_batch(readings(spark, batch), metrics, seq, METRIC)
        read.append(day_partials.update_day_partials(spark, metrics, days))
    assert len(read[0]) == 10 and read[1] == ["2024-03-02", "2024-03-11", "2024-03-12", "2024-03-13"]
    assert read[2] == ["2024-03-02"]
    tables.compact_metrics(spark, metrics)
    assert day_partials.update_day_partials(spark, metrics, days) == []
    got = rows_of(day_partials.baselines_from_partials(day_partials.read_day_partials(spark, days)))
    want = rows_of(metric_baselines(tables.read_metrics(spark, metrics)))
    assert set(got) == set(want) == {("a", "m"), ("b", "m")}
    for key, row in want.items():
        for name in want[key].asDict():
            assert got[key][name] == (pytest.approx(row[name], rel=1e-12) if isinstance(row[name], float) else row[name]), name
    recent = day_partials.read_day_partials(spark, days, "2024-03-08")
    since = metric_baselines(tables.read_metrics(spark, metrics), since=F.lit("2024-03-08").cast("timestamp"))
    assert rows_of(day_partials.baselines_from_partials(recent))["a", "m"].p95 == pytest.approx(rows_of(since)["a", "m"].p95)


def test_an_emptied_day_leaves_the_partials(spark, tmp_path):
    metrics, days = str(tmp_path / "metrics"), str(tmp_path / "days")
    tables.append_batch(readings(spark, [(h, "a", h) for h in range(48)]), metrics, 1, METRIC)
    day_partials.update_day_partials(spark, metrics, days)
    tables.append_batch(readings(spark, [(h, "a", h) for h in range(24)]), metrics, 1, METRIC)
    assert day_partials.update_day_partials(spark, metrics, days) == ["2024-03-01", "2024-03-02"]
    assert day_partials.read_day_partials(spark, days).agg(F.sum("_n")).first()[0] == 24
    assert day_partials.read_day_partials(spark, str(tmp_path / "none")).count() == 0


def as_files(folder, lines):
    """Raw lines, (service, ts_ms, message) rows, as one landed CSV file for each service and call."""
    folder.mkdir(exist_ok=True)
    for service in sorted({r.service_name for r in lines}):
        body = "".join(f'{r.ts_ms},"{r.message}"\n' for r in lines if r.service_name == service)
        sub = folder / service
        sub.mkdir(exist_ok=True)
        (sub / f"part-{len(list(sub.iterdir()))}.csv").write_text("timestamp,message\n" + body)


def test_two_runs_over_split_input_equal_one_over_the_whole(spark, tmp_path):
    """Log files and documents come in two parts, with late rows in the second one; cloud responses stay the same."""
    ev = views.events(spark, SMALL)
    lines = views.event_lines(ev).orderBy("event_id").collect()
    late = [r for r in lines if r.event_id % 9 == 0 or r.event_id > 800]
    docs = views.event_logs(ev).withColumn("log_level", F.upper("level")).withColumn(
        "service_name", F.concat(F.lit("doc-"), "service_name")
    )
    is_late = (F.col("event_id") % 7 == 0) | (F.col("event_id") > 700)
    docs = docs.withColumn("arrived", F.when(is_late, F.lit("2024-03-02")).otherwise(F.lit("2024-03-01")).cast("timestamp"))
    cloud = tmp_path / "cloud"
    cloud.mkdir()
    (cloud / "r.json").write_text("".join(
        '{"Namespace": "AWS/RDS", "MetricName": "DatabaseConnections", "Resource": "db/main", "Datapoints": ['
        + ", ".join(f'{{"Timestamp": "2024-01-{d:02d}T{h:02d}:00:00Z", "Maximum": {900 if (d, h) == (15, 6) else h + d}}}' for d in range(1, 29))
        + "]}\n" for h in (0, 6, 12, 18)
    ))
    common = dict(
        bucket="6 hours", service_from="dir", sigma=2.0, window_minutes=720, arrived="arrived", cloud_path=str(cloud),
        cloud_service=F.when(F.col("Namespace") == "AWS/RDS", F.lit("svc-1")),
    )
    whole, split = str(tmp_path / "whole"), str(tmp_path / "split")
    as_files(tmp_path / "all", lines)
    one = jobs.run_all(spark, whole, 1, log_path=str(tmp_path / "all"), docs=docs, **common)
    as_files(tmp_path / "landed", [r for r in lines if r not in late])
    jobs.run_all(spark, split, 1, log_path=str(tmp_path / "landed"), docs=docs.where(~is_late), **common)
    as_files(tmp_path / "landed", late)
    for _ in range(2):  # the second run is repeated, which changes nothing
        two = jobs.run_all(spark, split, 2, log_path=str(tmp_path / "landed"), docs=docs, **common)

    def values(paths):
        return sorted(
            (r.timestamp, r.service_name, r.metric_name, r.source, r.metric_value)
            for r in tables.read_metrics(spark, paths["metrics"]).collect()
        )

    def learnt(paths):
        found = tables.read_latest_baselines(spark, paths["baselines"]).collect()
        return {(r.service_name, r.metric_name): (r.sample_count, round(r.mean, 9), round(r.p95, 9)) for r in found}

    assert values(one) == values(two)
    assert learnt(one) == learnt(two) and learnt(one)["svc-1", "db_connections"][0] == 112
    parsed = [tables.read_batches(spark, x["parsed_logs"], LOG).drop("ingest_seq") for x in (one, two)]
    assert sorted(map(str, parsed[0].collect())) == sorted(map(str, parsed[1].collect()))
    audit = spark.read.parquet(two["audit"]).where("query_type = 'ingest'").orderBy("created_at").collect()
    assert audit[0].result_count > audit[1].result_count == audit[2].result_count > 0


def test_a_replayed_micro_batch_replaces_itself(spark, tmp_path):
    """The query stops after a batch was written and before the stream knows, and starts again."""
    source, path, state = (str(tmp_path / x) for x in ("source", "metrics", "state"))
    readings(spark, [(h, "s", h) for h in range(30)]).drop("created_at").coalesce(1).write.parquet(source)
    readings(spark, [(h, "s", h + 100) for h in range(20, 40)]).drop("created_at").coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    streams.upsert_stream(stream, path, state).awaitTermination()
    want = stored(spark, path)
    assert len(want) == 40 and len(table_log.current(spark, path).live) == 2
    last = sorted((tmp_path / "state" / "commits").glob("[0-9]*"))[-1]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    streams.upsert_stream(stream, path, state).awaitTermination()
    assert stored(spark, path) == want and len(table_log.current(spark, path).live) == 2
    assert tables.read_batches(spark, path, METRIC).count() == 50


def test_documents_are_found_in_any_session_zone(spark, tmp_path):
    docs = spark.createDataFrame([(1_709_254_800_000_000 + i * 3_600_000_000, f"s{i}") for i in range(30)], "_timestamp long, service_name string")
    path = str(tmp_path / "docs")
    documents.write_log_documents(docs, path)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            for i in range(30):
                at = F.timestamp_micros(F.lit(1_709_254_800_000_000 + i * 3_600_000_000))
                assert documents.read_log_docs(spark, path, start=at, end=at).count() == 1, (name, i)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("header", ["timestamp,message", "message,timestamp"])
def test_files_are_cut_in_any_column(spark, tmp_path, small_blocks, header):
    """A file with its time second gives as many owner blocks as one with its time first."""
    text = random_file(random.Random(11), header, 300)
    (tmp_path / "s.csv").write_text(text, encoding="utf-8", newline="")
    rows = read_log_csv(spark, str(tmp_path))
    got = [(r.ts_ms, r.message) for r in rows.orderBy("block", "rid").collect()]
    assert got == expected_rows(text)
    assert rows.select("block").distinct().count() > 12
    entries = entries_from_rows(rows, ["file", "service_name"], aligned=True).collect()
    assert sorted((r.ts_ms, r.message, r.n_continuations) for r in entries) == sorted(expected_entries(expected_rows(text)))


def test_a_quote_that_never_closes_is_an_error_with_its_place(spark, tmp_path, small_blocks):
    body = "".join(f'{1709287200000 + i},"line {i}"\n' for i in range(300))
    (tmp_path / "s.csv").write_text("timestamp,message\n" + body + '1709287300000,"open\n' + body.replace('"', "'"))
    with pytest.raises(Exception, match="an entry has more than 2000 bytes, in file -?[0-9]+, block [0-9]+"):
        read_log_csv(spark, str(tmp_path), max_record=2000).collect()
    assert read_log_csv(spark, str(tmp_path)).count() == 301


def test_a_long_grid_of_one_service_is_dealt_out(spark):
    one = spark.createDataFrame([("a",)], "service_name string")
    start = F.lit("2024-01-01").cast("timestamp")
    end = start + F.expr("interval 1000000 seconds")
    grid = timeseries.time_grid(one, ["m"], start, end, step_minutes=1, chunk=100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = grid.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in parts) == 16667 and max(r["count"] for r in parts) < 10000
    assert grid.select("timestamp").distinct().count() == 16667
    assert grid.agg(F.max("timestamp")).first()[0] == dt.datetime(2024, 1, 12, 13, 46)
