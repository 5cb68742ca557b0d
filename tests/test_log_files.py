"""Log files: parallel CSV reading and continuation merging against Python's csv module."""

import csv
import io
import random
import re

import pytest

from pyspark.sql import functions as F

from triagelake.sources.log_files import (
    discover_log_files,
    entries_from_rows,
    parse_entries,
    parse_stats,
    read_log_csv,
    read_logs,
)

OPEN = re.compile(r"^[0-9]{13}$")
PIECES = ["plain", 'say ""x""', "a,b", '5" disk', "line one\nline two", "", '"', "tab\there", "timestamp", "\n\n", "é"]


def expected_rows(text):
    """(ts, message) of every row after the header, the way the csv module reads them."""
    reader = csv.reader(io.StringIO(text, newline=""))
    header = [c.strip().lower() for c in next(reader)]
    ts_at = header.index("timestamp_ms") if "timestamp_ms" in header else header.index("timestamp")
    msg_at = header.index("message") if "message" in header else 1
    return [
        (row[ts_at].strip() if len(row) > ts_at else "", row[msg_at] if len(row) > msg_at else "")
        for row in reader if row
    ]


def expected_entries(rows):
    merged, current = [], None
    for ts, message in rows:
        if OPEN.match(ts):
            current = [ts, message, 0]
            merged.append(current)
        elif current is not None:
            current[1] += "\n" + message
            current[2] += 1
    return [tuple(entry) for entry in merged]


def random_file(rng, header, rows):
    out = [header]
    for _ in range(rows):
        kind = rng.random()
        ts = str(1709287200000 + rng.randrange(10**6)) if kind < 0.7 else rng.choice(["", "x", "12"])
        message = "".join(rng.choice(PIECES) for _ in range(rng.randrange(4)))
        style = rng.random()
        if style < 0.6:
            cell = '"' + message.replace('"', '""') + '"'
        elif style < 0.8:
            cell = message.replace("\n", " ").replace(",", ";").lstrip('"')
        else:
            cell = message.replace("\n", "|").replace('"', "'")
        out.append(f"{cell},{ts}" if header.startswith("message") else f"{ts},{cell}")
        if rng.random() < 0.05:
            out.append("")
    return "\n".join(out) + "\n"


@pytest.mark.parametrize("seed,header", [
    (1, "timestamp,message"), (2, " Timestamp_MS , Message"), (3, "timestamp,other"), (4, "message,timestamp"),
    (5, "timestamp,message"),
])
def test_parallel_csv_matches_csv_module(spark, tmp_path, seed, header):
    rng = random.Random(seed)
    texts = {f"svc-{i}": random_file(rng, header, rows) for i, rows in enumerate([150, 7, 40])}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8", newline="")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = read_log_csv(spark, str(tmp_path))
        got = {}
        for row in rows.orderBy("service_name", "block", "rid").collect():
            got.setdefault(row.service_name, []).append((row.ts_ms, row.message))
        entries = entries_from_rows(rows, ["file", "service_name"], aligned=True)
        merged = {}
        for row in entries.collect():
            merged.setdefault(row.service_name, []).append((row.ts_ms, row.message, row.n_continuations))
        blocks = rows.select("service_name", "block").distinct().where("service_name = 'svc-0'").count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    for name, text in texts.items():
        assert got[name] == expected_rows(text), name
        assert sorted(merged[name]) == sorted(expected_entries(expected_rows(text))), name
    if not header.startswith("message"):
        assert blocks > 3


def test_read_logs_fixture(spark, tmp_path):
    (tmp_path / "api-1.csv").write_text(
        "timestamp,message\n"
        ",orphan line\n"
        "1709287200000,info|abc|t1|2024-03-01T10:00:00.000Z:\t[End Request] GET /x 503 Down 12.5ms\n"
        '1709287201000,"error|a|t|[r1|]2024-03-01T10:00:01.000Z:\tquote ""q""\nsecond"\n'
        ",at frame one\n"
        ",at frame two\n"
        "1709287202000,plain text\n"
    )
    (tmp_path / "skip.csv").write_text("when,what\n1,2\n")
    (tmp_path / "ignored.txt").write_text("timestamp,message\n")
    logs = {row.correlation_id: row for row in read_logs(spark, str(tmp_path)).collect()}
    assert set(logs) == {"abc", "a"}
    assert logs["abc"].status_code == 503 and logs["abc"].latency_ms == 12.5 and not logs["abc"].is_error
    assert logs["a"].log_text == 'quote "q"\nsecond\nat frame one\nat frame two'
    assert logs["a"].req_id == "r1" and logs["a"].is_error and logs["a"].service_name == "api-1"
    rows = read_log_csv(spark, str(tmp_path))
    stats = parse_stats(
        parse_entries(entries_from_rows(rows, ["file", "service_name"], aligned=True)), ["service_name"]
    ).collect()[0]
    assert (stats.total_lines, stats.parsed_lines, stats.failed_lines, stats.merged_stack_traces) == (3, 2, 1, 2)


def test_missing_folder_and_dir_layout(spark, tmp_path):
    assert discover_log_files(spark, str(tmp_path / "none")).count() == 0
    assert read_logs(spark, str(tmp_path / "none")).count() == 0
    folder = tmp_path / "logs" / "service_name=svc-9"
    folder.mkdir(parents=True)
    (folder / "part-0.csv").write_text("timestamp,message\n1709287200000,info|a|t|2024-03-01T10:00:00Z: hi\n")
    rows = read_logs(spark, str(tmp_path / "logs"), service_from="dir").collect()
    assert [(r.service_name, r.log_text) for r in rows] == [("svc-9", "hi")]


def test_bad_utf8_is_replaced(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes(b"timestamp,message\n1709287200000,info|a|t|2024-03-01T10:00:00Z: caf\xff\n")
    assert read_logs(spark, str(tmp_path)).select(F.col("log_text")).collect()[0][0] == "caf\ufffd"


def test_changed_splits_are_an_error(spark, tmp_path):
    """The two passes must cut the files alike; otherwise reading fails instead of losing lines."""
    body = "".join(f"1709287200{i:03d},info|a|t|2024-03-01T10:00:00Z: hi\n" for i in range(200))
    (tmp_path / "s.csv").write_text("timestamp,message\n" + body)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = read_log_csv(spark, str(tmp_path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1700")
        with pytest.raises(Exception, match="splits differ"):
            rows.collect()
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        assert read_log_csv(spark, str(tmp_path)).count() == 200
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
