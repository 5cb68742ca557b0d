"""Queries of sources, sinks and table maintenance."""

from pyspark.sql import functions as F

from triagelake.functions.scores import rounded
from triagelake.operators import upserts
from triagelake.plans import event_views as views
from triagelake.plans import sql_views as q
from triagelake.plans.registry import query
from triagelake.schemas import BASELINE, INCIDENT, METRIC
from triagelake.session import materialize, scratch_path
from triagelake.sources import tables
from triagelake.sources.documents import read_log_docs, scan_docs, to_json_lines, to_log_documents, write_log_documents
from triagelake.sources.log_files import (
    discover_log_files,
    entries_from_rows,
    parse_entries,
    parse_stats,
    read_log_csv,
    read_logs,
)

FILE_MESSAGE = """message || CASE WHEN k % 7 = 0 THEN chr(10) || '  said "' || event_type || '", again'
    || chr(10) || 'end' ELSE '' END"""


def _csv_folder(spark, sf):
    """The raw lines as quoted CSV files, one folder per service; some messages hold quotes and line feeds."""
    lines = views.event_lines(views.events(spark, sf))
    extra = F.concat(F.lit('\n  said "'), F.col("event_type"), F.lit('", again\nend'))
    message = F.concat("message", F.when(F.col("k") % 7 == 0, extra).otherwise(""))
    path = scratch_path(spark, "raw-logs")
    (
        lines.select("service_name", F.col("ts_ms").alias("timestamp"), message.alias("message"))
        .write.partitionBy("service_name").option("header", True).option("quoteAll", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


@query("read_log_csv", f"WITH {q.LINES} SELECT service_name, ts_ms, {FILE_MESSAGE} AS message FROM lines")
def csv_rows(spark, sf):
    rows = read_log_csv(spark, _csv_folder(spark, sf), service_from="dir")
    return rows.select("service_name", "ts_ms", "message")


@query("discover_log_files", f"WITH {q.EV} SELECT DISTINCT service_name FROM ev")
def discover(spark, sf):
    return discover_log_files(spark, _csv_folder(spark, sf), service_from="dir").select("service_name").distinct()


@query("read_logs", f"""WITH {q.LINES}, c AS (
  SELECT event_id, service_name, ts_ms, {q.clean('(' + FILE_MESSAGE + ')')} AS clean FROM lines), p AS (
  SELECT service_name, ts_ms, lower({q.part(1)}) AS level, {q.part(2)} AS correlation_id, {q.part(3)} AS tenant_id,
    {q.part(4)} AS req_id, {q.part(5)} AS timestamp, {q.part(6)} AS log_text
  FROM c WHERE regexp_matches(clean, '{q.LINE}'))
SELECT service_name, level, correlation_id, tenant_id, req_id, timestamp, ts_ms, {q.utc('timestamp')} AS timestamp_dt,
  {q.status_of('log_text')} AS status_code, {q.latency_of('log_text')} AS latency_ms,
  level IN ('error','fatal','critical','warn','warning') OR {q.keyword('log_text')} AS is_error, log_text FROM p""")
def logs_from_files(spark, sf):
    return read_logs(spark, _csv_folder(spark, sf), service_from="dir")


@query("parse_stats", f"""WITH {q.PARSED} SELECT service_name, count(*) AS total_lines,
  count(*) FILTER (WHERE parsed) AS parsed_lines, count(*) FILTER (WHERE NOT parsed) AS failed_lines,
  CAST(sum(n_continuations) AS BIGINT) AS merged_stack_traces,
  count(*) FILTER (WHERE parsed AND is_error) AS error_count, count(latency_ms) AS latency_count,
  count(*) FILTER (WHERE parsed AND timestamp_dt IS NOT NULL) AS valid_documents
FROM parsed_logs GROUP BY service_name""")
def stats(spark, sf):
    rows = views.event_rows(views.events(spark, sf))
    return parse_stats(parse_entries(entries_from_rows(rows, ["service_name"])), ["service_name"])


@query("merge_continuations", f"WITH {q.ENTRIES} SELECT service_name, rid, ts_ms, message, n_continuations FROM entries")
def merge(spark, sf):
    rows = views.event_rows(views.events(spark, sf))
    return entries_from_rows(rows, ["service_name"]).select(
        "service_name", "rid", "ts_ms", "message", "n_continuations"
    )


@query("merge_document_lines", "SELECT doc_id, text FROM documents")
def merge_lines(spark, sf):
    """Documents cut into lines and merged again: all lines of a language form one file."""
    docs = views.table(spark, sf, "documents")
    lines = docs.select("lang", "doc_id", F.posexplode(F.split("text", "\n")).alias("n", "message"))
    rows = lines.select(
        "lang", F.floor(F.col("doc_id") / 64).cast("bigint").alias("block"),
        (F.shiftleft("doc_id", 24) + F.col("n")).alias("rid"),
        F.when(F.col("n") == 0, F.lpad(F.col("doc_id").cast("string"), 13, "0")).otherwise("").alias("ts_ms"),
        "message",
    )
    merged = entries_from_rows(rows, ["lang"])
    return merged.select(F.col("ts_ms").cast("bigint").alias("doc_id"), F.col("message").alias("text"))


DOCS = q.LOGS + """, docs AS (
  SELECT epoch_us(timestamp_dt) AS _timestamp, service_name, upper(level) AS log_level, log_text AS message,
    correlation_id, tenant_id, is_error, latency_ms, CAST(status_code AS BIGINT) AS status_code,
    nullif(req_id, '') AS req_id FROM logs)"""


def _docs(spark, sf):
    return to_log_documents(views.event_logs(views.events(spark, sf)))


@query("to_log_documents", f"WITH {DOCS} SELECT * FROM docs")
def documents(spark, sf):
    return _docs(spark, sf)


@query("log_document_json", f"""WITH {DOCS} SELECT CAST(json_extract_string(j, '$._timestamp') AS BIGINT) AS _timestamp,
  json_extract_string(j, '$.message') AS message, len(json_keys(j)) AS n_fields
FROM (SELECT to_json(json_merge_patch('{{}}', to_json(docs))) AS j FROM docs)""")
def document_json(spark, sf):
    """Documents as JSON text: absent fields are left out."""
    lines = to_json_lines(_docs(spark, sf))
    return lines.select(
        F.get_json_object("json", "$._timestamp").cast("bigint").alias("_timestamp"),
        F.get_json_object("json", "$.message").alias("message"),
        F.size(F.json_object_keys("json")).cast("bigint").alias("n_fields"),
    )


@query("read_log_docs", f"""WITH {DOCS} SELECT _timestamp, log_level, latency_ms, status_code, message FROM docs
WHERE service_name = 'svc-2' AND _timestamp BETWEEN epoch_us(TIMESTAMP '2024-01-05') AND epoch_us(TIMESTAMP '2024-01-20')
ORDER BY _timestamp""")
def scan(spark, sf):
    return scan_docs(
        _docs(spark, sf), service="svc-2", start=F.lit("2024-01-05").cast("timestamp"),
        end=F.lit("2024-01-20").cast("timestamp"), ordered=True,
        columns=["_timestamp", "timestamp_dt", "log_level", "latency_ms", "status_code", "message"],
    ).drop("timestamp_dt")


@query("write_log_documents", f"""WITH {DOCS} SELECT _timestamp, service_name, message FROM docs
WHERE _timestamp >= epoch_us(TIMESTAMP '2024-01-25')""")
def stored_documents(spark, sf):
    """Documents stored by day and read back from some days only."""
    path = scratch_path(spark, "docs")
    write_log_documents(_docs(spark, sf), path)
    return read_log_docs(spark, path, start=F.lit("2024-01-25").cast("timestamp")).select(
        "_timestamp", "service_name", "message"
    )


@query("dataset_stats", "SELECT count(*) AS doc_count, true AS has_bytes FROM events")
def dataset_stats(spark, sf):
    from triagelake.operators.reports import dataset_stats as stats_of

    found = stats_of(views.table(spark, sf, "events"))
    return found.select("doc_count", (F.col("size_bytes") > F.col("doc_count")).alias("has_bytes"))


def _metric_batches(ev):
    """Three overlapping batches: all series, a corrected part, and infra values."""
    base = materialize(views.log_metrics(ev, "6 hours"), "metrics")
    fixed = base.where("service_name IN ('svc-1', 'svc-2')").withColumn(
        "metric_value", rounded(F.col("metric_value") * 2, 4)
    ).withColumn("source", F.lit("opensearch"))
    return [base, fixed, views.infra_metrics(ev, "6 hours")]


BATCHES = q.LOGS + f""", base AS ({q.log_metrics('6 hours')}), batches AS (
  SELECT *, 0 AS ingest_seq FROM base
  UNION ALL SELECT timestamp, service_name, metric_name, {q.fixed('metric_value * 2', 4)}, metric_type, 'opensearch', 1
    FROM base WHERE service_name IN ('svc-1', 'svc-2')
  UNION ALL SELECT *, 2 FROM ({q.infra_metrics('6 hours')})),
current_ AS (SELECT * EXCLUDE (ingest_seq) FROM batches
  QUALIFY row_number() OVER (PARTITION BY timestamp, service_name, metric_name ORDER BY ingest_seq DESC) = 1)"""


@query("upsert_metrics", f"WITH {BATCHES} SELECT * FROM current_")
def upsert(spark, sf):
    numbered = [part.withColumn("ingest_seq", F.lit(i)) for i, part in enumerate(_metric_batches(views.events(spark, sf)))]
    batches = numbered[0].unionByName(numbered[1]).unionByName(numbered[2])
    return upserts.upsert_metrics(batches, ["ingest_seq"]).drop("ingest_seq")


@query("union_sources", f"WITH {BATCHES} SELECT * FROM current_")
def union_sources(spark, sf):
    return upserts.union_sources(*_metric_batches(views.events(spark, sf)))


@query("read_metrics", f"WITH {BATCHES} SELECT * FROM current_")
def read_metrics(spark, sf):
    """Batches appended to a stored table, read back as its current view."""
    path = scratch_path(spark, "metrics")
    stamp = F.lit("2024-02-01").cast("timestamp")
    for seq, part in enumerate(_metric_batches(views.events(spark, sf))):
        tables.append_batch(part.withColumn("created_at", stamp), path, seq, METRIC)
    return tables.read_metrics(spark, path).drop("created_at")


@query("replace_all_metrics", f"WITH {q.LOGS} SELECT * FROM ({q.log_metrics('6 hours')})")
def replace_all(spark, sf):
    """A stored table wiped and loaded again holds the new rows only."""
    path = scratch_path(spark, "metrics")
    stamp = F.lit("2024-02-01").cast("timestamp")
    base, _, infra = [p.withColumn("created_at", stamp) for p in _metric_batches(views.events(spark, sf))]
    tables.append_batch(infra, path, 0, METRIC)
    tables.replace_all_metrics(base, path)
    return tables.read_metrics(spark, path).drop("created_at")


@query("write_metrics_csv", f"WITH {q.LOGS} SELECT timestamp, service_name, metric_name, metric_value, metric_type, source FROM ({q.log_metrics('6 hours')})")
def metrics_csv(spark, sf):
    path = scratch_path(spark, "metrics-csv")
    tables.write_metrics_csv(views.log_metrics(views.events(spark, sf), "6 hours"), path)
    stored = spark.read.option("header", True).csv(path)
    return stored.select(
        F.col("timestamp").cast("timestamp").alias("timestamp"), "service_name", "metric_name",
        F.col("metric_value").cast("double").alias("metric_value"), "metric_type", "source",
    )


def _baseline_batches(spark, sf):
    from triagelake.operators.baselines import metric_baselines

    ev = views.events(spark, sf)
    metrics = materialize(views.log_metrics(ev, "6 hours"), "metrics")
    stamp = F.lit("2024-02-01").cast("timestamp")
    whole = metric_baselines(metrics).withColumn("created_at", stamp)
    recent = metric_baselines(metrics, since=F.lit("2024-01-16").cast("timestamp"))
    again = metric_baselines(metrics.withColumn("metric_value", F.col("metric_value") + 1))
    return [
        whole, recent.withColumn("created_at", stamp + F.expr("interval 1 day")),
        again.withColumn("created_at", stamp + F.expr("interval 2 days")),
    ]


def _baseline_sql(tail: str) -> str:
    def gated(where: str, value: str, day: int, seq: int) -> str:
        return f"""SELECT *, TIMESTAMP '2024-02-01' + INTERVAL {day} DAY AS created_at, {seq} AS ingest_seq FROM (
    {q.statistics(f"(SELECT * REPLACE ({value} AS metric_value) FROM metrics WHERE {where})")}) s
  QUALIFY sum(sample_count) OVER (PARTITION BY service_name) >= 100 AND sample_count >= 10"""

    return f"""WITH {q.LOGS}, metrics AS ({q.log_metrics('6 hours')}), batches AS (
  {gated('TRUE', 'metric_value', 0, 0)}
  UNION ALL {gated("timestamp >= TIMESTAMP '2024-01-16'", 'metric_value', 1, 1)}
  UNION ALL {gated('TRUE', 'metric_value + 1', 2, 2)}) {tail}"""


BASELINE_OUT = ["mean", "stddev", "p50", "p95", "p99"]
BASELINE_OUT_SQL = "service_name, metric_name, " + ", ".join(
    f"{q.fixed(c, 4)} AS {c}" for c in BASELINE_OUT
) + ", sample_count, window_start, window_end"


def rounded_baselines(df, *more):
    return df.select(
        "service_name", "metric_name", *[rounded(F.col(c), 4).alias(c) for c in BASELINE_OUT],
        "sample_count", "window_start", "window_end", *more,
    )


@query("upsert_baselines", _baseline_sql(f"""SELECT {BASELINE_OUT_SQL}, created_at FROM batches
  QUALIFY row_number() OVER (PARTITION BY service_name, metric_name, window_start ORDER BY ingest_seq DESC) = 1"""))
def upsert_baselines(spark, sf):
    numbered = [b.withColumn("ingest_seq", F.lit(i)) for i, b in enumerate(_baseline_batches(spark, sf))]
    batches = numbered[0].unionByName(numbered[1]).unionByName(numbered[2])
    return rounded_baselines(upserts.upsert_baselines(batches, ["ingest_seq"]), "created_at")


@query("read_baselines", _baseline_sql(f"""SELECT {BASELINE_OUT_SQL}, created_at FROM batches
  QUALIFY row_number() OVER (PARTITION BY service_name, metric_name ORDER BY created_at DESC) = 1"""))
def read_baselines(spark, sf):
    """Stored baseline batches, the newest row of every series."""
    path = scratch_path(spark, "baselines")
    for seq, part in enumerate(_baseline_batches(spark, sf)):
        tables.append_batch(part, path, seq, BASELINE)
    return rounded_baselines(tables.read_latest_baselines(spark, path), "created_at")


@query("dedup_keep_last", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC) = 1""")
def keep_last(spark, sf):
    lines = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return upserts.dedup_keep_last(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey"]).drop("l_shipdate")


@query("dedup_keep_first", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey) = 1""")
def keep_first(spark, sf):
    lines = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return upserts.dedup_keep_first(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey"]).drop("l_shipdate")


@query("insert_incidents_ignore", f"""WITH {q.EVENT_INCIDENTS}, hours AS (
  SELECT date_trunc('hour', timestamp) AS timestamp, service_name, incident_type, severity, description, id FROM incidents),
first_ AS (SELECT * FROM hours WHERE id % 2 = 1
  QUALIFY row_number() OVER (PARTITION BY timestamp, service_name, incident_type ORDER BY severity, description) = 1)
SELECT timestamp, service_name, incident_type, severity FROM first_ f WHERE NOT EXISTS (
  SELECT 1 FROM hours h WHERE h.id % 2 = 0 AND h.timestamp = f.timestamp AND h.service_name = f.service_name
    AND h.incident_type = f.incident_type)""")
def insert_ignore(spark, sf):
    """One half of the incidents, by hour, inserted next to the other half."""
    hours = views.event_incidents(views.events(spark, sf)).withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    new, existing = hours.where("id % 2 = 1"), hours.where("id % 2 = 0")
    return upserts.insert_incidents_ignore(new, existing).select(
        "timestamp", "service_name", "incident_type", "severity"
    )


@query("set_root_cause", f"""WITH {q.EVENT_INCIDENTS} SELECT id,
  CASE WHEN severity = 'low' THEN 'cause of ' || id ELSE root_cause END AS root_cause FROM incidents""")
def set_root_cause(spark, sf):
    found = views.event_incidents(views.events(spark, sf))
    causes = found.where("severity = 'low'").select(
        "id", F.concat(F.lit("cause of "), F.col("id").cast("string")).alias("root_cause")
    )
    return upserts.set_root_cause(found, causes).select("id", "root_cause")


@query("resolve_incidents", f"""WITH {q.EVENT_INCIDENTS} SELECT id, resolved OR severity = 'critical' AS resolved,
  CASE WHEN severity = 'critical' THEN timestamp + INTERVAL 60 MINUTE ELSE resolved_at END AS resolved_at FROM incidents""")
def resolve(spark, sf):
    found = views.event_incidents(views.events(spark, sf))
    at = found.where("severity = 'critical'").select("id", (F.col("timestamp") + F.expr("interval 1 hour")).alias("resolved_at"))
    return upserts.resolve_incidents(found, at).select("id", "resolved", "resolved_at")


@query("read_ground_truth", f"WITH {q.EV}, {q.LABELS} SELECT * FROM labels_")
def read_labels(spark, sf):
    """Labels stored as JSON lines and read back."""
    path = scratch_path(spark, "labels")
    labels = views.event_labels(views.events(spark, sf))
    labels.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)
    return tables.read_ground_truth(spark, path, lines=True)


@query("read_incidents", f"""WITH {q.EVENT_INCIDENTS} SELECT id, timestamp, service_name, incident_type,
  resolved OR severity = 'critical' AS resolved FROM incidents""")
def read_incidents(spark, sf):
    """Incidents stored, resolved in a later batch, read back in their latest version."""
    found = views.event_incidents(views.events(spark, sf))
    path = scratch_path(spark, "incidents")
    tables.append_batch(found, path, 0, INCIDENT)
    critical = tables.read_incidents(spark, path).where("severity = 'critical'")
    at = critical.select("id", F.col("timestamp").alias("resolved_at"))
    tables.append_batch(upserts.resolve_incidents(critical, at), path, 1, INCIDENT)
    return tables.read_incidents(spark, path).select("id", "timestamp", "service_name", "incident_type", "resolved")


@query("stage_audit", """SELECT 'count' AS query_type, 'event_logs' AS query_text, count(*) AS result_count,
  CAST(NULL AS VARCHAR) AS error FROM events""")
def audit(spark, sf):
    """One audit row for a stage that counts the parsed entries."""
    path = scratch_path(spark, "audit")
    logs = views.event_logs(views.events(spark, sf))
    tables.stage_audit(spark, path, "count", "event_logs", logs.count)
    return spark.read.parquet(path).select("query_type", "query_text", "result_count", "error")
