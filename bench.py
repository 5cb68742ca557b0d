"""Time the headline jobs and print one JSON line.

Inputs: $BENCH_SF_DIR (default /root/testdata/sf0.1), $BENCH_CPUS (default 8). Each job is run once to warm the
JVM and once for the figure; results go to a sink that takes every row and stores nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from triagelake.operators import detect, diagnose, evaluation, rollup, upserts  # noqa: E402
from triagelake.operators.baselines import metric_baselines  # noqa: E402
from triagelake.plans import catalog_tables, jobs  # noqa: E402
from triagelake.plans import event_views as views  # noqa: E402
from triagelake.session import build_session, materialize  # noqa: E402
from triagelake.sources.log_files import read_logs  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    ev = views.events(spark, sf_dir)
    logs = views.event_logs(ev)
    docs = logs.withColumn("log_level", F.upper("level"))
    csv_folder = catalog_tables._csv_folder(spark, sf_dir)
    metrics = views.stored_metrics(ev, "6 hours")
    hourly = views.stored_metrics(ev, "1 hour")
    baselines = materialize(metric_baselines(metrics), "baselines")
    hourly_baselines = materialize(metric_baselines(hourly), "baselines")
    incidents = materialize(views.event_incidents(ev), "incidents")
    labels = materialize(views.event_labels(ev), "labels")
    items = views.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("timestamp"), F.col("l_returnflag").alias("service_name"),
        F.col("l_linestatus").alias("metric_name"), F.col("l_extendedprice").alias("metric_value"),
    )
    lines = views.table(spark, sf_dir, "lineitem")

    headline = {
        "read_logs": lambda: read_logs(spark, csv_folder, "dir"),
        "ingest_logs": lambda: jobs.ingest_rows(views.event_rows(ev), ["service_name"]),
        "aggregate_to_metrics": lambda: rollup.aggregate_to_metrics(logs),
        "bucket_profile": lambda: rollup.bucket_profile(docs),
        "ingest_docs": lambda: jobs.ingest_docs(docs),
        "compute_baselines": lambda: metric_baselines(metrics),
        "value_baselines": lambda: metric_baselines(items),
        "detect_anomalies": lambda: detect.detect_anomalies(metrics, baselines),
        "create_incidents": lambda: detect.create_incidents(
            detect.detect_anomalies(metrics, baselines), incidents
        ),
        "diagnose_incidents": lambda: diagnose.diagnose_incidents(incidents, hourly, hourly_baselines, 360, 1.0),
        "evaluate_detections": lambda: evaluation.evaluation_report(incidents, labels)["summary"],
        "upsert": lambda: upserts.dedup_keep_last(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber"]),
    }
    seconds = {}
    for name, build in headline.items():
        for _ in range(2):
            started = time.time()
            build().write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - started, 3)
    print(json.dumps({
        "metric": "headline_jobs_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
