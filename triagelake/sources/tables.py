"""Fact tables on plain parquet: numbered batches with a current view, kept by a commit log (`table_log`).

A batch written again after a failure replaces only itself and never a folder that a plan reads. Batches of metrics
are cut by day (UTC), so a range of times reads its days only. `compact_metrics` merges batches into a base, so that a
read looks at the base and at what came after it.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.functions.times import utc_day
from triagelake.operators.baselines import latest_baseline
from triagelake.operators.upserts import dedup_keep_last, upsert_baselines, upsert_metrics
from triagelake.schemas import (
    AUDIT,
    BASELINE,
    DEFAULT_GROUND_TRUTH,
    GROUND_TRUTH,
    INCIDENT,
    METRIC,
)
from triagelake.sources import table_log


def _full(schema: T.StructType) -> T.StructType:
    days = [T.StructField("ds", T.DateType())] if schema == METRIC else []
    return T.StructType([*schema.fields, T.StructField("ingest_seq", T.LongType()), T.StructField("w", T.StringType()), *days])


def read_live(
    spark: SparkSession, path: str, schema: T.StructType, state: table_log.State, upto: int | None = None,
    first: str | None = None, last: str | None = None, days: set[str] | None = None,
) -> DataFrame:
    """The live folders of a state, of tables cut by day only the wanted days."""
    folders = []
    for live in state.live:
        if upto is not None and live.seq > upto:
            continue
        if live.days is None:
            folders.append(live.folder)
            continue
        wanted = [d for d in live.days if (first is None or d >= first) and (last is None or d <= last)]
        folders += [f"{live.folder}/ds={d}" for d in wanted if days is None or d in days]
    if not folders:
        return spark.createDataFrame([], _full(schema)).drop("w")
    found = spark.read.schema(_full(schema)).option("basePath", path).parquet(*[f"{path}/{x}" for x in folders])
    return found.drop("w")


def read_batches(spark: SparkSession, path: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
    """The live batches of a table (up to a number) with their `ingest_seq` (metrics: and `ds`); none if not written yet."""
    return read_live(spark, path, schema, table_log.current(spark, path), upto)


def _written(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write a frame and return its rows, counted on the way."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def write_batch(df: DataFrame, path: str, seq: int, schema: T.StructType) -> tuple[table_log.Live, int]:
    """Write a batch's folder, which nothing refers to yet; the folder and its number of rows."""
    spark, folder = df.sparkSession, table_log.new_folder(seq)
    aligned = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    if schema != METRIC:
        return table_log.Live(seq, folder), _written(aligned, lambda x: x.write.parquet(f"{path}/{folder}"))
    rows = _written(aligned, lambda x: _by_day(x).parquet(f"{path}/{folder}"))
    return table_log.Live(seq, folder, table_log.days_of(spark, f"{path}/{folder}")), rows


def append_batch(
    df: DataFrame, path: str, ingest_seq: int, schema: T.StructType, marks: dict[str, int | str] | None = None
) -> int:
    """Write and commit one batch; the same number again replaces that batch. Returns its number of rows.

    `marks` are stored in the same commit, so what they say holds if and only if the batch is there.
    """
    table_log.with_batch(table_log.current(df.sparkSession, path), table_log.Live(ingest_seq, ""))  # refused before it is written
    added, rows = write_batch(df, path, ingest_seq, schema)
    table_log.commit(df.sparkSession, path, lambda state: table_log.with_batch(state, added, marks))
    return rows


def _by_day(metrics: DataFrame) -> DataFrameWriter:
    """A writer by day; a day's rows come together, a large day's in several files."""
    dated = metrics.withColumn("ds", utc_day(F.col("timestamp"))).hint("rebalance", "ds")
    return dated.write.partitionBy("ds")


def compact_metrics(spark: SparkSession, path: str, upto: int | None = None) -> int:
    """Merge the batches up to a number (all there are) into the base; returns the number of days rewritten.

    Only days that more than one folder holds are written, from these folders alone; the base keeps its other days
    where they are. Readers see the table as before or after, with the same contents.
    """
    seen = table_log.current(spark, path)
    if not seen.live:
        return 0
    upto = max(x.seq for x in seen.live) if upto is None else upto
    held = Counter(day for x in seen.live if x.seq <= upto for day in x.days or [])
    days = {day for day, n in held.items() if n > 1}
    if not days:
        table_log.commit(spark, path, lambda state: table_log.compacted(state, seen, table_log.Live(upto, "", []), upto))
        return 0
    rows = upsert_metrics(read_live(spark, path, METRIC, seen, upto, days=days), ["ingest_seq", "created_at"])
    base, _ = write_batch(rows.drop("ingest_seq", "ds"), path, upto, METRIC)
    table_log.commit(spark, path, lambda state: table_log.compacted(state, seen, base, upto))
    return len(days)


def compact(spark: SparkSession, path: str, schema: T.StructType, key: list[str], order: list[str]) -> None:
    """Merge all batches of a table that is not cut by day into one folder with the latest row of each key."""
    seen = table_log.current(spark, path)
    if len(seen.live) < 2:
        return
    upto = max(x.seq for x in seen.live)
    rows = dedup_keep_last(read_live(spark, path, schema, seen), key, order).drop("ingest_seq")
    base, _ = write_batch(rows, path, upto, schema)
    table_log.commit(spark, path, lambda state: table_log.compacted(state, seen, base, upto))


def read_metrics(spark: SparkSession, path: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Current metrics, all or those from `start` to `end` (both included), of which only the days are read.

    Versions of a reading share its time, so the range is cut before the latest of them is taken.
    """
    batches, ts = read_batches(spark, path, METRIC), F.col("timestamp")
    if start is not None:
        batches = batches.where((F.col("ds") >= utc_day(start)) & (ts >= start))
    if end is not None:
        batches = batches.where((F.col("ds") <= utc_day(end)) & (ts <= end))
    return upsert_metrics(batches, ["ingest_seq", "created_at"]).drop("ingest_seq", "ds")


def read_baselines(spark: SparkSession, path: str) -> DataFrame:
    """Current baselines; several windows of one series may exist."""
    return upsert_baselines(read_batches(spark, path, BASELINE), ["ingest_seq", "created_at"]).drop("ingest_seq")


def read_latest_baselines(spark: SparkSession, path: str) -> DataFrame:
    return latest_baseline(read_baselines(spark, path))


def read_incidents(spark: SparkSession, path: str) -> DataFrame:
    """Current incidents: the latest version of each id."""
    return dedup_keep_last(read_batches(spark, path, INCIDENT), ["id"], ["ingest_seq"]).drop("ingest_seq")


def replace_all_metrics(metrics: DataFrame, path: str) -> None:
    """Store `metrics` as the only batch, in place of all there are."""
    only, _ = write_batch(metrics, path, 0, METRIC)
    table_log.commit(metrics.sparkSession, path, lambda state: table_log.replaced_by(state, only))


def write_metrics_csv(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").option("header", True).csv(path)


def read_ground_truth(spark: SparkSession, path: str | None = None, lines: bool = False) -> DataFrame:
    """Labelled windows with their position: a JSON array in a file, or the built-in two, also if there is no such file.

    Of a folder of manifests the files follow each other by name.

    A label set too large for one file is read with `lines=True` from JSON lines that carry their
    position as `gt_pos`.
    """
    if path is not None:
        try:
            if lines:
                schema = T.StructType([T.StructField("gt_pos", T.LongType()), *GROUND_TRUTH.fields])
                return spark.read.schema(schema).json(path)
            return _manifest(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            path = None
    if path is None:
        rows = [(i, *row) for i, row in enumerate(DEFAULT_GROUND_TRUTH)]
        names = ["gt_pos", "service_name", "incident_type", "_from", "_to", "label"]
        return spark.createDataFrame(
            rows, "gt_pos bigint, service_name string, incident_type string, _from string, _to string, label string"
        ).select(
            *names[:3], F.to_timestamp("_from").alias("window_start"), F.to_timestamp("_to").alias("window_end"),
            "label",
        )


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifests are small by nature; their windows are numbered in one task."""
    manifest = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    windows = F.from_json("value", T.ArrayType(GROUND_TRUTH))
    numbered = F.row_number().over(Window.orderBy("file", "at")).cast("bigint") - 1
    return manifest.select("file", F.posexplode(windows).alias("at", "g")).select(numbered.alias("gt_pos"), "g.*")


def write_evaluation_report(parts: dict[str, DataFrame], path: str) -> None:
    """Every part of the report as JSON lines in a folder of its own, the summary with the time of writing."""
    for name, part in parts.items():
        dated = part.withColumn("generated_at", F.current_timestamp()) if name == "summary" else part
        dated.write.mode("overwrite").json(f"{path}/{name}")


def read_evaluation_part(spark: SparkSession, path: str, part: str, schema: T.StructType | str) -> DataFrame:
    """A stored part of the report (per-service scores, matches, misses, ...); a part not written yet is empty."""
    try:
        return spark.read.schema(schema).json(f"{path}/{part}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_evaluation_summary(spark: SparkSession, path: str) -> DataFrame:
    """The stored summary; a row of zeros with status `pending` when there is none."""
    schema = (
        "ground_truth_count bigint, detected_count bigint, tp bigint, fp bigint, fn bigint, "
        "precision double, recall double, f1 double, tolerance_minutes bigint, generated_at timestamp, status string"
    )
    try:
        stored = spark.read.schema(schema).json(f"{path}/summary")
        return stored.withColumn("status", F.coalesce("status", F.lit("done")))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([(0, 0, 0, 0, 0, 0.0, 0.0, 0.0, None, None, "pending")], schema)


def stage_audit(
    spark: SparkSession, path: str, query_type: str, query_text: str, stage: Callable[[], int]
) -> int:
    """Run a stage and append one audit row: duration, the row count it returns, or its error."""
    started = time.time()
    count, message = None, None
    try:
        count = stage()
        return count
    except Exception as error:
        message = str(error)
        raise
    finally:
        row = (query_type, query_text, (time.time() - started) * 1000.0, count, message)
        (
            spark.createDataFrame([row], T.StructType(AUDIT.fields[:-1]))
            .withColumn("created_at", F.current_timestamp())
            .write.mode("append").parquet(path)
        )
