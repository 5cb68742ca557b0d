"""Baselines that are kept up to date by day: only days whose readings have changed are read again.

For every day the rank histogram of each series (`operators.quantiles`) is stored, with moments, time bounds and, in a
column of its own, the values of each bin and how often they occur. The bins of all days add up to the histogram of
the history. Percentiles are located in it, and only for ranks inside a bin are the stored values of that bin read; the
readings of days that have not changed are not touched. The commit log of the metrics tells which days have changed
since the partials were last brought up to date, corrected and late readings included.

What a bin holds in one row are the different values of one series on one day in one narrow bin, no more than the
series has readings on a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.functions.scores import finite
from triagelake.functions.times import utc_day
from triagelake.operators.baselines import COLUMNS, KEY, PERCENTILES, gated
from triagelake.operators.quantiles import combined, finished, located, with_bins
from triagelake.operators.upserts import upsert_metrics
from triagelake.schemas import METRIC
from triagelake.sources import table_log
from triagelake.sources.tables import read_live

BOUNDS = {"window_start": F.min, "window_end": F.max}
VALUES = T.ArrayType(T.StructType([T.StructField("v", T.DoubleType()), T.StructField("c", T.LongType())]))
PARTIAL = T.StructType([
    T.StructField("service_name", T.StringType()), T.StructField("metric_name", T.StringType()),
    T.StructField("_b", T.LongType()), T.StructField("_n", T.LongType()),
    *[T.StructField(name, T.DoubleType()) for name in ("_low", "_high", "_mean", "_m2")],
    *[T.StructField(name, T.TimestampType()) for name in BOUNDS],
    T.StructField("vals", VALUES), T.StructField("ds", T.DateType()),
])
LAYOUT = T.StructType([*PARTIAL.fields, T.StructField("ingest_seq", T.LongType()), T.StructField("w", T.StringType())])


def day_histograms(metrics: DataFrame) -> DataFrame:
    """Per series and UTC day the bins of its readings, with their values; readings that are not finite are no samples."""
    dated = metrics.where(finite(F.col("metric_value"))).withColumn("ds", utc_day(F.col("timestamp")))
    counted = with_bins(dated, [*KEY, "ds"], "metric_value", [F.col("timestamp")]).groupBy(*KEY, "ds", "_b", "_v").agg(
        F.count(F.lit(1)).alias("c"), F.min("timestamp").alias("window_start"), F.max("timestamp").alias("window_end"),
    )
    bins = counted.groupBy(*KEY, "ds", "_b").agg(
        F.sum("c").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"),
        (F.sum(F.col("c") * F.col("_v")) / F.sum("c")).alias("_mean"),
        *[fold(name).alias(name) for name, fold in BOUNDS.items()],
        F.array_sort(F.collect_list(F.struct(F.col("_v").alias("v"), "c"))).alias("vals"),
    )
    squares = F.aggregate(
        "vals", F.lit(0.0), lambda total, x: total + x["c"] * (x["v"] - F.col("_mean")) * (x["v"] - F.col("_mean"))
    )
    return bins.withColumn("_m2", squares).select(*PARTIAL.fieldNames())


def update_day_partials(spark: SparkSession, metrics_path: str, path: str) -> list[str]:
    """Bring the partials at `path` up to the current state of a metrics table; returns the days that were read."""
    source, mine = table_log.current(spark, metrics_path), table_log.current(spark, path)
    done = int(mine.marks.get("metrics", 0))
    days = {day for day, version in source.changed.items() if version > done}
    if not days:
        return []
    current = upsert_metrics(read_live(spark, metrics_path, METRIC, source, days=days), ["ingest_seq", "created_at"])
    folder = table_log.new_folder(source.version)
    day_histograms(current.drop("ds")).hint("rebalance", "ds").write.partitionBy("ds").parquet(f"{path}/{folder}")
    added = table_log.Live(source.version, folder, table_log.days_of(spark, f"{path}/{folder}"))
    table_log.commit(spark, path, lambda state: table_log.with_days(state, added, days, {"metrics": source.version}))
    return sorted(days)


def read_day_partials(spark: SparkSession, path: str, first_day: str | None = None) -> DataFrame:
    """The live partials, all or from a day on; each day lies in one folder."""
    state = table_log.current(spark, path)
    folders = [
        f"{path}/{x.folder}/ds={day}" for x in state.live for day in x.days or [] if first_day is None or day >= first_day
    ]
    if not folders:
        return spark.createDataFrame([], PARTIAL)
    return spark.read.schema(LAYOUT).option("basePath", path).parquet(*folders).select(*PARTIAL.fieldNames())


def baselines_from_partials(partials: DataFrame, min_samples: int = 100, min_metric_samples: int = 10) -> DataFrame:
    """The baselines that `metric_baselines` learns from the readings, learnt from their day partials."""
    bins = combined(partials.drop("vals"), KEY, BOUNDS)
    found = located(bins, KEY, list(PERCENTILES.values()), BOUNDS, moments=True)

    def values() -> DataFrame:
        return partials.select(*KEY, "_b", F.explode("vals").alias("x")).select(
            *KEY, "_b", F.col("x.v").alias("_v"), F.col("x.c").alias("_c")
        )

    stats = finished(found, KEY, PERCENTILES, values).withColumnRenamed("n_values", "sample_count").select(*COLUMNS)
    return gated(stats, min_samples, min_metric_samples)
