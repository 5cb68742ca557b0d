"""Regular time grids and overrides of series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.operators.intervals import interval_join
from triagelake.schemas import METRIC_KEY


def time_grid(
    services: DataFrame, metrics: list[str], start: Column, end: Column, step_minutes: int = 5, chunk: int = 4096,
) -> DataFrame:
    """Every (timestamp, service, metric) from `start` to before `end`.

    The range is cut into chunks of points; chunks are dealt out to tasks, and each then gives its points, so a long
    grid of one service is neither one array nor one task. An empty range gives no rows.
    """
    step, begin = step_minutes * 60_000_000, F.unix_micros(start)
    points = F.ceil((F.unix_micros(end) - begin) / step).cast("bigint")
    chunks = F.when(points > 0, F.sequence(F.lit(0).cast("bigint"), F.floor((points - 1) / chunk).cast("bigint")))
    dealt = (
        services.select("service_name", points.alias("_points"), begin.alias("_begin"), F.explode(chunks).alias("_chunk"))
        .repartition("service_name", "_chunk")
    )
    first = F.col("_chunk") * chunk
    place = F.explode(F.sequence(first, F.least(first + chunk, F.col("_points")) - 1))
    return (
        dealt.select("service_name", "_begin", place.alias("_place"))
        .select("service_name", F.timestamp_micros(F.col("_begin") + F.col("_place") * step).alias("timestamp"))
        .withColumn("metric_name", F.explode(F.array(*map(F.lit, metrics))))
        .select("timestamp", "service_name", "metric_name")
    )


def grid_gaps(grid: DataFrame, metrics: DataFrame) -> DataFrame:
    """Grid points for which no reading exists."""
    return grid.join(metrics.select(*METRIC_KEY), METRIC_KEY, "left_anti")


def override_in_windows(metrics: DataFrame, overrides: DataFrame, bin_seconds: int = 3600) -> DataFrame:
    """Replace values inside (service, metric, start, end) windows; where windows overlap the later one wins.

    `overrides` has columns service_name, metric_name, window_start, window_end, new_value and
    priority (later is higher).
    """
    spans = overrides.select(
        "service_name", "metric_name", "window_start", "window_end", "new_value", "priority",
    )
    # The winner is found once for each key and joined, so that readings with equal keys all stay.
    hit = interval_join(
        metrics.select(*METRIC_KEY).distinct(), spans, ["service_name", "metric_name"], "timestamp", "window_start",
        "window_end", bin_seconds,
    )
    latest = Window.partitionBy(*METRIC_KEY).orderBy(F.desc_nulls_last("priority"), F.desc("new_value"))
    winners = hit.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").select(
        *METRIC_KEY, F.col("new_value").alias("_new")
    )
    return metrics.join(winners, METRIC_KEY, "left").withColumn(
        "metric_value", F.coalesce("_new", "metric_value")
    ).select(*metrics.columns)


def sub_windows(spans: DataFrame, start: str, end: str, hours: int = 1) -> DataFrame:
    """Cut [start, end) into pieces of at most `hours`, the last one clipped."""
    step = F.make_dt_interval(F.lit(0), F.lit(hours))
    pieces = F.explode(F.sequence(F.col(start), F.col(end) - F.expr("interval 1 microsecond"), step))
    return (
        spans.where(F.col(start) < F.col(end)).withColumn("win_start", pieces)
        .withColumn("win_end", F.least(F.col("win_start") + step, F.col(end)))
    )
