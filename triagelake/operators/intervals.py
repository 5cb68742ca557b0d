"""Joins of points in time with intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bin(ts: Column, width: int) -> Column:
    return F.floor(F.unix_seconds(ts) / width).cast("bigint")


def interval_join(
    points: DataFrame,
    spans: DataFrame,
    keys: list[str],
    at: str,
    start: str,
    end: str,
    width_seconds: int,
    how: str = "inner",
) -> DataFrame:
    """Join each point with the spans of the same keys that contain it, both ends included.

    Spans are spread over fixed-width time bins, a point lies in exactly one, so the join is an
    equality on (keys, bin) with a residual time test. Spark may broadcast the spans when they
    turn out small; otherwise the time bins split a service that holds much of the data. `how` is
    `inner` or `left` (points kept).
    """
    spread = (
        spans.where(F.col(start) <= F.col(end))
        .withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), width_seconds), _bin(F.col(end), width_seconds))))
        .withColumnsRenamed({key: f"_span_{key}" for key in keys})
        .withColumnRenamed("_bin", "_span_bin")
    )
    located = points.withColumn("_bin", _bin(F.col(at), width_seconds))
    condition = (F.col("_bin") == F.col("_span_bin")) & F.col(at).between(F.col(start), F.col(end))
    for key in keys:
        condition = condition & (F.col(key) == F.col(f"_span_{key}"))
    return located.join(spread, condition, how).drop("_bin", "_span_bin", *[f"_span_{key}" for key in keys])
