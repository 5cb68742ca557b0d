"""Landed responses of a cloud metric service."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.functions.scores import rounded
from triagelake.functions.text import last_path_segment
from triagelake.schemas import CLOUD_METRICS, CLOUD_RESPONSE


def cloud_mapping() -> Column:
    """Constant map from `namespace|metric` to internal name, statistic and scale."""
    pairs = []
    for namespace, metric, internal, stat, scale in CLOUD_METRICS:
        pairs.append(F.lit(f"{namespace}|{metric}"))
        pairs.append(F.struct(
            F.lit(internal).alias("internal"), F.lit(stat).alias("stat"), F.lit(scale).alias("scale"),
        ))
    return F.create_map(*pairs)


def explode_datapoints(responses: DataFrame, service: Column | None = None) -> DataFrame:
    """One row per datapoint of each response.

    The service is the last path segment of the resource; `service` gives another expression over the response, such
    as the service that a database or a load balancer belongs to.
    """
    return responses.withColumn("p", F.explode("Datapoints")).select(
        F.col("Namespace").alias("namespace"), F.col("MetricName").alias("cloud_metric"),
        (last_path_segment(F.col("Resource")) if service is None else service).alias("service_name"),
        F.col("p.Timestamp").alias("timestamp"),
        F.col("p.Average").alias("average"), F.col("p.Sum").alias("sum"), F.col("p.Maximum").alias("maximum"),
    )


def read_cloud_datapoints(spark: SparkSession, path: str, service: Column | None = None) -> DataFrame:
    """Datapoints of stored responses, one JSON response per line."""
    return explode_datapoints(spark.read.schema(CLOUD_RESPONSE).json(path), service)


def normalize_cloud_metric(points: DataFrame, source: str = "cloudwatch") -> DataFrame:
    """Datapoints as metric rows: internal name, the statistic meant for it, unit conversion.

    A missing statistic counts as 0. Metrics outside the mapping are dropped. The nine entries of
    the mapping are a constant, so no join is needed.
    """
    entry = F.try_element_at(cloud_mapping(), F.concat_ws("|", "namespace", "cloud_metric"))
    mapped = points.withColumn("_m", entry).where(F.col("_m").isNotNull())
    value = (
        F.when(F.col("_m.stat") == "Sum", F.col("sum"))
        .when(F.col("_m.stat") == "Maximum", F.col("maximum"))
        .otherwise(F.col("average"))
    )
    return mapped.select(
        "timestamp", "service_name", F.col("_m.internal").alias("metric_name"),
        rounded(F.coalesce(value, F.lit(0.0)) * F.col("_m.scale"), 4).alias("metric_value"),
        F.col("_m.internal").alias("metric_type"), F.lit(source).alias("source"),
    )
