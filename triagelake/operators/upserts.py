"""Conflict policies of the fact tables, as views over append-only batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.schemas import BASELINE_KEY, INCIDENT_KEY, METRIC_KEY


def dedup_keep_last(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """Insert-or-replace: the row with the greatest `order` wins per key.

    The rank limit is applied before the shuffle as well, so repeated keys do not travel.
    """
    ranked = Window.partitionBy(*key).orderBy(*[F.desc(c) if isinstance(c, str) else c.desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def dedup_keep_first(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """Insert-or-ignore: the row with the smallest `order` wins per key."""
    ranked = Window.partitionBy(*key).orderBy(*[F.asc(c) if isinstance(c, str) else c.asc() for c in order])
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def upsert_metrics(batches: DataFrame, order: list[str], key: list[str] | None = None) -> DataFrame:
    """Current metrics: last batch wins per (timestamp, service, metric), whatever the source."""
    return dedup_keep_last(batches, key or METRIC_KEY, order)


def upsert_baselines(batches: DataFrame, order: list[str]) -> DataFrame:
    """Current baselines: last batch wins per (service, metric, window start)."""
    return dedup_keep_last(batches, BASELINE_KEY, order)


def insert_incidents_ignore(new: DataFrame, existing: DataFrame) -> DataFrame:
    """The new incidents whose key is not taken yet; existing rows stay as they are."""
    fresh = new.join(existing.select(*INCIDENT_KEY), INCIDENT_KEY, "left_anti")
    return dedup_keep_first(fresh, INCIDENT_KEY, ["severity", "description"])


def incident_id(timestamp: Column, service: Column, incident_type: Column) -> Column:
    """A stable id from the natural key."""
    return F.xxhash64(timestamp, service, incident_type)


def set_root_cause(incidents: DataFrame, causes: DataFrame) -> DataFrame:
    """Fill `root_cause` from (id, root_cause) rows; other incidents keep theirs."""
    update = causes.select("id", F.col("root_cause").alias("_new"))
    return (
        incidents.join(update, "id", "left")
        .withColumn("root_cause", F.coalesce("_new", "root_cause"))
        .select(*incidents.columns)
    )


def resolve_incidents(incidents: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Mark incidents as resolved from (id, resolved_at) rows."""
    update = resolutions.select("id", F.col("resolved_at").alias("_at"))
    return (
        incidents.join(update, "id", "left")
        .withColumn("resolved", F.col("resolved") | F.col("_at").isNotNull())
        .withColumn("resolved_at", F.coalesce("_at", "resolved_at"))
        .select(*incidents.columns)
    )


def union_sources(*parts: DataFrame) -> DataFrame:
    """Metrics of several sources in one table; the later argument wins per key."""
    numbered = [part.withColumn("ingest_seq", F.lit(i)) for i, part in enumerate(parts)]
    merged = numbered[0]
    for part in numbered[1:]:
        merged = merged.unionByName(part)
    return upsert_metrics(merged, ["ingest_seq"]).drop("ingest_seq")
