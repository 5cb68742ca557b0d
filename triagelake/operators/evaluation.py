"""Scores of detected incidents against labelled windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.functions.scores import rounded
from triagelake.functions.times import minutes
from triagelake.operators.intervals import interval_join
from triagelake.session import materialize


def with_default_label(ground_truth: DataFrame) -> DataFrame:
    """Labels with a name: the given one, else `GT` and the position counted from 1."""
    fallback = F.concat(F.lit("GT"), (F.col("gt_pos") + 1).cast("string"))
    return ground_truth.withColumn("label", F.coalesce("label", fallback))


def match_ground_truth(
    incidents: DataFrame,
    ground_truth: DataFrame,
    tolerance_minutes: int = 30,
    match_type: bool = False,
    bin_seconds: int = 6 * 3600,
) -> DataFrame:
    """Pairs of an incident and a label of its service whose widened window holds the incident."""
    spans = with_default_label(ground_truth).select(
        "gt_pos", "service_name", F.col("incident_type").alias("gt_type"), "label",
        (F.col("window_start") - minutes(tolerance_minutes)).alias("_from"),
        (F.col("window_end") + minutes(tolerance_minutes)).alias("_to"),
    )
    points = incidents.select("id", "service_name", "timestamp", "incident_type")
    pairs = interval_join(points, spans, ["service_name"], "timestamp", "_from", "_to", bin_seconds)
    if match_type:
        pairs = pairs.where(F.col("incident_type") == F.col("gt_type"))
    return pairs.drop("_from", "_to", "gt_type")


def first_label(pairs: DataFrame) -> DataFrame:
    """Each matched incident with its first label in manifest order."""
    return pairs.groupBy("id", "service_name", "timestamp", "incident_type").agg(
        F.min("gt_pos").alias("gt_pos"), F.min_by("label", "gt_pos").alias("gt_label")
    )


def matched_incidents(incidents: DataFrame, pairs: DataFrame) -> DataFrame:
    return incidents.join(pairs.select("id"), "id", "left_semi")


def unmatched_incidents(incidents: DataFrame, pairs: DataFrame) -> DataFrame:
    """False positives: incidents no label accounts for."""
    return incidents.join(pairs.select("id"), "id", "left_anti")


def missed_ground_truth(ground_truth: DataFrame, credited: DataFrame) -> DataFrame:
    """False negatives: labels that no incident is credited to."""
    return ground_truth.join(credited.select("gt_pos"), "gt_pos", "left_anti")


def _scores(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return {"precision": rounded(precision, 4), "recall": rounded(recall, 4), "f1": rounded(f1, 4)}


def _flags(incidents: DataFrame, ground_truth: DataFrame, credited: DataFrame) -> DataFrame:
    """One row per label and per incident: service, kind and whether it was hit."""
    hit_labels = credited.select("gt_pos").distinct().withColumn("_hit", F.lit(True))
    labels = ground_truth.join(hit_labels, "gt_pos", "left").select(
        "service_name", F.lit("label").alias("kind"), F.coalesce("_hit", F.lit(False)).alias("hit")
    )
    hit_incidents = credited.select("id").distinct().withColumn("_hit", F.lit(True))
    detections = incidents.join(hit_incidents, "id", "left").select(
        "service_name", F.lit("incident").alias("kind"), F.coalesce("_hit", F.lit(False)).alias("hit")
    )
    return labels.unionByName(detections)


COUNTS = {
    "ground_truth_count": ("label", None),
    "detected_count": ("incident", None),
    "tp": ("label", True),
    "fp": ("incident", False),
    "fn": ("label", False),
}


def _count_columns() -> list[Column]:
    columns = []
    for name, (kind, hit) in COUNTS.items():
        condition = F.col("kind") == kind
        if hit is not None:
            condition = condition & (F.col("hit") == F.lit(hit))
        columns.append(F.count_if(condition).alias(name))
    return columns


def evaluate_detections(incidents: DataFrame, ground_truth: DataFrame, credited: DataFrame) -> DataFrame:
    """One row: true and false positives, misses, precision, recall and F1."""
    counts = _flags(incidents, ground_truth, credited).agg(*_count_columns())
    return counts.withColumns(_scores(F.col("tp"), F.col("fp"), F.col("fn")))


def evaluate_by_service(incidents: DataFrame, ground_truth: DataFrame, credited: DataFrame) -> DataFrame:
    """The same per service, over the services of incidents and labels together."""
    counts = _flags(incidents, ground_truth, credited).groupBy("service_name").agg(*_count_columns())
    return counts.withColumns(_scores(F.col("tp"), F.col("fp"), F.col("fn")))


def union_distinct_services(incidents: DataFrame, ground_truth: DataFrame) -> DataFrame:
    return (
        incidents.select("service_name").union(ground_truth.select("service_name")).distinct().orderBy("service_name")
    )


def evaluation_report(
    incidents: DataFrame, ground_truth: DataFrame, tolerance_minutes: int = 30, match_type: bool = False
) -> dict[str, DataFrame]:
    """All parts of the evaluation, each a DataFrame. The matching is used by all and stored once."""
    pairs = match_ground_truth(incidents, ground_truth, tolerance_minutes, match_type)
    credited = materialize(first_label(pairs), "credited")
    return {
        "summary": evaluate_detections(incidents, ground_truth, credited).withColumn(
            "tolerance_minutes", F.lit(tolerance_minutes)
        ),
        "per_service": evaluate_by_service(incidents, ground_truth, credited),
        "true_positives": credited,
        "false_positives": unmatched_incidents(incidents, credited),
        "false_negatives": missed_ground_truth(ground_truth, credited),
    }
