"""Scores, severities, incident classes and the texts derived from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from triagelake.schemas import RULES, SEVERITIES


def rounded(col: Column, digits: int) -> Column:
    """Round half up on the decimal form, so ties do not depend on binary noise.

    Values that no decimal holds (beyond 1e32, or not finite) have no digits to round and stay as they are.
    """
    exact = F.round(col.try_cast("decimal(38,6)"), digits).cast("double")
    return F.coalesce(exact, col.cast("double"))


def finite(col: Column) -> Column:
    """Whether a value is a number other than NaN and the infinities; false for null."""
    return F.coalesce(~F.isnan(col) & (F.abs(col) < float("inf")), F.lit(False))


def zscore(value: Column, mean: Column, stddev: Column) -> Column:
    """Distance from the mean in standard deviations; 0 where the series is constant."""
    known = value.isNotNull() & mean.isNotNull() & stddev.isNotNull()
    return F.when(known, F.coalesce(F.try_divide(value - mean, stddev), F.lit(0.0)))


def reading_severity(z: Column) -> Column:
    return F.when(F.abs(z) >= 4, "high").otherwise("medium")


def incident_severity(max_abs_z: Column) -> Column:
    return (
        F.when(max_abs_z >= 5, "critical")
        .when(max_abs_z >= 4, "high")
        .when(max_abs_z >= 3.5, "medium")
        .otherwise("low")
    )


def severity_rank(severity: Column) -> Column:
    """1 for the mildest; 0 for an unknown word."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, SEVERITIES)), severity), F.lit(0))


def severity_name(rank: Column) -> Column:
    return F.get(F.array(*map(F.lit, SEVERITIES)), (rank - 1).cast("int"))


def confidence(max_abs_z: Column) -> Column:
    return rounded(F.least(max_abs_z / 6.0, F.lit(1.0)), 3)


def classify_incident_type(metrics: Column) -> Column:
    """Incident class from the array of anomalous metric names."""
    def any_of(*names: str) -> Column:
        return F.arrays_overlap(metrics, F.array(*map(F.lit, names)))

    return (
        F.when(any_of("error_rate", "http_5xx_rate"), "error_spike")
        .when(any_of("latency_p95"), "latency_spike")
        .when(any_of("db_connections"), "db_saturation")
        .when(any_of("asg_capacity"), "asg_capacity_limit")
        .when(any_of("cpu_usage", "memory_usage"), "resource_exhaustion")
        .otherwise("unknown_anomaly")
    )


def incident_description(incident_type: Column, service: Column, metrics: Column, sources: Column) -> Column:
    return F.concat(
        F.lit("Detected anomalous "), F.translate(incident_type, "_", " "), F.lit(" on "), service,
        F.lit(". Affected metrics: "), F.array_join(metrics, ", "),
        F.lit(". Signal source(s): "), F.array_join(sources, ", "), F.lit("."),
    )


def rule_table() -> Column:
    """The diagnosis rules as a constant array of structs, in priority order."""
    return F.array(*[
        F.struct(
            F.lit(priority).alias("priority"),
            F.lit(name).alias("name"),
            (F.array(*map(F.lit, requires)) if requires else F.array().cast("array<string>")).alias("requires"),
            F.lit(description).alias("description"),
            F.lit(action).alias("action"),
            F.lit(scenario).alias("scenario"),
        )
        for priority, (name, requires, description, action, scenario) in enumerate(RULES, 1)
    ])


def first_rule(elevated: Column) -> Column:
    """The first rule whose required metrics are all elevated (an empty requirement always holds)."""
    names = F.coalesce(elevated, F.array().cast("array<string>"))
    matching = F.filter(rule_table(), lambda rule: F.size(F.array_except(rule["requires"], names)) == 0)
    return F.get(matching, F.lit(0))


def root_cause_text(description: Column, primary: Column, correlated: Column, action: Column) -> Column:
    listed = F.when(F.size(correlated) > 0, F.array_join(correlated, ", ")).otherwise("None")
    return F.concat(
        description, F.lit(". Primary metric: "), F.coalesce(primary, F.lit("error_rate")),
        F.lit(". Correlated metrics: "), listed, F.lit(". Recommended action: "), action,
    )


def parse_root_cause(text: Column) -> dict[str, Column]:
    """Take a root cause text apart: summary, primary and correlated metrics, action."""
    def names(pattern: str) -> Column:
        items = F.transform(F.split(F.regexp_extract(text, pattern, 1), ","), lambda item: F.trim(item))
        return F.filter(items, lambda item: (item != "") & (F.lower(item) != "none"))

    first_sentence = F.trim(F.regexp_extract(text, r"^([^.]+\.)", 1))
    return {
        "summary": F.when(first_sentence != "", first_sentence).otherwise(text),
        "primary_metrics": names(r"(?i)Primary metrics?:\s*([^.]+)"),
        "correlated_metrics": names(r"(?i)Correlated metrics?:\s*([^.]+)"),
        "action": F.trim(F.regexp_extract(text, r"(?i)Recommended actions?:\s*(.+)$", 1)),
    }


def incident_label(incident_type: Column, ts: Column, score: Column, resolved: Column) -> dict[str, Column]:
    """Display texts of one incident card."""
    return {
        "type_label": F.initcap(F.translate(incident_type, "_", " ")),
        "time_label": F.date_format(ts, "MMM dd, yyyy  HH:mm"),
        "confidence_label": F.concat(rounded(score * 100, 0).cast("bigint").cast("string"), F.lit("%")),
        "status_label": F.when(resolved, "Resolved").otherwise("Open"),
    }


def all_of(conditions: list[Column]) -> Column:
    """Conjunction of any number of conditions."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
