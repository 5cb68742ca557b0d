"""Root causes from the metrics around an incident."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.functions.scores import finite, first_rule, root_cause_text, rounded, zscore
from triagelake.functions.times import minutes
from triagelake.operators.baselines import KEY
from triagelake.operators.intervals import interval_join
from triagelake.schemas import INFRA_METRICS, INFRA_SOURCES
from triagelake.session import materialize


def pending_incidents(incidents: DataFrame) -> DataFrame:
    """Open incidents without a root cause."""
    return incidents.where(~F.col("resolved") & F.col("root_cause").isNull())


def incident_metric_window(incidents: DataFrame, metrics: DataFrame, window_minutes: int = 60) -> DataFrame:
    """Every reading of the incident's service within the window around it, both ends included."""
    spans = incidents.select(
        F.col("id").alias("incident_id"), "service_name",
        (F.col("timestamp") - minutes(window_minutes)).alias("_from"),
        (F.col("timestamp") + minutes(window_minutes)).alias("_to"),
    )
    return interval_join(
        metrics, spans, ["service_name"], "timestamp", "_from", "_to", width_seconds=window_minutes * 120,
    ).select("incident_id", "service_name", "timestamp", "metric_name", "metric_value", "source")


def _figures(suffix: str, condition: Column) -> list[Column]:
    """Count, sum and bounds of the finite values that meet a condition; each adds up over parts by itself."""
    value = F.when(condition & finite(F.col("metric_value")), F.col("metric_value"))
    return [
        F.count(value).alias(f"n_{suffix}"), F.sum(value).alias(f"sum_{suffix}"),
        F.min(value).alias(f"min_{suffix}"), F.max(value).alias(f"max_{suffix}"),
    ]


def _window_figures() -> list[Column]:
    """Of any readings: how many, and the figures of those of an infra source and of those with an infra name."""
    return [
        F.count(F.lit(1)).alias("n_all"), *_figures("s", F.col("source").isin(*INFRA_SOURCES)),
        *_figures("n", F.col("metric_name").isin(*INFRA_METRICS)),
    ]


def _added_figures() -> list[Column]:
    folds = {"n": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
    return [F.sum("n_all").alias("n_all")] + [
        fold(f"{name}_{suffix}").alias(f"{name}_{suffix}") for suffix in ("s", "n") for name, fold in folds.items()
    ]


def window_figures(window: DataFrame) -> DataFrame:
    """Per incident and metric the figures of its readings in the window."""
    return window.groupBy("incident_id", "service_name", "metric_name").agg(*_window_figures())


def window_figures_by_bin(
    incidents: DataFrame, metrics: DataFrame, window_minutes: int = 60, bin_seconds: int | None = None
) -> DataFrame:
    """The same figures without a copy of the readings for each incident.

    Readings are added up once, by service, metric and time bin (a sixth of the window unless given). Of the bins that
    lie within an incident's window their sums are taken; only in the two bins at its edges are readings looked at.
    """
    width = (bin_seconds or max(1, window_minutes * 20)) * 1_000_000

    def bin_of(ts: Column) -> Column:
        return F.floor(F.unix_micros(ts) / width).cast("bigint")

    spans = incidents.select(
        F.col("id").alias("incident_id"), "service_name",
        (F.col("timestamp") - minutes(window_minutes)).alias("_from"), (F.col("timestamp") + minutes(window_minutes)).alias("_to"),
    ).withColumns({"_first": bin_of(F.col("_from")), "_last": bin_of(F.col("_to"))})
    binned = metrics.withColumn("_bin", bin_of(F.col("timestamp")))
    sums = binned.groupBy("service_name", "metric_name", "_bin").agg(*_window_figures())
    inner = F.when(F.col("_last") - F.col("_first") > 1, F.sequence(F.col("_first") + 1, F.col("_last") - 1))
    whole = spans.select("incident_id", "service_name", F.explode(inner).alias("_bin")).join(sums, ["service_name", "_bin"])
    edges = spans.select(
        "incident_id", "service_name", "_from", "_to", F.explode(F.array_distinct(F.array("_first", "_last"))).alias("_bin")
    ).join(binned, ["service_name", "_bin"]).where(F.col("timestamp").between(F.col("_from"), F.col("_to")))
    return whole.drop("_bin").unionByName(window_figures(edges)).groupBy("incident_id", "service_name", "metric_name").agg(
        *_added_figures()
    )


def window_metric_mean(window: DataFrame, baselines: DataFrame) -> DataFrame:
    """Per incident and infra metric: window mean, its distance and the largest single distance.

    `window` has the readings of incidents, or their figures. Infra readings are those of an infra source; where an
    incident has none, those with an infra name. Series that are constant or have no baseline drop out.
    """
    cells = window if "n_all" in window.columns else window_figures(window)
    has_source = F.max(F.col("n_s") > 0).over(Window.partitionBy("incident_id"))
    chosen = cells.withColumn("_src", has_source).select(
        "incident_id", *KEY,
        *[
            F.when(F.col("_src"), F.col(f"{name}_s")).otherwise(F.col(f"{name}_n")).alias(name)
            for name in ("n", "sum", "min", "max")
        ],
    ).where(F.col("n") > 0)
    stats_of = baselines.where(F.col("stddev") != 0).select(*KEY, "mean", "stddev")
    mean, stddev = F.col("mean"), F.col("stddev")
    average = F.col("sum") / F.col("n")
    return chosen.join(stats_of, KEY).select(
        "incident_id", *KEY, average.alias("window_mean"),
        zscore(average, mean, stddev).alias("z_mean"),
        F.greatest(
            F.abs(zscore(F.col("min"), mean, stddev)), F.abs(zscore(F.col("max"), mean, stddev))
        ).alias("z_max_abs"),
    )


def elevated_infra(
    window: DataFrame, baselines: DataFrame, sigma: float = 3.0, elevated_by: str = "mean"
) -> DataFrame:
    """Infra metrics at least `sigma` away from their baseline, by window mean or by any one reading."""
    column = {"mean": "z_mean", "max_abs": "z_max_abs"}[elevated_by]
    scored = window_metric_mean(window, baselines).where(finite(F.col(column)) & (F.abs(column) >= sigma))
    return scored.select("incident_id", *KEY, "window_mean", rounded(F.col(column), 2).alias("zscore"))


def match_rule(window: DataFrame, elevated: DataFrame) -> DataFrame:
    """The first satisfied rule of every incident that has readings in its window."""
    names = elevated.groupBy("incident_id").agg(F.array_sort(F.collect_set("metric_name")).alias("elevated"))
    seen = window.select("incident_id").distinct()
    none = F.array().cast("array<string>")
    return (
        seen.join(names, "incident_id", "left")
        .withColumn("elevated", F.coalesce("elevated", none))
        .withColumn("rule", first_rule(F.col("elevated")))
        .withColumn("primary_metric", F.get(F.col("rule.requires"), F.lit(0)))
    )


def co_observed_pairs(window: DataFrame, primary: DataFrame) -> DataFrame:
    """Each metric next to the primary metric at the same incident and time, repeated cells averaged.

    The primary value is spread over the handful of rows of its (incident, time) group, so no self
    join is needed.
    """
    cells = window.where(finite(F.col("metric_value"))).groupBy("incident_id", "timestamp", "metric_name").agg(
        F.avg("metric_value").alias("value")
    )
    known = cells.join(primary.where(F.col("primary_metric").isNotNull()), "incident_id")
    at = Window.partitionBy("incident_id", "timestamp")
    is_primary = F.col("metric_name") == F.col("primary_metric")
    return (
        known.withColumn("primary_value", F.max(F.when(is_primary, F.col("value"))).over(at))
        .where(F.col("primary_value").isNotNull() & ~is_primary)
        .select("incident_id", "timestamp", "primary_metric", "metric_name", "primary_value", "value")
    )


def correlated_metrics(pairs: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Metrics whose correlation with the primary reaches the threshold; constant series never do."""
    spread = F.stddev_pop("value") * F.stddev_pop("primary_value")
    return (
        pairs.groupBy("incident_id", "primary_metric", "metric_name")
        .agg(F.try_divide(F.covar_pop("value", "primary_value"), spread).alias("r"), F.count("value").alias("n"))
        .where(~F.isnan("r") & (F.abs("r") >= threshold))
    )


def diagnose_incidents(
    incidents: DataFrame,
    metrics: DataFrame,
    baselines: DataFrame,
    window_minutes: int = 60,
    sigma: float = 3.0,
    correlation: float = 0.7,
    elevated_by: str = "mean",
) -> DataFrame:
    """Root cause rows (id, rule, primary metric, correlated metrics, text) for the pending incidents.

    Incidents without any reading in their window give no row and so stay undiagnosed. What is elevated follows from
    figures by time bin; the readings around incidents are joined once, for those whose rule names a metric, and not
    stored.
    """
    pending = pending_incidents(incidents)
    figures = materialize(window_figures_by_bin(pending, metrics, window_minutes), "window-figures")
    ruled = materialize(match_rule(figures, elevated_infra(figures, baselines, sigma, elevated_by)), "ruled")
    primary = ruled.where("primary_metric IS NOT NULL").select("incident_id", "primary_metric")
    named_incidents = pending.join(primary.select(F.col("incident_id").alias("id")), "id", "left_semi")
    pairs = co_observed_pairs(incident_metric_window(named_incidents, metrics, window_minutes), primary)
    named = (
        correlated_metrics(pairs, correlation)
        .groupBy("incident_id")
        .agg(F.array_sort(F.collect_set("metric_name")).alias("correlated"))
    )
    none = F.array().cast("array<string>")
    listed = (
        ruled.join(named, "incident_id", "left")
        .withColumn("correlated", F.coalesce("correlated", none))
        .withColumn(
            "correlated",
            F.concat(
                "correlated",
                F.filter(
                    F.array_except("elevated", "correlated"),
                    lambda m: ~m.eqNullSafe(F.col("primary_metric")),
                ),
            ),
        )
    )
    return listed.select(
        F.col("incident_id").alias("id"), F.col("rule.name").alias("rule"), F.col("rule.scenario").alias("scenario"),
        "primary_metric", "elevated", "correlated",
        root_cause_text(
            F.col("rule.description"), F.col("primary_metric"), F.col("correlated"), F.col("rule.action")
        ).alias("root_cause"),
    )
