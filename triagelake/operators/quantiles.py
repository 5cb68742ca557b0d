"""Exact percentiles, sums and moments per group, from one mergeable rank histogram.

A first scan counts the values of each group in narrow bins whose numbers grow with the value. A bin keeps its count,
its least and greatest value and the sums asked for, and is combined before the shuffle, so a group that holds a third
of all rows travels as a few thousand bins, and bins of several scans (of days, say) can be added up. The running
count over a group's bins tells which bins hold the wanted ranks. The least and the greatest value of a bin are known
by rank, which settles every bin of up to two values and every rank at a bin's edge. What is left is refined: a
second scan looks at the values of the unsettled bins alone and counts them in a thousand parts of the bin's own
bounds, which settles ranks in the same way. Only bins with thousands of different values need a further turn.

Groups of all sizes go the same way. The located ranks are stored, one row for each group, so Spark knows the size of
what it joins to the second scan: it broadcasts by its own threshold or else shuffles. Without unsettled ranks there
is no second scan. Building the frame thus runs the scans.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.session import materialize

# 256 bins per factor of two; the offset exceeds 369.33 times the largest logarithm of a double.
BINS_PER_E = 369.3299304675746
OFFSET = 400000
# Parts of equal width that an unsettled bin is cut into.
PARTS = 1023

BIN = ["_b", "_n", "_low", "_high"]

#: A further figure of a group: what it is taken of, and the aggregate that also combines its parts (sum, min, max).
Fold = tuple[Column, Callable[[str], Column]]


def value_bin(value: Column) -> Column:
    """A bin number that never decreases as the value grows; null for null.

    The infinities have the outermost bins, and NaN one above them, as it sorts after all numbers.
    """
    magnitude = (F.floor(F.log(F.abs(value)) * BINS_PER_E) + OFFSET).cast("bigint")
    limit = float("inf")
    return (
        F.when(F.isnan(value), F.lit(2 * OFFSET + 1).cast("bigint"))
        .when(value == limit, F.lit(2 * OFFSET).cast("bigint")).when(value == -limit, F.lit(-2 * OFFSET).cast("bigint"))
        .when(value > 0, magnitude).when(value < 0, -magnitude).when(value == 0, F.lit(0).cast("bigint"))
    )


def _between(low: Column, high: Column, share: Column) -> Column:
    """Linear interpolation that also holds next to an infinity."""
    endless = F.abs(low) == float("inf")
    return F.when(low == high, low).when(endless, (1 - share) * low + share * high).otherwise(low + share * (high - low))


def _joined(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on columns that may be null; the right side's copies of them go."""
    renamed = right.withColumnsRenamed({name: f"_r_{name}" for name in names})
    on = reduce(lambda a, b: a & b, [left[name].eqNullSafe(renamed[f"_r_{name}"]) for name in names])
    found = left.join(renamed, on, how)
    return found if how in ("left_semi", "left_anti") else found.drop(*[f"_r_{name}" for name in names])


def with_bins(rows: DataFrame, keys: list[str], value: str, others: list[Column] | None = None) -> DataFrame:
    values = rows.select(*keys, F.col(value).cast("double").alias("_v"), *(others or []))
    return values.withColumn("_b", value_bin(F.col("_v")))


def histogram(
    rows: DataFrame, keys: list[str], value: str, folds: dict[str, Fold] | None = None, moments: bool = False,
) -> DataFrame:
    """The bins of each group: count, least and greatest value, folds; a null bin for rows without a value.

    With `moments` also mean and squared distances from it, which add up over bins without loss.
    """
    folds = folds or {}
    spread = [F.avg("_v").alias("_mean"), (F.var_pop("_v") * F.count("_v")).alias("_m2")] if moments else []
    return with_bins(rows, keys, value, [col.alias(name) for name, (col, _) in folds.items()]).groupBy(*keys, "_b").agg(
        F.count("_v").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), *spread,
        *[fold(name).alias(name) for name, (_, fold) in folds.items()],
    )


def combined(bins: DataFrame, keys: list[str], folds: dict[str, Callable[[str], Column]] | None = None) -> DataFrame:
    """Histograms with moments of the same groups, added up bin by bin.

    The values of a bin lie so close together that plain sums of squares keep their distances.
    """
    n, total = F.sum("_n"), F.sum(F.col("_n") * F.col("_mean"))
    apart = F.sum(F.col("_n") * F.col("_mean") * F.col("_mean")) - F.try_divide(total * total, n)
    return bins.groupBy(*keys, "_b").agg(
        n.alias("_n"), F.min("_low").alias("_low"), F.max("_high").alias("_high"), F.try_divide(total, n).alias("_mean"),
        (F.sum("_m2") + F.greatest(apart, F.lit(0.0))).alias("_m2"),
        *[fold(name).alias(name) for name, fold in (folds or {}).items()],
    )


def located(
    bins: DataFrame, keys: list[str], probabilities: list[float], folds: dict[str, Callable[[str], Column]] | None = None,
    moments: bool = False,
) -> DataFrame:
    """One row for each group: `n_values`, folds, `mean` and `stddev`, and the two bins that hold each percentile's ranks."""
    # One order for all frames, so that one pass over a group's bins does.
    group = Window.partitionBy(*keys).orderBy(F.col("_b").asc_nulls_first())
    below = group.rowsBetween(Window.unboundedPreceding, -1)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("_n").over(whole)
    placed = bins.withColumns({"_before": F.coalesce(F.sum("_n").over(below), F.lit(0)), "n_values": total})
    figures = []
    if moments:
        mean = F.sum(F.col("_n") * F.col("_mean")).over(whole)
        placed = placed.withColumn("_total", mean).withColumn("_center", F.try_divide("_total", "n_values"))
        apart = F.col("_mean") - F.col("_center")
        squares = F.sum(F.col("_m2") + F.col("_n") * apart * apart)
        figures = [F.max("_center").alias("mean"), F.sqrt(F.try_divide(squares, F.max("n_values"))).alias("stddev")]

    def holder(rank: Column) -> Column:
        held = (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_n"))
        return F.max(F.when(held, F.struct(*BIN, "_before")))

    return placed.groupBy(*keys).agg(
        F.max("n_values").alias("n_values"), *figures, *[fold(name).alias(name) for name, fold in (folds or {}).items()],
        *[holder(rank).alias(f"_at{i}") for i, rank in enumerate(_ranks(probabilities))],
    )


def _ranks(probabilities: list[float]) -> list[Column]:
    return [edge(F.lit(p) * (F.col("n_values") - 1)) for p in probabilities for edge in (F.floor, F.ceil)]


def settled_by_bounds(found: DataFrame, probabilities: list[float]) -> DataFrame:
    """`located` rows with the value `_v<i>` of every rank that its bin's bounds tell; `_open` counts the others."""
    ranks = _ranks(probabilities)
    known = found.withColumns({f"_v{i}": _settled(F.col(f"_at{i}"), rank) for i, rank in enumerate(ranks)})
    missing = [(F.col(f"_at{i}").isNotNull() & F.col(f"_v{i}").isNull()).cast("int") for i in range(len(ranks))]
    return known.withColumn("_open", reduce(lambda a, b: a + b, missing))


def _settled(at: Column, rank: Column) -> Column:
    """The value of a rank if its bin's bounds tell it, else null."""
    return (
        F.when((at["_low"] == at["_high"]) | (rank == at["_before"]), at["_low"])
        .when(rank == at["_before"] + at["_n"] - 1, at["_high"])
    )


def _refined(unsettled: DataFrame, keys: list[str], values: DataFrame) -> DataFrame:
    """Ranks inside their bins, (keys, _b, i, pos, low, high), one step on: settled by `value`, or in narrower bounds.

    The values between the bounds are counted in parts of equal width, which travel as one row each.
    """
    span = [*keys, "_b", "low", "high"]
    wanted = unsettled.groupBy(*span).agg(F.collect_list(F.struct("i", "pos")).alias("targets"))
    share = F.try_divide(F.col("_v") - F.col("low"), F.col("high") - F.col("low"))
    parts = (
        _joined(values, wanted, [*keys, "_b"]).where(F.col("_v").between(F.col("low"), F.col("high")))
        .groupBy(*span, "targets", F.floor(share * PARTS).cast("int").alias("_part"))
        .agg(F.sum("_c").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    )
    ahead = Window.partitionBy(*span).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    held = F.filter("targets", lambda x: (x["pos"] >= F.col("_before")) & (x["pos"] < F.col("_before") + F.col("_n")))
    return placed.withColumn("x", F.explode(held)).select(
        *keys, "_b", "x.i", (F.col("x.pos") - F.col("_before")).alias("pos"), F.col("_low").alias("low"),
        F.col("_high").alias("high"),
        F.when((F.col("_low") == F.col("_high")) | (F.col("x.pos") == F.col("_before")), F.col("_low"))
        .when(F.col("x.pos") == F.col("_before") + F.col("_n") - 1, F.col("_high")).alias("value"),
    )


def finished(
    found: DataFrame, keys: list[str], probabilities: dict[str, float], values: Callable[[], DataFrame],
) -> DataFrame:
    """`located` rows with interpolated percentiles in place of their bins.

    `values()` gives (keys, _b, _v, _c) rows, a value and how often it occurs; it is asked only for unsettled ranks.
    """
    points = list(probabilities.values())
    stored = materialize(settled_by_bounds(found, points), "ranks")
    ranks = _ranks(points)
    opened = F.array(*[
        F.when(F.col(f"_at{i}").isNotNull() & F.col(f"_v{i}").isNull(), F.struct(
            F.lit(i).alias("i"), F.col(f"_at{i}._b").alias("_b"), F.col(f"_at{i}._low").alias("low"),
            F.col(f"_at{i}._high").alias("high"), (rank - F.col(f"_at{i}._before")).alias("pos"),
        )) for i, rank in enumerate(ranks)
    ])
    ranked, settled = stored, []
    left = stored.agg(F.sum("_open")).first()[0]
    unsettled = stored.where("_open > 0").select(*keys, F.explode(F.array_compact(opened)).alias("x")).select(*keys, "x.*")
    while left:  # each turn narrows the bounds by a factor of PARTS, down to one value at the latest
        step = materialize(_refined(unsettled, keys, values()), "refined")
        settled.append(step.where("value IS NOT NULL"))
        unsettled = step.where("value IS NULL")
        left = unsettled.count()
    if settled:
        by_group = reduce(DataFrame.unionByName, settled).groupBy(*keys).agg(
            *[F.max(F.when(F.col("i") == i, F.col("value"))).alias(f"_w{i}") for i in range(len(ranks))]
        )
        ranked = _joined(stored, by_group, keys, "left").withColumns({f"_v{i}": F.coalesce(f"_v{i}", f"_w{i}") for i in range(len(ranks))})
    share = [F.lit(p) * (F.col("n_values") - 1) for p in points]
    return ranked.select(*[c for c in found.columns if not c.startswith("_at")], *[
        _between(F.col(f"_v{2 * n}"), F.col(f"_v{2 * n + 1}"), share[n] - F.floor(share[n])).alias(name)
        for n, name in enumerate(probabilities)
    ])


def grouped_profile(
    df: DataFrame,
    keys: list[str],
    value: str,
    probabilities: dict[str, float],
    sums: dict[str, Column] | None = None,
    exact: bool = True,
    moments: bool = False,
    extremes: dict[str, Fold] | None = None,
) -> DataFrame:
    """Per key: `n_values` (non-null), the given sums, and one linearly interpolated percentile per name.

    `moments` adds `mean` and `stddev` (of the population), `extremes` further least or greatest figures. With
    `exact=False` the percentiles come from Spark's bounded approximate sketch, in one pass and nothing run before.
    """
    folds = {**{name: (col, F.sum) for name, col in (sums or {}).items()}, **(extremes or {})}
    columns = [*keys, "n_values", *(["mean", "stddev"] if moments else []), *folds, *probabilities]
    if not exact:
        rows = df.select(*keys, F.col(value).cast("double").alias("_v"), *[col.alias(name) for name, (col, _) in folds.items()])
        figures = [F.avg("_v").alias("mean"), F.stddev_pop("_v").alias("stddev")] if moments else []
        sketch = [F.percentile_approx("_v", p, 10000).alias(name) for name, p in probabilities.items()]
        totals = [F.count("_v").alias("n_values"), *figures, *[fold(name).alias(name) for name, (_, fold) in folds.items()]]
        return rows.groupBy(*keys).agg(*totals, *sketch).select(*columns)
    again = {name: fold for name, (_, fold) in folds.items()}
    bins = histogram(df, keys, value, folds, moments)
    found = located(bins, keys, list(probabilities.values()), again, moments)

    def values() -> DataFrame:
        return with_bins(df, keys, value).where(F.col("_v").isNotNull()).withColumn("_c", F.lit(1).cast("bigint"))

    return finished(found, keys, probabilities, values).select(*columns)
