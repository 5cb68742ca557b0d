"""Mixing sources to target weights with hash thresholds; SQL functions only.

Each document has a fixed 60-bit hash. A source that shall give t words out of s gives floor(t / s) copies
of every document, and one more of those whose hash lies below a threshold. The threshold is found from
sums by source and hash bucket: 4096 buckets of the top 12 bits show in which bucket the budget runs out,
only that bucket is split by the next 12 bits, and so on, until the budget ends at a single hash value,
which is taken if that brings the sum nearer to the budget. Nothing is sorted, and a larger budget of the
same source takes everything that a smaller one takes.

Edge cases: null text or no words give size 0. A null source is a source of its own, last in order; a null
id hashes like an empty one. The hash is of id and text, so rows that share an id alone are taken one by one; rows
equal in both are taken together. Sources without words have target 0. Empty tables give empty results. Columns of
the documents keep their names and values, whatever they are called.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triagelake.llm.common import sql_n_words, table
from triagelake.session import materialize

#: Bits of a bucket number, and of the whole hash.
STEP, ALL = 12, 60
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def hash_of(doc_id: Column, text: Column) -> Column:
    """60 bits of the md5 of the id and the text's own."""
    def blank(col: Column) -> Column:
        return F.coalesce(col.cast("string"), F.lit(""))

    whole = F.concat(blank(doc_id), F.lit("/"), F.md5(blank(text).cast("binary")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Add target to (source, source_size): `share` of all words, by weight, none above `most` times its size.

    Filling up by weight until none is above its cap gives least(cap, level * weight) with one level for all,
    which is found by going through the sources by cap / weight. One row for each source, in one task.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("_ratio", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    pattern = F.array(*(F.lit(float(w)) for w in weights))
    ranked = sizes.withColumn("_rank", F.row_number().over(named)).withColumn(
        "_weight", F.get(pattern, (F.col("_rank") - 1) % len(weights))
    )
    capped = ranked.withColumn("_cap", (F.col("source_size") * most).cast("double")).withColumn(
        "_ratio", F.col("_cap") / F.col("_weight")
    )
    before = capped.withColumns({
        "_level": (
            F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(by_ratio), F.lit(0.0))
        ) / (F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(by_ratio), F.lit(0.0))),
    })
    level = F.min_by(F.when(F.col("_ratio") >= F.col("_level"), F.col("_level")), F.when(
        F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "_rank")
    )).over(whole)
    return before.withColumn("target", F.coalesce(F.least("_cap", level * F.col("_weight")), F.col("_cap"))).select(
        "source", "source_size", "target"
    )


@dataclass(frozen=True)
class Mix:
    """For each source: source_size, target, every (copies of each document) and below (one more copy of hashes under it)."""

    sources: DataFrame

    def copies(self, docs: DataFrame) -> DataFrame:
        """Add _copies, source_size and target to documents that have source and hash."""
        plan = self.sources.select(F.col("source").alias("_source"), "source_size", "target", "every", "below")
        return docs.join(plan, docs["source"].eqNullSafe(plan["_source"]), "left").withColumn(
            "_copies", F.col("every") + (F.col("hash") < F.col("below")).cast("int")
        ).drop("_source", "every", "below")


def plan_mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> Mix:
    """Thresholds for documents given as a stored table of (source, size, hash)."""
    step = 1 << STEP

    def histogram(rows: DataFrame, level: int) -> DataFrame:
        digit = F.shiftright("hash", ALL - STEP * (level + 1)) % step
        return rows.groupBy("source", digit.cast("int").alias("digit")).agg(
            F.sum("size").alias("size"), F.min("hash").alias("first"), F.max("hash").alias("last")
        )

    level0 = materialize(histogram(sized, 0), "mix-histogram")
    totals = level0.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = source_targets(totals, weights, share, most).withColumn(
        "every", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    ).withColumn("left", F.col("target") - F.col("every") * F.col("source_size"))
    open_, done = materialize(goals, "mix-goals"), None
    rows = level0
    for level in range(ALL // STEP):
        if level:
            prefix = F.shiftright("hash", ALL - STEP * level)
            bounds = open_.select(F.col("source").alias("_source"), F.col("prefix").alias("_prefix"))
            inside = sized.join(bounds, sized["source"].eqNullSafe(bounds["_source"]) & (prefix == bounds["_prefix"]))
            rows = histogram(inside.select("source", "size", "hash"), level)
        running = Window.partitionBy("source").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        sums = rows.withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0)))
        goal = open_.select(F.col("source").alias("_source"), "left")
        edge = sums.join(goal, sums["source"].eqNullSafe(goal["_source"])).where(
            (F.col("before") <= F.col("left")) & (F.col("before") + F.col("size") > F.col("left"))
        ).select("_source", F.struct("digit", "before", "size", "first", "last").alias("edge"))
        at = open_.join(edge, open_["source"].eqNullSafe(edge["_source"]), "left").drop("_source")
        # Without an edge the whole bucket fits (at level 0: a budget of all words, or none to take).
        single = F.col("edge.first") == F.col("edge.last")
        nearer = F.col("left") - F.col("edge.before") > F.col("edge.before") + F.col("edge.size") - F.col("left")
        below = (
            F.when(F.col("edge").isNull(), F.when(F.col("left") > 0, F.lit(1 << ALL)).otherwise(F.lit(0)))
            .when(single & nearer, F.col("edge.last") + 1).when(single, F.col("edge.first"))
        ).cast("long")
        if not level:  # whole copies alone reach the target, so no document has one more, empty ones included
            below = F.when(F.col("left") <= 0, F.lit(0).cast("long")).otherwise(below)
        stored = materialize(at.withColumn("below", below), "mix-edges")
        closed = stored.where("below is not null").select("source", "source_size", "target", "every", "below")
        done = closed if done is None else done.unionByName(closed)
        prefix = F.col("edge.digit").cast("long") if not level else F.col("prefix") * step + F.col("edge.digit")
        open_ = stored.where("below is null").select(
            "source", "source_size", "target", "every", (F.col("left") - F.col("edge.before")).alias("left"), prefix.alias("prefix")
        )
        if open_.isEmpty():
            break
    return Mix(materialize(done, "mix"))


def sized_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, hash), stored, so that the texts are read once."""
    return materialize(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), sql_n_words(F.col(text)).alias("size"),
        hash_of(F.col(doc_id), F.col(text)).alias("hash"),
    ), "mix-sizes")


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns."""
    plan = plan_mix(sized_documents(docs).select("source", "size", "hash"), **options)
    carried = docs.select(
        F.struct(*docs.columns).alias("own"), "source", hash_of(F.col("doc_id"), F.col("text")).alias("hash")
    )
    return plan.copies(carried).where("_copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))
    ).select("own.*")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of all words by weights 3, 1, 2, none more than twice."""
    sized = sized_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan_mix(sized.select("source", "size", "hash")).copies(sized).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("_copies")).alias("taken")
    )


OP10_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS hash
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST(2 * source_size AS DOUBLE) AS cap, CASE (k - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w
  FROM totals
), levels AS (
  SELECT *, cap / w AS ratio,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT level AS fill FROM levels WHERE ratio >= level ORDER BY ratio, k LIMIT 1
), targets AS (
  SELECT source, source_size, least(cap, fill * w) AS target,
    CASE WHEN source_size > 0 THEN CAST(floor(least(cap, fill * w) / source_size) AS BIGINT) ELSE 0 END AS every
  FROM levels, chosen
), hashes AS (
  SELECT t.source, hash, target - every * source_size AS budget, sum(size) AS size
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source GROUP BY 1, 2, 3
), sums AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY hash) - size AS before FROM hashes
), picked AS (
  SELECT *, CASE WHEN before + size <= budget THEN budget > 0
                 WHEN before <= budget THEN budget - before > before + size - budget ELSE false END AS more
  FROM sums
)
SELECT s.doc_id, s.size, t.source_size, t.target, s.size * (t.every + CAST(p.more AS BIGINT)) AS taken
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
JOIN picked p ON s.source IS NOT DISTINCT FROM p.source AND s.hash = p.hash
"""
