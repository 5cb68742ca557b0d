"""Quality rules, line first; SQL functions only.

Each line is judged by itself: marks, separators of menus, shouting, whether an earlier line is equal, and, if it
is short, how it ends and whether it has a boilerplate phrase. A long line is prose: it may lack its last full stop, or
name what a phrase names. Failed lines are removed, and a document goes if it loses more than half of the characters in
its words, or if it fails the base rules (few words, or repeated three-word windows).

Edge cases: a null text counts as empty: no words, rejected. Lines without a word are kept, as empty lines, and count
for nothing. Repeated rows are judged alike; nothing depends on other rows, so an empty table gives an empty
result. Very long texts are one value of one row and need memory in proportion to their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.llm.common import SPACES, WORD, sql_words, table

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
#: Percent of words in repeated windows, and of word characters lost, from which a document goes (if above).
MOST_REPEATED = 50
MOST_LOST = 50
#: Characters in words from which a line is long.
LONG_LINE = 120
#: Fixed phrases of boilerplate lines, searched in lower case as whole words.
BOILERPLATE = (
    "all rights reserved", "licensed under", "released under the", "privacy policy", "terms of use", "terms of service",
    "cookie", "javascript", "lorem ipsum", "click here", "subscribe to", "sign up", "log in", "read more",
)
#: What ends a sentence, what may follow it, separators of menus, and all characters that are counted.
ENDS, CLOSERS = (".", "!", "?", "…", ":", ";", "。", "！", "？", "．", "：", "；", "؟", "۔", "।", "॥", "።"), "\"'’”»)]」』）】"
PHRASES = "(^|[^a-z])(" + "|".join(BOILERPLATE) + ")([^a-z]|$)"
MENU, SHOUTS, COUNTED = "[|»›•]", "[!?]", "[^#*$%&|<>»›•!?A-Z]+"


def base_measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, carried columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lines) of
    each row; lines: without repeats, those without a word marked by a line feed and their place.

    Three-word windows are packed into one long each: the upper bits of a hash and, below them, the place.
    Sorted, equal windows lie side by side; only places found that way are compared by their real words.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    own = F.struct(*(F.col(c) for c in carried)) if carried else F.lit(None).cast("struct<>")
    cut = docs.select(F.col(doc_id).alias("doc_id"), own.alias("own"), body.alias("text"), sql_words(body).alias("w"))
    sized = cut.select("doc_id", "own", "text", "w", F.size("w").alias("n"))
    masked = sized.withColumn("mask", F.expr("shiftleft(1L, length(bin(n))) - 1L"))
    window = F.transform(
        F.when(F.col("n") >= 3, F.sequence(F.lit(0), F.col("n") - 3)).otherwise(F.expr("cast(array() as array<int>)")),
        lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).bitwiseAND(F.bitwise_not("mask")).bitwiseOR(i.cast("long")),
    )
    packed = masked.withColumn("s", F.sort_array(window))
    upper = lambda x: x.bitwiseAND(F.bitwise_not("mask"))
    near = F.filter(
        "s", lambda x, i: (upper(x) == upper(F.get("s", i - 1))) | (upper(x) == upper(F.get("s", i + 1)))
    )
    placed = packed.withColumn("near", F.transform(near, lambda x: x.bitwiseAND(F.col("mask")).cast("int"))).drop("s", "mask")
    spelled = placed.withColumn("spelled", F.when(F.size("near") > 0, F.sort_array(F.transform(
        "near", lambda p: F.struct(F.concat_ws(" ", F.get("w", p), F.get("w", p + 1), F.get("w", p + 2)).alias("x"), p.alias("p"))
    ))).otherwise(F.expr("cast(array() as array<struct<x: string, p: int>>)")))
    repeated = spelled.withColumn("at", F.sort_array(F.transform(F.filter(
        "spelled",
        lambda x, i: (x["x"] == F.get("spelled", i - 1)["x"]) | (x["x"] == F.get("spelled", i + 1)["x"]),
    ), lambda x: x["p"])))
    covered = F.aggregate(
        F.transform("at", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("at", i + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, b: a + b,
    )
    lines = F.transform(
        F.split("text", "\n"), lambda x, i: F.when(x.rlike(WORD), x).otherwise(F.concat(F.lit("\n"), i.cast("string")))
    )
    distinct = repeated.withColumn("_lines", lines).withColumn("lines", F.array_distinct("_lines"))
    measured = distinct.select(
        "doc_id", "own", "lines",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS + "+", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size("lines")).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )
    return measured.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    )


def good_lines(lines: Column) -> Column:
    """The lines that pass and those without a word, as an array of (line, size), size being the characters in words.

    Each line is read a fixed number of times: `rest` keeps only the few characters that the rules count.
    """
    def blank(x: Column) -> Column:
        return F.startswith(x, F.lit("\n"))

    solid = F.transform(lines, lambda x: F.struct(
        F.when(blank(x), "").otherwise(x).alias("line"), F.when(blank(x), "").otherwise(F.regexp_replace(x, SPACES, "")).alias("solid"),
    ))
    parts = F.transform(solid, lambda x: F.struct(
        x["line"].alias("line"), F.length(x["solid"]).alias("size"),
        F.substring(F.rtrim(x["solid"], F.lit(CLOSERS)), -1, 1).alias("end"),
        F.regexp_replace(x["solid"], COUNTED, "").alias("rest"),
    ))

    def count(x: Column, pattern: str) -> Column:
        return F.length(x["rest"]) - F.length(F.regexp_replace(x["rest"], pattern + "+", ""))

    return F.filter(parts, lambda x: (x["size"] == 0) | ~(
        ((x["size"] < LONG_LINE) & (~x["end"].isin(*ENDS) | F.lower(x["line"]).rlike(PHRASES)))
        | (10 * count(x, SYMBOLS) > x["size"])
        | (10 * count(x, SHOUTS) > x["size"])
        | (count(x, MENU) >= 3)
        | ((x["size"] >= 20) & (2 * count(x, "[A-Z]") > x["size"]))
    ))


def judge_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """Base measures of each document, kept and the cleaned text (its good lines); carried columns come as `own`."""
    judged = base_measures(docs, doc_id, text, carried).withColumn("good", good_lines(F.col("lines")))
    left = F.aggregate(F.transform("good", lambda x: x["size"]), F.lit(0), lambda a, b: a + b)
    return judged.withColumns({
        # The row number is always 0 or more. As it is not deterministic, a filter on kept stays above the measures
        # instead of being pushed below them with all of them spelled out in its condition.
        "kept": ~F.col("base_failed") & (100 * (F.col("word_chars") - left) <= MOST_LOST * F.col("word_chars"))
        & (F.monotonically_increasing_id() >= 0),
        "cleaned": F.array_join(F.transform("good", lambda x: x["line"]), "\n"),
    }).drop("lines", "good")


def cleaned_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents that are kept, with all their columns, cleaned text and its length in characters."""
    others = tuple(c for c in docs.columns if c not in (text, n_chars))
    judged = judge_quality(docs, doc_id, text, others).where("kept")
    new = {text: F.col("cleaned"), n_chars: F.length("cleaned").cast("long")}
    return judged.select(*(new[c].alias(c) if c in new else F.col("own").getField(c).alias(c) for c in docs.columns))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base measures and the verdict on every document."""
    return judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _size_sql(pattern: str) -> str:
    return f"length(x) - length(regexp_replace(x, '{pattern}', '', 'g'))"


def kept_sql(source: str) -> str:
    """DuckDB SQL for the measures and the verdict on each row of a table with doc_id and text."""
    size = f"length(regexp_replace(x, '{SPACES}', '', 'g'))"
    closers, ends = CLOSERS.replace("'", "''"), ", ".join(f"'{x}'" for x in ENDS)
    word = WORD
    return f"""
  SELECT *, NOT base_failed AND 100 * (word_chars - coalesce(list_sum([{size} FOR x IN list_distinct(good)]), 0))
      <= {MOST_LOST} * word_chars AS kept
  FROM (
    SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
      [x FOR x IN lines IF regexp_matches(x, '{word}') AND NOT (
        {size} < {LONG_LINE} AND (right(rtrim(regexp_replace(x, '{SPACES}', '', 'g'), '{closers}'), 1) NOT IN ({ends})
          OR regexp_matches(lower(x), '{PHRASES}'))
        OR 10 * ({_size_sql(SYMBOLS)}) > {size} OR 10 * ({_size_sql(SHOUTS)}) > {size}
        OR {_size_sql(MENU)} >= 3 OR ({size} >= 20 AND 2 * ({_size_sql("[A-Z]")}) > {size}))] AS good
    FROM (
      SELECT *, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(body) - length(regexp_replace(body, '{SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len([x FOR x IN lines IF regexp_matches(x, '{word}')])
           - len(list_distinct([x FOR x IN lines IF regexp_matches(x, '{word}')])) AS BIGINT) AS n_dup_lines,
        CAST((SELECT count(DISTINCT q) FROM (
          SELECT unnest([p, p + 1, p + 2]) AS q FROM (
            SELECT p, count(*) OVER (PARTITION BY w[p], w[p + 1], w[p + 2]) AS n
            FROM (SELECT unnest(range(1, len(w) - 1)) AS p)
          ) WHERE n > 1)) AS BIGINT) AS n_repeat_words
      FROM (SELECT *, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '{word}') AS w,
              string_split(coalesce(text, ''), chr(10)) AS lines FROM {source})
    )
  )"""


OP6_SQL = f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM ({kept_sql("documents")})
"""
