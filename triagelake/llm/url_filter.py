"""URL filter: rules by host and path, and a Bloom filter cascade for listed hosts.

A cascade answers "is this key listed?" without error for every key it was built over. Level 0 holds the
listed keys; level 1 the other keys that level 0 lets through; level 2 the listed keys that level 1 lets
through, and so on until none is left. A key is listed if the first level that rejects it is odd (or if
none rejects it and the number of levels is odd). Everything is SQL; rows are judged by bit tests alone, whatever the
size of the list: filters beyond a block's size are met block after block, the rows stored in between.

Edge cases: null url or one without `://` has an empty host and path, fits no rule and is not listed.
Empty hosts and null keys are never listed. An empty list or an empty table gives a cascade without
levels, which lists nothing. Repeated rows are judged alike. Other columns of the input are not touched,
except that result columns replace input columns of the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.llm.common import table
from triagelake.session import materialize

#: Share of other keys that a level lets through, from the second on: 4 bits a key, few levels.
PASSED = 1 / 16
#: Bits of one shard's level at most; keys are dealt to shards by hash so that this holds.
SHARD_BITS = 1 << 20
#: Shards whose filters rows carry as one value (about 1.5 levels of 128 KB each); more are met in blocks of so many.
BLOCK_SHARDS = 64

Rule = tuple[str, str]

RULES: list[Rule] = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: Names that mark a host of the corpus as listed in the registered query.
BAD_NAMES = "spam|casino|pills|bets|ads-track"


def host_of(url: Column) -> Column:
    """Between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null without one; of equal length the first by spelling."""
    rule = verdict = F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def suffixes(host: Column, most_labels: Column | int) -> Column:
    """The host and its parent domains of at most so many labels."""
    labels = F.size(F.split(host, "[.]"))
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(labels, F.lit(most_labels)))),
        lambda i: F.call_function("substring_index", host, F.lit("."), -i),
    )


@dataclass(frozen=True)
class Cascade:
    """Filters by shard: `stored` has (shard int, levels array<array<bigint>>); `levels` has (bits, hashes) of each."""

    stored: DataFrame
    shards: int
    levels: tuple[tuple[int, int], ...]

    def listed(self, key: Column, filters: Column) -> Column:
        """Whether a key is listed, given its shard's filters."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for at in reversed(range(len(self.levels))):
            passed = _passes(key, F.get(filters, F.lit(at)), at, *self.levels[at])
            answer = F.when(~passed, F.lit(at % 2 == 1)).otherwise(answer)
        return answer

    def block(self, first: int) -> Column:
        """The filters of BLOCK_SHARDS shards as one value, array by place in the block."""
        rows = F.sort_array(F.collect_list(F.struct("shard", "levels")))
        inside = self.stored.where((F.col("shard") >= first) & (F.col("shard") < first + BLOCK_SHARDS))
        return inside.agg(F.transform(rows, lambda r: r["levels"]).alias("filters")).scalar()


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def _in_block(key: Column, shards: int, first: int) -> Column:
    """Whether the key's shard is one of the block's."""
    shard = _shard(key, shards)
    return (shard >= first) & (shard < first + BLOCK_SHARDS)


def _place(key: Column, level: int, k: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(k)), F.lit(bits))


def _passes(key: Column, words: Column, level: int, bits: int, hashes: int) -> Column:
    passed = F.lit(True)
    for k in range(hashes):
        place = _place(key, level, k, bits)
        passed = passed & (F.getbit(F.get(words, (F.shiftright(place, 6)).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1)
    return passed


def _size(keys: int, passed: float, shards: int) -> tuple[int, int]:
    bits = math.ceil(keys / shards * math.log2(1 / passed) / math.log(2))
    return -(-max(64, bits) // 64) * 64, max(1, round(math.log2(1 / passed)))


def _words(keys: DataFrame, shards: int, level: int, bits: int, hashes: int) -> DataFrame:
    """(shard, words): the dense filter of each shard, also of shards without keys."""
    spark = keys.sparkSession
    per_shard = bits // 64
    placed = keys.select(
        _shard(F.col("key"), shards).alias("shard"),
        F.explode(F.array(*(_place(F.col("key"), level, k, bits) for k in range(hashes)))).alias("place"),
    )
    some = placed.select(
        "shard", F.shiftright("place", 6).cast("int").alias("word"),
        F.expr("shiftleft(1L, cast(pmod(place, 64) as int))").alias("value"),
    )
    blank = spark.range(shards * per_shard).select(
        (F.col("id") / per_shard).cast("int").alias("shard"), (F.col("id") % per_shard).cast("int").alias("word"),
        F.lit(0).cast("bigint").alias("value"),
    )
    merged = some.unionByName(blank).groupBy("shard", "word").agg(F.bit_or("value").alias("value"))
    return merged.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("word", "value"))).alias("words")).select(
        "shard", F.transform("words", lambda w: w["value"]).alias("words")
    )


def build_cascade(listed: DataFrame, universe: DataFrame, key: str = "key") -> Cascade:
    """A cascade over all keys of both tables that lists the keys of the first.

    Each level is one job over the keys that are still undecided; those shrink by a constant factor.
    """
    spark = universe.sparkSession
    both = universe.select(F.col(key).alias("key"), F.lit(False).alias("listed")).unionByName(
        listed.select(F.col(key).alias("key"), F.lit(True).alias("listed"))
    )
    keys = materialize(
        both.where("key is not null and key != ''").groupBy("key").agg(F.max("listed").alias("listed")), "cascade-keys"
    )
    n = keys.agg(F.count_if("listed").alias("inside"), F.count_if(~F.col("listed")).alias("outside")).first()
    inside, outside = keys.where("listed").select("key"), keys.where("not listed").select("key")
    first = min(0.5, max(2.0**-20, math.sqrt(0.5) * n["inside"] / max(1, n["outside"])))
    shards = max(1, math.ceil(_size(max(1, n["inside"]), first, 1)[0] / SHARD_BITS))
    held, tested, n_held, passed = inside, outside, n["inside"], first
    tables, levels = [], []
    while n_held:
        at, size = len(levels), _size(n_held, passed, shards)
        tables.append(materialize(_words(held, shards, at, *size).withColumn("level", F.lit(at)), "cascade-level"))
        levels.append(size)
        own = tables[-1].select(F.col("shard").alias("_shard"), "words")
        through = tested.withColumn("_shard", _shard(F.col("key"), shards)).join(own, "_shard").where(
            _passes(F.col("key"), F.col("words"), at, *size)
        )
        held, tested = materialize(through.select("key"), "cascade-held"), held
        n_held, passed = held.count(), PASSED
    if not tables:
        blank = spark.range(1).select(F.lit(0).alias("shard"), F.expr("cast(array() as array<array<bigint>>)").alias("levels"))
        return Cascade(blank, 1, ())
    stored = tables[0].select("shard", "words", "level")
    for more in tables[1:]:
        stored = stored.unionByName(more)
    stored = stored.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("level", "words"))).alias("levels")).select(
        "shard", F.transform("levels", lambda x: x["words"]).alias("levels")
    )
    return Cascade(materialize(stored, "cascade"), shards, tuple(levels))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule], url: str = "url", listed_key: str = "key") -> DataFrame:
    """Add host, path, rule and verdict to each row: the longest rule's verdict, else block if the host or a
    parent domain is listed, else allow."""
    hosts = pages.select(host_of(F.col(url)).alias("host")).where("host != ''").distinct()
    clean = listed.select(F.col(listed_key).alias("key")).where("key is not null and key != ''")
    most = clean.agg(F.max(F.size(F.split("key", "[.]"))).alias("n")).first()["n"] or 1
    universe = hosts.select(F.explode(suffixes(F.col("host"), most)).alias("key"))
    cascade = build_cascade(clean, universe)
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = pages.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "verdict": verdict})
    judged = judged.withColumn("_bad", F.lit(False))
    for first in range(0, cascade.shards, BLOCK_SHARDS):
        bad = F.exists(
            suffixes(F.col("host"), most),
            lambda key: F.when(
                _in_block(key, cascade.shards, first), cascade.listed(key, F.get("_filters", _shard(key, cascade.shards) - first))
            ).otherwise(False),
        )
        if first:
            # One block at a time: the rows are stored between two.
            judged = materialize(judged, "judged")
        judged = judged.withColumn("_filters", cascade.block(first)).withColumn(
            "_bad", F.col("_bad") | (F.col("verdict").isNull() & (F.col("host") != "") & bad)
        ).drop("_filters")
    return judged.withColumn("verdict", F.coalesce("verdict", F.when(F.col("_bad"), "block").otherwise("allow"))).drop("_bad")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the rules and the listed domains: those of the corpus with a bad name."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(host_of(F.col("url")).alias("host")).distinct()
    listed = hosts.select(
        F.regexp_extract("host", rf"([^.]*(?:{BAD_NAMES})[^.]*(?:[.].*)?)$", 1).alias("key")
    ).where("key != ''").distinct()
    return judge_urls(pages, listed, RULES).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = f"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(action, rule) AS (
  VALUES {", ".join(f"('{action}', '{rule}')" for action, rule in RULES)}
), fits AS (
  SELECT page_id, host, path, rule, action, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST, rule) AS k
  FROM parts LEFT JOIN rules
    ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
   AND starts_with(path, substr(rule, strpos(rule, '/')))
)
SELECT page_id, host, path, rule,
  coalesce(action, CASE WHEN regexp_matches(host, '{BAD_NAMES}') THEN 'block' ELSE 'allow' END) AS verdict
FROM fits WHERE k = 1
"""
