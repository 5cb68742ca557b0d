"""N-gram Jaccard join: T-occurrence search over inverted lists.

Documents are sets of four-word shingles. Two sets of similarity s or more share at least T = ceil(s n) elements
of a set of n, so leaving out its T - 1 longest inverted lists, any partner still occurs in one of the others.
As in DivideSkip the two kinds of lists are treated differently: the short ones are merged (by Spark's shuffle on
the shingle) and give the candidates, the long ones are never read as lists: the candidate's sorted set is probed
by binary search until the required overlap is reached.

List lengths come from a count of all shingles of all documents in hashed classes of a fixed number; they only
decide the order (short lists first, then by hash), which is the same for every document, so results do not depend
on it.

Equal sets are one node. Only components are asked for, so candidates are taken in rounds. A list of at most four
members for each pivot gives all its pairs of different components and is done; a longer one gives its smallest node
(its pivot) with the others, in the next round eight pivots, and so on, until it is done or holds one component. A
group of near copies is thus joined through its pivot in a number of candidates that grows with the group, not with
its square; no pair of different components that meets in a short list is left untested.

A list may hold a large share of all rows. Lists of more than 1/HOT of all members, of which there are at most HOT,
are cut into slices by a hash of the node, so every join over lists deals a long one out to many tasks.

Rounds work on components, not on nodes: a round's links join the components of the rounds before, so what is
propagated is that round's links alone. A text is fetched in the first round that compares its node, and kept; a
round without new nodes does not read the corpus.

Each set has a bit array in which every shingle flips one bit. Two arrays differ in no more bits than their sets do
in elements, so pairs whose arrays differ in too many are dropped before any text is fetched.

Edge cases: null texts count as empty: no shingles, linked with nothing, each its own component. A text of fewer
words than a shingle is one shingle. Rows with equal texts link, whatever their ids; a null id never names a
component unless all its ids are null. Rows that share an id but not a text are different documents with equal
ids. An empty table gives no rows. Other columns of the input are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.llm.common import (
    OUT_ROWS, column_of, count_parts, merged_counts, shingles, table, utf8, word_hashes,
)
from triagelake.session import materialize

WORDS = 4
#: Similarity in percent: 100 * shared >= PERCENT * all.
PERCENT = 85
#: Classes of the count of shingles: 8 million, one byte each where it is used.
COUNT_BITS = 23
#: Each round takes so many times the pivots of the one before.
MORE = 8
#: Members of a list, for each pivot, up to which all its pairs are taken.
WHOLE = 4
#: Lists are cut into slices of about 1/HOT of all members, but not of fewer than SLICE.
HOT = 1000
SLICE = 100
#: Bits of the array that bounds what two sets share.
FLIP_BITS = 512
#: The bit array that tells which texts may be needed has so many bits for each of them, but at most 8 MB.
BITS_EACH, MOST_FILTER_BITS = 16, 26
#: Links of a round up to which one task joins them (16 MB); more are joined by steps over all tasks.
FEW_LINKS = 1_000_000
#: A row's tag: two hashes of id and text from different starts.
TAG = "struct<x:bigint,y:bigint>"


def shingle_set(raw: np.ndarray, words: int = WORDS) -> np.ndarray:
    return np.unique(shingles(word_hashes(raw), words))


def least_overlap(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Elements that a set of n shares at least with any similar one."""
    return -(-percent * n // 100)


def list_lengths(docs: DataFrame, words: int = WORDS, bits: int = COUNT_BITS) -> np.ndarray:
    """For each class of shingles the binary logarithm of its number of documents, one byte each."""
    def count(batch: pa.RecordBatch, held: dict[str, np.ndarray]) -> None:
        for raw in utf8(column_of(batch, "text")):
            np.add.at(held["n"], (shingle_set(raw, words) >> np.uint64(64 - bits)).astype(np.intp), np.uint32(1))

    parts = count_parts(docs.select("text"), ["n"], 1 << bits, count)
    total = merged_counts(parts, 1 << bits, ["n"])["n"]
    return np.log2(np.maximum(total, 1)).astype(np.uint8)


def flipped(own: np.ndarray) -> np.ndarray:
    """The bits that a set's elements flip, as longs."""
    odd = np.bincount((own & np.uint64(FLIP_BITS - 1)).astype(np.int64), minlength=FLIP_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, lengths: np.ndarray, words: int, bits: int, percent: int) -> DataFrame:
    """(row, doc_id, tag, n, key, flips, short) of each row: key names the set, short are the shingles of its short lists."""
    shared = docs.sparkSession.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                rows = batch.slice(at, OUT_ROWS)
                n, keys, flips, short = [], [], [], []
                for raw in utf8(column_of(rows, "text")):
                    own = shingle_set(raw, words)
                    n.append(len(own))
                    keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                    flips.append(flipped(own))
                    order = np.argsort(shared.value[(own >> np.uint64(64 - bits)).astype(np.int64)], kind="stable")
                    short.append(own[order[:len(own) - least_overlap(len(own), percent) + 1]].view(np.int64) if len(own) else own.view(np.int64))
                sizes = np.concatenate(([0], np.cumsum([len(x) for x in short]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [column_of(rows, "row"), column_of(rows, "doc_id"), column_of(rows, "tag"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * (FLIP_BITS // 64)), pa.array(np.concatenate(flips))),
                     pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(short)))],
                    names=["row", "doc_id", "tag", "n", "key", "flips", "short"],
                )

    return docs.select("row", "doc_id", "tag", "text").mapInArrow(
        run, f"row long, doc_id long, tag {TAG}, n long, key binary, flips array<long>, short array<long>"
    )


def _slice() -> Column:
    """The slice of its list that a node is in."""
    return F.pmod(F.xxhash64("node"), F.col("slices")).cast("int").alias("slice")


def _every_slice(lists: DataFrame) -> DataFrame:
    """Each row once for every slice of its list."""
    return lists.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))


def _lists(postings: DataFrame, nodes: DataFrame) -> DataFrame:
    """(shingle, slices, node, at, n) of the lists of several rows, of equal sets only one.

    Lists of one row lead nowhere; they are most of all lists.
    """
    counts = materialize(postings.groupBy("shingle").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "counts")
    width = max((counts.agg(F.sum("k")).first()[0] or 0) // HOT, SLICE)
    cut = counts.select("shingle", F.ceil(F.col("k") / width).cast("int").alias("slices"))
    # At most HOT lists are longer than a slice, as all members together are HOT slices.
    hot = F.broadcast(cut.where("slices > 1"))
    placed = postings.join(hot, "shingle", "left").withColumn("slices", F.coalesce("slices", F.lit(1))).withColumn("slice", _slice())
    return placed.join(_every_slice(cut), ["shingle", "slices", "slice"]).drop("slice").join(nodes.select("node", "n"), "node")


def _open(members: DataFrame) -> DataFrame:
    """The members of lists that hold several components, with the length k of their list."""
    lists = members.groupBy("shingle", "slices").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("k"))
    several = _every_slice(lists.where("lo < hi").select("shingle", "slices", "k"))
    return members.withColumn("slice", _slice()).join(several, ["shingle", "slices", "slice"]).drop("slice")


def _candidates(open_: DataFrame, pivots: int, percent: int) -> DataFrame:
    """Distinct (a, b, la, lb, size): pairs of one list in different components whose sizes and places allow the similarity.

    `at` is a shingle's place in its set's order. A pair's first common shingle has all others behind it, so no more
    can be shared than is left in either set from there on; a similar pair passes this test in that list.

    Lists of up to WHOLE members for each pivot give all their pairs, others the pairs of so many of their nodes, the
    smallest of each salt. la and lb are the components, the smaller first; size is that of both sets together.
    """
    left, right = ([("node", x), ("n", f"n{x}"), ("at", f"t{x}"), ("label", f"l{x}")] for x in "ab")
    whole, long = open_.where(F.col("k") <= WHOLE * pivots), open_.where(F.col("k") > WHOLE * pivots)
    salt = F.pmod(F.xxhash64("node"), F.lit(pivots)).alias("salt")
    first = long.groupBy("shingle", "slices", salt).agg(
        F.min("node").alias("a"), *(F.min_by(x, "node").alias(y) for x, y in left[1:])
    ).drop("salt")
    place = ["shingle", "slices", "slice"]
    one = _every_slice(whole.select("shingle", "slices", *(F.col(x).alias(y) for x, y in left)))
    other, rest = (part.select("shingle", "slices", _slice(), *(F.col(x).alias(y) for x, y in right)) for part in (whole, long))
    met = one.join(other, place).where("a < b").unionByName(rest.join(_every_slice(first), place))
    size = F.col("na") + F.col("nb")
    fits = (100 + percent) * F.least(F.col("na") - F.col("ta"), F.col("nb") - F.col("tb")) >= percent * size
    return met.where((F.col("la") != F.col("lb")) & fits).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("la", "lb").alias("la"), F.greatest("la", "lb").alias("lb"),
        size.alias("size"),
    ).distinct()


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, la, lb, possible): whether bit arrays allow the similarity; size - differing bits is twice what two sets can share."""
    sides = [sets.select(F.col("row").alias(x), F.col("flips").alias(f"flips_{x}")) for x in "ab"]
    differ = F.aggregate(
        F.zip_with("flips_a", "flips_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x
    )
    possible = (100 + percent) * (F.col("size") - differ) >= 2 * percent * F.col("size")
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "la", "lb", possible.alias("possible"))


def _linked(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The distinct (la, lb) of the pairs that reach the overlap. Each pair's texts are met row by row; no group is gathered."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, np.ndarray] | None = None
        for batch in batches:
            left, right, keep = column_of(batch, "a").to_pylist(), utf8(column_of(batch, "text_b")), []
            for a, raw_a, raw_b in zip(left, utf8(column_of(batch, "text_a")), right, strict=True):
                if last is None or last[0] != a:
                    last = a, shingle_set(raw_a, words)
                keep.append(overlaps(last[1], shingle_set(raw_b, words), percent))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([column_of(batch, x).filter(mask) for x in ("la", "lb")], names=["a", "b"])

    sides = [texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")) for x in ("a", "b")]
    full = pairs.join(sides[1], "b").join(sides[0], "a")
    return full.select("a", "la", "lb", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def overlaps(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 |a and b| >= percent |a or b|: the smaller sorted set's elements are probed in the larger one."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = int((b[at] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ends of the links (a, b), each once, and the smallest end that each is joined to."""
    ends, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = at[:len(a)], at[len(a):]
    root = np.arange(len(ends))
    while True:
        low, high = np.minimum(root[left], root[right]), np.maximum(root[left], root[right])
        apart = low != high
        if not apart.any():
            return ends, ends[root]
        np.minimum.at(root, high[apart], low[apart])
        while not np.array_equal(root, root[root]):
            root = root[root]


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every end of the stored links (a, b): the smallest end reachable.

    Up to FEW_LINKS links, which are counted first, are joined by one task. More are joined by hooking larger labels
    onto smaller ones: each step sends every end's smallest neighbouring label to its label and then shortens paths by
    one jump, so the number of steps grows with the logarithm of the longest path for the shapes met here. Steps are
    stored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [pa.Table.from_batches([batch]) for batch in batches]
        if parts:
            all_ = pa.concat_tables(parts)
            ends, root = joined(all_["a"].to_numpy(), all_["b"].to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(ends, pa.int64()), pa.array(root, pa.int64())], names=["node", "label"])

    if links.count() <= FEW_LINKS:
        return materialize(links.select("a", "b").coalesce(1).mapInArrow(run, "node long, label long"), "labels")
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    touched = materialize(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    while True:
        near = both.join(touched.select(F.col("node").alias("b"), F.col("label").alias("other")), "b").groupBy("a").agg(
            F.min("other").alias("other")
        )
        met = touched.join(near.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "other").alias("low"))
        # A component's old label learns the smallest label that any of its nodes has met.
        hooks = met.groupBy("label").agg(F.min("low").alias("root"))
        hooked = met.join(hooks, "label").select("node", F.col("root").alias("label"), (F.col("root") < F.col("label")).alias("moved"))
        stored = materialize(hooked, "labels")
        jump = stored.select(F.col("node").alias("label"), F.col("label").alias("next"))
        touched = materialize(stored.join(jump, "label", "left").select("node", F.coalesce("next", "label").alias("label"), "moved"), "labels")
        if touched.where("moved").isEmpty():
            return touched.select("node", "label")
        touched = touched.select("node", "label")


def _relabelled(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with the labels that their labels have become."""
    return df.join(labels.select(F.col("node").alias("label"), F.col("label").alias("_new")), "label", "left").withColumn(
        "label", F.coalesce("_new", "label")
    ).drop("_new")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text",
                    bits: int = COUNT_BITS) -> DataFrame:
    """(row, doc_id, tag, n_shingles, component_id, keeper) of each row.

    component_id is the smallest id of all rows reachable by links; keeper marks one row of each component, one with
    that id. Rows without shingles are their own component. tag names id and text.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    ).withColumn("tag", _tag())
    sets = materialize(_sets(rows, list_lengths(rows, words, bits), words, bits, percent), "sets")
    filled = sets.where("n > 0")
    nodes = materialize(filled.groupBy("key").agg(
        F.min("row").alias("node"), F.max("n").alias("n"), F.min("doc_id").alias("id"),
        F.coalesce(F.min_by("row", "doc_id"), F.min("row")).alias("first"), F.min_by("tag", "row").alias("tag"),
    ), "nodes")
    postings = filled.select(F.col("row").alias("node"), F.posexplode("short").alias("at", "shingle"))
    lists = materialize(_lists(postings, nodes), "lists")
    members = lists.withColumn("label", F.col("node"))
    labels = tested = texts = None
    pivots = 1
    while True:
        open_ = materialize(_open(members), "open")
        if open_.isEmpty():
            break
        later = open_.where(F.col("k") > WHOLE * pivots).drop("k")
        fresh = _candidates(open_, pivots, percent)
        if tested is not None:
            fresh = fresh.join(tested, ["a", "b"], "left_anti")
        fresh = materialize(_possible(fresh, sets, percent), "pairs")
        tested = fresh.select("a", "b") if tested is None else tested.unionByName(fresh.select("a", "b"))
        pairs = fresh.where("possible")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        if texts is not None:
            ends = ends.join(texts, "node", "left_anti")
        wanted = materialize(nodes.select("node", "tag").join(ends, "node"), "wanted")
        n_wanted = wanted.count()
        if n_wanted:
            got = materialize(_texts(rows, wanted, n_wanted), "texts")
            texts = got if texts is None else texts.unionByName(got)
        members = later
        if texts is None:
            pivots *= MORE
            continue
        linked = materialize(_linked(pairs, texts, words, percent), "linked")
        if not linked.isEmpty():
            moved = components(linked)
            members = _relabelled(members, moved)
            labels = moved if labels is None else materialize(
                _relabelled(labels, moved).select("node", "label").unionByName(moved.join(labels, "node", "left_anti")), "labels"
            )
        pivots *= MORE
    if labels is None:
        labels = nodes.select("node", F.col("node").alias("label"))
    whole = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = whole.groupBy("label").agg(
        F.min("id").alias("component_id"), F.coalesce(F.min_by("first", "id"), F.min("node")).alias("_keeper")
    )
    named = whole.join(smallest, "label").select("key", "component_id", "_keeper")
    marked = filled.join(named, "key").select(
        "row", "doc_id", "tag", F.col("n").alias("n_shingles"), "component_id", (F.col("row") == F.col("_keeper")).alias("keeper")
    )
    alone = sets.where("n = 0").select(
        "row", "doc_id", "tag", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("keeper")
    )
    return marked.unionByName(alone)


def _tag(doc_id: Column | str = "doc_id", text: Column | str = "text") -> Column:
    """Names rows of one id and text, with 128 bits."""
    return F.struct(F.xxhash64(doc_id, text).alias("x"), F.xxhash64(F.lit(1), doc_id, text).alias("y"))


def _texts(rows: DataFrame, wanted: DataFrame, n_wanted: int) -> DataFrame:
    """(node, text) of the wanted (node, tag), found again by their tags in one more pass over the texts.

    A bit array over the tags keeps most other texts out of the shuffle.
    """
    bits = min(max(math.ceil(math.log2(BITS_EACH * n_wanted)), 10), MOST_FILTER_BITS)
    place = F.shiftrightunsigned(F.xxhash64("tag"), 64 - bits)
    words = wanted.select(F.shiftright(place, 6).alias("word"), F.expr("1L").alias("one"), place.alias("place")).select(
        "word", F.call_function("shiftleft", F.col("one"), F.pmod("place", F.lit(64)).cast("int")).alias("bits")
    )
    blank = rows.sparkSession.range(1 << bits - 6).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    dense = words.unionByName(blank).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    filled = materialize(
        dense.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("bits")), "filter"
    )
    held = filled.select("bits").scalar()
    maybe = F.getbit(F.get(held, F.shiftright(place, 6).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1
    found = rows.select("tag", "text").where(maybe).join(wanted, "tag")
    # Rows that are equal altogether have one tag; one of them serves.
    return found.groupBy("tag", "node").agg(F.first("text").alias("text")).select("node", "text")


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near copies: of each component the keeper, with all its columns.

    Rows are found again by id and text; of rows equal in both, one stays.
    """
    judged = near_duplicates(docs, words, percent, doc_id, text)
    kept = judged.where("keeper").select(F.col("tag").alias("_tag")).distinct()
    tagged = docs.withColumn("_tag", _tag(F.col(doc_id).cast("long"), F.col(text)))
    copies = judged.groupBy("tag").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("tag").alias("_tag"))
    found = tagged.join(kept, "_tag", "left_semi")
    repeated = found.join(copies, "_tag", "left_semi").dropDuplicates(["_tag"])
    return found.join(copies, "_tag", "left_anti").unionByName(repeated).drop("_tag")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document at a similarity of 85 % of four-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
