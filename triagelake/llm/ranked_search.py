"""Ranked lexical search the other way round: the items are indexed, the documents stream by.

The inverted index over the items' terms is what is broadcast. Items are dealt by hash into blocks of some `BLOCK`
postings and `ITEMS` items, so the index has a bound however many items there are, and the documents are read twice
for each block. A first pass counts, for the terms of the items, the documents
that hold them, and all terms of all documents; only one count for each term of the items reaches the driver. The
second pass streams each document's term counts through the index: its scores for all items are summed, and each
item keeps its best `k` in a heap. The heaps of the tasks are then merged in two steps, first by item and group of
tasks, then by item.

Terms are runs of ASCII letters and digits and of all other characters outside ASCII, A-Z lower-cased; in UTF-8 that
is a matter of bytes. Scores are exact integers.

Edge cases: null and empty texts have no terms; such items give no rows and such documents are never found. Rows of
one item_id are items of their own, ranked each by itself; a document that is there twice takes two ranks. Equal
scores are ranked by ascending doc_id, null last. Without documents or items there are no rows. Other columns are
not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triagelake.llm.common import column_of, table, utf8
from triagelake.session import materialize

TOP = 20
#: Postings (term and item) and items of one broadcast index, about.
BLOCK = 500_000
ITEMS = 20_000
#: Cells of the score table (documents by items) of one step of a task.
CELLS = 1 << 20
#: Groups of tasks whose heaps are merged first.
GROUPS = 64
K1_SHARE, LENGTH_SHARE = 75, 25


def _letters() -> bytes:
    table = bytearray(b" " * 256)
    for i in range(256):
        if i >= 128 or chr(i).isalnum():
            table[i] = i
    for i in range(ord("A"), ord("Z") + 1):
        table[i] = i + 32
    return bytes(table)


LETTERS = _letters()


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return raw.translate(LETTERS).split()


def item_terms(items: DataFrame) -> DataFrame:
    """One row for each item (row of the table) and term with its number of repeats."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found, repeats = [], [], []
            for i, raw in enumerate(utf8(column_of(batch, "text"))):
                counted = Counter(terms(raw.tobytes()))
                at += [i] * len(counted)
                found += counted.keys()
                repeats += counted.values()
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "item").take(rows), column_of(batch, "item_id").take(rows),
                 pa.array(found, pa.binary()), pa.array(repeats, pa.int64())],
                names=["item", "item_id", "term", "repeats"],
            )

    rows = items.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), F.col("text")
    )
    return rows.mapInArrow(count, "item long, item_id long, term binary, repeats long")


class Index:
    """Items by term: for term number t, the items `items[starts[t]:starts[t + 1]]` with their repeats."""

    def __init__(self, rows: list[tuple[int, int | None, bytes, int]]):
        numbers: dict[int, int] = {}
        self.ids: list[int | None] = []
        by_term: dict[bytes, list[tuple[int, int]]] = {}
        for item, item_id, term, repeats in rows:
            if item not in numbers:
                numbers[item] = len(numbers)
                self.ids.append(item_id)
            by_term.setdefault(bytes(term), []).append((numbers[item], repeats))
        self.number = {term: i for i, term in enumerate(by_term)}
        self.starts = np.cumsum([0, *map(len, by_term.values())])
        flat = [x for postings in by_term.values() for x in postings]
        self.items = np.asarray([x[0] for x in flat], dtype=np.int64)
        self.repeats = np.asarray([x[1] for x in flat], dtype=np.int64)
        self.weights = np.zeros(len(by_term), dtype=np.int64)
        self.n_docs = self.n_terms = 0

    def weigh(self, holding: dict[int, int], n_docs: int, n_terms: int) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        for i in range(len(self.weights)):
            self.weights[i] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding.get(i, 0) + 1)))


def _statistics(batches: Iterator[pa.RecordBatch], number: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term of the items; documents with terms as number -1, all their terms as -2."""
    holding = np.zeros(len(number), dtype=np.int64)
    n_docs = n_terms = 0
    for batch in batches:
        for raw in utf8(column_of(batch, "text")):
            found = terms(raw.tobytes())
            n_docs += bool(found)
            n_terms += len(found)
            holding[[number[x] for x in number.keys() & found]] += 1
    known = np.flatnonzero(holding)
    yield pa.RecordBatch.from_pydict({
        "term": pa.array([-1, -2, *known.tolist()], pa.int64()),
        "n": pa.array([n_docs, n_terms, *holding[known].tolist()], pa.int64()),
    })


class Heaps:
    """The best `k` documents of each item so far: by score, then by smallest id, null last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n_items)]
        self.least = np.ones(n_items, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        docs, items = np.nonzero(scores >= self.least)
        for doc, item, score in zip(docs.tolist(), items.tolist(), scores[docs, items].tolist(), strict=True):
            heap, doc_id = self.heaps[item], ids[doc]
            entry = (score, -math.inf if doc_id is None else -doc_id)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.least[item] = heap[0][0]


def _found(batches: Iterator[pa.RecordBatch], index: Index, k: int) -> Iterator[pa.RecordBatch]:
    """The heaps of a task, after all its documents."""
    n_items = len(index.ids)
    heaps = Heaps(n_items, k)
    at_once = max(1, CELLS // max(1, n_items))
    number, lengths = index.number, np.diff(index.starts)
    rows: list[int] = []
    words: list[int] = []
    counts: list[int] = []
    shares: list[int] = []
    ids: list[int | None] = []

    def score() -> None:
        if words:
            term, tf, m = (np.asarray(x, dtype=np.int64) for x in (words, counts, shares))
            value = index.weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            many = lengths[term]
            begins = np.cumsum(many) - many
            entry = np.arange(int(many.sum())) + np.repeat(index.starts[term] - begins, many)
            cell = np.repeat(np.asarray(rows, dtype=np.int64) * n_items, many) + index.items[entry]
            scores = np.zeros(len(ids) * n_items, dtype=np.int64)
            np.add.at(scores, cell, np.repeat(value, many) * index.repeats[entry])
            heaps.add(scores.reshape(len(ids), n_items), ids)
        for held in (rows, words, counts, shares, ids):
            held.clear()

    size = 0
    for batch in batches:
        doc_ids = column_of(batch, "doc_id").to_pylist()
        for doc_id, raw in zip(doc_ids, utf8(column_of(batch, "text")), strict=True):
            found = terms(raw.tobytes())
            counted = Counter(filter(number.__contains__, found))
            if not counted:
                continue
            m = 100 - LENGTH_SHARE + LENGTH_SHARE * len(found) * index.n_docs // index.n_terms
            rows += [len(ids)] * len(counted)
            words += map(number.__getitem__, counted)
            counts += counted.values()
            shares += [m] * len(counted)
            ids.append(doc_id)
            size += int(lengths[[number[x] for x in counted]].sum())
            if len(ids) >= at_once or size >= CELLS:
                score()
                size = 0
    score()
    out = [(i, s, None if d == -math.inf else -d) for i, heap in enumerate(heaps.heaps) for s, d in heap]
    columns = list(zip(*out, strict=True)) or [()] * 3
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["item", "score", "doc_id"])


def _best(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, rows: list[tuple[int, int | None, bytes, int]], k: int) -> DataFrame:
    spark = docs.sparkSession
    index = Index(rows)
    number = spark.sparkContext.broadcast(index.number)
    counted = docs.select("text").mapInArrow(lambda b: _statistics(b, number.value), "term long, n long")
    totals = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    index.weigh(totals, totals.get(-1, 0), max(1, totals.get(-2, 0)))
    shared = spark.sparkContext.broadcast(index)
    heaps = docs.select("doc_id", "text").mapInArrow(
        lambda b: _found(b, shared.value, k), "item long, score long, doc_id long"
    )
    merged = _best(heaps.withColumn("part", F.spark_partition_id() % GROUPS), ["item", "part"], k)
    ids = spark.createDataFrame(list(enumerate(index.ids)), "item long, item_id long")
    return _best(merged.drop("rank"), ["item"], k).join(ids, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block: int = BLOCK) -> DataFrame:
    """Per item its `k` best documents: item_id, rank, doc_id, score."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = materialize(item_terms(items), "item-terms")
    size = found.agg(F.count(F.lit(1)).alias("postings"), F.countDistinct("item").alias("items")).first()
    blocks = max(1, math.ceil(size["postings"] / block), math.ceil(size["items"] / ITEMS))
    dealt = F.pmod(F.xxhash64("item"), F.lit(blocks))
    parts = (found.where(dealt == i).collect() for i in range(blocks))
    results = [_search_block(docs, [tuple(r) for r in rows], k) for rows in parts if rows]
    if not results:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP12_SQL = f"""
WITH doc AS (
    SELECT row_number() OVER () AS place, doc_id, regexp_extract_all({_LOWER.format("text")}, '{_PATTERN}') AS words
    FROM documents
), item AS (
    SELECT row_number() OVER () AS place, item_id, regexp_extract_all({_LOWER.format("text")}, '{_PATTERN}') AS words
    FROM benchmark
), total AS (
    SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM doc WHERE len(words) > 0
), tf AS (
    SELECT place, doc_id, len(words) AS n, term, count(*) AS tf
    FROM (SELECT place, doc_id, words, unnest(words) AS term FROM doc) GROUP BY ALL
), df AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term
), wanted AS (
    SELECT place AS item, item_id, term, count(*) AS repeats FROM (SELECT place, item_id, unnest(words) AS term FROM item) GROUP BY ALL
), scored AS (
    SELECT item, item_id, place, doc_id, sum(repeats * w * ((1000000000 * tf) //
        (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM wanted JOIN tf USING (term) JOIN df USING (term), total GROUP BY ALL
)
SELECT item_id::BIGINT AS item_id, rank::INTEGER AS rank, doc_id::BIGINT AS doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, place) AS rank FROM scored WHERE score > 0
) WHERE rank <= {TOP}
"""
