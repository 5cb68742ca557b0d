"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the k smallest distinct hashes of a text's five-word shingles. Sketches of parts merge into
the sketch of the whole: the k smallest of all their hashes. With the k-th smallest value they estimate the
number of distinct shingles; two sketches estimate resemblance and containment of the texts.

Edge cases: null texts count as empty. A text of one to four words has one shingle, its whole sequence; an empty
text has an empty sketch. Two empty sketches resemble each other fully, an empty and another not at all. Equal
texts have equal sketches. Null ids come first in the order of documents; rows with one id are ordered by a hash
of their text. A table of one row is its own next document; an empty table gives no rows. Other columns of the
input are not carried.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triagelake.llm.common import column_of, id_slices, shingles, table, utf8, word_hashes

WORDS = 5
K = 128
OUT_ROWS = 512
_SPAN = float(2**64)


def sketch(raw: np.ndarray, k: int = K, words: int = WORDS) -> np.ndarray:
    """The k smallest distinct shingle hashes of a text's UTF-8 bytes, ascending."""
    return smallest(shingles(word_hashes(raw), words), k)


def smallest(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct values; repeats are common, so a few more than k are sorted at first."""
    many = 4 * k
    while len(hashes) > many:
        found = np.unique(np.partition(hashes, many)[:many])
        if len(found) >= k:
            return found[:k]
        many *= 4
    return np.unique(hashes)[:k]


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of two parts together."""
    return np.union1d(a, b)[:k]


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimate of the number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) * _SPAN / float(a[k - 1])


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimate of |A and B| / |A or B|: the share of the union's sketch that both hold."""
    union = merged(a, b, k)
    if not len(union):
        return 1.0
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum()) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimate of |A and B| / |A|, the share of the first text's shingles that the second has."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return min(1.0, both / distinct_shingles(a, k))


def as_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype="<u8")


def sketch_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """(doc_id, fingerprint, n_shingles) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                rows = batch.slice(at, OUT_ROWS)
                own = [sketch(raw, k) for raw in utf8(column_of(rows, "text"))]
                yield pa.RecordBatch.from_arrays(
                    [column_of(rows, "doc_id"), pa.array([as_text(a) for a in own], pa.string()),
                     pa.array([distinct_shingles(a, k) for a in own], pa.float64())],
                    names=["doc_id", "fingerprint", "n_shingles"],
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, fingerprint string, n_shingles double"
    )


def merge_sketches(parts: DataFrame, key: str, fingerprint: str = "fingerprint", k: int = K) -> DataFrame:
    """(key, fingerprint) of all parts of each key.

    Parts are merged one after the other inside tasks, keys spread over 64 salts first, so a key with most of
    the rows is neither met in one task nor held in memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            for name, part in zip(names, batch.column(1).to_pylist(), strict=True):
                held[name] = merged(held[name], from_text(part or ""), k) if name in held else from_text(part or "")
            if len(held) > 20_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(held), batch.schema.field(0).type), pa.array([as_text(a) for a in held.values()])],
                    names=batch.schema.names,
                )
                held = {}
            kind, columns = batch.schema.field(0).type, batch.schema.names
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), kind), pa.array([as_text(a) for a in held.values()])], names=columns
            )

    rows = parts.select(F.col(key), F.col(fingerprint).alias("fingerprint"))
    schema = rows.schema
    salt = F.pmod(F.xxhash64("fingerprint"), F.lit(64))
    once = rows.repartition(F.col(key), salt).sortWithinPartitions(key).mapInArrow(run, schema)
    last = once.repartition(F.col(key)).sortWithinPartitions(key)
    return last.groupBy(key).applyInArrow(
        lambda group: pa.table({
            group.schema.names[0]: group.column(0).slice(0, 1),
            "fingerprint": pa.array([as_text(_merge_all(group.column(1).to_pylist(), k))]),
        }), schema,
    )


def _merge_all(texts: list[str], k: int) -> np.ndarray:
    total = np.empty(0, dtype=np.uint64)
    for text in texts:
        total = merged(total, from_text(text), k)
    return total


def with_next(docs: DataFrame, slices: int) -> DataFrame:
    """(slice, tail, doc_id, order, text): documents in order within slices of the id range, each partition one
    slice, and at its end a copy of the next slice's first document (tail), the last slice's being the first of all.

    Each text is shuffled once; only the copies, one for each slice, travel twice.
    """
    rows = docs.withColumn("order", F.xxhash64("text"))
    number, n_slices = id_slices(docs, "doc_id", "order", slices)
    sliced = rows.withColumn("slice", number)
    firsts = sliced.groupBy("slice").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "order")).alias("head"))
    around = Window.orderBy(F.col("slice").desc())
    heads = firsts.select(
        F.col("head.doc_id").alias("_id"), F.col("head.order").alias("_order"),
        F.coalesce(F.lag("slice").over(around.orderBy("slice")), F.max("slice").over(Window.partitionBy(F.lit(0)))).alias("_slice"),
    )
    # One head for each slice: their number is bounded by the number of slices, so they may be broadcast.
    tails = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("order") == F.col("_order"))).groupBy("_slice").agg(
        F.any_value("doc_id").alias("doc_id"), F.any_value("order").alias("order"), F.any_value("text").alias("text")
    )
    both = sliced.select("slice", F.lit(False).alias("tail"), "doc_id", "order", "text").unionByName(
        tails.select(F.col("_slice").alias("slice"), F.lit(True).alias("tail"), "doc_id", "order", "text")
    )
    return both.repartitionById(n_slices, F.col("slice").cast("int")).sortWithinPartitions(
        "slice", "tail", F.col("doc_id").asc_nulls_first(), "order"
    )


def _fingerprinted(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Each row waits for the one after it; of the rows before, one sketch is held."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    out: list[tuple] = []
    held = None

    def done() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(x), kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=names
        )

    for batch in batches:
        columns = [column_of(batch, x) for x in ("slice", "tail", "doc_id", "text")]
        for part, tail, doc_id, value in zip(*columns, strict=True):
            text = value.as_py() or ""
            own = sketch(np.frombuffer(text.encode(), dtype=np.uint8), k)
            part, tail = part.as_py(), tail.as_py()
            if held is not None and held[0] == part:
                _, before, before_text, before_own = held
                cut = len(before_text) // 2
                edited = (before_text[:len(before_text) - cut] + text[:cut]).encode()
                changed = sketch(np.frombuffer(edited, dtype=np.uint8), k)
                out.append((
                    before, len(before_text), hashlib.sha256(edited).hexdigest(), as_text(before_own), as_text(changed),
                    resemblance(before_own, changed, k), resemblance(before_own, own, k),
                ))
                if len(out) >= OUT_ROWS:
                    yield done()
                    out = []
            held = None if tail else (part, doc_id.as_py(), text, own)
    if out:
        yield done()


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Each document's sketch, that of its edited text (second half replaced from the next document), and how near
    they are: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    slices = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return with_next(rows, slices).mapInArrow(
        lambda batches: _fingerprinted(batches, k),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and its edited text."""
    return fingerprint_edits(table(spark, sf_dir, "documents"))
