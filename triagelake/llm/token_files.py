"""Token ids as ORC files, ordered by document id.

Each file holds a range of ids in order: (part, doc_id, order, n_tokens, ids). ORC stores `ids` with
integer run-length encoding in stripes that are read in parallel, an index entry every few thousand rows,
and a Bloom filter on `doc_id`, so a lookup by id skips files and stripes by their metadata alone. A
document's place in the whole token stream is the sum of the parts before its own, from the n_tokens column
only, plus a running sum inside the part.

Edge cases: a null text counts as empty and has the end id alone. Null ids come first. Rows with the same id
are ordered by a hash of the text (rows that are equal altogether are interchangeable), so the result does not
depend on the input's order. An empty table gives an empty folder that reads back as no rows. Other columns of
the input are not stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triagelake.llm.common import column_of, id_slices, table
from triagelake.llm.tokens import default_path, encoder
from triagelake.session import scratch_path

END_ID = 2
#: Ids of one batch sent to Spark.
OUT_TOKENS = 1 << 20
SCHEMA = "part int, doc_id long, order long, n_tokens long, ids array<int>"
ORC = {
    "compression": "snappy", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true", "orc.row.index.stride": "2000", "orc.stripe.size": str(32 << 20),
}


def encoded_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """(part, doc_id, order, text) to SCHEMA, a bounded number of ids at a time."""
    encode = encoder(path).encode
    tail = np.asarray([end_id], dtype="<u4").tobytes()
    for batch in batches:
        ids = encode(column_of(batch, "text").to_pylist())
        at = 0
        while at < batch.num_rows:
            held, size, first = [], 0, at
            while at < batch.num_rows and size < 4 * OUT_TOKENS:
                held.append(next(ids) + tail)
                size += len(held[-1])
                at += 1
            sizes = np.fromiter(map(len, held), dtype=np.int64) // 4
            values = pa.Array.from_buffers(pa.int32(), int(sizes.sum()), [None, pa.py_buffer(b"".join(held))])
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            rows = batch.slice(first, at - first)
            yield pa.RecordBatch.from_arrays(
                [column_of(rows, "part"), column_of(rows, "doc_id"), column_of(rows, "order"), pa.array(sizes),
                 pa.ListArray.from_arrays(offsets, values)],
                names=["part", "doc_id", "order", "n_tokens", "ids"],
            )


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, doc_id: str = "doc_id",
                 text: str = "text") -> None:
    """Write the ids of every text, dealt to files by ranges of ids. Texts are shuffled once, before encoding."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("order"), F.col(text).alias("text")
    )
    part, parts = id_slices(rows, "doc_id", "order", int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.withColumn("part", part).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id", "order")
    ranged.select("part", "doc_id", "order", "text").mapInArrow(
        lambda batches: encoded_batches(batches, tokenizer, end_id), SCHEMA
    ).write.options(**ORC).orc(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The files as they are; filters on doc_id skip files, stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(folder)


def with_starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Add start, the ids of all documents before, to narrow rows (part, doc_id, order, n_tokens, ...)."""
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    ahead = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("ahead"))
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "order").rowsBetween(
        Window.unboundedPreceding, 0
    )
    return rows.join(ahead, "part").withColumn(
        "start", F.col("ahead") + F.sum("n_tokens").over(inside) - F.col("n_tokens")
    )


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = column_of(batch, "ids")
        at = ids.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(), dtype="<u4")).cast("B")
        sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(column_of(batch, x) for x in ("part", "doc_id", "order", "n_tokens")), pa.array(sums, pa.int64())],
            names=["part", "doc_id", "order", "n_tokens", "ids_crc32"],
        )


def token_digest(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each stored document; stripes are read in parallel."""
    files = read_tokens(spark, folder)
    narrow = files.mapInArrow(_checksums, "part int, doc_id long, order long, n_tokens long, ids_crc32 long")
    return with_starts(narrow, files).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written as ids and read back."""
    folder = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder, default_path())
    return token_digest(spark, folder)
