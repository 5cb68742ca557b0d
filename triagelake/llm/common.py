"""What the operators share: tables, word arrays in SQL, word hashes and merged counts in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

#: Bytes of one text that are hashed at a time; cuts fall between words.
BLOCK = 1 << 20
#: Rows of large values that are sent back to Spark in one batch.
OUT_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_words(text: Column) -> Column:
    """The words of a text, as an array without nulls."""
    return F.array_remove(F.split(text, SPACES), "")


def sql_n_words(text: Column) -> Column:
    return F.size(sql_words(F.coalesce(text, F.lit("")))).cast("long")


def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit value for each byte (0 for white space; A-Z as a-z), odd powers by position, shingle factors."""
    draw = np.random.Generator(np.random.PCG64(20240301))
    per_byte = draw.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    per_byte[[0x20, *range(0x09, 0x0E)]] = 0
    per_byte[ord("A"):ord("Z") + 1] = per_byte[ord("a"):ord("z") + 1]
    base = draw.integers(1, 1 << 62, dtype=np.uint64) * np.uint64(4) + np.uint64(3)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(1 << 16, base, dtype=np.uint64))
    return per_byte, powers, draw.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


PER_BYTE, POWERS, FACTORS = _constants()
EMPTY = np.empty(0, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(27))
        h = h * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _block_hashes(raw: np.ndarray) -> np.ndarray:
    values = PER_BYTE[raw]
    inside = values != 0
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    if not len(starts):
        return EMPTY
    lengths = np.diff(np.append(starts, len(raw)))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, lengths)
    return mixed(np.add.reduceat(values[starts[0]:] * POWERS[place & 0xFFFF], starts - starts[0]))


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of UTF-8 bytes, A-Z and a-z alike.

    All words of a block are hashed at once; memory is bounded by the block (or by one word, if longer).
    """
    if len(raw) <= BLOCK:
        return _block_hashes(raw) if len(raw) else EMPTY
    parts, at = [], 0
    while at < len(raw):
        end = min(at + BLOCK, len(raw))
        while end < len(raw):
            gap = np.flatnonzero(PER_BYTE[raw[end:end + BLOCK]] == 0)
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + BLOCK, len(raw))
        parts.append(_block_hashes(raw[at:end]))
        at = end
    return np.concatenate(parts)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words; fewer words are one shingle, none give none. With repeats."""
    n = len(words)
    if n == 0:
        return EMPTY
    size = min(size, n)
    with np.errstate(over="ignore"):
        total = np.full(n - size + 1, np.uint64(size), dtype=np.uint64)
        for i in range(size):
            total += words[i:n - size + 1 + i] * FACTORS[i]
    return mixed(total)


def utf8(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text of an Arrow column, without copies; null as no bytes."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        width = np.int32
    else:
        width = np.int64
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return
    at = np.frombuffer(offsets, dtype=width)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    nulls = column.is_null().to_numpy(zero_copy_only=False) if column.null_count else None
    for i in range(len(column)):
        yield raw[:0] if nulls is not None and nulls[i] else raw[at[i]:at[i + 1]]


#: Ids beyond this may share a double with their neighbours.
EXACT_DOUBLES = 1 << 53


def _bounds_before(value: Column, bounds: Column, n: int, equal: bool) -> Column:
    """Number of sorted bounds below the value, equal ones counted or not, by binary search in one array."""
    steps = [1 << k for k in reversed(range(n.bit_length()))]

    def further(at: Column, step: Column) -> Column:
        bound = F.get(bounds, at + step - 1)
        passed = bound <= value if equal else bound < value
        return F.when(passed, at + step).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)


def id_slices(df: DataFrame, column: str, order: str, slices: int) -> tuple[Column, int]:
    """A slice number that follows the order of a whole-number column, null first, then of `order`, a 64-bit hash, and
    the number of slices.

    The bounds are quantiles of that column alone, so nothing else is read for them; there are as many as slices. An id
    that fills several slices (it is then several bounds) is cut by its rows' hashes; null is an id like others here.
    """
    value = F.coalesce(F.col(column).cast("double"), F.lit(float("-inf")))
    found = df.select(value.alias("value")).approxQuantile(
        "value", [i / slices for i in range(1, slices)], 0.2 / slices
    ) if slices > 1 else []
    if not found:
        return F.lit(0), 1
    bounds = F.split(F.lit(",".join(map(repr, sorted(found)))).cast("string"), ",").cast("array<double>")
    below, upto = (_bounds_before(value, bounds, len(found), equal) for equal in (False, True))
    many = upto - below
    share = F.floor((F.col(order) / F.lit(2.0**64) + 0.5) * many).cast("int")
    whole = value.isNotNull() & ((F.abs(value) <= EXACT_DOUBLES) | (value == float("-inf")))
    cut = F.when(whole & (many > 1), below + 1 + F.least(share, many - 1)).otherwise(upto)
    return cut.cast("int"), len(found) + 1


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


#: Buckets whose counts travel together.
CHUNK = 1 << 14


def packed_counts(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The chunks of a count array that are not all zero, compressed."""
    for k in range(0, len(counts), CHUNK):
        part = counts[k:k + CHUNK]
        if part.any():
            yield k // CHUNK, zlib.compress(part.astype(np.int64).tobytes(), 1)


def merged_counts(parts: DataFrame, size: int, names: list[str]) -> dict[str, np.ndarray]:
    """Sum count chunks over all tasks. `parts` has (name string, chunk int, counts binary).

    The result has a fixed size, whatever the corpus: `size` counts for each name. A task that merges
    holds one chunk of each name it meets, however many parts there are.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for name, chunk, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                got = np.frombuffer(zlib.decompress(counts), dtype=np.int64)
                if (name, chunk) in held:
                    held[name, chunk] += got
                else:
                    held[name, chunk] = got.copy()
        for (name, chunk), counts in held.items():
            yield pa.RecordBatch.from_pydict({
                "name": pa.array([name]), "chunk": pa.array([chunk], pa.int32()),
                "counts": pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary()),
            })

    spread = parts.select("name", "chunk", "counts").repartition("name", "chunk")
    total = {name: np.zeros(size, dtype=np.int64) for name in names}
    for row in spread.mapInArrow(add, "name string, chunk int, counts binary").toLocalIterator(prefetchPartitions=True):
        got = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.int64)
        total[row["name"]][row["chunk"] * CHUNK:row["chunk"] * CHUNK + len(got)] = got
    return total


def count_parts(df: DataFrame, names: list[str], size: int,
                count: Callable[[pa.RecordBatch, dict[str, np.ndarray]], None]) -> DataFrame:
    """Let each task add its batches to count arrays and send their chunks; see `merged_counts`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {name: np.zeros(size, dtype=np.uint32) for name in names}
        for batch in batches:
            count(batch, held)
        for name in names:
            for chunk, counts in packed_counts(held[name]):
                yield pa.RecordBatch.from_pydict({
                    "name": pa.array([name]), "chunk": pa.array([chunk], pa.int32()),
                    "counts": pa.array([counts], pa.binary()),
                })

    return df.mapInArrow(run, "name string, chunk int, counts binary")
