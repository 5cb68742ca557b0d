"""LM scoring by cross-entropy difference of two matched bigram models.

Target and background model have the same order, smoothing and vocabulary: every word and every pair of words of the
corpus has counts of its own (words by their 64-bit hash, pairs by a 64-bit hash of both), so the models grow with the
corpus. P(w | v) = (c(v, w) + m P(w)) / (c(v) + m), where P(w) is the share of w, smoothed over a vocabulary of 2^18
words or as many as there are, if more; v of the first word is the start. A document's losses are its mean negative
log2 probabilities per word, score = background loss - target loss: above 0 means nearer to the target.

Tasks cut their documents into chunks and send each distinct word and pair of a chunk once, with its counts, to slots of
the hash range. To score a corpus by its own models (`score_corpus`), a slot sums what has come in and answers every
chunk in the same step: the answers, the counts of just a chunk's own words and pairs, are stored and meet the chunk's
texts, which are read again. Both readings must cut the same chunks, as they do for files; a chunk whose words differ
from what it asked for is an error. For other documents (`gather`, `score_documents`) the sums are stored, and chunks
ask for them. A word or pair has one entry for each chunk, however common it is, so no slot holds much more than others;
slots grow in number with the text. Only totals reach the driver.

Edge cases: null texts count as empty; a text without words has n_words 0, losses and score 0. Null target marks
count as not in the target. An empty corpus gives uniform models. Repeated rows count each time. Other columns of
the input are not carried. A text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.llm.common import EMPTY, FACTORS, column_of, mixed, table, utf8, word_hashes
from triagelake.session import materialize

#: The least vocabulary that smoothing assumes has 2^WORD_BITS words.
WORD_BITS = 18
#: What stands before the first word, the weight of the unigram share in each pair, and what is added to each word's count.
START, STRENGTH, ADDED = np.uint64(0), 8.0, 0.5
#: Words of a chunk, bytes of text for each slot, and bits of the least number of slots of each kind (words, pairs).
CHUNK_WORDS, SLOT_BYTES, LEAST_BITS = 1 << 21, 1 << 24, 6
#: Bytes of text of a chunk of a corpus, and ids of marked documents that are broadcast at most (16 MB).
CHUNK_BYTES, MOST_BROADCAST = 1 << 24, 2_000_000
OUT_SCHEMA = "doc_id long, n_words long, background_loss double, target_loss double, score double"


def _packed(values: np.ndarray, kind: str) -> bytes:
    return zlib.compress(values.astype(kind).tobytes(), 1)


def _unpacked(parts: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(map(zlib.decompress, parts)), dtype=kind)


def _keys(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u8")


def _chunks(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Values of a column and word hashes of documents, as many as make a chunk."""
    values, words, size = [], [], 0
    for batch in batches:
        for value, raw in zip(column_of(batch, name).to_pylist(), utf8(column_of(batch, "text")), strict=True):
            values.append(value)
            words.append(word_hashes(raw))
            size += len(words[-1]) + 1
            if size >= CHUNK_WORDS:
                yield values, words
                values, words, size = [], [], 0
    if values:
        yield values, words


def _joined(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The documents' lengths, and for each word: its hash, the hash before it, and the hash of the pair."""
    lengths = np.array([len(x) for x in words], dtype=np.int64)
    word = np.concatenate(words) if words else EMPTY
    before = np.concatenate(([START], word[:-1])) if len(word) else word
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = START
    with np.errstate(over="ignore"):
        return lengths, word, before, mixed(before * FACTORS[0] + word)


def _slots(words: np.ndarray, pairs: np.ndarray, bits: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(slot, from, to, keys) for sorted words, and then for sorted pairs in the slots above those of words."""
    for kind, keys in enumerate((words, pairs)):
        edges = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).tolist()
        for k in range(1 << bits):
            if edges[k] < edges[k + 1]:
                yield (kind << bits) + k, edges[k], edges[k + 1], keys[edges[k]:edges[k + 1]]


def gather(docs: DataFrame, target: str = "target", text: str = "text", size: int | None = None) -> dict[str, object]:
    """The models: `rows`, a stored table of slots with counts of words and pairs in all documents and in those marked as
    target; `bits` of a slot number; `words`, all and in the target; `distinct` words. `size`: bytes of text, if known."""
    if size is None:
        size = docs.agg(F.sum(F.octet_length(text))).first()[0]
    bits = max(LEAST_BITS, ((size or 0) // SLOT_BYTES).bit_length())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for marks, words in _chunks(batches, "target"):
            lengths, word, _, pair = _joined(words)
            marked = np.repeat(np.array(marks, dtype=bool), lengths)
            found = [np.unique(x, return_inverse=True) for x in (word, pair)]
            every = [np.bincount(at, minlength=len(keys)) for keys, at in found]
            good = [np.bincount(at[marked], minlength=len(keys)) for keys, at in found]
            rows = [
                (slot, keys.tobytes(), _packed(every[slot >> bits][a:b], "<i8"), _packed(good[slot >> bits][a:b], "<i8"))
                for slot, a, b, keys in _slots(found[0][0], found[1][0], bits)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 3), strict=True)],
                    names=["slot", "keys", "n", "t"],
                )

    def add(rows: pa.Table) -> pa.Table:
        keys = _keys(rows["keys"])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        n, t = (np.add.reduceat(_unpacked(rows[x].to_pylist(), "<i8")[order], first) for x in ("n", "t"))
        return pa.table({
            "slot": pa.array([rows["slot"][0].as_py()], pa.int32()), "keys": pa.array([keys[first].tobytes()], pa.binary()),
            "n": pa.array([_packed(n, "<i8")], pa.binary()), "t": pa.array([_packed(t, "<i8")], pa.binary()),
            "distinct": pa.array([len(first)], pa.int64()), "every": pa.array([int(n.sum())], pa.int64()),
            "good": pa.array([int(t.sum())], pa.int64()),
        })

    marked = docs.select(F.coalesce(F.col(target).cast("boolean"), F.lit(False)).alias("target"), F.col(text).alias("text"))
    rows = materialize(
        marked.mapInArrow(count, "slot int, keys binary, n binary, t binary").groupBy("slot").applyInArrow(
            add, "slot int, keys binary, n binary, t binary, distinct long, every long, good long"
        ), "lm-counts",
    )
    distinct, every, good = rows.where(F.col("slot") < (1 << bits)).agg(
        *(F.coalesce(F.sum(x), F.lit(0)) for x in ("distinct", "every", "good"))
    ).first()
    return {"rows": rows.select("slot", "keys", "n", "t"), "bits": bits, "words": np.array([every, good]), "distinct": distinct}


def score_documents(docs: DataFrame, counts: dict[str, object], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, background_loss, target_loss, score) of each row."""
    bits, totals = counts["bits"], [float(x) for x in counts["words"]]
    vocabulary = max(1 << WORD_BITS, counts["distinct"] + 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, (ids, words) in enumerate(_chunks(batches, "doc_id")):
            lengths, word, before, pair = _joined(words)
            single = np.unique(word)
            double, at, each = np.unique(pair, return_index=True, return_inverse=True)
            rows = [(slot, keys.tobytes()) for slot, _, _, keys in _slots(single, double, bits)]
            place = np.where(before[at] == START, -1, np.searchsorted(single, before[at]))
            sent = [_packed(x, "<i4") for x in (lengths, each, place, np.searchsorted(single, word[at]))]
            n = len(rows) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + k] * n, pa.int64()), pa.array([-1, *(r[0] for r in rows)], pa.int32()),
                 pa.array([None, *(r[1] for r in rows)], pa.binary()), pa.array([ids, *[None] * (n - 1)], pa.list_(pa.int64())),
                 *(pa.array([x, *[None] * (n - 1)], pa.binary()) for x in sent)],
                names=["chunk", "slot", "keys", "ids", "lengths", "each", "before", "word"],
            )

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        keys = _keys(known["keys"])
        n, t = (np.append(_unpacked(known[x].to_pylist(), "<i8"), 0) for x in ("n", "t"))
        got: list[list[bytes]] = [[], []]
        for raw in asked["keys"].to_pylist():
            wanted = np.frombuffer(raw, dtype="<u8")
            at = np.searchsorted(keys, wanted)
            at[np.append(keys, START)[at] != wanted] = len(keys)
            at[at == len(keys)] = len(n) - 1
            got[0].append(_packed(n[at], "<i8"))
            got[1].append(_packed(t[at], "<i8"))
        return pa.table({"chunk": asked["chunk"], "slot": asked["slot"], "n": pa.array(got[0], pa.binary()), "t": pa.array(got[1], pa.binary())})

    def score(asked: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("slot")
        lengths, each, before, word = (_unpacked(asked[x].to_pylist(), "<i4") for x in ("lengths", "each", "before", "word"))
        doc = np.repeat(np.arange(len(lengths)), lengths)
        losses = []
        for name, total in zip(("n", "t"), totals, strict=True):
            got = _unpacked(answers[name].to_pylist(), "<i8").astype(float)
            # Words first, then pairs, each in the order of their hashes; before the first word stands nothing, counted 0 times.
            single, double = np.append(got[:len(got) - len(word)], 0.0), got[len(got) - len(word):]
            share = (single[word] + ADDED) / (total + ADDED * vocabulary)
            # The start is counted by its pairs only.
            bits_of = -np.log2((double + STRENGTH * share) / (np.maximum(single[before], double) + STRENGTH))
            losses.append(np.bincount(doc, bits_of[each], minlength=len(lengths)) / np.maximum(lengths, 1))
        background, target = losses
        return pa.table({
            "doc_id": pa.array(asked["ids"][0].as_py(), pa.int64()),
            "n_words": pa.array(lengths.astype(np.int64)), "background_loss": pa.array(background), "target_loss": pa.array(target),
            "score": pa.array(background - target),
        })

    names = ["lengths", "each", "before", "word"]
    # Stored: which documents make a chunk may differ when they are read again.
    asked = materialize(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
            ask, "chunk long, slot int, keys binary, ids array<long>, " + ", ".join(f"{x} binary" for x in names)
        ), "lm-chunks",
    )
    requests = asked.where("slot >= 0").select("chunk", "slot", "keys").groupBy("slot")
    answers = requests.cogroup(counts["rows"].groupBy("slot")).applyInArrow(answer, "chunk long, slot int, n binary, t binary")
    return asked.where("slot < 0").select("chunk", "ids", *names).groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, OUT_SCHEMA)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by byte: the high bytes of neighbours are alike and get compressed, the low ones are kept as they are."""
    raw = keys.astype("<u8").view(np.uint8).reshape(-1, 8)
    return len(keys).to_bytes(8, "little") + raw[:, :5].tobytes() + zlib.compress(raw[:, 5:].T.tobytes(), 1)


def _unpack_keys(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    raw = np.empty((n, 8), dtype=np.uint8)
    raw[:, :5] = np.frombuffer(packed, np.uint8, 5 * n, 8).reshape(n, 5)
    raw[:, 5:] = np.frombuffer(zlib.decompress(packed[8 + 5 * n:]), np.uint8).reshape(3, n).T
    return raw.reshape(-1).view("<u8")


def _numbered(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with the chunk of each row; a chunk ends with the row that fills it, so it depends on the rows before alone."""
    part, k, size = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        chunk = np.empty(batch.num_rows, dtype=np.int64)
        for i, raw in enumerate(utf8(column_of(batch, "text"))):
            chunk[i] = (part << 32) + k
            size += len(raw)
            if size >= chunk_bytes:
                k, size = k + 1, 0
        yield batch, chunk


def _counted(batches: Iterator[pa.RecordBatch], bits: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """(slot, chunk, keys, n, t): the distinct words and pairs of each chunk with their counts."""
    held: list[np.ndarray] = []
    marks: list[bool] = []

    def out(chunk: int) -> pa.RecordBatch:
        lengths, word, _, pair = _joined(held)
        marked = np.repeat(np.array(marks, dtype=bool), lengths)
        found = [np.unique(x, return_inverse=True) for x in (word, pair)]
        every = [np.bincount(at, minlength=len(keys)) for keys, at in found]
        good = [np.bincount(at[marked], minlength=len(keys)) for keys, at in found]
        rows = [
            (slot, _pack_keys(keys), _packed(every[slot >> bits][a:b], "<i8"), _packed(good[slot >> bits][a:b], "<i8"))
            for slot, a, b, keys in _slots(found[0][0], found[1][0], bits)
        ]
        held.clear()
        marks.clear()
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array([chunk] * len(rows), pa.int64()), *[pa.array(x, pa.binary()) for x in columns[1:]]],
            names=["slot", "chunk", "keys", "n", "t"],
        )

    current = None
    for batch, chunk in _numbered(batches, chunk_bytes):
        targets = column_of(batch, "target").to_pylist()
        for number, mark, raw in zip(chunk.tolist(), targets, utf8(column_of(batch, "text")), strict=True):
            if current is not None and number != current:
                yield out(current)
            current = number
            marks.append(mark)
            held.append(word_hashes(raw))
    if current is not None:
        yield out(current)


def _answered(rows: pa.Table) -> pa.Table:
    """The sums over all chunks of a slot, for each chunk those of its own keys; what the slot holds in all in the first row."""
    own = [_unpack_keys(x) for x in rows["keys"].to_pylist()]
    keys, at = np.unique(np.concatenate(own), return_inverse=True)
    sums = []
    for name in ("n", "t"):
        total = np.zeros(len(keys), dtype=np.int64)
        np.add.at(total, at, _unpacked(rows[name].to_pylist(), "<i8"))
        sums.append(total)
    ends = np.cumsum([len(x) for x in own]).tolist()
    answers = [[_packed(total[at[a:b]], "<i8") for a, b in zip([0, *ends], ends, strict=False)] for total in sums]
    facts = {"distinct": len(keys), "every": int(sums[0].sum()), "good": int(sums[1].sum())}
    return pa.table({
        "chunk": rows["chunk"], "slot": rows["slot"], "n": pa.array(answers[0], pa.binary()), "t": pa.array(answers[1], pa.binary()),
        **{name: pa.array([value, *[0] * (len(own) - 1)], pa.int64()) for name, value in facts.items()},
    })


def _placed(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """The texts with their chunk and their place in it."""
    at = 0
    for batch, chunk in _numbered(batches, chunk_bytes):
        places = np.arange(at, at + batch.num_rows)
        at += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunk), pa.array(places), column_of(batch, "doc_id"), column_of(batch, "text")], names=["chunk", "at", "doc_id", "text"],
        )


def score_corpus(docs: DataFrame, target: str = "target", doc_id: str = "doc_id", text: str = "text", size: int | None = None,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_words, background_loss, target_loss, score) of each row, by models of these rows and of those marked."""
    if size is None:
        size = docs.agg(F.sum(F.octet_length(text))).first()[0]
    bits = max(LEAST_BITS, ((size or 0) // SLOT_BYTES).bit_length())
    # Both readings ask for the same columns, so that rows come in the same order from whatever made them.
    marked = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(target).cast("boolean"), F.lit(False)).alias("target"),
        F.col(text).alias("text"),
    )
    answers = materialize(
        marked.mapInArrow(lambda b: _counted(b, bits, chunk_bytes), "slot int, chunk long, keys binary, n binary, t binary").groupBy("slot").applyInArrow(
            _answered, "chunk long, slot int, n binary, t binary, distinct long, every long, good long"
        ), "lm-answers",
    )
    distinct, *totals = answers.where(F.col("slot") < (1 << bits)).agg(
        *(F.coalesce(F.sum(x), F.lit(0)) for x in ("distinct", "every", "good"))
    ).first()
    vocabulary = max(1 << WORD_BITS, distinct + 1)

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        texts, known = texts.sort_by("at").combine_chunks(), known.sort_by("slot")
        column = texts["text"].chunk(0) if texts.num_rows else pa.array([], pa.string())
        lengths, word, before, pair = _joined([word_hashes(raw) for raw in utf8(column)])
        single = np.unique(word)
        double, at, each = np.unique(pair, return_index=True, return_inverse=True)
        place = np.where(before[at] == START, len(single), np.searchsorted(single, before[at]))
        own = np.searchsorted(single, word[at])
        doc = np.repeat(np.arange(len(lengths)), lengths)
        losses = []
        for name, total in zip(("n", "t"), totals, strict=True):
            got = _unpacked(known[name].to_pylist(), "<i8").astype(float)
            if len(got) != len(single) + len(double):
                raise ValueError("the texts were cut into other chunks when they were read again; store them first")
            # Words first, then pairs, each in the order of their hashes; before the first word stands nothing, counted 0 times.
            singles, doubles = np.append(got[:len(single)], 0.0), got[len(single):]
            share = (singles[own] + ADDED) / (total + ADDED * vocabulary)
            # The start is counted by its pairs only.
            bits_of = -np.log2((doubles + STRENGTH * share) / (np.maximum(singles[place], doubles) + STRENGTH))
            losses.append(np.bincount(doc, bits_of[each], minlength=len(lengths)) / np.maximum(lengths, 1))
        return pa.table({
            "doc_id": texts["doc_id"], "n_words": pa.array(lengths.astype(np.int64)), "background_loss": pa.array(losses[0]),
            "target_loss": pa.array(losses[1]), "score": pa.array(losses[0] - losses[1]),
        })

    placed = marked.mapInArrow(
        lambda b: _placed(b, chunk_bytes), "chunk long, at long, doc_id long, text string"
    )
    return placed.groupBy("chunk").cogroup(answers.select("chunk", "slot", "n", "t").groupBy("chunk")).applyInArrow(score, OUT_SCHEMA)


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by how much better the model of documents labelled good predicts it than that of all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    good = materialize(
        table(spark, sf_dir, "labels").where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct(), "good"
    )
    # Labels grow with the corpus: up to a stated number their ids are broadcast, beyond it the texts are shuffled to them.
    if good.count() <= MOST_BROADCAST:
        marked = docs.join(F.broadcast(good.withColumn("target", F.lit(True))), "doc_id", "left")
    else:
        marked = materialize(docs.join(good.withColumn("target", F.lit(True)).hint("merge"), "doc_id", "left"), "marked")
    return score_corpus(marked, size=size)
