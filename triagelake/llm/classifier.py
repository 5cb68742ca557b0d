"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Each passage is encoded as h = tanh(W [x, e] + b): x are measures of its
characters and words, e is the mean of learnt embeddings of its words and of their first and last three bytes, looked
up by hash, so parts of a word count where the word itself is new. Gated attention a = softmax(w . (tanh(V h) *
sigmoid(U h))) weighs the passages, and the score is sigmoid(u . sum(a h) + c). All parameters, embeddings too, are
learnt together from document labels alone.

Training reads a bounded sample of labelled documents, encoded by tasks and fitted on the driver; the bound is
`most_documents`, with all their passages. Scoring reads every passage of every document.

Edge cases: null texts count as empty; a text without words is one passage of zeros, so it has a score too. Null
labels and labels of unknown documents are not used; several labels of one document count as their mean, and
documents with a mean of 0.5 or more as good. Without labels, or with one kind only, every score is the share of
good labels (0.5 without any). Repeated rows have equal scores; an empty table gives no rows. Only id and text
are read from documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.llm.common import BLOCK, column_of, mixed, table, utf8, word_hashes

PASSAGE = 64
THRESHOLD = 0.3
MOST_DOCUMENTS = 6_000
HIDDEN, GATE = 24, 12
#: Rows and columns of the embeddings; each word looks up itself, its beginning and its end.
ROW_BITS, DIM, LOOKUPS = 13, 8, 3

#: Kinds of bytes that are counted: their shares are the first measures of a passage.
KINDS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",", b"!?", b":;", b"|", b"#",
         b"*", b"$", b"%", b"&", b"<>", b"'\"", b"()[]{}", b"-_/\\@+=~^`", bytes(range(128, 256))]
N_KINDS = len(KINDS)
MEASURES = N_KINDS + 5


def _kinds() -> np.ndarray:
    kind = np.full(256, N_KINDS, dtype=np.int64)  # control characters and white space
    for k, some in enumerate(KINDS):
        kind[np.frombuffer(some, dtype=np.uint8)] = k
    return kind


KIND = _kinds()
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _cuts(raw: np.ndarray) -> Iterator[np.ndarray]:
    """The bytes in pieces of bounded size that end between words."""
    at = 0
    while at < len(raw):
        end = min(at + BLOCK, len(raw))
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end


@dataclass
class Bag:
    """Passages: measures of each, its number of words, and the embedding rows of all words in order."""

    x: np.ndarray
    words: np.ndarray
    rows: np.ndarray


def _pieces_of_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """The first and the last three bytes of each word as numbers, A-Z and a-z alike."""
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint64)
    for kind, at, step in ((1, starts, 1), (2, ends, -1)):
        code = np.full(len(starts), kind, dtype=np.uint64)
        for k in range(3):
            place = at + step * k
            inside = (place >= starts) & (place <= ends)
            code = (code << np.uint64(8)) | np.where(inside, low[np.where(inside, place, at)], 0).astype(np.uint64)
        yield mixed(code)


def _measured(raw: np.ndarray) -> Bag:
    """Measures and embedding rows of each passage of a piece of text."""
    space = _SPACE[raw]
    starts = ~space & np.concatenate(([True], space[:-1]))
    n_words = int(starts.sum())
    if not n_words:
        return Bag(*_NO_PASSAGES)
    n = -(-n_words // PASSAGE)
    word = np.cumsum(starts) - 1
    inside = ~space
    passage = word[inside] // PASSAGE
    counts = np.bincount(passage * (N_KINDS + 1) + KIND[raw[inside]], minlength=n * (N_KINDS + 1)).reshape(n, -1)
    size = np.maximum(1, counts.sum(1))
    words = np.full(n, PASSAGE)
    words[-1] = n_words - (n - 1) * PASSAGE
    hashes = word_hashes(raw)
    of = np.arange(n_words) // PASSAGE
    order = np.lexsort((hashes, of))
    same = (np.diff(hashes[order].view(np.int64)) == 0) & (np.diff(of[order]) == 0)
    repeated = np.bincount(of[order][1:][same], minlength=n)
    follows = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    upper_start = np.bincount(passage, weights=(starts[inside] & (KIND[raw[inside]] == 1)), minlength=n)
    out = np.empty((n, MEASURES), dtype=np.float32)
    out[:, :N_KINDS] = counts[:, :N_KINDS] / size[:, None]
    out[:, N_KINDS] = np.minimum(size / words / 10, 3)
    out[:, N_KINDS + 1] = words / PASSAGE
    out[:, N_KINDS + 2] = repeated / words
    out[:, N_KINDS + 3] = np.bincount(of[1:][follows], minlength=n) / words
    out[:, N_KINDS + 4] = upper_start / words
    ends = np.flatnonzero(inside & np.concatenate((space[1:], [True])))
    looked_up = (hashes, *_pieces_of_words(raw, np.flatnonzero(starts), ends))
    rows = np.stack([(h >> np.uint64(64 - ROW_BITS)).astype(np.uint16) for h in looked_up], axis=1)
    return Bag(out, words.astype(np.int32), rows)


_NO_PASSAGES = (np.empty((0, MEASURES), dtype=np.float32), np.empty(0, dtype=np.int32), np.empty((0, LOOKUPS), dtype=np.uint16))


def passages(raw: np.ndarray) -> Bag:
    """All passages of a text; an empty text is one passage of zeros without words."""
    parts = [x for x in map(_measured, _cuts(raw)) if len(x.x)]
    if not parts:
        return Bag(np.zeros((1, MEASURES), dtype=np.float32), np.zeros(1, dtype=np.int32), _NO_PASSAGES[2])
    return Bag(*(np.concatenate([getattr(x, name) for x in parts]) for name in ("x", "words", "rows")))


def _embedded(table_: np.ndarray, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The mean embedding of each passage; zeros without words."""
    out = np.zeros((len(words), DIM))
    some = words > 0
    if len(rows):
        each = sum(table_[rows[:, k]] for k in range(LOOKUPS))
        firsts = (np.cumsum(words) - words)[some]
        out[some] = np.add.reduceat(each, firsts) / (LOOKUPS * words[some, None])
    return out


def _to_embeddings(de: np.ndarray, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The gradient of the embeddings, given that of each passage's mean."""
    share = de / (LOOKUPS * np.maximum(words, 1)[:, None])
    of = np.repeat(np.arange(len(words)), words)
    out = np.empty((1 << ROW_BITS, DIM))
    at = rows.reshape(-1)
    for k in range(DIM):
        out[:, k] = np.bincount(at, weights=np.repeat(share[of, k], LOOKUPS), minlength=1 << ROW_BITS)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """The learnt parameters; `constant` replaces them where there is nothing to learn."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def score(self, bag: Bag) -> float:
        if self.constant is not None:
            return self.constant
        x = _inputs(self.weights, self.mean, self.scale, bag)
        return float(_forward(self.weights, x, np.array([0]), np.zeros(len(x), dtype=int))[0][0])


def _inputs(p: dict[str, np.ndarray], mean: np.ndarray, scale: np.ndarray, bag: Bag) -> np.ndarray:
    """[x, e] of each passage."""
    return np.hstack(((bag.x - mean) / scale, _embedded(p["E"], bag.words, bag.rows)))


def _forward(p: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, of: np.ndarray) -> tuple:
    """Scores of the bags whose passages are stacked in x; `of` is each passage's bag, `starts` each bag's first."""
    h = np.tanh(x @ p["W"] + p["b"])
    t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * s) @ p["w"]
    e = np.exp(e - np.maximum.reduceat(e, starts)[of])
    a = e / np.add.reduceat(e, starts)[of]
    z = np.add.reduceat(a[:, None] * h, starts)
    return _sigmoid(z @ p["u"] + p["c"]), h, t, s, a, z


def _gradients(p: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, of: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """The gradients of the parameters, and of the inputs as "x"."""
    score, h, t, s, a, z = _forward(p, x, starts, of)
    d = (score - y) / len(y)
    dz = d[:, None] * p["u"]
    along = (dz[of] * h).sum(1)
    de = a * (along - np.add.reduceat(a * along, starts)[of])
    dts = de[:, None] * p["w"]
    dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
    dh = (a[:, None] * dz[of] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
    return {
        "u": z.T @ d, "c": np.array([d.sum()]), "w": (t * s).T @ de, "V": h.T @ dt, "U": h.T @ ds, "W": x.T @ dh, "b": dh.sum(0),
        "x": dh @ p["W"].T,
    }


def fit(bags: list[Bag], labels: np.ndarray, epochs: int = 20, batch: int = 128, rate: float = 0.01, decay: float = 1e-4) -> Model:
    """Adam on the cross-entropy of whole documents; fixed seed."""
    if len(bags) == 0 or len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return Model(np.zeros(MEASURES), np.ones(MEASURES), {}, share)
    stacked = np.concatenate([bag.x for bag in bags])
    mean, scale = stacked.mean(0), stacked.std(0) + 0.01
    draw = np.random.default_rng(7)
    p = {
        "W": draw.normal(0, 0.3, (MEASURES + DIM, HIDDEN)), "b": np.zeros(HIDDEN), "V": draw.normal(0, 0.3, (HIDDEN, GATE)),
        "U": draw.normal(0, 0.3, (HIDDEN, GATE)), "w": draw.normal(0, 0.3, GATE), "u": draw.normal(0, 0.3, HIDDEN), "c": np.zeros(1), "E": np.zeros((1 << ROW_BITS, DIM)),
    }
    first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for _ in range(epochs):
        order = draw.permutation(len(bags))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            sizes = np.array([len(bags[i].x) for i in some])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            whole = Bag(*(np.concatenate([getattr(bags[i], name) for i in some]) for name in ("x", "words", "rows")))
            found = _gradients(p, _inputs(p, mean, scale, whole), starts, np.repeat(np.arange(len(some)), sizes), labels[some])
            found["E"] = _to_embeddings(found.pop("x")[:, MEASURES:], whole.words, whole.rows)
            step += 1
            for k, g in found.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = p[k] * (1 - rate * decay) - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, {**p, "E": p["E"].astype(np.float32)})


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo 5; such labels are never learnt."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, most_documents: int = MOST_DOCUMENTS, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> Model:
    """A model from the labels that are not held out; of more than `most_documents`, those with the smallest id hash."""
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(quality).alias("quality")).where(
        "doc_id is not null and quality is not null"
    ).where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_documents)
    # The sample's rows are bounded, so it may be broadcast: labelled texts are met where they are read.
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), "doc_id")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [passages(raw) for raw in utf8(column_of(batch, "text"))]
            parts = [pa.array([np.ascontiguousarray(getattr(bag, name)).tobytes() for bag in bags], pa.binary()) for name in ("x", "words", "rows")]
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), column_of(batch, "quality"), *parts], names=["doc_id", "quality", "x", "words", "rows"]
            )

    found = rows.select("doc_id", "quality", "text").mapInArrow(
        encode, "doc_id long, quality double, x binary, words binary, rows binary"
    ).dropDuplicates(["doc_id"])
    got = sorted(found.limit(most_documents).collect())
    bags = [
        Bag(np.frombuffer(r["x"], dtype=np.float32).reshape(-1, MEASURES), np.frombuffer(r["words"], dtype=np.int32),
            np.frombuffer(r["rows"], dtype=np.uint16).reshape(-1, LOOKUPS)) for r in got
    ]
    return fit(bags, np.array([float(r["quality"] >= 0.5) for r in got]))


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """Add score and predicted to each row; a model of a few hundred kilobytes goes along with the tasks."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    carried = docs.select(*kept)
    schema = docs.select(*kept).schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(passages(raw)) for raw in utf8(column_of(batch, text))], dtype=float)
            yield pa.RecordBatch.from_arrays(
                [*(column_of(batch, c) for c in kept), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=[*kept, "score", "predicted"],
            )

    return carried.mapInArrow(run, schema)


def good_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The documents with a predicted label of 1, with their own columns, whatever these are called."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(passages(raw)) for raw in utf8(column_of(batch, "text"))], dtype=float)
            keep = pa.array(scores >= threshold, pa.bool_())
            yield pa.RecordBatch.from_arrays([column_of(batch, "own").filter(keep)], names=["own"])

    carried = docs.select(F.struct(*docs.columns).alias("own"), F.col(text).alias("text"))
    return carried.mapInArrow(run, carried.select("own").schema).select("own.*")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model that learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return scores_only(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def scores_only(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of documents with just doc_id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(passages(raw)) for raw in utf8(column_of(batch, "text"))], dtype=float)
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")
