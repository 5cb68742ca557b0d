"""The prefix trie of rebuilt conversations, its subtree totals by time-forward processing.

Turns become two 64-bit hashes; a prefix is known by the sum of its turns' hashes times odd powers by position,
so prefixes come from running sums, and a conversation that continues another's opening needs one factor. Running
sums are made in range partitions of (conversation, turn): a conversation may span many, and each partition takes
over one row from the one before. Prefixes are then grouped to nodes.

Subtree totals go up from the deepest level. A node with one member has nothing below it but a chain, so its totals
are known. Nodes with more than `heavy` members are the top of the tree: at most `MOST_HEAVY` of them, whatever the
input, since `heavy` grows with it. What hangs below them are the shards, of at most `heavy` conversations each.
In a shard Spark sorts the nodes by reverse level order (spilling), and each node sends its totals to its parent
through a priority queue in the same order, which spills sorted runs to the task's own temporary folder. The totals
of shard roots are then summed by their parent, and the same pass goes over the top of the tree.

Edge cases: rows without a conv_id belong to no conversation. Null roles and texts are empty. Turns with equal
numbers are ordered by a hash of role and text, so repeated rows are turns of their own, one after the other. A
conversation without own turns beyond its first h and without a base is turnless and ends at the root. Negative ids
use the remainder with the sign of the id. Empty tables give no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.llm.common import column_of, table
from triagelake.session import materialize

#: Conversations that share the opening of their first one, and the number of lengths an opening may have.
BASE, OPENINGS = 100, 6
#: Factors of the two running sums, odd, so that they have inverses.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(x, -1, 1 << 64) for x in FACTORS)
#: Nodes that are the top of the tree, at most; nodes with fewer members never are.
MOST_HEAVY, LEAST_HEAVY = 10_000, 64
#: Messages a queue holds in memory.
QUEUE = 200_000
#: Ids of a node's conversations that travel in one value.
IDS = 1 << 16

KEY = ["depth", "k1", "k2"]


def power(base: int, exponent: np.ndarray) -> np.ndarray:
    """base ** exponent modulo 2 ** 64."""
    e = exponent.astype(np.uint64)
    result, square = np.ones(len(e), dtype=np.uint64), np.uint64(base)
    with np.errstate(over="ignore"):
        while e.any():
            result = np.where(e & np.uint64(1), result * square, result)
            e, square = e >> np.uint64(1), square * square
    return result


def _unsigned(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return column_of(batch, name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and running sums (before and with the turn) of sorted turns, from the start of the partition."""
    pid = TaskContext.get().partitionId()
    conv, count, held = None, 0, [np.uint64(0), np.uint64(0)]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids = column_of(batch, "conv_id").to_numpy()
        first = np.concatenate(([conv is None or ids[0] != conv], ids[1:] != ids[:-1]))
        starts = np.flatnonzero(first)
        begin = np.zeros(n, dtype=np.int64)
        begin[starts] = starts
        begin = np.maximum.accumulate(begin)
        joined = 0 if first[0] else (int(starts[0]) if len(starts) else n)  # rows that go on with the last batch
        pos = np.arange(n) - begin + 1
        pos[:joined] += count
        out = [pa.array(np.full(n, pid), pa.int32()), pa.array(ids), pa.array(pos)]
        with np.errstate(over="ignore"):
            for i, factor in enumerate(FACTORS):
                term = _unsigned(batch, f"t{i + 1}") * power(factor, pos)
                total = np.cumsum(term, dtype=np.uint64)
                before = np.concatenate((np.zeros(1, np.uint64), total))[begin]
                own = total - before
                own[:joined] += held[i]
                held[i] = own[-1]
                out += [_signed(own), _signed(own - term)]
        conv, count = ids[-1], int(pos[-1])
        yield pa.RecordBatch.from_arrays([*out, column_of(batch, "n_chars")], names=RUNNING_NAMES)


RUNNING = "pid int, conv_id long, pos long, s1 long, q1 long, s2 long, q2 long, n_chars long"
RUNNING_NAMES = [x.split()[0] for x in RUNNING.split(", ")]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """Per turn: its place in its conversation and the running sums with and without it.

    What one range partition hands to the next is its last row; those, one for each partition, meet in the driver.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), role, text).alias("t2"),
        F.length(text).cast("long").alias("n_chars"), F.spark_partition_id().alias("part"),
    )
    order = ["conv_id", "turn", "t1", "t2", "part"]  # equal turns are told apart by where they were read
    stored = materialize(
        turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_running, RUNNING), "turns"
    )
    ends = stored.groupBy("pid").agg(F.max(F.struct("conv_id", "pos", "s1", "s2")).alias("e")).collect()
    carry: dict[int, tuple[int, int, int, int]] = {}
    held = None
    for row in sorted(ends, key=lambda r: r["pid"]):
        conv, pos, *sums = row["e"]
        if held:
            carry[row["pid"]] = held
            if held[0] == conv:
                sums = [
                    (a + pow(f, held[1], 1 << 64) * b) % (1 << 64)
                    for a, b, f in zip(held[2:], sums, FACTORS, strict=True)
                ]
                pos += held[1]
        held = (conv, pos, *[x % (1 << 64) for x in sums])

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pids, ids = column_of(batch, "pid").to_numpy(), column_of(batch, "conv_id").to_numpy()
            columns = {x: column_of(batch, x).to_numpy().copy() for x in RUNNING_NAMES}
            for pid in np.unique(pids).tolist():
                if pid not in carry:
                    continue
                conv, pos, *sums = carry[pid]
                at = np.flatnonzero((pids == pid) & (ids == conv))
                columns["pos"][at] += pos
                with np.errstate(over="ignore"):
                    for i, factor in enumerate(FACTORS):
                        shift = np.uint64(pow(factor, pos, 1 << 64))
                        for name in (f"s{i + 1}", f"q{i + 1}"):
                            moved = columns[name][at].view(np.uint64) * shift + np.uint64(sums[i])
                            columns[name][at] = moved.view(np.int64)
            yield pa.RecordBatch.from_pydict({x: pa.array(v) for x, v in columns.items()})

    return stored.mapInArrow(carried, RUNNING)


PATH = "conv_id long, depth long, k1 long, k2 long, p1 long, p2 long, n_chars long, is_end boolean"


def _own_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of the turns after the opening: the opening's sum, and their own, moved to their new depth."""
    for batch in batches:
        h, k = (column_of(batch, x).to_numpy() for x in ("h", "k"))
        pos = column_of(batch, "pos").to_numpy()
        keys = {}
        with np.errstate(over="ignore"):
            for i, inverse in enumerate(INVERSES, 1):
                shift, skipped = power(inverse, h - k), _unsigned(batch, f"skipped{i}")
                for to, name in ((f"k{i}", f"s{i}"), (f"p{i}", f"q{i}")):
                    keys[to] = _signed(_unsigned(batch, f"opening{i}") + shift * (_unsigned(batch, name) - skipped))
        yield pa.RecordBatch.from_pydict({
            "conv_id": column_of(batch, "conv_id"), "depth": pa.array(k + pos - h),
            "k1": keys["k1"], "k2": keys["k2"], "p1": keys["p1"], "p2": keys["p2"],
            "n_chars": column_of(batch, "n_chars"),
            "is_end": pa.array(pos == column_of(batch, "n").to_numpy()),
        })


def rebuilt(conversations: DataFrame, base: int = BASE, openings: int = OPENINGS) -> tuple[DataFrame, DataFrame]:
    """One row for each turn of each rebuilt conversation with its node and parent, and one for each conversation."""
    turns = numbered_turns(conversations)
    head = F.when(F.col("pos") < openings, F.struct("pos", "s1", "q1", "s2", "q2", "n_chars"))
    heads = materialize(
        turns.groupBy("conv_id").agg(F.max("pos").alias("n"), F.array_sort(F.collect_list(head)).alias("head")), "heads"
    )
    own = heads.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % openings)
    first = heads.select(
        F.col("conv_id").alias("first_id"), F.col("n").alias("first_n"), F.col("head").alias("first_head")
    )
    joined = own.join(first, F.col("conv_id") - F.col("conv_id") % base == F.col("first_id"), "left").withColumn(
        "k", F.least("h", F.coalesce("first_n", F.lit(0)))
    )

    def sum_at(head: str, place: str, name: str) -> F.Column:
        found = F.get(head, (F.col(place) - 1).cast("int"))
        return F.coalesce(F.when(F.col(place) > 0, found.getField(name)), F.lit(0).cast("long"))

    convs = materialize(joined.select(
        "conv_id", "n", "h", "k", F.slice("first_head", F.lit(1), F.col("k").cast("int")).alias("opening"),
        *[sum_at("first_head", "k", f"s{i}").alias(f"opening{i}") for i in (1, 2)],
        *[sum_at("head", "h", f"s{i}").alias(f"skipped{i}") for i in (1, 2)],
    ), "conversations")
    shared = convs.select("conv_id", "n", "h", "k", F.explode("opening").alias("t")).select(
        "conv_id", F.col("t.pos").alias("depth"), F.col("t.s1").alias("k1"), F.col("t.s2").alias("k2"),
        F.col("t.q1").alias("p1"), F.col("t.q2").alias("p2"), F.col("t.n_chars").alias("n_chars"),
        ((F.col("t.pos") == F.col("k")) & (F.col("n") <= F.col("h"))).alias("is_end"),
    )
    later = (
        turns.drop("pid").join(convs.where("n > h").drop("opening"), "conv_id").where("pos > h").mapInArrow(_own_turns, PATH)
    )
    return materialize(shared.unionByName(later), "paths"), convs


class SpillingQueue:
    """A priority queue of integer tuples that keeps at most `limit` in memory, the rest in sorted temporary files."""

    def __init__(self, width: int, limit: int = QUEUE, most_runs: int = 64):
        self.record, self.limit, self.most_runs = struct.Struct("<" + "q" * width), limit, most_runs
        self.heap: list[tuple[int, ...]] = []
        self.runs: list[tuple[tuple[int, ...], int, Iterator[tuple[int, ...]]]] = []
        self.made = 0

    def _read(self, file) -> Iterator[tuple[int, ...]]:
        file.seek(0)
        while block := file.read(self.record.size * 4096):
            yield from self.record.iter_unpack(block)
        file.close()

    def _write(self, entries: Iterator[tuple[int, ...]]) -> None:
        file = tempfile.TemporaryFile()
        block = bytearray()
        for entry in entries:
            block += self.record.pack(*entry)
            if len(block) >= 1 << 20:
                file.write(block)
                block.clear()
        file.write(block)
        run = self._read(file)
        self.made += 1
        heapq.heappush(self.runs, (next(run), self.made, run))

    def push(self, entry: tuple[int, ...]) -> None:
        if len(self.heap) >= self.limit:
            if len(self.runs) >= self.most_runs:
                merged, self.runs = self.runs, []
                self._write(heapq.merge(*[self._whole(first, run) for first, _, run in merged]))
            self._write(iter(sorted(self.heap)))
            self.heap = []
        heapq.heappush(self.heap, entry)

    @staticmethod
    def _whole(first: tuple[int, ...], run: Iterator[tuple[int, ...]]) -> Iterator[tuple[int, ...]]:
        yield first
        yield from run

    def top(self) -> tuple[int, ...] | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple[int, ...]:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            entry, number, run = self.runs[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, number, run))
            return entry
        return heapq.heappop(self.heap)


NODE = ("depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, n_chars long, n_children long, "
        "n_single long")
NODE_NAMES = [x.split()[0] for x in NODE.split(", ")]
FORWARD = NODE + ", is_top boolean, n_leaves long, saved_tokens long"


def _forward(batches: Iterator[pa.RecordBatch], limit: int = QUEUE) -> Iterator[pa.RecordBatch]:
    """Subtree totals of nodes sorted by reverse level order; `is_top` nodes send nothing.

    A node adds to its own share what has come in from other shards (`in_leaves`, `in_saved`), what its children
    with one member are worth, and the messages that wait for it, which are the first in the queue.
    """
    queue = SpillingQueue(5, limit)
    for batch in batches:
        all_leaves, all_saved = [], []
        columns = [column_of(batch, x).to_pylist() for x in (
            "depth", "k1", "k2", "p1", "p2", "n_convs", "n_chars", "n_children", "n_single", "is_top", "in_leaves", "in_saved",
        )]
        for depth, k1, k2, p1, p2, n, chars, children, single, is_top, leaves, saved in zip(*columns, strict=True):
            leaves += single if children else 1
            saved += (n - 1) * chars
            key = (-depth, k1, k2)
            while (waiting := queue.top()) is not None and waiting[:3] == key:
                got = queue.pop()
                leaves += got[3]
                saved += got[4]
            all_leaves.append(leaves)
            all_saved.append(saved)
            if not is_top:
                queue.push((1 - depth, p1, p2, leaves, saved))
        kept = [column_of(batch, x) for x in [*NODE_NAMES, "is_top"]]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(all_leaves, pa.int64()), pa.array(all_saved, pa.int64())],
            names=[*NODE_NAMES, "is_top", "n_leaves", "saved_tokens"],
        )


def _reverse_levels(nodes: DataFrame) -> DataFrame:
    return nodes.sortWithinPartitions(F.col("depth").desc(), "k1", "k2").mapInArrow(_forward, FORWARD)


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) rows to comma-joined ids: a hash for a node that lies within the partition, else pieces.

    Only a partition's first and last node may go on in another one.
    """
    key, ids, begun, first = None, [], None, True
    rows: list[tuple] = []

    def emit(whole: bool) -> None:
        text = ",".join(map(str, ids)).encode()
        rows.append((*key, begun, None if whole else text, hashlib.sha256(text).hexdigest() if whole else None))

    def out() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 6
        rows.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(columns, [pa.int64()] * 4 + [pa.binary(), pa.string()], strict=True)],
            names=[*KEY, "begun", "ids", "ends_sha256"],
        )

    pieces = 0
    for batch in batches:
        for depth, k1, k2, conv in zip(*[column_of(batch, x).to_pylist() for x in [*KEY, "conv_id"]], strict=True):
            if (depth, k1, k2) != key:
                if key is not None:
                    emit(not first and not pieces)
                    first = False
                key, ids, begun, pieces = (depth, k1, k2), [], conv, 0
            elif len(ids) >= IDS:
                emit(False)
                ids, begun, pieces = [], conv, pieces + 1
            ids.append(conv)
        if rows:
            yield out()
    if key is not None:
        emit(False)
        yield out()


def _hashed_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash over the pieces of each node, which come in order."""
    key, state = None, None
    done: list[tuple] = []
    for batch in batches:
        for *node, ids in zip(*[column_of(batch, x).to_pylist() for x in [*KEY, "ids"]], strict=True):
            if node != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256(ids)
            else:
                state.update(b"," + ids)
    if key is not None:
        done.append((*key, state.hexdigest()))
    columns = list(zip(*done, strict=True)) or [()] * 4
    yield pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(columns, [pa.int64()] * 3 + [pa.string()], strict=True)], names=[*KEY, "ends_sha256"],
    )


def ends_hashes(ends: DataFrame) -> DataFrame:
    """Per node: SHA-256 of the conversations that end there, ascending. A node with very many is read in pieces."""
    order = [*KEY, "conv_id"]
    joined = materialize(ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _joined_ids, "depth long, k1 long, k2 long, begun long, ids binary, ends_sha256 string"
    ), "ends")
    split = joined.where("ids IS NOT NULL").repartition(*KEY).sortWithinPartitions(*KEY, "begun").mapInArrow(
        _hashed_pieces, "depth long, k1 long, k2 long, ends_sha256 string"
    )
    return joined.where("ids IS NULL").select(*KEY, "ends_sha256").unionByName(split)


def prefix_trie(conversations: DataFrame, base: int = BASE, openings: int = OPENINGS) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    paths, convs = rebuilt(conversations, base, openings)
    zero = F.lit(0).cast("long")
    grouped = materialize(paths.groupBy(*KEY).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.max("n_chars").alias("n_chars"),
    ), "prefixes")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        *[zero.alias(x) for x in [*KEY, "p1", "p2"]], "conv_id", "n_convs", zero.alias("n_chars"),
    )
    single = F.when(F.col("n_convs") == 1, 1).otherwise(0).cast("long")
    as_child = grouped.select(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"),
        *[F.lit(None).cast("long").alias(x) for x in ("p1", "p2", "conv_id", "n_convs", "n_chars")],
        F.lit(1).cast("long").alias("n_children"), single.alias("n_single"),
    )
    as_node = grouped.unionByName(root).withColumns({"n_children": zero, "n_single": zero})
    nodes = materialize(as_node.unionByName(as_child).groupBy(*KEY).agg(
        *[F.max(x).alias(x) for x in ("p1", "p2", "conv_id", "n_convs", "n_chars")],
        *[F.sum(x).alias(x) for x in ("n_children", "n_single")],
    ), "nodes")

    def bound(rows: int) -> int:
        return max(LEAST_HEAVY, -(-rows // MOST_HEAVY))

    heavy_above = bound(paths.count())
    is_heavy = (F.col("n_convs") > heavy_above) | (F.col("depth") == 0)
    heavy = nodes.where(is_heavy)
    shard = paths.join(F.broadcast(heavy.select(*KEY)), KEY, "left_anti").groupBy("conv_id").agg(
        F.min(F.struct(*KEY)).alias("shard")
    )
    inside = {"in_leaves": zero, "in_saved": zero}
    light = materialize(_reverse_levels(
        nodes.where(~is_heavy & (F.col("n_convs") > 1)).join(shard, "conv_id")
        .withColumns({"is_top": F.col("depth") == F.col("shard.depth"), "s1": F.col("shard.k1"), "s2": F.col("shard.k2"), **inside})
        .drop("shard").repartition("s1", "s2")
    ), "shards")
    sent = light.where("is_top").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.sum("n_leaves").alias("in_leaves"), F.sum("saved_tokens").alias("in_saved")
    )
    top = _reverse_levels(
        heavy.join(sent, KEY, "left").fillna(0, ["in_leaves", "in_saved"]).withColumn("is_top", F.col("depth") == 0).coalesce(1)
    )
    alone = nodes.where(~is_heavy & (F.col("n_convs") == 1)).withColumns(
        {"n_leaves": F.lit(1).cast("long"), "saved_tokens": zero}
    )
    names = [*NODE_NAMES, "n_leaves", "saved_tokens"]
    totals = light.select(*names).unionByName(top.select(*names)).unionByName(alone.select(*names))

    # Parents with very many children are few, whatever the input: they are looked up, the others joined.
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"), "n_children",
    )
    many = F.col("n_children") > bound(nodes.count())
    wide = F.broadcast(parents.where(many | (F.col("depth") == 1)).drop("n_children"))
    up = ["depth", "p1", "p2"]
    below_root = totals.where("depth > 0")
    with_parent = (
        totals.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
        .unionByName(below_root.join(wide, up))
        .unionByName(below_root.join(wide, up, "left_anti").join(parents.where(~many).drop("n_children"), up))
    )
    at_root = convs.where("k = 0 AND n <= h").select(*[zero.alias(x) for x in KEY], "conv_id")
    ends = paths.where("is_end").select(*KEY, "conv_id").unionByName(at_root)
    return with_parent.join(ends_hashes(ends), KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def _crc32_sql(text: str) -> str:
    step = "xor(c >> 1, (c & 1) * 3988292384)"
    for _ in range(7):
        step = f"list_transform([{step}], lambda c: xor(c >> 1, (c & 1) * 3988292384))[1]"
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), "
        f"lambda a, b: list_transform([xor(a, b)], lambda c: {step})[1]), 4294967295)"
    )


OP11_SQL = f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, {_crc32_sql("conv_id::VARCHAR")} % {OPENINGS} AS h, conv_id - conv_id % {BASE} AS base
    FROM (SELECT DISTINCT conv_id FROM turns)
), whole AS (
    SELECT c.conv_id, t.pos, 0 AS part, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
    UNION ALL
    SELECT c.conv_id, t.pos, 1 AS part, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
), placed AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, role, text FROM whole
), paths AS (
    SELECT conv_id, depth, length(text) AS n_chars,
        list({{'role': role, 'text': text}}) OVER (PARTITION BY conv_id ORDER BY depth) AS path,
        depth = max(depth) OVER (PARTITION BY conv_id) AS is_end
    FROM placed
    UNION ALL
    SELECT conv_id, 0, 0, [], conv_id NOT IN (SELECT conv_id FROM placed) FROM convs
), nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_chars) AS n_chars,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
    FROM paths GROUP BY path, depth
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1
        AND c.path[:-2] = n.path) AS n_children
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[:-2]
), member AS (
    SELECT p.conv_id AS member, p.depth, n.conv_id FROM paths p JOIN nodes n USING (path, depth)
)
SELECT a.conv_id::BIGINT AS conv_id, a.depth::BIGINT AS depth, any_value(a.parent_conv_id)::BIGINT AS parent_conv_id,
    any_value(a.n_convs)::BIGINT AS n_convs, any_value(a.n_children)::BIGINT AS n_children,
    count(*) FILTER (d.n_children = 0)::BIGINT AS n_leaves,
    sum((d.n_convs - 1) * d.n_chars)::BIGINT AS saved_tokens, any_value(a.ends_sha256) AS ends_sha256
FROM linked a JOIN linked d ON d.depth >= a.depth
    AND EXISTS (SELECT 1 FROM member m WHERE m.member = d.conv_id AND m.depth = a.depth AND m.conv_id = a.conv_id)
GROUP BY a.conv_id, a.depth
"""
