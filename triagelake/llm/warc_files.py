"""WARC archives whose records are compressed one by one with a dictionary that the archive carries.

Each task writes archives of its own (`*.warc.zst`). It holds the first `SAMPLE` bytes of an archive's records,
builds a Zstandard dictionary from them, writes the dictionary as a skippable frame in front, and then every record
as a frame of its own, so that a reader may start at any record. An archive ends at about `ARCHIVE` bytes. Files get
names of their own for each attempt of a task, below the shared folder, and only those named in the written list of
blocks count, so a task that is run again replaces its archives. The list has a row for each `BLOCK` bytes of
records, and archives are read in parallel by block.

Payloads that occur more than once are found from digests alone. The table of repeated payloads is stored; Spark
broadcasts it if it is small, else pages are joined to it by digest, and a digest that very many pages share is
split by Spark's handling of skewed joins.

Of equal payloads of at least `LEAST` bytes the one with the largest page_id is a response, the others are
revisits, which hold HTTP headers only. The reader checks each response's digest.

Edge cases: a null html is an empty payload. A null page_id is smaller than any other and is read back as null; if
all pages of a group have none, one is the response and `refers_to` is null. Of repeated rows with a group's largest
page_id one is the response, the others revisit it. A null url gives a record without a target; characters that may
not stand in a header are percent-encoded. Empty tables give no archives. Other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triagelake.llm.common import column_of, table
from triagelake.session import materialize, scratch_path

#: Payloads below this size are always archived whole.
LEAST = 1000
#: Bytes of records that an archive's dictionary is built from, and the dictionary's size.
SAMPLE, DICTIONARY = 4 << 20, 64 << 10
#: Bytes of an archive, about, and of the parts it is read in.
ARCHIVE, BLOCK = 256 << 20, 8 << 20
#: Bytes of archives that a reading task gets, about; fewer if there are not enough for all cores.
TASK = 128 << 20
#: Payload bytes in one batch of read records.
OUT_BYTES = 8 << 20
LEVEL = 3
#: Compressed bytes that a reader takes at a time.
STEP = 4 << 10
#: The frame type in which WARC readers look for a dictionary.
SKIPPABLE = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_types(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """The pages as archived: page_id, url, html, payload_digest, is_revisit, refers_to."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.sha1(html.cast("binary")).alias("payload_digest"), F.octet_length(html).alias("n_bytes"),
    )
    repeated = materialize(
        rows.where(F.col("n_bytes") >= least).groupBy("payload_digest", "page_id").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("payload_digest").agg(
            F.sum("n").alias("n"), F.max("page_id").alias("kept_id"),
            F.max_by("n", F.struct(F.col("page_id").isNotNull(), "page_id")).alias("n_kept"),
        ).where("n > 1").drop("n"),
        "repeated-payloads",
    )
    joined = rows.join(repeated, "payload_digest", "left")
    is_kept = F.col("page_id").eqNullSafe(F.col("kept_id"))
    tagged = joined.withColumn("is_revisit", F.col("n_kept").isNotNull() & ~is_kept)
    # Only repeated rows of a group's largest id need to be told apart.
    several = F.coalesce(F.col("n_kept") > 1, F.lit(False)) & is_kept
    names = ["page_id", "url", "html", "payload_digest", "is_revisit", "kept_id"]
    plain = tagged.where(~several).select(*names)
    if repeated.where("n_kept > 1").isEmpty():
        whole = plain
    else:
        place = F.row_number().over(Window.partitionBy("payload_digest").orderBy("url"))
        whole = plain.unionByName(tagged.where(several).withColumn("is_revisit", place > 1).select(*names))
    return whole.select(*names[:-1], F.when(F.col("is_revisit"), F.col("kept_id")).alias("refers_to"))


def header_value(text: str) -> str:
    """A header value on one line: white space and control characters are percent-encoded."""
    if text.isascii() and text.isprintable() and " " not in text:
        return text
    return "".join(x if x.isprintable() and x != " " else "".join(f"%{b:02X}" for b in x.encode()) for x in text)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, is_revisit: bool,
                refers_to: int | None, own_id: str) -> bytes:
    """One record: its header, and as block the HTTP headers, which tell the payload's size, and in a response the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {own_id}", f"WARC-Date: {DATE}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_value(url)}")
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if is_revisit:
        lines.append(f"WARC-Profile: {PROFILE}")
        lines.append(f"WARC-Refers-To: {record_id(refers_to, digest)}")
        if refers_to is not None:
            lines.append(f"Refers-To-Page-ID: {refers_to}")
    lines += [
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", "",
    ]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of a record; a response's payload must have the digest that its header tells."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    block = rest[:size]
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('WARC-Record-ID')} has not the length its header tells")
    http, _, payload = block.partition(b"\r\n\r\n")
    told = int(http.rpartition(b"Content-Length: ")[2])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    is_revisit = fields["WARC-Type"] == "revisit"
    if not is_revisit and (len(payload) != told or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields.get('WARC-Record-ID')} has not the payload its header tells")
    page_id, refers_to = (fields.get(x) for x in ("Page-ID", "Refers-To-Page-ID"))
    return {
        "page_id": None if page_id is None else int(page_id), "url": fields.get("WARC-Target-URI"),
        "payload_bytes": told, "payload_digest": digest, "record_type": fields["WARC-Type"],
        "refers_to": None if refers_to is None else int(refers_to), "payload": None if is_revisit else payload,
    }


def trained(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary for records like these; where they are too few to train one, their own bytes serve as such."""
    total = sum(map(len, samples))
    if len(samples) >= 16 and total >= 4 * 1024:
        try:
            return zstandard.train_dictionary(min(size, total // 4), samples, k=256, d=8, level=LEVEL).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:]


class ArchiveWriter:
    """One archive: records are held until there are enough for the dictionary, and then written one by one."""

    def __init__(self, system: fs.FileSystem, path: str, sample: int = SAMPLE, block: int = BLOCK):
        self.path, self.sample, self.block = path, sample, block
        self.file = system.open_output_stream(path, compression=None)
        self.held: list[bytes] = []
        self.held_size, self.at, self.begin, self.records = 0, 0, 0, 0
        self.compressor: zstandard.ZstdCompressor | None = None
        self.blocks: list[tuple[str, int, int, int]] = []

    def _write(self, data: bytes) -> None:
        self.file.write(data)
        self.at += len(data)

    def _start(self) -> None:
        raw = trained(self.held)
        self._write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
        self.begin = self.at
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw))
        held, self.held = self.held, []
        for record in held:
            self._record(record)

    def _record(self, record: bytes) -> None:
        self._write(self.compressor.compress(record))
        self.records += 1
        if self.at - self.begin >= self.block:
            self._cut()

    def _cut(self) -> None:
        if self.records:
            self.blocks.append((self.path, self.begin, self.at - self.begin, self.records))
        self.begin, self.records = self.at, 0

    def add(self, record: bytes) -> None:
        if self.compressor:
            self._record(record)
            return
        self.held.append(record)
        self.held_size += len(record)
        if self.held_size >= self.sample:
            self._start()

    def close(self) -> list[tuple[str, int, int, int]]:
        if not self.compressor:
            self._start()
        self._cut()
        self.file.close()
        return self.blocks


BLOCKS = "path string, start long, size long, records long"


def _archived(batches: Iterator[pa.RecordBatch], folder: str, archive: int) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    system, root = fs.FileSystem.from_uri(folder)
    writer, number, blocks = None, 0, []
    seen = 0
    for batch in batches:
        columns = [column_of(batch, x) for x in ("page_id", "url", "html", "payload_digest", "is_revisit", "refers_to")]
        for i in range(batch.num_rows):
            page_id, url, html, digest, is_revisit, refers_to = (x[i].as_py() for x in columns)
            if writer is None:
                name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{number:03d}.warc.zst"
                writer, number = ArchiveWriter(system, f"{root}/{name}"), number + 1
            seen += 1
            own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{folder}/{task.partitionId()}/{seen}')}>" if is_revisit else record_id(page_id, digest)
            writer.add(warc_record(page_id, url, html.encode(), digest, is_revisit, refers_to, own))
            if writer.at >= archive:
                blocks += writer.close()
                writer = None
    if writer:
        blocks += writer.close()
    columns = list(zip(*blocks, strict=True)) or [()] * 4
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.string()), *[pa.array(x, pa.int64()) for x in columns[1:]]],
        names=["path", "start", "size", "records"],
    )


def shared_uri(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, made, as a URI that tasks can open."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path)
    uri = system.makeQualified(path).toString()
    return uri if "://" in uri else uri.replace("file:", "file://", 1)


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, archive: int = ARCHIVE) -> DataFrame:
    """Write the pages as archives below `folder` (a URI); the result lists the blocks that the archives consist of."""
    tagged = record_types(pages, least)
    return materialize(tagged.mapInArrow(lambda b: _archived(b, folder, archive), BLOCKS), "archive-blocks")


def dictionary_of(file: pa.NativeFile) -> bytes:
    """The dictionary in the frame at the start of an archive."""
    kind, size = struct.unpack("<II", file.read(8))
    if kind != SKIPPABLE:
        raise ValueError("the archive has no dictionary in front")
    return file.read(size)


RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")
RECORD_TYPES = {
    "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
    "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(),
}


def records_of(file: pa.NativeFile, start: int, size: int, decompressor: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    """The records of the frames in a part of an archive."""
    file.seek(start)
    raw, at = memoryview(file.read(size)), 0
    while at < len(raw):
        # A frame's end shows only when it is read: small steps leave little behind it.
        reader, parts = decompressor.decompressobj(), []
        while not reader.eof:
            if at >= len(raw):
                raise ValueError("a record's frame is cut off")
            step = raw[at:at + STEP]
            parts.append(reader.decompress(step))
            at += len(step)
        at -= len(reader.unused_data)
        yield b"".join(parts)


def read_archives(spark: SparkSession, blocks: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """One row for each record of the listed blocks; they are dealt out to tasks by size."""
    names = [*RECORD_TYPES][: None if with_payload else -1]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        held: dict[str, list] = {x: [] for x in names}
        weight = 0

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(held[x], RECORD_TYPES[x]) for x in names], names=names)
            for x in names:
                held[x].clear()
            return got

        for batch in batches:
            for path, start, size, records in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                with system.open_input_file(path) as file:
                    dictionary = zstandard.ZstdCompressionDict(dictionary_of(file))
                    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
                    n = 0
                    for raw in records_of(file, start, size, decompressor):
                        record = parse_record(raw)
                        n += 1
                        for x in names:
                            held[x].append(record[x])
                        weight += 200 + len(raw) * with_payload
                        if weight >= OUT_BYTES:
                            yield out()
                            weight = 0
                if n != records:
                    raise ValueError(f"{path} has {n} records in a block of {records}")
        yield out()

    schema = RECORD + ", payload binary" * with_payload
    total = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = min(total[0], max(spark.sparkContext.defaultParallelism, -(-total[1] // TASK)))
    return blocks.select("path", "start", "size", "records").repartition(max(1, tasks)).mapInArrow(read, schema)


def op13_warc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, from the archives written."""
    folder = shared_uri(spark, "archives")
    blocks = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, blocks, folder)


OP13_SQL = f"""
WITH page AS (
    SELECT row_number() OVER () AS place, page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST, place) AS n,
        max(page_id) OVER (PARTITION BY payload_digest) AS kept_id
    FROM page
)
SELECT page_id::BIGINT AS page_id, url, payload_bytes::BIGINT AS payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= {LEAST} AND n > 1 THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= {LEAST} AND n > 1 THEN kept_id END::BIGINT AS refers_to
FROM ranked
"""
