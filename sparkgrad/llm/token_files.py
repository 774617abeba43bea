"""Token ids as files of length-delimited binary records with an offset index.

A record is framed as: length (8 bytes), masked CRC-32C of these 8 bytes, payload, masked CRC-32C of the payload; numbers are
little-endian. That is the framing of TFRecord files, so their readers can walk through ours. The payload is a 16-byte
head (key, whether there is one, bytes per id) and the ids. Next to ``x.records`` lies ``x.index``: the
offset of each record and of the end, 8 bytes each, so that any record can be fetched by its number.

Writing: rows are range-partitioned by (key, text hash, input row), so that a key of any frequency spans several tasks, and each task
writes its rows in order to files of about ``FILE_BYTES``. File names are fresh for each attempt of a task, and only
the attempts that succeed have rows in the list of files (a table written by Spark): a lost executor leaves files that nobody reads.
Reading: a task per file; every length and payload is checked against its checksum, and a damaged or cut record is an error.

The folder has to be one that executors reach through Arrow's file systems (local or mounted, hdfs, s3, gs, abfs).

Defined results: a NULL or empty text is the end id alone; rows with a NULL key come first; rows that share a key are in the order
of their texts' hashes; repeated rows are written as often as they occur; an empty table has no files and reads as an empty result; further
columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkgrad.llm import byte_bpe
from sparkgrad.llm.crc32c import crc32c, masked
from sparkgrad.llm.slices import SLICE_BYTES, by_bytes
from sparkgrad.llm.text import read
from sparkgrad.session import materialize, scratch_path

END_ID = 2
FILE_BYTES = 64 << 20
ENCODE_BYTES = 4 << 20  # texts encoded at once; a word that repeats among them is looked up once
CACHE_ENTRIES = 500_000  # of the encoder; rare words come back in later slices
LOT = 256
HEAD, HEAD_BYTES = "<q?B6x", 16
FRAME = 12  # length and its checksum
FILES = "part int, seq int, path string, records long, ids long, bytes long"


def frames(payloads: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The framed records, and the size of each."""
    sizes = np.array([len(p) for p in payloads], np.uint64)
    lengths = sizes.view(np.uint8)
    n = np.arange(len(payloads))
    heads = masked(crc32c(lengths, n * 8, n * 8 + 8))
    ends = np.cumsum(sizes.astype(np.int64))
    tails = masked(crc32c(np.frombuffer(b"".join(payloads), np.uint8), ends - sizes.astype(np.int64), ends))
    framed = b"".join([part for size, head, payload, tail in zip(sizes, heads, payloads, tails)
                       for part in (size.tobytes(), head.tobytes(), payload, tail.tobytes())])
    return framed, sizes.astype(np.int64) + FRAME + 4


def unframed(data: bytes, starts: np.ndarray, ends: np.ndarray, path: str) -> list[bytes]:
    """Payloads of the records at data[starts[i]:ends[i]], all checked."""
    raw = np.frombuffer(data, np.uint8)
    if len(starts) and (int(ends[-1]) > len(raw) or (ends - starts < FRAME + 4 + HEAD_BYTES).any()):
        raise ValueError(f"{path}: a record is cut off")
    number = lambda at, kind, width: raw[at[:, None] + np.arange(width)].copy().view(kind).ravel()
    fine = (number(starts, "<u8", 8).astype(np.int64) == ends - starts - FRAME - 4) & (
        number(starts + 8, "<u4", 4) == masked(crc32c(raw, starts, starts + 8))) & (
        number(ends - 4, "<u4", 4) == masked(crc32c(raw, starts + FRAME, ends - 4)))
    if not fine.all():
        raise ValueError(f"{path}: record {int(np.argmin(fine))} of a stretch is damaged")
    return [data[a + FRAME:b - 4] for a, b in zip(starts.tolist(), ends.tolist())]


def payload(key: int | None, ids: bytes, width: int) -> bytes:
    return struct.pack(HEAD, key or 0, key is not None, width) + ids


def opened(found: bytes) -> tuple[int | None, bytes]:
    """Key, and ids as unsigned 32-bit integers."""
    key, there, width = struct.unpack_from(HEAD, found)
    ids = found[HEAD_BYTES:]
    return key if there else None, ids if width == 4 else np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()


class RecordWriter:
    """Files of one task, closed when they are full."""

    def __init__(self, folder: str, part: int, file_bytes: int):
        self.system, self.folder = fs.FileSystem.from_uri(folder)
        self.uri, self.part, self.limit = folder, part, file_bytes
        self.out, self.closed = None, []

    def add(self, payloads: list[bytes], ids: int) -> None:
        if self.out is None:
            self.name = f"{self.part:06d}-{len(self.closed):04d}-{uuid.uuid4().hex}"
            self.system.create_dir(self.folder, recursive=True)
            self.out, self.sizes, self.ids = self.system.open_output_stream(f"{self.folder}/{self.name}.records"), [], 0
            self.bytes = 0
        framed, sizes = frames(payloads)
        self.out.write(framed)
        self.sizes.append(sizes)
        self.ids += ids
        self.bytes += len(framed)
        if self.bytes >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(self.sizes))]).astype("<u8")
        with self.system.open_output_stream(f"{self.folder}/{self.name}.index") as index:
            index.write(offsets.tobytes())
        self.closed.append((self.part, len(self.closed), f"{self.uri}/{self.name}", len(offsets) - 1, self.ids, self.bytes))
        self.out = None


class RecordReader:
    def __init__(self, path: str):
        self.path = path
        self.system, inner = fs.FileSystem.from_uri(path)
        with self.system.open_input_stream(f"{inner}.index") as index:
            self.offsets = np.frombuffer(index.read(), "<u8").astype(np.int64)
        self.file = self.system.open_input_file(f"{inner}.records")

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()

    def __len__(self):
        return len(self.offsets) - 1

    def stretch(self, first: int, last: int) -> list[bytes]:
        """Payloads of the records first..last-1, read in one go."""
        at = self.offsets[first:last + 1]
        self.file.seek(int(at[0]))
        return unframed(self.file.read(int(at[-1] - at[0])), at[:-1] - at[0], at[1:] - at[0], self.path)

    def in_order(self) -> Iterator[list[bytes]]:
        first = 0
        while first < len(self):
            last = max(first + 1, int(np.searchsorted(self.offsets, self.offsets[first] + SLICE_BYTES, "right")) - 1)
            yield self.stretch(first, last)
            first = last


def write(docs: DataFrame, path: str, folder: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID,
          file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the ids of all texts below ``folder``; returns the list of files. ``path``: vocabulary file on the driver."""
    held = docs.sparkSession.sparkContext.broadcast(byte_bpe.file_text(path))
    t = F.col(text).cast("string")
    rows = docs.select(F.col(key).cast("long").alias("key"), t.alias("t"), F.xxhash64(t).alias("tie"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("key").asc_nulls_first(), "tie", "row"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe.encoder(held.value, entries=CACHE_ENTRIES)
        width = encoder.kind.itemsize
        end = np.array([end_id], encoder.kind).tobytes()
        writer = RecordWriter(folder, TaskContext.get().partitionId(), file_bytes)
        for batch in batches:
            for part in by_bytes(batch, 1, min(ENCODE_BYTES, file_bytes)):
                ids = [found + end for found in encoder.encode(part.column(1))]
                writer.add([payload(k, i, width) for k, i in zip(part.column(0).to_pylist(), ids)], sum(map(len, ids)) // width)
        writer.close()
        if writer.closed:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*writer.closed), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                ["part", "seq", "path", "records", "ids", "bytes"])

    return materialize(dealt.mapInArrow(run, FILES), "token-files")


def _rows(found: list[tuple[int | None, bytes]], start: int) -> tuple[pa.RecordBatch, int]:
    sizes = np.array([len(ids) // 4 for _, ids in found], np.int64)
    ends = start + np.cumsum(sizes)
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), pa.array(ends - sizes, pa.int64()),
                                        pa.array([i for _, i in found], pa.binary())], ["key", "start", "ids"])
    return batch, int(ends[-1]) if len(ends) else start


def sequences(files: DataFrame) -> DataFrame:
    """(key, start, ids) per record in the order of the files; start counts the ids before it, ids are unsigned 32-bit integers."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = files.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    n = max(1, files.count())
    spread = placed.repartitionByRange(n, "start", "path")  # a task per file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*[c.to_pylist() for c in batch.columns]):
                with RecordReader(path) as reader:
                    for stretch in reader.in_order():
                        out, start = _rows([opened(p) for p in stretch], start)
                        yield out

    return spread.mapInArrow(run, "key long, start long, ids binary")


def shuffled(files: DataFrame, seed: int, lot: int = LOT, tasks: int | None = None) -> DataFrame:
    """(key, ids) of all records in an order drawn from ``seed``, for one pass of training.

    Lots of ``lot`` neighbouring records are dealt out in random order; a task fetches a lot's records one by one through the
    index, again in random order. The same seed gives the same order.
    """
    lots = files.select("path", "records", F.explode(F.sequence(F.lit(0), F.floor((F.col("records") - 1) / lot).cast("int"))).alias("lot"))
    drawn = lots.withColumn("draw", F.xxhash64("path", "lot", F.lit(seed)))
    order = ["draw", "path", "lot"]
    dealt = (drawn.repartitionByRange(tasks, *order) if tasks else drawn.repartitionByRange(*order)).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, records, k, draw in zip(*[batch.column(c).to_pylist() for c in ("path", "records", "lot", "draw")]):
                some = np.arange(k * lot, min((k + 1) * lot, records))
                np.random.default_rng(draw & (1 << 63) - 1).shuffle(some)
                with RecordReader(path) as reader:
                    for i in some.tolist():
                        key, ids = opened(reader.stretch(i, i + 1)[0])
                        yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([ids], pa.binary())], ["key", "ids"])

    return dealt.mapInArrow(run, "key long, ids binary")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write(read(spark, sf_dir, "documents"), byte_bpe.vocabulary_path(), scratch_path(spark, "token-records"))
    return sequences(files).select(F.col("key").alias("doc_id"), "start", F.expr("CAST(octet_length(ids) / 4 AS BIGINT)").alias("n_tokens"),
                                   F.crc32("ids").alias("ids_crc32"))
