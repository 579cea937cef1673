"""Operator 7: token ids as length-delimited binary records with a separate offset index.

A record is one document's ids: ``length (8 bytes) | masked CRC-32 of those 8 bytes | payload | masked CRC-32 of the payload``,
all little-endian; a payload is the doc_id (8 bytes), a flag byte (1: doc_id is null) and the ids, 2 bytes each
where the vocabulary allows it and else 4. The mask rotates the checksum and adds a constant, so a checksum stored
inside a payload does not check itself. (The framing is that of the common record files for training input; their
CRC-32C is not in Python's standard library, so zlib's CRC-32 takes its place.) The index of a shard is a file of
8-byte offsets, one per record and one for the end: readers can pick records in any order without scanning.

Documents are range-partitioned by doc_id (rows of one doc_id by a hash of the text, so a doc_id that many rows share is split) and sorted; each task writes its shards of at most ``SHARD_BYTES`` under fresh
names, and the table of shards that Spark commits names the files that count. A task that is run again leaves files
that nothing names. Files are written and read through pyarrow's file systems, at the shared folder of the session.

Defined results: a null or empty text has the end token alone; rows that share a doc_id follow by that hash, then text; null ids come first;
an empty table gives no shard and an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayflow.llm import _store, _text, _tokens
from stayflow.session import shared_dir

SHARD_BYTES, READ_BYTES = 64 << 20, 4 << 20
MASK_DELTA = 0xA282EAD8  # fixed value of the record format
SHARDS = "part int, nth int, path string, index_path string, n_records long, n_tokens long, width int"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload))


def unframe(data: bytes, at: int = 0) -> tuple[bytes, int]:
    """(payload of the record at this offset, offset of the next); raises if a checksum does not hold."""
    head = data[at : at + 8]
    (length,) = struct.unpack("<Q", head)
    (crc,) = struct.unpack_from("<I", data, at + 8)
    if crc != masked(head):
        raise ValueError(f"record length at {at} is damaged")
    payload = data[at + 12 : at + 12 + length]
    (crc,) = struct.unpack_from("<I", data, at + 12 + length)
    if crc != masked(payload):
        raise ValueError(f"record at {at} is damaged")
    return payload, at + 16 + length


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _writer(folder: str, tokenizer: str, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tokens.WordEncoder.of(tokenizer)
        width = 2 if encoder.vocabulary <= 1 << 16 else 4
        fs, base = file_system(folder)
        part, nth = TaskContext.get().partitionId(), 0
        offsets, n_tokens, stream, path = [0], 0, None, ""

        def close() -> pa.RecordBatch:
            nonlocal nth, offsets, n_tokens, stream
            stream.close()
            with fs.open_output_stream(path + ".index") as index:
                index.write(np.array(offsets, "<u8").tobytes())
            row = {"part": part, "nth": nth, "path": path, "index_path": path + ".index", "n_records": len(offsets) - 1,
                   "n_tokens": n_tokens, "width": width}
            nth, offsets, n_tokens, stream = nth + 1, [0], 0, None
            return pa.RecordBatch.from_pylist([row], schema=SHARDS_ARROW)

        for block, texts in _text.blocks(batches, limit=_tokens.BLOCK_BYTES, keep=True):
            ids = encoder.encode(texts)
            for doc, own in zip(block.column(0).to_pylist(), ids):
                if stream is None:
                    path = f"{base}/part-{part:06d}-{nth:04d}-{uuid.uuid4().hex}.records"
                    stream = fs.open_output_stream(path)
                tokens = np.frombuffer(own + _tokens.END, "<u4").astype(f"<u{width}")
                record = frame(struct.pack("<qB", doc or 0, doc is None) + tokens.tobytes())
                stream.write(record)
                offsets.append(offsets[-1] + len(record))
                n_tokens += len(tokens)
                if offsets[-1] >= shard_bytes:
                    yield close()
        if stream is not None:
            yield close()
    return run


SHARDS_ARROW = pa.schema([("part", pa.int32()), ("nth", pa.int32()), ("path", pa.string()), ("index_path", pa.string()),
                          ("n_records", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32())])


def write_records(docs: DataFrame, tokenizer: str | None = None, folder: str | None = None,
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write all documents in ascending doc_id order; returns the committed table of shards."""
    folder = folder or shared_dir(docs.sparkSession, "llm", f"records-{uuid.uuid4().hex}")
    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .withColumn("by", F.xxhash64("text")).repartitionByRange("doc_id", "by").sortWithinPartitions("doc_id", "by", "text").select("doc_id", "text"))
    return _store.land(ordered.mapInArrow(_writer(folder, tokenizer or _tokens.default_tokenizer(), shard_bytes), SHARDS), "shards")


def _in_runs(f, offsets: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Where each record lies in the run of bytes read with it: one read for several megabytes of records."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(int(np.searchsorted(offsets, offsets[first] + READ_BYTES, "right")) - 1, first + 1)
        base = int(offsets[first])
        run = f.read_at(int(offsets[last]) - base, base)
        for lo, hi in zip((offsets[first:last] - base).tolist(), (offsets[first + 1 : last + 1] - base).tolist()):
            yield lo, hi, run
        first = last


def read_records(shards: DataFrame, folder: str) -> DataFrame:
    """One row per record of the committed shards: doc_id, start, n_tokens, ids_crc32, checked against both checksums."""
    before = F.sum("n_tokens").over(Window.orderBy("part", "nth")) - F.col("n_tokens")  # one row per shard
    placed = shards.withColumn("before", before).select("path", "index_path", "width", "before")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(folder)
        for batch in batches:
            for path, index_path, width, start in zip(*(c.to_pylist() for c in batch.columns)):
                with fs.open_input_stream(index_path) as f:
                    offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
                rows: list[list] = [[], [], [], []]
                with fs.open_input_file(path) as f:
                    for lo, hi, run in _in_runs(f, offsets):
                        payload, _ = unframe(run[lo:hi])
                        doc, null = struct.unpack_from("<qB", payload)
                        ids = np.frombuffer(payload, f"<u{width}", offset=9).astype("<u4")
                        for column, value in zip(rows, (None if null else doc, start, len(ids), zlib.crc32(ids.tobytes()))):
                            column.append(value)
                        start += len(ids)
                        if len(rows[0]) == 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=RECORD)
                            rows = [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=RECORD)

    tasks = placed.repartition(max(placed.sparkSession.sparkContext.defaultParallelism, 1), "path")
    return tasks.mapInArrow(run, ", ".join(f"{c} long" for c in RECORD))


RECORD = ["doc_id", "start", "n_tokens", "ids_crc32"]


def op7_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "llm", f"records-{uuid.uuid4().hex}")
    return read_records(write_records(_store.documents(spark, sf_dir, "doc_id", "text"), folder=folder), folder)
