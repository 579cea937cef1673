"""Operator 5: packing by shortest-pack-first over the length histogram.

Documents are tokenised (END_ID appended) and cut at multiples of ``size`` tokens; what is packed are pieces of 1..size
tokens. The histogram of their lengths has at most ``size`` entries however many documents there are. On it alone the
packing is found: lengths are placed longest first, each into the shortest open pack that has room for it, in
counts of equal packs ("patterns"). Then every piece takes the slot of its rank among the pieces of its length. Ranks are
counted within (length, salt) groups plus the counts of the groups before, so a length that a third of all pieces
share is spread over many tasks. The patterns that are shipped to tasks are bounded by the histogram, not the corpus.

A sequence is padded to ``size`` unless its length is a power of two (then it is used as it is).

Defined results: a null or empty text is the end token alone; repeated rows are packed one by one; a null doc_id stays
null; an empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayflow.llm import _store, _text, _tokens

SIZE = 2048


def patterns(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, list[int]]]:
    """(number of packs, their lengths) over a histogram {length: count}: longest first into the shortest pack with room."""
    open_: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)  # room left -> packs with that room
    for length in sorted(counts, reverse=True):
        left = counts[length]
        # a pack made while this length is placed has room below its predecessor's: one sweep from the most room down
        room = size
        while left and room >= length:
            if room == size or not open_.get(room):
                room -= 1
                continue
            n, pack = open_[room].pop()
            take = min(n, left)
            if n > take:
                open_[room].append((n - take, pack))
            open_[room - length].append((take, [*pack, length]))
            left -= take
        if left:
            per_pack = size // length  # new packs are the shortest there are: they take this length while it fits
            whole, rest = divmod(left, per_pack)
            if whole:
                open_[size - per_pack * length].append((whole, [length] * per_pack))
            if rest:
                open_[size - rest * length].append((1, [length] * rest))
    return [entry for room in sorted(open_) for entry in open_[room]]


class Slots:
    """Where the piece of each (length, rank) goes: arrays over runs of consecutive ranks."""

    def __init__(self, packs: list[tuple[int, list[int]]]):
        used: dict[int, int] = defaultdict(int)
        rows, sequence = [], 0
        for n, lengths in packs:
            offset = 0
            for length in lengths:
                rows.append((length, used[length], sequence, offset))
                used[length] += n
                offset += length
            sequence += n
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.start = (table[:, 0] << 48) + table[:, 1]
        self.rank, self.sequence, self.offset = table[:, 1], table[:, 2], table[:, 3]

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.start, (length << 48) + rank, side="right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


def _cut(path: str, size: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _text.forget()
        encoder = _tokens.WordEncoder.of(path)
        for part, texts in _text.blocks(batches, limit=_tokens.BLOCK_BYTES, keep=True):
            rows: list[list] = [[] for _ in range(6)]
            for doc, ids in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                ids += _tokens.END
                total = len(ids) // 4
                for start in range(0, total, size):
                    piece = ids[4 * start : 4 * (start + size)]
                    for column, value in zip(rows, (doc, start, len(piece) // 4, zlib.crc32(piece), total, piece)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], part.schema.field(0).type), *(pa.array(c, pa.int64()) for c in rows[1:5])]
                + [pa.array(rows[5], pa.binary())] * with_ids,
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids)
    return run


def cut(docs: DataFrame, tokenizer: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens (and ids, 4 bytes each)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _cut(tokenizer, size, with_ids), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids)


def place(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds sequence_id and offset to a landed table of pieces."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``size`` rows
    slots = Slots(patterns(histogram, size))
    salts = max(1, int(sum(histogram.values()) ** 0.5))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)))
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = groups.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens"))
    ranked = salted.withColumn("nth", nth).join(before, ["length", "salt"]).select(
        *pieces.columns, (F.col("before") + F.col("nth") - 1).alias("rank"))

    names = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            sequence, offset = slots.find(batch.column(at("length")).to_numpy(), batch.column(at("rank")).to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(at(c)) for c in names), pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(run, fields + ", sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    pieces = _store.land(cut(docs, tokenizer or _tokens.default_tokenizer(), size, with_ids), "pieces")
    return place(pieces, size)


def sequences(placed: DataFrame, size: int = SIZE) -> DataFrame:
    """The packed sequences themselves (sequence_id, n_tokens, input_ids as 4-byte ids), unpadded, from pieces with ids. A
    group holds at most ``size`` tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select(
        "sequence_id", "n_tokens", F.unhex(F.array_join(F.col("parts")["ids"], "")).alias("input_ids"))


def op5_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_store.documents(spark, sf_dir, "doc_id", "text"))
