"""Vectorised splitting and hashing of whole texts, shared by the text operators.

Texts are handled as UTF-8 bytes in blocks of a few megabytes, so a task's memory does not depend on
the number of rows in its partition. Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19
U64 = np.uint64

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_byte_value = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the longest table asked for is kept, up to a few blocks."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, BLOCK_BYTES), base, U64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        if n <= 4 * BLOCK_BYTES:
            _powers[base] = table
    return table[:n]


def forget() -> None:
    """Give back the tables that earlier operators left in this worker."""
    _powers.clear()


#: What gives back the caches that other operators keep in this worker.
held: list[Callable[[], None]] = []


def trim() -> None:
    """Hand memory that the C library keeps for later back to the system, where the library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


_INVERSE = pow(_BASE, -1, 1 << 64)


class Block:
    """The words of some texts. ``first[d]:first[d+1]`` are the words of text ``d``."""

    def __init__(self, texts: list[bytes], lower: bool = False, raw: bool = False):
        data = b"\n".join(texts) + b"\n"
        buf = np.frombuffer(data, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.data, self.buf = data, buf
        self.offset = np.concatenate([[0], np.cumsum(lengths + 1)])  # of each text, the joining byte included
        space = _space[buf]
        edge = np.empty(len(buf), bool)
        edge[0] = not space[0]
        np.not_equal(space[1:], space[:-1], out=edge[1:])
        at = np.flatnonzero(edge)
        self.start, self.end = at[0::2], at[1::2]
        if raw:
            lower = False
        self.lower = lower
        self.first = np.searchsorted(self.start, self.offset)

    def word_hash(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes (A-Z lower-cased if asked for)."""
        buf = _lower[self.buf] if self.lower else self.buf
        total = np.zeros(len(buf) + 1, U64)
        np.cumsum(_byte_value[buf] * powers(_BASE, len(buf)), out=total[1:])
        h = (total[self.end] - total[self.start]) * powers(_INVERSE, len(buf))[self.start]
        return mix(h + (self.end - self.start).astype(U64))

    def word_doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words inside one text: (position of first word, hash)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    acc = np.zeros(n, U64)
    for k, p in enumerate(powers(0xC2B2AE3D27D4EB4F, width + 1)[1:].tolist()):
        acc += hashes[k : k + n] * U64(p)
    ok = np.ones(len(hashes) + 1, bool)  # a window may not run over the end of its text
    for back in range(1, width):
        ends = first[1:] - back
        ok[ends[ends >= first[:-1]]] = False
    at = np.flatnonzero(ok[:n])
    return at, mix(acc[at])


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = BLOCK_BYTES, keep: bool = False) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with at most ``limit`` bytes of text (or a single row), null texts as empty. Only a slice's texts
    become Python objects; what Arrow no longer needs goes back after each batch. Unless ``keep``, caches that other operators left in
    this worker go first."""
    while held and not keep:
        held.pop()()
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        lo, before = 0, 0
        while lo < len(ends):
            hi = max(lo + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(lo, hi - lo), [b"" if t is None else t for t in column.slice(lo, hi - lo).to_pylist()]
            lo, before = hi, int(ends[hi - 1])
        del batch, column
        pa.default_memory_pool().release_unused()
    trim()
