"""Operator 9: byte-level BPE by corpus-level merge replay.

The matches of the split pattern are gathered over a large chunk of the corpus; every distinct one not met before enters
the replay once. All of them lie in one array of symbols. An inverted index maps each rank to the positions whose symbol
pair has it; merges are applied in rank order to all positions of the rank at once, and only the pairs on both sides
of a merge are looked up again and re-indexed. Each worker keeps the ids of matches and words it has met, up to a
fixed number, so the replay of later chunks covers only new ones. A chunk is bounded, and so is a task's memory.

With the pattern of the public byte-level files a single space goes with what follows it and a single line feed stands
alone, so a text without other runs of white space is split at those first, and the pattern runs over distinct
words only; any other text goes through the pattern whole.

Defined results: a null or empty text has no ids; repeated rows are encoded alike, one output row per input row; a null
doc_id stays null; an empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stayflow.llm import _store, _text

CHUNK_BYTES = 8 << 20
KEPT_PIECES, KEPT_WORDS = 700_000, 500_000
NONE = np.int32(2**31 - 1)


class Ranks:
    """The vocabulary: token bytes by rank, and the rank of every pair of tokens that joins to a token."""

    _shared: dict[str, "Ranks"] = {}

    @classmethod
    def of(cls, path: str) -> "Ranks":
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        pairs = {(self.rank[t[:k]] << 32) + self.rank[t[k:]]: r for t, r in self.rank.items() if len(t) > 1
                 for k in range(1, len(t)) if t[:k] in self.rank and t[k:] in self.rank}
        keys = np.array(sorted(pairs), np.int64)
        size = 1 << max(4, int(4 * len(keys)).bit_length())  # an open hash table: few probes per pair
        self.shift = np.uint64(65 - size.bit_length())
        self.keys, self.values = np.full(size + 64, -1, np.int64), np.full(size + 64, NONE, np.int32)
        slot = self._slot(keys)
        todo = np.arange(len(keys))
        self.probes = 0
        while len(todo):  # place what finds its slot free; the rest tries the next slot
            free = todo[self.keys[slot[todo]] < 0]
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[first]] = keys[first]
            self.values[slot[first]] = [pairs[k] for k in keys[first].tolist()]
            todo = np.setdiff1d(todo, first)
            slot[todo] += 1
            self.probes += 1
        self.pieces: dict[str, bytes] = {}
        # ids of words after a space and of words at the start of a line; None: the whole text must be split
        self.spaced: dict[str, bytes | None] = {}
        self.first: dict[str, bytes | None] = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it joins to no token."""
        keys = (left.astype(np.int64) << 32) + right
        slot = self._slot(keys)
        out = np.full(len(keys), NONE, np.int32)
        at = np.arange(len(keys))
        for _ in range(self.probes):
            found = self.keys[slot]
            hit = found == keys[at]
            out[at[hit]] = self.values[slot[hit]]
            more = ~hit & (found >= 0)
            if not more.any():
                break
            at, slot = at[more], slot[more] + 1
        return out

    def replay(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        symbol = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        end = np.cumsum(length)
        n = len(symbol)
        after, before = np.arange(1, n + 1, dtype=np.int64), np.arange(-1, n - 1, dtype=np.int64)
        after[end - 1] = -1
        before[end - length] = -1
        rank = np.full(n, NONE, np.int32)
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self.lookup(symbol[inner], symbol[inner + 1])
        index: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Index positions by the rank of their pair."""
            at = at[rank[at] != NONE]
            if not len(at):
                return
            own = rank[at]
            order = np.argsort(own, kind="stable")
            own, at = own[order], at[order]
            cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
                r = int(own[lo])
                if r in index:
                    index[r].append(at[lo:hi])
                else:
                    index[r] = [at[lo:hi]]
                    heapq.heappush(waiting, r)

        enter(inner)
        alive = np.ones(n, bool)
        while waiting:
            r = heapq.heappop(waiting)
            held = index.pop(r)
            at = held[0] if len(held) == 1 else np.concatenate(held)
            at = at[rank[at] == r]
            if len(at) > 1:
                at = np.unique(at)
                chained = after[at[:-1]] == at[1:]
                if chained.any():  # overlapping pairs merge from the left: every other one of a run
                    nth = np.arange(len(at))
                    run = np.maximum.accumulate(np.where(np.concatenate([[True], ~chained]), nth, 0))
                    at = at[(nth - run) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            right = after[gone]
            symbol[at] = r
            after[at] = right
            some = right >= 0
            before[right[some]] = at[some]
            alive[gone] = False
            rank[gone] = NONE
            rank[at] = NONE
            left = before[at]
            touched = np.concatenate([at[some], left[left >= 0]])
            rank[touched] = self.lookup(symbol[touched], symbol[after[touched]])
            enter(touched)
        total = np.concatenate([[0], np.cumsum(alive)])
        ids = symbol[alive]
        return [ids[i:j] for i, j in zip(total[end - length].tolist(), total[end].tolist())]

    def learn(self, pieces: set[str]) -> None:
        new = list(pieces - self.pieces.keys())
        raw = [p.encode() for p in new]
        whole = [self.rank.get(b) for b in raw]  # a match that is a token is that token
        rest = [i for i, r in enumerate(whole) if r is None]
        replayed = self.replay([raw[i] for i in rest]) if rest else []
        self.pieces.update((p, r.to_bytes(4, "little")) for p, r in zip(new, whole) if r is not None)
        self.pieces.update((new[i], ids.astype("<i4").tobytes()) for i, ids in zip(rest, replayed))

    def encode(self, texts: list[str], find, split_words: bool) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        for kept, limit in ((self.pieces, KEPT_PIECES), (self.spaced, KEPT_WORDS), (self.first, KEPT_WORDS)):
            if len(kept) > limit:
                kept.clear()
        lines = [[line.split(" ") for line in t.split("\n")] for t in texts] if split_words else [None] * len(texts)
        heads = {line[0] for text in lines if text for line in text} - self.first.keys()
        tails = set().union(*(line[1:] for text in lines if text for line in text)) - self.spaced.keys()
        # a word that begins or ends with white space (or is empty) is not one
        found = {w: find(w) if w and w == w.strip() else None for w in heads}
        after = {w: find(" " + w) if w and w == w.strip() else None for w in tails}
        whole = [None if split_words else find(t) for t in texts]
        self.learn({p for group in (found.values(), after.values(), whole) for split in group if split for p in split} | {"\n"})
        get = self.pieces.__getitem__
        self.first.update((w, split and b"".join(map(get, split))) for w, split in found.items())
        self.spaced.update((w, split and b"".join(map(get, split))) for w, split in after.items())
        out: list[bytes | None] = []
        spaced, first, feed = self.spaced.__getitem__, self.first.__getitem__, self.pieces["\n"]
        for text, split in zip(lines, whole):
            try:
                out.append(b"".join(map(get, split)) if text is None else
                           feed.join([first(line[0]) + b"".join(map(spaced, line[1:])) for line in text]))
            except TypeError:
                out.append(None)
        if odd := [i for i, ids in enumerate(out) if ids is None]:
            splits = [find(texts[i]) for i in odd]
            self.learn({p for split in splits for p in split})
            for i, split in zip(odd, splits):
                out[i] = b"".join(map(get, split))
        return out


def _encoded(path: str, pattern: str):
    """A function from a list of UTF-8 texts to a list of ids (arrays)."""
    import public_tokenizers
    import regex

    find = regex.compile(pattern).findall
    ranks = Ranks.of(path)
    split_words = pattern == public_tokenizers.PATTERN
    return lambda texts: [np.frombuffer(b, "<i4") for b in ranks.encode([t.decode("utf-8", "replace") for t in texts], find, split_words)]


def encoder(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = _encoded(path, pattern)
        for part, texts in _text.blocks(batches, limit=CHUNK_BYTES):
            ids = encode_texts(texts)
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "ids"])
    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every row of docs (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encoder(path, pattern), f"doc_id {kind}, ids array<int>")


def decode_bytes(ids: list[int], token: list[bytes]) -> bytes:
    return b"".join(map(token.__getitem__, ids))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text (the decoded bytes) of every row of encoded (doc_id, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = Ranks.of(path).token
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([decode_bytes(i or [], token) for i in part.column(1).to_pylist()], pa.binary())],
                                                 names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(run, f"doc_id {kind}, text binary")


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Both ways in one pass: doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256 of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, token = _encoded(path, pattern), Ranks.of(path).token
        decimal = [b"%d" % i for i in range(len(token))]
        for part, texts in _text.blocks(batches, limit=CHUNK_BYTES):
            rows: list[list] = [[], [], []]
            for i in map(np.ndarray.tolist, encode_texts(texts)):
                rows[0].append(len(i))
                rows[1].append(hashlib.sha256(b" ".join(map(decimal.__getitem__, i))).hexdigest())
                rows[2].append(hashlib.sha256(decode_bytes(i, token)).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(_store.documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
