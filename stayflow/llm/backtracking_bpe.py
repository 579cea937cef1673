"""Operator 11: exact byte-level BPE by backtracking over longest matches, and decoding by an offset table.

One pass of an Aho-Corasick automaton over a piece (read backwards) gives the longest token that starts at each byte. The encoder
takes longest tokens from the left; a token may follow another only if merging would never cross the boundary between
them, which a table of pairs tells. Where no token fits, it tries the next shorter one (the longest token that is a prefix of
the last), and where none is left it marks the position as dead and takes back the token before. A position dies at most once, so the
time is linear in the piece. A sequence of tokens whose neighbours are all compatible is the one that the merges give.

The table of pairs is filled as pairs are met: the merges of both tokens are undone, latest first, and the boundary holds if no two
parts that stood side by side would have merged before one of them was taken up on its own side (merges of
one rank go from left to right). Tokens that their own merges never give are left out of the automaton.

Pieces are the matches of the split pattern; each worker keeps the ids of pieces it has met, up to a fixed number. The pattern's
character classes agree with the library's on all assigned characters; a text with an unassigned one is cut into
pieces by the library. Decoding gathers the bytes of all ids from one byte string through an offset table.

Texts are read whole, one pass, no shuffle; a task holds a few megabytes of texts (or one text), its ids, and the tables.

Defined results: a null or empty text has no ids; strings of added tokens inside a text become those tokens, as in the library;
repeated rows are encoded alike, one output row per input row; a null doc_id stays null; an empty table gives an
empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stayflow.llm import _store, _text

BLOCK_BYTES, GROUP_BYTES = 4 << 20, 1 << 20
KEPT_PIECES, KEPT_PAIRS = 500_000, 2_000_000
LONG_TEXT, STEP = 1 << 20, 100_000
DECODED_AT_ONCE = 1 << 18
BREAK = "Ā"  # outside the bytes, so no match crosses it


def byte_chars() -> list[str]:
    """The character that stands for each byte in byte-level vocabulary files: printable Latin-1 for itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def _unassigned() -> np.ndarray:
    """Which code points have no category here; later versions of the standard may give them one."""
    return np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


class Merges:
    """Tokens numbered by rank: the 256 bytes, then the result of each merge."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        self.token = [bytes([b]) for b in range(256)]
        number = {t: i for i, t in enumerate(self.token)}
        self.parts: list[tuple[int, int] | None] = [None] * 256
        for a, b in merges:
            if a + b in number:
                raise ValueError(f"two merges give the token {a + b!r}")
            number[a + b] = len(self.token)
            self.token.append(a + b)
            self.parts.append((number[a], number[b]))
        self.number = number
        self.joined = {p: t for t, p in enumerate(self.parts) if p}
        reached = [True] * 256
        for t in range(256, len(self.token)):
            a, b = self.parts[t]
            reached.append(reached[a] and reached[b] and self.stays_apart(a, b, t))
        self.reached = reached
        self.size = list(map(len, self.token))
        # the longest token that is a proper prefix of each token
        self.shorter = [-1] * len(self.token)
        for t, text in enumerate(self.token):
            for k in range(len(text) - 1, 0, -1):
                p = number.get(text[:k], -1)
                if p >= 0 and reached[p]:
                    self.shorter[t] = p
                    break
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for t, text in enumerate(self.token):
            if reached[t]:
                self.automaton.add_word(text[::-1].decode("latin-1"), t)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}

    def stays_apart(self, left: int, right: int, before: int = sys.maxsize) -> bool:
        """Whether no merge of a rank below ``before`` crosses the boundary between two tokens, while each is built up."""
        x, y, limit = left, right, before  # the parts at the boundary; merges from ``limit`` on come too late
        while True:
            if self.joined.get((x, y), limit) < limit:
                return False
            if max(x, y) < 256:  # both are bytes: there is nothing left to undo
                return True
            if x > y:
                limit = min(limit, x)  # a merge of this very rank went first on the left
                x = self.parts[x][1]
            else:
                limit = min(limit, y + 1)
                y = self.parts[y][0]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.stays_apart(left, right)
        return known

    def longest(self, pieces: list[bytes]) -> list[int]:
        """The longest token at each byte of the pieces, which lie behind each other with one byte between them."""
        line = BREAK.join(p.decode("latin-1") for p in pieces)[::-1]
        out = [-1] * len(line)
        last, end = len(line) - 1, -1
        for at, token in self.automaton.iter(line):  # of the matches that end at one place, the longest comes first
            if at != end:
                end = at
                out[last - at] = token
        return out

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """The tokens of each piece (none empty)."""
        longest, size, shorter, apart = self.longest(pieces), self.size, self.shorter, self.compatible
        out, base = [], 0
        for piece in pieces:
            n = len(piece)
            tokens: list[int] = []
            dead = bytearray(n + 1)
            at, token = 0, longest[base]
            while at < n:
                while True:
                    end = at + size[token]
                    if not dead[end] and (not tokens or apart(tokens[-1], token)):
                        tokens.append(token)
                        at = end
                        if at < n:
                            token = longest[base + at]
                        break
                    token = shorter[token]
                    if token < 0:
                        dead[at] = 1
                        token = tokens.pop()
                        at -= size[token]
            out.append(tokens)
            base += n + 1
        return out


class Tokenizer:
    """A byte-level BPE file of the ``tokenizers`` library."""

    _shared: dict[tuple[str, str], "Tokenizer"] = {}

    @classmethod
    def of(cls, path: str, pattern: str) -> "Tokenizer":
        if (path, pattern) not in cls._shared:
            cls._shared[path, pattern] = cls(path, pattern)
        return cls._shared[path, pattern]

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, split = file["model"], file["pre_tokenizer"] or {}
        plain = all(not model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if (model["type"], split.get("type"), split.get("add_prefix_space"), file["normalizer"], plain) != ("BPE", "ByteLevel", False, None, True):
            raise ValueError(f"{path} is no plain byte-level BPE")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in file["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take more than their own string")
        byte = {c: b for b, c in enumerate(byte_chars())}
        raw = lambda s: bytes(map(byte.__getitem__, s))
        self.merges = Merges([(raw(a), raw(b)) for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])])
        vocabulary = {raw(s): i for s, i in model["vocab"].items() if all(c in byte for c in s)}
        self.id = np.array([vocabulary[t] for t in self.merges.token], "<u4")
        added = {t["content"]: t["id"] for t in file["added_tokens"]}
        texts = {int(i): t for i, t in zip(self.id, self.merges.token)} | {i: t.encode() for t, i in added.items()}
        known = [texts.get(i, b"") for i in range(max(texts) + 1)]
        self.pool = np.frombuffer(b"".join(known), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum(np.fromiter(map(len, known), np.int64, len(known)))])
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        self.added_strings = re.compile("(%s)" % "|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.pattern = regex.compile(pattern)
        self.unassigned = _unassigned()
        self.first_unassigned = int(np.argmax(self.unassigned))
        self.path, self.library = path, None
        self.pieces: dict[str, bytes] = {}

    def _odd(self, text: str) -> bool:
        """Whether the text has an unassigned character."""
        if text.isascii():
            return False
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        return bool(self.unassigned[codes[codes >= self.first_unassigned]].any())

    def _split(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text without added tokens, in lists of bounded length."""
        if self._odd(text):
            if self.library is None:
                from tokenizers import Tokenizer as Library

                self.library = Library.from_file(self.path).pre_tokenizer
            yield [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        elif len(text) <= LONG_TEXT:
            yield self.pattern.findall(text)
        else:
            found = self.pattern.finditer(text)
            while some := [m.group() for m in islice(found, STEP)]:
                yield some

    def _learn(self, pieces: set[str]) -> None:
        if len(self.pieces) > KEPT_PIECES:
            self.pieces.clear()
        new = list(pieces - self.pieces.keys())
        raw = [p.encode() for p in new]
        lo = size = 0
        for hi, text in enumerate(raw, 1):
            size += len(text) + 1
            if size > GROUP_BYTES or hi == len(raw):
                self.pieces.update((p, self.id[t].tobytes()) for p, t in zip(new[lo:hi], self.merges.encode(raw[lo:hi])))
                lo, size = hi, 0

    def _plain(self, text: str) -> bytes:
        out = []
        for pieces in self._split(text):
            self._learn(set(pieces))
            out.append(b"".join(map(self.pieces.__getitem__, pieces)))
        return b"".join(out)

    def _whole(self, text: str) -> bytes:
        if self.added_strings is None:
            return self._plain(text)
        return b"".join(self.added.get(t) or self._plain(t) for t in self.added_strings.split(text) if t)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers. New pieces of short texts are learnt together."""
        simple = [len(t) <= LONG_TEXT and not (self.added_strings and self.added_strings.search(t)) and not self._odd(t) for t in texts]
        split = [self.pattern.findall(t) if s else None for t, s in zip(texts, simple)]
        self._learn(set().union(*(p for p in split if p)))
        get = self.pieces.__getitem__
        out = [None if p is None else b"".join(map(get, p)) for p in split]
        return [self._whole(t) if ids is None else ids for t, ids in zip(texts, out)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes behind some ids."""
        out = []
        for lo in range(0, len(ids), DECODED_AT_ONCE):
            some = ids[lo : lo + DECODED_AT_ONCE]
            start, size = self.offset[some], self.offset[some.astype(np.int64) + 1] - self.offset[some]
            end = np.cumsum(size)
            out.append(self.pool[np.repeat(start - end + size, size) + np.arange(end[-1])].tobytes())
        return b"".join(out)

    def decode_texts(self, encoded: list[bytes]) -> list[str]:
        """The text of each list of ids; bytes that are no UTF-8 become replacement characters."""
        ids = np.frombuffer(b"".join(encoded), "<u4")
        size = np.concatenate([[0], np.cumsum(self.offset[ids.astype(np.int64) + 1] - self.offset[ids])])
        raw = self.decode(ids)
        cut = size[np.concatenate([[0], np.cumsum([len(e) >> 2 for e in encoded])])].tolist()
        return [raw[i:j].decode("utf-8", "replace") for i, j in zip(cut, cut[1:])]


def _strings(texts: list[bytes]) -> list[str]:
    return [t.decode("utf-8", "replace") for t in texts]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every row of docs (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.of(path, pattern)
        for part, texts in _text.blocks(batches, limit=BLOCK_BYTES):
            encoded = tokenizer.encode(_strings(texts))
            offsets = np.concatenate([[0], np.cumsum([len(e) >> 2 for e in encoded])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), "<i4")))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text of every row of encoded (doc_id, ids); null ids are an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.of(path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                ids = [np.array(i or [], "<u4").tobytes() for i in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(tokenizer.decode_texts(ids), pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Both ways in one pass: doc_id, n_tokens, ids_sha256 (of the ids as little-endian 32-bit integers), decoded_sha256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.of(path, pattern)
        for part, texts in _text.blocks(batches, limit=BLOCK_BYTES):
            encoded = tokenizer.encode(_strings(texts))
            back = tokenizer.decode_texts(encoded)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(e) >> 2 for e in encoded], pa.int64()),
                 pa.array([hashlib.sha256(e).hexdigest() for e in encoded], pa.string()),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(_store.documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
