"""Operator 12: periodic runs of words by an online sparse diagonal DP.

A diagonal is a lag q between two positions of one text. Each word looks at its nearest earlier occurrence: the lag it finds there
is active, and its match length grows by one for every further word that agrees with the word q back. A lag that ends is a
run of length (matched words + q), emitted when it is long enough.

One word alone has far too many earlier occurrences (a text of one word has n * n / 2), so a lag is opened by the nearest earlier
occurrence of the last k words instead, k a power of two with k / 2 < q <= k (16 for q <= 16). This loses nothing: a run of period
q has at least 2q matched words (24 - q for small q), hence at least k; and inside it the nearest earlier occurrence of its last
k >= q words is q back, since a nearer one would give the run a smaller period. For the same reason only smallest
periods are ever opened. Each position has at most one lag per k, and a position whose k words occur once leaves the sparse
set for good, so the work is n log n at worst, whatever repeats.

Runs: maximal stretches of words with smallest period q and a length of at least max(``min_words``, ``min_powers`` * q).

Texts are read whole, one pass, no shuffle; a task holds a few megabytes of texts (or one text) and integers per word.

Defined results: a null or empty text has no words and no runs; repeated rows give one output row each; a null doc_id stays null;
an empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stayflow.llm import _store, _text

MIN_WORDS, MIN_POWERS = 24, 3


def word_numbers(words: list[bytes], base: int = 0) -> np.ndarray:
    """Equal words of one text have equal numbers, words of different texts (bases) different ones."""
    first: dict[bytes, int] = {}
    return np.fromiter(map(first.setdefault, words, range(base, base + len(words))), np.int64, len(words))


def _repeated(at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of positions with a key: those whose key occurs twice or more, the number of the key, and how far back the key was last
    (0: not before)."""
    order = np.argsort(key, kind="stable")
    own = key[order]
    new = np.concatenate([[True], own[1:] != own[:-1]])
    group = np.cumsum(new) - 1
    keep = (np.bincount(group) > 1)[group]
    where, lag = at[order], np.zeros(len(at), np.int64)
    lag[1:] = np.where(new[1:], 0, where[1:] - where[:-1])
    where, group, lag = where[keep], group[keep], lag[keep]
    back = np.argsort(where, kind="stable")
    return where[back], group[back], lag[back]


def runs(ids: np.ndarray, min_words: int = MIN_WORDS, min_powers: int = MIN_POWERS) -> np.ndarray:
    """Rows (start, length, period) of all runs in an array of word numbers, by start, then period. Several texts may lie behind
    each other when no number occurs in two of them."""
    if min_powers < 3:
        raise ValueError("runs of fewer than three periods are not found this way")
    least = 1  # for every q up to this many words, min_words - q or (min_powers - 1) * q matched words reach as many words
    while min(max(min_words - q, (min_powers - 1) * q) for q in range(1, 2 * least + 1)) >= 2 * least:
        least *= 2
    n = len(ids)
    at, group, lag = _repeated(np.arange(n), np.asarray(ids, np.int64)) if n else (np.zeros(0, np.int64),) * 3
    code = np.full(n, -1, np.int64)
    out, k = [], 1
    while len(at):  # at: first positions of k words that occur more than once
        if k >= least:
            active = (lag > (k // 2 if k > least else 0)) & (lag <= k)
            first, q = at[active], lag[active]
            if len(first):
                opens = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1] + 1) | (q[1:] != q[:-1])]))
                grown = np.diff(np.append(opens, len(first)))  # words that went on with the lag after it was opened
                start, period = first[opens] - q[opens], q[opens]
                length = k + grown - 1 + period
                long = length >= np.maximum(min_words, min_powers * period)
                out.append(np.stack([start[long], length[long], period[long]], 1))
        code[:] = -1
        code[at] = group
        at = at[at + k < n]
        second = code[at + k]
        at, second = at[second >= 0], second[second >= 0]
        if not len(at):
            break
        at, group, lag = _repeated(at, code[at] * n + second)
        k *= 2
    found = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words stay when every run keeps its first period only."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return np.cumsum(edge)[:n] == 0


def collapsed(words: list[bytes], found: np.ndarray) -> bytes:
    if len(found):
        words = [words[i] for i in np.flatnonzero(kept_words(len(words), found)).tolist()]
    return b" ".join(words)


def _blocks(batches: Iterator[pa.RecordBatch], change, min_words: int, min_powers: int):
    """The doc_id column, and words and runs of each of its texts. All texts of a block go through one search."""
    for part, texts in _text.blocks(batches):
        split = [t.split() for t in texts]  # of bytes: at [\x20\x09-\x0D]
        if change is not None:
            split = [change(doc, words) for doc, words in zip(part.column(0).to_pylist(), split)]
        first = np.concatenate([[0], np.cumsum([len(words) for words in split])])
        found = runs(np.concatenate([word_numbers(words, lo) for words, lo in zip(split, first.tolist())]), min_words, min_powers)
        cut = np.searchsorted(found[:, 0], first).tolist()
        yield part.column(0), [(words, found[i:j] - [lo, 0, 0]) for words, i, j, lo in zip(split, cut, cut[1:], first.tolist())]


def _batch(docs: pa.Array, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([docs, *columns.values()], names=["doc_id", *columns])


def find(docs: DataFrame, min_words: int = MIN_WORDS, min_powers: int = MIN_POWERS) -> DataFrame:
    """One row per run: doc_id, start (word number), length, period."""
    def run(batches):
        for ids, texts in _blocks(batches, None, min_words, min_powers):
            found = np.concatenate([f for _, f in texts])
            row = np.repeat(np.arange(len(texts)), [len(f) for _, f in texts])
            yield _batch(ids.take(pa.array(row)), **{name: pa.array(found[:, i]) for i, name in enumerate(("start", "length", "period"))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, length long, period long")


def collapse(docs: DataFrame, min_words: int = MIN_WORDS, min_powers: int = MIN_POWERS) -> DataFrame:
    """doc_id, n_runs and text of every row: runs cut down to their first period, words joined by one space."""
    def run(batches):
        for ids, texts in _blocks(batches, None, min_words, min_powers):
            yield _batch(ids, n_runs=pa.array([len(f) for _, f in texts], pa.int64()),
                         text=pa.array([collapsed(*t).decode("utf-8", "replace") for t in texts], pa.string()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_runs long, text string")


def strongest(found: np.ndarray) -> list:
    """start, length, period and floor(1000 * length / period) of the run with the most periods; nulls without a run."""
    best = None
    for start, length, period in found.tolist():  # by start, then period: the first of equals stays
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return [*best, 1000 * best[1] // best[2]] if best else [None] * 4


def planted(doc, words: list[bytes]) -> list[bytes]:
    """The words that the contract of the query searches: one document in ten is made periodic from some word on."""
    h = zlib.crc32(str(doc).encode())
    n, g = len(words), h // 10
    if doc is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * -(-(n - a) // len(cycle)))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its runs and digests, after the contract's planting."""
    def run(batches):
        for ids, texts in _blocks(batches, planted, MIN_WORDS, MIN_POWERS):
            best = list(zip(*(strongest(f) for _, f in texts)))
            lines = ["".join("%d,%d,%d\n" % tuple(r) for r in f.tolist()) for _, f in texts]
            yield _batch(ids, n_runs=pa.array([len(f) for _, f in texts], pa.int64()),
                         **{name: pa.array(values, pa.int64()) for name, values in zip(("start", "length", "period", "exponent_milli"), best)},
                         runs_sha256=pa.array([hashlib.sha256(t.encode()).hexdigest() for t in lines]),
                         collapsed_sha256=pa.array([hashlib.sha256(collapsed(*t)).hexdigest() for t in texts]))

    docs = _store.documents(spark, sf_dir, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, "
                                "runs_sha256 string, collapsed_sha256 string")
