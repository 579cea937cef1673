"""Operator 8: quality rules as gradient-boosted trees over document statistics, with monotonic constraints.

One vectorised pass over the whole texts gives every document's statistics. The trees are grown on a bounded sample of labelled rows (``sample_rows``, the rows with the smallest hashes), on histograms of the statistics;
a constrained statistic (symbols, repeated lines and words) can only lower the score as it grows. The trees
are flattened into node arrays, and all rows of a block walk down all trees at once.

Defined results: a null or empty text has no words (all statistics 0) and fails the base rules; repeated rows are judged
alike, one output row per input row; a null doc_id stays null; without labels of both classes the trees keep all that
the base rules keep; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import _store, _text

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: (statistic, constraint): -1 the score may only fall as it grows, 0 free.
FEATURES = (("log_words", 0), ("word_length", 0), ("symbol_share", -1), ("dup_line_share", -1), ("repeat_share", -1),
            ("stutter_share", -1), ("upper_share", 0), ("digit_share", 0), ("mark_share", 0), ("line_words", 0))

_symbol, _upper, _digit, _mark = (np.zeros(256, bool) for _ in range(4))
_symbol[list(SYMBOLS)] = True
_upper[65:91] = True
_digit[48:58] = True
_mark[list(b"!?\"'()[]{}=/\\+_~^@")] = True


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The statistics of each text, as arrays."""
    b = _text.Block(texts)
    n_docs, buf = len(texts), b.buf

    def per_text(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return np.diff(total[b.offset])

    words = np.diff(b.first)
    h, doc = b.word_hash(), b.word_doc()
    salt = _text.mix(np.arange(1, n_docs + 1).astype(np.uint64))
    out = {"n_words": words, "word_chars": per_text(((buf & 0xC0) != 0x80) & ~_text._space[buf]), "n_symbols": per_text(_symbol[buf])}

    ends = np.flatnonzero(buf == 10)  # lines: the byte that joins two texts ends a line too
    starts = np.concatenate([[0], ends[:-1] + 1])
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_text._byte_value[buf] * _text.powers(_text._BASE, len(buf)), out=total[1:])
    line = _text.mix((total[ends] - total[starts]) * _text.powers(_text._INVERSE, len(buf))[starts] + (ends - starts).astype(np.uint64))
    solid = np.concatenate([[0], np.cumsum(~_text._space[buf])])
    full = solid[ends] > solid[starts]
    line_doc = (np.searchsorted(b.offset, starts, side="right") - 1)[full]
    _, at = np.unique(line[full] ^ salt[line_doc], return_index=True)
    lines = np.bincount(line_doc, minlength=n_docs)
    out["n_dup_lines"] = lines - np.bincount(line_doc[at], minlength=n_docs)

    at, wh = _text.windows(h, b.first, WINDOW)
    _, back, count = np.unique(wh ^ salt[doc[at]], return_inverse=True, return_counts=True)
    twice = at[count[back] > 1]
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.subtract.at(cover, twice + WINDOW, 1)
    out["n_repeat_words"] = np.bincount(doc[np.cumsum(cover)[:-1] > 0], minlength=n_docs)

    stutter = np.bincount(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], minlength=n_docs)
    chars, some = np.maximum(out["word_chars"], 1), np.maximum(words, 1)
    out |= {"log_words": np.log1p(words), "word_length": out["word_chars"] / some, "symbol_share": out["n_symbols"] / chars,
            "dup_line_share": out["n_dup_lines"] / np.maximum(lines, 1), "repeat_share": out["n_repeat_words"] / some,
            "stutter_share": stutter / some, "upper_share": per_text(_upper[buf]) / chars, "digit_share": per_text(_digit[buf]) / chars,
            "mark_share": per_text(_mark[buf]) / chars, "line_words": words / np.maximum(lines, 1)}
    return out


def _features(found: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([found[c].astype(float) for c, _ in FEATURES], 1)


@dataclass
class Trees:
    """All trees in flat arrays: node i asks x[feature] <= threshold, goes to left or left + 1; a leaf has left 0."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the good class for each row of x."""
        rows = np.arange(len(x))[:, None]
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(self.depth):
            left = self.left[node]
            down = left + (x[rows, self.feature[node]] > self.threshold[node])
            node = np.where(left > 0, down, node)
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(1))))


def grow(x: np.ndarray, y: np.ndarray, signs: np.ndarray, n_trees: int = 60, depth: int = 4, rate: float = 0.2,
         bins: int = 64, ridge: float = 1.0, least: float = 1.0) -> Trees:
    """Gradient boosting on the logistic loss. signs: -1, 0 or 1 for each column of x."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(cut, c) for cut, c in zip(cuts, x.T)], 1)
    n, width = len(x), x.shape[1]
    prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(prior / (1 - prior)))
    margin = np.full(n, base)
    feature, threshold, left, value, roots = [], [], [], [], []

    def node() -> int:
        for arr, v in ((feature, 0), (threshold, 0.0), (left, 0), (value, 0.0)):
            arr.append(v)
        return len(feature) - 1

    column = np.arange(width) * bins
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        roots.append(node())
        todo = [(roots[-1], np.arange(n), -np.inf, np.inf, 0)]
        while todo:
            at, rows, low, high, level = todo.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            value[at] = rate * float(np.clip(-g / (h + ridge), low, high))
            best = None
            if level < depth:
                flat = (binned[rows] + column).ravel()
                gs = np.bincount(flat, np.repeat(grad[rows], width), width * bins).reshape(width, bins).cumsum(1)
                hs = np.bincount(flat, np.repeat(hess[rows], width), width * bins).reshape(width, bins).cumsum(1)
                gl, hl = gs[:, :-1], hs[:, :-1]
                gr, hr = g - gl, h - hl
                vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
                gain = -(gl * vl + 0.5 * (hl + ridge) * vl**2) - (gr * vr + 0.5 * (hr + ridge) * vr**2)
                gain = np.where((hl >= least) & (hr >= least) & (signs[:, None] * (vr - vl) >= 0), gain, -np.inf)
                v0 = np.clip(-g / (h + ridge), low, high)
                f, c = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[f, c] > -(g * v0 + 0.5 * (h + ridge) * v0**2) + 1e-6 and c < len(cuts[f]):
                    best = (int(f), int(c), float(vl[f, c]), float(vr[f, c]))
            if best is None:
                margin[rows] += value[at]
                continue
            f, c, a, b = best
            feature[at], threshold[at] = f, float(cuts[f][c])
            left[at] = node()
            node()
            go = binned[rows, f] <= c
            middle = (a + b) / 2
            (llo, lhi), (rlo, rhi) = {-1: ((middle, high), (low, middle)), 0: ((low, high),) * 2, 1: ((low, middle), (middle, high))}[int(signs[f])]
            todo += [(left[at], rows[go], llo, lhi, level + 1), (left[at] + 1, rows[~go], rlo, rhi, level + 1)]
    return Trees(np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(value), base, depth)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> Trees | None:
    """Trees grown on at most ``sample_rows`` labelled rows, or None without both classes. Labels, and the rows of repeated doc_ids,
    are chosen by hash, whatever the texts are like."""
    chosen = (labels.select("doc_id", "quality").where("quality IN (0, 1) AND doc_id IS NOT NULL")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows))
    names = [c for c, _ in FEATURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _text.blocks(batches):
            x = _features(statistics(texts))
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("hash")),
                                              part.column(part.schema.get_field_index("quality")).cast(pa.int32()),
                                              *(pa.array(x[:, i]) for i in range(len(names)))], names=["hash", "quality", *names])

    rows = (docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("hash")).join(F.broadcast(chosen), "doc_id")
            .mapInArrow(run, "hash long, quality int, " + ", ".join(f"{c} double" for c in names))
            .orderBy("hash", "quality", *names).limit(sample_rows).toPandas().sort_values([*names, "quality"]))
    y = rows["quality"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return None
    return grow(rows[names].to_numpy(float), y, np.array([s for _, s in FEATURES]))


def _verdicts(texts: list[bytes], trees: Trees | None, least_score: float) -> dict[str, np.ndarray]:
    found = statistics(texts)
    failed = (found["n_words"] < 20) | (100 * found["n_repeat_words"] > 30 * found["n_words"])
    score = np.ones(len(texts)) if trees is None else trees.score(_features(found))
    return found | {"base_failed": failed, "score": score, "kept": ~failed & (score >= least_score)}


def judge(docs: DataFrame, trees: Trees | None, least_score: float = 0.3) -> DataFrame:
    """doc_id, the statistics of the base rules, base_failed, score, kept of every row."""
    names = [*LONGS, "base_failed", "score", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _text.blocks(batches):
            found = _verdicts(texts, trees, least_score)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(found[c].astype(np.int64) if c in LONGS else found[c]) for c in names)], names=["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in LONGS) + ", base_failed boolean, score double, kept boolean")


def keep_good(docs: DataFrame, trees: Trees | None, least_score: float = 0.3) -> DataFrame:
    """The rows of docs, with all their columns, that pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _text.blocks(batches):
            yield part.filter(pa.array(_verdicts(texts, trees, least_score)["kept"]))

    return docs.mapInArrow(run, docs.schema)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _store.documents(spark, sf_dir, "doc_id", "text")
    return judge(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
