"""Operator 3: quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded (shares of its characters by
kind, repetition and word-length figures, then a learned tanh layer), a gated attention (tanh times sigmoid) weighs the
passages, and the weighted passage representation is scored. Weights are learned from document labels only, by Adam on
the logistic loss over a bounded sample (``sample_rows`` labelled rows with the smallest hashes outside the held-out
fold, each of at most ``bag_limit`` passages); scoring runs over every whole text inside Spark tasks.

Defined results: a null or empty text is an empty bag, whose representation is zero; repeated rows score alike, one
output row per input row; a null doc_id is not held out; without labels of both classes every score is 0.5; an empty
table gives an empty result; columns other than doc_id and text (lang, source, clashing names) are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import _store, _text

PASSAGE = 64
HIDDEN, GATE = 24, 12

_kind = np.full(256, 96, np.uint8)  # printable ASCII one by one, other bytes of UTF-8, control characters
_kind[32:127] = np.arange(95)
_kind[:32] = 95
KINDS = 97
WIDTH = KINDS + 6


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features of each passage, number of passages of each text)."""
    b = _text.Block(texts)
    words = np.diff(b.first)
    n = -(-words // PASSAGE)
    total = int(n.sum())
    if not total:
        return np.zeros((0, WIDTH), np.float32), n
    doc = b.word_doc()
    nth = np.arange(len(doc)) - b.first[doc]
    bag = np.concatenate([[0], np.cumsum(n)])[:-1][doc] + nth // PASSAGE  # the passage of each word
    first = np.flatnonzero(np.concatenate([[True], bag[1:] != bag[:-1]]))
    count = np.diff(np.append(first, len(bag)))
    start, end = b.start[first], b.end[first + count - 1]
    edges = np.stack([start, end], 1).ravel()  # bytes between passages belong to none
    owner = np.repeat(np.stack([np.full(total, total), np.arange(total)], 1).ravel(), np.diff(edges, prepend=0))
    x = np.zeros((total, WIDTH), np.float32)
    x[:, :KINDS] = np.bincount(owner * KINDS + _kind[b.buf[: len(owner)]], minlength=(total + 1) * KINDS)[: total * KINDS].reshape(total, KINDS)
    x[:, :KINDS] = np.sqrt(x[:, :KINDS] / np.maximum(x[:, :KINDS].sum(1, keepdims=True), 1))
    h = b.word_hash()
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (bag[1:] == bag[:-1])
    distinct = np.bincount(bag[np.unique(h ^ _text.mix(bag.astype(np.uint64)), return_index=True)[1]], minlength=total)
    size = (b.end - b.start).astype(float)
    mean = np.add.reduceat(size, first) / count
    x[:, KINDS:] = np.stack([
        np.add.reduceat(same.astype(float), first) / count, distinct / count, mean / 10,
        np.sqrt(np.maximum(np.add.reduceat(size**2, first) / count - mean**2, 0)) / 10, np.log1p(count) / 4, np.log1p(end - start) / 8], 1)
    return x, n


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def start_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    return {"w": rng.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)), "b": np.zeros(HIDDEN), "v": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
            "u": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "a": rng.normal(0, GATE**-0.5, GATE), "c": np.zeros(HIDDEN), "d": np.zeros(1)}


def forward(p: dict[str, np.ndarray], x: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Logits of the bags; x: standardised passages in bag order, n: passages of each bag (may be 0)."""
    bag = np.repeat(np.arange(len(n)), n)
    h = np.tanh(x @ p["w"] + p["b"])
    t, s = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
    e = (t * s) @ p["a"]
    top = np.full(len(n), -np.inf)
    np.maximum.at(top, bag, e)
    e = np.exp(e - top[bag])
    alpha = e / np.bincount(bag, e, len(n))[bag]
    z = np.zeros((len(n), HIDDEN))
    np.add.at(z, bag, alpha[:, None] * h)
    return z @ p["c"] + p["d"][0], (bag, h, t, s, alpha, z)


def gradients(p: dict[str, np.ndarray], x: np.ndarray, out: np.ndarray, kept: tuple) -> dict[str, np.ndarray]:
    """out: derivative of the loss by each bag's logit."""
    bag, h, t, s, alpha, z = kept
    dz = out[bag, None] * p["c"]
    along = (dz * h).sum(1)
    de = alpha * (along - out[bag] * (z @ p["c"])[bag])
    dt, ds = de[:, None] * p["a"] * s * (1 - t**2), de[:, None] * p["a"] * t * s * (1 - s)
    dh = (alpha[:, None] * dz + dt @ p["v"].T + ds @ p["u"].T) * (1 - h**2)
    return {"w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ ds, "a": (t * s).T @ de, "c": z.T @ out, "d": out.sum(keepdims=True)}


def fit(x: np.ndarray, n: np.ndarray, y: np.ndarray, epochs: int = 20, batch: int = 64, rate: float = 0.005,
        decay: float = 1e-4, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0, dtype=float), x.std(0, dtype=float) + 0.02
    x -= mean.astype(x.dtype)  # in place: the bags are the largest thing the driver holds
    x /= scale.astype(x.dtype)
    first = np.concatenate([[0], np.cumsum(n)])
    p = start_weights(rng)
    m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    turn = 0
    for _ in range(epochs):
        order = rng.permutation(len(n))
        for i in range(0, len(n), batch):
            own = order[i : i + batch]
            rows = np.concatenate([np.arange(first[k], first[k + 1]) for k in own])
            logit, kept = forward(p, x[rows], n[own])
            g = gradients(p, x[rows], (_sigmoid(logit) - y[own]) / len(own), kept)
            turn += 1
            for k, v in p.items():
                a, b = m[k]
                grad = g[k] + decay * v
                a += 0.1 * (grad - a)
                b += 0.001 * (grad**2 - b)
                v -= rate * (a / (1 - 0.9**turn)) / (np.sqrt(b / (1 - 0.999**turn)) + 1e-8)
    return p | {"mean": mean, "scale": scale}


def _bags(limit: int):
    """One bag per labelled text: all its passages, or ``limit`` of them chosen by a hash of their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _text.blocks(batches):
            x, n = passages(texts)
            bags = []
            for end, k in zip(np.cumsum(n).tolist(), n.tolist()):
                bag = x[end - k : end]
                if k > limit:
                    bag = bag[np.sort(np.argsort(_text.mix(np.arange(1, k + 1, dtype=np.uint64)), kind="stable")[:limit])]
                bags.append(bag)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(part.schema.get_field_index("quality")).cast(pa.int32()), pa.array([len(b) for b in bags], pa.int32()),
                 pa.array([b.tobytes() for b in bags], pa.binary())], names=["doc_id", "quality", "n", "x"])
    return run


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 4000, bag_limit: int = 64) -> dict[str, np.ndarray] | None:
    """Weights learned outside the held-out fold, or None without both classes. The fit reads at most ``sample_rows`` labelled
    documents, chosen by hash, and ``bag_limit`` passages of each: about 105 MB at the driver with the defaults."""
    chosen = (labels.select("doc_id", "quality").where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out("doc_id"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .mapInArrow(_bags(bag_limit), f"doc_id {kind}, quality int, n int, x binary")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "x").limit(sample_rows).toPandas())
    y, n = rows["quality"].to_numpy(float), rows["n"].to_numpy()
    if not 0 < y.sum() < len(y) or not n.sum():
        return None
    x, at = np.empty((int(n.sum()), WIDTH), np.float32), 0
    for bag in rows.pop("x"):
        own = np.frombuffer(bag, np.float32).reshape(-1, WIDTH)
        x[at : at + len(own)] = own
        at += len(own)
    return fit(x, n, y)


def held_out(key: str):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _scores(texts: list[bytes], weights: dict[str, np.ndarray] | None) -> np.ndarray:
    if weights is None:
        return np.full(len(texts), 0.5)
    x, n = passages(texts)
    return _sigmoid(forward(weights, (x - weights["mean"]) / weights["scale"], n)[0])


def score(docs: DataFrame, weights: dict[str, np.ndarray] | None) -> DataFrame:
    """doc_id and score of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _text.blocks(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_scores(texts, weights), pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, weights: dict[str, np.ndarray] | None, least: float = 0.3) -> DataFrame:
    """The rows of docs, with all their columns, that score at least ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _text.blocks(batches):
            yield part.filter(pa.array(_scores(texts, weights) >= least))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, least: float = 0.3, sample_rows: int = 4000) -> DataFrame:
    return score(docs, train(docs, labels, sample_rows)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_store.documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
