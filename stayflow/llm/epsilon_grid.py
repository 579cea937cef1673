"""Operator 2: embedding near-duplicates by an epsilon grid order join.

Unit vectors of cosine >= c lie within eps = sqrt(2 - 2c). Vectors are projected on the leading principal directions
(fitted on a bounded sample; any orthonormal basis gives the same result), sorted by the grid cells of side eps there,
and cut into blocks of ``BLOCK`` along that order. Blocks are the leaves of a tree of sequence intervals with fan-out
``FAN``; each interval has a bounding box. From the top, a pair of intervals farther apart than eps is dropped, any
other is replaced by the pairs of its children: one join with the boxes per level, until pairs of blocks are left.
The recursion goes on inside the task that joins two blocks, down to ``LEAF`` vectors, where cosines are computed
(single precision with a margin finds candidates, double precision decides).

Equal vectors are one vertex with a multiplicity. A block pair gives sums and a spanning forest of its links, never the
links themselves, so a group of near copies costs rows in proportion to its vectors per block pair.

Defined results: null, zero, or non-finite vectors (or null components) link with nothing, nor do vectors of different
lengths; each row is a vector, so repeated rows link with each other; a null vec_id has a null component, no links and
is kept; an empty table gives an empty result; labels and other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayflow.llm import _store

DIMS = 8
BLOCK, LEAF, FAN = 2048, 256, 16
SAMPLE = 4096


def _vectors(single: bool):
    """vec_id, key of the vector (null if it links with nothing), its bytes, its length."""
    kind = np.float32 if single else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, raws, dims = [], [], []
            for v in batch.column(1):
                x = np.zeros(0) if v.as_py() is None else np.array([np.nan if c is None else c for c in v.as_py()], kind)
                good = len(x) and np.isfinite(x).all() and x.any()
                raw = (x + kind(0)).astype(kind).tobytes() if good else None
                raws.append(raw)
                keys.append(hashlib.blake2b(raw, digest_size=16).digest() if good else None)
                dims.append(len(x))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(keys, pa.binary()), pa.array(raws, pa.binary()),
                                              pa.array(dims, pa.int32())], names=["vec_id", "key", "raw", "dim"])
    return run, kind


def _unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _project(unit: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Leading coordinates: exact distances never grow under them. Other lengths use their own first components."""
    if unit.shape[1] == basis.shape[0]:
        out = unit @ basis
    else:
        out = unit[:, :DIMS]
    return np.pad(out, ((0, 0), (0, DIMS - out.shape[1])))


def _matrix(raws: list[bytes], kind, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raws), kind).reshape(-1, dim)


def fit_basis(vectors: DataFrame, kind) -> np.ndarray:
    """Principal directions of at most SAMPLE vectors of the sample's most common length."""
    rows = vectors.where("key IS NOT NULL").select("key", "raw", "dim").orderBy("key").limit(SAMPLE).toPandas()
    if not len(rows):
        return np.eye(1, 1)
    dim = int(rows["dim"].mode()[0])
    x = _unit(_matrix(list(rows.loc[rows["dim"] == dim, "raw"]), kind, dim))
    return np.linalg.eigh(x.T @ x)[1][:, ::-1][:, : min(DIMS, dim)]


def _boxes(lo: str, n: int) -> list[str]:
    return [f"{lo}{i}" for i in range(n)]


LO, HI = _boxes("lo", DIMS + 1), _boxes("hi", DIMS + 1)


def _coordinates(dim: int, unit: np.ndarray, basis: np.ndarray) -> np.ndarray:
    return np.concatenate([np.full((len(unit), 1), 16.0 * dim), _project(unit, basis)], 1)


def _apart(a_lo, a_hi, b_lo, b_hi) -> np.ndarray:
    """Squared distance of boxes."""
    return (np.maximum(0, np.maximum(a_lo - b_hi, b_lo - a_hi)) ** 2).sum(-1)


class GridJoin:
    def __init__(self, cosine: float, kind, basis: np.ndarray):
        self.cosine, self.kind, self.basis = cosine, kind, basis
        self.eps = float(np.sqrt(2 - 2 * cosine)) + 1e-6

    def cells(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the grid cell of each vector (v, key, raw, dim, times)."""
        for batch in batches:
            dims = batch.column(3).to_numpy()
            cell = np.zeros((batch.num_rows, DIMS), np.int32)
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                unit = _unit(_matrix(batch.column(2).take(pa.array(own)).to_pylist(), self.kind, dim))
                cell[own] = np.floor(_project(unit, self.basis) / self.eps)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(cell[:, i]) for i in range(DIMS))],
                                             names=[*batch.schema.names, *_boxes("c", DIMS)])

    def pack(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of consecutive vectors of one length, with their bounding boxes."""
        part, nth, held = TaskContext.get().partitionId(), 0, []

        def out(rows):
            nonlocal nth
            dim = rows[0][3]
            x = _coordinates(dim, _unit(_matrix([r[2] for r in rows], self.kind, dim)), self.basis)
            nth += 1
            return pa.RecordBatch.from_pylist([{
                "part": part, "nth": nth - 1, "dim": dim, "v": np.array([r[0] for r in rows], np.int64).tobytes(),
                "key": b"".join(r[1] for r in rows), "raw": b"".join(r[2] for r in rows),
                "times": np.array([r[4] for r in rows], np.int64).tobytes(),
                **dict(zip(LO, x.min(0).tolist())), **dict(zip(HI, x.max(0).tolist()))}], schema=PACKED)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if held and (len(held) == BLOCK or held[0][3] != row[3]):
                    yield out(held)
                    held = []
                held.append(row)
        if held:
            yield out(held)

    def join(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each pair of blocks: link sums by vector, and a spanning forest of the links."""
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                if row["dim_a"] == row["dim_b"]:
                    yield from self._pair(row)

    def _pair(self, row: dict) -> Iterator[pa.RecordBatch]:
        dim, same = row["dim_a"], row["a"] == row["b"]
        raw = [np.frombuffer(row[f"raw_{s}"], self.kind).reshape(-1, dim) for s in "ab"]
        times = [np.frombuffer(row[f"times_{s}"], np.int64) for s in "ab"]
        unit = [_unit(r) for r in raw]
        flat = [u.astype(np.float32) for u in unit]
        boxes = []
        for u in unit:
            x = _project(u, self.basis)
            at = np.arange(0, len(u), LEAF)
            boxes.append((np.minimum.reduceat(x, at), np.maximum.reduceat(x, at)))
        near = _apart(boxes[0][0][:, None], boxes[0][1][:, None], boxes[1][0][None], boxes[1][1][None]) <= self.eps**2
        if same:
            near &= np.triu(np.ones_like(near))
        n = [len(u) for u in unit]
        sums = [np.zeros(k, np.int64) for k in n]
        label = np.arange(n[0] + (0 if same else n[1]))
        shift = 0 if same else n[0]
        links = []
        for p, q in zip(*(x.tolist() for x in np.nonzero(near))):
            one, two = slice(p * LEAF, (p + 1) * LEAF), slice(q * LEAF, (q + 1) * LEAF)
            found = flat[0][one] @ flat[1][two].T >= self.cosine - 1e-4
            if same and p == q:
                found = np.triu(found, 1)
            i, j = np.nonzero(found)
            if not len(i):
                continue
            i, j = i + p * LEAF, j + q * LEAF
            x, y = raw[0][i].astype(np.float64), raw[1][j].astype(np.float64)
            if np.abs(x).max() > 1e100 or np.abs(x).max() < 1e-100 or np.abs(y).max() > 1e100 or np.abs(y).max() < 1e-100:
                x, y = unit[0][i], unit[1][j]
            good = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1))) >= self.cosine
            i, j = i[good], j[good]
            np.add.at(sums[0], i, times[1][j])
            np.add.at(sums[0 if same else 1], j, times[0][i])
            links.append((i, j + shift))
            keep = label[i] != label[j + shift]
            while keep.any():  # smallest label along this leaf's links
                low = np.minimum(label[i], label[j + shift])
                np.minimum.at(label, i, low)
                np.minimum.at(label, j + shift, low)
                keep = label[i] != label[j + shift]
        moved = True
        while moved and links:  # and across leaves
            moved = False
            for i, j in links:
                low = np.minimum(label[i], label[j])
                if (label[i] != low).any() or (label[j] != low).any():
                    moved = True
                    np.minimum.at(label, i, low)
                    np.minimum.at(label, j, low)
        for side in range(1 if same else 2):
            own = np.flatnonzero(sums[side])
            if len(own):
                v = [np.frombuffer(row[f"v_{s}"], np.int64) for s in "ab"]
                every = v[0] if same else np.concatenate(v)
                keys = row[f"key_{'ab'[side]}"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(v[side][own]), pa.array([keys[16 * k : 16 * k + 16] for k in own.tolist()], pa.binary()),
                    pa.array(sums[side][own]), pa.array(every[label[own + (shift if side else 0)]])], names=["v", "key", "n", "to"])


PACKED = pa.schema([("part", pa.int32()), ("nth", pa.int32()), ("dim", pa.int32()), ("v", pa.binary()), ("key", pa.binary()),
                    ("raw", pa.binary()), ("times", pa.binary()), *((c, pa.float64()) for c in LO + HI)])
PACKED_SQL = "part int, nth int, dim int, v binary, key binary, raw binary, times binary, " + ", ".join(f"{c} double" for c in LO + HI)


def _near_pairs(boxes: DataFrame, n_blocks: int, eps: float) -> DataFrame:
    """Pairs (a <= b) of blocks that are not provably distant, level by level from the top intervals."""
    spark, level = boxes.sparkSession, 0
    while n_blocks >> (4 * level) > FAN:
        level += 1
    top = (n_blocks - 1) >> (4 * level)
    pairs = spark.range(top + 1).select(F.col("id").alias("a"), F.explode(F.sequence("id", F.lit(top))).alias("b"))
    while True:
        at = boxes.groupBy(F.shiftright("block", 4 * level).alias("i")).agg(*(F.min(c).alias(c) for c in LO), *(F.max(c).alias(c) for c in HI))
        one, two = (at.select(F.col("i").alias(s), F.struct(*LO, *HI).alias(f"box_{s}")) for s in "ab")
        gap = [F.greatest(F.lit(0.0), F.col("box_a")[lo] - F.col("box_b")[hi], F.col("box_b")[lo] - F.col("box_a")[hi]) for lo, hi in zip(LO, HI)]
        pairs = pairs.join(one, "a").join(two, "b").where(sum((g * g for g in gap[1:]), gap[0] * gap[0]) <= eps * eps).select("a", "b")
        if not level:
            return pairs
        pairs = _store.land(pairs, "intervals")
        level -= 1
        child = lambda c: F.explode(F.sequence(F.col(c) * FAN, F.least(F.col(c) * FAN + FAN - 1, F.lit((n_blocks - 1) >> (4 * level)))))  # noqa: E731, B023
        pairs = pairs.select("b", child("a").alias("x")).select("x", child("b").alias("y")).where("x <= y").select(
            F.col("x").alias("a"), F.col("y").alias("b"))


def near_duplicates(table: DataFrame, cosine: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept, for every row of table (vec_id, embedding)."""
    single = table.schema["embedding"].dataType.elementType.simpleString() == "float"
    read, kind = _vectors(single)
    if not single:
        table = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    vectors = _store.land(table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
                          .mapInArrow(read, "vec_id long, key binary, raw binary, dim int"), "vectors")
    same = _store.land(vectors.where("key IS NOT NULL AND vec_id IS NOT NULL").groupBy("key")
                       .agg(F.min("vec_id").alias("v"), F.count("*").alias("times")), "same")
    reps = (vectors.withColumnRenamed("vec_id", "v").join(same, ["v", "key"]).dropDuplicates(["v", "key"])
            .select("v", "key", "raw", "dim", "times"))
    grid = GridJoin(cosine, kind, fit_basis(vectors, kind))
    cells = _boxes("c", DIMS)
    celled = _store.land(reps.mapInArrow(grid.cells, "v long, key binary, raw binary, dim int, times long, " + ", ".join(f"{c} int" for c in cells)), "cells")
    order = ["dim", *cells, "v", "key"]
    packed = _store.land(celled.repartitionByRange(*order).sortWithinPartitions(*order).select("v", "key", "raw", "dim", "times")
                         .mapInArrow(grid.pack, PACKED_SQL), "blocks")
    per_part = packed.groupBy("part").agg(F.count("*").alias("size"))  # one row per partition of the sort
    before = per_part.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    blocks = _store.land(packed.join(before, "part").withColumn("block", F.col("before") + F.col("nth")), "sequence")
    n_blocks = blocks.count()
    if n_blocks:
        pairs = _near_pairs(blocks.select("block", *LO, *HI), n_blocks, grid.eps)
        side = lambda s: blocks.select(F.col("block").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("dim", "v", "key", "raw", "times")))
        found = _store.land(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(grid.join, "v long, key binary, n long, to long"), "found")
    else:
        found = vectors.sparkSession.createDataFrame([], "v long, key binary, n long, to long")
    sums = found.groupBy("key").agg(F.sum("n").alias("others"))
    shared = vectors.where("key IS NOT NULL AND vec_id IS NOT NULL").join(same, "key").where("v <> vec_id")
    ids = shared.join(shared.groupBy("vec_id").agg(F.count_distinct("v").alias("roots")).where("roots > 1"), "vec_id").select(
        F.col("vec_id").alias("a"), F.col("v").alias("b"))
    label = _store.components(found.select(F.col("v").alias("a"), F.col("to").alias("b")).where("a <> b").union(ids).distinct())
    out = vectors.select("vec_id", "key").join(same, "key", "left").join(sums, "key", "left").join(label, "v", "left")
    linked = F.col("vec_id").isNotNull() & F.col("key").isNotNull()
    component = F.when(linked, F.coalesce("label", "v")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(linked, F.coalesce("others", F.lit(0)) + F.col("times") - 1).otherwise(0).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def op2_epsilon_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
