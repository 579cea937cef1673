"""Operator 1: MinHash near-duplicates with sequential Bayesian verification.

1. One vectorised pass over whole texts: the set of distinct 5-word shingles (64-bit hashes), its size, a 128-bit key of
   the set, and the band keys of its signature of ``HASHES`` minima. Equal sets are one vertex from here on (a keyed
   minimum, combined before the shuffle), so copies never meet in pairs. Signatures themselves are not shuffled here: those
   of the members of buckets are taken again in step 4's pass over their texts.
2. Banding: keys of as many minima as the threshold allows (``bands_for``). Two sets of similarity s share one of b bands
   of r minima with probability 1 - (1 - s^r)^b: above 0.9999 (``BAND_MISS``) for every pair at the threshold or above,
   with 20 bands of 6 at 0.85, 24 of 5 at 0.80, 22 of 3 at 0.70. ``HASHES`` minima reach that from 0.08 up; a lower
   threshold is an error. Every member of a bucket is paired with the bucket's centre.
3. Sequential verification: signatures are compared in batches; after each, a pair is pruned when the posterior
   probability (uniform prior) that its similarity reaches the threshold falls below ``MISS``.
4. Survivors are confirmed on their full shingle sets, recomputed from the texts. Only confirmed pairs are links.
5. Components of the links. In each bucket whose members are not all in one component, everything outside its largest
   component is compared with all members: both are cut into blocks of bounded size, and each pair of blocks goes
   through step 3 as a matrix of signatures, for the pairs whose first shared band this is. The full sets are joined to
   the members that still have a partner, and step 4 gives one link for each two components that meet. So only pairs
   that share a bucket are compared, once; pairs within the largest component, which is most of a group of copies, are
   never formed, the others never become rows, and no task holds more than two blocks.

Defined results: texts without words (null, empty, white space) have n_shingles 0 and link with nothing; fewer than five words
form one shingle; rows that share a doc_id count as one document, each row gets a result; a null doc_id links
with nothing, has a null component and is kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import _store, _text

WIDTH = 5
HASHES = 120
BAND_MISS = 1e-4
BATCH = 20
MISS = 1e-6
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 18

_rng = np.random.default_rng(5)
_times = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_plus = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)
_band_times = _rng.integers(0, 2**64, HASHES, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    b = _text.Block(texts, lower=True)
    h = b.word_hash()
    at, sh = _text.windows(h, b.first, WIDTH)
    cut = np.searchsorted(at, b.first)
    out = []
    for d, n in enumerate(np.diff(b.first).tolist()):
        if n >= WIDTH:
            out.append(np.unique(sh[cut[d] : cut[d + 1]]))
        elif n:
            own = h[b.first[d] : b.first[d + 1]] * _text.powers(0x9FB21C651E98DF25, n + 1)[1:]
            out.append(_text.mix(own.sum(keepdims=True, dtype=np.uint64) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        one, two = s.sum(dtype=np.uint64) + np.uint64(len(s)), _text.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def signature(s: np.ndarray) -> np.ndarray:
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 2**32 - 1, np.uint32)
    for i in range(0, len(x), 4096):
        np.minimum(out, (x[i : i + 4096] * _times[:, None] + _plus[:, None]).min(1), out=out)
    return out


def band_keys(sigs: np.ndarray, bands: int, length: int) -> np.ndarray:
    """A 64-bit key for each band of each signature (one per row); the band's number is part of it."""
    one = sigs[:, : bands * length].reshape(-1, bands, length).astype(np.uint64)
    total = (one * _band_times[: bands * length].reshape(bands, length)).sum(2, dtype=np.uint64)
    return _text.mix(total + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _features(bands: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _text.blocks(batches):
            sets = shingle_sets(texts)
            ids = [set_key(s) for s in sets]
            some = [s for s in sets if len(s)]
            found = iter(band_keys(np.stack([signature(s) for s in some]), bands, length).view(np.int64) if some else ())
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([k[0] for k in ids], pa.int64()), pa.array([k[1] for k in ids], pa.int64()),
                pa.array([next(found) if len(s) else np.zeros(0, np.int64) for s in sets], pa.list_(pa.int64())),
            ], names=["doc_id", "n", "k1", "k2", "keys"])
    return run


def bands_for(percent: int) -> tuple[int, int]:
    """Bands and rows: the longest bands of which ``HASHES`` minima hold enough that a pair of this similarity misses all of them
    with probability ``BAND_MISS`` at most."""
    for rows in range(HASHES, 0, -1):
        share = (percent / 100) ** rows
        bands = 1 if share >= 1 else ceil(log(BAND_MISS) / log1p(-share)) if share > 1e-12 else HASHES + 1
        if bands * rows <= HASHES:
            return bands, rows
    raise ValueError(f"{HASHES} minima do not reach a similarity of {percent}%")


def least_matches(threshold: float, miss: float = MISS) -> list[int]:
    """For 0, BATCH, 2 BATCH .. hashes: the fewest matches at which the posterior of reaching the threshold is >= miss."""
    grid = np.linspace(0, 1, 20001)[1:-1]
    out = [0]
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            weight = np.exp(m * np.log(grid) + (n - m) * np.log1p(-grid) - max(m * log(max(m / n, 1e-9)) + (n - m) * log(max(1 - m / n, 1e-9)), -700))
            if weight[grid >= threshold].sum() >= miss * weight.sum():
                out.append(m)
                break
    return out


def _prune(least: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                one, two = (np.frombuffer(part.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int32), np.int32).reshape(-1, HASHES) for i in (2, 3))
                alive, match = np.arange(part.num_rows), np.zeros(part.num_rows, int)
                for k in range(BATCH, HASHES + 1, BATCH):
                    match[alive] += (one[alive, k - BATCH : k] == two[alive, k - BATCH : k]).sum(1)
                    alive = alive[match[alive] >= least[k // BATCH]]
                yield part.take(pa.array(alive)).select(["a", "b"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in _text.blocks(batches):
        sets = shingle_sets(texts)
        keys = [set_key(s) for s in sets]
        yield pa.RecordBatch.from_arrays([
            part.column(0), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
            pa.array([signature(s).view(np.int32) for s in sets], pa.list_(pa.int32())),
            pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["v", "k1", "k2", "sig", "shingles"])


def _meet(least: list[int], bands: int, length: int):
    """Pairs of blocks of one bucket -> the members of both that have a partner left after pruning. A pair that shares several bands
    is looked at in the bucket of the first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, two = (batch.column(k)[i].values for k in (4, 5))
                v, label = ([x.field(f).to_numpy() for x in (one, two)] for f in ("v", "label"))
                sig = [x.field("sig").flatten().to_numpy().reshape(-1, HASHES) for x in (one, two)]
                alive = label[0][:, None] != label[1][None]
                for j in range(batch.column(1)[i].as_py() + 1):
                    if not alive.any():
                        break
                    same = np.ones(alive.shape, bool)
                    for h in range(j * length, (j + 1) * length):
                        same &= sig[0][:, h, None] == sig[1][None, :, h]
                    alive &= same if j == batch.column(1)[i].as_py() else ~same
                match = np.zeros(alive.shape, np.int16)
                for k in range(BATCH, HASHES + 1, BATCH):
                    if alive.any():
                        for j in range(k - BATCH, k):
                            match += sig[0][:, j, None] == sig[1][None, :, j]
                        alive &= match >= least[k // BATCH]
                left = [np.unique(np.stack([x[at], y[at]], 1), axis=0) for x, y, at in zip(v, label, (alive.any(1), alive.any(0)))]
                n = [len(x) for x in left]
                if not n[0]:
                    continue
                both = np.concatenate(left)
                yield pa.RecordBatch.from_arrays([
                    *(pa.array(np.full(sum(n), batch.column(k)[i].as_py()), batch.column(k).type) for k in (0, 2, 3)), pa.array(np.repeat([True, False], n)),
                    pa.array(both[:, 0]), pa.array(both[:, 1])], names=["key", "p", "q", "first", "v", "label"])
    return run


def _confirm(percent: int):
    """Pairs of blocks with their full sets -> one link for each two components that meet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, two = (batch.column(k)[i].values for k in range(2))
                v, label = ([x.field(f).to_numpy() for x in (one, two)] for f in ("v", "label"))
                alive = label[0][:, None] != label[1][None]
                sets = [x.field("shingles") for x in (one, two)]
                size = [np.diff(x.offsets.to_numpy()) for x in sets]
                flat = [x.flatten().to_numpy() for x in sets]
                owner = [np.repeat(np.arange(len(n)), n) for n in size]
                common = np.intersect1d(*flat)
                held = []
                for f, o in zip(flat, owner):
                    at = np.minimum(np.searchsorted(common, f), max(len(common) - 1, 0))
                    hit = common[at] == f if len(common) else np.zeros(len(f), bool)
                    held.append((at[hit], o[hit]))
                shared = np.zeros(alive.shape, np.float32)
                for lo in range(0, len(common), 4096):
                    part = []
                    for (at, o), n in zip(held, size):
                        own = (at >= lo) & (at < lo + 4096)
                        x = np.zeros((len(n), min(4096, len(common) - lo)), np.float32)
                        x[o[own], at[own] - lo] = 1
                        part.append(x)
                    shared += part[0] @ part[1].T
                shared = shared.astype(np.int64)
                alive &= 100 * shared >= percent * (size[0][:, None] + size[1][None] - shared)
                p, q = np.nonzero(alive)
                _, first = np.unique(np.stack([label[0][p], label[1][q]], 1), axis=0, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(v[0][p[first]]), pa.array(v[1][q[first]])], names=["a", "b"])
    return run


def open_blocks(named: DataFrame, sets: DataFrame) -> DataFrame:
    """key, band, p, q, one, two: the members of open buckets (key, band, v, label) outside their bucket's largest component, and all
    members of the same bucket, as pairs of blocks of bounded size, with signatures only."""
    weight = sets.groupBy("v").agg(F.max(F.size("shingles")).alias("weight"))
    by_label = named.join(weight, "v").groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    by_label = _store.land(by_label, "bucket-components")
    body = by_label.groupBy("key").agg(F.max(F.struct("n", "label"))["label"].alias("body"), F.sum("n").alias("n"), F.sum("w").alias("w"))
    other = by_label.join(body.select("key", "body"), "key").where("label != body").groupBy("key").agg(F.sum("n").alias("on"), F.sum("w").alias("ow"))
    parts = lambda n, w: F.greatest(F.ceil(F.col(n) / BLOCK_SETS), F.ceil(F.col(w) / BLOCK_SHINGLES))
    cut = body.join(other, "key").select("key", "body", parts("n", "w").alias("parts"), parts("on", "ow").alias("outer"))
    full = named.join(cut, "key").join(sets.select("v", "sig"), "v").select(
        "key", "band", F.expr("int(pmod(xxhash64(v), outer))").alias("p"), F.expr("int(pmod(xxhash64(v), parts))").alias("q"), "v", "label", "sig",
        (F.col("label") != F.col("body")).alias("outside"))
    full = _store.land(full, "full")
    packed = F.collect_list(F.struct("v", "label", "sig"))
    outside = full.where("outside").groupBy("key", "band", "p").agg(packed.alias("one"))
    every = full.groupBy("key", "q").agg(packed.alias("two"))
    return outside.join(every, "key").select("key", "band", "p", "q", "one", "two")


def _open_links(blocks: DataFrame, sets: DataFrame, least: list[int], percent: int) -> DataFrame:
    """Links (a, b) between the components that meet in a bucket; full sets are joined to what pruning leaves."""
    left = _store.land(blocks.mapInArrow(_meet(least, *bands_for(percent)), "key long, p int, q int, first boolean, v long, label long"), "meeting")
    packed = lambda side: F.collect_list(F.when(F.expr(side), F.struct("v", "label", "shingles")))
    held = left.join(sets.select("v", "shingles"), "v").groupBy("key", "p", "q").agg(
        packed("first").alias("one"), packed("NOT first").alias("two"))
    return held.select("one", "two").mapInArrow(_confirm(percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, for every row of docs (doc_id, text). A pair at ``percent`` shares a band with
    probability 0.9999 or more, whatever the percent."""
    bands, length = bands_for(percent)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    feats = _store.land(docs.mapInArrow(_features(bands, length), "doc_id long, n long, k1 long, k2 long, keys array<long>"), "features")
    some = feats.where("n > 0 AND doc_id IS NOT NULL")
    reps = _store.land(some.groupBy("k1", "k2").agg(F.min("doc_id").alias("v"), F.any_value("keys").alias("keys")), "representatives")
    rows = _store.land(feats.select("doc_id", "n", "k1", "k2").join(reps.select("k1", "k2", "v"), ["k1", "k2"], "left"), "rows")
    # rows that share a doc_id are one document, whatever their texts
    again = _store.land(rows.where("v IS NOT NULL").groupBy("doc_id").agg(F.min("v").alias("x"), F.max("v").alias("y"), F.count("*").alias("times"))
                 .where("times > 1").select("doc_id", "x", "y"), "repeated")
    several = again.where("x != y").select("doc_id")
    shared = rows.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("v").alias("b")).where("a != b")

    banded = reps.select("v", F.posexplode("keys").alias("band", "key"))
    buckets = banded.groupBy("key").agg(F.min("v").alias("centre"), F.max("v").alias("last")).where("centre != last")
    buckets = _store.land(buckets.select("key", "centre"), "bucket-centres")
    members = _store.land(_store.sieve(banded, "key", buckets.select("key")).join(buckets, "key"), "buckets")

    # the full sets and signatures of all members, recomputed from their texts
    wanted = _store.land(members.select("v").distinct(), "members")
    texts = _store.sieve(docs, "doc_id", wanted).join(wanted.withColumnRenamed("v", "doc_id"), "doc_id")
    sets = texts.mapInArrow(_sets, "v long, k1 long, k2 long, sig array<int>, shingles array<long>")
    if not again.isEmpty():  # a doc_id with several rows: only the sets it stands for, each once
        sets = sets.join(reps.select("v", "k1", "k2"), ["v", "k1", "k2"], "left_semi").dropDuplicates(["v", "k1", "k2"])
    sets = _store.land(sets.select("v", "sig", "shingles"), "sets")
    _store.give_back(feats, reps, buckets, wanted)

    least = least_matches(percent / 100)
    pairs = members.where("v != centre").select(F.col("centre").alias("a"), F.col("v").alias("b")).distinct()
    near = (pairs.join(sets.select(F.col("v").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sets.select(F.col("v").alias("b"), F.col("sig").alias("sb")), "b")
            .select("a", "b", "sa", "sb").mapInArrow(_prune(least), "a long, b long"))
    near = _store.land(near.distinct(), "survivors")
    both = (near.join(sets.select(F.col("v").alias("a"), F.col("shingles").alias("one")), "a")
            .join(sets.select(F.col("v").alias("b"), F.col("shingles").alias("two")), "b"))
    common = F.size(F.array_intersect("one", "two"))
    links = both.where(100 * common >= percent * (F.size("one") + F.size("two") - common)).select("a", "b")
    links = _store.land(shared.unionByName(links).distinct(), "links")
    label = _store.components(links)

    named = members.join(label, "v", "left").select("key", "band", "v", F.coalesce("label", "v").alias("label"))
    unlike = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("key")
    named = _store.land(named.join(unlike, "key", "left_semi"), "open")
    if not named.isEmpty():
        more = _open_links(open_blocks(named, sets), sets, least, percent)
        label = _store.components(_store.land(links.unionByName(more), "links"))
    _store.give_back(members, sets, near)  # what is returned reads rows and label only, both landed

    out = rows.join(label, "v", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "v", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of docs, with all their columns, that are the first of their group (by doc_id; one row per doc_id).
    Rows without a doc_id stay. Only rows whose doc_id may lose one are shuffled; a bitmap tells them from the others."""
    found = near_duplicates(docs, percent).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("times"))
    loses = _store.land(found.where("NOT kept OR times > 1"), "verdicts")
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*(f"`{c}`" for c in docs.columns)).alias("row"))
    flagged = _store.maybe(known, "doc_id", loses.select("doc_id"), "may_lose")
    some = flagged.where("may_lose").join(loses, "doc_id", "left")
    stay = some.where("times IS NULL OR (kept AND times = 1)").select("row")
    once = some.where("kept AND times > 1").dropDuplicates(["doc_id"]).select("row")
    return flagged.where("NOT may_lose").select("row").unionByName(stay).unionByName(once).select("row.*")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_store.documents(spark, sf_dir, "doc_id", "text"))
