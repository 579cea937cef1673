"""Operator 4: suffix-array dedup by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Removes every byte covered by a string of ``length`` bytes that also starts anywhere else in the corpus.

Partitioning. Every start of a ``length``-byte string is dealt to the block that can decide on it: its anchor is the
(leftmost) smallest hash among the ``GRAM``-byte grams inside the string. Equal strings have equal anchors. The
consecutive starts of one anchor and the bytes of their strings are a context. Anchors that occur once are dropped; equal
contexts are one context with a multiplicity (all strings of a context met twice repeat), so copies are
summed before anything gathers them.

Method. Distinct contexts of the same anchor go to the same task and are concatenated into blocks of bounded size. Over a
block's suffix array the Burrows-Wheeler transform is taken, and intervals of suffixes are extended backward breadth-first:
level l holds the intervals of strings of l bytes whose right boundary was found at that level, and gives the
boundaries between suffixes with exactly l common bytes. The expansion stops at ``length``: suffixes that no boundary
separates by then share ``length`` bytes or more.

Hot anchors (more than ``HOT`` distinct contexts, such as the edges of a passage that a third of all documents share) are
not gathered: each of their strings becomes a row with a 128-bit hash, and rows with equal hashes are summed.

Defined results: a null or empty text has no bytes; texts shorter than ``length`` lose nothing; rows with the same doc_id
and text are two occurrences of that text; a null doc_id stays null; an empty table gives an empty result; columns other than
doc_id and text are carried along by ``remove_repeats`` and not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import _store, _text

GRAM = 32
BLOCK_BYTES = 1 << 20
HOT = BLOCK_BYTES // 256  # contexts of one anchor that about fill a block
COMMON, SHARES = 1024, 256  # a context met so often is joined in so many shares
U64 = np.uint64
_SECOND = 0xA0761D6478BD642F
_SECOND_INVERSE = pow(_SECOND, -1, 1 << 64)


def _prefix(buf: np.ndarray, base: int) -> np.ndarray:
    total = np.zeros(len(buf) + 1, U64)
    np.cumsum(_text._byte_value[buf] * _text.powers(base, len(buf)), out=total[1:])
    return total


def contexts(texts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """All contexts of some texts: number of the text, first start in it, number of starts, anchor and context hashes."""
    none = np.zeros(0, np.int64)
    data = b"\n".join(texts) + b"\n"
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offset = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    if len(texts) == 0 or sizes.max() < length:
        return {"text": none, "start": none, "n": none, "anchor": none, "context": none}
    buf = np.frombuffer(data, np.uint8)
    total = _prefix(buf, _text._BASE)
    back = _text.powers(_text._INVERSE, len(buf))
    grams = len(buf) - GRAM + 1
    gram = _text.mix((total[GRAM:] - total[:-GRAM]) * back[:grams])
    least = (gram & U64(0xFFFFFFFF00000000)) | np.arange(grams, dtype=U64)
    width, have = length - GRAM + 1, 1
    while have < width:  # minimum over ``width`` grams from minima over powers of two; the position breaks ties
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    anchor = (least & U64(0xFFFFFFFF)).astype(np.int64)
    counts = np.maximum(sizes - length + 1, 0)
    text = np.repeat(np.arange(len(texts)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = offset[text] + within
    own = anchor[at]
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (text[1:] != text[:-1])]))
    n = np.diff(np.append(first, len(own)))
    begin = at[first]
    end = begin + n - 1 + length
    context = _text.mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(U64))
    return {"text": text[first], "start": within[first], "n": n, "anchor": gram[own[first]].view(np.int64), "context": context.view(np.int64)}


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _text.blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(contexts(texts, length)["anchor"])], names=["anchor"])
    return run


def _occurrences(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _text.blocks(batches):
            found = contexts(texts, length)
            ref, tag = (part.column(part.schema.get_field_index(c)).to_numpy() for c in ("ref", "tag"))
            yield pa.RecordBatch.from_arrays([
                pa.array(found["anchor"]), pa.array(found["context"]), pa.array(ref[found["text"]]),
                pa.array(tag[found["text"]] << 47 | found["start"] << 16 | found["n"])], names=["anchor", "context", "ref", "place"])
    return run


PLACE = {"tag": "shiftright(place, 47)", "start": f"shiftright(place, 16) & {(1 << 31) - 1}", "n": "place & 65535"}


def suffix_array(symbol: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; symbols 0..257. Only suffixes that are still tied are sorted again."""
    n = len(symbol)
    s = np.concatenate([symbol.astype(np.int64) + 1, np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = (key << 9) | s[k : k + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = head
    step = 7
    while True:
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        own = order[at]
        follow = own + step
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        key = (rank[own] << 32) | second
        again = np.argsort(key, kind="stable")
        own, key = own[again], key[again]
        order[at] = own
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        new[at] |= fresh
        rank[own] = at[np.maximum.accumulate(np.where(new[at], np.arange(len(at)), 0))]
        step *= 2


def unseparated(symbol: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True at i if suffixes i - 1 and i of the suffix array share at least ``length`` symbols (the last symbol is
    an end mark, smaller than all others).

    Breadth-first backward extension: an interval [lo, hi) holds all suffixes with some prefix w; those preceded by
    c lie in the interval of c + w, found through the last-to-first mapping of the transform.
    """
    n = len(symbol)
    order = order.astype(np.int32)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    bwt, last_first = symbol[order - 1], place[order - 1]  # the end mark precedes the whole text
    by = np.argsort(bwt, kind="stable")
    same = bwt[by[1:]] == bwt[by[:-1]]
    following, leading = np.full(n, n, np.int32), np.full(n, -1, np.int32)  # next and previous rows with the same symbol
    following[by[:-1][same]] = by[1:][same]
    leading[by[1:][same]] = by[:-1][same]
    unset = np.ones(n + 1, bool)
    unset[[0, n]] = False
    lo, hi = np.array([0]), np.array([n])
    for _ in range(length):
        size = hi - lo
        base = np.cumsum(size) - size
        row = np.arange(size.sum()) + np.repeat(lo - base, size)
        end, begin = np.repeat(hi, size), np.repeat(lo, size)
        is_last = following[row] >= end
        is_first = leading[row] < begin
        # the symbols of an interval, in one order for both ends
        owner = np.repeat(np.arange(len(lo)), size)
        last, first = row[is_last], row[is_first]
        last = last[np.lexsort((bwt[last], owner[is_last]))]
        first = first[np.lexsort((bwt[first], owner[is_first]))]
        new_hi, new_lo = last_first[last] + 1, last_first[first]
        fresh = unset[new_hi]
        lo, hi = new_lo[fresh], new_hi[fresh]
        unset[hi] = False
        if not len(lo):
            break
    return unset[:n]


def repeated_starts(rows: list[tuple[bytes, int, int]], length: int) -> list[np.ndarray]:
    """For contexts (bytes, number of starts, multiplicity): the starts of each whose strings occur at least twice."""
    sizes = np.array([len(r[0]) + 1 for r in rows])
    begin = np.cumsum(sizes) - sizes
    sizes[-1] += 1
    symbol = np.ones(int(sizes.sum()), np.int32)  # a separator after each context, the end mark after all
    inside = np.ones(len(symbol), bool)
    inside[begin + [len(r[0]) for r in rows]] = False
    symbol[-1], inside[-1] = 0, False
    symbol[inside] = np.frombuffer(b"".join(r[0] for r in rows), np.uint8).astype(np.int32) + 2
    order = suffix_array(symbol)
    group = np.cumsum(~unseparated(symbol, order, length))
    owner = np.repeat(np.arange(len(rows)), sizes)
    starts = np.array([r[1] for r in rows])
    valid = (np.arange(len(symbol)) - begin[owner]) < starts[owner]
    times = np.where(valid, np.array([r[2] for r in rows])[owner], 0)
    total = np.bincount(group, times[order])
    hit = np.zeros(len(symbol), bool)
    hit[order] = total[group] >= 2
    hit &= valid
    return [np.flatnonzero(hit[b : b + k]) for b, k in zip(begin.tolist(), starts.tolist())]


def _runs(at: np.ndarray) -> list[tuple[int, int]]:
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 1)
    return list(zip(at[np.concatenate([[0], cut + 1])].tolist(), at[np.append(cut, len(at) - 1)].tolist()))


SPAN = "ref long, tag long, lo long, hi long"


def _expand(length: int):
    """Sorted by anchor: (anchor, context, times, ref, tag, start, n, body) -> spans of starts of the contexts met once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last, seen = [], 0, None, set()

        def out() -> pa.RecordBatch:
            found = repeated_starts([(r[7], r[6], r[2]) for r in held], length)
            rows = [(r[3], r[4], r[5] + a, r[5] + b) for r, at in zip(held, found) if r[2] == 1 for a, b in _runs(at)]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], pa.int64()) for i in range(4)], names=["ref", "tag", "lo", "hi"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != last:
                    if size >= BLOCK_BYTES:
                        yield out()
                        held, size = [], 0
                    last, seen = row[0], set()
                if row[1] not in seen:  # a row of documents that is there twice brings its contexts twice
                    seen.add(row[1])
                    held.append(row)
                    size += len(row[7])
        if held:
            yield out()
    return run


def _strings(length: int):
    """Hot contexts -> a row per string: (h1, h2, times, ref, tag, at)."""
    names = ["h1", "h2", "times", "ref", "tag", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                buf, n = np.frombuffer(row[7], np.uint8), row[6]
                h = [_text.mix((t[length : length + n] - t[:n]) * _text.powers(inv, n)).view(np.int64)
                     for t, inv in ((_prefix(buf, _text._BASE), _text._INVERSE), (_prefix(buf, _SECOND), _SECOND_INVERSE))]
                yield pa.RecordBatch.from_arrays([pa.array(h[0]), pa.array(h[1]), *(pa.array(np.full(n, v, np.int64)) for v in (row[2], row[3], row[4])),
                                                  pa.array(row[5] + np.arange(n))], names=names)
    return run


def _bodies(length: int):
    """(text, wanted contexts) -> a row per context with its bytes."""
    kind = pa.schema([*((c, pa.int64()) for c in ("anchor", "context", "times", "ref", "tag", "start", "n")), ("body", pa.binary()), ("hot", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _text.blocks(batches):
            rows = [{**w, "body": t[w["start"] : w["start"] + w["n"] - 1 + length]}
                    for t, want in zip(texts, part.column(part.schema.get_field_index("wanted")).to_pylist()) for w in want]
            for lo in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_pylist(rows[lo : lo + 4096], schema=kind)
    return run


def _spread(seen: DataFrame, contexts: DataFrame, merged: DataFrame) -> DataFrame:
    """seen joined to contexts on both hashes. Occurrences of a context met ``COMMON`` times or more are dealt over ``SHARES`` keys,
    and that context is repeated for each; which contexts these may be, both sides read from one bitmap."""
    common = merged.where(F.col("times") >= COMMON).select("context")
    left = _store.maybe(seen, "context", common, "common").withColumn(
        "share", F.when(F.col("common"), F.pmod(F.xxhash64("ref", "place"), F.lit(SHARES))).otherwise(0)).drop("common")
    right = _store.maybe(contexts, "context", common, "common").withColumn(
        "share", F.explode(F.when(F.col("common"), F.sequence(F.lit(0).cast("long"), F.lit(SHARES - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long"))))).drop("common")
    return left.join(right, ["anchor", "context", "share"]).drop("share")


def repeated_spans(docs: DataFrame, length: int = 200, scratch: list[str] | None = None) -> DataFrame:
    """ref, tag, spans: the runs [lo, hi] of starts of repeated strings, per document that has any (docs: ref, tag, text)."""
    if not GRAM < length < 32768:
        raise ValueError(f"length must be above {GRAM} and below 32768")
    again = _store.land(docs.select("text").mapInArrow(_anchors(length), "anchor long").groupBy("anchor")
                        .agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors", scratch)
    every = docs.select("ref", "tag", "text").mapInArrow(_occurrences(length), "anchor long, context long, ref long, place long")
    seen = _store.land(_store.sieve(every, "anchor", again).join(again, "anchor"), "occurrences", scratch)
    merged = _store.land(seen.groupBy("anchor", "context").agg(F.count("*").alias("times"),
                                                                F.min("ref").alias("ref"), F.min("place").alias("place")), "contexts", scratch)
    kinds = merged.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    # the place of a context met twice must belong to the ref: one occurrence is looked up for those that are compared
    compared = _store.land(merged.join(kinds, "anchor").select("anchor", "context", "times", "ref", "place", (F.col("kinds") > HOT).alias("hot")), "compared", scratch)
    once = compared.where("times = 1")
    more = (_spread(seen, compared.where("times > 1").select("anchor", "context", "times", "hot"), merged)
            .groupBy("anchor", "context", "times", "hot").agg(F.min(F.struct("ref", "place")).alias("o"))
            .select("anchor", "context", "times", "o.ref", "o.place", "hot"))
    wanted = _store.land(once.unionByName(more).select("anchor", "context", "times", "ref", *(F.expr(c).alias(k) for k, c in PLACE.items()), "hot")
              .groupBy("ref", "tag").agg(F.collect_list(F.struct("anchor", "context", "times", "ref", "tag", "start", "n", "hot")).alias("wanted")), "wanted", scratch)
    bodies = _store.land(_store.sieve(docs.select("ref", "tag", "text"), "ref", wanted.select("ref")).join(wanted, ["ref", "tag"]).mapInArrow(
        _bodies(length), "anchor long, context long, times long, ref long, tag long, start long, n long, body binary, hot boolean"), "bodies", scratch)
    fields = ["anchor", "context", "times", "ref", "tag", "start", "n", "body"]
    cold = bodies.where("NOT hot").select(*fields).repartition("anchor").sortWithinPartitions("anchor", "context").mapInArrow(_expand(length), SPAN)
    spans = [cold]
    hot = bodies.where("hot").select(*fields).dropDuplicates(["anchor", "context"])
    if not bodies.where("hot").isEmpty():
        strings = _store.land(hot.mapInArrow(_strings(length), "h1 long, h2 long, times long, ref long, tag long, at long"), "strings", scratch)
        twice = strings.groupBy("h1", "h2").agg(F.sum("times").alias("all")).where("all > 1").select("h1", "h2")
        spans.append(strings.where("times = 1").join(twice, ["h1", "h2"]).select("ref", "tag", F.col("at").alias("lo"), F.col("at").alias("hi")))
    whole = _spread(seen, merged.where("times > 1").select("anchor", "context"), merged).select(
        "ref", F.expr(PLACE["tag"]).alias("tag"), F.expr(PLACE["start"]).alias("lo"), F.expr(f"({PLACE['start']}) + ({PLACE['n']}) - 1").alias("hi"))
    spans.append(whole)
    every = spans[0]
    for more_spans in spans[1:]:
        every = every.unionByName(more_spans)
    return every.groupBy("ref", "tag").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans"))


def covered(spans: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal removed runs [from, to) of sorted spans of starts."""
    out: list[tuple[int, int]] = []
    for s in spans or ():
        lo, hi = s["lo"], s["hi"] + length
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _keep(text: bytes, removed: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for lo, hi in removed:
        parts.append(text[at:lo])
        at = hi
    return b"".join([*parts, text[at:]])


def with_spans(docs: DataFrame, length: int = 200) -> DataFrame:
    """row (a struct of all columns of docs but text), text and spans, for every row. Rows are found again by hashes of
    doc_id and text (80 bits together)."""
    known = docs.select(F.struct(*(f"`{c}`" for c in docs.columns if c != "text")).alias("row"), "text", F.xxhash64("doc_id", "text").alias("ref"),
                        F.hash("text", F.lit(7)).cast("long").bitwiseAND(65535).alias("tag"))
    scratch: list[str] = []
    spans = _store.land(repeated_spans(known.select("ref", "tag", "text"), length, scratch), "spans")
    _store.drop(docs.sparkSession, scratch)
    flagged = _store.maybe(known, "ref", spans.select("ref"), "may_have")  # texts that surely have none are not shuffled
    have = flagged.where("may_have").join(spans, ["ref", "tag"], "left").select("row", "text", "spans")
    return have.unionByName(flagged.where("NOT may_have").select("row", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")))


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """docs with every repeated string cut out of ``text`` (a cut inside a character drops the rest of it)."""
    names = docs.columns
    others = [c for c in names if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _text.blocks(batches):
            null = part.column(1).is_null().to_pylist()
            kept = [None if none else _keep(t, covered(s, length)).decode("utf-8", "ignore")
                    for t, s, none in zip(texts, part.column(2).to_pylist(), null)]
            columns = dict(zip(others, part.column(0).flatten())) | {"text": pa.array(kept, pa.string())}
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return with_spans(docs, length).mapInArrow(run, docs.schema)


def digest(docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _text.blocks(batches):
            removed = [covered(s, length) for s in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                part.column(0).field(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([sum(hi - lo for lo, hi in r) for r in removed], pa.int64()),
                pa.array([len(r) for r in removed], pa.int64()),
                pa.array([hashlib.sha256(_keep(t, r)).hexdigest() for t, r in zip(texts, removed)], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_spans(docs.select("doc_id", "text"), length).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op4_bwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(_store.documents(spark, sf_dir, "doc_id", "text"))
