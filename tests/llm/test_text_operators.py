"""Quality trees, attention classifier, packing, records, merge replay against brute force or exact round trips."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stayflow.llm import _text, _tokens, attention_mil, histogram_packing, merge_replay, quality_trees, record_files

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n \t", "one", "word " * 3000, "a\n\nb\na\n \nb", "é́ ñ ß İ ΣΑΣ 中文 ² x²—“q”", "it's I'll '' 'd", "<|endoftext|> a<|endoftext|>b",
       "\x01 a\x01b \x1c \x85   \x0b\x0c", "#a *b $c %d &e |f <g >h", "x" * 40000, "😀😀 ‍ 12.5% http://a.b/c?d=1", "a b c d e f g h " * 5]


def all_texts(spark):
    return ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]


# --- quality trees -----------------------------------------------------------------------------------------------


def rules(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), len(w) < 20 or 100 * len(again) > 30 * len(w))


def test_base_rules_match_brute_force(spark, make_docs):
    texts = all_texts(spark)
    out = {r.doc_id: r for r in quality_trees.judge(make_docs(list(enumerate(texts)), extra=True), None).collect()}
    for i, t in enumerate(texts):
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == rules(t)
        assert r.kept == (not r.base_failed)


def test_trees_learn_and_obey_their_constraints():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = (rng.random(3000) < 1 / (1 + np.exp(-(4 - 8 * x[:, 0] + 2 * np.sin(9 * x[:, 1]))))).astype(float)
    trees = quality_trees.grow(x, y, np.array([-1, 0, 0]))
    assert ((trees.score(x) > 0.5) == y).mean() > 0.8
    for row in rng.random((50, 3)):
        line = np.repeat(row[None], 200, 0)
        line[:, 0] = np.linspace(-1, 2, 200)
        assert (np.diff(trees.score(line)) <= 1e-12).all()


def test_flat_arrays_equal_a_walk_of_each_tree():
    rng = np.random.default_rng(1)
    x = rng.random((400, 4))
    trees = quality_trees.grow(x, (x[:, 0] > x[:, 1]).astype(float), np.zeros(4, int), n_trees=8)
    for row, score in zip(x, trees.score(x)):
        total = trees.base
        for node in trees.roots.tolist():
            while trees.left[node]:
                node = trees.left[node] + int(row[trees.feature[node]] > trees.threshold[node])
            total += trees.value[node]
        assert abs(score - 1 / (1 + np.exp(-total))) < 1e-12


def test_quality_edge_tables(spark, make_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality_trees.train(make_docs([(1, "a")]), labels) is None  # one class only
    assert quality_trees.judge(make_docs([]), None).count() == 0
    assert quality_trees.keep_good(make_docs([(None, "w " * 10 + " ".join(map(str, range(30)))), (2, None)]), None).count() == 1
    assert attention_mil.train(make_docs([(1, "a")]), labels) is None
    out = attention_mil.classify(make_docs([(None, None), (3, "")]), labels).collect()
    assert [(r.score, r.predicted) for r in out] == [(0.5, 1)] * 2
    assert attention_mil.classify(make_docs([]), labels).count() == 0


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = [r for r in attention_mil.op3_quality_classifier(spark, sf).collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in out)
    held = [(truth[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.93
    kept = [(truth[r.doc_id], r.kept) for r in quality_trees.op8_quality_rules(spark, sf).collect() if r.doc_id in truth]
    assert sum(a == b for a, b in kept) / len(kept) > 0.93


def test_attention_gradients():
    rng = np.random.default_rng(2)
    p = attention_mil.start_weights(rng)
    p["c"] = rng.normal(size=attention_mil.HIDDEN)
    n = np.array([2, 0, 3, 1])
    x, y = rng.normal(size=(6, attention_mil.WIDTH)), np.array([1.0, 0, 0, 1])

    def loss():
        z = attention_mil.forward(p, x, n)[0]
        return (np.log1p(np.exp(z)) - y * z).sum()

    z, kept = attention_mil.forward(p, x, n)
    g = attention_mil.gradients(p, x, attention_mil._sigmoid(z) - y, kept)
    for k in p:
        at = tuple(rng.integers(0, s) for s in p[k].shape)
        p[k][at] += 1e-5
        up = loss()
        p[k][at] -= 2e-5
        down = loss()
        p[k][at] += 1e-5
        assert abs((up - down) / 2e-5 - g[k][at]) < 1e-4


def test_passages_do_not_depend_on_the_block():
    texts = [(t or "").encode() for t in ODD]
    x, n = attention_mil.passages(texts)
    alone = [attention_mil.passages([t]) for t in texts]
    assert n.tolist() == [int(a[1][0]) for a in alone]
    assert np.allclose(x, np.concatenate([a[0] for a in alone]), atol=1e-6)


# --- tokens ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(_tokens.default_tokenizer())


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def test_word_cache_equals_the_library(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(_tokens, "KEPT_WORDS", 50)
    monkeypatch.setattr(_tokens, "KEPT_PARTS", 60)
    encoder = _tokens.WordEncoder(_tokens.default_tokenizer())
    for t in all_texts(spark):
        assert encoder.encode([(t or "").encode(), b"x y"])[0] == ids_of(tokenizer, t)[:-1].tobytes()
    # every letter of the encoder's class before every ASCII mark
    words = [w + chr(a) + chr(m) for a in range(0x41, 0x250) if chr(a).isalpha() for m in range(33, 127) for w in ("", "a")]
    monkeypatch.setattr(_tokens, "KEPT_WORDS", 10**6)
    monkeypatch.setattr(_tokens, "KEPT_PARTS", 10**6)
    assert encoder.encode([w.encode() for w in words]) == [e.astype("<u4").tobytes() for e in encoder._library(words)]


def test_packing_places_every_id_once(spark, make_docs, tokenizer):
    texts = all_texts(spark) + ["same text"] * 300
    out = histogram_packing.pack(make_docs(list(enumerate(texts)), extra=True), with_ids=True)
    rows = out.toPandas()
    for doc, own in rows.sort_values("start").groupby("doc_id"):
        ids, at = ids_of(tokenizer, texts[doc]), 0
        for r in own.itertuples():
            piece = ids[at : at + r.length]
            assert (r.start, r.doc_tokens, r.ids_crc32, r.ids) == (at, len(ids), zlib.crc32(piece.tobytes()), piece.tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    whole = {r.sequence_id: r for r in histogram_packing.sequences(out).collect()}
    for sequence, own in rows.sort_values("offset").groupby("sequence_id"):
        assert (own["offset"] == own["length"].cumsum() - own["length"]).all() and own["length"].sum() <= 2048
        n = int(own["length"].sum())
        total, padding = total + n, padding + (2048 - n if n & (n - 1) else 0)
        assert whole[sequence].n_tokens == n and bytes(whole[sequence].input_ids) == b"".join(own["ids"])
    assert padding < max(2048, 0.02 * total)
    assert histogram_packing.pack(make_docs([])).count() == 0


def test_patterns_use_the_whole_histogram():
    rng = random.Random(0)
    counts = Counter(min(2048, 1 + int(rng.lognormvariate(6, 1))) for _ in range(200_000))
    packs = histogram_packing.patterns(counts)
    used = Counter()
    for n, lengths in packs:
        assert sum(lengths) <= 2048
        for x in lengths:
            used[x] += n
    assert used == counts and len(packs) < 4 * 2048
    waste = sum(n * (2048 - sum(x)) for n, x in packs) / sum(n * 2048 for n, _ in packs)
    assert waste < 0.02


def test_records_round_trip(spark, make_docs, tokenizer, tmp_path):
    rows = list(enumerate(all_texts(spark))) + [(3, "again"), (3, "again"), (None, "no id")]
    random.Random(1).shuffle(rows)
    folder = str(tmp_path / "records")
    shards = record_files.write_records(make_docs(rows, extra=True), folder=folder, shard_bytes=20000)
    out = [tuple(r) for r in record_files.read_records(shards, folder).collect()]
    assert shards.count() > 3
    expected, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ids_of(tokenizer, t)
        expected.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(out, key=str) == sorted(expected, key=str)
    assert record_files.op7_record_files.__name__ == "op7_record_files"
    empty = record_files.write_records(make_docs([]), folder=folder)
    assert record_files.read_records(empty, folder).count() == 0


def test_damaged_records_are_refused():
    data = record_files.frame(b"abc") + record_files.frame(b"")
    assert record_files.unframe(data) == (b"abc", 19) and record_files.unframe(data, 19) == (b"", 35)
    for i in range(19):
        with pytest.raises((ValueError, Exception)):
            record_files.unframe(data[:i] + bytes([data[i] ^ 1]) + data[i + 1 :])


def test_merge_replay_equals_the_library(spark, make_docs):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = merge_replay.Ranks(path)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.rank, special_tokens={})
    texts = all_texts(spark) + ["aaaaaaaaaaaaaaaaaaaa" * 7, " " * 500, "ab" * 999, "\n\n\n \n"]
    docs = make_docs(list(enumerate(texts)), extra=True)
    texts += ["a  b", "a   b", " a", "a ", "a\n", "\na", "a\n\nb", "a \nb", "a\n b", "a\tb c", "a\u00a0 b", "x\u00a0y z", "it's 'll 12ab  \n", "a\r\nb"]
    docs = make_docs(list(enumerate(texts)), extra=True)
    out = {r.doc_id: r for r in merge_replay.digest(docs, path, public_tokenizers.PATTERN).collect()}
    encoded = merge_replay.encode(docs, path, public_tokenizers.PATTERN)
    back = {r.doc_id: bytes(r.text) for r in merge_replay.decode(encoded, path).collect()}
    ids_of_rows = {r.doc_id: r.ids for r in encoded.collect()}
    for i, t in enumerate(texts):
        ids = own.encode_ordinary(t or "")
        raw = (t or "").encode()
        assert ids_of_rows[i] == ids and back[i] == raw, t
        assert (out[i].n_tokens, out[i].ids_sha256, out[i].decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest())
    assert merge_replay.encode(make_docs([]), path, public_tokenizers.PATTERN).count() == 0


def test_blocks_are_bounded_and_whole():
    import pyarrow as pa

    texts = ["a" * n for n in (10, 3000, 0, 50)] + [None]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(5)), "text": texts})
    parts = list(_text.blocks(iter([batch]), limit=100))
    assert [t for _, own in parts for t in own] == [(t or "").encode() for t in texts]
    assert all(len(own) == 1 or sum(map(len, own)) <= 100 for _, own in parts)


def test_training_rows_of_repeated_ids_are_chosen_by_hash(spark, make_docs, monkeypatch):
    from stayflow.llm import quality_trees

    seen = []
    monkeypatch.setattr(quality_trees, "grow", lambda x, y, signs: seen.append((x, y)))
    docs = make_docs([(d, f"word{d} " * n) for d in range(40) for n in (5, 6, 7, 8, 200, 201, 202, 203)])
    labels = spark.createDataFrame([(d, d % 2) for d in range(40)], "doc_id long, quality int")
    quality_trees.train(docs, labels, sample_rows=40)
    x, y = seen[0]
    size = x[:, [c for c, _ in quality_trees.FEATURES].index("log_words")]
    assert len(x) == 40 and 8 <= (size > size.mean()).sum() <= 32 and size.max() > 4


def test_long_labelled_texts_are_learnt_from_bags_of_bounded_size(spark, make_docs):
    long = "good river stone walk " * 9000
    docs = make_docs([(i, long if i % 2 else "bad junk word " * 3000) for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    sizes = [r.n for r in docs.join(labels, "doc_id").select("doc_id", "text", "quality").mapInArrow(attention_mil._bags(16), "doc_id long, quality int, n int, x binary").collect()]
    assert len(sizes) == 40 and set(sizes) == {16}
    scores = {r.doc_id: r.score for r in attention_mil.score(docs, attention_mil.train(docs, labels, bag_limit=16)).collect()}
    assert min(scores[i] for i in scores if i % 2) > max(scores[i] for i in scores if i % 2 == 0)


def test_records_of_one_doc_id_are_split(spark, make_docs, tmp_dir, tokenizer):
    texts = [f"text number {i} " + "w " * (i % 40) for i in range(600)]
    docs = make_docs([(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t) for i, t in enumerate(texts)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = record_files.write_records(docs.repartition(8), folder=tmp_dir, shard_bytes=4000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert shards.select("part").distinct().count() > 4  # two ids hold two thirds of the rows
    rows = record_files.read_records(shards, tmp_dir).orderBy("start").collect()
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0)) and len(ids) == 600
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows[:-1]]))
    assert sorted(r.ids_crc32 for r in rows) == sorted(zlib.crc32(ids_of(tokenizer, t).tobytes()) for t in texts)


def test_records_are_read_in_runs(monkeypatch):
    import pyarrow as pa

    rng = random.Random(4)
    records = [bytes([i % 256]) * rng.choice([0, 1, 5, 50, 400]) for i in range(200)]
    offsets = np.cumsum([0] + [len(r) for r in records])
    for size in (1, 64, 1 << 20):
        monkeypatch.setattr(record_files, "READ_BYTES", size)
        assert [run[lo:hi] for lo, hi, run in record_files._in_runs(pa.BufferReader(b"".join(records)), offsets)] == records
    assert list(record_files._in_runs(pa.BufferReader(b""), np.array([0]))) == []


def test_words_are_looked_up_by_their_parts():
    from stayflow.llm import _tokens

    encoder = _tokens.WordEncoder(_tokens.default_tokenizer())
    texts = ["Alpha, ALPHA. alpha!", "ÉTÉ. (alpha) Alpha42 1987", "EVİ. J̌ K. ǅ1 a×b don't x.y ’a \x01b a\x7f 北。Ö\x0bö", "", " \t\r\n", "a", "42", "é́. Ɏz9"]
    got = encoder.encode([t.encode() for t in texts])
    want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert got == want
    kept = encoder.parts.keys() | encoder.words.keys()
    assert {b"alpha", b",", b".", b"!", b"42", b"1987"} <= kept and not {b"Alpha,", b"ALPHA.", b"alpha!", b"Alpha42", b"Alpha"} & kept
