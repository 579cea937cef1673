"""Periodic runs against brute force over all lags."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from stayflow.llm import periodic_runs as R

SF = "/root/testdata/sf0.001"


def smallest_period(words):
    n = len(words)
    return next(q for q in range(1, n + 1) if all(words[i] == words[i - q] for i in range(q, n)))


def brute(words, min_words=24, min_powers=3):
    n, out = len(words), []
    for q in range(1, n // min_powers + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = first - q, i - first + q
            if length >= max(min_words, min_powers * q) and smallest_period(words[start : start + 2 * q]) == q:
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def ids(words):
    return R.word_numbers(words)


def cases():
    rng = random.Random(7)
    yield ["a"] * 100
    yield (list("ab") * 30) + list("xyz") * 9 + ["q"]
    yield list("aab" * 12) + list("aab") + list("ab" * 20)  # runs that overlap
    yield list("abaab" * 30)
    fib = ["a"], ["b"]
    for _ in range(10):
        fib = fib[1], fib[1] + fib[0]
    yield fib[1]
    yield (["w%d" % i for i in range(40)] * 4)[:130]
    for q in (1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65):  # exactly at, one below and one above the least length
        for extra in (-1, 0, 1):
            n = max(24, 3 * q) + extra
            yield ["x"] + (["p%d" % i for i in range(q)] * (n // q + 2))[:n] + ["y"]
    for _ in range(150):
        words = []
        while len(words) < rng.randrange(20, 300):
            piece = [rng.choice("abc") for _ in range(rng.randrange(1, 12))]
            words += (piece * rng.randrange(1, 40))[: rng.randrange(1, 120)]
        yield words
    for _ in range(60):
        yield [rng.choice("ab") for _ in range(rng.randrange(0, 200))]


def test_runs_match_brute_force():
    everything, base, expected = [], 0, []
    for words in cases():
        want = brute(words)
        assert [tuple(r) for r in R.runs(ids(words)).tolist()] == want
        everything.append(R.word_numbers(words, base))
        expected += [(s + base, n, q) for s, n, q in want]
        base += len(words)
    assert sorted(map(tuple, R.runs(np.concatenate(everything)).tolist())) == sorted(expected)  # texts behind each other


@pytest.mark.parametrize("least,powers", [(1, 3), (5, 3), (12, 4), (100, 3), (24, 5)])
def test_other_thresholds(least, powers):
    for words in cases():
        assert [tuple(r) for r in R.runs(ids(words), least, powers).tolist()] == brute(words, least, powers)


def test_a_long_text_of_one_word_and_one_without_repeats():
    n = 400_000
    assert R.runs(np.zeros(n, np.int64)).tolist() == [[0, n, 1]]
    assert R.runs(np.arange(n)).tolist() == []
    half = np.arange(n) % (n // 3)
    assert R.runs(half).tolist() == [[0, n, n // 3]]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected(doc, text):
    words = words_of(text)
    n = len(words)
    h = zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    return (len(found), *(best or [None] * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_query_matches_brute_force(spark, make_docs, tmp_dir):
    rng = random.Random(3)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() if len(r.text or "") < 4000]
    texts += [None, "", " \t\n\x0b", "one", "la " * 200, "é x é x " * 20, "\x1c \x85 " * 30, "a b c\n" * 30 + "tail", "same", "same"]
    texts += [" ".join(rng.choice("ab") for _ in range(150)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 2
    make_docs(rows, extra=True).write.parquet(tmp_dir + "/t/documents.parquet")
    out = R.op12_periodic_runs(spark, tmp_dir + "/t")
    got = sorted((r[0], *map(str, r[1:])) for r in out.collect())
    assert got == sorted((d, *map(str, expected(d, t))) for d, t in rows)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert out.limit(0).count() == 0


def test_find_collapse_and_null_ids(spark, make_docs):
    docs = make_docs([(None, "x " + "la " * 30 + "y"), (2, None), (2, "a b")], extra=True)
    assert [tuple(r) for r in R.find(docs).collect()] == [(None, 1, 30, 1)]
    assert {(r.doc_id, r.n_runs, r.text) for r in R.collapse(docs).collect()} == {(None, 1, "x la y"), (2, 0, ""), (2, 0, "a b")}
    assert R.find(docs.limit(0)).count() == 0 == R.collapse(docs.limit(0)).count()
