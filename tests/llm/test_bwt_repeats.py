import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stayflow.llm import bwt_repeats as M


def brute(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def text(rng, n, letters="abcdefgh é"):
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.mark.parametrize("n,letters", [(60, 2), (300, 3), (500, 1), (900, 26)])
def test_boundaries_of_the_transform(n, letters):
    rng = np.random.default_rng(n)
    symbol = np.append(rng.integers(1, letters + 1, n), 0).astype(np.int32)
    order, s = M.suffix_array(symbol), symbol.tolist()
    assert order.tolist() == sorted(range(n + 1), key=lambda i: s[i:])
    for length in (1, 4, 9):
        found = M.unseparated(symbol, order, length)
        for i in range(1, n + 1):
            a, b = s[order[i - 1] :][:length], s[order[i] :][:length]
            assert found[i] == (a == b and len(a) == length)


def test_edge_cases(make_docs):
    rng = random.Random(1)
    p = text(rng, 300)
    rows = [(1, None), (2, ""), (3, "short"), (4, "a" * 5000), (5, p), (5, p), (6, p[:199]), (7, p[50:250]), (None, "x" + p[100:299]),
            (8, "ab" * 400), (9, text(rng, 70000)), (10, "\x00\x01" * 150 + text(rng, 50)), (11, "a" * 201)]
    assert got(M.digest(make_docs(rows, extra=True))) == brute(rows, 200)
    assert M.digest(make_docs([])).count() == 0


@pytest.mark.parametrize("hot", [1000, 3])
def test_passages_and_edits_match_brute_force(make_docs, monkeypatch, hot):
    monkeypatch.setattr(M, "HOT", hot)
    monkeypatch.setattr(M, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(M, "COMMON", 3)
    rng = random.Random(2)
    shared = [text(rng, n) for n in (60, 150, 200, 230, 400, 900)]
    rows = []
    for d in range(120):
        t = ""
        for _ in range(rng.randrange(1, 4)):
            t += text(rng, rng.randrange(0, 300)) + rng.choice(shared)
        if rng.random() < 0.3:  # an edit inside
            k = rng.randrange(len(t))
            t = t[:k] + "#" + t[k + 1 :]
        rows.append((d, t))
    rows += [(200 + i, rows[i][1]) for i in range(10)]
    assert got(M.digest(make_docs(rows))) == brute(rows, 200)
    assert got(M.digest(make_docs(rows), 64)) == brute(rows, 64)


def test_cut_texts_keep_rows_and_columns(make_docs):
    p = text(random.Random(3), 250)
    docs = make_docs([(1, "é" + p + "tail"), (2, p), (3, None), (4, "plain")], extra=True)
    out = {r.doc_id: r for r in M.remove_repeats(docs).collect()}
    assert (out[1].text, out[2].text, out[3].text, out[4].text) == ("étail", "", None, "plain")
    assert list(out[1].asDict()) == docs.columns and out[1].ref == "1"
