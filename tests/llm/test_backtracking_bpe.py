"""The backtracking encoder against the tokenizers library, and against merges replayed one by one on small vocabularies."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from stayflow.llm import backtracking_bpe as B

SF = "/root/testdata/sf0.001"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
ODD = [None, "", " ", " \n \t", "one", "word " * 3000, "a\n\nb\na\n \nb", "é́ ñ ß İ ΣΑΣ 中文 ² x²—“q”", "it's I'll '' 'd", "<|endoftext|>",
       "<|endoftext|> a<|endoftext|>b<|endoftext", " \x01 a\x01b \x1c \x85   \x0b\x0c \x00", "aaaaaaaa" * 500, "x" * 40000, "ab" * 9000 + "a",
       "😀😀 ‍ 12.5% http://a.b/c?d=1", "͸ a͸՘ b", "  lead", "trail  ", "1234567890" * 30, "　  x", "�", "���"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return B.Tokenizer.of(PATH, PATTERN)


def same(tokenizer, library, texts):
    want = [np.array(e.ids, "<u4") for e in library.encode_batch(texts, add_special_tokens=False)]
    got = tokenizer.encode(texts)
    for t, w, g in zip(texts, want, got):
        assert g == w.tobytes(), t[:80]
    assert tokenizer.decode_texts(got) == library.decode_batch([w.tolist() for w in want], skip_special_tokens=False)


def test_documents_and_odd_texts(spark, tokenizer, library):
    same(tokenizer, library, [t or "" for t in ODD] + [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()])


def test_every_code_point(tokenizer, library):
    """The classes of the pattern are the library's: every character beside letters, digits, marks, spaces and line ends."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    lines = [f"x{c}1{c}{c} {c}!{c}\n{c} {c}b" for c in points]
    for lo in range(0, len(lines), 400_000):
        same(tokenizer, library, ["|".join(lines[i : i + 500]) for i in range(lo, min(lo + 400_000, len(lines)), 500)][::40])
    split = library.pre_tokenizer.pre_tokenize_str
    for lo in range(0, len(lines), 2048):
        text = "|".join(lines[lo : lo + 2048])
        assert [p for some in tokenizer._split(text) for p in some] == [text[a:b] for _, (a, b) in split(text)]


def test_random_strings_caches_and_long_texts(tokenizer, library, monkeypatch):
    rng = random.Random(5)
    letters = "aeinrst  \n.,'0123éüЖ中😀ing"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 400))) for _ in range(400)]
    same(tokenizer, library, texts)
    monkeypatch.setattr(B, "KEPT_PIECES", 40)
    monkeypatch.setattr(B, "KEPT_PAIRS", 50)
    monkeypatch.setattr(B, "GROUP_BYTES", 64)
    monkeypatch.setattr(B, "LONG_TEXT", 100)
    monkeypatch.setattr(B, "STEP", 7)
    monkeypatch.setattr(B, "DECODED_AT_ONCE", 11)
    for text in texts[:60]:
        same(tokenizer, library, [text])


def replay(merges, text):
    """Merges one by one: the pair of the lowest rank, from the left."""
    parts = [bytes([b]) for b in text]
    while True:
        found = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
        if not found:
            return parts
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_small_vocabularies_against_replayed_merges():
    rng = random.Random(11)
    for _ in range(60):
        tokens, merges = [b"a", b"b", b"c"], []
        for _ in range(rng.randrange(1, 14)):  # any merge of two tokens, also one that the earlier merges never allow
            a, b = rng.choice(tokens), rng.choice(tokens)
            if a + b not in tokens:
                tokens.append(a + b)
                merges.append((a, b))
        model = B.Merges(merges)
        texts = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 25))) for _ in range(60)]
        for text, got in zip(texts, model.encode(texts)):
            assert [model.token[t] for t in got] == replay(merges, text), (merges, text)


def test_linear_on_a_long_piece(tokenizer):
    text = "ab" * 400_000 + "c"
    assert tokenizer.decode_texts(tokenizer.encode([text])) == [text]


def test_query_and_round_trip(spark, make_docs, tmp_dir, library):
    rows = list(enumerate(ODD)) + [(None, "null id"), (4, "one"), (4, "one")]
    docs = make_docs(rows, extra=True)
    docs.write.parquet(tmp_dir + "/t/documents.parquet")
    got = sorted(map(str, map(tuple, B.op11_backtracking_bpe(spark, tmp_dir + "/t").collect())))
    want = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(map(str, want))
    back = B.decode(B.encode(docs, PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(d), t or "") for d, t in rows)
    assert B.encode(docs.limit(0), PATH, PATTERN).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        B.Tokenizer(public_tokenizers.path("word_bpe_49k.json"), PATTERN)
