"""Whole texts to token ids with a public tokenizer file of the ``tokenizers`` library.

The library does the encoding; each worker keeps what it returned for parts of words it has met, up to a fixed number of parts.
White space never reaches a token of this tokenizer, so a text is the sequence of its words between spaces, tabs and line ends,
and a word of Latin letters followed by ASCII marks or digits (no apostrophe) splits where the letters end. Far fewer parts than
words differ, so words are split as bytes, a block at a time, before anything is looked up.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from stayflow.llm import _text

KEPT_WORDS, KEPT_PARTS = 500_000, 600_000
BLOCK_BYTES = 2 << 20
END_ID = 1
_MARK = "\x01"
WORD_END = "</w>"  # fixed value of the tokenizer file: the last token of each of its words ends so
_is_blank = np.zeros(256, bool)
_is_blank[[9, 10, 13, 32]] = True
_is_upper = np.zeros(256, bool)
_is_upper[65:91] = True
# [!-&(-/:-@\\[-`{-~0-9]; letters are A-Z, a-z and U+00C0 to U+023F but for three, as bytes: ASCII or C3..C8 and a byte of 80..BF
_is_mark = np.zeros(256, bool)
_is_mark[33:127] = True
_is_mark[[39, *range(65, 91), *range(97, 123)]] = False
_is_odd = ~_is_mark
_is_odd[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xC9)]] = False
_is_lead = np.zeros(256, bool)
_is_lead[0xC3:0xC9] = True
_NO_LETTER = (0xC397, 0xC3B7, 0xC4B0)  # the signs for times and divided by, and the dotted capital I, which becomes two characters


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """``encode(texts)`` gives the ids of each text as little-endian unsigned 32-bit bytes."""

    _shared: dict[str, "WordEncoder"] = {}

    @classmethod
    def of(cls, path: str) -> "WordEncoder":
        if path not in cls._shared:
            cls._shared[path] = cls(path)
            _text.held.append(cls._shared.clear)
        return cls._shared[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.mark = np.array(self.tokenizer.encode(_MARK, add_special_tokens=False).ids, np.uint32)
        if len(self.mark) != 1:
            raise ValueError("this tokenizer has no id of its own for the separator")
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.parts: dict[bytes, bytes] = {}  # letters only
        self.words: dict[bytes, bytes] = {}  # marks, and words that do not split

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fill_letters(self, parts: list[bytes], texts: list[str]) -> list[int]:
        """Ask the library for parts of letters only, many to a call: each is one word of the call. Returns which it split otherwise."""
        other: list[int] = []
        for lo in range(0, len(parts), 1024):
            some = texts[lo : lo + 1024]
            ids = self._library([" ".join(some)])[0]
            end = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
            if len(end) != len(some) or end[-1] != 4 * len(ids):
                other += range(lo, lo + len(some))
                continue
            raw, cuts = ids.astype("<u4").tobytes(), end.tolist()
            self.parts.update(zip(parts[lo : lo + 1024], map(raw.__getitem__, map(slice, [0, *cuts], cuts))))
        return other

    def _fill(self, parts: list[bytes], texts: list[str]) -> None:
        """Ask the library for parts, many to a call, told apart by a separator that no part contains."""
        clean = [i for i, t in enumerate(texts) if _MARK not in t]
        for lo in range(0, len(clean), 512):
            some = clean[lo : lo + 512]
            ids = self._library([f" {_MARK} ".join([texts[i] for i in some])])[0]
            cuts = np.flatnonzero(ids == self.mark[0])
            if len(cuts) != len(some) - 1:
                raise ValueError("the separator did not keep the words apart")
            begin = np.concatenate([[0], cuts + 1]) * 4
            end = np.append(cuts, len(ids)) * 4
            raw = ids.astype("<u4").tobytes()
            self.words.update(zip([parts[i] for i in some], (raw[i:j] for i, j in zip(begin.tolist(), end.tolist()))))
        for part, text in zip(parts, texts):
            if _MARK in text:
                self.words[part] = self._library([text])[0].astype("<u4").tobytes()

    def _ids(self, parts: list[bytes], letters: np.ndarray) -> list[bytes]:
        """The ids of distinct parts; ``letters``: which of them are letters only, in lower case as far as they are ASCII."""
        if len(self.parts) > KEPT_PARTS:
            self.parts.clear()
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        found = [self.parts.get(p) or self.words.get(p) if plain else self.words.get(p) for p, plain in zip(parts, letters.tolist())]
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            plain = [parts[i] for i in missing if letters[i]]
            text = "\n".join(p.decode("utf-8", "replace") for p in plain).lower().split("\n")  # no letter's lower case depends on its neighbours here
            rest = [parts[i] for i in missing if not letters[i]]
            again = self._fill_letters(plain, text)
            self._fill(rest + [plain[i] for i in again], [p.decode("utf-8", "replace") for p in rest] + [text[i] for i in again])
            for i in missing:
                found[i] = self.words[parts[i]] if (own := self.parts.get(parts[i])) is None else own
        return found

    @staticmethod
    def _split(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, one after another in ``buf``, as parts: where the parts begin (and the last ends), the bytes with the ASCII letters of words
        that can be split in lower case, and which parts are letters only."""
        mark, odd = _is_mark[buf], _is_odd[buf]
        odd[1:] |= mark[:-1] & ~mark[1:]  # a letter after a mark, or the first letter of the next word
        odd[offsets[:-1]] = _is_odd[buf[offsets[:-1]]]
        lead, more = _is_lead[buf], (buf >> 6) == 2
        odd[1:] |= more[1:] != lead[:-1]  # bytes that are no text
        odd[:-1] |= lead[:-1] & ~more[1:]
        for pair in _NO_LETTER:
            odd[:-1] |= (buf[:-1] == pair >> 8) & (buf[1:] == pair & 255)
        edge = np.zeros(len(buf) + 1, bool)
        edge[1:-1] = mark[1:] & ~mark[:-1]  # where marks begin
        whole = np.zeros(len(buf), bool)
        at = np.unique(np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1)  # words that are not letters, then marks
        for lo, hi in zip(offsets[at].tolist(), offsets[at + 1].tolist()):
            whole[lo:hi] = True
        edge[:-1] &= ~whole
        edge[offsets] = True
        begin = np.flatnonzero(edge)
        letters = ~(mark | whole)[begin[:-1]]
        return begin, np.where(_is_upper[buf] & ~whole, buf + np.uint8(32), buf), letters

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text. The parts of all words of the texts lie in one Arrow array: each distinct one is looked up once, and the
        ids are gathered from there."""
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        buf = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        blank = _is_blank[buf]
        filled = np.concatenate([[0], np.cumsum(~blank)])  # bytes of words before each byte
        at = np.flatnonzero(blank)
        bound = np.concatenate([[0], filled[at]])
        real = bound[1:] > bound[:-1]  # between two blanks there may be no word
        offsets = np.concatenate([[0], bound[1:][real]])
        if len(offsets) == 1:
            return [b""] * len(texts)
        offsets, data, letters = self._split(buf[~blank], offsets)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = parts.dictionary_encode()
        part = coded.indices.to_numpy()
        plain = np.empty(len(coded.dictionary), bool)
        plain[part] = letters
        ids = self._ids(coded.dictionary.to_pylist(), plain)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        pool = np.frombuffer(b"".join(ids), "<u4")
        own = size[part]
        total = np.concatenate([[0], np.cumsum(own)])
        place = np.repeat((np.cumsum(size) - size)[part] - total[:-1], own) + np.arange(total[-1])
        flat = pool[place].tobytes()
        cut = 4 * total[np.concatenate([[0], np.searchsorted(offsets, filled[ends])])]
        return [flat[i:j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())]


END = np.array([END_ID], "<u4").tobytes()
