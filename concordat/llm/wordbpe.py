"""Ids of a word-level BPE of the tokenizers library, with the ids of whole words remembered."""

from __future__ import annotations

import functools
import os
import re
import weakref

import numpy as np
import xxhash

from .common import DROP, FORGET, different_words, ends_of, gathered

#: Letters and digits of Latin-1, and the split pattern of the vocabulary file within it.
LETTER, DIGIT = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{DIGIT}]|[^\s{LETTER}{DIGIT}]+"


class WordTable:
    """Ids of words by 128-bit hashes of the words, in arrays: some 40 bytes a word, where a dictionary of texts takes 200. When most words are
    held the table begins anew."""

    def __init__(self, most: int = 1 << 19) -> None:
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.bits = 12
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.empty((1 << 10, 2), np.uint64)
        self.size = np.empty(1 << 10, np.int64)
        self.start = np.empty(1 << 10, np.int64)
        self.ids = np.empty(1 << 12, np.uint32)
        self.words = self.taken = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key's word, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left, at = np.arange(len(keys)), (keys[:, 0] >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(left):
            held = self.slots[at]
            same = (held >= 0) & (self.keys[np.maximum(held, 0)] == keys[left]).all(1)
            out[left[same]] = held[same]
            go = (held >= 0) & ~same
            left, at = left[go], (at[go] + 1) & (1 << self.bits) - 1
        return out

    def add(self, keys: np.ndarray, ids: list[bytes]) -> None:
        """Words that are not there yet, each once."""
        if self.words + len(keys) > self.most:
            self.clear()
        raw = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, self.words = self.words, self.words + len(keys)
        self.keys, self.size, self.start, self.ids = (room(x, n) for x, n in ((self.keys, self.words), (self.size, self.words), (self.start, self.words), (self.ids, self.taken + len(raw))))
        self.keys[first : self.words], self.size[first : self.words] = keys, size
        self.start[first : self.words] = self.taken + np.cumsum(size) - size
        self.ids[self.taken : self.taken + len(raw)] = raw
        self.taken += len(raw)
        numbers = np.arange(first, self.words)
        if 2 * self.words > len(self.slots):
            self.bits = int(4 * self.words - 1).bit_length()
            self.slots = np.full(1 << self.bits, -1, np.int32)
            numbers = np.arange(self.words)
        at = (self.keys[numbers, 0] >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(numbers):
            free = self.slots[at] < 0
            mine = np.zeros(len(numbers), bool)
            mine[np.unique(np.where(free, at, -1), return_index=True)[1]] = True
            mine &= free
            self.slots[at[mine]] = numbers[mine]
            numbers, at = numbers[~mine], (at[~mine] + 1) & (1 << self.bits) - 1


def room(x: np.ndarray, rows: int) -> np.ndarray:
    """An array with room for so many rows, half as many more where it grows."""
    if rows <= len(x):
        return x
    out = np.empty((max(rows, len(x) * 3 // 2), *x.shape[1:]), x.dtype)
    out[: len(x)] = x
    return out


def hashes(words: list[str]) -> np.ndarray:
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in words]), np.uint64).reshape(len(words), 2)


class WordCodec:
    """Texts within Latin-1 are lower-cased and split at white space here, and each distinct word is encoded once by the library: they
    need no normal form, pieces never hold white space, and their ids don't depend on what stands beside them. Other texts go to
    the library whole. Special tokens are ordinary text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.split = re.compile(SPLIT).findall
        self.odd = re.compile(r"[^\x00-\x1b\x20-\xff]").search  # separators \x1c-\x1f are white space for Python only
        self.known = WordTable()  # of words; a piece alone is a word with the same ids
        TABLES.add(self.known)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def simple(self, text: str) -> bool:
        if text.isascii():
            return not ("\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text)
        return not self.odd(text)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Encodes pieces some hundreds in one text, which takes half the time, and cuts the ids where a piece ends."""
        out: dict[str, bytes] = {}
        for at in range(0, len(pieces), 512):
            part = pieces[at : at + 512]
            ids = np.array(self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part):
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                out.update(zip(part, (raw[a:b] for a, b in zip([0, *ends], ends))))
            else:
                out.update(zip(part, self.whole(part)))
        return out

    def learn_words(self, words: list[str]) -> list[bytes]:
        """Ids of words: a word of letters is one piece; the pieces of others are encoded once each, those that are known as words not again."""
        alone, others = [], []
        for w in words:
            (alone if w.isalpha() else others).append(w)
        made = self.learn(alone)
        split = list(map(self.split, others))
        parts = [p for p in {p for ps in split for p in ps} if p not in made]
        number = self.known.find(hashes(parts)) if parts else np.empty(0, np.int64)
        made.update((p, self.known.ids[a : a + n].tobytes()) for p, k in zip(parts, number.tolist()) if k >= 0 for a, n in [(self.known.start[k], self.known.size[k])])
        made |= self.learn([p for p, k in zip(parts, number.tolist()) if k < 0])
        made.update((w, b"".join([made[p] for p in ps])) for w, ps in zip(others, split))
        return [made[w] for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        mine = [bool(self.simple(t)) for t in texts]
        words, place, counts = different_words([t.lower() for t, m in zip(texts, mine) if m])
        keys = hashes(words)
        number = self.known.find(keys)
        if (number < 0).any():
            new = np.flatnonzero(number < 0)
            made = self.learn_words([words[k] for k in new])
            if self.known.words + len(new) > self.known.most:  # begins anew with all that these texts have
                old = np.flatnonzero(number >= 0)
                kept = [self.known.ids[a : a + n].tobytes() for a, n in zip(self.known.start[number[old]], self.known.size[number[old]])]
                self.known.clear()
                self.known.add(np.concatenate([keys[old], keys[new]]), kept + made)
            else:
                self.known.add(keys[new], made)
            number = self.known.find(keys)
        out, ends = gathered(self.known.ids, self.known.size, number[place], self.known.start)
        raw, ends = out.tobytes(), (4 * ends_of(ends, counts)).tolist()
        texts_ids = iter([raw[a:b] for a, b in zip([0, *ends], ends)])
        rest = iter(self.whole([t for t, m in zip(texts, mine) if not m]))
        return [next(texts_ids if m else rest) for m in mine]


TABLES: weakref.WeakSet[WordTable] = weakref.WeakSet()


@FORGET.append
def forget_words() -> None:
    for t in list(TABLES):
        t.clear()


@functools.lru_cache(maxsize=1)
def word_codec(path: str) -> WordCodec:
    return WordCodec(path)


DROP.append(word_codec.cache_clear)
