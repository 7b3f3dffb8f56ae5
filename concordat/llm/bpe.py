"""Byte-level BPE in padded numpy matrices, one row for each distinct piece of text, and its inverse."""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
import weakref
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DROP, FORGET, SLICE, different_words, ends_of, fields, gathered, in_arrow, slices

NONE = np.int32(2**31 - 1)
#: Longer pieces (in bytes) are merged one at a time with a heap: a matrix round costs the width of the row.
WIDEST = 256
#: Bytes that a memory of a worker takes, in two generations, and bytes that an entry of a word takes.
REMEMBER, ENTRY = 48 << 20, 210
#: Fixed value: the pattern under which a space that has no white space beside it begins a piece, whatever stands around it.
BY_SPACE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Memory:
    """What a worker remembers of keys seen: two generations of half of REMEMBER bytes at most, of which the older goes first."""

    def __init__(self, share: float = 1.0) -> None:
        self.most = REMEMBER * share / 2
        self.forget()
        MEMORIES.add(self)

    def forget(self) -> None:
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.taken = 0

    def missing(self, keys: set[str]) -> list[str]:
        """The keys that are not known; the others are in new afterwards. Begins a generation where the last is full."""
        if self.taken > self.most:
            self.old, self.new, self.taken = self.new, {}, 0
        fresh = keys.difference(self.new)
        if not self.old:
            return list(fresh)
        again = {k: self.old[k] for k in fresh if k in self.old}
        self.update(again)
        return list(fresh.difference(again))

    def update(self, entries: dict[str, bytes]) -> None:
        self.new |= entries
        self.taken += len(entries) * ENTRY
        if len(entries) < 1000:  # a few may be of any length
            self.taken += sum(map(len, entries)) + sum(map(len, entries.values()))


MEMORIES: weakref.WeakSet[Memory] = weakref.WeakSet()


@FORGET.append
def forget_words() -> None:
    for m in list(MEMORIES):
        m.forget()


class Codec:
    """Encodes texts as a rank file and a split pattern say; decodes ids."""

    def __init__(self, path: str, pattern: str) -> None:
        ranks = read_ranks(path)
        self.token = {i: b for b, i in ranks.items()}
        self.by_space = pattern == BY_SPACE
        self.split = regex.compile(pattern).findall
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = [(ranks[b[:k]], ranks[b[k:]], i) for b, i in ranks.items() for k in range(1, len(b)) if b[:k] in ranks and b[k:] in ranks]
        self._fill(np.array(pairs, np.int64))
        self.pieces, self.words = Memory(0.5), Memory(0.5)
        self.uneven = re.compile(r"\s\s").search

    def _fill(self, pairs: np.ndarray) -> None:
        """An open-addressing table at most a quarter full: keys and ranks, filled one probe distance at a time."""
        self.bits = max(4, int(len(pairs) * 4 - 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        key, rank = pairs[:, 0] << 32 | pairs[:, 1], pairs[:, 2].astype(np.int32)
        at, self.probes = self._slot(key), 0
        while len(key):
            free = self.keys[at] < 0
            first = np.zeros(len(key), bool)
            first[np.unique(np.where(free, at, -1), return_index=True)[1]] = True
            put = first & free
            self.keys[at[put]], self.ranks[at[put]] = key[put], rank[put]
            key, rank, at, self.probes = key[~put], rank[~put], (at[~put] + 1) & (1 << self.bits) - 1, self.probes + 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair merged, NONE where there is none (and beside padding, which is -1)."""
        shape = left.shape
        key = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        key[(left < 0).ravel() | (right < 0).ravel()] = -2
        at, found = self._slot(key), np.full(len(key), NONE, np.int32)
        open_ = np.arange(len(key))
        for _ in range(self.probes):
            held = self.keys[at[open_]]
            hit = held == key[open_]
            found[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (1 << self.bits) - 1
        return found.reshape(shape)

    def _rows(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of pieces of at most width bytes: each round every live row merges its leftmost pair of least rank; rows without one leave."""
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        size = np.array([len(p) for p in pieces])
        ids = self.byte[raw]
        ids[np.arange(width) >= size[:, None]] = -1
        rank = np.full(ids.shape, NONE, np.int32)
        rank[:, :-1] = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        live, done = np.arange(len(pieces)), [np.empty(0, np.int32)] * len(pieces)
        while len(live):
            at = rank.argmin(1)
            best = rank[np.arange(len(live)), at]
            stay = best != NONE
            for r in np.flatnonzero(~stay):
                done[live[r]] = ids[r, : size[r]].copy()
            if not stay.all():  # compaction of rows, then of columns that no live row uses
                live, ids, rank, size, at, best = live[stay], ids[stay], rank[stay], size[stay], at[stay], best[stay]
                if len(live) and (w := int(size.max())) < ids.shape[1]:
                    ids, rank = ids[:, :w].copy(), rank[:, :w].copy()
            if not len(live):
                break
            row, w = np.arange(len(live)), ids.shape[1]
            ids[row, at] = best
            take = np.arange(w - 1) + (np.arange(w - 1) > at[:, None])
            kept, kept_rank = np.take_along_axis(ids, take, 1), np.take_along_axis(rank, take, 1)
            ids[:, :-1], rank[:, :-1] = kept, kept_rank
            ids[:, -1], rank[:, -1] = -1, NONE
            size -= 1
            after = np.where(at + 1 < w, ids[row, np.minimum(at + 1, w - 1)], -1)
            rank[row, at] = self.pair_ranks(ids[row, at], after)
            b = at > 0
            rank[row[b], at[b] - 1] = self.pair_ranks(ids[row[b], at[b] - 1], ids[row[b], at[b]])
        return done

    def _long(self, piece: bytes) -> np.ndarray:
        """One piece of any length in n log n steps: a heap of (rank, place) over a linked list."""
        ids = self.byte[np.frombuffer(piece, np.uint8)]
        first = self.pair_ranks(ids[:-1], ids[1:])
        heap = [(int(first[i]), int(i)) for i in np.flatnonzero(first != NONE)]
        heapq.heapify(heap)
        at = ids.tolist()
        after, before = [*range(1, len(at)), -1], [-1, *range(len(at) - 1)]
        rank_of = functools.partial(self._pair)
        while heap:
            r, i = heapq.heappop(heap)
            if at[i] < 0 or (j := after[i]) < 0 or rank_of(at[i], at[j]) != r:
                continue
            at[i], at[j], after[i] = r, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if (x := rank_of(r, at[after[i]])) != NONE:
                    heapq.heappush(heap, (x, i))
            if (h := before[i]) >= 0 and (x := rank_of(at[h], r)) != NONE:
                heapq.heappush(heap, (x, h))
        return np.array([x for x in at if x >= 0], np.int32)

    def _pair(self, a: int, b: int) -> int:
        key = a << 32 | b
        slot = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
        for _ in range(self.probes):
            if (k := self.keys[slot]) == key:
                return int(self.ranks[slot])
            if k < 0:
                break
            slot = (slot + 1) & (1 << self.bits) - 1
        return int(NONE)

    def learn(self, pieces: Iterable[str]) -> None:
        """Remembers the ids of pieces, in matrices of like lengths."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        known: dict[str, bytes] = {}
        for p in pieces:
            raw = p.encode()
            n = len(raw)
            if n == 1:
                known[p] = self.byte[raw[0]].astype("<u4").tobytes()
            elif n > WIDEST:
                known[p] = self._long(raw).astype("<u4").tobytes()
            else:
                buckets.setdefault(n if n <= 16 else (n + 7) // 8 * 8, []).append((p, raw))
        for width, held in buckets.items():
            step = max(1, (1 << 20) // width)
            for k in range(0, len(held), step):
                part = held[k : k + step]
                for (p, _), ids in zip(part, self._rows([raw for _, raw in part], width)):
                    known[p] = ids.astype("<u4").tobytes()
        self.pieces.update(known)

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= SLICE):
                chars += len(texts[end])
                end += 1
            out += self._slice(texts[at:end])
            at = end
        return out

    def _slice(self, texts: list[str]) -> list[bytes]:
        """Under BY_SPACE, where no two white spaces meet, words with the space before them are remembered whole; other texts, and all
        under another pattern, are split as they are."""
        even = [self.by_space and not self.uneven(t) for t in texts]
        heads, tails = self._by_words([t for t, e in zip(texts, even) if e])
        others = [self.split(t) for t, e in zip(texts, even) if not e]
        first = [self.split(h) for h in heads]
        self.learn(self.pieces.missing({p for ps in (*first, *others) for p in ps}))
        piece = self.pieces.new.__getitem__
        made, rest = iter([b"".join(map(piece, f)) + t for f, t in zip(first, tails)]), iter([b"".join(map(piece, p)) for p in others])
        return [next(made if e else rest) for e in even]

    def _by_words(self, texts: list[str]) -> tuple[list[str], list[bytes]]:
        """What stands before the first space of each text, and the ids of all that follows."""
        words, place, counts = different_words(texts, " ")
        first = np.cumsum(counts) - counts
        heads = [words[k] for k in place[first]]
        later = np.ones(len(place), bool)
        later[first] = False
        place = place[later]
        asked = np.zeros(len(words), bool)
        asked[place] = True
        tails = [w for w, a in zip(words, asked) if a]
        self._learn_words(self.words.missing(set(tails)))
        number = np.cumsum(asked) - 1
        ids = list(map(self.words.new.__getitem__, tails))
        out, ends = gathered(np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4, number[place])
        raw, ends = out.tobytes(), (4 * ends_of(ends, counts - 1)).tolist()
        return heads, [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _learn_words(self, words: list[str]) -> None:
        """Remembers the ids of words with a space before them."""
        new = {w: self.split(" " + w) for w in words}
        self.learn(self.pieces.missing({p for ps in new.values() for p in ps}))
        piece = self.pieces.new.__getitem__
        self.words.update({w: b"".join(map(piece, ps)) for w, ps in new.items()})

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class LibraryCodec:
    """The same ids by the tiktoken library, which splits and encodes each text whole: that takes less than looking up its words."""

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        ranks = read_ranks(path)
        self.token = {i: b for b, i in ranks.items()}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    decode = Codec.decode

    def encode(self, texts: list[str]) -> list[bytes]:
        encode = self.library.encode_ordinary
        return [array("I", encode(t)).tobytes() for t in texts]


@functools.lru_cache(maxsize=1)
def library_codec(path: str, pattern: str) -> LibraryCodec:
    return LibraryCodec(path, pattern)


@functools.lru_cache(maxsize=1)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker, as long as its tasks are of one kind."""
    return Codec(path, pattern)


DROP += [library_codec.cache_clear, codec.cache_clear]


def encode_documents(docs: DataFrame, path: str, pattern: str, keys: list[str] | None = None, ids: bool = False) -> DataFrame:
    """docs (text and keys) encoded and decoded again: keys, n_tokens, ids_sha256, decoded_sha256 and, if asked, ids (binary,
    little-endian unsigned 32-bit).

    A null or empty text has no ids. Pieces are split by pattern over the whole text, merged alone, and special tokens
    are ordinary text. One pass without a shuffle; memory is a slice of text plus the pieces remembered. Keys (of any type, null or
    repeated) are handed on as they are; other columns are left out.
    """
    keys = keys or ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        sha = lambda held: pa.array([hashlib.sha256(b).hexdigest() for b in held], pa.string())
        for texts, rows in slices(batches, "__text"):
            held = c.encode(texts)
            out = [rows.column(k) for k in range(len(keys))]
            out += [pa.array([len(b) // 4 for b in held], pa.int64()), sha(held), sha(map(c.decode, held))]
            yield pa.RecordBatch.from_arrays(out + [pa.array(held, pa.binary())] * ids, [*keys, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids)

    kept = docs.select(*(F.col(f"`{k}`") for k in keys), F.col("text").cast("string").alias("__text"))
    return in_arrow(kept, run, fields(kept, *keys) + ", n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * ids)
