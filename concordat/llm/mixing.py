"""Log probabilities of texts: hashed-context bit predictors, mixed in the logistic domain by gated weights that are learned online, refined by adaptive maps.

A text is coded word by word: lower-cased (A-Z), each word followed by a space, and one end. Each byte is a walk down a binary tree, and
each step of the walk a bit that PREDICTORS predict from counts of what followed their contexts in the training texts. The topic, a context of
one predictor, comes from the words before: of which class of leading words (learned from which words lead the same texts) the text
has had most. All that a word costs is thus told by the word and the topic, so that each pair of these is computed once, however often it occurs.

Contexts that grow with the corpus, those of whole beginnings of words, are counted where words meet in stretches of their sorted order, and
only contexts at the seams of stretches are joined; short contexts have tables of fixed size, in which each word counts once, as what they are asked for is words that have hardly been seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MIX, durable, fields, gathered, in_arrow, made, mix64, whole_groups
from .quality import add_up

#: Characters of a word that are spelled in one piece, and characters of words in one stretch of their order.
PIECE, STRETCH = 64, 50_000
#: Words that lead a text, words that classes of topics are made of, classes at most, and the likeness below which classes stay apart.
LEADING, GATE_WORDS, TOPICS, ALIKE = 6, 64, 15, 0.1
#: Items whose scores every task holds; texts' other items are joined.
HELD_ITEMS = 1 << 17
#: Bits of the tables of the last 2, 3 and 5 bytes (of TOPICAL and more with the topic); the other predictors are the word's beginning without and with the topic.
SHORT = {2: 17, 3: 18, 5: 19}
TOPICAL = 3
OFFSETS = np.cumsum([0, *(1 << b for b in SHORT.values())])
PREDICTORS = len(SHORT) + 2
BLOCK = 4096
#: Counts at which the gates of the mixer change, for the beginnings and for the longest table; bits learned from at a time; buckets of the adaptive maps.
LEVELS, FEW = np.array([1, 2, 3, 5, 9, 33, 257], np.float32), np.array([1, 9, 257], np.float32)
GATES = (len(LEVELS) + 1) ** 2 * (len(FEW) + 1)
BATCH, BUCKETS = 16384, 33
LEAST = 1e-7
#: Bytes lower-cased (A-Z), white space as spaces; more bits than any item has.
FOLD = bytes(32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
FAR = 1 << 40


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % 7 == 2, F.lit(False))


class Texts:
    """The words of texts one after the other, each text closed by the word "\\n": names, ids and rows (texts)."""

    def __init__(self, texts: pa.Array) -> None:
        text = texts.cast(pa.large_string()).fill_null("")
        _, places, raw = text.buffers()
        if raw is not None:
            text = pa.LargeStringArray.from_buffers(len(text), places, pa.py_buffer(raw.to_pybytes().translate(FOLD)), None, 0, text.offset)
        text = pc.binary_join_element_wise(text, pa.scalar("\n", pa.large_string()), pa.scalar(" ", pa.large_string()))
        parts = pc.split_pattern(text, " ")
        flat = parts.flatten().dictionary_encode()
        self.names = flat.dictionary
        ids, row = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
        some = ids != pc.index(self.names, pa.scalar("", self.names.type)).as_py()
        self.ids, self.row, self.n = ids[some], row[some].astype(np.int64), len(texts)

    def topics(self, classes: dict[str, int]) -> np.ndarray:
        """For each word the class (from 1) of which most leading words stood before it in its text, of equal ones the first; 0 before any."""
        found = pc.index_in(self.names, pa.array(list(classes), self.names.type)).fill_null(-1).to_numpy(zero_copy_only=False)
        mine = np.append(np.array(list(classes.values()), np.int64), 0)[found][self.ids]
        leads = mine > 0
        before = np.cumsum(leads) - leads  # leading words before each word
        mine = mine[leads]
        first = np.append(before, len(mine))[np.searchsorted(self.row, np.arange(self.n))]
        size = np.bincount(self.row[leads], minlength=self.n)
        best, after = np.zeros(len(mine), np.int64), np.zeros(len(mine) + 1, np.int64)
        for g in range(1, max(classes.values(), default=0) + 1):
            seen = np.concatenate([[0], np.cumsum(mine == g)])
            seen = seen[1:] - np.repeat(seen[first], size)
            after[:-1][seen > best] = g
            np.maximum(best, seen, out=best)
        return np.where(before > first[self.row], after[before - 1], 0)

    def grouped(self, *keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The different combinations of keys (not negative), in order, and how often each occurs."""
        code = keys[0]
        sizes = [int(k.max()) + 1 if len(k) else 1 for k in keys]
        for k, size in zip(keys[1:], sizes[1:]):
            code = code * size + k
        code, n = np.unique(code, return_counts=True)
        out = []
        for size in sizes[:0:-1]:
            out.append(code % size)
            code = code // size
        return [code, *out[::-1]], n


def items_of(word: str) -> list[str]:
    """What stands for a word in the counts: itself; or of a word of PIECE characters or more the whole, marked by \\x0b and not spelled, and
    its pieces, which are spelled, all but the first marked by a tab; the last has fewer than PIECE characters and so tells its end."""
    if len(word) < PIECE:
        return [word]
    return ["\x0b" + word, word[:PIECE], *("\t" + word[k : k + PIECE] for k in range(PIECE, len(word) + 1, PIECE))]


def expanded(names: pa.Array, ids: np.ndarray, *columns: np.ndarray) -> tuple[pa.Array, np.ndarray, list[np.ndarray]]:
    """Names by id, and rows (ids, columns) with those of long words replaced by rows of their items."""
    long = np.flatnonzero(pc.greater_equal(pc.utf8_length(names), PIECE).to_numpy(zero_copy_only=False))
    if not len(long):
        return names, ids, list(columns)
    at, more, n = {}, [], len(names)
    for i, word in zip(long.tolist(), names.take(pa.array(long)).to_pylist()):
        parts = items_of(word)
        at[i] = np.arange(n + len(more), n + len(more) + len(parts))
        more += parts
    mine = np.isin(ids, long)
    place, new = [np.flatnonzero(~mine)], [ids[~mine]]
    for row in np.flatnonzero(mine).tolist():
        new.append(at[int(ids[row])])
        place.append(np.full(len(new[-1]), row))
    place = np.concatenate(place)
    return pa.concat_arrays([names, pa.array(more, names.type)]), np.concatenate(new), [c[place] for c in columns]


def told(table: pa.Table, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows of a batch as Spark takes them. What a batch has of a word is one row already, and tasks have few words more than once a batch."""
    return iter(table.cast(schema).combine_chunks().to_batches(50_000))


#: What statistics() hands on.
STATISTICS = pa.schema([("kind", pa.int32()), ("a", pa.string()), ("b", pa.string()), ("n", pa.int64())])


def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of training texts: counts of pairs of words that lead a text (kind 1), and of bytes (2)."""
    octets = np.zeros(256, np.int64)
    rows = lambda kind, a, b, n: pa.table([pa.array(np.full(len(n), kind, np.int32)), a, b, pa.array(n)], ["kind", "a", "b", "n"])
    for batch in batches:
        texts = Texts(batch.column("text"))
        (row, word), n = texts.grouped(texts.row, texts.ids)
        total = np.bincount(word, n, len(texts.names)).astype(np.int64)
        size = pc.binary_length(texts.names).to_numpy(zero_copy_only=False).astype(np.int64)
        octets += np.bincount(np.frombuffer(texts.names.buffers()[2] or b"", np.uint8, int(size.sum())), np.repeat(total, size), 256).astype(np.int64)
        octets[32] += int(total.sum())
        # only words as frequent as the last that leads a text need to be told apart
        end = pc.index(texts.names, pa.scalar("\n", texts.names.type)).as_py()
        row, word, n = row[word != end], word[word != end], n[word != end]
        order = np.lexsort((-n, row))
        row, word, n = row[order], word[order], n[order]
        first = np.searchsorted(row, np.arange(texts.n + 1))
        last = np.minimum(first[:-1] + LEADING, first[1:]) - 1
        near = n >= n[np.maximum(last, 0)][row] if len(n) else n > 0
        row, word, n = row[near], word[near], n[near]
        few, place = np.unique(word, return_inverse=True)
        marks = np.array([xxhash.xxh3_64_intdigest(w) >> 1 for w in texts.names.take(pa.array(few)).to_pylist()], np.int64)[place]
        order = np.lexsort((marks, -n, row))
        row, word = row[order], word[order]
        lead = np.arange(len(row)) - np.searchsorted(row, row) < LEADING
        row, word = row[lead], word[lead]
        ahead = [np.arange(len(row) - k) for k in range(LEADING)]
        left = np.concatenate([x[row[x] == row[x + k]] for k, x in enumerate(ahead)]).astype(np.int64)
        right = np.concatenate([x[row[x] == row[x + k]] + k for k, x in enumerate(ahead)]).astype(np.int64)
        (x, y), n = texts.grouped(word[left], word[right])
        a, b = texts.names.take(pa.array(x)), texts.names.take(pa.array(y))
        later = pc.greater(a, b)
        yield from told(rows(1, pc.if_else(later, b, a), pc.if_else(later, a, b), n.astype(np.int64)), STATISTICS)
    some = np.flatnonzero(octets)
    yield from told(rows(2, pa.array(list(map(str, some.tolist())), pa.string()), pa.nulls(len(some), pa.string()), octets[some]), STATISTICS)


def topic_classes(pairs: list[tuple[str, str, int]]) -> dict[str, int]:
    """Classes (from 1) of words that lead the same texts: average linkage of likenesses pairs / sqrt(texts of a x texts of b), down to
    ALIKE; the TOPICS classes that lead most texts stay."""
    alone = {a: n for a, b, n in pairs if a == b}
    words = sorted(alone, key=lambda w: (-alone[w], w))[:GATE_WORDS]
    place = {w: i for i, w in enumerate(words)}
    like = np.zeros((len(words), len(words)))
    for a, b, n in pairs:
        if a in place and b in place and a != b:
            like[place[a], place[b]] = like[place[b], place[a]] = n / np.sqrt(alone[a] * alone[b])
    groups = [[i] for i in range(len(words))]
    while len(groups) > 1:
        value, x, y = max((like[np.ix_(g, h)].mean(), -x, -y) for x, g in enumerate(groups) for y, h in enumerate(groups[:x]))
        if value < ALIKE:
            break
        groups[-y] += groups.pop(-x)
    groups.sort(key=lambda g: (-sum(alone[words[i]] for i in g), min(g)))
    return {words[i]: k for k, g in enumerate(groups[:TOPICS], 1) for i in g}


@dataclass
class Tree:
    """A binary tree of bytes in their order: for each byte its nodes and bits from the root, one after the other in nodes and bits; and how many
    bits two bytes have in common."""

    nodes: np.ndarray
    bits: np.ndarray
    sizes: np.ndarray
    common: np.ndarray


def byte_tree(counts: np.ndarray) -> Tree:
    """Each node splits its bytes where their counts are halved best, so that frequent bytes have few bits."""
    ahead = np.concatenate([[0], np.cumsum(np.asarray(counts, np.float64) + 1e-3 * (1 + np.sum(counts)) / 256)])
    paths: list[list[tuple[int, int]]] = [[] for _ in range(256)]
    held, node = [(0, 256)], 0
    while held:
        low, high = held.pop()
        if high - low == 1:
            continue
        middle = int(np.clip(np.searchsorted(ahead, (ahead[low] + ahead[high]) / 2), low + 1, high - 1))
        if middle > low + 1 and abs(2 * ahead[middle - 1] - ahead[low] - ahead[high]) < abs(2 * ahead[middle] - ahead[low] - ahead[high]):
            middle -= 1
        for b in range(low, high):
            paths[b].append((node, int(b >= middle)))
        held += [(low, middle), (middle, high)]
        node += 1
    sizes = np.array([len(x) for x in paths], np.int64)
    codes = np.full((256, sizes.max()), -1, np.int64)
    for b, path in enumerate(paths):
        codes[b, : len(path)] = [bit for _, bit in path]
    common = np.argmax(np.concatenate([codes[:, None] != codes[None], np.ones((256, 256, 1), bool)], 2), 2)
    return Tree(np.array([n for x in paths for n, _ in x], np.int64), np.array([b for x in paths for _, b in x], bool), sizes, common)


def spelling(item: str) -> bytes:
    """The bytes that an item codes."""
    if item[:1] == "\x0b":
        return b""
    text = item[1:] if item[:1] == "\t" else item
    return (text if text == "\n" or len(text) >= PIECE else text + " ").encode()


class Bits:
    """All bits of items, one after the other: item, bit, node and the slots of short contexts; and the bits' contexts of whole
    beginnings, which lie together in the order of items and so are counted by runs. No item's bytes are the beginning of another's."""

    def __init__(self, tree: Tree, items: list[str], topic: np.ndarray) -> None:
        spelled = list(map(spelling, items))
        self.topic, size = topic.astype(np.int64), np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.raw = raw = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int64)
        self.size, self.start, row = size, np.cumsum(size) - size, np.repeat(np.arange(len(size)), size)
        #: Items with bits in the order of their bytes, which is nearly the order that they come in.
        self.order = np.array([k for k in sorted(range(len(items)), key=spelled.__getitem__) if spelled[k]], np.int64)
        self.tree, self.later = tree, np.fromiter((x[:1] == "\t" for x in items), np.int64, len(items))
        place, first = np.arange(len(raw)) - self.start[row], 256 + self.later[row]
        own = tree.sizes[raw]
        step = np.repeat(np.arange(len(raw)), own)
        self.node, _ = gathered(tree.nodes, tree.sizes, raw)
        self.bit, _ = gathered(tree.bits, tree.sizes, raw)
        self.item = row[step]
        #: Bits before each byte, and of each item.
        self.ahead = np.concatenate([[0], np.cumsum(own)])
        self.first, self.length = self.ahead[self.start], self.ahead[self.start + size] - self.ahead[self.start]
        mark = (self.node.astype(np.uint64) + np.uint64(1)) * MIX
        held, self.slots = np.zeros(len(raw), np.uint64), []
        with np.errstate(over="ignore"):
            for k in range(1, max(SHORT) + 1):
                held = held * np.uint64(512) + np.where(place >= k, raw[np.maximum(np.arange(len(raw)) - k, 0)], first).astype(np.uint64)
                if k in SHORT:
                    last = held + (self.topic[row].astype(np.uint64) << np.uint64(55)) if k >= TOPICAL else held
                    slot = mix64(mix64(last * MIX + np.uint64(k))[step] ^ mark) >> np.uint64(64 - SHORT[k])
                    self.slots.append(slot.astype(np.int64) + int(OFFSETS[len(self.slots)]))

    def shared(self, order: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """How many bits each item of an order has in common with the one before; -1 where a segment begins."""
        a, b = order[:-1], order[1:]
        byte, alive = np.zeros(len(b), np.int64), np.flatnonzero(segment[a] == segment[b])
        least = np.minimum(self.size[a], self.size[b])
        out = np.full(len(b), -1)
        k = 0
        while len(alive):
            ended = least[alive] <= k
            out[alive[ended]] = self.ahead[self.start[b[alive[ended]]] + k] - self.first[b[alive[ended]]]
            alive = alive[~ended]
            x, y = self.raw[self.start[a[alive]] + k], self.raw[self.start[b[alive]] + k]
            apart = x != y
            gone = alive[apart]
            out[gone] = self.ahead[self.start[b[gone]] + k] - self.first[b[gone]] + self.tree.common[x[apart], y[apart]]
            alive = alive[~apart]
            k += 1
        return np.concatenate([[-1], out])

    def lines(self, topical: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Items with bits by segment (kind of beginning, and topic if topical) and in order, the bits that each has in common with the one before
        (-1 where a segment begins), where segments begin, and their numbers."""
        segment = self.later + 2 * self.topic if topical else self.later
        order = self.order[np.argsort(segment[self.order], kind="stable")]
        common = self.shared(order, segment) if len(order) else order
        heads = np.flatnonzero(common < 0)
        return order, common, heads, segment[order[heads]]

    def hashes(self, items: np.ndarray, segment: np.ndarray, topical: bool) -> np.ndarray:
        """Of the contexts of all bits of items in segments, one after the other: of the bits before, each times a number of its place."""
        bits, ends = gathered(self.bit, self.length, items, self.first)
        n = self.length[items]
        with np.errstate(over="ignore"):
            seed = (np.uint64(1) + segment.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93 if topical else 0xA0761D6478BD642F)
            factor = mix64(np.arange(1, 1 + int(n.max(initial=0)), dtype=np.uint64) * MIX)
            step = (bits.astype(np.uint64) + np.uint64(1)) * factor[np.arange(len(bits)) - np.repeat(ends - n, n)]
            before = np.cumsum(step) - step
            return mix64(before + np.repeat(mix64(seed) - before[ends - n], n))

    def ends(self, topical: bool, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The contexts of the first and last item of each segment, which others may share: hashes, and how often zeros and ones follow here."""
        order, common, heads, segment = self.lines(topical)
        if not len(order):
            return np.zeros(0, np.uint64), np.zeros((0, 2))
        size = np.diff(np.append(heads, len(order)))
        part, whole = np.repeat(np.arange(len(heads)), size), np.add.reduceat(count[order], heads)
        first, last = with_ends(common, part)
        hashes, sums = [], []
        for end, near, least in ((heads, first, np.zeros(len(heads), np.int64)), (heads + size - 1, last, first[heads + size - 1] + 1)):
            n = self.length[order[end]]
            start = np.cumsum(n + 1) - n - 1  # one place more, for items that are equal to the end
            other = np.bincount(start[part] + np.minimum(near, n[part]), count[order], int((n + 1).sum()))
            bits, stop = gathered(self.bit, self.length, order[end], self.first)
            deep = np.arange(len(bits)) - np.repeat(stop - n, n)
            before = np.cumsum(other) - other
            at = np.repeat(start, n) + deep
            same = np.repeat(whole + before[start], n) - before[at] - other[at]
            some = deep >= np.repeat(least, n)  # what the last has in common with the first is told once
            hashes.append(self.hashes(order[end], segment, topical)[some])
            sums.append(np.stack([np.where(bits, other[at], same), np.where(bits, same, other[at])], 1)[some])
        return np.concatenate(hashes), np.concatenate(sums)

    def follow(self, topical: bool, count: np.ndarray, known: tuple[np.ndarray, np.ndarray], out: np.ndarray) -> None:
        """How often zeros and ones follow each bit's context, the bits before it of its item (and the topic, if topical), into out. known: hashes, in order, of
        contexts that others share, and their sums over all.

        Items that have a context in common lie together, and where one has the other bit, two neighbours part: so each place where neighbours
        part tells the items around it how many take the other way, and what is left takes theirs.
        """
        order, common, heads, segment = self.lines(topical)
        if not len(order):
            return
        size = np.diff(np.append(heads, len(order)))
        part = np.repeat(np.arange(len(heads)), size)
        ahead = np.concatenate([[0], np.cumsum(count[order])])
        fork = np.flatnonzero((common >= 0) & (common < self.length[order]))
        low, high = around(common, fork)
        left, right = ahead[fork] - ahead[low], ahead[high] - ahead[fork]
        place, n = ranges(np.concatenate([low, fork]), np.concatenate([fork, high]))
        other = np.zeros(len(self.bit), np.int64)
        other[self.first[order[place]] + np.repeat(np.tile(common[fork], 2), n)] = np.repeat(np.concatenate([right, left]), n)
        before = np.concatenate([[0], np.cumsum(other)])
        whole = np.zeros(len(self.size), np.int64)
        whole[order] = (ahead[heads + size] - ahead[heads])[part]
        same = np.repeat(whole + before[self.first], self.length) - before[1:]
        out[:, 0], out[:, 1] = np.where(self.bit, other, same), np.where(self.bit, same, other)
        if not len(known[0]):
            return
        first, last = with_ends(common, part)
        for end, near, least in ((heads, first, np.zeros(len(heads), np.int64)), (heads + size - 1, last, first[heads + size - 1] + 1)):
            hashes, n = self.hashes(order[end], segment, topical), self.length[order[end]]
            start = np.cumsum(n) - n
            place = np.minimum(np.searchsorted(known[0], hashes), len(known[0]) - 1)
            met = np.add.reduceat(known[0][place] == hashes, start, dtype=np.int64)  # a beginning: who shares a context shares those before it
            stop = np.minimum(np.minimum(near + 1, self.length[order]), met[part])
            deep, n = ranges(least[part], stop)
            out[np.repeat(self.first[order], n) + deep] = known[1][place[np.repeat(start[part], n) + deep]]


def ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each low to before its high, one range after the other, and how many each has."""
    n = np.maximum(high - low, 0)
    ends = np.cumsum(n)
    return np.repeat(low - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0), n


def with_ends(common: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many bits each item of segments has in common with the first and with the last of its segment; these with themselves FAR - 1."""
    first = np.minimum.accumulate(np.where(common < 0, FAR - 1, common) - part * FAR) + part * FAR
    after = np.append(common[1:], -1)
    last = np.minimum.accumulate((np.where(after < 0, FAR - 1, after) + part * FAR)[::-1])[::-1] - part * FAR
    return first, last


def around(common: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For some places (not where a segment begins) the nearest before and after them where less is in common, found by jumps that double."""
    held, out = np.append(common, -1), []
    for way in (-1, 1):
        near = np.arange(len(held)) + way
        left = np.flatnonzero(held >= 0)
        while len(left):
            left = left[held[near[left]] >= held[left]]
            near[left] = near[near[left]]
        out.append(near[some])
    return out[0], out[1]


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    for group in whole_groups(batches, "part", 1):
        parts = group.column("part").to_numpy()
        for p in np.unique(parts).tolist():
            yield p, group.filter(pa.array(parts == p))


def seams(tree: Tree, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each stretch the counts of contexts that others may share, by part and context; and sums of the tables of short contexts, by block."""
    total, held, size = np.zeros((int(OFFSETS[-1]), 2)), [], 0

    def add_up_slots() -> None:
        nonlocal size
        if held:
            total[:] += np.bincount(np.concatenate(held), minlength=2 * len(total)).reshape(-1, 2)
        held.clear()
        size = 0

    for part, rows in parts_of(batches):
        items, topic, c = rows.column("item").to_pylist(), rows.column("topic").to_numpy(), rows.column("c").to_numpy()
        bits = Bits(tree, items, topic)
        seen = c[bits.item] > 0
        held += [(2 * s + bits.bit)[seen] for s in bits.slots]  # each word counts once
        size += len(bits.slots) * len(bits.bit)
        if size > 4_000_000:
            add_up_slots()
        for topical in (False, True):
            contexts, n = bits.ends(topical, c)
            none = pa.nulls(len(contexts), pa.int32())
            yield made(part=pa.array([part] * len(contexts), pa.int32()), context=pa.array(contexts.view(np.int64)), zeros=pa.array(n[:, 0]), ones=pa.array(n[:, 1]), block=none, k=pa.nulls(len(contexts), pa.int64()), sums=pa.nulls(len(contexts), pa.binary()))
    add_up_slots()
    blocks = total.astype("<i8").reshape(-1, 2 * BLOCK)
    some = np.flatnonzero(blocks.any(1))
    n = len(some)
    yield made(part=pa.nulls(n, pa.int32()), context=pa.nulls(n, pa.int64()), zeros=pa.nulls(n, pa.float64()), ones=pa.nulls(n, pa.float64()), block=pa.array(some.astype(np.int32)), k=pa.array(some * 64 + xxhash.xxh3_64_intdigest(str(some[:8]) + str(total.sum())) % 64), sums=pa.array([blocks[k].tobytes() for k in some], pa.binary()))


class Evidence:
    """What the predictors say of each bit of a stretch: counts (bits, predictors, 2), each stretch's seams overridden by their sums over all."""

    def __init__(self, tree: Tree, short: np.ndarray, rows: pa.Table) -> None:
        own = rows.filter(pc.is_valid(rows.column("item")))
        seam = rows.filter(pc.is_valid(rows.column("context")))
        self.items, self.topic, self.c = own.column("item").to_pylist(), own.column("topic").to_numpy(), own.column("c").to_numpy()
        self.bits = bits = Bits(tree, self.items, self.topic)
        known = seam.column("context").to_numpy().view(np.uint64)
        order = np.argsort(known)
        sums = np.stack([seam.column("zeros").to_numpy(), seam.column("ones").to_numpy()], 1)[order]
        self.n = np.empty((PREDICTORS, len(bits.bit), 2), np.float32)
        for k, s in enumerate(bits.slots):
            np.take(short, s, 0, self.n[k], "clip")
        for k, topical in enumerate((False, True), len(SHORT)):
            bits.follow(topical, self.c, (known[order], sums), self.n[k])

    def without_own(self, some: slice) -> np.ndarray:
        """Counts without one occurrence of the item that the bit is of, as for one that is yet to be seen."""
        bit = self.bits.bit[some]
        own = np.stack([~bit, bit], 1).astype(np.float32)
        n = self.n[:, some].copy()
        n[len(SHORT) :] -= own
        n[: len(SHORT)] -= own * (self.c[self.bits.item[some]] == 1)[:, None]
        return np.maximum(n, 0, out=n)


def inputs(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logits (bits, predictors) of counts (predictors, bits, 2), and the gates that they select: how often the beginnings with and without the topic and the last bytes have been seen."""
    x = np.log((n[..., 1] + np.float32(0.4)) / (n[..., 0] + np.float32(0.4))).T
    level = lambda k, levels: np.searchsorted(levels, n[k, :, 0] + n[k, :, 1], "right")
    return x, (level(-1, LEVELS) * (len(LEVELS) + 1) + level(-2, LEVELS)) * (len(FEW) + 1) + level(len(SHORT) - 1, FEW)


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -17, 17)))


def bucketed(logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lower of the two buckets between which a logit lies, and the share of the upper."""
    at = np.clip((logit + 8) * 2, 0, BUCKETS - 1 - 1e-4)
    low = at.astype(np.int64)
    return low, at - low.astype(at.dtype)


class Mixer:
    """Weights by gate, learned online by AdaGrad on the log loss of weighted bits, and maps by node that learn what follows each mixed probability."""

    def __init__(self) -> None:
        self.w = np.full((GATES, PREDICTORS), 0.3)
        self.squares = np.full((GATES, PREDICTORS), 1e-6)
        self.visits = np.zeros(GATES)
        self.maps = np.zeros((255 * BUCKETS, 2))

    def learn(self, x: np.ndarray, gate: np.ndarray, node: np.ndarray, bit: np.ndarray, count: np.ndarray, rate: float = 0.1) -> None:
        x, gate, node, bit, count = map(np.ascontiguousarray, (x, gate, node, bit, count))  # each is gone through many times
        logit = np.einsum("ij,ij->i", self.w.astype(np.float32)[gate], x)
        error = (bit - squash(logit)) * count
        scale = np.bincount(gate, count, GATES)
        for k in range(PREDICTORS):
            slope = np.bincount(gate, error * x[:, k], GATES) / np.maximum(scale, 1)
            self.squares[:, k] += slope * slope
            self.w[:, k] += rate * slope / np.sqrt(self.squares[:, k])
        self.visits += scale
        low, share = bucketed(logit)
        for at, part in ((low, 1 - share), (low + 1, share)):
            self.maps += np.bincount((node * BUCKETS + at) * 2 + bit, count * part, self.maps.size).reshape(-1, 2)


@dataclass
class Model:
    tree: Tree
    short: np.ndarray
    w: np.ndarray
    maps: np.ndarray

    def log10(self, evidence: Evidence) -> np.ndarray:
        """For each item the log10 probability of its bits."""
        out, bits, w, maps = np.zeros(len(evidence.items)), evidence.bits, self.w.astype(np.float32), self.maps.astype(np.float32)
        for k in range(0, len(bits.bit), 1 << 16):
            some = slice(k, k + (1 << 16))
            x, gate = inputs(evidence.n[:, some])
            logit = np.einsum("ij,ij->i", w[gate], x)
            low, share = bucketed(logit)
            at = bits.node[some] * BUCKETS + low
            p = (squash(logit) + maps[at] * (1 - share) + maps[at + 1] * share) / 2
            p = np.clip(np.where(bits.bit[some], p, 1 - p), LEAST, 1)
            out += np.bincount(bits.item[some], np.log10(p), len(out))
        return out


def learned(tree: Tree, short: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weights of a task, times visits, by gate; and the sums of its maps, by node and bucket (after the gates)."""
    mixer = Mixer()
    for _, rows in parts_of(batches):
        seen = Evidence(tree, short, rows)
        told = [inputs(seen.without_own(slice(k, k + BLOCK * 16))) for k in range(0, len(seen.bits.bit), BLOCK * 16)]
        if not told:
            continue
        x, gate, count = np.concatenate([x for x, _ in told]), np.concatenate([g for _, g in told]), seen.c[seen.bits.item].astype(np.float64)
        steps = -(-len(count) // BATCH)
        for k in range(steps):  # every steps-th bit, so that what is learned from at a time is of the whole stretch
            some = slice(k, None, steps)
            mixer.learn(x[some], gate[some], seen.bits.node[some], seen.bits.bit[some], count[some])
    values = np.zeros((GATES + len(mixer.maps), PREDICTORS + 1))
    values[:GATES, 0], values[:GATES, 1:] = mixer.visits, mixer.w * mixer.visits[:, None]
    values[GATES:, :2] = mixer.maps
    some = np.flatnonzero(values.any(1))
    yield made(cell=pa.array(some.astype(np.int32)), values=pa.array(list(values[some]), pa.list_(pa.float64())))


def counted_pairs(batches: Iterator[pa.RecordBatch], classes: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """How often each item has each topic in training texts; those of other texts only are counted 0."""
    schema = pa.schema([("item", pa.string()), ("topic", pa.int32()), ("c", pa.int64())])
    for batch in batches:
        texts = Texts(batch.column("text"))
        train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
        (word, topic, learn), n = texts.grouped(texts.ids, texts.topics(classes), train[texts.row].astype(np.int64))
        names, word, (topic, n) = expanded(texts.names, word, topic, n * learn)
        yield from told(pa.table({"item": names.take(pa.array(word)), "topic": pa.array(topic.astype(np.int32)), "c": pa.array(n)}), schema)


def dealt(rows: DataFrame) -> DataFrame:
    """Stretches whole in tasks, items in order."""
    return rows.repartition("part").sortWithinPartitions("part", "item", "topic")


def stretched(pairs: DataFrame, tree: Broadcast) -> tuple[DataFrame, np.ndarray]:
    """pairs (item, topic, c) by stretches of their order, with rows (context, zeros, ones) for what each stretch shares with others; and the tables of short contexts."""
    spark = pairs.sparkSession
    chars = pairs.agg(F.sum(F.length("item"))).first()[0] or 0
    stretches = 1 + chars // STRETCH
    parts = durable(pairs.repartitionByRange(stretches, F.concat("item", F.lit(" "))).withColumn("part", F.spark_partition_id()), "stretches")
    schema = "part int, context long, zeros double, ones double, block int, k long, sums binary"
    found = durable(in_arrow(dealt(parts.select("part", "item", "topic", "c")), lambda b: seams(tree.value, b), schema), "seams")
    level = found.where("block IS NOT NULL").select("block", "k", "sums")
    for key in ("k", "block"):
        level = in_arrow(level.repartition(key).sortWithinPartitions(key), lambda b, key=key: add_up(b, key, "<i8"), "block int, k long, sums binary")
    short = np.zeros((int(OFFSETS[-1]) // BLOCK, 2 * BLOCK), np.float32)
    for r in level.select("block", "sums").toLocalIterator():  # a table of fixed size, whatever the corpus
        short[r["block"]] = np.frombuffer(r["sums"], "<i8")

    seam = found.where("context IS NOT NULL").select("part", "context", "zeros", "ones")
    sums = seam.groupBy("context").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    seam = seam.select("part", "context").join(sums, "context").select("part", F.lit(None).cast("string").alias("item"), F.lit(None).cast("int").alias("topic"), F.lit(None).cast("long").alias("c"), "context", "zeros", "ones")
    own = parts.select("part", "item", "topic", "c", F.lit(None).cast("long").alias("context"), F.lit(0.0).alias("zeros"), F.lit(0.0).alias("ones"))
    return durable(own.unionByName(seam), "evidence"), short.reshape(-1, 2)


def train(pairs: DataFrame, tree: Tree) -> DataFrame:
    """Scores of items under topics from their counts: pairs (item, topic, c) with total (c over all topics), one (true once an item) and logp."""
    spark = pairs.sparkSession
    shared = spark.sparkContext.broadcast(tree)
    rows, short = stretched(pairs, shared)
    model = spark.sparkContext.broadcast(short)
    values = in_arrow(dealt(rows.where("c IS NULL OR c > 0")), lambda b: learned(shared.value, model.value, b), "cell int, values array<double>")
    sums = values.groupBy("cell").agg(*(F.sum(F.col("values")[k]).alias(f"v{k}") for k in range(PREDICTORS + 1)))
    mixer = Mixer()
    for r in sums.collect():  # gates and maps, whatever the corpus
        if r["cell"] < GATES:
            mixer.w[r["cell"]] = np.array(r[2:]) / max(r[1], 1e-9)
        else:
            mixer.maps[r["cell"] - GATES] = r[1:3]
    middle = squash((np.arange(BUCKETS) / 2) - 8)
    ones = mixer.maps.reshape(255, BUCKETS, 2)
    maps = (ones[..., 1] + 4 * middle) / (ones.sum(2) + 4)
    final = spark.sparkContext.broadcast((mixer.w, maps.reshape(-1)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixed = Model(shared.value, model.value, *final.value)
        for _, part in parts_of(batches):
            seen = Evidence(mixed.tree, mixed.short, part)
            items = pa.array(seen.items, pa.string()).dictionary_encode()
            place = items.indices.to_numpy(zero_copy_only=False)
            total = np.bincount(place, seen.c, len(items.dictionary)).astype(np.int64)[place] if len(place) else seen.c
            one = np.zeros(len(place), bool)
            one[np.unique(place, return_index=True)[1]] = True
            yield made(item=pa.array(seen.items, pa.string()), topic=pa.array(seen.topic.astype(np.int32)), total=pa.array(total), one=pa.array(one), logp=pa.array(mixed.log10(seen)))

    return durable(in_arrow(dealt(rows), scored, "item string, topic int, total long, one boolean, logp double"), "scored")


def lm_scores(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """docs (key, text) scored: key, held_out, n_tokens, n_known, train_tokens (long), base_score, score (double), n_bytes (long), bits_per_byte.

    Texts whose key is not held out (crc32 of the key as text, modulo 7, is not 2) train. Tokens are the words between ASCII white space, A-Z
    lower-cased, and one end. base_score: log10 of add-one unigram probabilities. score: log10 of what the model gives the same tokens, words
    spelled with a space behind; bits_per_byte: that in bits by n_bytes, the bytes spelled. Counts come from all training texts. The mixer, a small
    classifier of bits, learns from the words of all of them, each bit from counts without it, online in each task; tasks' weights are averaged
    by how often gates were open. A null text is empty and has the end alone; a null key trains; repeated rows are scored alike, and each counts;
    other columns are left out; no documents give no rows, and without training texts every bit is even.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{key}`").alias("__key"), held_out(key).alias("held_out"), F.col("text").cast("string").alias("text"))
    found = durable(in_arrow(texts.where("NOT held_out").select("text"), statistics, "kind int, a string, b string, n long"), "statistics")
    sums = found.groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    pairs = sums.where("kind = 1")
    leaders = pairs.where("a = b").orderBy(F.desc("n"), "a").limit(GATE_WORDS).select("a")
    pairs = pairs.join(F.broadcast(leaders), "a", "left_semi").join(F.broadcast(leaders.select(F.col("a").alias("b"))), "b", "left_semi")
    classes = topic_classes(sorted((r["a"], r["b"], r["n"]) for r in pairs.select("a", "b", "n").collect()))  # GATE_WORDS squared at most
    counts = np.zeros(256, np.int64)
    for r in sums.where("kind = 2").collect():
        counts[int(r["a"])] = r["n"]

    partial = in_arrow(texts.select("held_out", "text"), lambda b: counted_pairs(b, classes), "item string, topic int, c long")
    scored = train(durable(partial.groupBy("item", "topic").agg(F.sum("c").alias("c")), "pairs"), byte_tree(counts))
    whole = "one AND (length(item) < {0} AND NOT startswith(item, '\t') OR startswith(item, '\x0b'))".format(PIECE)
    tokens, words = scored.where(whole).agg(F.coalesce(F.sum("total"), F.lit(0)), F.count_if(F.col("total") > 0)).first()
    top = scored.where("one").select("item", "total").orderBy(F.desc("total"), "item").limit(HELD_ITEMS)
    top = scored.join(F.broadcast(top.select("item")), "item", "left_semi").toArrow()  # HELD_ITEMS items under TOPICS + 1 topics at most
    code = top.column("item").combine_chunks().dictionary_encode()
    place = code.indices.to_numpy(zero_copy_only=False)
    table = np.full((len(code.dictionary), TOPICS + 1), np.nan)
    table[place, top.column("topic").to_numpy()] = top.column("logp").to_numpy()
    total = np.zeros(len(code.dictionary), np.int64)
    total[place] = top.column("total").to_numpy()
    held = spark.sparkContext.broadcast((code.dictionary.to_pylist(), table, total))
    even = float(tokens + words + 1)

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, table, total = held.value
        items = pa.array(items, pa.large_string())
        for batch in batches:
            texts = Texts(batch.column("text"))
            (row, word, topic), n = texts.grouped(texts.row, texts.ids, texts.topics(classes))
            size = pc.binary_length(texts.names).to_numpy(zero_copy_only=False).astype(np.int64) + 1 - pc.equal(texts.names, "\n").to_numpy(zero_copy_only=False)
            add = lambda values, at=row: np.bincount(at, values, texts.n)
            out = {"n_tokens": add(n).astype(np.int64), "n_bytes": add(n * size[word]).astype(np.int64)}
            named, word, (row, topic, n) = expanded(texts.names, word, row, topic, n)
            at = pc.index_in(named, items).fill_null(-1).to_numpy(zero_copy_only=False)[word] if len(items) else np.full(len(word), -1)
            logp = np.where(at >= 0, table[at, topic], np.nan) if len(items) else np.full(len(word), np.nan)
            here = ~np.isnan(logp)
            whole = pc.and_(pc.less(pc.utf8_length(named), PIECE), pc.invert(pc.starts_with(named, "\t")))
            whole = pc.or_(whole, pc.starts_with(named, "\x0b")).to_numpy(zero_copy_only=False)[word]
            c, counted = total[at[here]] if len(items) else at[here], n[here] * whole[here]
            out |= {"n_known": add(counted * (c > 0), row[here]).astype(np.int64), "base": add(counted * np.log10((c + 1) / even), row[here]), "score": add(n[here] * logp[here], row[here])}
            rest = ~here
            ends = np.cumsum(np.bincount(row[rest], minlength=texts.n))
            order = np.argsort(row[rest], kind="stable")
            cells = pa.StructArray.from_arrays([named.take(pa.array(word[rest][order])).cast(pa.string()), pa.array(topic[rest][order].astype(np.int32)), pa.array(n[rest][order]), pa.array(whole[rest][order])], ["item", "topic", "n", "whole"])
            yield made(__row=batch.column("__row"), __key=batch.column("__key"), held_out=batch.column("held_out"), **{k: pa.array(v) for k, v in out.items()}, rest=pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), cells))

    source = texts.withColumn("__row", F.monotonically_increasing_id())
    mine = durable(in_arrow(source, of_texts, fields(source, "__row", "__key", "held_out") + ", n_tokens long, n_bytes long, n_known long, base double, score double, rest array<struct<item:string,topic:int,n:long,whole:boolean>>"), "texts")
    rest = mine.select("__row", F.explode("rest").alias("x")).select("__row", "x.*").join(scored, ["item", "topic"])
    once = F.when(F.col("whole"), F.col("n")).otherwise(F.lit(0))
    rest = rest.groupBy("__row").agg(F.sum(F.when(F.col("total") > 0, once).otherwise(F.lit(0))).alias("known2"), F.sum(once * F.log10((F.col("total") + 1) / F.lit(even))).alias("base2"), F.sum(F.col("n") * F.col("logp")).alias("score2"))
    out = mine.drop("rest").join(rest, "__row", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    out = out.withColumn("score", plus("score", "score2"))
    return out.select(
        F.col("__key").alias(key),
        "held_out",
        "n_tokens",
        plus("n_known", "known2").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        plus("base", "base2").alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).alias("bits_per_byte"),
    )
