"""Quality scores of documents: random-indexing word vectors, pooled, and a two-layer network with calibrated probabilities."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MIX, different_words, durable, ends_of, fields, gathered, in_arrow, made, mix64, slices, whole_groups

#: Words are hashed to so many rows of the vector table; each row has so many parts. The table is a fixed 4 MB at any size of corpus, and words that share a row share its vector.
ROWS, PARTS = 1 << 15, 32
#: Words of which a worker remembers the rows.
REMEMBER = 150_000
#: Each word's index vector has so many parts of +1 or -1; neighbours this far away count.
NONZERO, REACH = 2, 2
#: Rows of the table in one block of the sums.
BLOCK = 256


class Tokens:
    """Rows of the table for the tokens of texts: runs of word characters and runs of others, case and all."""

    def __init__(self) -> None:
        self.known: dict[str, bytes] = {}
        self.split = re.compile(r"\w+|[^\w\s]+").findall

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The rows of all tokens of all texts, and how many each text has."""
        if len(self.known) > REMEMBER:
            self.known.clear()
        words, place, counts = different_words(texts)
        new = [w for w in words if w not in self.known]
        parts = [[w] if w.isalnum() else self.split(w) for w in new]
        raw = np.array([xxhash.xxh3_64_intdigest(x) % ROWS for p in parts for x in p], "<i4").tobytes()
        ends = np.cumsum([0, *map(len, parts)]) * 4
        self.known.update((w, raw[a:b]) for w, a, b in zip(new, ends.tolist(), ends[1:].tolist()))
        rows = list(map(self.known.__getitem__, words))
        out, ends = gathered(np.frombuffer(b"".join(rows), "<i4"), np.fromiter(map(len, rows), np.int64, len(rows)) // 4, place)
        ends = ends_of(ends, counts)
        return out, np.diff(ends, prepend=0)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For each row its NONZERO places and signs."""
    h = mix64(np.arange(1, ROWS * NONZERO + 1, dtype=np.uint64) * MIX).reshape(ROWS, NONZERO)
    return (h % np.uint64(PARTS)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors of neighbours for each row of the table, over a partition; blocks of it as 32-bit integers."""
    tokens, total, (place, sign) = Tokens(), np.zeros(ROWS * PARTS), index_vectors()
    for part, _ in slices(batches):
        ids, size = tokens.rows(part)
        ids, doc = ids.astype(np.int64), np.repeat(np.arange(len(size)), size)
        for d in range(1, REACH + 1):
            same = doc[:-d] == doc[d:]
            a, b = ids[:-d][same], ids[d:][same]
            for k in range(NONZERO):
                at = np.concatenate([a * PARTS + place[b, k], b * PARTS + place[a, k]])
                total += np.bincount(at, np.concatenate([sign[b, k], sign[a, k]]), ROWS * PARTS)
    pid, blocks = TaskContext.get().partitionId(), np.clip(total, -(2**31), 2**31 - 1).astype("<i4").reshape(-1, BLOCK * PARTS)
    some = np.flatnonzero(blocks.any(1))
    yield made(block=pa.array(some.astype(np.int32)), k=pa.array(some * 64 + pid % 64), sums=pa.array([blocks[k].tobytes() for k in some], pa.binary()))


def add_up(batches: Iterator[pa.RecordBatch], key: str, width: str) -> Iterator[pa.RecordBatch]:
    """Sums of blocks with equal keys, in a stream sorted by key, as 64-bit integers."""
    for rows in whole_groups(batches, key, 64):
        keys = rows.column(key).to_numpy()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sums = rows.column("sums").to_pylist()
        total = [np.sum([np.frombuffer(x, width) for x in sums[a:b]], 0, dtype=np.int64).astype("<i8").tobytes() for a, b in zip(first, [*first[1:], len(keys)])]
        yield made(block=rows.column("block").take(pa.array(first)).combine_chunks(), k=rows.column("k").take(pa.array(first)).combine_chunks(), sums=pa.array(total, pa.binary()))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of all rows of the table, from the whole corpus: centred, of length 1. Blocks are added up in two levels; the table has a fixed size."""
    schema = "block int, k long, sums binary"
    blocks = durable(in_arrow(docs, contexts, schema), "contexts")
    level = in_arrow(blocks.repartition("k").sortWithinPartitions("k"), lambda x: add_up(x, "k", "<i4"), schema)
    level = in_arrow(level.repartition("block").sortWithinPartitions("block"), lambda x: add_up(x, "block", "<i8"), schema)
    table = np.zeros((ROWS // BLOCK, BLOCK * PARTS))
    for r in level.select("block", "sums").collect():  # the table: ROWS rows, whatever the corpus
        table[r["block"]] = np.frombuffer(r["sums"], "<i8")
    table = table.reshape(ROWS, PARTS)
    norm = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    table = norm(table)
    seen = table.any(1)
    return np.where(seen[:, None], norm(table - table[seen].mean(0) if seen.any() else table), 0).astype(np.float32)


def pool(tokens: Tokens, vectors: np.ndarray, texts: list[str]) -> np.ndarray:
    """For each text the mean and the spread of its word vectors, the logarithm of its tokens, the share of different ones, and of tokens equal to the one before."""
    ids, size = tokens.rows(texts)
    out = np.zeros((len(texts), 2 * PARTS + 3), np.float32)
    ends = np.cumsum(size)
    at = 0
    while at < len(texts):  # some texts at a time, as their vectors take 128 bytes a token
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 200_000, "right")))
        for d in range(at, end):
            mine = ids[ends[d] - size[d] : ends[d]]
            if not len(mine):
                continue
            n, mean, square = len(mine), np.zeros(PARTS), np.zeros(PARTS)
            for k in range(0, n, 100_000):  # some tokens at a time, however long the text
                v = vectors[mine[k : k + 100_000]]
                mean += v.sum(0, dtype=np.float64) / n
                square += np.einsum("ij,ij->j", v, v) / n
            out[d] = [*mean, *np.sqrt(np.maximum(square - mean**2, 0)), np.log1p(n), len(np.unique(mine)) / n, float((mine[1:] == mine[:-1]).sum()) / n]
        at = end
    return out


@dataclass
class Network:
    """x -> sigmoid(w2 . tanh(w1 x + b1) + b2, over temperature), on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(np.float64)) / self.temperature, -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, rate: float = 3e-3, decay: float = 1e-4, seed: int = 11) -> Network:
    """Adam on four fifths of the rows, then the temperature of least log loss on the fifth. With one label only, or no rows, a constant score."""
    rng = np.random.default_rng(seed)
    x = x.astype(np.float64)
    width = x.shape[1]
    mean, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(width), np.ones(width))
    net = Network(mean, scale, rng.standard_normal((width, hidden)) / np.sqrt(width), np.zeros(hidden), rng.standard_normal(hidden) / np.sqrt(hidden), 0.0)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        net.w2, net.b2 = np.zeros(hidden), float(np.log(share / (1 - share)))
        return net
    order = rng.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5 :]
    z, t = (x[used] - mean) / scale, y[used].astype(float)
    values = [net.w1, net.b1, net.w2, np.array([0.0])]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(epochs):
        shuffled = rng.permutation(len(z))
        for k in range(0, len(z), 128):
            i = shuffled[k : k + 128]
            h = np.tanh(z[i] @ values[0] + values[1])
            e = (1 / (1 + np.exp(-(h @ values[2] + values[3][0]))) - t[i]) / len(i)
            back = e[:, None] * values[2] * (1 - h * h)
            grads = [z[i].T @ back + decay * values[0], back.sum(0), h.T @ e + decay * values[2], np.array([e.sum()])]
            step += 1
            for v, g, m, s in zip(values, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * m / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = values[0], values[1], values[2], float(values[3][0])
    if len(held):
        logit, truth = net.logits(x[held]), y[held]
        loss = lambda temperature: np.mean(np.logaddexp(0, np.where(truth == 1, -logit, logit) / temperature))
        net.temperature = float(min(np.geomspace(0.25, 8, 200), key=loss))
    return net


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % 4 == 2, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = 20_000, threshold: float = 0.7, key: str = "doc_id", passing: bool = False) -> DataFrame:
    """docs (key, text) scored: key, held_out, score (0 to 1) and predicted (1 if score >= threshold, else 0); with passing, row (a
    struct of all columns of docs, whatever their names) instead of key.

    Learns from labels (key, quality 0 or 1): of rows whose key is not held out (crc32 of the key as text, modulo 4, is not
    2), at most sample, those with the least hashes of their keys; a key with several labels has the least. Word vectors come
    from all docs. Only the text makes a score. A null or empty text is scored as one without tokens; equal texts have equal
    scores; a null key is not held out and never labelled; of rows that share a labelled key the least text is learned from.
    Without labels of both kinds all scores are the same, and no documents give no rows.
    """
    spark, text = docs.sparkSession, F.col("text").cast("string")
    table = spark.sparkContext.broadcast(word_vectors(docs.select(text.alias("text"))))  # 4 MB
    known = labels.where(F.col(f"`{key}`").isNotNull() & F.col("quality").isin(0, 1)).where(~held_out(key))
    known = known.groupBy(F.col(f"`{key}`").alias("k")).agg(F.min("quality").cast("int").alias("quality"))
    known = durable(known.orderBy(F.xxhash64("k"), "k").limit(sample), "labels")  # at most sample rows, so fit to be broadcast

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for part, rows in slices(batches):
            yield made(quality=rows.column("quality"), x=pa.array(list(pool(tokens, table.value, part)), pa.list_(pa.float32())))

    # of rows that share a key the least text counts
    seen = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(text, F.lit("")).alias("text")).join(F.broadcast(known), "k").groupBy("k").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))
    rows = in_arrow(seen.select("quality", "text"), pooled, "quality int, x array<float>").collect()  # at most sample rows
    rows = sorted((tuple(r["x"]), r["quality"]) for r in rows)  # the same net however rows arrive
    x, y = np.array([r[0] for r in rows], np.float32).reshape(len(rows), 2 * PARTS + 3), np.array([r[1] for r in rows], np.int64)
    net = fit(x, y)
    # columns of docs travel in one, so that none can clash
    held = F.struct(*(F.col(f"`{c}`") for c in (docs.columns if passing else [key])))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for part, rows in slices(batches, "__text"):
            yield made(__row=rows.column("__row"), __score=pa.array(net.score(pool(tokens, table.value, part)), pa.float64()))

    source = docs.select(held.alias("__row"), text.alias("__text"))
    out = in_arrow(source, scored, fields(source, "__row") + ", __score double")
    own = {"held_out": held_out(f"__row`.`{key}"), "score": F.col("__score"), "predicted": (F.col("__score") >= threshold).cast("int")}
    if passing:
        return out.select(F.col("__row").alias("row"), *(c.alias(n) for n, c in own.items()))
    return out.select(F.col("__row")[key].alias(key), *(c.alias(n) for n, c in own.items()))
