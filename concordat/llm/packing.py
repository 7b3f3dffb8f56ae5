"""Best-fit packing of token sequences, planned on lengths alone.

How many pieces there are of each length says all that a packing needs, and has at most as many rows as a sequence has
tokens, whatever the corpus. The plan gives runs: pieces of one length, by rank, go to a range of sequences at one place.
Each piece finds its run from its rank among the pieces of its length, so that no bin, key or hot group is ever one task.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, fields, in_arrow, made, slices, small, whole_groups

#: Runs up to this many are broadcast (48 bytes each); beyond it they are joined by shuffle, by so many ranks of a length at a time.
BROADCAST_RUNS, STRETCH = 100_000, 1 << 16


class CapacityTree:
    """A segment tree over capacities 0..size: how many open bins have each, and the least capacity that suffices."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, bins: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += bins
            at >>= 1

    def at_least(self, need: int) -> int | None:
        at = need + self.leaves
        if self.count[at]:
            return need
        while at > 1:
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


class TreeBins:
    """Open bins by residual tokens; best fit is the least residual that holds the piece."""

    def __init__(self, size: int) -> None:
        self.start, self.tree = size, CapacityTree(size)

    def best(self, length: int) -> int | None:
        return self.tree.at_least(length)

    def room(self, left: int, length: int) -> int:
        return left // length

    def after(self, left: int, length: int, pieces: int) -> int:
        return left - length * pieces

    def change(self, left: int, bins: int) -> None:
        self.tree.add(left, bins)


class VectorBins:
    """Open bins by residual (tokens, documents, attention cost); a piece of n tokens takes (n, 1, n * n).

    score "norm": the weighted squared norm of what would be left, least first, each part as a share of its capacity;
    "dot": the weighted product of what the piece takes and what the bin has left, largest first. Every part must fit.
    """

    def __init__(self, size: int, documents: int | None = None, cost: int | None = None, weights: tuple[float, float, float] = (1.0, 0.05, 0.05), score: str = "norm") -> None:
        self.start = (size, documents or size, cost or size * size)
        self.weights, self.score = np.array(weights), score
        self.fewest = self.start[1]  # documents that the fullest sequence has room for
        self.keys: dict[tuple[int, int, int], int] = {}
        self.left = np.zeros((64, 3), np.int64)
        self.open = np.zeros(64, bool)
        self.free = list(range(64))

    def best(self, length: int) -> tuple[int, int, int] | None:
        need = np.array([length, 1, length * length])
        fits = np.flatnonzero(self.open & (self.left >= need).all(1))
        if not len(fits):
            return None
        size = np.array(self.start, float)
        if self.score == "dot":
            value = -((self.left[fits] / size) * (need / size) * self.weights).sum(1)
        else:
            value = ((((self.left[fits] - need) / size) ** 2) * self.weights).sum(1)
        return tuple(self.left[fits[int(value.argmin())]].tolist())

    def room(self, left: tuple[int, int, int], length: int) -> int:
        most = min(left[0] // length, left[1], left[2] // (length * length))
        return most if self.score == "norm" else min(most, 1)

    def after(self, left: tuple[int, int, int], length: int, pieces: int) -> tuple[int, int, int]:
        return left[0] - length * pieces, left[1] - pieces, left[2] - length * length * pieces

    def change(self, left: tuple[int, int, int], bins: int) -> None:
        self.fewest = min(self.fewest, left[1])
        at = self.keys.get(left)
        if at is None:
            if not self.free:
                n = len(self.open)
                self.left, self.open = np.vstack([self.left, np.zeros_like(self.left)]), np.concatenate([self.open, np.zeros(n, bool)])
                self.free = list(range(n, 2 * n))
            at = self.keys[left] = self.free.pop()
            self.left[at], self.open[at] = left, True
        elif not bins:
            self.open[at] = False
            self.free.append(self.keys.pop(left))


def plan(counts: dict[int, int], bins: TreeBins | VectorBins) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit by decreasing length: runs (length, first rank, end rank, pieces in a sequence, first sequence, offset).

    All pieces of a length are placed together: the best open bins take as many as they hold, then the next best, then
    new ones, which is what placing them one after the other gives.
    """
    held: dict[object, list[list[int]]] = defaultdict(list)
    runs: list[tuple[int, int, int, int, int, int]] = []
    size = bins.start if isinstance(bins.start, int) else bins.start[0]
    made = 0

    def put(key: object, first: int, end: int) -> None:
        bins.change(key, end - first)
        held[key].append([first, end])

    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            key = bins.best(length)
            if key is None:
                each = bins.room(bins.start, length)
                if not each:
                    raise ValueError(f"a piece of {length} tokens fits in no sequence")
                many = max(1, (total - rank) // each)
                key, first, end = bins.start, made, made + many
                made += many
            else:
                each = bins.room(key, length)
                first, end = held[key].pop()
                many = min(end - first, max(1, (total - rank) // each))
                if first + many < end:
                    held[key].append([first + many, end])
                    end = first + many
                if isinstance(bins, TreeBins):
                    bins.change(key, first - end)
                elif not held[key]:
                    bins.change(key, 0)
            each = min(each, total - rank)
            left = key if isinstance(key, int) else key[0]
            runs.append((length, rank, rank + many * each, each, first, size - left))
            rank += many * each
            put(bins.after(key, length, each), first, end)
    return runs


def sequences(runs: list[tuple[int, int, int, int, int, int]]) -> int:
    """How many sequences a plan has."""
    return max((first + -(-(end - rank) // each) for _, rank, end, each, first, _ in runs), default=0)


def tightest(counts: dict[int, int], size: int, steps: int = 2, **options) -> VectorBins:
    """Bins with a limit of documents a sequence that costs no sequence: the least found in some halvings between one and what the
    fullest sequence of the plan without a limit has. Plans take the counts of lengths only, so this costs the same for any corpus.

    Documents and not attention cost, as a piece of size tokens must fit: its cost is the square of size, and of the squares of lengths
    that add up to size the sum is never more.
    """
    free = VectorBins(size, **options)
    least = sequences(plan(counts, free))
    low, high = 1, max(1, free.start[1] - free.fewest)
    for _ in range(steps):
        middle = max(low + 1, round((low * high) ** 0.5))
        if middle >= high:
            break
        if sequences(plan(counts, VectorBins(size, documents=middle, **options))) <= least:
            high = middle
        else:
            low = middle
    return VectorBins(size, documents=high, **options)


def ranked(pieces: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """pieces (..., length, pid, at) with a rank among those of equal length, and how many there are of each length.

    at counts equal lengths within partition pid, so ranks need only sums over (pid, length), never a sort of a length's pieces.
    """
    counts = durable(pieces.groupBy("pid", "length").agg(F.count("*").alias("n")), "lengths")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one row a length
    before = counts.selectExpr("pid", "length", "sum(n) OVER (PARTITION BY length ORDER BY pid) - n AS before")
    before = F.broadcast(before) if small(before, BROADCAST_RUNS) else before
    return pieces.join(before, ["pid", "length"]).withColumn("rank", F.col("before") + F.col("at")).drop("before", "at", "pid"), totals


def pack(pieces: DataFrame, bins: TreeBins | VectorBins | Callable[[dict[int, int]], TreeBins | VectorBins]) -> DataFrame:
    """pieces (..., length, pid, at), held durably, with sequence_id and offset (long). bins: open bins, or what gives them for the counts of lengths.

    Columns are handed on as they are, whatever their types; repeated and null keys are pieces like any other; no pieces give no rows.
    Pieces of equal length are alike to a plan: which of them goes where follows from the partition and place that cut() gave them.
    """
    spark = pieces.sparkSession
    rows, totals = ranked(pieces)
    runs = plan(totals, bins if isinstance(bins, (TreeBins, VectorBins)) else bins(totals))
    schema = "length int, first long, end long, each long, sequence long, place long"
    told = spark.createDataFrame(pd.DataFrame(runs, columns=["length", "first", "end", "each", "sequence", "place"]).astype({"length": "int32"}) if runs else [], schema)
    within = (rows["rank"] >= told["first"]) & (rows["rank"] < told["end"])
    if len(runs) <= BROADCAST_RUNS:
        found = rows.join(F.broadcast(told), (rows["length"] == told["length"]) & within)
    else:  # by length and stretch of ranks, so that neither a length nor its runs are one key
        told = told.withColumn("stretch", F.explode(F.expr(f"sequence(first div {STRETCH}, (end - 1) div {STRETCH})")))
        rows = rows.withColumn("stretch", F.expr(f"rank div {STRETCH}"))
        within = (rows["rank"] >= told["first"]) & (rows["rank"] < told["end"])
        found = rows.join(told, (rows["length"] == told["length"]) & (rows["stretch"] == told["stretch"]) & within)
    return found.select(
        *(rows[c] for c in rows.columns if c not in ("rank", "stretch")),
        (F.col("sequence") + F.expr("(rank - first) div each")).alias("sequence_id"),
        (F.col("place") + F.expr("(rank - first) % each") * rows["length"]).cast("long").alias("offset"),
    )


def cut(docs: DataFrame, encoder: Callable[[], Callable[[list[str]], list[bytes]]], size: int, end_id: int | None, key: str = "doc_id", ids: bool = False, width: int = 4) -> DataFrame:
    """Documents (key, text) tokenized, closed by end_id and cut where longer than size: key, piece int, start long, length int,
    ids_crc32 long, pid int, at long and, if asked, ids (binary, little-endian, width bytes an id).

    encoder() gives, once a task, a function from texts to little-endian unsigned 32-bit ids. A null text is empty; a
    document without any id has no piece; an id that width bytes don't hold is an error. Keys of any type are handed on as they are,
    null or repeated; other columns are left out. Written durably, as ranks need stable partitions.
    """
    close = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pid = encoder(), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for texts, rows in slices(batches, "__text"):
            from_, out = [], []
            for k, held in enumerate(encode(texts)):
                held += close
                for n, at in enumerate(range(0, len(held), 4 * size)):
                    part = held[at : at + 4 * size]
                    length = len(part) // 4
                    crc = zlib.crc32(part)
                    if ids and width < 4:
                        wide = np.frombuffer(part, "<u4")
                        if int(wide.max()) >> 8 * width:
                            raise ValueError(f"an id of {int(wide.max())} needs more than {width} bytes")
                        part = wide.astype(f"<u{width}").tobytes()
                    from_.append(k)
                    out.append((n, at // 4, length, crc, seen[length], part if ids else None))
                    seen[length] += 1
            piece, start, length, crc, at, parts = zip(*out) if out else ((),) * 6
            columns = {
                key: rows.column(0).take(pa.array(from_, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int32()),
                "ids_crc32": pa.array(crc, pa.int64()),
                "pid": pa.array([pid] * len(out), pa.int32()),
                "at": pa.array(at, pa.int64()),
            }
            yield made(**columns, **({"ids": pa.array(parts, pa.binary())} if ids else {}))

    kept = docs.select(F.col(f"`{key}`"), F.col("text").cast("string").alias("__text"))
    schema = fields(kept, key) + ", piece int, start long, length int, ids_crc32 long, pid int, at long" + ", ids binary" * ids
    return durable(in_arrow(kept, run, schema), "pieces")


def assemble(packed: DataFrame, size: int, key: str = "doc_id", width: int = 2, pad: int = 0) -> DataFrame:
    """Rows of the packed id matrix: sequence_id, n_tokens, doc_ids, pieces (both by place), cu_seqlens (0, then where each
    segment ends), position_resets (where positions start again at 0) and input_ids (size ids of width bytes, padded).

    packed: what pack() gives for pieces with ids. Keys are handed on as they are, null or repeated; other columns are left out; no
    pieces give no rows. A sequence is at most size tokens, so no task holds more than some hundred of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fill = np.full(size, pad, f"<u{width}").tobytes()
        for rows in whole_groups(batches, "sequence_id", 256):
            rows = rows.combine_chunks()
            sequence, offset, length = (rows.column(c).to_numpy() for c in ("sequence_id", "offset", "length"))
            first = np.flatnonzero(np.concatenate([[True], sequence[1:] != sequence[:-1]]))
            last = np.append(first[1:], len(sequence))
            whole = (offset + length)[last - 1]
            if (np.add.reduceat(length, first) != whole).any():
                raise ValueError("a sequence has gaps")
            ids = rows.column("ids").to_pylist()
            matrix = [b"".join(ids[a:b]) for a, b in zip(first, last)]
            bounds = pa.array(np.append(first, len(sequence)).astype(np.int32))
            lists = lambda values: pa.ListArray.from_arrays(bounds, values)
            yield made(
                sequence_id=pa.array(sequence[first]),
                n_tokens=pa.array(whole.astype(np.int32)),
                **{f"{key}s": lists(rows.column(key).combine_chunks()), "pieces": lists(rows.column("piece").combine_chunks())},
                cu_seqlens=pa.array([[0, *(offset[a:b] + length[a:b]).tolist()] for a, b in zip(first, last)], pa.list_(pa.int32())),
                position_resets=lists(pa.array(offset.astype(np.int32))),
                input_ids=pa.array([row + fill[len(row) :] for row in matrix], pa.binary()),
            )

    kind = packed.schema[key].dataType.simpleString()
    schema = f"sequence_id long, n_tokens int, `{key}s` array<{kind}>, pieces array<int>, cu_seqlens array<int>, position_resets array<int>, input_ids binary"
    rows = packed.select("sequence_id", "offset", "length", key, "piece", "ids").repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    return in_arrow(rows, run, schema)


def write_matrices(rows: DataFrame, path: str, size: int, width: int = 2, pad: int = 0) -> None:
    """Assembled rows as Parquet shards in order of sequence, each with its part of the id matrix, the cumulative lengths and the
    position resets, and size, width and pad as columns of one value, which Parquet keeps in a few bytes."""
    told = rows.withColumns({"row_tokens": F.lit(size), "id_bytes": F.lit(width), "pad_id": F.lit(pad)})
    told.repartitionByRange("sequence_id").sortWithinPartitions("sequence_id").write.parquet(path)


def matrices(rows: pd.DataFrame, size: int, width: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """The id matrix and the matrix of positions (restarting in every segment, 0 in the padding) of assembled rows."""
    ids = np.frombuffer(b"".join(rows["input_ids"]), f"<u{width}").reshape(len(rows), size)
    places = np.zeros((len(rows), size), np.int64)
    for r, (ends, n) in enumerate(zip(rows["cu_seqlens"], rows["n_tokens"])):
        starts = np.asarray(ends[:-1])
        places[r, :n] = np.arange(n) - np.repeat(starts, np.diff(ends))
    return ids, places
