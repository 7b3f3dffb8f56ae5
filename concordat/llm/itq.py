"""Near copies among vectors: learned balanced binary codes, multi-index Hamming tables, rerank with the vectors themselves."""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, comb, cos, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dealt, discard, durable, fields, in_arrow, in_units, made, pair_blocks, partners, settle, small, whole_groups, with_cores
from .ngram import roots

#: Bits of a code, one for each sign under a rotation.
BITS = 64
#: Bits that a table's substrings may differ by: each vector enters its bucket and those one bit away.
APART = 2
#: Members of a bucket compared in one unit; larger buckets are cut in chunks, and pairs of chunks are units.
CHUNK = 2048
#: Bytes of the vectors on which rotations are fitted, beside their number.
SAMPLE_BYTES = 64 << 20


def learn(sample: np.ndarray, bits: int, rounds: int = 50, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Iterative quantisation: the mean and a projection to bits whose signs lose least: principal directions, then a rotation
    that in turn fits the signs (B = sign(VR)) and is fitted to them (the orthogonal Procrustes solution)."""
    mean = sample.mean(0)
    x = sample - mean
    value, vector = np.linalg.eigh(x.T @ x)
    w = vector[:, np.argsort(-value)[:bits]]
    v = x @ w
    r = np.linalg.qr(np.random.default_rng(seed).standard_normal((w.shape[1], w.shape[1])))[0]
    for _ in range(rounds):
        b = np.where(v @ r >= 0, 1.0, -1.0)
        u, _, t = np.linalg.svd(b.T @ v)
        r = (u @ t).T
    return mean, w @ r


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # squares can neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Index:
    """How vectors of one dimension are coded: rotations, tables and their width.

    Tables are as wide as there are vectors in binary digits (8 to 32), so that a bucket's size doesn't grow with the corpus, and as
    many as give a pair at the threshold, whose signs differ independently with the share of its angle, the wanted chance to
    meet. Each rotation gives a code of up to BITS bits, cut into tables; more tables take further rotations.
    """

    def __init__(self, dimension: int, vectors: int, threshold: float, recall: float = 0.97) -> None:
        self.bits = min(BITS, dimension)
        self.width = max(1, min(32, self.bits, max(8, ceil(log2(max(2, vectors))))))
        p = acos(max(-1.0, min(1.0, threshold))) / pi
        meets = sum(comb(self.width, d) * p**d * (1 - p) ** (self.width - d) for d in range(min(APART, self.width) + 1))
        self.tables = 1 if meets >= 1 else max(1, ceil(log(1 - recall) / log(1 - meets)))
        self.each = self.bits // self.width
        self.rotations = ceil(self.tables / self.each)
        # three deviations beyond the differing bits of a pair at the threshold, over all codes
        n = self.bits * self.rotations
        self.far = ceil(n * p + 3 * (n * p * (1 - p)) ** 0.5)

    def fit(self, sample: np.ndarray) -> None:
        self.models = [learn(sample, self.bits, seed=7 + r) if len(sample) else (np.zeros(sample.shape[1]), np.eye(sample.shape[1])[:, : self.bits]) for r in range(self.rotations)]

    def codes(self, x: np.ndarray) -> np.ndarray:
        """One 64-bit number for each row and rotation."""
        out = np.empty((len(x), self.rotations), np.uint64)
        for r, (mean, projection) in enumerate(self.models):
            positive = (x - mean) @ projection >= 0
            out[:, r] = (positive.astype(np.uint64) << np.arange(positive.shape[1], dtype=np.uint64)).sum(1, dtype=np.uint64)
        return out

    def part(self, codes: np.ndarray, table: int) -> np.ndarray:
        return codes[:, table // self.each] >> np.uint64(self.width * (table % self.each)) & np.uint64((1 << self.width) - 1)


def close_pairs(rows: pa.Table, indexes: dict[int, Index]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (whole units) that share no core, are close over their whole codes, and whose first meeting is this bucket of
    this table: two substrings at most two bits apart share neighbours at one bit; they meet at the least of those on the way
    from one to the other."""
    unit, side, core, lo, hi, table, value, dimension = (rows.column(c).to_numpy() for c in ("unit", "side", "core", "lo", "hi", "tab", "value", "dimension"))
    raw = rows.column("code").to_pylist()
    found_a, found_b = [], []
    low, high = partners(unit, side, lo == hi)
    for d in np.unique(dimension):
        index, mine = indexes[int(d)], np.flatnonzero(dimension == d)
        codes = np.zeros((len(unit), index.rotations), np.uint64)
        codes[mine] = np.frombuffer(b"".join(raw[int(i)] for i in mine), np.uint64).reshape(len(mine), index.rotations)
        parts = np.stack([index.part(codes, t) for t in range(index.tables)], 1)
        for a, b in pair_blocks(np.where(dimension == d, low, high), high):
            stay = (core[a] == 0) | (core[a] != core[b])
            a, b = a[stay], b[stay]
            stay = np.bitwise_count(codes[a] ^ codes[b]).sum(1, dtype=np.int64) <= index.far
            a, b = a[stay], b[stay]
            for t in range(int(table[mine].max()) + 1 if len(a) else 0):
                x, y = parts[a, t], parts[b, t]
                diff = x ^ y
                apart = np.bitwise_count(diff)
                bit = diff & (~diff + np.uint64(1))
                meet = np.where(apart == 2, np.minimum(x ^ bit, x ^ (diff ^ bit)), np.minimum(x, y))
                here = (apart <= APART) & (meet == value[a].astype(np.uint64))
                stay = np.where(table[a] == t, here, (table[a] < t) | (apart > APART))
                a, b = a[stay], b[stay]
            found_a.append(a)
            found_b.append(b)
    none = np.empty(0, np.int64)
    return np.concatenate(found_a or [none]), np.concatenate(found_b or [none])


def matrix(rows: pa.Table, column: str, at: np.ndarray, dimension: int) -> np.ndarray:
    return unit_rows(np.frombuffer(b"".join(rows.column(column).take(pa.array(at)).to_pylist()), np.float64).reshape(len(at), dimension))


def reranked(rows: pa.Table, indexes: dict[int, Index], threshold: float) -> pa.RecordBatch:
    """For rows (whole units) with partners of the threshold's cosine at least: the class, one that it reaches, and how many rows are linked with it here."""
    a, b = close_pairs(rows, indexes)
    copies, cls, dimension = rows.column("copies").to_numpy(), rows.column("cls").combine_chunks(), rows.column("dimension").to_numpy()
    yes = np.zeros(len(a), bool)
    for d in np.unique(dimension[a]):
        of = np.flatnonzero(dimension == d)
        place = np.zeros(len(dimension), np.int64)
        place[of] = np.arange(len(of))
        x = matrix(rows, "vector", of, int(d))
        mine = np.flatnonzero(dimension[a] == d)
        step = max(1, (1 << 22) // int(d))
        for k in range(0, len(mine), step):
            m = mine[k : k + step]
            yes[m] = np.einsum("ij,ij->i", x[place[a[m]]], x[place[b[m]]]) >= threshold
    a, b = a[yes], b[yes]
    n = len(copies)
    links = (np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)).astype(np.int64)
    some = np.flatnonzero(links)
    root = roots(n, a, b)[some] if len(some) else some
    return made(a=cls.take(pa.array(some)), b=cls.take(pa.array(root)), links=pa.array(links[some]))


def embedding_dedup(vectors: DataFrame, threshold: float = 0.9, key: str = "vec_id", column: str = "embedding", sample: int = 20_000) -> DataFrame:
    """One row for each row of vectors (key, column): key, class_id, n_links, component_id and kept.

    Equal vectors are one class (class_id: its smallest key); classes are linked where the cosine, in double precision, is at
    least threshold. n_links counts the other vectors linked with this one; component_id is the smallest key reachable by links,
    itself included; kept: key = component_id. Vectors that are null, empty, zero or hold null or non-finite components are linked
    with nothing; vectors of different lengths are never linked. Rows with a null key are compared as any other; other columns are left out.

    Rotations are fitted on a bounded sample (the vectors with the least digests, at most sample of them and SAMPLE_BYTES); every
    vector is indexed as Index says: it enters its bucket of each table and those one bit away. Pairs that meet and whose codes differ little are reranked
    exactly. Measured recall is in the README. No pair leaves a task and a bucket is cut in chunks; in a bucket of more than a
    chunk, vectors so near to its first one that they must be linked with each other (angles add up) are not compared but counted together.
    """
    v = F.col("vector")
    rows = vectors.select(F.col(f"`{key}`").alias("key"), F.transform(F.col(f"`{column}`").cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vector"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = rows.select("key", F.when(F.coalesce(fine, F.lit(False)), v).alias("vector"))
    rows = rows.withColumn("cls", F.when(F.col("vector").isNotNull(), F.unhex(F.md5(F.concat_ws(",", F.col("vector").cast("array<string>"))))))
    kind = rows.schema["key"].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors as bytes: lists of numbers take five times the work."""
        for batch in batches:
            held = batch.column("vector")
            raw, ends = held.values.to_numpy(zero_copy_only=False).astype("<f8", copy=False), held.offsets.to_numpy()
            out = [None if cls is None else raw[a:b].tobytes() for cls, a, b in zip(batch.column("cls").to_pylist(), ends, ends[1:])]
            size = pa.array([None if x is None else len(x) // 8 for x in out], pa.int32())
            yield made(key=batch.column("key"), cls=batch.column("cls"), dimension=size, vector=pa.array(out, pa.binary()))

    rows = durable(in_arrow(rows.select("key", "cls", "vector"), packed, f"key {kind}, cls binary, dimension int, vector binary"), "vectors")
    classes = rows.where("cls IS NOT NULL").groupBy("cls", "dimension").agg(F.count("*").alias("copies"), F.min("key").alias("first"), F.max("vector").alias("vector"))
    classes = durable(classes, "classes")

    kinds = {r["dimension"]: r["n"] for r in classes.groupBy("dimension").agg(F.count("*").alias("n")).collect()}  # a row for each length of vectors
    indexes = {d: Index(d, n, threshold) for d, n in kinds.items()}
    for d, index in indexes.items():
        most = max(1, min(sample, SAMPLE_BYTES // (8 * d)))
        held = classes.where(F.col("dimension") == d).orderBy("cls").select("vector").limit(most).collect()
        index.fit(unit_rows(np.frombuffer(b"".join(bytes(r["vector"]) for r in held), np.float64).reshape(len(held), d)))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            dimension = rows.column("dimension").to_numpy()
            for d in np.unique(dimension):
                index, at = indexes[int(d)], np.flatnonzero(dimension == d)
                codes = index.codes(matrix(rows, "vector", at, int(d)))
                # each vector's buckets of all tables: the substring and those one bit away
                near = np.concatenate([[0], 1 << np.arange(index.width, dtype=np.int64)])
                value = np.stack([index.part(codes, t).astype(np.int64)[:, None] ^ near for t in range(index.tables)], 1).reshape(len(at), -1)
                bounds = pa.array(np.arange(len(at) + 1, dtype=np.int32) * value.shape[1])
                yield made(
                    cls=batch.column("cls").take(pa.array(at)),
                    dimension=batch.column("dimension").take(pa.array(at)),
                    code=pa.array([c.tobytes() for c in codes], pa.binary()),
                    value=pa.ListArray.from_arrays(bounds, pa.array(value.ravel())),
                    many=pa.array(np.full(len(at), len(near), np.int32)),
                )

    entries = in_arrow(classes.select("cls", "dimension", "vector"), coded, "cls binary, dimension int, code binary, value array<bigint>, many int")
    entries = durable(entries, "codes").select("cls", "dimension", "code", "many", F.posexplode("value").alias("at", "value"))
    entries = entries.withColumn("tab", F.expr("at div many").cast("int")).drop("at", "many").withColumn("bucket", F.xxhash64("dimension", "tab", "value")).withColumn("size", F.lit(1).cast("long"))

    # vectors that a large bucket's first member resembles so much that they are all linked with each other
    large = entries.groupBy("bucket").agg(F.count("*").alias("n"), F.min("cls").alias("rep")).where(F.col("n") > CHUNK)
    near = cos(acos(min(1.0, max(-1.0, threshold))) / 2) + 1e-9
    large, cores = durable(large, "large"), None
    if large.limit(1).count():
        held = entries.select("cls", "bucket").join(F.broadcast(large) if small(large, 100_000) else large, "bucket")
        told = held.groupBy("cls").agg(F.max_by("rep", F.struct("n", "bucket")).alias("rep")).join(classes.select("cls", "dimension", "copies", "vector"), "cls")
        reps = classes.join(F.broadcast(large.select(F.col("rep").alias("cls")).distinct()) if small(large, 100_000) else large.select(F.col("rep").alias("cls")).distinct(), "cls", "left_semi")
        reps = durable(reps.select(F.col("cls").alias("rep"), F.col("vector").alias("other")), "representatives")
        reps = F.broadcast(reps) if small(reps, 10_000) else reps

        def resembling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, yes = pa.Table.from_batches([batch]), np.zeros(batch.num_rows, bool)
                dimension = rows.column("dimension").to_numpy()
                for d in np.unique(dimension):
                    at = np.flatnonzero(dimension == d)
                    yes[at] = np.einsum("ij,ij->i", matrix(rows, "vector", at, int(d)), matrix(rows, "other", at, int(d))) >= near
                yield batch.select(["cls", "rep", "copies"]).filter(pa.array(yes))

        cores = in_arrow(told.join(reps, "rep").select("cls", "rep", "copies", "dimension", "vector", "other"), resembling, "cls binary, rep binary, copies long")
        cores = durable(cores.select("cls", F.expr("shiftrightunsigned(xxhash64(rep), 1)").alias("core"), "copies"), "cores")

    entries = entries.join(cores.select("cls", "core"), "cls", "left").fillna(0, "core") if cores is not None else entries.withColumn("core", F.lit(0).cast("long"))
    units = in_units(entries, CHUNK).select("unit", "side", "lo", "hi", "tab", "value", "dimension", "core", "code", "cls")
    names = units.columns
    schema = fields(units, *names)

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "unit", 8 * CHUNK):
            a, b = close_pairs(rows, indexes)
            seen = np.unique(np.concatenate([a, b]))
            yield from rows.select(names).take(pa.array(seen)).combine_chunks().to_batches()

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "unit", 4 * CHUNK):
            yield reranked(rows, indexes, threshold)

    # codes first; vectors only for what has a close partner
    close = durable(in_arrow(dealt(units), meeting, schema), "close")
    found = dealt(close.join(classes.select("cls", "copies", "vector"), "cls"))
    found = durable(in_arrow(found, compared, "a binary, b binary, links long"), "links")
    discard(vectors.sparkSession, close)
    return settle(rows.select("key", "cls"), classes, with_cores(found, cores) if cores is not None else found, key)
