"""Jaccard self-join of texts on word n-grams, with Bayesian pruning of MinHash candidates."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX, dealt, different_words, discard, durable, fields, in_arrow, in_units, made, mix64, pair_blocks, partners, settle, slices, small, whole_groups, with_cores

BANDS, ROWS = 20, 4
HASHES = BANDS * ROWS
#: Hashes compared before each decision.
STEP = 16
#: Members of a bucket compared in one unit, and shingles they may hold together; larger buckets are cut in chunks, and pairs of chunks are units.
CHUNK, CHUNK_SHINGLES = 512, 1 << 19
#: Rows up to which a list of ids is broadcast (8 bytes each), and of shingle sets of representatives (some KB each).
BROADCAST_IDS, BROADCAST_SETS = 1_000_000, 2_000
#: Words of which a worker remembers the hashes.
REMEMBER = 150_000
SEEDS = mix64(np.arange(1, HASHES + 1, dtype=np.uint64) * MIX) | np.uint64(1)


class Shingler:
    """Sets of 64-bit hashes of n-word shingles; words are lower-cased and split at white space."""

    def __init__(self, n: int) -> None:
        self.n = n
        self.known: dict[str, int] = {}

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > REMEMBER:
            self.known.clear()
        words, place, counts = different_words([t.lower() for t in texts])
        for w in words:
            if w not in self.known:
                self.known[w] = xxhash.xxh3_64_intdigest(w.encode())
        hashes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))[place]
        ends = np.cumsum(counts)
        whole = self.windows(hashes) if len(hashes) >= self.n else hashes[:0]
        out = []
        for a, b in zip((ends - counts).tolist(), ends.tolist()):
            if b - a >= self.n:
                out.append(np.unique(whole[a : b - self.n + 1]))
            else:  # a shorter text is one shingle
                out.append(self.windows(hashes[a:b], b - a) if b > a else hashes[:0])
        return out

    def windows(self, h: np.ndarray, width: int | None = None) -> np.ndarray:
        """A hash for each window of words; those over two texts are not used."""
        k = width or self.n
        with np.errstate(over="ignore"):
            g = mix64(h[: len(h) - k + 1] + np.uint64(k))
            for i in range(1, k):
                g = mix64(g * MIX + h[i : len(h) - k + 1 + i])
        return g


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, one row of HASHES 32-bit numbers for each (not empty) set."""
    every = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint32)
    with np.errstate(over="ignore"):
        for k in range(HASHES):
            x = every * SEEDS[k]
            x ^= x >> np.uint64(32)
            x *= MIX
            out[:, k] = np.minimum.reduceat(x, starts) >> np.uint64(32)
    return out


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """By hashes compared, the matches below which a pair is dropped: under a uniform prior on the similarity, matches m of n
    give it a Beta(m + 1, n - m + 1) posterior, whose mass above threshold is P(Binomial(n + 1, threshold) <= m)."""
    out = []
    for n in range(HASHES + 1):
        mass, m = 0.0, 0
        while m <= n:
            mass += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if mass >= tolerance:
                break
            m += 1
        out.append(m)
    return out


def linked(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Which of the pairs (a, b) of sets are similar, exactly: by merging where pairs are few, else by counting shared
    shingles for all sets at once, some columns of the incidence matrix at a time."""
    size = np.array([len(s) for s in sets], np.int64)
    if len(a) <= 4 * len(sets):
        shared = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b)], np.int64)
    else:
        who = np.repeat(np.arange(len(sets)), size)
        _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        keep = often[column] > 1
        who, column = who[keep], (np.cumsum(often > 1) - 1)[column[keep]]
        total, width = int((often > 1).sum()), 2048
        order = np.argsort(column, kind="stable")
        who, column = who[order], column[order]
        left, right = np.unique(a), np.unique(b)
        both = np.zeros((len(left), len(right)), np.float32)
        for at in range(0, total, width):
            lo, hi = np.searchsorted(column, [at, at + width])
            x = np.zeros((len(sets), width), np.float32)
            x[who[lo:hi], column[lo:hi] - at] = 1
            both += x[left] @ x[right].T
        shared = both[np.searchsorted(left, a), np.searchsorted(right, b)].astype(np.int64)
    return shared * threshold.denominator >= threshold.numerator * (size[a] + size[b] - shared)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable of each of n nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def meetings(rows: pa.Table, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (whole units) that the pruning leaves: those whose first common band is their bucket's, that share no core, and
    whose matches keep up with least after every STEP hashes."""
    sigs = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint32).reshape(rows.num_rows, HASHES)
    halves = np.ascontiguousarray(sigs).view(np.uint64).reshape(len(sigs), BANDS, ROWS // 2)
    unit, side, band, core, lo, hi = (rows.column(c).to_numpy() for c in ("unit", "side", "band", "core", "lo", "hi"))
    found_a, found_b = [], []
    for a, b in pair_blocks(*partners(unit, side, lo == hi)):
        stay = (core[a] == 0) | (core[a] != core[b])
        a, b = a[stay], b[stay]
        for k in range(int(band.max()) + 1):
            # the bucket's band must be equal, and no band before it
            same = (halves[a, k] == halves[b, k]).all(1)
            stay = np.where(band[a] == k, same, (band[a] < k) | ~same)
            a, b = a[stay], b[stay]
        matches = np.zeros(len(a), np.int64)
        for n in range(0, HASHES, STEP):
            matches += (sigs[a, n : n + STEP] == sigs[b, n : n + STEP]).sum(1)
            stay = matches >= least[n + STEP]
            a, b, matches = a[stay], b[stay], matches[stay]
        found_a.append(a)
        found_b.append(b)
    none = np.empty(0, np.int64)
    return np.concatenate(found_a or [none]), np.concatenate(found_b or [none])


def verified(rows: pa.Table, least: list[int], threshold: Fraction) -> pa.RecordBatch:
    """For rows (whole units) with similar partners: the class, one that it reaches, and how many rows are linked with it here."""
    a, b = meetings(rows, least)
    copies, cls, unit = rows.column("copies").to_numpy(), rows.column("cls").combine_chunks(), rows.column("unit").to_numpy()
    sets = rows.column("shingles")
    yes = np.zeros(len(a), bool)
    cuts = np.flatnonzero(unit[a][1:] != unit[a][:-1]) + 1 if len(a) else []
    for lo, hi in zip([0, *cuts], [*cuts, len(a)]):  # a unit at a time
        if lo < hi:
            who, place = np.unique(np.concatenate([a[lo:hi], b[lo:hi]]), return_inverse=True)
            held = [np.frombuffer(sets[int(i)].as_py(), np.uint64) for i in who]
            yes[lo:hi] = linked(held, place[: hi - lo], place[hi - lo :], threshold)
    a, b = a[yes], b[yes]
    n = len(copies)
    links = (np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)).astype(np.int64)
    some = np.flatnonzero(links)
    root = roots(n, a, b)[some] if len(some) else some
    return made(a=cls.take(pa.array(some)), b=cls.take(pa.array(root)), links=pa.array(links[some]))


def ngram_join(docs: DataFrame, threshold: float = 0.8, n: int = 5, tolerance: float = 1e-6, key: str = "doc_id") -> DataFrame:
    """One row for each row of docs (key, text): key, class_id, n_links, component_id and kept.

    Texts with equal shingle sets are one class (class_id: its smallest key). Classes are linked when the Jaccard similarity
    of their sets is at least threshold. n_links counts the other rows linked with this one, in its class or a linked one;
    component_id is the smallest key reachable by links, itself included; kept: key = component_id. A text of fewer than n
    words is one shingle of all its words; a null text or one without words is linked with nothing. Rows with a null key are
    compared as any other; kept is false for them unless all rows of the component have a null key. Other columns are left out.

    Candidates share one of 20 bands of 4 MinHash values (a pair at the threshold is missed once in 40,000); comparing 16
    values at a time drops those whose posterior chance of reaching the threshold is under tolerance; the rest are verified
    on whole sets. A bucket is cut in chunks, so that no task holds all of it, and no pair leaves a task. In a bucket of more than a
    chunk, classes with a similarity to its first one so high that they must be linked with each other (distances add up) are
    not compared but counted together.
    """
    spark, exact, least = docs.sparkSession, Fraction(threshold).limit_denominator(1000), least_matches(threshold, tolerance)
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col("text").cast("string").alias("text"))
    kind = texts.schema["key"].dataType.simpleString()

    def shingled(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for part, rows in slices(batches):
            sets = shingler.sets(part)
            names = pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())
            if whole:
                yield made(cls=names, shingles=pa.array([s.tobytes() for s in sets], pa.binary()))
                continue
            full = [s for s in sets if len(s)]
            sigs = iter(signatures(full)) if full else iter(())
            size, sig = pa.array([len(s) for s in sets], pa.int64()), pa.array([next(sigs).tobytes() if len(s) else None for s in sets], pa.binary())
            yield made(key=rows.column("key"), cls=names, size=size, sig=sig)

    rows = durable(in_arrow(texts, lambda x: shingled(x, False), f"key {kind}, cls binary, size long, sig binary"), "signatures")
    classes = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.count("*").alias("copies"), F.min("key").alias("first"), F.max("size").alias("size"), F.max("sig").alias("sig"))
    classes = durable(classes, "classes")

    def with_sets(wanted: DataFrame) -> DataFrame:
        """wanted (cls, ...) with the shingles of each class, from the text of its first row."""
        ids = classes.join(wanted.select("cls").distinct(), "cls", "left_semi").select("first")
        ids = F.broadcast(ids) if small(ids, BROADCAST_IDS) else ids
        sources = texts.join(ids, texts["key"].eqNullSafe(ids["first"]), "left_semi").select("text")
        sets = in_arrow(sources, lambda x: shingled(x, True), "cls binary, shingles binary").where("cls IS NOT NULL")
        return wanted.join(sets.groupBy("cls").agg(F.max("shingles").alias("shingles")), "cls")

    bands = classes.select("cls", "size", F.posexplode(F.array(*(F.expr(f"substring(sig, {4 * ROWS * k + 1}, {4 * ROWS})") for k in range(BANDS)))).alias("band", "part"))
    bands = bands.select("cls", "size", "band", F.xxhash64("band", "part").alias("bucket"))
    # buckets with the same members in several bands: the first is enough, as it holds all that the others hold
    buckets = bands.groupBy("bucket").agg(F.count("*").alias("n"), F.min("cls").alias("rep"), F.min("band").alias("band"), F.expr("bit_xor(xxhash64(cls))").alias("x"), F.expr("bit_xor(xxhash64(1L, cls))").alias("y"))
    buckets = buckets.where("n > 1").groupBy("x", "y", "n", "rep").agg(F.min(F.struct("band", "bucket")).alias("held")).select("held.bucket", "n", "rep")
    members = durable(bands.join(buckets, "bucket").select("cls", "size", "bucket", "band", "n", "rep"), "members")

    # classes that a large bucket's first member resembles so much that by the triangle inequality they are all linked with each other
    large = members.where(F.col("n") > CHUNK)
    near = (1 + exact) / 2
    cores = None
    if large.limit(1).count():
        told = durable(large.groupBy("cls").agg(F.max_by("rep", F.struct("n", "bucket")).alias("rep")), "large")
        reps = durable(with_sets(told.select(F.col("rep").alias("cls")).distinct()).select(F.col("cls").alias("rep"), F.col("shingles").alias("other")), "representatives")
        reps = F.broadcast(reps) if small(reps, BROADCAST_SETS) else reps

        def resembling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yes = []
                for x, y in zip(batch.column("shingles").to_pylist(), batch.column("other").to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    yes.append(both * near.denominator >= near.numerator * (len(x) + len(y) - both))
                yield batch.select(["cls", "rep"]).filter(pa.array(yes, pa.bool_()))

        cores = in_arrow(with_sets(told).join(reps, "rep").select("cls", "rep", "shingles", "other"), resembling, "cls binary, rep binary")
        cores = cores.select("cls", F.expr("shiftrightunsigned(xxhash64(rep), 1)").alias("core")).join(classes.select("cls", "copies"), "cls")
        cores = durable(cores, "cores")

    units = members.select("cls", "size", "bucket", "band")
    units = units.join(cores.select("cls", "core"), "cls", "left").fillna(0, "core") if cores is not None else units.withColumn("core", F.lit(0).cast("long"))
    units = in_units(units, CHUNK, CHUNK_SHINGLES).select("unit", "side", "lo", "hi", "band", "core", "cls")
    names = units.columns
    schema = fields(units, *names)

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "unit", 4 * CHUNK):
            a, b = meetings(rows, least)
            seen = np.unique(np.concatenate([a, b]))
            yield from rows.select(names).take(pa.array(seen)).combine_chunks().to_batches()

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "unit", 4 * CHUNK):
            yield verified(rows, least, exact)

    # signatures first; shingles only for what the pruning leaves
    close = durable(in_arrow(dealt(units.join(classes.select("cls", "sig"), "cls")), meeting, schema), "close")
    discard(spark, members)
    data = durable(with_sets(close.select("cls").distinct()), "sets").join(classes.select("cls", "copies", "sig"), "cls")
    found = durable(in_arrow(dealt(close.join(data, "cls")), compared, "a binary, b binary, links long"), "links")
    return settle(rows, classes, with_cores(found, cores) if cores is not None else found, key)
