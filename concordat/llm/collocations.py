"""Collocations: frequent word n-grams by hashed bucket counts and Apriori pruning, scored by their weakest cut."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MIX, durable, in_arrow, made, mix64, small, whole_groups

#: Buckets into which n-grams are hashed, as a power of two, and of these in one run of the counts. A bitmap of all buckets has 8 MB,
#: whatever the corpus; fewer buckets an n-gram prune less and change no result.
BITS, RUN_BITS = 26, 16
#: Rows of counts and of buckets that a task holds before it hands them on.
HELD_ROWS, HELD_BUCKETS = 300_000, 3_000_000
#: Langs up to which their sizes are broadcast.
BROADCAST_LANGS = 100_000
#: Fixed value: what ends a piece besides the end of a text.
BREAKS = r"[.,;:!?\n-\r]"
SCHEMA = "lang string, phrase string, n long, run int, places binary, counts binary"


class Words:
    """The words of a batch of texts one after the other: names (each different word once), ids, 64-bit hashes of (lang, word), lang codes and pieces."""

    def __init__(self, texts: pa.Array, langs: pa.Array) -> None:
        text = pc.ascii_lower(texts.cast(pa.large_string()).fill_null(""))
        text = pc.replace_substring(pc.replace_substring_regex(text, BREAKS, " \n "), "\t", " ")
        parts = pc.split_pattern(text, " ")
        flat = parts.flatten().dictionary_encode()
        names, ids = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        listed = names.to_pylist()
        place = {w: listed.index(w) for w in ("", "\n") if w in listed}
        row = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
        ends, word = ids == place.get("\n", -1), (ids != place.get("", -1)) & (ids != place.get("\n", -1))
        # a piece is told by the row and by how many ends came before
        piece = np.cumsum(ends) + row
        coded = langs.cast(pa.string()).fill_null("und").dictionary_encode()
        self.langs = coded.dictionary
        self.names, self.ids, self.piece = names, ids[word], piece[word]
        self.lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row[word]]
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in listed), np.uint64, len(listed))
        seeds = np.array([xxhash.xxh3_64_intdigest(x, 1) for x in self.langs.to_pylist()], np.uint64)
        self.hashes = [mix64(hashes[self.ids] ^ seeds[self.lang])] if len(seeds) else [hashes[:0]]

    def grams(self, n: int) -> np.ndarray:
        """Hashes of all n-grams, by the place of the first word; of those over two pieces as well."""
        while len(self.hashes) < n:
            k, last = len(self.hashes), self.hashes[-1]
            with np.errstate(over="ignore"):
                self.hashes.append(mix64(last[:-1] * MIX + self.hashes[0][k:]))
        return self.hashes[n - 1]

    def within(self, n: int) -> np.ndarray:
        """Which n-grams lie within a piece."""
        return self.piece[: max(0, len(self.piece) - n + 1)] == self.piece[n - 1 :]

    def counted(self, n: int, at: np.ndarray) -> pa.Table:
        """How often each n-gram that begins at one of these places does: lang, phrase, n."""
        keys = [self.lang[at], *(self.ids[at + k] for k in range(n))]
        found = pa.table([pa.array(k) for k in keys], [f"k{i}" for i in range(n + 1)]).group_by([f"k{i}" for i in range(n + 1)]).aggregate([([], "count_all")])
        words = [self.names.take(found.column(f"k{i + 1}").combine_chunks()) for i in range(n)]
        phrase = words[0] if n == 1 else pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()))
        return pa.table([self.langs.take(found.column("k0").combine_chunks()), phrase, found.column("count_all")], ["lang", "phrase", "n"])


class Tally:
    """Counts of phrases, handed on when they grow."""

    def __init__(self) -> None:
        self.held, self.rows = [], 0

    def add(self, counted: pa.Table) -> Iterator[pa.RecordBatch]:
        self.held.append(counted)
        self.rows += counted.num_rows
        if self.rows > HELD_ROWS:
            merged = self.merged()
            self.held, self.rows = [merged], merged.num_rows
            if 2 * self.rows > HELD_ROWS:
                yield from self.end()

    def merged(self) -> pa.Table:
        every = pa.concat_tables(self.held).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        return every.select(["lang", "phrase", "n_sum"]).rename_columns(["lang", "phrase", "n"])

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            for b in self.merged().combine_chunks().to_batches(50_000):
                none = pa.nulls(b.num_rows, pa.binary())
                yield made(lang=b.column("lang"), phrase=b.column("phrase").cast(pa.string()), n=b.column("n"), run=pa.nulls(b.num_rows, pa.int32()), places=none, counts=none)
        self.held, self.rows = [], 0


class Buckets:
    """How many hashes fell into each bucket, as far as least: more tells nothing more."""

    def __init__(self, least: int) -> None:
        self.least, self.held, self.places = least, [], 0

    def add(self, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        place, n = np.unique((hashes >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
        self.held.append((place, np.minimum(n, self.least)))
        self.places += len(place)
        if self.places > HELD_BUCKETS:
            merged = self.merged()
            self.held, self.places = [merged], len(merged[0])
            if 2 * self.places > HELD_BUCKETS:
                yield from self.end()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        every, n = np.concatenate([p for p, _ in self.held]), np.concatenate([n for _, n in self.held])
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else order
        return every[first], np.minimum(np.add.reduceat(n[order], first), self.least) if len(every) else n

    def end(self) -> Iterator[pa.RecordBatch]:
        place, n = self.merged() if self.held else (np.array([], np.int64), np.array([], np.int64))
        run = place >> RUN_BITS
        first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else run
        low, n = (place & ((1 << RUN_BITS) - 1)).astype("<u2"), n.astype("<u2")
        cuts = list(zip(first.tolist(), [*first[1:].tolist(), len(run)]))
        for k in range(0, len(cuts), 500):
            some = cuts[k : k + 500]
            none = pa.nulls(len(some), pa.string())
            yield made(
                lang=none,
                phrase=none,
                n=pa.nulls(len(some), pa.int64()),
                run=pa.array([int(run[a]) for a, _ in some], pa.int32()),
                places=pa.array([low[a:b].tobytes() for a, b in some], pa.binary()),
                counts=pa.array([n[a:b].tobytes() for a, b in some], pa.binary()),
            )
        self.held, self.places = [], 0


def bitmap(rows: DataFrame, least: int) -> np.ndarray:
    """Which buckets hold least or more, as packed bits. Runs of buckets are added up where they meet, and a bit for each reaches the driver: 8 MB at any size."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RUN_BITS, np.int64)
        for group in whole_groups(batches, "run", 1):
            runs = group.column("run").to_numpy()
            for run in np.unique(runs):
                total[:] = 0
                for k in np.flatnonzero(runs == run).tolist():
                    total[np.frombuffer(group.column("places")[k].as_buffer(), "<u2")] += np.frombuffer(group.column("counts")[k].as_buffer(), "<u2")
                yield made(run=pa.array([run], pa.int32()), bits=pa.array([np.packbits(total >= least).tobytes()], pa.binary()))

    met = rows.where("run IS NOT NULL").select("run", "places", "counts").repartition("run").sortWithinPartitions("run")
    out = np.zeros(1 << (BITS - 3), np.uint8)
    size = 1 << (RUN_BITS - 3)
    for r in in_arrow(met, added, "run int, bits binary").toLocalIterator():
        out[r["run"] * size : (r["run"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - BITS)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (place & np.uint64(7))).astype(np.uint8)) & 1 == 1


def count_pass(texts: DataFrame, n: int, longest: int, least: int, marks: list[np.ndarray]) -> DataFrame:
    """Counts of n-grams and, below longest, buckets of the (n + 1)-grams that may still be frequent.

    marks has two bitmaps for n > 1: of the frequent (n - 1)-grams, and of the buckets of n-grams with least or more. An n-gram is counted
    if both (n - 1)-grams in it and its bucket are marked; only one over two of these is put in a bucket of the next length.
    """
    told = texts.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, buckets = Tally(), Buckets(least)
        for batch in batches:
            words = Words(batch.column("text"), batch.column("lang"))
            good = words.within(n)
            if n > 1 and good.any():
                part, own = holds(told.value[0], words.grams(n - 1)), holds(told.value[1], words.grams(n))
                good &= part[:-1] & part[1:] & own
            yield from tally.add(words.counted(n, np.flatnonzero(good)))
            if n < longest and len(good) > 1:
                yield from buckets.add(words.grams(n + 1)[good[:-1] & good[1:] & words.within(n + 1)])
        yield from tally.end()
        yield from buckets.end()

    return durable(in_arrow(texts, run, SCHEMA), f"grams-{n}")


def marked(grams: DataFrame, least: int) -> np.ndarray:
    """Bitmap of the hashes of phrases (lang, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(least)
        for batch in batches:
            words = Words(batch.column("phrase"), batch.column("lang"))
            n = np.diff(np.append(np.flatnonzero(np.concatenate([[True], words.piece[1:] != words.piece[:-1]])), len(words.piece)))
            first = np.cumsum(n) - n
            for k in np.unique(n).tolist():
                yield from buckets.add(np.repeat(words.grams(k)[first[n == k]], least))
        yield from buckets.end()

    return bitmap(in_arrow(grams, run, SCHEMA), least)


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to longest words found least times or more, exactly: lang, phrase, words, n; and how many words each lang has.

    docs: text, lang. Text is lower-cased (A-Z only) and cut at BREAKS into pieces, these into words at spaces and tabs; a phrase lies within a
    piece, and overlapping occurrences all count. Each length is one pass over all texts.
    """
    texts = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    marks, found, sizes = [], [], None
    for n in range(1, longest + 1):
        rows = count_pass(texts, n, longest, least, marks)
        counts = rows.where("run IS NULL").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        grams = durable(counts.where(F.col("n") >= least).withColumn("words", F.lit(n)), f"frequent-{n}")
        found.append(grams)
        if n == 1:
            sizes = rows.where("run IS NULL").groupBy("lang").agg(F.sum("n").alias("words"))
        if n < longest:
            marks = [marked(grams, least), bitmap(rows, least)]
    return reduce(DataFrame.unionByName, found), sizes


def first_of_each(ranked: DataFrame, group: str, order: Callable[[], list], most: int) -> DataFrame:
    """The first most rows of each group with their rank: the first of many hashed shares of it, then of fewer, so that no task takes in a large group."""
    for shares in (256, 32, 4, 1):
        window = Window.partitionBy(group, F.pmod(F.xxhash64("phrase"), F.lit(shares))).orderBy(*order())
        ranked = ranked.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= most)
    return ranked


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, inside_percent: int = 50, most: int = 2000) -> DataFrame:
    """The first most collocations of each lang: lang, rank, phrase, a, l, r, n, score (long).

    docs: text, lang. Candidates are phrases of 2 to longest words with a = f(phrase) >= least. Each cut after k words gives l = f(first part)
    and r = f(rest) and the score floor(1000000 a a / (l r)), in whole numbers of up to 38 digits; the lowest counts, of equal ones that of
    the least k. A candidate whose words lie in a row inside a longer candidate with 100 f(longer) >= inside_percent a is left out. n: all
    words of the lang. Rank: by score and a from the top, then by phrase. A null text is empty, a null lang is und; repeated rows
    count each; langs without candidates and empty tables give no rows; other columns are left out.
    """
    grams, sizes = frequent_phrases(docs, longest, least)
    return ranked_candidates(grams, sizes, inside_percent, most)


def ranked_candidates(grams: DataFrame, sizes: DataFrame, inside_percent: int, most: int) -> DataFrame:
    """The collocations among grams (lang, phrase, words, n), all frequent phrases with their counts; sizes: lang, words."""
    parts = grams.select("lang", "phrase", "n")
    candidates = grams.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    pieces = F.split("phrase", " ")
    inner = F.expr("flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> array_join(slice(split(phrase, ' '), i, m), ' '))))")
    longer = candidates.where("words > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = candidates.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a")))
    cuts = left.select("lang", "phrase", "a", pieces.alias("w"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("first"), F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("rest"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    score = F.expr("CAST(1000000 * (CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0))) AS DECIMAL(38,0)) div (CAST(l AS DECIMAL(16,0)) * CAST(r AS DECIMAL(16,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    ranked = best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    ranked = first_of_each(ranked, "lang", lambda: [F.desc("score"), F.desc("a"), F.asc("phrase")], most)
    sizes = sizes.withColumnRenamed("words", "n")
    ranked = ranked.join(F.broadcast(sizes) if small(sizes, BROADCAST_LANGS) else sizes, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
