"""Helpers shared by the corpus operators: durable tables, bounded batches, whole groups from sorted batches, stable hashes."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the only separators of words.
SPACE = r"[\x20\x09-\x0D]+"
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Rows and bytes of an Arrow batch that goes to a Python worker, and characters of text handled at a time there.
BATCH_ROWS, BATCH_BYTES, SLICE = 1000, 4 << 20, 1 << 20
#: Rows of a small table of pairs that a file holds.
FILE_ROWS = 200_000
#: What a worker forgets when its task ends, what it drops before a task of another kind, and the kind of its last task.
FORGET: list[Callable[[], None]] = []
DROP: list[Callable[[], None]] = []
LAST: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where the session names none and all runs on one machine (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpus-"))
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return held.get().rstrip("/")


def durable(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: later stages survive lost executors and compute nothing twice.
    The files go when the application ends, or with discard()."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    passing(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def passing(spark: SparkSession, path: str) -> None:
    """Has the files below path deleted when the application ends."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)


def begin(kind: str) -> None:
    """Drops what a worker holds for tasks of another kind."""
    if LAST != [kind]:
        LAST[:] = [kind]
        for drop in DROP:
            drop()


def release() -> None:
    """Gives what a worker holds back to the system."""
    for forget in FORGET:
        forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """df through run, a generator over Arrow batches. Batches are bounded by rows and bytes (for the session, where its bounds are
    wider), columns that run hands on keep their types and values, and the worker's memory is given back when the task ends."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    kind = f"{run.__module__}.{run.__qualname__}"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(kind)
        try:
            yield from run(batches)
        finally:
            release()

    return df.mapInArrow(task, schema)


def made(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[list[str], pa.RecordBatch]]:
    """Runs of rows whose texts hold about SLICE characters together: the texts (null: empty), and the rows."""
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        at = 0
        while at < len(texts):
            end, chars = at + 1, len(texts[at])
            while end < len(texts) and chars + len(texts[end]) <= SLICE:
                chars += len(texts[end])
                end += 1
            yield texts[at:end], batch.slice(at, end - at)
            at = end


def different_words(texts: list[str], separator: str | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different words of texts (between white space, as str.split() has it, or between separators), the place of each word of all texts
    among them, and how many each text has."""
    held = pa.array(texts, pa.large_string())
    parts = pc.utf8_split_whitespace(held) if separator is None else pc.split_pattern(held, separator)
    words = parts.flatten().dictionary_encode()
    names, place, size = words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False), pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    if separator is None and "" in names:  # white space at an end of a text leaves an empty word there
        kept = place != names.index("")
        size = np.diff(np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(size)])])
        place = place[kept]
    return names, place, size.astype(np.int64)


def gathered(values: np.ndarray, sizes: np.ndarray, place: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The runs of values (of so many each, one after the other unless starts says where) at places, one after the other, and where each ends."""
    n = sizes[place]
    ends = np.cumsum(n)
    first = (np.cumsum(sizes) - sizes if starts is None else starts)[place]
    return values[np.repeat(first - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)], ends


def ends_of(ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Where the last of each group of so many runs ends."""
    return np.concatenate([[0], ends])[np.cumsum(counts)]


def fields(df: DataFrame, *names: str) -> str:
    """The named columns' part of a schema."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return ", ".join(f"`{n}` {kinds[n]}" for n in names)


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Removes the files behind a table of durable() that nothing reads any more."""
    for path in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, rows: int) -> bool:
    """Whether df has at most so many rows, told by one counted, limited scan: the size check before a broadcast."""
    return df.limit(rows + 1).count() <= rows


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, size: int, most: int = 32 << 20) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by key, of size rows or most bytes, or the least beyond that ends with a group; holds these and one batch."""
    held: list[pa.RecordBatch] = []
    rows = taken = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if rows >= size or taken >= most:
            last, keys = held[-1].column(key)[-1].as_py(), batch.column(key).to_numpy(zero_copy_only=False)
            cut = int(np.argmax(keys != last)) if (keys != last).any() else len(keys)
            if cut:
                held.append(batch.slice(0, cut))
            if cut < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, rows, taken, batch = [], 0, 0, batch.slice(cut)
            else:
                continue
        held.append(batch)
        rows += batch.num_rows
        taken += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def pair_blocks(low: np.ndarray, high: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (i, j) with low[i] <= j < high[i], about most of them at a time."""
    count = np.maximum(high - low, 0)
    ends, at = np.cumsum(count), 0
    while at < len(low):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        n = count[at:end]
        a = np.repeat(np.arange(at, end), n)
        if len(a):
            yield a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n - low[at:end], n)
        at = end


def partners(unit: np.ndarray, side: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by (unit, side), the range of rows that each is compared with: in a unit alone those after it, else side 1 for those of side 0."""
    n = len(unit)
    first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    size = np.diff(np.append(first, n))
    end = np.repeat(first + size, size)
    zeros = np.add.reduceat((side == 0).astype(np.int64), first)
    middle = np.repeat(first + zeros, size)
    low = np.where(alone, np.arange(n) + 1, middle)
    return low, np.where(alone | (side == 0), end, low)


def in_units(members: DataFrame, chunk: int, weight: int | None = None) -> DataFrame:
    """members (cls, bucket, core long, size long, ...) dealt out to units of work of at most two chunks: unit, lo, hi and side are added.

    A bucket of more than chunk members (or weight, summed over size) is cut in chunks by a hash of cls, and pairs of chunks are units,
    so that no task holds a bucket. Members of one core (other than 0) are known to be linked with each other: where a
    bucket has chunk or more of them they have chunks of their own, and such chunks are not paired with each other.
    """
    by_core = members.groupBy("bucket", "core").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    by_core = by_core.withColumn("part", F.when(F.col("n") >= chunk, F.col("core")).otherwise(F.lit(0)))
    parts = by_core.groupBy("bucket", "part").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    sized = F.greatest(F.ceil(F.col("n") / chunk), F.ceil(F.col("size") / weight) if weight else F.lit(1)).cast("int")
    parts = parts.withColumn("chunks", sized)
    # a bucket has few parts, as each but one holds chunk members
    gathered = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("part", "chunks"))).alias("parts")).where("n > 1")
    gathered = gathered.select("bucket", "parts", F.expr("aggregate(parts, 0, (a, x) -> a + x.chunks)").alias("total"))
    rows = members.join(gathered, "bucket")
    rows = rows.withColumn("place", F.expr("greatest(array_position(transform(parts, x -> x.part), core), 1)").cast("int"))
    rows = rows.withColumn("first", F.expr("aggregate(slice(parts, 1, place - 1), 0, (a, x) -> a + x.chunks)"))
    rows = rows.withColumn("mine", F.expr("parts[place - 1]"))
    rows = rows.withColumn("own", F.expr("first + cast(pmod(xxhash64(cls, 7), mine.chunks) AS int)"))
    # a part of a core other than 0 is not paired with itself
    other = F.expr("filter(sequence(0, total - 1), o -> mine.part = 0 OR o < first OR o >= first + mine.chunks)")
    rows = rows.withColumn("other", F.explode(other))
    rows = rows.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other"), "side": (F.col("own") > F.col("other")).cast("int")})
    return rows.withColumn("unit", F.xxhash64("bucket", "lo", "hi")).drop("parts", "total", "place", "first", "mine", "own", "other")


def dealt(units: DataFrame) -> DataFrame:
    """Units whole in partitions, sorted as partners() asks."""
    return units.repartition("unit").sortWithinPartitions("unit", "side")


def with_cores(found: DataFrame, cores: DataFrame) -> DataFrame:
    """found (a, b, links) and the links within cores: cores (cls, core, copies) holds classes that are all linked with each other, each in one core at most."""
    sums = cores.groupBy("core").agg(F.sum("copies").alias("all"), F.min("cls").alias("b"), F.count("*").alias("n")).where("n > 1")
    sums = F.broadcast(sums) if small(sums, 10_000) else sums
    return found.unionByName(cores.join(sums, "core").select(F.col("cls").alias("a"), "b", (F.col("all") - F.col("copies")).alias("links")))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser over unsigned 64-bit integers, equal on every machine."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every node: (node, root), from edges (a, b).

    Large-star and small-star steps (alternating), each an aggregate and a join whose large side can be split, with a
    durable table after each round; nothing but one count and one checksum reaches the driver. Nodes without an edge
    to another node are not returned. Null ends are ignored.
    """
    spark = edges.sparkSession
    pairs = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    last, rows = None, pairs.count()
    for _ in range(rounds):
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        stars = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").union(lowest.select("a", F.col("m").alias("b"))).distinct()
        # a round has at most as many rows as edges and nodes: no more files than they fill
        files = 1 + 3 * rows // FILE_ROWS
        new = durable(stars.coalesce(files) if files < partitions(spark) else stars, "stars")
        mark = new.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(pmod(xxhash64(b, a), 1000000007))")).first()
        discard(spark, pairs)
        pairs, rows = new, mark[0]
        if mark == last:
            break
        last = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def settle(rows: DataFrame, classes: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """One row for each of rows (key, cls): the key under its name, class_id, n_links, component_id and kept.

    classes (cls, copies, first) names the classes of equal rows; found (a, b, links) has, for classes linked in some unit
    of work, a class that they reach and the rows linked with each row of a. A null cls is linked with nothing.
    """
    links = found.groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    reached = components(found.select("a", "b")).select(F.col("node").alias("cls"), "root")
    told = classes.select("cls", "copies", "first").join(links, "cls", "left").join(reached, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    told = durable(told, "told")
    lowest = told.groupBy("root").agg(F.min("first").alias("lowest"))
    told = told.join(lowest, "root").select("cls", "first", "lowest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    alone = F.col("cls").isNull()
    out = rows.select("key", "cls").join(told, "cls", "left").select(
        F.col("key").alias(key),
        F.when(alone, F.col("key")).otherwise(F.col("first")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("key")).otherwise(F.col("lowest")).alias("component_id"),
    )
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
