"""How filters interact: joint failures of all sets of filters, inverted to what each filter does in each order."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small
from .lines import let, words

#: Rows of a table of labels that is broadcast; beyond that the join is shuffled.
BROADCAST_LABELS = 1_000_000


def text_flags(text: Column, min_words: int = 100, distinct_percent: int = 80, capitals_percent: int = 10, symbols: str = r"[#$%&*|]") -> dict[str, Column]:
    """Failures that the text alone decides. A: fewer than min_words words; B: less than distinct_percent of the words differ;
    C: more than capitals_percent of the code points are A-Z; D: it holds a symbol. The empty text fails A only."""
    counts = let(words(text), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("different")))
    return {
        "A": counts["n"] < min_words,
        "B": 100 * counts["different"] < distinct_percent * counts["n"],
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > capitals_percent * F.length(text),
        "D": text.rlike(symbols),
    }


def judged(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of docs (key, text, lang) counted by what they fail: part, flags A to E (0 or 1), rows, good, toxic (all long); a few rows for
    each different text.

    A to D are text_flags(); E: an equal text stands under a smaller key anywhere in the table. A null text is empty, a null lang the
    part of the empty string, with which it is counted. A null key is smaller than none and has no label, so it fails E never and makes
    nothing fail; rows that repeat a key and a text fail E alike. good and toxic: a label of the key says quality = 1, toxic = 1; a key
    with several labels has the largest. Other columns are left out. Texts travel as SHA-256 digests; a text that many rows
    share is counted before it is shuffled.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    seen = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("t"))
    seen = seen.select("k", "part", F.sha2("t", 256).alias("digest"), F.struct(*(c.cast("long").alias(n) for n, c in text_flags(F.col("t")).items())).alias("flags"))
    # null keys meet nobody, so they are spread by their texts instead of gathered
    seen = seen.withColumn("salt", F.when(F.col("k").isNull(), F.xxhash64("digest") % 1024).otherwise(F.lit(0)))
    known = labels.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("k")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    known = F.broadcast(known) if small(labels, BROADCAST_LABELS) else known.withColumn("salt", F.lit(0).cast("long"))
    told = seen.join(known, [c for c in ("k", "salt") if c in known.columns], "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(0))
    by_key = told.groupBy("k", "salt", "digest", "part", "flags", flag("good").alias("good"), flag("toxic").alias("toxic")).agg(F.count("*").alias("n"))
    least = F.when(F.col("k").isNotNull(), F.struct("k", "n"))
    by_text = by_key.groupBy("digest", "part", "flags", "good", "toxic").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("k").isNotNull(), F.col("n"))).alias("keyed"), F.min(least).alias("least"))
    # a window holds a row for each part and label of one text, not the rows that have it
    first = F.min("least.k").over(Window.partitionBy("digest"))
    copies = by_text.withColumn("first", first).withColumn("again", F.coalesce(F.col("keyed") - F.when(F.col("least.k") == F.col("first"), F.col("least.n")).otherwise(F.lit(0)), F.lit(0)))
    sides = F.explode(F.array(F.struct(F.lit(0).cast("long").alias("E"), (F.col("n") - F.col("again")).alias("rows")), F.struct(F.lit(1).cast("long").alias("E"), F.col("again").alias("rows")))).alias("side")
    out = copies.select("part", "flags.*", "good", "toxic", sides)
    return out.select("part", "A", "B", "C", "D", "side.E", F.col("side.rows").alias("rows"), *((F.col("side.rows") * F.col(c)).alias(c) for c in ("good", "toxic")))


def joint_failures(counted: DataFrame, filters: str, sums: Mapping[str, str]) -> DataFrame:
    """For each part arrays of 2^n sums: at place S the sum over rows that fail every filter of the set S (bit i: filter i), as sums of
    products of flags. counted: part, a flag (0 or 1) for each filter, and the columns that sums names, by the names of the arrays."""

    def fails(subset: int) -> Column:
        flags = [F.col(f) for i, f in enumerate(filters) if subset >> i & 1]
        return reduce(lambda a, b: a * b, flags, F.lit(1))

    sets = range(1 << len(filters))
    return counted.groupBy("part").agg(*(F.array(*(F.sum(F.col(c) * fails(s)) for s in sets)).alias(name) for name, c in sums.items()))


def signed_sum(joint: Column, sets: Column, weight) -> Column:
    """The sum of weight(S) times joint[S] over an array of sets S."""
    return F.aggregate(sets, F.lit(0).cast("long"), lambda total, s: total + weight(s) * F.get(joint, s))


def audit(counted: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """One row for each part, each order of the filters and each step of it: part, filter_order, step, filter and the counts (long) kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    counted: part, a flag (0 or 1) for each filter, rows, good, toxic, with any number of rows for a combination. Only joint failures J(S) are
    aggregated; all else is their Moebius inversion. Survivors of the filters K: the sum over S in K of (-1)^|S| J(S). Failures of f alone: the
    sum over S without f of (-1)^|S| J(S and f). The Harsanyi dividend of S in the game "rows removed" is -(-1)^|S| J(S), and f has the
    |S|th part of the dividend of each S with f; times n! that is whole, the sum of what f removes over all orders. Parts without rows do not
    show; a count that nothing adds to is 0; no rows give none.
    """
    n = len(filters)
    joint = joint_failures(counted, filters, {"rows_in": "rows", "good_in": "good", "toxic_in": "toxic"})
    sign = lambda s: 1 - 2 * (F.bit_count(s) % 2)
    every = F.sequence(F.lit(0), F.lit((1 << n) - 1))
    survivors = lambda c: F.transform(every, lambda k: signed_sum(F.col(c), F.filter(every, lambda s: s.bitwiseAND(k) == s), sign))
    of = lambda f: F.filter(every, lambda s: F.shiftright(s, f) % 2 == 1)
    alone = F.array(*(signed_sum(F.col("rows_in"), of(f), lambda s: -sign(s)) for f in range(n)))
    shares = F.array(*(signed_sum(F.col("rows_in"), of(f), lambda s: -sign(s) * (F.lit(factorial(n)) / F.bit_count(s)).cast("long")) for f in range(n)))
    held = joint.select("part", "rows_in", survivors("rows_in").alias("rows"), survivors("good_in").alias("good"), survivors("toxic_in").alias("toxic"), alone.alias("alone"), shares.alias("shares"))
    orders = F.explode(F.array(*(F.lit("".join(filters[i] for i in p)) for p in permutations(range(n))))).alias("filter_order")
    steps = held.select("*", orders).select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    earlier = F.substr(F.col("filter_order"), F.lit(1), F.col("step") - 1)
    before = reduce(lambda a, b: a + b, (F.when(F.contains(earlier, F.lit(x)), 1 << i).otherwise(0) for i, x in enumerate(filters)))
    steps = steps.withColumns({"filter": F.substr(F.col("filter_order"), F.col("step"), F.lit(1)), "before": before})
    steps = steps.withColumn("f", F.expr(f"instr('{filters}', filter) - 1")).withColumn("bit", F.expr("shiftleft(1, f)")).withColumn("after", F.col("before") + F.col("bit"))
    lost = lambda c: F.get(c, F.col("before")) - F.get(c, F.col("after"))
    failing = F.get("rows_in", F.col("bit"))
    return steps.select(
        "part",
        "filter_order",
        "step",
        "filter",
        F.get("rows", F.col("after")).alias("kept"),
        lost("rows").alias("removed"),
        (failing - lost("rows")).alias("redundant"),
        F.get("alone", F.col("f")).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("shares", F.col("f")).alias("shapley"),
    )
