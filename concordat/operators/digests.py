"""Digest trees: digests of ranges of hashed keys in levels, so that two tables are compared without moving the rows in which they are equal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.functions.canonical import BETWEEN, canonical_row, row_number_of, view_cell

from .durable import durable
from .parity import diff_rows

#: Hexadecimal digits of a key's MD5 that each level goes by, and ranges that differ up to which they are broadcast to filter rows.
DIGITS, BROADCAST_RANGES = 3, 200_000


def path(df: DataFrame, keys: list[str]) -> Column:
    """Where a row lies in the tree: the MD5 of its canonical keys, of which each level reads some digits more."""
    return F.md5(canonical_row(df, columns=keys).cast("binary"))


def tree_hash(df: DataFrame, by: list[str] | None = None, cell=view_cell, columns: list[str] | None = None) -> DataFrame:
    """set_hash and n_rows of df, or of each group: the MD5 of the digests of 16 ** DIGITS ranges of row hashes, in their order. It tells multisets of rows
    apart as a hash of all sorted rows would, but what is gathered are digests, a few thousand whatever the size of a group. No rows: the MD5 of nothing."""
    text = canonical_row(df, cell, columns)
    rows = df.select(*(by or []), text.alias("__row")).select(*(by or []), F.substring(F.md5(F.col("__row").cast("binary")), 1, DIGITS).alias("__range"), row_number_of(F.col("__row")).alias("__number"))
    ranges = rows.groupBy(*(by or []), "__range").agg(F.count("*").alias("__n"), F.sum(F.col("__number").cast("decimal(38,0)")).cast("string").alias("__total"), F.bit_xor("__number").alias("__mixed"))
    digest = F.concat_ws(":", "__range", "__n", "__total", "__mixed")
    return ranges.groupBy(*(by or [])).agg(F.md5(F.array_join(F.array_sort(F.collect_list(digest)), ",").cast("binary")).alias("set_hash"), F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"))


def signed(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], cell) -> DataFrame:
    """Rows of both sides as __path, __n (a number of their keys and cells) and __sign (1 and -1)."""
    side = lambda df, sign: df.select(path(df, keys).alias("__path"), row_number_of(F.concat_ws(BETWEEN, canonical_row(df, columns=keys), canonical_row(df, cell, columns))).alias("__n"), F.lit(sign).alias("__sign"))
    return side(source, 1).unionByName(side(target, -1))


def within(rows: DataFrame, at: Column, ranges: DataFrame | None, digits: int, small: bool) -> DataFrame:
    """Rows in some of these ranges, of so many digits."""
    if ranges is None:
        return rows
    return rows.withColumn("range", F.substring(at, 1, digits)).join(F.broadcast(ranges) if small else ranges, "range", "left_semi").drop("range")


def digest_diff(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], cell=view_cell, levels: int = 4, enough: int = 16) -> tuple[DataFrame, list[tuple[int, int, int, int, int]]]:
    """diff_rows() of two tables, from only those rows whose range of keys differs; and the levels that led there: number, ranges looked at,
    ranges that differ, and rows of the source and the target in these.

    Each level is one aggregate of both sides, added up before it is shuffled, over the ranges that differed at the level before: equal rows cancel in
    signed sums, so a range without difference is one row of zeros. Levels end when a differing range has no more than enough rows in the
    mean, when ranges outnumber what is broadcast, or after levels of them. Only rows of ranges that differ are shuffled. Rows are canonical as in
    diff_rows(); null keys are keys, repeated rows count.
    """
    rows, ranges, small, told = signed(source, target, keys, columns, cell), None, True, []
    for level in range(1, levels + 1):
        part = F.substring("__path", 1, DIGITS * level).alias("range")
        sums = within(rows, F.col("__path"), ranges, DIGITS * (level - 1), small).groupBy(part).agg(
            F.sum("__sign").alias("n"), F.sum((F.col("__sign") * F.col("__n")).cast("decimal(38,0)")).alias("total"), F.bit_xor("__n").alias("mixed"), F.count_if(F.col("__sign") > 0).alias("s"), F.count_if(F.col("__sign") < 0).alias("t")
        )
        held = durable(sums.select("range", "s", "t", ((F.col("n") != 0) | (F.col("total") != 0) | (F.col("mixed") != 0)).alias("differs")), "ranges")
        seen, differ, left, right = held.agg(F.count("*"), F.count_if("differs"), F.coalesce(F.sum(F.when(F.col("differs"), F.col("s"))), F.lit(0)), F.coalesce(F.sum(F.when(F.col("differs"), F.col("t"))), F.lit(0))).first()
        told.append((level, seen, differ, left, right))
        ranges, small = held.where("differs").select("range"), differ <= BROADCAST_RANGES
        if not differ or left + right <= enough * differ or not small:
            break
    keep = lambda df: within(df.withColumn("__path", path(df, keys)), F.col("__path"), ranges, DIGITS * len(told), small).select(*df.columns)
    return diff_rows(keep(source), keep(target), keys, columns, cell), told
