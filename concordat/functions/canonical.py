"""Canonical text of cells and rows, and digests of result sets that don't depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stands for null in canonical rows; no canonical cell can equal it, as texts have their control characters escaped.
NULL = "\x01N"
BETWEEN = "\x1f"


def escaped(c: Column) -> Column:
    """A text in which the mark of null and the separator of cells can't stand."""
    for raw, made in (("\\", "\\\\"), (BETWEEN, "\\u"), ("\x01", "\\1")):
        c = F.replace(c, F.lit(raw), F.lit(made))
    return c


def routine_cell(c: Column, kind: T.DataType) -> Column:
    """Cell of a routine's result: numbers with four decimals, lower-case booleans, times to the second, bytes in hex, text trimmed."""
    if isinstance(kind, T.BooleanType):
        text = F.lower(c.cast("string"))
    elif isinstance(kind, T.NumericType):
        text = F.format_string("%.4f", c.cast("double"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    elif isinstance(kind, T.BinaryType):
        text = F.lower(F.hex(c))
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(c)
    else:
        text = F.btrim(c.cast("string"))
    return F.coalesce(text, F.lit("NULL"))


def view_cell(c: Column, kind: T.DataType) -> Column:
    """Cell of a view's result: decimals exactly and without trailing zeros, doubles by the text that reads back as the same number, times in
    UTC to the second, dates as ISO text, text escaped, null as NULL's mark."""
    if isinstance(kind, T.BooleanType):
        text = F.lower(c.cast("string"))
    elif isinstance(kind, T.DecimalType):
        plain = c.cast("string")
        text = F.when(plain.contains("."), F.regexp_replace(F.rtrim(plain, F.lit("0")), r"\.$", "")).otherwise(plain)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        plain = F.regexp_replace(c.cast("string"), r"\.0$", "")
        text = F.when(plain == "-0", "0").otherwise(plain)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    elif isinstance(kind, T.BinaryType):
        text = F.lower(F.hex(c))
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = escaped(F.to_json(c))
    elif isinstance(kind, T.StringType):
        # fixed value: the form of a time stamp with or without fraction and zone
        text = escaped(F.regexp_replace(c, r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(\.\d+)?(Z|[+-]\d{2}:?\d{2})?$", "$1 $2"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(NULL))


def serialised(c: Column, kind: T.DataType) -> Column:
    """Cell of an execution log: numbers rounded to six places, times as ISO text without a zone, bytes in hex."""
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.round(c.cast("double"), 6).cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    if isinstance(kind, T.BinaryType):
        return F.lower(F.hex(c))
    return c.cast("string")


def canonical_row(df: DataFrame, cell=view_cell, columns: list[str] | None = None) -> Column:
    """One text for a row: its canonical cells between separators."""
    kinds = {f.name: f.dataType for f in df.schema}
    return F.concat_ws(BETWEEN, *(cell(F.col(f"`{c}`"), kinds[c]) for c in columns or df.columns))


def row_number_of(row: Column) -> Column:
    """The first 15 hex digits of a row's MD5 as a number: 60 bits, so that sums of 2 to the 60 rows fit 38 digits."""
    return F.conv(F.substring(F.md5(row.cast("binary")), 1, 15), 16, 10).cast("bigint")


def set_digest(df: DataFrame, by: list[str] | None = None, cell=view_cell, columns: list[str] | None = None) -> DataFrame:
    """n_rows, digest_sum (text) and digest_xor of df, or of each group: equal multisets of rows have equal digests. Partial sums
    are made before the shuffle; no rows are gathered or sorted."""
    number = row_number_of(canonical_row(df, cell, columns)).alias("__n")
    rows = df.select(*(by or []), number)
    return rows.groupBy(*(by or [])).agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(F.col("__n").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest_sum"),
        F.coalesce(F.bit_xor("__n"), F.lit(0)).alias("digest_xor"),
    )
