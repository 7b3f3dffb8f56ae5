"""Text functions of other dialects on Spark columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def length(x: Column) -> Column:
    """Characters without trailing blanks."""
    return F.length(F.rtrim(x))


def datalength(x: Column) -> Column:
    return F.octet_length(x)


def charindex(part: Column, x: Column, start: int = 1) -> Column:
    return F.call_function("locate", part, x, F.lit(start))


def like_to_regex(pattern: str) -> str:
    """A regular expression for a LIKE pattern with %, _ and [...] classes."""
    out, k = "", 0
    while k < len(pattern):
        c = pattern[k]
        if c == "[" and (end := pattern.find("]", k + 1)) > 0:
            body = pattern[k + 1 : end]
            out += "[" + ("^" if body.startswith("^") else "") + body.lstrip("^").replace("\\", "\\\\") + "]"
            k = end + 1
            continue
        out += {"%": ".*", "_": "."}.get(c, re.escape(c))
        k += 1
    return out


def patindex(pattern: str, x: Column) -> Column:
    """Where the pattern first matches, from 1; 0 if nowhere."""
    body = pattern
    free_start, free_end = body.startswith("%"), body.endswith("%") and len(body) > 1
    inner = like_to_regex(body.strip("%"))
    expression = "(?s)" + ("" if free_start else "^") + inner + ("" if free_end else "$")
    return F.coalesce(F.when(x.rlike(expression), F.length(F.regexp_extract(x, f"(?s)^(.*?){inner}" + ("" if free_end else "$"), 1)) + 1), F.when(x.isNotNull(), 0))


def stuff(x: Column, start: int, count: int, new: Column) -> Column:
    """x with count characters from start replaced; null for a start outside x."""
    put = F.concat(F.substring(x, 1, start - 1) if start > 1 else F.lit(""), new, F.substring(x, start + count, 2**31 - 1 - start - count))
    return F.when((F.lit(start) >= 1) & (F.lit(start) <= F.length(x)), put)


def string_split(x: Column, separator: str) -> Column:
    return F.split(x, re.escape(separator), -1)


def plus(*parts: Column) -> Column:
    """Concatenation that is null where a part is."""
    return F.concat(*parts)


def mid(x: Column, start: int, count: int) -> Column:
    return F.substring(x, start, count)


def logical_xor(a: Column, b: Column) -> Column:
    return (a & ~b) | (~a & b)
