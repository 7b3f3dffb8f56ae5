"""Values on their way between systems: coercion by type, spatial blobs, literals of Python-like text."""

from __future__ import annotations

import ast
import json
import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def from_field(x: Column, kind: str) -> Column:
    """A text field of an export as kind: an empty text stays empty, an empty field of another type is null; a value that
    doesn't parse is null, booleans may be 0, 1, t or f."""
    if kind == "string":
        return x
    bare = F.nullif(F.btrim(x), F.lit(""))
    if kind == "boolean":
        return F.when(F.lower(bare).isin("1", "t", "true", "y"), True).when(F.lower(bare).isin("0", "f", "false", "n"), False)
    if kind == "binary":
        return F.try_to_binary(F.regexp_replace(bare, "^(0x|\\\\\\\\x)", ""), F.lit("hex"))
    return bare.try_cast(kind)


def tree_path(x: Column) -> Column:
    """A path /1/2/ as 1.2."""
    return F.array_join(F.filter(F.split(x, "/"), lambda p: p != ""), ".")


def copy_field(x: Column) -> Column:
    """A text as a field of a bulk-load file: null as \\N, with tabs, line ends and backslashes escaped."""
    out = F.replace(x, F.lit("\\"), F.lit("\\\\"))
    for raw, named in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(raw), F.lit(named))
    return F.coalesce(out, F.lit("\\N"))


def point_text(blob: bytes | None) -> str | None:
    """EWKT of a 22-byte point (SRID, version 1, flags 12, latitude, longitude; little-endian), else null."""
    if blob is None or len(blob) != 22 or blob[4] != 1 or blob[5] != 0x0C:
        return None
    srid, _, _, lat, lon = struct.unpack("<IBBdd", blob)
    return f"SRID={srid};POINT({lon} {lat})"


@F.pandas_udf(T.StringType())
def spatial_text(blobs: pd.Series) -> pd.Series:
    return blobs.map(lambda b: point_text(None if b is None else bytes(b)))


def wkb_text(blob: bytes | None) -> str | None:
    """WKT of a geometry stored as a 4-byte SRID and a WKB point, else null."""
    if blob is None or len(blob) != 25:
        return None
    order = "<" if blob[4] == 1 else ">"
    kind, x, y = struct.unpack(order + "Idd", blob[5:])
    return f"POINT({x} {y})" if kind == 1 else None


@F.pandas_udf(T.StringType())
def geometry_text(blobs: pd.Series) -> pd.Series:
    return blobs.map(lambda b: wkb_text(None if b is None else bytes(b)))


def literal_text(text: str | None) -> str | None:
    """A list or mapping in JSON or Python notation as JSON with sorted keys; other text as it is."""
    if text is None or not text.strip()[:1] in ("{", "["):
        return text
    for read in (json.loads, ast.literal_eval):
        try:
            return json.dumps(read(text), sort_keys=True, default=str)
        except (ValueError, SyntaxError):
            continue
    return text


@F.pandas_udf(T.StringType())
def canonical_literal(texts: pd.Series) -> pd.Series:
    return texts.map(literal_text)


def masked(x: Column, name: Column) -> Column:
    """x, or *** where its name tells of a secret."""
    return F.when(F.lower(name).rlike("password|passwd|secret|token|credential|private_key|api_key"), "***").otherwise(x)
