"""Dump files of any size: statements found in parallel across splits, and the rows of their INSERT statements as typed columns.

A split of a file begins anywhere, perhaps inside a text or a comment. So each split first tells, for every state in which it may begin, the state in which it ends and
the delimiter that it sets; states are then followed from split to split, a row for each, and each split is read from the state that it does begin in. What a split's
first delimiter ends, and what its last leaves open, is put together with its neighbours' pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.operators.durable import durable

#: States: outside, in a text, in a name in double quotes, in a name in back quotes or brackets, in a comment of several lines.
STATES = "NTDQC"
#: How each system's texts escape, which marks open names, and what begins a comment of one line.
KINDS = {"mysql": (True, "`", "--|#"), "mariadb": (True, "`", "--|#"), "mssql": (False, "[", "--"), "oracle": (False, "", "--")}
LONE = {"mssql": re.compile(r"(?i)^\s*go(?:\s+\d+)?\s*$"), "oracle": re.compile(r"^\s*/\s*$")}
DELIMITER = re.compile(r"(?i)^\s*delimiter\s+(\S+)\s*$")


@cache
def patterns(source: str, delimiter: str) -> dict[str, re.Pattern]:
    escapes, name, line = KINDS[source]
    slash = r"\\.|" if escapes else ""
    opens = "|".join(filter(None, ["'", '"', re.escape(name) if name else "", r"/\*", line, re.escape(delimiter)]))
    closing = {"`": "``|`", "[": r"\]\]|\]", "": "(?!)"}[name]
    return {"N": re.compile(opens), "T": re.compile(rf"{slash}''|'"), "D": re.compile(rf'{slash}""|"'), "Q": re.compile(closing), "C": re.compile(r"\*/")}


def followed(line: str, state: str, delimiter: str, source: str) -> tuple[str, list[int]]:
    """The state behind a line, and the places behind the delimiters in it."""
    held, at, ends = patterns(source, delimiter), 0, []
    while True:
        m = held[state].search(line, at)
        if not m:
            return state, ends
        mark, at = m[0], m.end()
        if state != "N":
            state = "N" if mark in ("'", '"', "`", "]", "*/") else state
        elif mark == delimiter:
            ends.append(at)
        elif mark in ("'", '"', "`", "[", "/*"):
            state = {"'": "T", '"': "D", "`": "Q", "[": "Q", "/*": "C"}[mark]
        else:
            return state, ends  # a comment up to the line's end


def delimiter_of(source: str) -> str:
    return "\x00" if source == "mssql" else ";"  # batches end at lines of their own


def by_split(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """Lines of one split after the other, in the order of a task's rows."""
    rows = ((r.path, int(r.start), r.value) for f in frames for r in f.itertuples(index=False))
    row = next(rows, None)
    while row is not None:
        key = row[:2]

        def lines() -> Iterator[str]:
            nonlocal row
            while row is not None and row[:2] == key:
                yield row[2]
                row = next(rows, None)

        held = lines()
        yield key, held
        for _ in held:  # what was not read
            pass


def statements(lines: DataFrame, source: str) -> DataFrame:
    """(path, start, place, statement): the statements of files, in the order of start and place. lines: value, path and start of its split, in
    order within a split, as text_lines() reads them.

    Statements end at semicolons, at the delimiter that a line DELIMITER sets, or at lines GO and /, outside of texts, names and comments; empty ones are
    left out. Two passes over the lines; what reaches the driver is a row for each split, and only statements at the ends of splits are shuffled.
    """

    def ends_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (path, start), held in by_split(frames):
            now = {s: (s, "") for s in STATES}
            for line in held:
                known: dict[tuple[str, str], tuple[str, str]] = {}
                for s, at in now.items():
                    if at not in known:
                        m = DELIMITER.match(line) if at[0] == "N" else None
                        known[at] = ("N", m[1]) if m else (followed(line, at[0], at[1] or delimiter_of(source), source)[0], at[1])
                    now[s] = known[at]
            yield pd.DataFrame({"path": [path], "start": [start], "ends": ["".join(now[s][0] for s in STATES)], "set": [[now[s][1] for s in STATES]]})

    spark = lines.sparkSession
    splits = sorted((r["path"], r["start"], r["ends"], r["set"]) for r in lines.mapInPandas(ends_of, "path string, start long, ends string, `set` array<string>").collect())
    begins, last = {}, None
    for path, start, ends, given in splits:
        if path != last:
            last, state, delimiter = path, "N", delimiter_of(source)
        begins[path, start] = (state, delimiter)
        k = STATES.index(state)
        state, delimiter = ends[k], given[k] or delimiter
    told = spark.sparkContext.broadcast(begins)

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (path, start), held in by_split(frames):
            state, delimiter = told.value[path, start]
            out: list[tuple[int, str, bool]] = []
            open_, place = [], 0
            for line in held:
                if state == "N" and (m := DELIMITER.match(line)):
                    delimiter = m[1]
                    continue
                if state == "N" and source in LONE and LONE[source].match(line):
                    out.append((place, "".join(open_), True))
                    open_, place = [], place + 1
                    continue
                before, ends = state, []
                state, ends = followed(line, before, delimiter, source)
                at = 0
                for e in ends:
                    out.append((place, "".join([*open_, line[at : e - len(delimiter)]]), True))
                    open_, place, at = [], place + 1, e
                open_.append(line[at:] + "\n")
                if len(out) > 2000:
                    yield frame(path, start, out)
                    out = []
            out.append((place, "".join(open_), False))
            yield frame(path, start, out)

    def frame(path: str, start: int, out: list[tuple[int, str, bool]]) -> pd.DataFrame:
        return pd.DataFrame({"path": path, "start": start, "place": [p for p, _, _ in out], "statement": [s for _, s, _ in out], "ended": [e for _, _, e in out]})

    found = durable(lines.mapInPandas(pieces, "path string, start long, place int, statement string, ended boolean"), "pieces")
    counts = sorted((r["path"], r["start"], r["n"]) for r in found.where("NOT ended").select("path", "start", F.col("place").alias("n")).collect())  # a row for each split
    owner, last, at = [], None, (0, 0)
    for path, start, n in counts:
        if path != last:
            last, at = path, (start, 0)
        owner.append((path, start, *at))
        at = (start, n) if n else at
    owners = spark.createDataFrame(owner, "path string, start long, own_start long, own_place int")
    inner = found.where("ended AND place > 0").select("path", "start", "place", "statement")
    edge = found.where("NOT ended OR place = 0").join(F.broadcast(owners), ["path", "start"])  # a row for each split
    first = F.col("place") == 0
    edge = edge.select("path", F.when(first, F.col("own_start")).otherwise(F.col("start")).alias("s"), F.when(first, F.col("own_place")).otherwise(F.col("place")).alias("p"), F.struct("start", "place", "statement").alias("piece"))
    joined = edge.groupBy("path", "s", "p").agg(F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda x: x["statement"]), "").alias("statement"))
    whole = inner.unionByName(joined.select("path", F.col("s").alias("start"), F.col("p").alias("place"), "statement"))
    return whole.withColumn("statement", F.btrim("statement", F.lit(" \n\r\t"))).where("statement <> ''")


def text_lines(spark, path: str) -> DataFrame:
    """Lines of files with their file and where their split begins."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(F.rtrim(F.col("value"), F.lit("\r")).alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))


INSERT = re.compile(r"(?is)^(?:\s|--[^\n]*\n|/\*.*?\*/)*insert\s+(?:ignore\s+)?(?:into\s+)?([\w.\[\]`\"]+)\s*(?:\(([^()]*)\))?\s*values\s*")
VALUE = re.compile(r"(?is)\s*(?:N?'((?:[^'\\]|''|\\.)*)'|(null)|0x([0-9a-f]*)|(true|false)|([-+]?[\d.]+(?:e[-+]?\d+)?)|([^,()']+(?:\([^()]*\))?))\s*([,)])")
UNESCAPED = {"n": "\n", "t": "\t", "r": "\r", "0": "\x00", "b": "\b", "Z": "\x1a"}


def values_of(statement: str, source: str) -> tuple[str, list[str], list[list[str | None]]] | None:
    """The table, the columns it lists and the rows (as texts) of an INSERT .. VALUES; None for another statement."""
    m = INSERT.match(statement)
    if not m:
        return None
    rows, at = [], m.end()
    value = VALUE if KINDS[source][0] else re.compile(VALUE.pattern.replace(r"(?:[^'\\]|''|\\.)*", r"(?:[^']|'')*"))
    while at < len(statement) and statement[at] == "(":
        at += 1
        row: list[str | None] = []
        while True:
            v = value.match(statement, at)
            if not v:
                raise ValueError(f"not a value: {statement[at : at + 40]}")
            if v[1] is not None:
                text = v[1].replace("''", "'")
                text = re.sub(r"(?s)\\(.)", lambda x: UNESCAPED.get(x[1], x[1]), text) if KINDS[source][0] else text
                row.append(text)
            else:
                row.append(None if v[2] else v[3] if v[3] is not None else (v[4] or v[5] or v[6]).strip())
            at = v.end()
            if v[7] == ")":
                break
        rows.append(row)
        at = re.compile(r"[\s,]*").match(statement, at).end()
    bare = lambda x: re.sub(r"[\[\]`\"]", "", x).rpartition(".")[2].strip().lower()
    return bare(m[1]), [bare(c) for c in m[2].split(",")] if m[2] else [], rows


def table_rows(found: DataFrame, source: str, table: str, schema: str) -> DataFrame:
    """Rows that the INSERT statements of a table hold, as columns of schema; columns that a statement doesn't list are null, hexadecimal texts are bytes."""
    spark = found.sparkSession
    fields = spark.createDataFrame([], schema).schema
    place = {f.name.lower(): i for i, f in enumerate(fields)}

    def parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for s in f["statement"]:
                got = values_of(s, source)
                if got and got[0] == table.lower():
                    at = [place[c] for c in got[1]] if got[1] else list(range(len(place)))
                    for r in got[2]:
                        row: list[str | None] = [None] * len(place)
                        for i, v in zip(at, r, strict=True):
                            row[i] = v
                        out.append(row)
            yield pd.DataFrame({"cells": out})

    cells = found.select("statement").mapInPandas(parsed, "cells array<string>")
    kinds = {"binary": lambda c: F.unhex(c)}
    return cells.select(*(kinds.get(f.dataType.simpleString(), lambda c, t=f.dataType: c.cast(t))(F.col("cells")[i]).alias(f.name) for i, f in enumerate(fields)))


def insert_lines(df: DataFrame, table: str, source: str) -> DataFrame:
    """A line (value) for each row of df: an INSERT statement that gives it back. Line breaks in texts stay in the statement."""

    def text(c, kind):
        if kind == "binary":
            return F.concat(F.lit("0x"), F.hex(c))
        if kind in ("string", "date", "timestamp", "timestamp_ntz"):
            plain = F.replace(c.cast("string"), F.lit("'"), F.lit("''"))
            return F.concat(F.lit("'"), F.replace(plain, F.lit("\\"), F.lit("\\\\")) if KINDS[source][0] else plain, F.lit("'"))
        return c.cast("string")

    cells = F.concat_ws(", ", *(F.coalesce(text(F.col(f"`{f.name}`"), f.dataType.simpleString()), F.lit("NULL")) for f in df.schema))
    end = "\nGO" if source == "mssql" else ";"
    return df.select(F.concat(F.lit(f"INSERT INTO {table} ({', '.join(df.columns)}) VALUES ("), cells, F.lit(f"){end}")).alias("value"))
