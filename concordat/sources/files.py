"""Files of exports, logs and definitions as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOG_SCHEMA = "full_name string, schema string, procedure_name string, status string, call_string string, param_source string, strategy_used string, total_rows bigint, result_sets array<struct<columns:array<string>,row_count:int>>, error string"


def decoded(content: Column) -> Column:
    """Text of a file's bytes by its byte order mark; UTF-8 without one."""
    head = F.hex(F.substring(content, 1, 3))
    rest = lambda n: F.substring(content, n + 1, 2**31 - 1 - n)
    return F.when(head == "EFBBBF", F.decode(rest(3), "UTF-8")).when(head.startswith("FFFE"), F.decode(rest(2), "UTF-16LE")).when(head.startswith("FEFF"), F.decode(rest(2), "UTF-16BE")).otherwise(F.decode(content, "UTF-8"))


def read_texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(file, value) of all files below path, decoded."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return f.select(F.col("path").alias("file"), decoded(F.col("content")).alias("value"))


def statements(texts: DataFrame, source: str) -> DataFrame:
    """(file, place, statement, kind) of scripts: split at GO lines, lines with a slash, or semicolons at line ends, by dialect."""
    mark = {"mssql": r"(?im)^[ \t]*go[ \t]*\r?$", "oracle": r"(?m)^[ \t]*/[ \t]*\r?$"}.get(source, r"(?m);[ \t]*\r?$")
    s = texts.select("file", F.posexplode(F.filter(F.transform(F.split("value", mark), F.btrim), lambda x: F.regexp_replace(x, r"\s", "") != "")).alias("place", "statement"))
    return s.withColumn("statement", F.regexp_replace("statement", r"^\s+|\s+$", "")).withColumn("kind", statement_kind(F.col("statement")))


def statement_kind(s: Column) -> Column:
    kind = F.lower(F.regexp_extract(s, r"(?is)^\s*(?:create|alter)\s+(?:or\s+(?:replace|alter)\s+)?(?:definer\s*=\s*\S+\s+)?(table|view|procedure|proc|function|trigger|sequence|schema|index|unique\s+index|type|package)\b", 1))
    return F.when(kind == "proc", "procedure").when(kind.endswith("index"), "index").when(kind == "", "other").otherwise(kind)


#: The order in which kinds of definitions are run.
KIND_ORDER = ["schema", "sequence", "type", "table", "index", "function", "view", "procedure", "trigger", "other"]


def in_kind_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.array_position(F.array(*map(F.lit, KIND_ORDER)), F.col("kind")), "file", "place")


def split_delimited(text: str) -> list[str]:
    """Statements of a script that changes its delimiter: DELIMITER lines are taken out, marks in quotes and comments don't count."""
    out, mark, held, k, n = [], ";", "", 0, len(text)
    while k < n:
        line_start = k == 0 or text[k - 1] == "\n"
        if line_start and text[k : k + 10].lower() == "delimiter ":
            end = text.find("\n", k)
            end = n if end < 0 else end
            mark, k = text[k + 10 : end].strip() or ";", end
            continue
        if text[k] in "'\"`":
            end = k + 1
            while end < n and text[end] != text[k]:
                end += 2 if text[end] == "\\" else 1
            held, k = held + text[k : end + 1], end + 1
            continue
        if text.startswith("--", k) or text.startswith("/*", k):
            stop = "\n" if text[k] == "-" else "*/"
            end = text.find(stop, k + 2)
            end = n if end < 0 else end + len(stop)
            held, k = held + text[k:end], end
            continue
        if text.startswith(mark, k):
            out.append(held.strip())
            held, k = "", k + len(mark)
            continue
        held, k = held + text[k], k + 1
    return [s for s in [*out, held.strip()] if s]


def sniffed_records(texts: DataFrame) -> DataFrame:
    """(file, record, fields) of exports whose fields end with a tab and records with a line, or with +| and &|.

    In the first form a record begins where a line begins with digits and a tab, so that lines inside fields stay whole.
    """
    marked = F.col("value").contains("+|")
    plain = F.regexp_replace(F.regexp_replace("value", "^﻿", ""), "\r\n", "\n")
    records = F.when(marked, F.split(plain, r"&\|\n?")).otherwise(F.split(F.regexp_replace(plain, r"\n+$", ""), r"\n(?=[0-9]+\t)"))
    rows = texts.select("file", marked.alias("m"), F.posexplode(F.filter(records, lambda r: r != "")).alias("record", "line"))
    return rows.select("file", "record", F.when(F.col("m"), F.split("line", r"\+\|")).otherwise(F.split("line", "\t")).alias("fields"))


def execution_log(lines: DataFrame) -> DataFrame:
    """Last record (line, value) of each routine, by its lower-case name; lines that aren't records are left out."""
    r = lines.withColumn("r", F.from_json("value", LOG_SCHEMA, {"mode": "PERMISSIVE"})).where(F.col("r.full_name").isNotNull())
    r = r.select("line", F.lower("r.full_name").alias("full_name"), *(f"r.{c.split()[0]}" for c in ("status", "total_rows", "error", "result_sets", "call_string", "param_source")))
    last = Window.partitionBy("full_name").orderBy(F.col("line").desc())
    return r.withColumn("__p", F.row_number().over(last)).where("__p = 1").drop("__p", "line")


def bad_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.from_json("value", LOG_SCHEMA)["full_name"].isNull() & (F.btrim("value") != ""))


def jdbc_table(spark: SparkSession, url: str, name: str, key: str | None = None, low: int = 0, high: int = 0, parts: int = 1, fetch: int = 5000) -> DataFrame:
    """A table of a database, read in ranges of a key where one is given."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", name).option("fetchsize", fetch)
    if key:
        r = r.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
    return r.load()
