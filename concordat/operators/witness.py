"""Witness data: rows by type and constraint, foreign keys that hold, orphans found and repaired, parameters inferred."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranks import numbered
from .wishes import conditions, solved


#: Rows that one task makes or holds.
ROWS_A_TASK = 1_000_000


def value_of(index: Column, kind: str, name: str = "", choices: list[str] | None = None, low: int | None = None, high: int | None = None, size: int | None = None) -> Column:
    """The value of row index (from 0) for a column of a kind: choices and ranges of its check first, then by type, text by name.
    Deterministic: decimals come from a hash of the index."""
    if choices:
        return F.element_at(F.array(*map(F.lit, choices)), (index % len(choices) + 1).cast("int"))
    if low is not None and high is not None:
        return (F.lit(low) + index % (high - low + 1)).cast("int")
    if kind in ("int", "bigint", "smallint"):
        return (index + 1).cast(kind)
    if kind.startswith("decimal"):
        return (F.pmod(F.xxhash64(index), F.lit(100000)) / 100).cast(kind)
    if kind == "boolean":
        return index % 2 == 1
    if kind == "date":
        return F.date_add(F.lit("2024-01-01").cast("date"), (index % 365).cast("int"))
    if kind == "timestamp":
        return F.timestamp_add("SECOND", (index % 86400).cast("int"), F.date_add(F.lit("2024-01-01").cast("date"), (index % 365).cast("int")).cast("timestamp"))
    if kind == "uuid":
        h = F.md5(index.cast("string").cast("binary"))
        return F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    low_name = name.lower()
    n = (index + 1).cast("string")
    if "email" in low_name:
        text = F.concat(F.lit("user"), n, F.lit("@example.com"))
    elif "phone" in low_name:
        text = F.concat(F.lit("555-"), F.lpad(n, 4, "0"))
    elif "name" in low_name:
        text = F.concat(F.lit("name "), n)
    else:
        text = F.concat(F.lit("v"), n)
    return F.substring(text, 1, size) if size else text


def permuted(index: Column, domain: int, key: int = 1) -> Column:
    """A number below domain for each index (from 0, below domain) such that no two indexes have the same: a permutation, of which each key gives another.
    Whole numbers of 38 digits, so domains of up to 10**18 are exact; no row needs to know of another."""
    if not 0 < domain <= 10**18:
        raise ValueError(f"a domain of {domain}")
    factor = int(domain * 0.6180339887498949) + 2 * key + 1
    while gcd(factor, domain) != 1:
        factor += 1
    shift = mixed(key) % domain
    long = lambda v: F.lit(v).cast("decimal(19,0)")
    return F.pmod(index.cast("decimal(18,0)") * long(factor % domain) + long(shift), long(domain)).cast("bigint")


def mixed(key: int) -> int:
    x = (key + 0x9E3779B97F4A7C15) & (2**64 - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ x >> shift) * factor) & (2**64 - 1)
    return x ^ x >> 31


def unique_text(index: Column, size: int, key: int = 1) -> Column:
    """A text of size letters for each index such that no two indexes have the same; there are 26 ** size of them, 12 letters counting at most."""
    letters = min(size, 12)
    number = permuted(index, 26**letters, key)
    text = reduce(F.concat, (F.char(F.lit(97) + F.floor(number / F.lit(26**k)) % 26) if k else F.char(F.lit(97) + number % 26) for k in range(letters))) if letters > 1 else F.char(F.lit(97) + number % 26)
    return F.rpad(text, size, "a")


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks that rows are dealt to, so that what one holds doesn't grow with them."""
    return max(spark.sparkContext.defaultParallelism, 1 + rows // ROWS_A_TASK)


def assign_unique_pairs(children: DataFrame, index: str, rows: int, first: tuple[DataFrame, str, str], second: tuple[DataFrame, str, str], key: int = 1) -> DataFrame:
    """children (with an index below rows) with a pair of references, to first and second (table, key column, name here), that no other child has. There must
    be as many pairs of parents as rows, or ValueError. Pairs are permuted numbers of all pairs, parents found by equality of their places."""
    sizes = [df.count() for df, _, _ in (first, second)]
    if sizes[0] * sizes[1] < rows:
        raise ValueError(f"{rows} rows and {sizes[0] * sizes[1]} pairs")
    out = children.withColumn("__pair", permuted(F.col(index), max(1, sizes[0] * sizes[1]), key))
    out = out.withColumns({"__first": F.expr(f"__pair div {max(1, sizes[1])}") + 1, "__second": F.pmod("__pair", F.lit(max(1, sizes[1]))) + 1})
    tasks = tasks_for(children.sparkSession, rows)
    many = tasks > int(children.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for (df, column, name), place in ((first, "__first"), (second, "__second")):
        out = (out.repartition(tasks, place) if many else out).join(numbered(df.select(F.col(column).alias(name)), F.col(name), place=place), place, "left")
    return out.drop("__pair", "__first", "__second")


def seed(spark: SparkSession, rows: int, columns: list[dict]) -> DataFrame:
    """rows rows of columns, each a dict of value_of's arguments with name and kind."""
    i = F.col("id")
    return spark.range(rows).select(*(value_of(i, **c).alias(c["name"]) for c in columns))


def assign_parents(children: DataFrame, parents: DataFrame, index: str, key: str, name: str) -> DataFrame:
    """children with name: the key of parent number index modulo their count, parents ordered by key. Equi-join on the number, which no one task counts."""
    places = numbered(parents.select(F.col(key).alias(name)), F.col(name), place="__place", total="__total")
    total = F.broadcast(places.agg(F.coalesce(F.max("__total"), F.lit(1)).alias("__total")))  # one row
    wanted_place = children.crossJoin(total).withColumn("__place", F.pmod(F.col(index), F.col("__total")) + 1).drop("__total")
    return wanted_place.join(places.drop("__total"), "__place", "left").drop("__place")


def assign_self_parents(rows: DataFrame, key: str, name: str) -> DataFrame:
    """rows with name: for a reference of a table to itself, the key of the row at half a row's place by key, and null for the first, so that every
    parent is there before its children and the reference has no cycle."""
    places = numbered(rows, F.col(key), place="__place").withColumn("__half", F.expr("__place div 2"))
    parents = places.select(F.col(key).alias(name), F.col("__place").alias("__half"))
    return places.join(parents, "__half", "left").drop("__place", "__half")


def check_values(definition: Column) -> tuple[Column, Column, Column]:
    """Choices (sorted), least and largest value that a CHECK constraint's text allows; null where it doesn't say."""
    quoted = F.regexp_extract_all(definition, F.lit(r"'((?:[^']|'')*)'"), 1)
    choice = definition.rlike(r"(?i)\bin\s*\(|=\s*any|\bor\b.*=") & (F.size(quoted) > 0)
    number = lambda p: F.nullif(F.regexp_extract(definition, p, 1), F.lit("")).cast("bigint")
    low = F.coalesce(number(r"(?i)between\s+(-?\d+)"), number(r">=\s*\(?(-?\d+)"), number(r">\s*\(?(-?\d+)") + 1)
    high = F.coalesce(number(r"(?i)between\s+-?\d+\s+and\s+(-?\d+)"), number(r"<=\s*\(?(-?\d+)"), number(r"<\s*\(?(-?\d+)") - 1)
    return F.when(choice, F.array_sort(F.array_distinct(quoted))), low, high


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of children with a key that no parent has; null keys are no orphans."""
    return children.where(F.col(child_key).isNotNull()).join(parents.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def repair_orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """children with orphaned keys set to the least parent key, and repaired telling so."""
    known = parents.select(F.col(parent_key).alias(child_key)).distinct().withColumn("__known", F.lit(True))
    least = F.broadcast(parents.agg(F.min(parent_key).alias("__least")))  # one row
    lost = F.col(child_key).isNotNull() & F.col("__known").isNull()
    rows = children.join(known, child_key, "left").crossJoin(least)
    return rows.select(*(F.when(lost, F.col("__least")).otherwise(F.col(c)).alias(c) if c == child_key else F.col(c) for c in children.columns), lost.alias("repaired"))


def parameter_value(default: Column, largest: Column, kind: str) -> Column:
    """What a routine is called with: the default, else the largest value of the matching column, else a value by type."""
    fallback = {"int": "1", "bigint": "1", "date": "2024-01-01", "string": "a", "boolean": "true"}.get(kind, "1")
    return F.coalesce(default.cast("string"), largest.cast("string"), F.lit(fallback))


def predicate_columns(sql: Column) -> Column:
    """alias.column, operator and literal of the comparisons in a statement, as text."""
    return F.regexp_extract_all(sql, F.lit(r"(\w+\.\w+\s*(?:=|<>|!=|<=|>=|<|>)\s*(?:'[^']*'|-?\d+(?:\.\d+)?))"), 1)


def chain_status(expected: Column, rows: Column, failed: Column) -> Column:
    """Status of a checked object: unsupported, failed, validated (rows as expected), partial (none) or skipped."""
    return F.when(expected.isNull(), "unsupported").when(failed, "failed").when(~expected, "skipped").when(rows > 0, "validated").otherwise("partial")


#: Words after a table's name that are no alias.
NO_ALIAS = frozenset("FROM ON WHERE JOIN INNER LEFT RIGHT FULL CROSS OUTER GROUP ORDER HAVING UNION SET AS WITH LIMIT USING NATURAL AND OR SELECT EXCEPT INTERSECT APPLY LATERAL".split())


def alias_map(sql: str) -> dict[str, str]:
    """Aliases (lower-case) of a statement's tables, and the tables' own bare names, with the tables' names; names that WITH gives are none."""
    bare = re.sub(r"--[^\n]*|/\*.*?\*/|'(?:[^']|'')*'", " ", sql, flags=re.S)
    given = {m[1].lower() for m in re.finditer(r"(?i)(?:\bwith|,)\s+(\w+)\s*(?:\([^()]*\)\s*)?as\s*\(", bare)}
    out: dict[str, str] = {}
    named = re.compile(r"(?i)\s*((?:[\[`\"]?\w+[\]`\"]?\.)*[\[`\"]?\w+[\]`\"]?)(?:\s+(?:as\s+)?(\w+))?")
    for start in re.finditer(r"(?i)\b(?:from|join)\b", bare):
        m = named.match(bare, start.end())
        while m:
            table = re.sub(r"[\[\]`\"]", "", m[1])
            if table.upper() in NO_ALIAS:
                break
            alias = m[2] if m[2] and m[2].upper() not in NO_ALIAS else None
            if table.lower() not in given:
                out[table.rpartition(".")[2].lower()] = table
                if alias:
                    out[alias.lower()] = table
            comma = re.compile(r"\s*,").match(bare, m.end() if alias or not m[2] else m.start(2))
            m = named.match(bare, comma.end()) if comma else None
    return out


def join_pairs(sql: str) -> list[tuple[str, str, str, str]]:
    """(table, column, table, column) of the equal signs between columns of different tables, by their aliases, in order and once each."""
    names = alias_map(sql)
    out = []
    for a, b, c, d in re.findall(r"(?<![\w.])\[?(\w+)\]?\.\[?(\w+)\]?\s*=\s*\[?(\w+)\]?\.\[?(\w+)\]?(?![\w.(])", re.sub(r"--[^\n]*|'(?:[^']|'')*'", " ", sql)):
        if a.lower() in names and c.lower() in names and a.lower() != c.lower():
            out.append((names[a.lower()], b, names[c.lower()], d))
    return list(dict.fromkeys(out))


def wanted(sql: str, columns: dict[str, list[str]] | None = None) -> list[tuple[str, str, str, str]]:
    """(table, column, operator, value) of what a statement asks of columns: comparisons with literals, the first value of IN, the lower end of BETWEEN, IS NOT
    NULL, LIKE, and COALESCE(column, ..) <> ''. Bare columns are looked for in columns, the columns of each table."""
    names, out = alias_map(sql), []
    text = re.sub(r"--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S)
    column = r"(?:\[?(\w+)\]?\.)?\[?([A-Za-z_]\w*)\]?"
    value = r"('(?:[^']|'')*'|-?\d+(?:\.\d+)?)"
    found = [
        *((m[1], m[2], m[3], m[4]) for m in re.finditer(rf"(?<![\w.']){column}\s*(=|<>|!=|<=|>=|<|>)\s*N?{value}", text)),
        *((m[1], m[2], "=", m[3]) for m in re.finditer(rf"(?i)(?<![\w.']){column}\s+in\s*\(\s*N?{value}", text)),
        *((m[1], m[2], "=", m[3]) for m in re.finditer(rf"(?i)(?<![\w.']){column}\s+between\s+N?{value}", text)),
        *((m[1], m[2], "LIKE", m[3]) for m in re.finditer(rf"(?i)(?<![\w.']){column}\s+like\s+N?{value}", text)),
        *((m[1], m[2], "NOT NULL", "") for m in re.finditer(rf"(?i)(?<![\w.']){column}\s+is\s+not\s+null", text)),
        *((m[1], m[2], "<>", m[3]) for m in re.finditer(rf"(?i)\b(?:coalesce|isnull|ifnull|nvl)\s*\(\s*{column}\s*,[^()]*\)\s*<>\s*N?{value}", text)),
    ]
    for alias, name, sign, literal in found:
        table = names.get((alias or "").lower())
        if not alias:
            table = next((t for t in dict.fromkeys(names.values()) if name.lower() in {c.lower() for c in (columns or {}).get(t, [])}), None)
        if table:
            out.append((table, name, sign, literal.strip("'").replace("''", "'") if literal.startswith("'") else literal))
    return list(dict.fromkeys(out))


def solution(sql: str, tables: dict[str, DataFrame], seed_value: int = 1) -> tuple[dict[tuple[str, str], str | None], list[str]]:
    """Values (as text) by table and column for which the comparisons of a statement hold together, and the columns for which there are none."""
    columns = {t: {f.name.lower(): f.dataType.simpleString() for f in df.schema} for t, df in tables.items()}
    by_name = {n.lower(): n for n in tables}
    resolve = lambda t: by_name.get(t.lower()) or by_name.get(t.rpartition(".")[2].lower())
    names = {alias: r for alias, t in alias_map(sql).items() if (r := resolve(t))}

    def place(alias: str, column: str) -> tuple[str, str] | None:
        t = names.get(alias) if alias else next((t for t in dict.fromkeys(names.values()) if column in columns[t]), None)
        return (t, column) if t and column in columns[t] else None

    ways = [[(c, w) for w in way if (c := place(w.alias, w.column))] for way in conditions(sql)]
    pairs = [((t, b.lower()), (u, d.lower())) for a, b, c, d in join_pairs(sql) if (t := resolve(a)) and (u := resolve(c)) and b.lower() in columns[t] and d.lower() in columns[u]]
    return solved(ways, {(t, c): kind for t, held in columns.items() for c, kind in held.items()}, pairs, seed_value)


def witness_rows(spark: SparkSession, sql: str, tables: dict[str, DataFrame], seed_value: int = 1) -> dict[str, DataFrame]:
    """Tables of a statement with one row more each, so that the statement has a row to return: values that meet all its comparisons together, one for
    columns that its joins set equal, other columns by type. Comparisons that no value meets raise ValueError with their columns; what can't be met
    by one row a table (other comparisons between columns, aggregates over many rows) stays unmet, which the caller sees as an empty result."""
    own, clashes = solution(sql, tables, seed_value)
    if clashes:
        raise ValueError(f"contradictory: {', '.join(clashes)}")
    out = {}
    for t, df in tables.items():
        row = []
        for f in df.schema:
            kind = f.dataType.simpleString()
            value = F.lit(own[t, f.name.lower()]).try_cast(kind) if (t, f.name.lower()) in own else value_of(F.lit(seed_value), kind, f.name).cast(kind)
            row.append(value.alias(f.name))
        out[t] = df.unionByName(spark.range(1).select(*row))
    return out


def prerequisites(body: Column) -> Column:
    """Tables that a routine looks for rows in before it works (IF NOT EXISTS (SELECT .. FROM t), status and log tables), lower-case and sorted."""
    asked = F.regexp_extract_all(F.lower(body), F.lit(r"if\s+not\s+exists\s*\(\s*select\b.*?\bfrom\s+([\w.\[\]]+)"), 1)
    logs = F.regexp_extract_all(F.lower(body), F.lit(r"\b(?:from|update|into)\s+((?:\w+\.)?\w*(?:status|log|staging)\w*)"), 1)
    return F.array_sort(F.array_distinct(F.transform(F.concat(asked, logs), lambda x: F.regexp_replace(x, r"[\[\]]", ""))))


def joined_rows(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """One row: joined (rows that a join gives) and orphans (rows of left whose key no row of right has)."""
    counts = right.groupBy(F.col(right_key).alias("__k")).agg(F.count("*").alias("__n"))
    rows = left.select(F.col(left_key).alias("__k")).groupBy("__k").agg(F.count("*").alias("__m")).join(counts, "__k", "left")
    return rows.agg(F.coalesce(F.sum(F.col("__m") * F.col("__n")), F.lit(0)).alias("joined"), F.coalesce(F.sum(F.when(F.col("__n").isNull() & F.col("__k").isNotNull(), F.col("__m"))), F.lit(0)).alias("orphans"))


def last_identity(written: DataFrame, column: str) -> DataFrame:
    """identity: the largest number among the rows that were written, which a session's last identity is."""
    return written.agg(F.max(column).alias("identity"))


def rows_affected(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """One row: inserted, deleted and updated rows between two states of a table, by its key."""
    mark = lambda df, n: df.select(F.col(key), F.xxhash64(*df.columns).alias(n))
    both = mark(before, "__a").join(mark(after, "__b"), key, "full_outer")
    a, b = F.col("__a"), F.col("__b")
    return both.agg(F.count_if(a.isNull()).alias("inserted"), F.count_if(b.isNull()).alias("deleted"), F.count_if(a.isNotNull() & b.isNotNull() & (a != b)).alias("updated"))


def copy_order(tables: list[str], references: list[tuple[str, str]]) -> list[str]:
    """Tables so that each comes after those that it refers to, by levels and then by name; members of cycles come last."""
    needs = {t: {b for a, b in references if a == t and b in tables and b != t} for t in tables}
    out: list[str] = []
    while needs:
        ready = sorted(t for t, n in needs.items() if not n - set(out))
        if not ready:
            return out + sorted(needs)
        out += ready
        needs = {t: n for t, n in needs.items() if t not in ready}
    return out


def load_files(frames: dict[str, DataFrame], references: list[tuple[str, str]], write: Callable[[str, DataFrame], object]) -> list[str]:
    """Loads tables in the order of their references, each in place of what was there, so that a load that is run again gives the same; returns the order."""
    order = copy_order(list(frames), references)
    for t in order:
        write(t, frames[t])
    return order
