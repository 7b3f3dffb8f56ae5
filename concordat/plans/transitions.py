"""Statements that write, as transitions of tables: INSERT, UPDATE, DELETE and MERGE become joins that give a table's next state.

A state is a durable table, so a transaction that is rolled back is the state of before, and a routine that writes runs on copies of nothing: the
tables that it was given stay as they are. Two routines are compared by what they leave behind and how many rows each step took.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.operators.durable import durable
from concordat.operators.parity import digest_parity
from concordat.operators.ranks import numbered
from concordat.operators.witness import alias_map

from .repairs import outside_quotes
from .rewriter import Token, arguments, cast_type, step, text_of, to_spark, tokens
from .scripts import HEAD, MARKERS, Body, declarations, expression, literal, markers, names
from .routines import parameters

#: Words with which a statement that writes begins.
WRITES = ("INSERT", "UPDATE", "DELETE", "MERGE", "TRUNCATE")
#: What still needs a hand in a routine that writes.
HARD = {"CURSOR", "DYNAMIC_SQL", "BULK_COLLECT", "CONNECT_BY", "ANCHORED_TYPE"}
#: The variable that holds how many rows the last write took.
TAKEN = "rows_taken"
PLAIN = re.compile(r"[\[\]`\"]")


def sections(sql: str, *words: str) -> list[tuple[str, str]]:
    """The parts of a statement that these words begin, outside of parentheses and CASE: (word, text behind it); what stands before the first has an empty word."""
    out, depth, cases = [("", [])], 0, 0
    for t in tokens(sql):
        depth += (t.text == "(") - (t.text == ")")
        if not depth and not cases and t.word in words and t.kind == "word":
            out.append((t.word, []))
            continue
        cases += (t.word == "CASE") - (t.word == "END" and cases > 0)
        out[-1][1].append(t)
    return [(w, text_of(held).strip()) for w, held in out]


def listed(sql: str) -> list[str]:
    """Items between commas outside of parentheses."""
    held = [Token("mark", "("), *tokens(sql), Token("mark", ")")]
    return [text_of(a).strip() for a in arguments(held, 0, len(held) - 1)]


def bare(name: str) -> str:
    return PLAIN.sub("", name.strip()).rpartition(".")[2].lower()


def inner(text: str) -> str:
    """What stands in the parentheses around a text."""
    return text.strip()[1:-1]


def assignments(sql: str) -> list[tuple[str, str]]:
    """(column, expression) of the items of SET; a += b is a = a + b."""
    out = []
    for item in listed(sql):
        m = re.match(r"(?s)^([\w.\[\]`\"]+)\s*([-+*/]?)=(.*)$", item)
        if not m or m[1].startswith("@"):
            raise ValueError(f"needs a hand: SET {item[:60]}")
        out.append((bare(m[1]), f"{m[1]} {m[2]} ({m[3].strip()})" if m[2] else m[3].strip()))
    return out


def named(text: str) -> tuple[str, str]:
    """A table or subquery in parentheses, and its alias (its bare name without one)."""
    m = re.match(r"(?is)^(\(.*\)|[\w.\[\]`\"#@]+)(?:\s+(?:as\s+)?([\w\[\]`\"]+))?\s*(?:with\s*\([^()]*\))?$", text.strip())
    if not m:
        raise ValueError(f"needs a hand: {text[:60]}")
    return m[1], bare(m[2]) if m[2] else bare(m[1])


@dataclass
class Tables:
    """The tables of a script by their bare names (lower-case). Reads see the state after the last write.

    defaults has expressions for columns that an INSERT leaves out, by table and column (else null); identities the column of a table whose
    numbers go on from the largest there is. taken lists what each write did: step, table and how many rows were inserted, updated and deleted.
    """

    spark: SparkSession
    source: str
    frames: dict[str, DataFrame]
    defaults: dict[str, dict[str, str]] = field(default_factory=dict)
    identities: dict[str, str] = field(default_factory=dict)
    taken: list[tuple[int, str, int, int, int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        for name in list(self.frames):
            self.put(name.lower(), self.frames.pop(name))

    def put(self, name: str, df: DataFrame) -> None:
        self.frames[name] = df
        df.drop("__row").createOrReplaceTempView(name)

    def columns(self, name: str) -> list[str]:
        return [c for c in self.frames[name].columns if c != "__row"]

    def kinds(self, name: str) -> dict[str, str]:
        return {f.name.lower(): f.dataType.simpleString() for f in self.frames[name].schema}

    def expression(self, sql: str) -> str:
        return expression(sql, self.source)

    def table(self, name: str) -> str:
        found = bare(name)
        if found not in self.frames:
            raise ValueError(f"no table {found}")
        return found

    def with_rows(self, name: str) -> str:
        """A view of a table with a number for each row that later reads agree on."""
        df = self.frames[name]
        if "__row" not in df.columns:
            df = durable(df.withColumn("__row", F.monotonically_increasing_id()), name)
            self.put(name, df)
        df.createOrReplaceTempView(f"__rows_of_{name}")
        return f"__rows_of_{name}"

    def write(self, sql: str) -> int:
        """Runs a statement that writes; how many rows it took."""
        first = tokens(sql)[step(tokens(sql), 0)].word
        makers: dict[str, Callable[[str], tuple[str, DataFrame]]] = {"INSERT": self.inserted, "UPDATE": self.updated, "DELETE": self.deleted, "MERGE": self.merged, "TRUNCATE": self.truncated}
        if first not in makers:
            raise ValueError(f"not a statement that writes: {sql[:60]}")
        name, made = makers[first](sql.strip().rstrip(";"))
        result = durable(made.withColumn("__row", F.monotonically_increasing_id()), name)
        counts = {r["__what"]: r["n"] for r in result.groupBy("__what").agg(F.count("*").alias("n")).collect()}  # five kinds
        state = result.where("__what IN ('kept', 'inserted', 'updated')")
        if "__old" in result.columns:
            took = result.where("__what IN ('updated', 'deleted')").select("__old")
            if took.groupBy("__old").count().where("count > 1").limit(1).count():
                raise ValueError(f"a row of {name} meets several rows of the source")
            if counts.get("met"):  # matched, but nothing was asked for: once each, unless another match took the row
                state = state.unionByName(result.where("__what = 'met'").dropDuplicates(["__old"]).join(took, "__old", "left_anti").select(*result.columns))
        self.put(name, state.select(*self.columns(name), "__row"))
        done = [counts.get(k, 0) for k in ("inserted", "updated", "deleted")]
        self.taken.append((len(self.taken) + 1, name, *done))
        return sum(done)

    def picked(self, name: str, values: dict[str, str], otherwise: Callable[[str], str]) -> str:
        """The columns of a table, with expressions (by lower-case name) cast to their types in place of what otherwise says."""
        unknown = set(values) - {c.lower() for c in self.columns(name)}
        if unknown:
            raise ValueError(f"{name} has no column {', '.join(sorted(unknown))}")
        kinds = self.kinds(name)
        return ", ".join(f"CAST({values[c.lower()]} AS {kinds[c.lower()]}) AS `{c}`" if c.lower() in values else f"{otherwise(c)} AS `{c}`" for c in self.columns(name))

    def truncated(self, sql: str) -> tuple[str, DataFrame]:
        name = self.table(re.match(r"(?is)^truncate\s+(?:table\s+)?([\w.\[\]`\"#]+)", sql)[1])
        return name, self.frames[name].drop("__row").withColumn("__what", F.lit("deleted"))

    def inserted(self, sql: str) -> tuple[str, DataFrame]:
        m = re.match(r"(?is)^insert\s+(?:into\s+)?([\w.\[\]`\"#]+)\s*(\((?!\s*select\b)[^()]*\))?\s*(.*)$", sql)
        name = self.table(m[1])
        wanted = [bare(c) for c in listed(inner(m[2]))] if m[2] else [c.lower() for c in self.columns(name) if c != self.identities.get(name)]
        text = m[3].strip()
        if re.match(r"(?i)output\b|exec\b|default\s+values\b|set\b", text):
            raise ValueError(f"needs a hand: {text[:60]}")
        if rows := re.match(r"(?is)^values?\s*(\(.*)$", text):
            text = " UNION ALL ".join(f"SELECT {', '.join(f'({self.expression(v)})' for v in listed(inner(row)))}" for row in listed(rows[1]))
        else:
            text = names(to_spark(text, self.source))
        query = self.spark.sql(text)
        if len(query.columns) != len(wanted):
            raise ValueError(f"{len(query.columns)} values for {len(wanted)} columns of {name}")
        query.toDF(*(f"__v{i}" for i in range(len(wanted)))).createOrReplaceTempView("__inserted")
        identity, given = self.identities.get(name), self.defaults.get(name, {})
        values = {c: f"__v{i}" for i, c in enumerate(wanted)} | {c.lower(): self.expression(e) for c, e in given.items() if c.lower() not in wanted}
        new = self.spark.sql(f"SELECT {self.picked(name, values, lambda c: f'CAST(NULL AS {self.kinds(name)[c.lower()]})')} FROM __inserted")
        if identity and identity.lower() not in wanted:
            new = numbered(durable(new.withColumn("__at", F.monotonically_increasing_id()), name), F.col("__at"), place="__place")
            most = F.broadcast(self.frames[name].agg(F.coalesce(F.max(identity), F.lit(0)).alias("__most")))  # one row
            new = new.crossJoin(most).withColumn(identity, (F.col("__most") + F.col("__place")).cast(self.kinds(name)[identity.lower()])).select(*self.columns(name))
        old = self.frames[name].drop("__row").withColumn("__what", F.lit("kept"))
        return name, old.unionByName(new.withColumn("__what", F.lit("inserted")))

    def target(self, text: str, tables: str) -> tuple[str, str, str]:
        """The table that a statement with joins writes, its alias, and the tables it reads (Spark SQL) with that one's rows numbered."""
        known = {k: bare(v) for k, v in alias_map(f"FROM {tables}").items()}
        found = bare(text)
        name = self.table(known.get(found, found))
        alias = found if found in known and (found != name or name in known) else next((a for a, t in known.items() if t == name and a != name), found)
        read = tokens(names(to_spark(f"SELECT 1 FROM {tables}", self.source))[len("SELECT 1 FROM ") :])
        view, depth = self.with_rows(name), 0
        for k, t in enumerate(read):
            depth += (t.text == "(") - (t.text == ")")
            if not depth and t.kind in ("word", "tick") and bare(t.text) == name:
                after = step(read, k + 1)
                after = step(read, after + 1) if after < len(read) and read[after].word == "AS" else after
                own = after < len(read) and read[after].kind in ("word", "tick") and bare(read[after].text) == alias
                if own or alias == name:
                    read[k] = Token("made", view if own else f"{view} AS {alias}")
                    return name, alias, text_of(read)
        raise ValueError(f"{name} isn't among the tables read")

    def updated(self, sql: str) -> tuple[str, DataFrame]:
        """Where several rows of other tables meet a row, the least of what they would set counts."""
        parts = dict(sections(sql, "UPDATE", "SET", "FROM", "WHERE", "OUTPUT"))
        if "OUTPUT" in parts or re.match(r"(?i)top\b", parts["UPDATE"]):
            raise ValueError(f"needs a hand: {sql[:60]}")
        values = dict(assignments(parts["SET"]))
        where = self.expression(parts["WHERE"]) if parts.get("WHERE") else "true"
        joined = parts.get("FROM") or (parts["UPDATE"] if re.search(r"(?i)\bjoin\b|,", parts["UPDATE"]) else "")
        if not joined:
            text, alias = named(parts["UPDATE"])
            name = self.table(text)
            made = {c: self.expression(e) for c, e in values.items()}
            own = {c: f"CASE WHEN {alias}.__hit THEN {e} ELSE {alias}.`{c}` END" for c, e in made.items()}
            hits = f"(SELECT {alias}.*, coalesce({where}, false) AS __hit FROM {name} AS {alias}) AS {alias}"
            return name, self.spark.sql(f"SELECT {self.picked(name, own, lambda c: f'{alias}.`{c}`')}, CASE WHEN {alias}.__hit THEN 'updated' ELSE 'kept' END AS __what FROM {hits}")
        first = re.match(r"[\w.\[\]`\"]+", parts["UPDATE"])[0] if parts.get("FROM") else named(re.split(r"(?i),|\b(?:inner|left|right|cross|join)\b", parts["UPDATE"])[0])[1]
        name, alias, read = self.target(first, joined)
        kinds = self.kinds(name)
        made = ", ".join(f"CAST({self.expression(e)} AS {kinds[c]}) AS `{c}`" for c, e in values.items())
        found = self.spark.sql(f"SELECT {alias}.__row, struct({made}) AS __new FROM {read} WHERE {where}").where("__row IS NOT NULL").groupBy("__row").agg(F.min("__new").alias("__new"))
        hit = F.col("__new").isNotNull()
        rows = self.frames[name].join(found, "__row", "left")
        columns = [F.when(hit, F.col("__new")[c.lower()]).otherwise(F.col(c)).alias(c) if c.lower() in values else F.col(c) for c in self.columns(name)]
        return name, rows.select(*columns, F.when(hit, "updated").otherwise("kept").alias("__what"))

    def deleted(self, sql: str) -> tuple[str, DataFrame]:
        parts = sections(sql, "DELETE", "FROM", "USING", "WHERE", "OUTPUT")
        held = dict(parts)
        if "OUTPUT" in held or re.match(r"(?i)top\b", held["DELETE"]):
            raise ValueError(f"needs a hand: {sql[:60]}")
        where = self.expression(held["WHERE"]) if held.get("WHERE") else "true"
        froms = [t for w, t in parts if w == "FROM"]
        if held.get("USING"):
            first, joined = named(re.split(r"(?i),", froms[0])[0])[1], held["USING"]
        elif len(froms) == 2:
            first, joined = froms
        else:
            first, joined = (held["DELETE"], froms[0]) if held["DELETE"] and froms else ("", "")
        if not joined or not re.search(r"(?i)\bjoin\b|,", joined) and first and bare(first) == named(joined)[1]:
            text, alias = named(joined or (froms[0] if froms else held["DELETE"]))
            name = self.table(text)
            return name, self.spark.sql(f"SELECT {alias}.*, CASE WHEN coalesce({where}, false) THEN 'deleted' ELSE 'kept' END AS __what FROM {name} AS {alias}")
        name, _, read = self.target(first, joined)
        alias = next(a for a in (bare(first), name) if re.search(rf"(?i)\b{a}\b", read))
        found = self.spark.sql(f"SELECT DISTINCT {alias}.__row, true AS __hit FROM {read} WHERE {where}").where("__row IS NOT NULL")
        rows = self.frames[name].join(found, "__row", "left")
        return name, rows.select(*self.columns(name), F.when(F.col("__hit"), "deleted").otherwise("kept").alias("__what"))

    def merged(self, sql: str) -> tuple[str, DataFrame]:
        """The clauses of a MERGE in their order; a row that two rows of the source would change raises when it is written."""
        parts = sections(sql, "MERGE", "INTO", "USING", "ON", "WHEN", "OUTPUT")
        held = dict(parts)
        if held.get("OUTPUT"):
            raise ValueError(f"needs a hand: OUTPUT {held['OUTPUT'][:60]}")
        text, a = named(held.get("INTO") or held["MERGE"])
        name = self.table(text)
        other, b = named(held["USING"])
        on, kinds = self.expression(inner(held["ON"]) if held["ON"].startswith("(") and text_of(tokens(held["ON"])).endswith(")") and len(listed(held["ON"])) == 1 and balanced(inner(held["ON"])) else held["ON"]), self.kinds(name)
        clauses: list[tuple[str, str, dict[str, str]]] = []
        for clause in (t for w, t in parts if w == "WHEN"):
            (_, head), (_, act) = sections(clause, "THEN")
            m = re.match(r"(?is)^(not\s+)?matched(?:\s+by\s+(target|source))?(?:\s+and\s+(.*))?$", head)
            sides = f"{b}.__there IS NULL" if m[2] and m[2].lower() == "source" else f"{a}.__row IS NULL" if m[1] else f"{a}.__row IS NOT NULL AND {b}.__there"
            steps = dict(sections(act, "UPDATE", "SET", "DELETE", "INSERT", "VALUES", "WHERE"))
            if "UPDATE" in steps and "DELETE" in steps:
                raise ValueError("needs a hand: UPDATE and DELETE in one clause")
            more = [self.expression(x) for x in (m[3], steps.get("WHERE")) if x]
            test = " AND ".join([sides, *(f"({x})" for x in more)])
            if "SET" in steps:
                clauses.append((test, "updated", {c: self.expression(e) for c, e in assignments(steps["SET"])}))
            elif "INSERT" in steps:
                given = [bare(c) for c in listed(inner(steps["INSERT"]))] if steps["INSERT"] else [c.lower() for c in self.columns(name)]
                made = [self.expression(v) for v in listed(inner(steps["VALUES"]))]
                clauses.append((test, "inserted", dict(zip(given, made, strict=True)) | {c.lower(): self.expression(e) for c, e in self.defaults.get(name, {}).items() if c.lower() not in given}))
            else:
                clauses.append((test, "deleted", {}))

        def chosen(c: str) -> str:
            cases = [f"WHEN {test} THEN CAST({values[c.lower()]} AS {kinds[c.lower()]})" if c.lower() in values else f"WHEN {test} THEN NULL" if what == "inserted" else f"WHEN {test} THEN {a}.`{c}`" for test, what, values in clauses]
            return f"CASE {' '.join(cases)} ELSE {a}.`{c}` END AS `{c}`"

        unknown = {c for _, _, v in clauses for c in v} - {c.lower() for c in self.columns(name)}
        if unknown:
            raise ValueError(f"{name} has no column {', '.join(sorted(unknown))}")
        what = f"CASE {' '.join(f"WHEN {test} THEN '{k}'" for test, k, _ in clauses)} WHEN {a}.__row IS NULL THEN 'none' WHEN {b}.__there THEN 'met' ELSE 'kept' END AS __what"
        rows = names(to_spark(inner(other), self.source)) if other.startswith("(") else f"SELECT * FROM {bare(other)}"
        join = "FULL OUTER" if any(k == "inserted" for _, k, _ in clauses) else "LEFT"
        return name, self.spark.sql(f"SELECT {', '.join(map(chosen, self.columns(name)))}, {a}.__row AS __old, {what} FROM {self.with_rows(name)} AS {a} {join} JOIN (SELECT *, true AS __there FROM ({rows})) AS {b} ON {on}").where("__what <> 'none'")


def balanced(text: str) -> bool:
    depth = 0
    for t in tokens(text):
        depth += (t.text == "(") - (t.text == ")")
        if depth < 0:
            return False
    return not depth


class Steps(Body):
    """Statements of a routine that writes: as Body has them, with writes, transactions, guarded blocks and tables of the routine as steps of their own."""

    STARTS = (*Body.STARTS, "COMMIT", "ROLLBACK", "SIGNAL", "RAISE")

    def __init__(self, sql: str, source: str) -> None:
        super().__init__(sql, source)
        self.writes: list[str] = []

    def guarded(self) -> list[str]:
        """BEGIN TRY .. END TRY BEGIN CATCH .. END CATCH."""
        self.skip(2)
        tried = self.block("END")
        self.skip(2)
        while self.word() == ";":
            self.skip()
        self.skip(2)
        caught = self.block("END")
        self.skip(2)
        return ["TRY", *tried, "CATCH", *caught, "END TRY"]

    def statement(self) -> list[str]:
        first, second = self.word(), self.word(1)
        if first == "BEGIN" and second == "TRY":
            return self.guarded()
        if (first, second) in (("BEGIN", "TRAN"), ("BEGIN", "TRANSACTION"), ("START", "TRANSACTION")) or first in ("COMMIT", "ROLLBACK"):
            self.simple()
            return [first if first in ("COMMIT", "ROLLBACK") else "START"]
        if first in ("THROW", "RAISERROR", "SIGNAL", "RAISE"):
            self.writes.append(self.simple())
            quiet = re.search(r",\s*(\d+)\s*,\s*\d+\s*\)?\s*$", self.writes[-1]) if first == "RAISERROR" else None
            return [] if quiet and int(quiet[1]) <= 10 else [f"ERROR {len(self.writes) - 1}"]
        if first == "DECLARE" and second in ("EXIT", "CONTINUE"):
            self.skip(5 if self.word(4) != "BEGIN" and self.word(3) == "FOR" else 4)
            return ["HANDLER", *self.one(), "END HANDLER"]
        if first in WRITES:
            self.writes.append(self.simple())
            return [f"WRITE {len(self.writes) - 1}"]
        if first == "CREATE" and second == "TABLE" or first == "DECLARE" and self.word(2) == "TABLE":
            text = re.sub(r"(?is)^declare\s+@?(\w+)\s+table", r"create table \1", self.simple())
            m = re.match(r"(?is)^create\s+table\s+([\w.\[\]#`\"]+)\s*\((.*)\)\s*$", text)
            columns = [re.match(r"(?is)^[\[`\"]?(\w+)[\]`\"]?\s+([\w]+(?:\s*\([\w\s,]+\))?)", c) for c in listed(m[2])]
            self.writes.append(f"{bare(m[1])}|" + ", ".join(f"`{c[1]}` {cast_type(c[2])}" for c in columns if c and c[1].upper() not in ("PRIMARY", "CONSTRAINT", "UNIQUE", "FOREIGN", "CHECK", "INDEX", "KEY")))
            return [f"TABLE {len(self.writes) - 1}"]
        if first == "DROP" and second == "TABLE":
            self.simple()
            return []
        if first == "SELECT" and self.source == "mssql":
            at = self.at
            text = self.simple()
            if m := re.match(r"(?is)^(select\b.*?)\s+into\s+([\w#\[\].]+)\s+(from\b.*)$", text):
                self.writes.append(f"{bare(m[2])}|{m[1]} {m[3]}")
                return [f"FILL {len(self.writes) - 1}"]
            self.at = at
        return super().statement()


def prepared(sql: str, source: str) -> tuple[list[tuple[str, str, str | None]], list[str], Steps]:
    """A routine's parameters, its declarations and steps, and what holds their writes."""
    hard = [c for c in markers(sql) if c in HARD]
    if hard:
        raise ValueError(f"needs a hand: {', '.join(hard)}")
    sql = outside_quotes(sql, [(r"@@rowcount\b|\brow_count\s*\(\s*\)|\bsql%rowcount\b", TAKEN), (r"(?<![\w])#(\w+)", r"tmp_\1")])
    m = HEAD[source].match(sql.strip().rstrip("/").strip())
    if not m:
        raise ValueError("not a procedure")
    text = (m["params"] or "").strip()
    text = inner(text) if source == "mssql" and text.startswith("(") else text
    text = re.sub(r"(?i)(\w+)\s+in\s+", r"\1 ", re.sub(r"(?i)(^|,)\s*(?:in|out|inout)\s+", r"\1 ", re.sub(r"(?i)\s+(?:output|out|readonly)\b", "", text)))
    body, declared = m["body"].strip(), []
    if source == "oracle":
        head, body = re.match(r"(?is)^(.*?)\bbegin\b(.*)$", body).groups()
        declared = [f"DECLARE {x[1].lower()} {cast_type(x[2])} DEFAULT {expression(x[3], source) if x[3] else 'NULL'}" for x in re.finditer(r"(?is)(\w+)\s+([\w]+(?:\s*\([\d, ]+\))?)\s*(?::=\s*([^;]*?))?\s*;", head)]
        body = re.sub(r"(?is)\bend\b\s*\w*\s*;?\s*$", "", body)
        tried, caught = [*[t for _, t in sections(body, "EXCEPTION")], ""][:2]
        steps = Steps(tried, source)
        lines = steps.block()
        if caught:
            other = Steps(re.sub(r"(?is)^\s*when\s+\w+\s+then\b", "", caught), source)
            other.writes = steps.writes
            lines = ["TRY", *lines, "CATCH", *other.block(), "END TRY"]
    else:
        steps = Steps(re.sub(r"(?is)^\s*begin\b(?!\s+(?:try|tran))(.*)\bend\b\s*[`\w]*\s*;?\s*$", r"\1", body), source)
        lines = steps.block()
        if "HANDLER" in lines:
            a, b = lines.index("HANDLER"), lines.index("END HANDLER")
            lines = ["TRY", *lines[:a], *lines[b + 1 :], "CATCH", *lines[a + 1 : b], "END TRY"]
    return (parameters(text) if text else []), [*declared, *steps.declared, *lines], steps


def ending(lines: list[str], at: int, opens: tuple[str, ...], *stops: str) -> int:
    """Where one of stops stands at the level of a place."""
    depth = 0
    for k in range(at, len(lines)):
        if not depth and (lines[k] in stops or any(s.endswith(" ") and lines[k].startswith(s) for s in stops)):
            return k
        depth += any(lines[k].startswith(o) for o in opens) - (lines[k] in ("END IF", "END WHILE", "END TRY"))
    raise ValueError(f"no {stops[0]}")


OPENS = ("IF ", "WHILE ", "TRY")


@dataclass
class Run:
    """A routine under way: tables, the state before an open transaction, the last result, and the error that is being handled."""

    tables: Tables
    steps: Steps
    before: dict[str, DataFrame] | None = None
    rows: DataFrame | None = None
    error: Exception | None = None

    def ask(self, condition: str) -> bool:
        return bool(self.tables.spark.sql(f"SELECT coalesce({condition}, false)").first()[0])

    def lines(self, lines: list[str]) -> None:
        spark, at = self.tables.spark, 0
        while at < len(lines):
            line = lines[at]
            if line.startswith("IF "):
                end = ending(lines, at + 1, OPENS, "END IF")
                test, start, done = line, at + 1, False
                while True:
                    stop = min(ending(lines, start, OPENS, "ELSEIF ", "ELSE", "END IF"), end)
                    if not done and (test == "ELSE" or self.ask(re.sub(r"^(?:ELSE)?IF (.*) THEN$", r"\1", test, flags=re.S))):
                        self.lines(lines[start:stop])
                        done = True
                    if stop == end:
                        break
                    test, start = lines[stop], stop + 1
                at = end
            elif line.startswith("WHILE "):
                end = ending(lines, at + 1, OPENS, "END WHILE")
                while self.ask(re.sub(r"^WHILE (.*) DO$", r"\1", line, flags=re.S)):
                    self.lines(lines[at + 1 : end])
                at = end
            elif line == "TRY":
                middle = ending(lines, at + 1, OPENS, "CATCH")
                end = ending(lines, middle + 1, OPENS, "END TRY")
                try:
                    self.lines(lines[at + 1 : middle])
                except Exception as e:  # noqa: BLE001  whatever a statement raises, the block behind it is for that
                    outer, self.error = self.error, e
                    self.lines(lines[middle + 1 : end])
                    self.error = outer
                at = end
            elif line == "START":
                self.before = self.before or dict(self.tables.frames)
            elif line in ("COMMIT", "ROLLBACK"):
                if line == "ROLLBACK" and self.before is not None:
                    for name, df in self.before.items():
                        self.tables.put(name, df)
                self.before = None
            elif m := re.match(r"(WRITE|TABLE|FILL|ERROR) (\d+)$", line):
                text = self.steps.writes[int(m[2])]
                if m[1] == "ERROR":
                    raise self.error or ValueError(text)
                if m[1] == "WRITE":
                    spark.sql(f"SET VAR {TAKEN} = {self.tables.write(text)}")
                else:
                    name, _, rest = text.partition("|")
                    self.tables.put(name, spark.createDataFrame([], rest) if m[1] == "TABLE" else durable(spark.sql(names(to_spark(rest, self.tables.source))), name))
            elif m := re.match(r"(?is)^DECLARE (\w+) (.*?) DEFAULT (.*)$", line):
                spark.sql(f"DECLARE OR REPLACE VARIABLE {m[1]} {m[2]} DEFAULT {m[3]}")
            elif m := re.match(r"(?is)^SET (\w+) = (.*)$", line):
                spark.sql(f"SET VAR {m[1]} = {m[2]}")
            else:
                self.rows = spark.sql(line)
            at += 1


def run_routine(tables: Tables, sql: str, arguments: dict[str, object] | None = None) -> DataFrame | None:
    """Runs a procedure that writes, on tables: these hold the next states afterwards, and what each write took; returns the rows of its last query.

    Variables are session variables, conditions are asked of Spark, each write is a transition. ROLLBACK gives back the states at the start of the
    transaction; a guarded block hands on to the one behind it whatever raises. Cursors and dynamic statements raise ValueError, as does a
    statement that has no transition.
    """
    params, lines, steps = prepared(sql, tables.source)
    given = {k.lower().lstrip("@"): v for k, v in (arguments or {}).items()}
    unknown = set(given) - {n for n, _, _ in params}
    if unknown:
        raise ValueError(f"no parameter {', '.join(sorted(unknown))}")
    spark = tables.spark
    spark.sql(f"DECLARE OR REPLACE VARIABLE {TAKEN} BIGINT DEFAULT 0")
    for n, kind, default in params:
        value = literal(given[n]) if n in given else expression(default, tables.source) if default else "NULL"
        spark.sql(f"DECLARE OR REPLACE VARIABLE {n} {kind} DEFAULT {value}")
    run = Run(tables, steps)
    run.lines(lines)
    return run.rows


def compare_routines(make: Callable[[str], Tables], routine: tuple[str, str], counterpart: tuple[str, str], arguments: dict[str, object], names_of: dict[str, str] | None = None) -> list[tuple[str, str, str]]:
    """(table, verdict, error) for what a routine and its counterpart, each (statement, dialect), leave behind on equal tables, which make gives for
    a dialect. arguments are the routine's; names_of tells where the counterpart's are named otherwise. PASS_WRITE_PROC if both took as many rows
    in all and left equal rows; else what differs. If one raises, one row says which; WRITE_EXPECTED_FAIL if both do."""
    done, errors = [], []
    for (sql, source), known in ((routine, {}), (counterpart, names_of or {})):
        tables = make(source)
        try:
            run_routine(tables, sql, {known.get(k, k): v for k, v in arguments.items()})
            errors.append("")
        except Exception as e:  # noqa: BLE001  a routine's error is part of the verdict
            errors.append(str(e).splitlines()[0][:200])
        done.append(tables)
    if any(errors):
        return [("", "WRITE_EXPECTED_FAIL" if all(errors) else "FAIL_SOURCE" if errors[0] else "FAIL_TARGET", errors[0] or errors[1])]
    out = []
    for name in sorted({t[1] for tables in done for t in tables.taken} & set(done[0].frames) & set(done[1].frames)):
        left, right = (tables.frames[name].drop("__row") for tables in done)
        (row,) = digest_parity(left, right.select(*left.columns)).select("verdict").collect()
        out.append((name, "PASS_WRITE_PROC" if row["verdict"] == "PASS" else row["verdict"], ""))
    return out
