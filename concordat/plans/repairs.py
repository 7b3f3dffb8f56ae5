"""Repairs of statements by rules: applied until a statement runs, within guards."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import SparkSession

from .rewriter import text_of, to_spark, tokens

HEAD = re.compile(r"(?is)^\s*create\s+(?:or\s+replace\s+)?(?:temporary\s+)?(view|function|procedure|table)\s+(?:if\s+not\s+exists\s+)?([\w.`\[\]\"]+)")


def head(sql: str) -> tuple[str, str]:
    m = HEAD.match(sql)
    return (m[1].lower(), re.sub(r"[`\[\]\"]", "", m[2]).rpartition(".")[2].lower()) if m else ("", "")


def repaired(sql: str, rules: list[tuple[str, str]], run: Callable[[str], object], rounds: int = 2) -> tuple[str, str, str]:
    """(status, statement, error): succeeded as it was, fixed by rules, or failed. Each round applies all rules (pattern, replacement) outside of quotes; what
    changes the statement's kind or name is not taken, and at most rounds are made."""
    error = ""
    for k in range(rounds + 1):
        try:
            run(sql)
            return ("fixed" if k else "succeeded"), sql, ""
        except Exception as e:  # noqa: BLE001  whatever a statement raises is its result
            error = str(e).splitlines()[0][:200]
        made = outside_quotes(sql, rules)
        if made == sql or head(made) != head(sql):
            return "failed", sql, error
        sql = made
    return "failed", sql, error


def outside_quotes(sql: str, rules: list[tuple[str, str]]) -> str:
    """A statement after rules, with texts and comments as they were."""
    held = tokens(sql)
    kept: list[str] = []
    for t in held:
        if t.kind == "text" or t.kind == "space" and t.text.strip():
            kept.append(t.text)
            t.text = f"\x00{len(kept) - 1}\x00"
    text = text_of(held)
    for pattern, replacement in rules:
        text = re.sub(f"(?i){pattern}", replacement, text)
    return re.sub("\x00(\\d+)\x00", lambda m: kept[int(m[1])], text)


TRIGGER = re.compile(r"(?is)^\s*create\s+(?:or\s+(?:alter|replace)\s+)?trigger\s+([\w.\[\]`]+)\s+(?:(?:on\s+([\w.\[\]`]+)\s+)?(?:after|for|before|instead\s+of)\s+([\w, ]+?))(?:\s+on\s+([\w.\[\]`]+))?\s+(?:for\s+each\s+row\s+)?(?:as\s+)?begin\s+(.*?)\s*;?\s*end\s*;?\s*$")


def statements_of(body: str) -> list[str]:
    """Statements between semicolons; those in texts and comments end none."""
    out: list[list[str]] = [[]]
    for t in tokens(body):
        if t.text == ";":
            out.append([])
        else:
            out[-1].append(t.text)
    return ["".join(x) for x in out]


def trigger_effects(sql: str, source: str) -> tuple[str, list[str], list[tuple[str, str]]]:
    """A trigger as what it does with changed rows: its table, its events, and for each INSERT .. SELECT of its body the table that gets rows and the query that
    gives them, by the names of the statement's list of columns where it has one, from the views new_rows and old_rows of a batch of changes (inserted and deleted, NEW and OLD). Spark runs no triggers; a
    batch writer runs these. Other statements raise ValueError."""
    m = TRIGGER.match(sql)
    if not m:
        raise ValueError("not a trigger")
    bare = lambda x: re.sub(r"[`\[\]]", "", x or "").rpartition(".")[2]
    out = []
    for statement in (x.strip() for x in statements_of(m[5]) if x.strip()):
        if re.match(r"(?i)set\s+nocount\b", statement):
            continue
        into = re.match(r"(?is)^insert\s+into\s+([\w.\[\]`]+)\s*(\([^()]*\)\s*)?(?:(select\b.*)|values\s*\((.*)\))$", statement)
        if not into:
            raise ValueError(f"needs a hand: {statement[:60]}")
        select = into[3] or f"SELECT {into[4]} FROM {'OLD' if re.search(r'(?i)\bold\.', into[4]) else 'NEW'}"
        select = to_spark(select, source)
        for old, new in (("inserted", "new_rows"), ("deleted", "old_rows"), ("new", "new_rows"), ("old", "old_rows")):
            select = "".join(new if t.kind == "word" and t.text.lower() == old else t.text for t in tokens(select))
        named = [bare(c.strip()) for c in into[2].strip()[1:-1].split(",")] if into[2] else []
        out.append((bare(into[1]), f"SELECT * FROM ({select}) AS made({', '.join(f'`{c}`' for c in named)})" if named else select))
    return bare(m[2] or m[4]), [e.strip().upper() for e in re.split(r",|\bor\b", m[3], flags=re.I)], out


def run_effects(spark: SparkSession, effects: list[tuple[str, str]], write: Callable[[str, object], object]) -> list[str]:
    """Runs a trigger's effects on a batch of changes, whose views new_rows and old_rows are there; write gets each table and its new rows."""
    for name, select in effects:
        write(name, spark.sql(select))
    return [name for name, _ in effects]
