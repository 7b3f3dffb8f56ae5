"""Tokens of SQL, and where its clauses begin and end."""

from __future__ import annotations

import re
from dataclasses import dataclass

SET_WORDS = frozenset(["UNION", "INTERSECT", "EXCEPT", "MINUS"])

TOKENS = re.compile(
    r"(?P<space>\s+|--[^\n]*|/\*.*?\*/)|(?P<text>N?'(?:[^']|'')*')|(?P<bracket>\[[^\]]*\])|(?P<tick>`[^`]*`)|(?P<quoted>\"[^\"]*\")|(?P<number>\d+(?:\.\d+)?)|(?P<word>[@#A-Za-z_][@#$\w]*)|(?P<mark><>|<=|>=|!=|\|\||::|.)",
    re.S,
)


@dataclass
class Token:
    kind: str
    text: str

    @property
    def word(self) -> str:
        return self.text.upper() if self.kind == "word" else self.text


def tokens(sql: str) -> list[Token]:
    return [Token(m.lastgroup or "mark", m[0]) for m in TOKENS.finditer(sql)]


def text_of(held: list[Token]) -> str:
    return "".join(t.text for t in held)


def step(held: list[Token], at: int) -> int:
    """The next token that isn't white space."""
    while at < len(held) and held[at].kind == "space":
        at += 1
    return at


def closing(held: list[Token], at: int) -> int:
    """Where the parenthesis that opens at a place closes."""
    depth = 0
    for k in range(at, len(held)):
        depth += (held[k].text == "(") - (held[k].text == ")")
        if not depth:
            return k
    raise ValueError("a parenthesis stays open")


def arguments(held: list[Token], at: int, end: int) -> list[list[Token]]:
    out, depth, start = [], 0, at + 1
    for k in range(at + 1, end):
        depth += (held[k].text == "(") - (held[k].text == ")")
        if held[k].text == "," and not depth:
            out.append(held[start:k])
            start = k + 1
    if out or text_of(held[start:end]).strip():
        out.append(held[start:end])
    return out


def before(held: list[Token], k: int) -> int:
    """The token before a place that isn't white space, or -1."""
    k -= 1
    while k >= 0 and held[k].kind == "space":
        k -= 1
    return k


def branch(held: list[Token], k: int) -> tuple[int, bool]:
    """Where the SELECT at a place ends, and whether it is a branch of a set operation. The ORDER BY after the last branch isn't the branch's."""
    depth, end = 0, len(held)
    for j in range(k + 1, len(held)):
        depth += (held[j].text == "(") - (held[j].text == ")")
        if depth < 0 or depth == 0 and (held[j].text == ";" or held[j].word in SET_WORDS):
            end = j
            break
    last = before(held, k)
    if last >= 0 and held[last].word in ("ALL", "DISTINCT"):
        last = before(held, last)
    follows = last >= 0 and held[last].word in SET_WORDS
    united = follows or end < len(held) and held[end].word in SET_WORDS
    if follows and not (end < len(held) and held[end].word in SET_WORDS):
        end = clause(held, k, end, "ORDER")
    return end, united


def clause(held: list[Token], k: int, end: int, *words: str) -> int:
    """Where a clause of the SELECT at a place begins, or end."""
    depth = 0
    for j in range(k + 1, end):
        depth += (held[j].text == "(") - (held[j].text == ")")
        if not depth and held[j].word in words:
            return j
    return end


def made(text: str) -> list[Token]:
    return [Token("made", text)]


def select_items(held: list[Token], k: int, end: int) -> tuple[int, int, list[list[Token]]]:
    """The items of the SELECT at a place, and where they begin and end."""
    first = step(held, k + 1)
    if first < end and held[first].word in ("DISTINCT", "ALL"):
        first = step(held, first + 1)
    stop = clause(held, k, end, "FROM", "WHERE", "GROUP", "ORDER", "FOR", "LIMIT")
    items, depth, start = [], 0, first
    for j in range(first, stop):
        depth += (held[j].text == "(") - (held[j].text == ")")
        if held[j].text == "," and not depth:
            items.append(held[start:j])
            start = j + 1
    return first, stop, [*items, held[start:stop]]
