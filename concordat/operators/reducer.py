"""Rows that survive a join: semi-joins up and down its tree leave in each table just the rows that the join returns, without the join."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Edge:
    """A table joined to its parent in the tree, by columns of each."""

    table: str
    parent: str
    own: tuple[str, ...]
    above: tuple[str, ...]


def join_tree(tables: list[str], pairs: list[tuple[str, str, str, str]], root: str) -> tuple[list[Edge], list[Edge]]:
    """Edges of a spanning tree from the root downwards, all equalities of two tables in one, and edges that close a ring. A table that no equality
    reaches raises ValueError."""
    joined: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for a, x, b, y in pairs:
        (a, x), (b, y) = sorted(((a, x), (b, y)))
        joined.setdefault((a, b), []).append((x, y))
    tree, rings, seen, front = [], [], {root}, [root]
    left = dict(joined)
    while front:
        at = front.pop(0)
        for (a, b), columns in list(left.items()):
            if at not in (a, b):
                continue
            del left[a, b]
            other = b if at == a else a
            own, above = (tuple(y for _, y in columns), tuple(x for x, _ in columns)) if at == a else (tuple(x for x, _ in columns), tuple(y for _, y in columns))
            (rings if other in seen else tree).append(Edge(other, at, own, above))
            if other not in seen:
                seen.add(other)
                front.append(other)
    if missing := sorted(set(tables) - seen):
        raise ValueError(f"not joined: {', '.join(missing)}")
    return tree, rings


def kept(rows: DataFrame, columns: tuple[str, ...], other: DataFrame, theirs: tuple[str, ...]) -> DataFrame:
    """Rows whose columns some row of other has. Only other's different keys are shuffled to them."""
    keys = other.select(*(F.col(c).alias(f"__{i}") for i, c in enumerate(theirs))).distinct()
    on = [F.col(c) == F.col(f"__{i}") for i, c in enumerate(columns)]
    return rows.join(keys, on, "left_semi")


def reduced(tables: dict[str, DataFrame], pairs: list[tuple[str, str, str, str]], root: str | None = None) -> dict[str, DataFrame]:
    """tables with only the rows that their inner join, by equalities pairs (table, column, table, column), returns.

    Two passes of semi-joins over the tree of the join: from the leaves up, each table keeps what its children meet; from the root down, what its parent
    meets. For joins whose tables form a tree that is exact, and costs a shuffle of keys for each edge and pass, whatever the join would
    return. Equalities that close a ring are met as well, in both passes, but rows may be left that only meet in part; null keys meet nothing. Where no
    root is named it is the first table.
    """
    tree, rings = join_tree(list(tables), pairs, root or next(iter(tables)))
    held = dict(tables)
    for e in [*reversed(tree), *rings]:
        held[e.parent] = kept(held[e.parent], e.above, held[e.table], e.own)
    for e in [*rings, *tree]:
        held[e.table] = kept(held[e.table], e.own, held[e.parent], e.above)
    return held


def anchor(tables: dict[str, DataFrame], pairs: list[tuple[str, str, str, str]], root: str | None = None) -> dict[str, dict[str, object]] | None:
    """One row of each table that meet each other, and so values that a routine's parameters can have together; None if the join is empty. The least row
    of the root that survives, then for each table down the tree the least row that meets its parent's."""
    first = root or next(iter(tables))
    tree, _ = join_tree(list(tables), pairs, first)
    held = reduced(tables, pairs, first)
    least = lambda df: df.agg(F.min(F.struct(*df.columns)).alias("row")).first()["row"]  # noqa: E731  one row
    top = least(held[first])
    if top is None:
        return None
    found = {first: top.asDict()}
    for e in tree:
        above = found[e.parent]
        met = [F.col(own) == F.lit(above[parent]) for own, parent in zip(e.own, e.above)]
        row = least(held[e.table].where(reduce(lambda a, b: a & b, met)))
        if row is None:
            return None  # a ring that only met in part
        found[e.table] = row.asDict()
    return found
