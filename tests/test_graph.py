"""Graphs: what joins find is what a walk finds."""

import random

import pytest

from concordat.operators import graph


def walked(edges):
    needs = {}
    for a, b in edges:
        needs.setdefault(a, set()).add(b)
    out = {}
    for start in needs:
        front, depth = {start}, 0
        while front:
            depth += 1
            front = {d for x in front for d in needs.get(x, ())} - {d for s, d in out if s == start}
            out |= {(start, d): depth for d in front}
    return out


@pytest.mark.parametrize("n,m", [(12, 14), (30, 80)])
def test_joins_find_what_a_walk_finds(spark, n, m):
    rng = random.Random(n)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
    deps, want = spark.createDataFrame(edges, "src int, dst int"), walked(edges)
    for found in (graph.closure(deps), graph.doubled_closure(deps)):
        assert {(r.src, r.dst): r.depth for r in found.collect()} == want
    assert {tuple(r) for r in graph.reachable(deps).collect()} == set(want)
    nodes = {x for e in edges for x in e}
    least = {x: min([x, *(y for y in nodes if (x, y) in want and (y, x) in want)]) for x in nodes}
    for found in (graph.components(deps), graph.joined_components(deps)):
        assert {r.node: r.component for r in found.collect()} == least
    assert {r.fqn for r in graph.cycle_members(deps).collect()} == {x for x in nodes if (x, x) in want}


def test_a_long_chain_is_a_table_not_a_list_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(graph, "DRIVER_PAIRS", 1000)
    deps = spark.createDataFrame([(i, i + 1) for i in range(200)], "src int, dst int")
    found = graph.closure(deps)
    assert found.count() == 200 * 201 // 2 and found.agg({"depth": "max"}).first()[0] == 200


def test_components_of_nothing_and_of_nulls(spark):
    deps = spark.createDataFrame([(None, "a"), ("a", None), ("b", "b")], "src string, dst string")
    for found in (graph.components(deps), graph.joined_components(deps)):
        assert sorted(map(tuple, found.collect())) == [("b", "b")]
    assert graph.doubled_closure(deps.limit(0)).count() == 0


def test_bare_names_are_of_the_same_schema_first(spark):
    objects = spark.createDataFrame([("a.v", "v", ["T", "b.t", "u"]), ("a.t", "t", []), ("b.t", "t", []), ("c.u", "u", ["v"]), ("b.u", "u", [])], "fqn string, name string, depends_on array<string>")
    assert sorted(map(tuple, graph.edges(objects).collect())) == [("a.v", "a.t"), ("a.v", "b.t"), ("a.v", "b.u"), ("c.u", "a.v")]
