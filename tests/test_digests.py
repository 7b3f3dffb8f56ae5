"""Digest trees against plain differences."""

import random

import pytest

from concordat.operators import digests, parity


@pytest.mark.parametrize("seed", range(3))
def test_only_ranges_that_differ_are_looked_at_and_all_differences_found(spark, monkeypatch, seed):
    monkeypatch.setattr(digests, "DIGITS", 1)
    rng = random.Random(seed)
    rows = [(rng.randrange(300) if rng.random() < 0.95 else None, rng.choice(["a", "b", None, "x\x1fy"]), rng.random() < 0.5) for _ in range(400)]
    other = [r for r in rows if rng.random() > 0.01] + [(rng.randrange(300), "new", True) for _ in range(rng.randrange(0, 4))]
    schema = "k int, v string, b boolean"
    source, target = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)
    want = sorted(map(str, parity.diff_rows(source, target, ["k"], ["v", "b"]).collect()))
    found, told = digests.digest_diff(source, target, ["k"], ["v", "b"], enough=2)
    assert sorted(map(str, found.collect())) == want
    assert all(a[3] + a[4] >= b[3] + b[4] for a, b in zip(told, told[1:])) and told[-1][3] + told[-1][4] < len(rows)
    same, told = digests.digest_diff(source, source.repartition(5), ["k"], ["v", "b"])
    assert same.collect() == [] and len(told) == 1 and told[0][2] == 0


def test_tree_hashes_are_of_multisets(spark):
    rows = [("a", 1), ("b", 2), ("b", 2), (None, 3)]
    of = lambda r: spark.createDataFrame(r, "s string, n int")
    h = lambda df: tuple(digests.tree_hash(df).first())
    assert h(of(rows)) == h(of(rows[::-1]).repartition(3)) and h(of(rows))[1] == 4
    assert len({h(of(r)) for r in (rows, rows[1:], [*rows, ("a", 1)], [("1", 1), *rows[1:]])}) == 4
    assert h(of([]))[1] == 0 and digests.tree_hash(of(rows), ["n"]).count() == 3
