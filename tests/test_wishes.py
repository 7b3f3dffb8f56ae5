"""Conditions solved together against rows tried one by one, and rows that survive joins against the join."""

import itertools
import random

import pytest

from concordat.operators import reducer
from concordat.operators.wishes import USUAL, Domain, Wish, conditions, matches, solved


@pytest.mark.parametrize("seed", range(40))
def test_a_domain_has_a_value_if_one_of_a_range_meets_all(seed):
    rng = random.Random(seed)
    signs = {"=": int.__eq__, "<>": int.__ne__, "<": int.__lt__, "<=": int.__le__, ">": int.__gt__, ">=": int.__ge__}
    wishes = [(rng.choice(["<", "<=", ">", ">=", "<>", "<>", "="] if rng.random() < 0.8 else list(signs)), rng.randrange(0, 8)) for _ in range(rng.randrange(1, 6))]
    domain = Domain("whole")
    for s, v in wishes:
        domain.ask(Wish("", "a", s, (str(v),)))
    ok, value = domain.pick("1000")
    holds = lambda x: all(signs[s](x, v) for s, v in wishes)
    assert ok == any(map(holds, [*range(-10, 20), 1000])) and (not ok or holds(int(value)))


def test_patterns_sets_and_nulls():
    def picked(*wishes, kind="text"):
        domain = Domain(kind)
        for s, *v in wishes:
            domain.ask(Wish("", "a", s, tuple(v)))
        return domain.pick(USUAL[kind])

    ok, value = picked(("LIKE", "a%"), ("LIKE", "%b"), ("NOT LIKE", "ab"), ("<>", "axb"))
    assert ok and matches(value, "a%b") and value not in ("ab", "axb")
    assert picked(("IN", "x", "y"), ("<>", "x")) == (True, "y") and picked(("IN", "x"), ("<>", "x"))[0] is False
    assert picked(("NULL",)) == (True, None) and picked(("NULL",), ("=", "x"))[0] is False and picked(("NOT NULL",)) == (True, "v1")
    assert picked((">", "1.5"), ("<", "1.6"), kind="number")[0] and not picked((">", "1.5"), ("<", "1.6"), kind="whole")[0]
    assert picked(("=", "abc"), kind="whole")[0] is False
    ok, day = picked((">=", "2024-02-28"), ("<", "2024-03-01"), ("<>", "2024-02-28"), kind="day")
    assert ok and day == "2024-02-29"
    ok, text = picked((">", "abc"), ("<", "abd"))
    assert ok and "abc" < text < "abd"


def test_conditions_have_alternatives_and_leave_texts_alone():
    ways = conditions("SELECT * FROM a JOIN b ON a.x = b.x AND b.y > 1 WHERE (a.z = 'it''s OR not' OR 3 >= a.z) AND a.w BETWEEN 1 AND 2 -- AND a.q = 1\n GROUP BY a.x HAVING a.v NOT IN (1, 2) ORDER BY a.u")
    assert len(ways) == 2
    told = [{(w.alias, w.column, w.sign, w.values) for w in way} for way in ways]
    both = {("b", "y", ">", ("1",)), ("a", "w", ">=", ("1",)), ("a", "w", "<=", ("2",)), ("a", "v", "NOT IN", ("1", "2"))}
    assert told == [both | {("a", "z", "=", ("it's OR not",))}, both | {("a", "z", "<=", ("3",))}]


def test_joined_columns_have_one_domain():
    a, b, c = ("a", "x"), ("b", "x"), ("c", "x")
    kinds = dict.fromkeys([a, b, c], "int")
    values, clashes = solved([[(a, Wish("", "x", ">", ("5",))), (c, Wish("", "x", "<", ("7",)))]], kinds, [(a, b), (b, c)])
    assert not clashes and set(values.values()) == {"6"} and len(values) == 3
    assert solved([[(a, Wish("", "x", ">", ("5",))), (c, Wish("", "x", "<", ("6",)))]], kinds, [(a, b), (b, c)])[1] == ["a.x"]


@pytest.mark.parametrize("seed", range(3))
def test_survivors_are_the_joins_rows(spark, seed):
    rng = random.Random(seed)
    draw = lambda n, *sizes: [(i, *(None if rng.random() < 0.1 else rng.randrange(s) for s in sizes)) for i in range(n)]
    rows = {"a": draw(20, 6, 5), "b": draw(8, 6, 4), "c": draw(6, 5), "d": draw(5, 4)}
    schemas = {"a": "ka int, ab int, ac int", "b": "kb int, ba int, bd int", "c": "kc int, ca int", "d": "kd int, db int"}
    pairs = [("a", "ab", "b", "ba"), ("c", "ca", "a", "ac"), ("b", "bd", "d", "db")]
    want = [t for t in itertools.product(*rows.values()) if None not in (t[0][1], t[0][2], t[1][2]) and t[0][1] == t[1][1] and t[0][2] == t[2][1] and t[1][2] == t[3][1]]
    frames = {n: spark.createDataFrame(rows[n], schemas[n]) for n in rows}
    for root in "ad":
        held = reducer.reduced(frames, pairs, root)
        for i, n in enumerate(rows):
            assert sorted(r[0] for r in held[n].collect()) == sorted({t[i][0] for t in want})
    found = reducer.anchor(frames, pairs)
    assert (found is None) == (not want) and (not want or tuple(tuple(found[n].values()) for n in rows) in want)


def test_tables_must_be_joined(spark):
    with pytest.raises(ValueError, match="not joined: b"):
        reducer.join_tree(["a", "b"], [], "a")


@pytest.mark.parametrize("domain", [1, 2, 26, 97, 1000, 10**18])
def test_permutations_repeat_nothing(spark, domain):
    from pyspark.sql import functions as F

    from concordat.operators import witness

    n = min(domain, 1000)
    got = [tuple(r) for r in spark.range(n).select(*(witness.permuted(F.col("id"), domain, k) for k in (1, 2))).collect()]
    for k in (0, 1):
        assert len({r[k] for r in got}) == n and all(0 <= r[k] < domain for r in got)
    texts = [r[0] for r in spark.range(min(n, 26)).select(witness.unique_text(F.col("id"), 1)).collect()]
    assert len(set(texts)) == len(texts) and all(len(t) == 1 and t.islower() for t in texts)


def test_pairs_must_suffice(spark):
    from concordat.operators import witness

    parents = spark.createDataFrame([("a",), ("b",)], "k string")
    got = witness.assign_unique_pairs(spark.range(4), "id", 4, (parents, "k", "x"), (parents, "k", "y")).collect()
    assert {(r.x, r.y) for r in got} == {(a, b) for a in "ab" for b in "ab"}
    with pytest.raises(ValueError, match="pairs"):
        witness.assign_unique_pairs(spark.range(5), "id", 5, (parents, "k", "x"), (parents, "k", "y"))
