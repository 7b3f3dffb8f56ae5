"""Statements that write: each against what the statement means, and what needs a hand."""

import datetime
from decimal import Decimal

import pytest

from concordat.plans.scripts import literal
from concordat.plans.transitions import Tables, run_routine


@pytest.fixture
def tables(spark):
    def make(source="mssql", **more):
        items = spark.createDataFrame([(1, "a", 10.0), (2, "b", None), (3, "a;b", 30.0), (4, None, 40.0)], "k int, what string, x double")
        other = spark.createDataFrame([(1, 100), (1, 90), (3, 7), (9, 8)], "k int, y int")
        return Tables(spark, source, {"Items": items, "other": other}, **more)

    return make


def state(t, name="items"):
    return sorted((tuple(r) for r in t.frames[name].drop("__row").collect()), key=repr)


def test_updates(tables):
    t = tables()
    assert t.write("UPDATE dbo.Items SET x += 1, [what] = 'it''s' WHERE x > 5 AND what = 'a;b'") == 1
    assert (3, "it's", 31.0) in state(t)
    assert t.write("UPDATE i SET i.x = o.y FROM items AS i JOIN other o ON o.k = i.k") == 2
    assert [r for r in state(t) if r[0] in (1, 3)] == [(1, "a", 90.0), (3, "it's", 7.0)]  # the least of what would be set
    assert t.write("UPDATE items SET x = 0 WHERE EXISTS (SELECT 1 FROM other o WHERE o.k = items.k)") == 2
    t = tables("mysql")
    assert t.write("UPDATE items i INNER JOIN other o ON o.k = i.k SET i.what = CONCAT(i.what, o.y) WHERE o.y < 50") == 1
    assert (3, "a;b7", 30.0) in state(t)


def test_null_conditions_take_no_row(tables):
    t = tables()
    assert t.write("UPDATE items SET x = 1 WHERE what <> 'a'") == 2 and (4, None, 40.0) in state(t)
    assert t.write("DELETE FROM items WHERE x < 0 OR x IS NULL AND k = 99") == 0


def test_deletes(tables):
    t = tables()
    assert t.write("DELETE i FROM items i JOIN other o ON i.k = o.k WHERE o.y > 50") == 1 and [r[0] for r in state(t)] == [2, 3, 4]
    assert t.write("DELETE FROM items WHERE k NOT IN (SELECT k FROM other)") == 2 and [r[0] for r in state(t)] == [3]
    assert t.write("TRUNCATE TABLE items") == 1 and state(t) == [] and t.write("DELETE items") == 0
    t = tables("mysql")
    assert t.write("DELETE i FROM items i WHERE i.k = 2") == 1 and t.write("DELETE FROM i USING items i, other o WHERE i.k = o.k") == 2


def test_inserts_with_defaults_and_identities(tables):
    t = tables(defaults={"items": {"what": "'none'"}}, identities={"items": "k"})
    assert t.write("INSERT INTO items (x) VALUES (1), (2.5)") == 2
    assert [r for r in state(t) if r[0] > 4] == [(5, "none", 1.0), (6, "none", 2.5)]
    assert t.write("INSERT items SELECT what, y FROM items i JOIN other o ON o.k = i.k") == 3
    assert sorted(r[0] for r in state(t)) == list(range(1, 10))
    with pytest.raises(ValueError, match="values for"):
        t.write("INSERT INTO items (x, what) VALUES (1)")


def test_merges(tables):
    t = tables()
    once = "(SELECT k, MAX(y) AS y FROM other GROUP BY k)"
    taken = t.write(f"MERGE items AS t USING {once} AS s ON (t.k = s.k) WHEN MATCHED AND s.y > 50 THEN UPDATE SET x = s.y WHEN MATCHED THEN DELETE WHEN NOT MATCHED THEN INSERT (k, x) VALUES (s.k, s.y) WHEN NOT MATCHED BY SOURCE AND t.x IS NULL THEN DELETE;")
    assert taken == 4 and t.taken[-1][2:] == (1, 1, 2) and state(t) == [(1, "a", 100.0), (4, None, 40.0), (9, None, 8.0)]
    t = tables()
    with pytest.raises(ValueError, match="several rows"):
        t.write("MERGE INTO items t USING other s ON t.k = s.k WHEN MATCHED THEN UPDATE SET x = s.y")
    assert len(state(t)) == 4
    # two rows of the source meet a row, but only one is asked for: the row is there once
    assert t.write("MERGE INTO items t USING other s ON t.k = s.k WHEN MATCHED AND s.y = 90 THEN UPDATE SET x = s.y") == 1
    assert state(t) == [(1, "a", 90.0), (2, "b", None), (3, "a;b", 30.0), (4, None, 40.0)]


def test_rollbacks_guards_and_counts(tables):
    sql = """CREATE PROCEDURE p @fail INT AS BEGIN
      DECLARE @n INT = 0;
      BEGIN TRY
        BEGIN TRANSACTION;
        DELETE FROM items WHERE k < 3;
        SET @n = @@ROWCOUNT;
        IF @fail = 1 THROW 50000, 'no; not this', 1;
        COMMIT;
      END TRY
      BEGIN CATCH
        ROLLBACK;
        SET @n = -1;
      END CATCH
      SELECT @n AS n;
    END"""
    for fail, n, left in ((0, 2, 2), (1, -1, 4)):
        t = tables()
        assert run_routine(t, sql, {"fail": fail}).first()["n"] == n and len(state(t)) == left


def test_loops_and_tables_of_a_routine(tables):
    sql = """CREATE PROCEDURE p @most INT AS BEGIN
      CREATE TABLE #seen (k INT, x FLOAT);
      WHILE @most > 0 BEGIN
        INSERT INTO #seen (k, x) VALUES (@most, @most * 2);
        SET @most = @most - 1;
      END
      SELECT k, COUNT(*) AS n INTO #counts FROM #seen GROUP BY k;
      UPDATE items SET x = s.x FROM items JOIN #seen s ON s.k = items.k;
      SELECT SUM(n) AS n FROM #counts;
    END"""
    t = tables()
    assert run_routine(t, sql, {"most": 3}).first()["n"] == 3 and [r[2] for r in state(t)] == [2.0, 4.0, 6.0, 40.0]


def test_what_needs_a_hand(tables):
    for sql in ("UPDATE TOP (1) items SET x = 1", "UPDATE items SET x = 1 OUTPUT inserted.k", "INSERT INTO items EXEC p", "UPDATE items SET no_column = 1", "UPDATE nowhere SET x = 1", "SELECT 1"):
        with pytest.raises(ValueError):
            tables().write(sql)
    with pytest.raises(ValueError, match="CURSOR"):
        run_routine(tables(), "CREATE PROCEDURE p AS BEGIN DECLARE c CURSOR FOR SELECT 1; END")
    with pytest.raises(ValueError, match="no parameter"):
        run_routine(tables(), "CREATE PROCEDURE p @a INT AS BEGIN DELETE FROM items; END", {"b": 1})


def test_literals_have_types(spark):
    values = [None, True, 3, 1.5, float("nan"), "it's \\ ;", b"\x00\xff", datetime.date(2024, 1, 2), datetime.datetime(2024, 1, 2, 3, 4, 5), Decimal("1.50"), datetime.timedelta(seconds=90)]
    row = spark.sql("SELECT " + ", ".join(f"{literal(v)} AS c{i}" for i, v in enumerate(values))).first()
    assert [row[i] for i in range(len(values)) if i != 4] == [v for i, v in enumerate(values) if i != 4] and row["c4"] != row["c4"]
