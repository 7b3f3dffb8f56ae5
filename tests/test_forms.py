"""Forms that are rewritten, and forms that need a hand and say so."""

import pytest

from concordat.plans.repairs import statements_of, trigger_effects
from concordat.plans.rewriter import to_spark


@pytest.mark.parametrize(
    "source,sql",
    [
        ("mssql", "SELECT * FROM OPENJSON(@x)"),
        ("mssql", "SELECT a FROM t FOR XML PATH('row')"),
        ("mssql", "SELECT FORMAT(a, '#,##0.0') FROM t"),
        ("oracle", "SELECT MAX(a) KEEP (DENSE_RANK FIRST ORDER BY b) FROM t"),
        ("oracle", "SELECT * FROM a, b WHERE a.x = b.x(+) OR a.y = 1"),
        ("oracle", "SELECT * FROM a, b WHERE a.x(+) = b.x AND b.y(+) = a.y"),
        ("oracle", "SELECT a FROM t FETCH FIRST 3 ROWS WITH TIES"),
        ("mysql", "SELECT STRAIGHT_JOIN a FROM t"),
    ],
)
def test_what_has_no_counterpart_raises(source, sql):
    with pytest.raises(ValueError, match="needs a hand"):
        to_spark(sql, source)


def test_texts_and_names_are_left_alone():
    assert to_spark("SELECT 'OFFSET 1 ROWS (+) LIMIT 1, 2' AS [OPENJSON], t.KEEP FROM t", "mssql") == "SELECT 'OFFSET 1 ROWS (+) LIMIT 1, 2' AS `OPENJSON`, t.KEEP FROM t"
    assert to_spark("SELECT a FROM t WHERE a LIKE 'x[_]%' OR b LIKE '%]%'", "mssql") == "SELECT a FROM t WHERE a RLIKE '(?s)^x[_].*$' OR b LIKE '%]%'"


def test_effects_keep_names_and_texts():
    trigger = "CREATE TRIGGER t ON dbo.items AFTER INSERT AS BEGIN INSERT INTO log (what, k) SELECT 'a;b', i.k FROM inserted i; INSERT INTO log SELECT 1, 2 FROM inserted; END"
    table, events, effects = trigger_effects(trigger, "mssql")
    assert (table, events) == ("items", ["INSERT"]) and [e[0] for e in effects] == ["log", "log"]
    assert effects[0][1] == "SELECT * FROM (SELECT 'a;b', i.k FROM new_rows i) AS made(`what`, `k`)" and effects[1][1] == "SELECT 1, 2 FROM new_rows"
    assert statements_of("a ';' -- ;\n; b") == ["a ';' -- ;\n", " b"]


def test_functions_of_several_statements(spark):
    from concordat.plans.routines import table_function_to_spark

    head = "CREATE FUNCTION dbo.f (@n INT = 2) RETURNS @t TABLE (a INT NOT NULL, b VARCHAR(5)) AS BEGIN {} RETURN END"
    spark.sql(table_function_to_spark(head.format("INSERT INTO @t (b) VALUES ('x;'), (NULL); UPDATE @t SET a = @n WHERE b = 'x;'; INSERT @t SELECT a + 1, b FROM @t WHERE a IS NOT NULL; DELETE @t WHERE b IS NULL;"), "mssql"))
    assert sorted(map(tuple, spark.sql("SELECT * FROM f()").collect())) == [(2, "x;"), (3, "x;")]
    assert sorted(r.a for r in spark.sql("SELECT * FROM f(7)").collect()) == [7, 8]
    for body in ("EXEC p;", "UPDATE x SET a = 1;", "MERGE @t USING u ON 1 = 1 WHEN MATCHED THEN DELETE;"):
        with pytest.raises(ValueError, match="needs a hand"):
            table_function_to_spark(head.format(body), "mssql")
    with pytest.raises(ValueError, match="several"):
        table_function_to_spark("CREATE FUNCTION f() RETURNS INT AS BEGIN RETURN 1 END", "mssql")
