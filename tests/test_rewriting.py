"""Rewrites, scripts, definitions and witness conditions as texts; no literal is ever altered."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from concordat.operators import witness
from concordat.operators.catalog import copied_columns, default_of, spark_type
from concordat.plans.rewriter import like_pattern, to_spark
from concordat.plans.scripts import annotated, to_script
from concordat.plans.repairs import repaired, trigger_effects
from concordat.sources import catalogs, definitions, sinks

PIECES = st.sampled_from(["from dbo.x", "flag = 1", "WITH (NOLOCK)", "from dual", "TOP 3", "ROWNUM <= 2", "seq.NEXTVAL", "[a]", "`b`", "GETDATE()", "a + b", "CROSS APPLY f(x) y", "x XOR y", "PIVOT (", "FOR JSON PATH", "--", "/*", "*/", ";", "''", "é", " ", "LIMIT", "AS 'z'", "UNION SELECT TOP 1"])


@settings(max_examples=200, deadline=None)
@given(st.lists(PIECES, max_size=5), st.sampled_from(["mssql", "mysql", "oracle"]))
def test_literals_stay(parts, source):
    literal = "'" + " ".join(parts) + "'"
    sql = f"SELECT {literal} AS a, count(*) AS n FROM app.t WHERE b <> {literal} AND flag = 1"
    out = to_spark(sql, source, booleans={"flag"})
    assert out.count(literal) == 2 and "flag = true" in out and "FROM t" in out


@pytest.mark.parametrize(
    "sql, source, want",
    [
        ("SELECT TOP 100 PERCENT a FROM dbo.t ORDER BY a", "mssql", "SELECT a FROM t ORDER BY a"),
        ("SELECT DISTINCT TOP (3) a FROM t", "mssql", "SELECT DISTINCT a FROM t LIMIT 3"),
        ("SELECT a FROM t (NOLOCK) JOIN dbo.u WITH (READPAST) ON t.i = u.i", "mssql", "SELECT a FROM t  JOIN u ON t.i = u.i"),
        ("SELECT a FROM t WHERE ROWNUM = 1 AND b = 2", "oracle", "SELECT a FROM t WHERE b = 2 LIMIT 1"),
        ("SELECT a FROM t WHERE ROWNUM < 3 UNION ALL SELECT 1 FROM dual", "oracle", "(SELECT a FROM t LIMIT 2) UNION ALL SELECT 1"),
        ("SELECT a FROM otherdb.dbo.t", "mssql", "SELECT a FROM t"),
        ("SELECT x = a FROM t WHERE x = 1", "mssql", "SELECT a AS x FROM t WHERE x = 1"),
        ("SELECT a FROM t LIMIT ;", "mysql", "SELECT a FROM t"),
    ],
)
def test_forms(sql, source, want):
    assert " ".join(to_spark(sql, source).split()) == " ".join(want.split())


def test_like_patterns():
    assert like_pattern("%a_[0-9]%") == "a.[0-9]" and like_pattern("a.b") == "^a\\\\.b$" and like_pattern("%x") == "x$"


def test_scripts_declare_before_they_do():
    script = to_script("CREATE PROC dbo.p @a INT = 3 AS BEGIN SET @a = @a + 1 DECLARE @b INT SELECT @b = COUNT(*) FROM dbo.t WHERE x = @a IF @b > 1 SELECT @b AS b ELSE SELECT 0 AS b END", "mssql")
    lines = script.split("\n")
    assert lines[1] == "DECLARE a int DEFAULT 3;" and lines[2] == "DECLARE b int DEFAULT NULL;" and lines[3] == "SET a = a + 1;"
    assert lines[4] == "SET b = (SELECT COUNT(*) FROM t WHERE x = a);" and lines[5:] == ["IF b > 1 THEN", "SELECT b AS b;", "ELSE", "SELECT 0 AS b;", "END IF;", "END"]
    with pytest.raises(ValueError, match="CURSOR"):
        to_script("CREATE PROC p AS BEGIN DECLARE c CURSOR FOR SELECT 1 END", "mssql")
    marked, codes = annotated("CREATE PROC p AS EXEC sp_executesql @s", "mssql")
    assert codes == ["DYNAMIC_SQL"] and marked.startswith("-- FIX-REQUIRED: DYNAMIC_SQL\n")


def test_definitions_of_oracle():
    ddl = """CREATE TABLE "APP"."EMP" ("ID" NUMBER(9,0) NOT NULL ENABLE, "SAL" NUMBER DEFAULT 0, "D" DATE, CONSTRAINT "PK" PRIMARY KEY ("ID") USING INDEX) TABLESPACE users NOLOGGING;
CREATE OR REPLACE PROCEDURE app.p IS BEGIN UPDATE app.emp SET sal = 1; INSERT INTO app.log SELECT * FROM app.emp; END;
/
CREATE OR REPLACE VIEW app.v AS SELECT * FROM app.emp;
"""
    table, routine, view = definitions.parse(ddl, "oracle", "app")
    assert [c["name"] for c in table["columns"]] == ["ID", "SAL", "D"] and table["pk_columns"] == ["ID"] and not table["columns"][0]["nullable"]
    assert routine["depends_on"] == ["app.emp", "app.log"] and view["row_producing"] and view["depends_on"] == ["app.emp"]


def test_conditions_of_statements():
    sql = "WITH q AS (SELECT 1 AS a) SELECT * FROM dbo.a x, dbo.b y JOIN q ON q.a = x.a WHERE x.k = y.k AND x.s LIKE 'ab%' AND y.n BETWEEN 5 AND 9 AND y.m IS NOT NULL AND ISNULL(x.z, '') <> ''"
    assert witness.alias_map(sql) == {"a": "dbo.a", "x": "dbo.a", "b": "dbo.b", "y": "dbo.b"}
    assert witness.join_pairs(sql) == [("dbo.a", "k", "dbo.b", "k")]
    assert witness.wanted(sql) == [("dbo.b", "n", "=", "5"), ("dbo.a", "s", "LIKE", "ab%"), ("dbo.b", "m", "NOT NULL", ""), ("dbo.a", "z", "<>", "")]


def test_types_and_defaults():
    assert spark_type("number", "oracle") == "decimal(38,10)" and spark_type("number", "oracle", 9, 0) == "int" and spark_type("tinyint(1)", "mysql") == "boolean" and spark_type("tinyint", "mysql") == "smallint"
    assert default_of("(getdate())", "date") == "current_date()" and default_of("(getdate())", "timestamp") == "current_timestamp()"
    assert copied_columns([{"name": "a"}, {"name": "b", "is_computed": True}], ["A", "B"]) == ["A"]


def test_sources_and_settings(tmp_path, monkeypatch):
    assert catalogs.connection("postgres", "h", "d", user="u")["user"] == "u"
    with pytest.raises(ValueError, match="no such source"):
        catalogs.connection("db9", "h", "d")
    (tmp_path / "env").write_text("# x\nexport A_B='one'\nC=two\n")
    monkeypatch.setenv("C", "three")
    assert catalogs.settings(str(tmp_path / "env")) == {"A_B": "one", "C": "three"}
    (tmp_path / "service").write_text("[main]\nhost=h\nport=1\n")
    assert catalogs.settings(str(tmp_path / "service"), "main") == {"host": "h", "port": "1"} and catalogs.settings(str(tmp_path / "service"), "none") == {}


def test_retries_and_repairs():
    seen = []

    def fails():
        seen.append(1)
        raise OSError("no")

    with pytest.raises(OSError):
        sinks.with_retries(fails, sleep=lambda s: None)
    assert len(seen) == 3
    assert repaired("SELECT x", [("x", "y")], lambda s: 1 / 0 if s == "SELECT x" else None)[:2] == ("fixed", "SELECT y")
    with pytest.raises(ValueError, match="needs a hand"):
        trigger_effects("CREATE TRIGGER t ON dbo.a AFTER DELETE AS BEGIN UPDATE b SET c = 1 END", "mssql")
