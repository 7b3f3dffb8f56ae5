"""Dumps cut anywhere: statements and rows as a reading of the whole finds them."""

import random

import pytest

from concordat.sources import dumps

TEXTS = ["plain", "it's; done", "a\nGO\nb", "-- no comment", "/* not; one", "back\\slash'", '"quoted"', "`tick", "[bracket", "", None, "new\nline;\n", "é中;😀", "# hash"]


@pytest.mark.parametrize("source", ["mysql", "mssql", "oracle"])
def test_a_table_comes_back_from_a_dump_in_splits(spark, tmp_path, source):
    rng = random.Random(3)
    rows = [(i, rng.choice(TEXTS), None if i % 7 == 0 else i / 4, bytes([i % 256, 39, 59]), i % 2 == 0) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, t string, x double, b binary, f boolean")
    dumps.insert_lines(df.coalesce(1), "app.items", source).write.option("lineSep", "\n").text(str(tmp_path / "dump"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        lines = dumps.text_lines(spark, str(tmp_path / "dump"))
        assert lines.select("start").distinct().count() >= 4
        found = dumps.statements(lines, source)
        back = dumps.table_rows(found, source, "items", "k int, t string, x double, b binary, f boolean").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, back)) == sorted((k, t, x, bytearray(b), f) for k, t, x, b, f in rows)


SCRIPT = """-- a; comment
CREATE TABLE t (a int); /* b;
c; */ INSERT INTO t VALUES (1), (2);
DELIMITER //
CREATE PROCEDURE p() BEGIN SELECT 'x//y;'; SELECT 2; END//
DELIMITER ;
INSERT INTO `t` (b, a) VALUES ('it''s \\' ;', 3);
SELECT "a;b" # rest; of
FROM t
"""


@pytest.mark.parametrize("size", ["10b", "37b", "64b", "1m"])
def test_statements_are_the_same_wherever_a_file_is_cut(spark, tmp_path, size):
    (tmp_path / "a.sql").write_text(SCRIPT)
    (tmp_path / "b.sql").write_text("SELECT 1;\nSELECT 'open\n;'")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        got = dumps.statements(dumps.text_lines(spark, str(tmp_path)), "mysql").orderBy("path", "start", "place").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.statement for r in got] == [
        "-- a; comment\nCREATE TABLE t (a int)",
        "/* b;\nc; */ INSERT INTO t VALUES (1), (2)",
        "CREATE PROCEDURE p() BEGIN SELECT 'x//y;'; SELECT 2; END",
        "INSERT INTO `t` (b, a) VALUES ('it''s \\' ;', 3)",
        'SELECT "a;b" # rest; of\nFROM t',
        "SELECT 1",
        "SELECT 'open\n;'",
    ]
    assert [dumps.values_of(r.statement, "mysql") for r in got][3] == ("t", ["b", "a"], [["it's ' ;", "3"]])
