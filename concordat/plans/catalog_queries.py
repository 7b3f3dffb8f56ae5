"""Queries of definitions, catalogs, verification, documents of a run and witness rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.functions import canonical, values
from concordat.operators import audit, parity, verification, witness, workspace
from concordat.operators import catalog as types
from concordat.operators.ranks import numbered
from concordat.sources import catalogs, definitions, files, sinks

from .registry import for_each, one_of, query, sql_rows, table

quoted = lambda x: "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'"


def values_of(rows: list[tuple]) -> str:
    return ", ".join(f"({', '.join(map(quoted, r))})" for r in rows)


MYSQL_DDL = """CREATE TABLE `ship_note` (
  `note_no` int(11) NOT NULL AUTO_INCREMENT, -- counted up
  `carrier` varchar(80) NOT NULL,
  `remark` text,
  `sealed` tinyint(1) DEFAULT 0,
  `line_no` int(11),
  PRIMARY KEY (`note_no`), KEY `by_carrier` (`carrier`, `sealed`),
  CONSTRAINT `of_line` FOREIGN KEY (`line_no`) REFERENCES `depot`.`line` (`no`) ON DELETE SET NULL
) ENGINE=InnoDB;
DELIMITER //
CREATE DEFINER=`clerk`@`%` PROCEDURE `depot`.`notes_of`(IN p_carrier VARCHAR(80))
BEGIN
  SELECT note_no, remark FROM ship_note WHERE carrier = p_carrier; SELECT 'x//;y' AS t;
END//
DELIMITER ;"""
MSSQL_DDL = """CREATE TABLE [dbo].[orders] (
  [id] INT IDENTITY(1,1) NOT NULL,
  [amount] DECIMAL(10,2) NULL,
  [cust] INT NOT NULL,
  PRIMARY KEY CLUSTERED ([id] ASC) WITH (PAD_INDEX = OFF) ON [PRIMARY]
) ON [PRIMARY]
GO
ALTER TABLE [dbo].[orders] WITH CHECK ADD CONSTRAINT [fk] FOREIGN KEY([cust]) REFERENCES [dbo].[customers] ([id])
GO
CREATE TRIGGER dbo.trg ON dbo.orders AFTER INSERT AS BEGIN UPDATE dbo.log SET x = 1 END
GO
CREATE VIEW dbo.v AS WITH q AS (SELECT 1 AS a) SELECT * FROM q JOIN dbo.orders o ON o.id = q.a
GO"""


def scripts(spark: SparkSession) -> DataFrame:
    t = "file string, value string"
    return definitions.inventory(spark.createDataFrame([("a.sql", MYSQL_DDL)], t), "mysql", "depot").unionByName(definitions.inventory(spark.createDataFrame([("b.sql", MSSQL_DDL)], t), "mssql"))


@query("SELECT * FROM (VALUES ('TABLE', 'depot.ship_note', 5, 'note_no', 'note_no', 'depot.line', '', false), ('PROCEDURE', 'depot.notes_of', 0, '', '', 'ship_note', '', true), ('TABLE', 'dbo.orders', 3, 'id', 'id', 'dbo.customers', '', false), ('TRIGGER', 'dbo.trg', 0, '', '', 'dbo.log', 'dbo.orders', false), ('VIEW', 'dbo.v', 0, '', '', 'dbo.orders', '', true)) t(type, fqn, n_columns, identity, pk, deps, target_table, row_producing)")
def ddl_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of two scripts: a changing delimiter, a key added later, comments, definers and storage options."""
    identity = F.array_join(F.transform(F.filter("columns", lambda c: c["is_identity"]), lambda c: c["name"]), ",")
    o = scripts(spark).where(~F.col("ddl").contains("DEFINER"))
    return o.select("type", "fqn", F.size("columns").alias("n_columns"), identity.alias("identity"), F.array_join("pk_columns", ",").alias("pk"), F.array_join("depends_on", ",").alias("deps"), F.coalesce("target_table", F.lit("")).alias("target_table"), "row_producing")


@query("SELECT * FROM (VALUES ('dbo.orders', 'id', 'INT', 'int', false), ('dbo.orders', 'amount', 'DECIMAL(10,2)', 'decimal(10,2)', true), ('dbo.orders', 'cust', 'INT', 'int', false), ('depot.ship_note', 'note_no', 'int(11)', 'int', false), ('depot.ship_note', 'carrier', 'varchar(80)', 'string', false), ('depot.ship_note', 'remark', 'text', 'string', true), ('depot.ship_note', 'sealed', 'tinyint(1)', 'boolean', true), ('depot.ship_note', 'line_no', 'int(11)', 'int', true)) t(fqn, name, type_name, spark_type, nullable)")
def ddl_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scripts(spark).select("fqn", F.explode("columns").alias("c")).select("fqn", "c.name", "c.type_name", "c.nullable")
    spark_type = F.pandas_udf(lambda s: s.map(lambda t: types.spark_type(t.partition("(")[0] if not t.lower().startswith("tinyint(1") else t, "mysql" if "tinyint" in t else "mssql", *(int(x) for x in t.partition("(")[2].rstrip(")").split(",") if x.strip().isdigit()))), "string")
    return rows.withColumn("spark_type", spark_type("type_name"))


@query("SELECT * FROM (VALUES ('dbo.orders', 'cust', 'dbo.customers', 'id'), ('depot.ship_note', 'line_no', 'depot.line', 'no')) t(from_table, from_cols, to_table, to_cols)")
def ddl_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return definitions.foreign_key_rows(scripts(spark))


@query("SELECT * FROM (VALUES ('TABLE', 1::BIGINT, 5::BIGINT), ('PROCEDURE', 1, 0)) t(type, n, n_columns)")
def inventory_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory kept as JSON, its columns taken from definitions."""
    held = [{"type": "table", "schema": "depot", "name": "ship_note", "fqn": "depot.ship_note", "ddl": MYSQL_DDL.partition("DELIMITER")[0], "depends_on": []}, {"type": "procedure", "schema": "depot", "name": "p", "fqn": "depot.p", "ddl": "CREATE PROCEDURE depot.p() BEGIN SELECT 1; END", "depends_on": []}]
    o = definitions.enriched(spark.createDataFrame([(json.dumps({"objects": held}),)], "value string"), "mysql", "depot")
    return o.groupBy("type").agg(F.count("*").alias("n"), F.sum(F.size("columns")).cast("bigint").alias("n_columns"))


@query("SELECT 'CREATE TABLE t (a int)' AS cleaned, true AS clean")
def ddl_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ddl = "SET ANSI_NULLS ON\nGO\nCREATE TABLE t (a int NOT FOR REPLICATION COLLATE Latin1_General_CI_AS) ON [PRIMARY] TEXTIMAGE_ON [PRIMARY]\nGO"
    made = definitions.without_storage(ddl)
    return spark.createDataFrame([(made.replace(" )", ")"), "PRIMARY" not in made)], "cleaned string, clean boolean")


# rows of a system's catalog, made of the tables themselves: each nation is a table, each supplier a column of it
def system(spark: SparkSession, sf_dir: str, source: str) -> catalogs.Catalog:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    s.createOrReplaceTempView("cat_supplier")
    n.createOrReplaceTempView("cat_nation")
    k = "cast(s_suppkey AS int)"
    schema = "CASE WHEN s_nationkey = 3 THEN 'SYS' ELSE concat('S', s_nationkey % 4) END"
    made = {
        "columns": f"SELECT {schema} AS schema_name, concat('T', s_nationkey) AS table_name, {k} AS place, concat('C', s_suppkey) AS column_name, element_at(array('int', 'bit', 'varchar', 'tinyint(1)'), {k} % 4 + 1) AS type_name, 10 AS max_length, 9 AS precision, 0 AS scale, {k} % 2 AS is_nullable, cast({k} % 7 = 0 AS int) AS is_identity, 1L AS seed, 1L AS increment, CASE WHEN {k} % 5 = 0 THEN '((0))' END AS default_expr, 0 AS is_computed, cast(NULL AS string) AS computed_expr FROM cat_supplier",
        "keys": f"SELECT {schema} AS schema_name, concat('T', s_nationkey) AS table_name, -{k} AS ordinal, concat('C', s_suppkey) AS column_name FROM cat_supplier WHERE s_suppkey % 7 = 0",
        "foreign_keys": "SELECT concat('F', s_nationkey) AS name, -cast(s_suppkey AS int) AS ordinal, concat('S', s_nationkey % 4) AS from_schema, concat('T', s_nationkey) AS from_table, concat('C', s_suppkey) AS from_col, 'S0' AS to_schema, 'T0' AS to_table, concat('D', s_suppkey) AS to_col, 'CASCADE' AS on_delete, 'NO_ACTION' AS on_update FROM cat_supplier WHERE s_suppkey % 3 = 0",
        "indexes": "SELECT concat('S', s_nationkey % 4) AS schema_name, concat('T', s_nationkey) AS table_name, concat('I', s_nationkey) AS index_name, CASE WHEN s_nationkey = 5 THEN 'HEAP' ELSE 'NONCLUSTERED' END AS kind, 1 AS is_unique, cast(s_nationkey = 6 AS int) AS is_primary_key, cast(NULL AS string) AS predicate, cast(s_suppkey AS int) AS ordinal, concat('C', s_suppkey) AS column_name, cast(s_suppkey % 2 AS int) AS is_desc, cast(s_suppkey % 3 = 0 AS int) AS is_included FROM cat_supplier",
        "sequences": "SELECT 'app' AS schema_name, concat('Q', n_nationkey) AS sequence_name, n_nationkey * 10 AS start_value, 5L AS increment, 1L AS min_value, 999L AS max_value, cast(n_nationkey % 2 AS int) AS is_cycling FROM cat_nation",
        "texts": "SELECT 'app' AS schema_name, concat('p', s_nationkey) AS object_name, element_at(array('SQL_STORED_PROCEDURE', 'VIEW', 'SQL_TRIGGER', 'SQL_SCALAR_FUNCTION'), cast(s_nationkey % 4 AS int) + 1) AS kind, s_suppkey AS line, concat(s_suppkey, ';') AS text FROM cat_supplier",
        "parameters": "SELECT 'app' AS schema_name, concat('p', s_nationkey) AS routine_name, -cast(s_suppkey AS int) AS place, concat('@a', s_suppkey) AS parameter_name, 'int' AS type_name, 0 AS is_output FROM cat_supplier",
    }
    if "view_texts" in catalogs.STATEMENTS[source]:  # kept apart from other texts
        made |= {"texts": f"SELECT * FROM ({made['texts']}) WHERE kind <> 'VIEW'", "view_texts": f"SELECT * FROM ({made['texts']}) WHERE kind = 'VIEW'"}
    by_statement = {catalogs.STATEMENTS[source][w]: q for w, q in made.items() if w in catalogs.STATEMENTS[source]}
    return catalogs.Catalog(source, lambda statement: spark.sql(by_statement[statement]))


KEPT = "k AS (SELECT s_suppkey::INT AS k, s_nationkey AS n, 'S' || (s_nationkey % 4) AS sch FROM supplier WHERE s_nationkey <> 3)"
TABLES_SQL = f"WITH {KEPT} SELECT sch AS schema_name, 'T' || n AS table_name, count(*)::INT AS n_columns, string_agg('C' || k, ',' ORDER BY k) AS columns, coalesce(string_agg('C' || k, ',' ORDER BY k DESC) FILTER (k % 7 = 0), '') AS pk, sum(k % 7 = 0)::INT AS n_identity, sum(k % 5 = 0)::INT AS n_defaults FROM k GROUP BY ALL"


def table_rows(c: catalogs.Catalog) -> DataFrame:
    count = lambda ok: F.size(F.filter("columns", ok))
    return c.tables().select("schema_name", "table_name", F.size("columns").alias("n_columns"), F.array_join("columns.column_name", ",").alias("columns"), F.array_join("primary_key", ",").alias("pk"), count(lambda x: x["is_identity"]).alias("n_identity"), count(lambda x: x["default_expr"].isNotNull()).alias("n_defaults"))


@query(TABLES_SQL)
def catalog_tables_mssql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, keys, identities and defaults by table; the system's own schemas are left out."""
    return table_rows(system(spark, sf_dir, "mssql"))


@query(TABLES_SQL)
def catalog_tables_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_rows(system(spark, sf_dir, "mysql"))


@query(TABLES_SQL)
def catalog_tables_oracle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_rows(system(spark, sf_dir, "oracle"))


@query("SELECT 'F' || s_nationkey AS name, 'T' || s_nationkey AS from_table, string_agg('C' || s_suppkey, ',' ORDER BY s_suppkey DESC) AS from_cols, string_agg('D' || s_suppkey, ',' ORDER BY s_suppkey DESC) AS to_cols, 'CASCADE' AS on_delete FROM supplier WHERE s_suppkey % 3 = 0 GROUP BY s_nationkey")
def catalog_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return system(spark, sf_dir, "oracle").foreign_keys().select("name", "from_table", F.array_join("from_cols", ",").alias("from_cols"), F.array_join("to_cols", ",").alias("to_cols"), "on_delete")


@query("SELECT 'I' || s_nationkey AS index_name, coalesce(string_agg('C' || s_suppkey || CASE WHEN s_suppkey % 2 = 1 THEN ' DESC' ELSE '' END, ',' ORDER BY s_suppkey) FILTER (s_suppkey % 3 <> 0), '') AS columns, coalesce(string_agg('C' || s_suppkey || CASE WHEN s_suppkey % 2 = 1 THEN ' DESC' ELSE '' END, ',' ORDER BY s_suppkey) FILTER (s_suppkey % 3 = 0), '') AS include_cols FROM supplier WHERE s_nationkey NOT IN (5, 6) GROUP BY s_nationkey")
def catalog_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without heaps and primary keys."""
    return system(spark, sf_dir, "mssql").indexes().select("index_name", F.array_join("columns", ",").alias("columns"), F.array_join("include_cols", ",").alias("include_cols"))


@query("SELECT 'Q' || n_nationkey AS sequence_name, n_nationkey * 10 AS start_value, n_nationkey % 2 = 1 AS is_cycling, [n_nationkey * 10, n_nationkey * 10 + 5, n_nationkey * 10 + 10] AS first_values FROM nation")
def catalog_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = system(spark, sf_dir, "mssql").sequences()
    return q.select("sequence_name", "start_value", "is_cycling", F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.col("start_value") + i * F.col("increment")).alias("first_values"))


@query("SELECT CASE s_nationkey % 4 WHEN 0 THEN 'PROCEDURE' WHEN 1 THEN 'VIEW' WHEN 2 THEN 'TRIGGER' ELSE 'FUNCTION' END AS type, 'app.p' || s_nationkey AS fqn, string_agg(s_suppkey || ';', '' ORDER BY s_suppkey) AS ddl FROM supplier GROUP BY s_nationkey")
def catalog_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts kept line by line, joined in order."""
    return system(spark, sf_dir, "oracle").objects().select("type", "fqn", "ddl")


@query("SELECT 'p' || s_nationkey AS routine_name, string_agg('@a' || s_suppkey, ',' ORDER BY s_suppkey DESC) AS names FROM supplier GROUP BY s_nationkey")
def catalog_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return system(spark, sf_dir, "mysql").parameters().select("routine_name", F.array_join("names", ",").alias("names"))


@query(f"WITH {KEPT} SELECT sch AS schema_name, 'T' || n AS table_name, string_agg('C' || k, ',' ORDER BY 'C' || k) AS columns FROM k WHERE k % 4 IN (1, 3) GROUP BY ALL")
def catalog_boolean_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = system(spark, sf_dir, "mysql").columns()
    return types.boolean_columns(c.withColumn("table_name", F.concat_ws(".", "schema_name", "table_name"))).select(F.substring_index("table_name", ".", 1).alias("schema_name"), F.substring_index("table_name", ".", -1).alias("table_name"), "columns")


@query("SELECT * FROM (VALUES ('nation', 3::BIGINT), ('region', 2), ('customer', 5), ('supplier', 4)) t(table_name, n_columns)".replace("('customer', 5), ('supplier', 4)", "('customer', (SELECT count(*) FROM (DESCRIBE customer))), ('supplier', (SELECT count(*) FROM (DESCRIBE supplier)))"))
def session_column_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = {t: table(spark, sf_dir, t) for t in ("nation", "region", "customer", "supplier")}
    return catalogs.session_catalog(spark, held).column_counts().select("table_name", "n_columns")


@query("SELECT n_name AS schema_name, n_nationkey % 5 = 0 AS own FROM nation WHERE n_nationkey % 5 <> 0 UNION ALL SELECT * FROM (VALUES ('sys', true), ('INFORMATION_SCHEMA', true), ('pg_toast_1', true), ('dbo', false)) t(schema_name, own)")
def system_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0").select(F.col("n_name").alias("schema_name"))
    rows = n.unionByName(spark.createDataFrame([("sys",), ("INFORMATION_SCHEMA",), ("pg_toast_1",), ("dbo",)], "schema_name string"))
    return rows.withColumn("own", catalogs.system_schema(F.col("schema_name"), "mssql") | catalogs.system_schema(F.col("schema_name"), "postgres"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL ORDER BY o_orderkey LIMIT 1")
def sample_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row with what a routine's parameters are compared with (the sample is the feature)."""
    return catalogs.sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], key="o_orderkey")


@query("SELECT least(count(*), 5000)::BIGINT AS n FROM lineitem")
def bounded_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogs.first_rows(table(spark, sf_dir, "lineitem")).agg(F.count("*").alias("n"))


SOURCE_OBJECTS = [("TABLE", "dbo.Orders", "id,amount"), ("TABLE", "dbo.lost", "id"), ("VIEW", "dbo.[v]", "a,b,c"), ("PROCEDURE", "dbo.p", "x,y"), ("TRIGGER", "dbo.trg", ""), ("TRIGGER", "dbo.trg2", ""), ("SEQUENCE", "dbo.s", "")]
TARGET_OBJECTS = [("TABLE", "dbo.orders", "ID,amount"), ("VIEW", "dbo.v", "a,b,d"), ("PROCEDURE", "dbo.p", "x"), ("FUNCTION", "dbo.trg_fn", "z"), ("SEQUENCE", "dbo.s", "")]
COPIES = "SELECT type, replace(fqn, '.', s_suppkey || '.') AS fqn, m FROM supplier, (VALUES {}) v(place, type, fqn, m)"  # in a schema of each supplier
VERIFY = f"""s AS ({COPIES.format(sql_rows(SOURCE_OBJECTS))}), t AS ({COPIES.format(sql_rows(TARGET_OBJECTS))}), k AS (SELECT s.type, s.fqn, t.fqn AS target_fqn, CASE WHEN s.type IN ('TRIGGER', 'SEQUENCE') THEN '' ELSE lower(s.m) END AS a, CASE WHEN s.type IN ('TRIGGER', 'SEQUENCE') THEN '' ELSE lower(t.m) END AS b
 FROM s LEFT JOIN t ON regexp_replace(lower(s.fqn), '[\\[\\]"]', '', 'g') = lower(t.fqn) OR (s.type = 'TRIGGER' AND lower(s.fqn) || '_fn' = lower(t.fqn))),
d AS (SELECT *, list_filter(string_split(a, ','), lambda x: x <> '' AND NOT list_contains(string_split(b, ','), x)) AS os, list_filter(string_split(b, ','), lambda x: x <> '' AND NOT list_contains(string_split(a, ','), x)) AS ot FROM k),
v AS (SELECT fqn, type, target_fqn, CASE WHEN target_fqn IS NULL THEN 'missing' WHEN len(os) + len(ot) = 0 THEN 'match' WHEN type IN ('TABLE', 'VIEW') THEN 'col_mismatch' ELSE 'param_mismatch' END AS status, CASE WHEN target_fqn IS NULL THEN '' ELSE array_to_string(list_sort(os), ',') END AS only_source, CASE WHEN target_fqn IS NULL THEN '' ELSE array_to_string(list_sort(ot), ',') END AS only_target FROM d)"""


def verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    side = lambda rows: for_each(each, rows, "type string, fqn string, m string").select("type", F.replace("fqn", F.lit("."), F.concat("k", F.lit("."))).alias("fqn"), F.filter(F.split("m", ","), lambda x: x != "").alias("members"))
    return verification.catalog_verification(side(SOURCE_OBJECTS), side(TARGET_OBJECTS))


@query(f"WITH {VERIFY} SELECT * FROM v")
def catalog_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified(spark, sf_dir)


@query(f"WITH {VERIFY} SELECT type, count(*) FILTER (status = 'match')::BIGINT AS match, count(*) FILTER (status = 'col_mismatch')::BIGINT AS col_mismatch, count(*) FILTER (status = 'param_mismatch')::BIGINT AS param_mismatch, count(*) FILTER (status = 'missing')::BIGINT AS missing FROM v GROUP BY type")
def catalog_verification_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verification.verification_summary(verified(spark, sf_dir))


@query("""WITH s AS (SELECT 'T' || s_nationkey AS t, s_suppkey AS k FROM supplier), q AS (SELECT * FROM s WHERE k % 11 <> 0), n AS (SELECT count(DISTINCT t) AS a FROM s), m AS (SELECT count(DISTINCT t) AS a FROM q)
SELECT 'table_count' AS "check", n.a AS source_n, m.a AS target_n, m.a >= n.a AS passed FROM n, m UNION ALL SELECT 'identity_columns', (SELECT count(*) FROM s WHERE k % 7 = 0), (SELECT count(*) FROM q WHERE k % 7 = 0), (SELECT count(*) FROM q WHERE k % 7 = 0) >= (SELECT count(*) FROM s WHERE k % 7 = 0)
 UNION ALL SELECT 'foreign_keys', 5, 5, true UNION ALL SELECT 'indexes', 3, 2, false UNION ALL SELECT 'column_counts', n.a, (SELECT count(*) FROM (SELECT t, count(*) AS c FROM s GROUP BY t) JOIN (SELECT t, count(*) AS d FROM q GROUP BY t) USING (t) WHERE c = d), (SELECT count(*) FROM q) = (SELECT count(*) FROM s) FROM n
 UNION ALL SELECT 'primary_keys', n.a, (SELECT count(*) FROM (SELECT t, coalesce(string_agg('C' || k, ',' ORDER BY 'C' || k) FILTER (k % 5 = 0), '') AS c FROM s GROUP BY t) JOIN (SELECT t, coalesce(string_agg('C' || k, ',' ORDER BY 'C' || k) FILTER (k % 5 = 0), '') AS d FROM q GROUP BY t) USING (t) WHERE c = d), (SELECT count(*) FROM q WHERE k % 5 = 0) = (SELECT count(*) FROM s WHERE k % 5 = 0) FROM n""")
def schema_six_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six checks of a target that lacks each eleventh column; the sample holds all tables here."""
    columns = table(spark, sf_dir, "supplier").select(F.concat(F.lit("T"), "s_nationkey").alias("table_name"), F.concat(F.lit("C"), "s_suppkey").alias("column_name"), (F.col("s_suppkey") % 7 == 0).alias("is_identity"), (F.col("s_suppkey") % 5 == 0).alias("in_key"), "s_suppkey")
    side = lambda c, i: {"columns": c, "foreign_keys": spark.range(5), "indexes": spark.range(i)}
    return verification.six_checks(side(columns, 3), side(columns.where("s_suppkey % 11 <> 0"), 2), sample=1000)


@query("""WITH t AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 97 <> 0 UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 101 = 0 AND o_orderkey <> 0), s AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders)
SELECT (SELECT count(*) FROM s) AS source_n_rows, (SELECT count(*) FROM t) AS target_n_rows, 'o_orderstatus' AS columns_only_source, 'extra' AS columns_only_target, (SELECT count(*) FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM t)) AS rows_only_source, (SELECT count(*) FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM s)) AS rows_only_target, 'FAIL_COLUMNS' AS verdict""")
def view_full_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    t = parity.perturbed(o, "o_orderkey", "o_totalprice").drop("o_orderstatus").withColumn("extra", F.lit(1))
    return verification.view_parity(o, t)


SOURCE_TRIGGERS = [("dbo.a", "dbo.t", "INSERT,update", True), ("dbo.b", "dbo.t", "DELETE", True), ("c", "dbo.u", "INSERT", True), ("d", "dbo.t", "INSERT", True), ("e", "dbo.t", "INSERT", True)]
TARGET_TRIGGERS = [("a_trigger", "DBO.T", "UPDATE,INSERT", True), ("b_fn", "dbo.t", "INSERT", True), ("x.c", "dbo.t", "INSERT", True), ("d", "dbo.t", "INSERT", False), ("f", "dbo.t", "INSERT", True)]


@query("SELECT 'q' || s_suppkey || trigger AS trigger, verdict FROM supplier, (VALUES ('a', 'PASS'), ('b', 'FAIL_EVENTS'), ('c', 'FAIL_TABLE'), ('d', 'FAIL_ENABLED'), ('e', 'SOURCE_ONLY'), ('f', 'TARGET_ONLY')) t(trigger, verdict)")
def trigger_full_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    own = F.concat(F.regexp_extract("name", r"^(\w+\.)?", 0), F.lit("q"), "k", F.regexp_replace("name", r"^\w+\.", ""))  # a trigger of its own for each supplier
    side = lambda rows: for_each(each, rows, "name string, table_name string, e string, enabled boolean").withColumn("name", own).drop("k").withColumn("events", F.split("e", ","))
    return verification.trigger_parity(side(SOURCE_TRIGGERS), side(TARGET_TRIGGERS))


@query("SELECT 'T' || n_nationkey AS type_name, CASE WHEN n_nationkey % 3 = 0 THEN 'SOURCE_ONLY' ELSE 'PASS' END AS verdict FROM nation")
def type_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("T"), "n_nationkey").alias("type_name"), "n_nationkey")
    return verification.type_parity(n.select("type_name"), n.where("n_nationkey % 3 <> 0").select(F.lower("type_name").alias("type_name")))


@query("SELECT CASE WHEN c_custkey % 19 < 10 AND c_custkey < 38 THEN 'trigger_function' ELSE 'procedure' END AS kind, count(*)::BIGINT AS n, sum(c_custkey % 2 = 0)::BIGINT AS by_rules, sum(c_custkey % 2 = 1)::BIGINT AS by_hand FROM customer GROUP BY 1")
def routine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey")
    routines = c.select(F.concat(F.lit("app.r"), "c_custkey", F.when(F.col("c_custkey") % 19 < 10, "_fn").otherwise("")).alias("name"), F.when(F.col("c_custkey") % 2 == 0, "rules").otherwise("model").alias("fixed_by"))
    triggers = c.where("c_custkey % 19 < 10 AND c_custkey < 38").select(F.concat(F.lit("r"), "c_custkey", F.lit("_trigger")).alias("name"))
    return verification.split_routines(routines, triggers)


@query("SELECT 'S' || n AS schema_name, 'T' || t AS table_name, a AS source_n, b AS target_n, CASE WHEN b IS NULL THEN 'SOURCE_ONLY' WHEN a = b THEN 'PASS' ELSE 'FAIL' END AS verdict FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY 'T' || t) AS p FROM (SELECT c_nationkey AS n, c_custkey AS t, c_custkey % 7 AS a, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 7 + c_custkey % 2 END AS b FROM customer) WHERE a > 0) WHERE p <= 30")
def structural_column_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").selectExpr("concat('S', c_nationkey) AS schema_name", "concat('T', c_custkey) AS table_name", "c_custkey % 7 AS source_n", "CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 7 + c_custkey % 2 END AS target_n")
    return verification.column_sample(c)


ORDERED = [("FAIL", 0), ("FAIL_DATA", 1), ("PASS", 12), ("SKIPPED", 13), ("ODD", 16)]


@query(f"WITH v(verdict, place) AS (VALUES {values_of(ORDERED)}) SELECT o_orderkey, verdict, row_number() OVER (ORDER BY place, o_orderkey) AS position FROM orders JOIN (SELECT *, row_number() OVER (ORDER BY place) - 1 AS i FROM v) ON o_orderkey % 5 = i")
def verdict_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts by gravity, then key."""
    v = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(ORDERED)], "i long, verdict string")
    rows = table(spark, sf_dir, "orders").join(F.broadcast(v), F.col("o_orderkey") % 5 == F.col("i")).withColumn("__place", verification.verdict_place(F.col("verdict")))
    return verification.in_verdict_order(numbered(rows, F.col("__place"), F.col("o_orderkey"), place="position").select("o_orderkey", "verdict", "position"), "o_orderkey")


#: Labels cut from the names of parts, cut too long, or of no part; objects named after parts in two schemas.
LABELS = "CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN left(upper(p_name), 12) WHEN 2 THEN concat('app.', p_name) WHEN 3 THEN concat(left(p_name, 14), '_LONG') ELSE concat('none', p_partkey) END"
NAMES = "concat(CASE WHEN p_partkey % 2 = 0 THEN 'app.' ELSE 'rep.' END, left(p_name, 14))"


@query(f"""WITH l AS (SELECT DISTINCT {LABELS} AS label FROM part WHERE p_partkey % 7 = 0), n AS (SELECT DISTINCT {NAMES} AS fqn FROM part), p AS (SELECT label, fqn, CASE WHEN lower(label) = lower(fqn) THEN 1 WHEN lower(label) = split_part(lower(fqn), '.', -1) THEN 2 WHEN starts_with(split_part(lower(fqn), '.', -1), lower(label)) OR starts_with(lower(label), split_part(lower(fqn), '.', -1)) THEN 3
 WHEN starts_with(lower(fqn), lower(label)) OR starts_with(lower(label), lower(fqn)) THEN 4 END AS kind FROM l, n) SELECT label, (SELECT fqn FROM p q WHERE q.label = l.label AND kind IS NOT NULL ORDER BY kind, fqn LIMIT 1) AS fqn FROM l""")
def label_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return verification.label_match(parts.where("p_partkey % 7 = 0").selectExpr(f"{LABELS} AS label").distinct(), parts.selectExpr(f"{NAMES} AS fqn").distinct())


STATUS = ["blocked", "failed_objects", "checks", "checks_failed", "witness_ran", "witness_failed", "parity_ran", "parity_failed", "parity_missing"]


@query("""WITH r AS (SELECT o_orderkey AS k, o_orderkey % 13 = 0 AS blocked, o_orderkey % 3 AS fo, o_orderkey % 5 AS c, o_orderkey % 2 AS cf, o_orderkey % 7 <> 0 AS wr, o_orderkey % 4 AS wf, o_orderkey % 11 <> 0 AS pr, o_orderkey % 6 AS pf, 0 AS pm FROM orders)
SELECT status, count(*)::BIGINT AS n FROM (SELECT CASE WHEN blocked THEN 'BLOCKED' WHEN fo = 0 AND c > 0 AND cf = 0 AND wr AND wf = 0 AND pr AND pf = 0 AND pm = 0 THEN 'COMPLETE' WHEN c = 0 OR NOT wr OR NOT pr THEN 'IN PROGRESS' ELSE 'NEEDS ATTENTION' END AS status FROM r) GROUP BY 1""")
def overall_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    row = dict(zip(STATUS, (k % 13 == 0, k % 3, k % 5, k % 2, k % 7 != 0, k % 4, k % 11 != 0, k % 6, F.lit(0))))
    return table(spark, sf_dir, "orders").select(verification.overall_status(row).alias("status")).groupBy("status").agg(F.count("*").alias("n"))


@query("""WITH o AS (SELECT ['pending', 'done', 'failed', 'skipped'][o_orderkey % 4 + 1] AS c, ['pending', 'done', 'failed', 'skipped'][o_orderkey % 3 + 1] AS r, ['pending', 'done', 'failed', 'skipped'][o_custkey % 4 + 1] AS d, ['pending', 'done', 'failed', 'skipped'][o_custkey % 3 + 1] AS v FROM orders)
SELECT count(*) FILTER (d = 'failed' AND r <> 'done')::BIGINT AS repair, count(*) FILTER (c = 'done' AND d NOT IN ('done', 'skipped'))::BIGINT AS deployment, count(*) FILTER (d = 'done' AND v NOT IN ('done', 'skipped'))::BIGINT AS validation, count(*) FILTER (c NOT IN ('done', 'skipped'))::BIGINT AS conversion, count(*) FILTER (c = 'done' AND r IN ('done', 'skipped', 'pending'))::BIGINT AS deployable FROM o""")
def tier_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = lambda k, n: F.element_at(F.array(*map(F.lit, ("pending", "done", "failed", "skipped"))), (F.col(k) % n + 1).cast("int"))
    states = {"conversion": state("o_orderkey", 4), "repair": state("o_orderkey", 3), "deployment": state("o_custkey", 4), "validation": state("o_custkey", 3)}
    return table(spark, sf_dir, "orders").agg(*(F.count_if(verification.needs(t, states)).alias(t) for t in ("repair", "deployment", "validation", "conversion")), F.count_if(verification.deployable(states)).alias("deployable"))


FAMILY_RULES = [("etl_rows", "etl", ["staging", "no rows"], []), ("any_timeout", None, [], ["time", "out"])]


@query("SELECT o_orderkey, e, f, CASE WHEN (contains(e, 'staging') OR contains(e, 'no rows')) AND f = 'etl' THEN 'etl_rows' WHEN contains(e, 'time') AND contains(e, 'out') THEN 'any_timeout' END AS rule FROM orders JOIN (VALUES (0, 'no rows in staging', 'etl'), (1, 'no rows', 'report'), (2, 'it timed out', 'x'), (3, 'time', 'etl')) t(place, e, f) ON o_orderkey % 4 = place")
def error_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = one_of(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", [("no rows in staging", "etl"), ("no rows", "report"), ("it timed out", "x"), ("time", "etl")], "e string, f string")
    return e.withColumn("rule", verification.reclassified_by_family(F.col("e"), F.col("f"), FAMILY_RULES))


@query("""WITH f AS (SELECT 'k' || (o_orderkey % 6) AS e FROM orders WHERE o_orderkey % 50 = 0), g AS (SELECT 'T' || o_custkey AS t, count(*)::BIGINT AS a, sum(o_orderkey % 97 <> 0)::BIGINT AS b FROM orders GROUP BY 1)
SELECT 'HIGH' AS level, 'repair_rate' AS rule, '' AS subject, 5::BIGINT AS n UNION ALL SELECT 'MEDIUM', 'error_pattern', e, count(*) FROM f GROUP BY e HAVING count(*) >= 2 UNION ALL SELECT 'MEDIUM', 'row_gap', t, abs(b - a) FROM g WHERE abs(b - a) * 100.0 / a > 5 UNION ALL SELECT 'MEDIUM', 'marker_density', '', 3""")
def recommendation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    failures = o.where("o_orderkey % 50 = 0").select(F.concat(F.lit("k"), F.col("o_orderkey") % 6).alias("error_class"))
    gaps = o.groupBy(F.concat(F.lit("T"), "o_custkey").alias("table_name")).agg(F.count("*").alias("source_n"), F.count_if(F.col("o_orderkey") % 97 != 0).alias("target_n"))
    one = lambda schema, *v: spark.createDataFrame([v], schema)
    return verification.recommendations(one("fixed long, failed long", 4, 5), failures, gaps, one("n_markers long, n_objects long", 3, 20))


DOCS = [
    ("ws/deployment_summary.json", '{"source_db": "a", "elapsed_s": 45.0, "phases": {"tables": {"ok": 71, "failed": 0}, "indexes": {"ok": 102, "failed": 1}}, "failures": [{"label": "i1", "phase": "indexes", "error": "x"}, {"label": "i1", "phase": "indexes", "error": "x"}]}'),
    ("ws/parallel_deploy_summary.json", '{"source_db": "old", "phases": {}}'),
    ("ws/deploy_report.json", '{"succeeded": ["v1", "v2"], "failed": [], "skipped": ["v3"]}'),
    ("ws/repair/repair_report.json", '{"fixed_llm": ["p1"], "still_failed": []}'),
    ("ws/validation_report.json", '{"checks": [{"check": "table_count", "passed": true}, {"check": null, "passed": true}]}'),
    ("ws/catalog_verification.json", "not json"),
]


def documents(spark: SparkSession) -> DataFrame:
    return workspace.load_documents(spark.createDataFrame(DOCS, "file string, value string"))


@query("SELECT * FROM (VALUES ('deployment_summary', 'ws/deployment_summary.json'), ('deploy_report', 'ws/deploy_report.json'), ('repair_report', 'ws/repair/repair_report.json'), ('validation_report', 'ws/validation_report.json')) t(document, file)")
def workspace_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark).select("document", "file")


@query(f"SELECT json_extract_string(v, '$.source_db') AS source_db, (SELECT sum(json_extract(x, '$.ok')::INT) FROM (SELECT unnest(json_extract(v, '$.phases.*')) AS x))::BIGINT AS ok, json_array_length(v, '$.failures')::INT AS n_failures FROM (SELECT {quoted(DOCS[0][1])}::JSON AS v)")
def workspace_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = workspace.document(documents(spark), "deployment_summary")
    return d.select("source_db", F.aggregate(F.map_values("phases"), F.lit(0).cast("bigint"), lambda a, p: a + p["ok"]).alias("ok"), F.size("failures").alias("n_failures"))


@query("SELECT * FROM (VALUES ('deployment_summary', 'a failure named twice'), ('validation_report', 'a check without name or verdict')) t(document, error)")
def contract_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workspace.contract_errors(documents(spark))


@query("SELECT * FROM (VALUES ('report', 'deployment_summary', true), ('report', 'validation_report', true), ('repair', 'deploy_report', true), ('extract', 'none', true)) t(phase, document, there) WHERE document <> 'none'")
def preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark)
    return workspace.preflight(d, "report").unionByName(workspace.preflight(d, "repair"))


STATES = [("extract", "done"), ("assess", "done"), ("convert", "failed"), ("deploy", "pending"), ("validate", "pending")]


@query(f"SELECT phase, status FROM (VALUES {values_of(STATES)}) t(phase, status) WHERE list_position(['extract', 'assess', 'convert', 'deploy', 'repair', 'validate', 'report'], phase) < 6 AND status <> 'done'")
def blocked_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workspace.blocked_by(spark.createDataFrame(STATES, "phase string, status string"), "validate")


@query("""WITH e AS (SELECT o_orderkey AS line, 'k' || (o_orderkey % 4) AS error_class, 'src' || (o_orderkey % 2) AS source_type, 't' || (o_orderkey % 3) AS tester, 'obj' || lpad((o_orderkey % 40)::VARCHAR, 2, '0') AS object_name, 'e' || o_orderkey AS error FROM orders)
SELECT error_class, count(*)::BIGINT AS n, array_to_string(list_sort(list_distinct(list(source_type))), ',') AS sources, array_to_string(list_sort(list_distinct(list(tester))), ',') AS testers, array_to_string(list_sort(list_distinct(list(object_name)))[1:20], ',') AS objects, arg_min(error, line) AS first_error FROM e GROUP BY 1""")
def feedback_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    body = F.to_json(F.struct(F.concat(F.lit("k"), k % 4).alias("error_class"), F.concat(F.lit("src"), k % 2).alias("source_type"), F.concat(F.lit("t"), k % 3).alias("tester"), F.concat(F.lit("obj"), F.lpad((k % 40).cast("string"), 2, "0")).alias("object_name"), F.concat(F.lit("e"), k).alias("error")))
    lines = table(spark, sf_dir, "orders").select(F.lit("f.jsonl").alias("file"), k.alias("line"), body.alias("value"))
    lines = lines.unionByName(spark.createDataFrame([("f.jsonl", -1, "broken {")], "file string, line long, value string"))
    return workspace.feedback_summary(workspace.feedback_entries(lines))


RULE_FILES = {"mssql/functions.json": '[{"pattern": "isnull\\\\(", "replacement": "coalesce(", "phase": "view"}, {"pattern": "getdate\\\\(\\\\)", "replacement": "now()", "phase": "proc"}]', "shared/types.json": '[{"pattern": "nvarchar", "replacement": "string", "context": "cast"}]'}


@query("SELECT * FROM (VALUES ('coalesce(a, GETDATE())', 'nvarchar'), ('x', 'nvarchar')) t(sql, shared_pattern)")
def rule_loader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's own rules by phase, shared ones where it has none, applied in order."""
    own = workspace.rules(spark, RULE_FILES.get, "mssql", "functions", phase="view")
    shared = workspace.rules(spark, RULE_FILES.get, "mssql", "types")
    pairs = [(r["pattern"], r["replacement"]) for r in own.orderBy("place").collect()]
    return spark.createDataFrame([("ISNULL(a, GETDATE())",), ("x",)], "s string").select(workspace.applied(F.col("s"), pairs).alias("sql")).crossJoin(shared.select(F.col("pattern").alias("shared_pattern")))


WITNESS_VIEW = "SELECT c.c_custkey, o.o_orderkey FROM dbo.customer c JOIN dbo.orders o ON o.o_custkey = c.c_custkey WHERE c.c_mktsegment = 'NOWHERE' AND o.o_totalprice > 999999999 AND o.o_orderpriority IN ('9-NONE', 'x')"


@query("SELECT 0::BIGINT AS rows_before, 1::BIGINT AS rows_after, 'NOWHERE' AS segment, '9-NONE' AS priority")
def witness_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view without rows has one after a row that meets its conditions and its join was added to each table."""
    held = {t: table(spark, sf_dir, t) for t in ("customer", "orders")}

    def rows(frames: dict[str, DataFrame]) -> DataFrame:
        for t, df in frames.items():
            df.createOrReplaceTempView(t)
        return spark.sql(WITNESS_VIEW.replace("dbo.", "").replace("SELECT c.c_custkey, o.o_orderkey", "SELECT c.c_mktsegment, o.o_orderpriority"))

    before = rows(held).agg(F.count("*").alias("rows_before"))
    after = rows(witness.witness_rows(spark, WITNESS_VIEW, held)).agg(F.count("*").alias("rows_after"), F.max("c_mktsegment").alias("segment"), F.max("o_orderpriority").alias("priority"))
    return before.crossJoin(after)


@query("SELECT * FROM (VALUES ('alias', 'c', 'dbo.customer'), ('alias', 'customer', 'dbo.customer'), ('alias', 'o', 'dbo.orders'), ('alias', 'orders', 'dbo.orders'), ('join', 'dbo.orders.o_custkey', 'dbo.customer.c_custkey'), ('want', 'dbo.customer.c_mktsegment', '= NOWHERE'), ('want', 'dbo.orders.o_totalprice', '> 999999999'), ('want', 'dbo.orders.o_orderpriority', '= 9-NONE')) t(kind, name, meaning)")
def alias_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("alias", a, t) for a, t in witness.alias_map(WITNESS_VIEW).items()] + [("join", f"{a}.{b}", f"{c}.{d}") for a, b, c, d in witness.join_pairs(WITNESS_VIEW)] + [("want", f"{t}.{c}", f"{s} {v}") for t, c, s, v in witness.wanted(WITNESS_VIEW)]
    return spark.createDataFrame(rows, "kind string, name string, meaning string")


@query("SELECT (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 13 <> 0) AS joined, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 13 <> 0)) AS orphans")
def join_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return witness.joined_rows(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("c_custkey % 13 <> 0"), "o_custkey", "c_custkey")


GUARDED = [("p1", "IF NOT EXISTS (SELECT 1 FROM dbo.run_status WHERE x = 1) RETURN; INSERT INTO dbo.load_log VALUES (1)"), ("p2", "SELECT 1 FROM t")]


@query("SELECT * FROM (VALUES ('p1', 'dbo.load_log,dbo.run_status'), ('p2', '')) t(name, tables)")
def prerequisite_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(GUARDED, "name string, body string").select("name", F.array_join(witness.prerequisites(F.col("body")), ",").alias("tables"))


@query("SELECT count(*) FILTER (o_orderkey % 101 = 0 AND o_orderkey <> 0)::BIGINT AS inserted, count(*) FILTER (o_orderkey % 97 = 0)::BIGINT AS deleted, count(*) FILTER (o_orderkey % 97 <> 0 AND o_orderkey % 89 = 0)::BIGINT AS updated, max(o_orderkey) AS identity FROM orders")
def rows_affected(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return witness.rows_affected(o, parity.perturbed(o, "o_orderkey", "o_totalprice"), "o_orderkey").crossJoin(witness.last_identity(o, "o_orderkey"))


REFERENCES = [("lineitem", "orders"), ("orders", "customer"), ("customer", "nation"), ("supplier", "nation"), ("nation", "region"), ("lineitem", "part")]


@query("SELECT * FROM (VALUES (0, 'part'), (1, 'region'), (2, 'nation'), (3, 'customer'), (4, 'supplier'), (5, 'orders'), (6, 'lineitem')) t(place, table_name)")
def copy_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = {t: table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "supplier", "nation", "region", "part")}
    order = witness.load_files(held, REFERENCES, lambda t, df: df.createOrReplaceTempView(f"loaded_{t}"))
    return spark.createDataFrame(list(enumerate(order)), "place int, table_name string")


@query("SELECT n_nationkey, n_name, '| ' || n_nationkey || ' | ' || n_name || ' |' AS line FROM nation")
def markdown_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey")
    lines = verification.markdown(n).split("\n")[2:]
    return spark.createDataFrame([(x,) for x in lines], "line string").select(F.regexp_extract("line", r"^\| (\d+) ", 1).cast("bigint").alias("n_nationkey"), F.regexp_extract("line", r"^\| \d+ \| (.*) \|$", 1).alias("n_name"), "line")


@query("SELECT c_custkey, '***' AS token, '***' AS login_password, c_name AS login_user, '***' AS part_key, c_nationkey AS part_n FROM customer")
def redaction_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name AS token", "named_struct('password', c_name, 'user', c_name) AS login", "array(named_struct('secret_key', c_name, 'n', c_nationkey)) AS parts")
    return sinks.redacted(c).selectExpr("c_custkey", "token", "login.password AS login_password", "login.user AS login_user", "parts[0].secret_key AS part_key", "parts[0].n AS part_n")


@query("SELECT 'a.sql' AS file, 'é x' AS value UNION ALL SELECT 'b.sql', 'ü' UNION ALL SELECT 'c.sql', 'plain'")
def encoded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts by their byte order marks."""
    rows = [("a.sql", bytearray(b"\xff\xfe" + "é x".encode("utf-16-le"))), ("b.sql", bytearray(b"\xef\xbb\xbf" + "ü".encode())), ("c.sql", bytearray(b"plain"))]
    return spark.createDataFrame(rows, "file string, content binary").select("file", files.decoded(F.col("content")).alias("value"))


@query("SELECT * FROM (VALUES ('bit', '1', 'true'), ('boolean', 'f', 'false'), ('int', ' 12 ', '12'), ('int', 'x', NULL), ('decimal(10,2)', '1.239', '1.24'), ('date', '2024-02-30', NULL), ('binary', '0xFF', 'FF'), ('string', '', '')) t(kind, field, value)")
def field_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("bit", "1", "boolean"), ("boolean", "f", "boolean"), ("int", " 12 ", "int"), ("int", "x", "int"), ("decimal(10,2)", "1.239", "decimal(10,2)"), ("date", "2024-02-30", "date"), ("binary", "0xFF", "binary"), ("string", "", "string")]
    one = lambda k, f, t: spark.createDataFrame([(k, f)], "kind string, field string").withColumn("value", (F.hex(values.from_field(F.col("field"), t)) if t == "binary" else values.from_field(F.col("field"), t).cast("string")))
    out = one(*rows[0])
    for r in rows[1:]:
        out = out.unionByName(one(*r))
    return out


SCRIPT_FILES = [("v.sql", "CREATE VIEW v AS SELECT 1\nGO"), ("t.sql", "CREATE TABLE t (a int)\nGO\nCREATE PROCEDURE p AS SELECT 1\nGO"), ("s.sql", "CREATE SCHEMA s\nGO\nCREATE FUNCTION f() RETURNS int AS BEGIN RETURN 1 END\nGO")]


@query("SELECT * FROM (VALUES (1::BIGINT, 'schema'), (2, 'table'), (3, 'function'), (4, 'view'), (5, 'procedure')) t(place, kind)")
def combined_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of scripts in the order in which its statements are run."""
    rows = files.in_kind_order(files.statements(spark.createDataFrame(SCRIPT_FILES, "file string, value string"), "mssql"))
    kinds = [r["kind"] for r in rows.select("kind").collect()]
    return spark.createDataFrame([(i + 1, k) for i, k in enumerate(kinds)], "place long, kind string")


@query("SELECT * FROM (VALUES ('jdbc:sqlserver://h:1433;databaseName=d;encrypt=true;trustServerCertificate=true', 'mssql'), ('jdbc:mysql://h:3307/d', 'mysql'), ('jdbc:oracle:thin:@//h:1521/d', 'oracle')) t(url, source)")
def source_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(catalogs.connection(s, "h", "d", p)["url"], s) for s, p in (("mssql", None), ("mysql", 3307), ("oracle", None))]
    return spark.createDataFrame(rows, "url string, source string")


@query("SELECT 'Id,Amount' AS copied")
def copied_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = [{"name": "id"}, {"name": "amount"}, {"name": "total", "is_computed": True}, {"name": "gone"}]
    return spark.createDataFrame([(",".join(types.copied_columns(source, ["Id", "Amount", "Total"])),)], "copied string")


@query("SELECT n_nationkey, nullif(p.up, -1) AS parent FROM (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) AS r FROM nation) n LEFT JOIN (SELECT n_nationkey AS up, row_number() OVER (ORDER BY n_nationkey) AS r FROM nation) p ON p.r = n.r // 2")
def seed_self_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return witness.assign_self_parents(table(spark, sf_dir, "nation").select("n_nationkey"), "n_nationkey", "parent")


@query("SELECT 3::INT AS attempts, 'done' AS result, 1.5::DOUBLE AS waited")
def write_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A write that fails twice and is made the third time."""
    seen: list[int] = []
    waits: list[float] = []

    def attempt() -> str:
        seen.append(1)
        if len(seen) < 3:
            raise OSError("deadlock")
        return "done"

    result = sinks.with_retries(attempt, sleep=waits.append)
    return spark.createDataFrame([(len(seen), result, sum(waits))], "attempts int, result string, waited double")


@query("SELECT 'a' || chr(92) || 't' || 'b' || chr(9) || 't' || chr(9) || chr(92) || chr(92) || 'x00ff' || chr(9) || chr(92) || 'N' AS line")
def bulk_field_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Escapes, booleans, bytes in hex and nulls of a bulk load."""
    rows = spark.createDataFrame([("a\tb", True, bytearray(b"\x00\xff"), None)], "t string, b boolean, x binary, n int")
    return sinks.bulk_fields(rows).select(F.col("value").alias("line"))


@query("SELECT 'dbo.' || lower(n_name) AS name, count(*)::BIGINT AS n FROM nation GROUP BY 1")
def identifier_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    forms = F.array(F.concat(F.lit("[DBO].["), "n_name", F.lit("]")), F.concat(F.lit('"dbo"."'), "n_name", F.lit('"')), F.concat(F.lit("dbo.`"), F.lower("n_name"), F.lit("`")))
    rows = table(spark, sf_dir, "nation").select(F.explode(forms).alias("form")).select(parity.identifier(F.col("form")).alias("name"))
    return rows.groupBy("name").agg((F.count("*") / 3).cast("bigint").alias("n"))


@query("SELECT o_custkey, min(o_orderkey) AS entry FROM orders GROUP BY 1")
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first entry of each key."""
    return audit.deduplicated(table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("entry")), ["o_custkey"], "entry")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS at, round(o_totalprice, 6)::VARCHAR AS price, lower(hex(o_orderstatus)) AS raw FROM orders")
def log_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of an execution log."""
    o = table(spark, sf_dir, "orders").withColumn("raw", F.col("o_orderstatus").cast("binary"))
    kinds = {f.name: f.dataType for f in o.schema}
    cell = lambda c: canonical.serialised(F.col(c), kinds[c])
    return o.select("o_orderkey", cell("o_orderdate").alias("at"), cell("o_totalprice").alias("price"), cell("raw").alias("raw"))


VIEWS = [("v_top", "SELECT n FROM v_base WHERE n > 1"), ("v_base", "SELECT count(*) AS n FROM short_nation"), ("v_bad", "SELECT * FROM no_such_thing_at_all")]


@query("SELECT * FROM (VALUES ('v_base', 'auto_fixed'), ('v_top', 'succeeded'), ('v_bad', 'failed')) t(name, status)")
def view_deployment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views in order of need; a short name is tried once more under its full one."""
    table(spark, sf_dir, "nation").createOrReplaceTempView("app_short_nation")
    done = sinks.deploy_views(spark, VIEWS, ["v_base", "v_top"], {"short_nation": "app_short_nation"})
    return spark.createDataFrame([(n, s) for n, s, _ in done], "name string, status string")


@query("SELECT 7::BIGINT AS run_number, 'app' AS source_db, count(*)::BIGINT AS total, sum(o_orderkey % 3 = 0)::BIGINT AS passed, sum(o_orderkey % 3 = 1)::BIGINT AS failed, sum(o_orderkey % 3 = 2)::BIGINT AS skipped, 'COMPLETE' AS status FROM orders")
def run_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run begun after six others and completed by its results."""
    runs = sinks.new_run(spark.range(1, 7).select(F.col("id").alias("run_number")), "app", "target", ["s"], "notes")
    results = table(spark, sf_dir, "orders").select(F.lit(7).cast("bigint").alias("run_number"), F.element_at(F.array(*map(F.lit, ("PASS", "FAIL", "SKIPPED"))), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("verdict"))
    return sinks.completed_run(runs, results, ["PASS"], ["SKIPPED"]).select("run_number", "source_db", "total", "passed", "failed", "skipped", "status")
