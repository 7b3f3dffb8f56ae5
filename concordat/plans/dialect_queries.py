"""Queries written in other dialects, rewritten and run, and the catalog operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.operators import catalog

from .registry import query, table
from .rewriter import to_spark
from .routines import function_to_spark


def run(spark: SparkSession, sf_dir: str, sql: str, source: str, **more: object) -> DataFrame:
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    return run_text(spark, to_spark(sql, source, **more))  # type: ignore[arg-type]


def run_text(spark: SparkSession, text: str) -> DataFrame:
    """The query that a rewritten text is. A tree may have any number of rows, so that the session's limit of a recursion's rows, a million where
    it has none of its own, goes when a text holds one; that of its levels stays and ends loops."""
    if "WITH RECURSIVE" in text:
        spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    return spark.sql(text)


TSQL_VIEW = """CREATE VIEW dbo.v_orders WITH SCHEMABINDING AS
SELECT TOP 50 [o].[o_orderkey] AS [order_key], ISNULL(o.o_orderstatus, N'?') + '-' + c.c_mktsegment AS tag, LEN(c.c_name + '  ') AS name_len,
  DATEADD(month, 1, o.o_orderdate) AS due, DATEPART(yy, o.o_orderdate) AS y, DATEDIFF(day, '1995-01-01', o.o_orderdate) AS days, IIF(o.o_totalprice > 100000, 'big', IIF(o.o_totalprice > 50000, 'mid', 'small')) AS size,
  CONVERT(varchar(10), o.o_orderdate, 112) AS d112, CHARINDEX('#', c.c_name) AS hash_at, TRY_CAST(c.c_name AS INT) AS none, DATEADD(month, DATEDIFF(month, 0, o.o_orderdate), 0) AS m
FROM [dbo].[orders] o WITH (NOLOCK) JOIN dbo.customer c ON c.c_custkey = o.o_custkey ORDER BY o.o_orderkey"""


@query("""SELECT o_orderkey AS order_key, coalesce(o_orderstatus, '?') || '-' || c_mktsegment AS tag, len(c_name)::INT AS name_len, strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS due, year(o_orderdate)::INT AS y, datediff('day', DATE '1995-01-01', o_orderdate)::INT AS days,
 CASE WHEN o_totalprice > 100000 THEN 'big' WHEN o_totalprice > 50000 THEN 'mid' ELSE 'small' END AS size, strftime(o_orderdate, '%Y%m%d') AS d112, strpos(c_name, '#')::INT AS hash_at, NULL::INT AS none, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS m FROM orders JOIN customer ON c_custkey = o_custkey ORDER BY o_orderkey LIMIT 50""")
def tsql_view_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    v = run(spark, sf_dir, TSQL_VIEW, "mssql")
    return v.select("order_key", "tag", "name_len", day("due"), F.col("y").cast("int").alias("y"), "days", "size", "d112", "hash_at", "none", day("m"))


TSQL_APPLY = "SELECT c.c_custkey, x.o_orderkey FROM dbo.customer c OUTER APPLY (SELECT TOP (1) o.o_orderkey FROM dbo.orders o WHERE o.o_custkey = c.c_custkey ORDER BY o.o_totalprice DESC, o.o_orderkey) x"


@query("SELECT c_custkey, x.o_orderkey FROM customer LEFT JOIN LATERAL (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) x ON true")
def tsql_apply_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, TSQL_APPLY, "mssql")


MYSQL_VIEW = """CREATE ALGORITHM=UNDEFINED DEFINER=`root`@`%` SQL SECURITY DEFINER VIEW `app`.`v_seg` AS SELECT `c`.`c_mktsegment` AS `seg`, COUNT(*) AS `n`, IFNULL(MAX(`c`.`c_acctbal`), 0) AS `top`, GROUP_CONCAT(DISTINCT `n`.`n_name` ORDER BY `n`.`n_name` SEPARATOR '/') AS `names`,
 IF(COUNT(*) > 300, 'many', 'few') AS `size`, DATE_FORMAT(DATE_ADD('1998-01-31', INTERVAL 1 MONTH), '%Y/%m/%d') AS `d`, MID('abcdef', 2, 3) AS `m`, SUBSTRING_INDEX('a.b.c', '.', 2) AS `i` FROM `app`.`customer` `c` JOIN `app`.`nation` `n` ON `n`.`n_nationkey` = `c`.`c_nationkey` GROUP BY `c`.`c_mktsegment`"""


@query("SELECT c_mktsegment AS seg, count(*)::BIGINT AS n, coalesce(max(c_acctbal), 0) AS top, string_agg(DISTINCT n_name, '/' ORDER BY n_name) AS names, CASE WHEN count(*) > 300 THEN 'many' ELSE 'few' END AS size, '1998/02/28' AS d, 'bcd' AS m, 'a.b' AS i FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def mysql_view_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, MYSQL_VIEW, "mysql")


ORACLE_VIEW = "CREATE OR REPLACE FORCE VIEW app.v_top AS SELECT /*+ PARALLEL(4) */ s.s_suppkey, NVL(s.s_name, 'none') AS nm, DECODE(MOD(s.s_suppkey, 3), 0, 'a', 1, 'b', 'c') AS g FROM app.supplier s WHERE s.s_acctbal > 0 AND ROWNUM <= 100000"


@query("SELECT s_suppkey, coalesce(s_name, 'none') AS nm, CASE s_suppkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS g FROM supplier WHERE s_acctbal > 0")
def oracle_view_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, ORACLE_VIEW, "oracle")


@query("SELECT 1 + 1 AS two")
def oracle_dual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT 1+1 AS two FROM SYS.DUAL", "oracle")


@query("SELECT event_type, count(*)::BIGINT AS n FROM events WHERE (user_id % 2 = 1) = true GROUP BY 1")
def boolean_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").withColumn("odd", F.col("user_id") % 2 == 1).createOrReplaceTempView("odd_events")
    return spark.sql(to_spark("SELECT e.event_type, COUNT_BIG(*) AS n FROM odd_events e WHERE e.odd = 1 GROUP BY e.event_type", "mssql", booleans={"odd"}))


SOURCE_TYPES = [("bit", "mssql", None, None), ("tinyint", "mssql", None, None), ("decimal", "mssql", 10, 2), ("timestamp", "mssql", None, None), ("NUMBER", "oracle", 9, 0), ("NUMBER", "oracle", 18, 0), ("NUMBER", "oracle", 20, 4), ("DATE", "oracle", None, None), ("money", "mssql", None, None), ("mediumint", "mysql", None, None), ("enum", "mysql", None, None), ("unheard_of", "mssql", None, None)]
WANTED = ["boolean", "smallint", "decimal(10,2)", "binary", "int", "bigint", "decimal(20,4)", "timestamp", "decimal(19,4)", "int", "string", "string"]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t[0]}', '{t[1]}', {i}, '{w}')" for i, (t, w) in enumerate(zip(SOURCE_TYPES, WANTED))) + ") t(type_name, source, place, spark_type)")
def type_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(t[0], t[1], i, catalog.spark_type(*t)) for i, t in enumerate(SOURCE_TYPES)]
    return spark.createDataFrame(rows, "type_name string, source string, place int, spark_type string")


FKS = [("fk1", 2, "orders", "b", "customer", "y"), ("fk1", 1, "orders", "a", "customer", "x"), ("fk2", 1, "nation", "r", "region", "k")]


@query("WITH f(name, ordinal, from_table, from_col, to_table, to_col) AS (VALUES " + ", ".join(str(x) for x in FKS) + ") SELECT name, from_table, to_table, string_agg(from_col, ',' ORDER BY ordinal) AS from_cols, string_agg(to_col, ',' ORDER BY ordinal) AS to_cols FROM f GROUP BY ALL")
def foreign_keys_by_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.foreign_keys(spark.createDataFrame(FKS, "name string, ordinal int, from_table string, from_col string, to_table string, to_col string"))


INDEXES = [("ix1", "orders", 1, "a", False, False), ("ix1", "orders", 2, "b", True, False), ("ix1", "orders", 3, "c", False, True), ("ix2", "nation", 1, "n", False, False)]


@query("WITH f(index_name, table_name, ordinal, column_name, is_desc, is_included) AS (VALUES " + ", ".join(str(x) for x in INDEXES) + ") SELECT index_name, table_name, coalesce(string_agg(column_name || CASE WHEN is_desc THEN ' DESC' ELSE '' END, ',' ORDER BY ordinal) FILTER (NOT is_included), '') AS columns, coalesce(string_agg(column_name, ',' ORDER BY ordinal) FILTER (is_included), '') AS include_cols FROM f GROUP BY ALL")
def index_columns_by_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.index_columns(spark.createDataFrame(INDEXES, "index_name string, table_name string, ordinal int, column_name string, is_desc boolean, is_included boolean"))


@query("SELECT table_name, (ordinal_position - 1)::INT AS place, column_name FROM (SELECT 'nation' AS table_name, unnest(range(1, 4)) AS ordinal_position, unnest(['n_nationkey', 'n_name', 'n_regionkey']) AS column_name UNION ALL SELECT 'region', unnest(range(1, 3)), unnest(['r_regionkey', 'r_name']))")
def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.columns_of(spark, {t: table(spark, sf_dir, t) for t in ("nation", "region")}).select("table_name", "place", "column_name")


LINES = [("p", 2, "b\n"), ("p", 1, "a\n"), ("p", 10, "c"), ("q", 1, "x")]


@query("SELECT * FROM (VALUES ('p', 'a' || chr(10) || 'b' || chr(10) || 'c'), ('q', 'x')) t(name, ddl)")
def catalog_source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.source_lines(spark.createDataFrame(LINES, "name string, line int, text string"))


TSQL_FUNCTION = "CREATE FUNCTION dbo.fn_net (@price DECIMAL(12,2), @rate INT = 10) RETURNS DECIMAL(12,2) AS BEGIN RETURN ISNULL(@price, 0) * (100 - @rate) / 100 END"
TSQL_TABLE_FUNCTION = "CREATE FUNCTION dbo.fn_of (@nation INT) RETURNS TABLE AS RETURN (SELECT c.c_custkey, LEN(c.c_name) AS n FROM dbo.customer c WHERE c.c_nationkey = @nation)"


@query("SELECT p_partkey, round(p_retailprice::DECIMAL(12,2) * 90 / 100, 2)::DOUBLE AS net, round(p_retailprice::DECIMAL(12,2) * 50 / 100, 2)::DOUBLE AS half FROM part")
def tsql_scalar_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.sql(function_to_spark(TSQL_FUNCTION, "mssql"))
    table(spark, sf_dir, "part").createOrReplaceTempView("part")
    return spark.sql("SELECT p_partkey, cast(fn_net(p_retailprice) AS double) AS net, cast(fn_net(p_retailprice, 50) AS double) AS half FROM part")


@query("SELECT n_name, c_custkey, len(c_name)::INT AS n FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_nationkey < 5")
def tsql_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    for t in ("customer", "nation"):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    spark.sql(function_to_spark(TSQL_TABLE_FUNCTION, "mssql", spark))
    return spark.sql("SELECT n_name, f.c_custkey, f.n FROM nation, LATERAL fn_of(n_nationkey) f WHERE n_nationkey < 5")


BODIES = [("p1", "SELECT * FROM t WHERE t.id = @id AND name = @p_name"), ("p2", "SELECT 1")]


@query("WITH b(name, body) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in BODIES) + ") SELECT name, array_to_string(list_transform(regexp_extract_all(body, '\\w+\\s*=\\s*@\\w+'), lambda x: replace(lower(x), ' ', '')), ';') AS pairs FROM b")
def parameter_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that a routine compares with its parameters."""
    pairs = F.transform(F.regexp_extract_all("body", F.lit(r"(\w+\s*=\s*@\w+)"), 1), lambda x: F.replace(F.lower(x), F.lit(" "), F.lit("")))
    return spark.createDataFrame(BODIES, "name string, body string").select("name", F.array_join(pairs, ";").alias("pairs"))
