"""Forms of other dialects that stand outside of calls, each rewritten and run over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .dialect_queries import run
from .registry import query, table
from .routines import table_function_to_spark


def views(spark: SparkSession, sf_dir: str) -> None:
    table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "nullif(c_custkey div 2, 0) AS up", "c_name").createOrReplaceTempView("staff")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 7 OFFSET 5")
def tsql_offset_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT o_orderkey, o_totalprice FROM dbo.orders ORDER BY o_totalprice DESC, o_orderkey OFFSET 5 ROWS FETCH NEXT 7 ROWS ONLY", "mssql")


@query("SELECT n_name, string_agg(c_name, ';' ORDER BY c_name DESC) AS names FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 5000 GROUP BY n_name, n_nationkey")
def tsql_for_xml_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts gathered by FOR XML PATH('') in a correlated subquery, the first separator taken away."""
    sql = "SELECT n.n_name, NULLIF(STUFF((SELECT ';' + c.c_name FROM dbo.customer c WHERE c.c_nationkey = n.n_nationkey AND c.c_acctbal > 5000 ORDER BY c.c_name DESC FOR XML PATH(''), TYPE).value('.', 'NVARCHAR(MAX)'), 1, 1, ''), '') AS names FROM dbo.nation n"
    return run(spark, sf_dir, sql, "mssql")


@query("SELECT event_id, json_extract_string(props, '$.k')::INT AS k, event_type FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def tsql_openjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT e.event_id, j.number AS k, e.event_type FROM dbo.events e CROSS APPLY OPENJSON(e.props) WITH (number INT '$.k', other NVARCHAR(20)) AS j WHERE j.number IS NOT NULL", "mssql")


@query("SELECT s_suppkey, 'name' AS what, s_name AS v FROM supplier UNION ALL SELECT s_suppkey, 'balance', CASE WHEN s_acctbal > 0 THEN 'in' ELSE 'out' END FROM supplier")
def tsql_apply_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT s.s_suppkey, v.what, v.v FROM dbo.supplier s CROSS APPLY (VALUES ('name', s.s_name), ('balance', IIF(s.s_acctbal > 0, 'in', 'out'))) AS v(what, v)", "mssql")


@query("SELECT p_partkey, '[' || replace(p_brand, ']', ']]') || ']' AS quoted, CASE p_size % 4 WHEN 1 THEN 'one' WHEN 2 THEN 'two' END AS chosen FROM part WHERE regexp_matches(p_name, '^[a-mA-M]') AND NOT regexp_matches(p_brand, '[^0-9a-zA-Z#]$')")
def tsql_classes_in_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT p_partkey, QUOTENAME(p_brand) AS quoted, CHOOSE(p_size % 4, 'one', 'two') AS chosen FROM dbo.part WHERE p_name LIKE '[a-mA-M]%' AND p_brand NOT LIKE N'%[^0-9a-zA-Z#]'", "mssql")


@query("SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS day FROM orders")
def tsql_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT o_orderkey, FORMAT(o_orderdate, 'dd/MM/yyyy') AS day FROM dbo.orders", "mssql")


@query("SELECT c_custkey, n_name, o_orderkey FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 100000 WHERE c_acctbal > 0")
def oracle_outer_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT c.c_custkey, n.n_name, o.o_orderkey FROM app.customer c, app.orders o, app.nation n WHERE c.c_custkey = o.o_custkey(+) AND o.o_totalprice(+) > 100000 AND n.n_nationkey = c.c_nationkey AND c.c_acctbal > 0", "oracle")


@query("SELECT o_custkey, max(o_totalprice) FILTER (o_orderdate = m) AS latest, count(*)::BIGINT AS n FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS m FROM orders) GROUP BY o_custkey")
def oracle_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT o.o_custkey, MAX(o.o_totalprice) KEEP (DENSE_RANK LAST ORDER BY o.o_orderdate) AS latest, COUNT(*) AS n FROM app.orders o GROUP BY o.o_custkey", "oracle")


@query("WITH RECURSIVE t AS (SELECT c_custkey AS k, '/' || c_custkey AS p FROM customer WHERE c_custkey = 1 UNION ALL SELECT c_custkey, p || '/' || c_custkey FROM customer JOIN t ON c_custkey // 2 = k AND c_custkey > 1) SELECT k, p FROM t")
def oracle_path_of_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir)
    return run(spark, sf_dir, "SELECT s.k, SYS_CONNECT_BY_PATH(s.k, '/') AS p FROM app.staff s START WITH s.k = 1 CONNECT BY PRIOR s.k = s.up", "oracle")


@query("SELECT s_suppkey, s_name FROM supplier ORDER BY s_acctbal, s_suppkey LIMIT 4")
def oracle_fetch_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT s_suppkey, s_name FROM app.supplier ORDER BY s_acctbal, s_suppkey FETCH FIRST 4 ROWS ONLY", "oracle")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, user_id::VARCHAR AS u, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 0 END::BIGINT AS place FROM events WHERE user_id > 10 AND value > 1 ORDER BY event_id LIMIT 20 OFFSET 30")
def mysql_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions by &&, paths of JSON by arrows, character sets, index hints and LIMIT with two numbers."""
    return run(spark, sf_dir, "SELECT `e`.`event_id`, e.props->>'$.k' AS k, CONVERT(e.user_id USING utf8mb4) AS u, FIELD(e.event_type, 'view', 'click') AS place FROM `app`.`events` e USE INDEX (by_user) WHERE e.user_id > 10 && e.value > 1 ORDER BY e.event_id LIMIT 30, 20", "mysql")


@query("SELECT n_regionkey, n_name, count(*)::BIGINT AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_regionkey, n_name)")
def mysql_with_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT n.n_regionkey, n.n_name, COUNT(*) AS n FROM app.nation n JOIN app.customer c ON c.c_nationkey = n.n_nationkey GROUP BY n.n_regionkey, n.n_name WITH ROLLUP", "mysql")


BANDS = """CREATE FUNCTION dbo.fn_bands (@region INT, @least DECIMAL(12,2) = 0) RETURNS @out TABLE (custkey BIGINT NOT NULL, band VARCHAR(10), balance FLOAT, PRIMARY KEY (custkey)) AS
BEGIN
  INSERT INTO @out (custkey, balance) SELECT c.c_custkey, c.c_acctbal FROM dbo.customer c JOIN dbo.nation n ON n.n_nationkey = c.c_nationkey WHERE n.n_regionkey = @region;
  UPDATE @out SET band = CASE WHEN balance > 5000 THEN 'high;' ELSE 'low' END, balance = ISNULL(balance, 0) WHERE balance > @least;
  DELETE FROM @out WHERE band IS NULL AND custkey % 2 = 0;
  INSERT INTO @out SELECT -MAX(custkey), 'last', COUNT(*) FROM @out;
  RETURN
END"""


@query("""WITH a AS (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN CASE WHEN c_acctbal > 5000 THEN 'high;' ELSE 'low' END END AS band, c_acctbal FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 2),
b AS (SELECT * FROM a WHERE NOT (band IS NULL AND c_custkey % 2 = 0)) SELECT c_custkey AS custkey, band, c_acctbal AS balance FROM b UNION ALL SELECT -max(c_custkey), 'last', count(*) FROM b""")
def tsql_many_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table function of several statements: rows put in, changed, taken out and counted."""
    run(spark, sf_dir, "SELECT 1 AS x", "mssql")
    spark.sql(table_function_to_spark(BANDS, "mssql"))
    return spark.sql("SELECT * FROM fn_bands(2)")


OF_KEYS = """CREATE FUNCTION dbo.fn_of_keys (@keys dbo.KeyList READONLY, @more INT) RETURNS @out TABLE (custkey BIGINT, balance FLOAT) AS
BEGIN
  INSERT @out SELECT c.c_custkey, c.c_acctbal + k.extra + @more FROM dbo.customer c JOIN @keys k ON k.id = c.c_nationkey;
  RETURN
END"""


@query("SELECT c_custkey AS custkey, c_acctbal + n_regionkey + 5 AS balance FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey < 2")
def tsql_table_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function with a table for a parameter, which gets it as an array (a list of keys that a caller gives; here some nations)."""
    run(spark, sf_dir, "SELECT 1 AS x", "mssql")
    spark.sql(table_function_to_spark(OF_KEYS, "mssql", {"KeyList": [("id", "int"), ("extra", "int")]}))
    keys = [f"named_struct('id', {r['n_nationkey']}, 'extra', {r['n_regionkey']})" for r in table(spark, sf_dir, "nation").where("n_regionkey < 2").collect()]
    return spark.sql(f"SELECT * FROM fn_of_keys(array({', '.join(keys)}), 5)")
