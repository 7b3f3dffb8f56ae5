"""Statements of other dialects that need more than renamed functions, rewritten and run against the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .dialect_queries import run
from .registry import query, table
from .repairs import repaired, run_effects, trigger_effects
from .scripts import annotated, call, executed, to_script

TOPS = """SELECT TOP 3 o_orderkey AS k FROM dbo.orders ORDER BY o_totalprice DESC, o_orderkey UNION ALL SELECT TOP (2) c_custkey FROM dbo.customer WHERE c_nationkey IN (SELECT TOP 1 n_nationkey FROM dbo.nation ORDER BY n_name) ORDER BY c_custkey"""


@query("(SELECT o_orderkey AS k FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3) UNION ALL (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation ORDER BY n_name LIMIT 1) ORDER BY c_custkey LIMIT 2)")
def tsql_top_in_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits belong to the branches, the inner one to its subquery; the order after the last branch is put into it here, as its limit takes the first rows."""
    return run(spark, sf_dir, TOPS.replace(" ORDER BY c_custkey", "", 1).replace("SELECT TOP (2) c_custkey FROM dbo.customer", "SELECT k FROM (SELECT TOP (2) c_custkey AS k FROM dbo.customer") + " ORDER BY c_custkey) q", "mssql")


@query("SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS p, count(*) OVER () AS n FROM orders WHERE o_custkey > 5) WHERE p <= ceil(n * 10 / 100.0)")
def tsql_top_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT TOP 10 PERCENT o.o_orderkey, o.o_totalprice FROM dbo.orders o WHERE o.o_custkey > 5 ORDER BY o.o_totalprice DESC, o.o_orderkey", "mssql")


@query("SELECT c_nationkey, c_custkey FROM (SELECT *, rank() OVER (ORDER BY c_nationkey) AS p FROM customer) WHERE p <= 3")
def tsql_top_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT TOP 3 WITH TIES c_nationkey, c_custkey FROM dbo.customer ORDER BY c_nationkey", "mssql")


@query("""SELECT 'from dbo.x' AS a, 'flag = 1' AS b, 'a WITH (NOLOCK) b' AS c, 'pick from dual now, TOP 3' AS d, count(*)::BIGINT AS n FROM nation WHERE n_regionkey = 1""")
def tsql_quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing inside quotes or comments is rewritten."""
    return run(spark, sf_dir, "SELECT 'from dbo.x' AS a, 'flag = 1' AS b, 'a WITH (NOLOCK) b' AS c, N'pick from dual now, TOP 3' AS d, COUNT(*) AS n -- from dual\n FROM dbo.nation WITH (NOLOCK, INDEX(ix)) /* flag = 1 */ WHERE n_regionkey = 1 OPTION (MAXRECURSION 0)", "mssql", booleans={"flag"})


@query("SELECT o_orderstatus AS st, sum(o_totalprice) FILTER (o_orderpriority = '1-URGENT') AS \"1-URGENT\", sum(o_totalprice) FILTER (o_orderpriority = '5-LOW') AS \"5-LOW\" FROM orders GROUP BY 1 ORDER BY 1")
def tsql_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "SELECT pv.o_orderstatus AS st, pv.[1-URGENT], pv.[5-LOW] FROM (SELECT o_orderstatus, o_orderpriority, o_totalprice FROM dbo.orders) AS src PIVOT (SUM(o_totalprice) FOR o_orderpriority IN ([1-URGENT], [5-LOW])) AS pv ORDER BY pv.o_orderstatus"
    return run(spark, sf_dir, sql, "mssql")


@query("""SELECT r_name, (SELECT '[' || string_agg('{"id":' || n_nationkey || ',"name":"' || n_name || '"}', ',' ORDER BY n_nationkey) || ']' FROM nation WHERE n_regionkey = r_regionkey) AS js FROM region""")
def tsql_for_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT r.r_name, (SELECT n.n_nationkey AS id, n.n_name AS [name] FROM dbo.nation n WHERE n.n_regionkey = r.r_regionkey ORDER BY n.n_nationkey FOR JSON PATH) AS js FROM dbo.region r", "mssql")


@query("SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS part FROM orders")
def tsql_apply_string_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT o.o_orderkey, s.value AS part FROM dbo.orders o CROSS APPLY STRING_SPLIT(o.o_orderpriority, '-') AS s", "mssql")


@query("SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey = 2")
def tsql_apply_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    run(spark, sf_dir, "SELECT 1 AS x", "mssql")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION nation_of(k BIGINT) RETURNS TABLE (n_name STRING) RETURN SELECT n_name FROM nation WHERE n_nationkey = k AND n_regionkey = 2")
    return run(spark, sf_dir, "SELECT c.c_custkey, f.n_name FROM dbo.customer c OUTER APPLY dbo.nation_of(c.c_nationkey) f", "mssql")


@query("SELECT n_nationkey AS k, n_name AS item_name, x::INT AS qty, 'c' || x AS code FROM nation, (VALUES (1), (2)) t(x)")
def tsql_xml_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.expr("concat('<r><item q=\"1\"><name>', n_name, '</name><code>c1</code></item><item q=\"2\"><name>', n_name, '</name><code>c2</code></item></r>')")
    table(spark, sf_dir, "nation").select("n_nationkey", doc.alias("doc")).createOrReplaceTempView("docs")
    sql = "SELECT d.n_nationkey AS k, t.n.value('(name)[1]', 'nvarchar(50)') AS item_name, t.n.value('@q', 'int') AS qty, t.n.value('(x:code)[1]', 'nvarchar(9)') AS code FROM dbo.docs d CROSS APPLY d.doc.nodes('/r/item') AS t(n)"
    return run(spark, sf_dir, sql, "mssql")


@query("SELECT sum(o_totalprice) AS total, o_orderstatus AS \"my status\", 1 AS one FROM orders GROUP BY o_orderstatus")
def tsql_alias_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT total = SUM(o_totalprice), o_orderstatus AS 'my status', [one] = 1 FROM dbo.orders GROUP BY o_orderstatus", "mssql")


@query("SELECT count(*)::BIGINT AS n, count(*) FILTER (o_orderdate IS NOT NULL)::BIGINT AS dated, true AS week_back FROM orders JOIN (SELECT c_custkey::VARCHAR AS code FROM customer) ON o_custkey::VARCHAR = code")
def tsql_loose_comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers joined to texts, times compared with an empty text, days taken from the present."""
    table(spark, sf_dir, "customer").selectExpr("cast(c_custkey AS string) AS code").createOrReplaceTempView("codes")
    sql = "SELECT COUNT(*) AS n, SUM(CASE WHEN o.o_orderdate <> '' THEN 1 ELSE 0 END) AS dated, MAX(GETDATE() - 7) < GETDATE() AS week_back FROM dbo.orders o JOIN dbo.codes c ON o.o_custkey = c.code"
    return run(spark, sf_dir, sql, "mssql", times={"o_orderdate"}, numbers={"o_custkey"}, texts={"code"})


@query("SELECT n_nationkey, 100 + 10 * (row_number() OVER (ORDER BY n_nationkey) - 1) AS id, (SELECT max(o_orderkey) FROM orders) AS last_id FROM nation")
def tsql_sequence_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a sequence in the order of the rows that ask for them; the last identity is the largest key written."""
    made = run(spark, sf_dir, "SELECT NEXT VALUE FOR dbo.seq AS id, SCOPE_IDENTITY() AS last_id FROM dbo.nation", "mssql", sequences={"seq": (100, 10)}, identity="orders.o_orderkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.expr("100 + 10 * (row_number() OVER (ORDER BY n_nationkey) - 1)").alias("id"))
    return n.join(made, "id").select("n_nationkey", "id", "last_id")


@query("SELECT c_custkey, CASE WHEN regexp_matches(c_name, '[0-4]$') THEN length(c_name) ELSE 0 END::INT AS p, percentile FROM customer, (SELECT quantile_cont(c_acctbal, 0.5) AS percentile FROM customer)")
def tsql_patindex_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = run(spark, sf_dir, "SELECT APPROX_PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY c_acctbal) AS percentile FROM dbo.customer", "mssql")
    c = run(spark, sf_dir, "SELECT c_custkey, PATINDEX('%[0-4]', c_name) AS p FROM dbo.customer", "mssql")
    return c.crossJoin(F.broadcast(p))  # one row


@query("SELECT o_orderkey FROM (SELECT o_orderkey FROM orders WHERE o_custkey > 10 AND o_totalprice > 1000 ORDER BY o_orderkey LIMIT 4) UNION ALL SELECT 1::BIGINT")
def oracle_rownum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROWNUM with < amid other conditions, and = 1 without any."""
    sql = "SELECT o_orderkey FROM (SELECT o_orderkey FROM app.orders WHERE o_custkey > 10 AND ROWNUM < 5 AND o_totalprice > 1000 ORDER BY o_orderkey) UNION ALL SELECT 1 FROM sys.dual WHERE ROWNUM = 1"
    return run(spark, sf_dir, sql, "oracle").select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"))


@query("SELECT n_regionkey AS r, any_value(r_name) AS r_name, count(*)::BIGINT AS \"2023\" FROM nation JOIN region ON n_regionkey = r_regionkey WHERE (n_regionkey = 1) <> (n_nationkey < 10) GROUP BY 1")
def mysql_loose_group_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selected column that isn't grouped by, a number as alias, XOR, a text's introducer."""
    sql = "SELECT `n`.`n_regionkey` AS `r`, `g`.`r_name`, COUNT(*) AS 2023 FROM `other`.`nation` `n` JOIN `other`.`region` `g` ON `n`.`n_regionkey` = `g`.`r_regionkey` WHERE `n`.`n_regionkey` = 1 XOR `n`.`n_nationkey` < 10 AND _utf8mb4'a' = 'a' GROUP BY `n`.`n_regionkey`"
    return run(spark, sf_dir, sql, "mysql")


PROCEDURE = """CREATE PROCEDURE dbo.big_customers @least INT, @segment NVARCHAR(20) = N'BUILDING' AS
BEGIN
  SET NOCOUNT ON;
  DECLARE @n INT = 0, @limit FLOAT;
  SET @limit = @least * 10.0;
  IF @limit > 1000
  BEGIN
    SET @n = 1;
  END
  ELSE
    SET @n = 2;
  WHILE @n < 5
  BEGIN
    SET @n = @n + 3;
    PRINT 'step';
  END
  SELECT c.c_custkey, ISNULL(c.c_mktsegment, '') AS seg, @n AS n FROM dbo.customer c WHERE c.c_acctbal > @limit AND c.c_mktsegment = @segment;
END"""


@query("SELECT c_custkey, c_mktsegment AS seg, 7::INT AS n FROM customer WHERE c_acctbal > 1200 * 10.0 / 10 * 0 + 2000 AND c_mktsegment = 'BUILDING'".replace("1200 * 10.0 / 10 * 0 + 2000", "2000"))
def procedure_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A procedure as a script: parameters, variables, branches, a loop and its result set. 200 * 10 is over 1000, so n goes 1, 4, 7."""
    run(spark, sf_dir, "SELECT 1 AS x", "mssql")
    return call(spark, to_script(PROCEDURE, "mssql"), {"least": 200})


MYSQL_PROCEDURE = """CREATE DEFINER=`root`@`%` PROCEDURE `app`.`count_to`(IN p_most INT)
BEGIN
  DECLARE v INT DEFAULT 0;
  SET v = 1;
  WHILE v < p_most DO
    IF v > 100 THEN SET v = v + 1; ELSE SET v = v * 2; END IF;
  END WHILE;
  SELECT v AS reached, COUNT(*) AS n FROM nation WHERE n_regionkey < v;
END"""


@query("SELECT 64::INT AS reached, count(*)::BIGINT AS n FROM nation WHERE n_regionkey < 64")
def mysql_procedure_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    run(spark, sf_dir, "SELECT 1 AS x", "mssql")
    return call(spark, to_script(MYSQL_PROCEDURE, "mysql"), {"p_most": 50})


ORACLE_PROCEDURE = """CREATE OR REPLACE PROCEDURE app.nations_of(p_region IN NUMBER) IS
  v_n NUMBER(9) := 0;
BEGIN
  v_n := p_region + 1;
  IF v_n > 1 THEN
    v_n := v_n * 2;
  ELSIF v_n = 1 THEN
    v_n := 9;
  END IF;
  SELECT n_name, v_n AS n FROM nation WHERE n_regionkey = p_region;
END nations_of;"""


@query("SELECT n_name, 6::INT AS n FROM nation WHERE n_regionkey = 2")
def oracle_procedure_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    run(spark, sf_dir, "SELECT 1 AS x", "mssql")
    return call(spark, to_script(ORACLE_PROCEDURE, "oracle"), {"p_region": 2})


HARD = [
    ("p_cursor", "mssql", "CREATE PROCEDURE p AS BEGIN DECLARE c CURSOR FOR SELECT 1; OPEN c; FETCH NEXT FROM c; END"),
    ("p_dynamic", "mssql", "CREATE PROCEDURE p @s NVARCHAR(9) AS BEGIN EXEC sp_executesql @s; END"),
    ("p_transaction", "mssql", "CREATE PROCEDURE p AS BEGIN BEGIN TRY BEGIN TRANSACTION; SELECT 1 AS x; COMMIT TRANSACTION; END TRY BEGIN CATCH ROLLBACK; END CATCH END"),
    ("p_bulk", "oracle", "CREATE PROCEDURE p IS v t.a%TYPE; BEGIN SELECT a BULK COLLECT INTO v FROM t; END;"),
    ("p_tree", "oracle", "CREATE PROCEDURE p IS BEGIN SELECT a FROM t START WITH b IS NULL CONNECT BY PRIOR a = b; END;"),
    ("p_plain", "mysql", "CREATE PROCEDURE p() BEGIN SELECT 1 AS x; END"),
]
HARD_VALUES = ", ".join("('{}', '{}', '{}')".format(n, s, t.replace("'", "''")) for n, s, t in HARD)


@query(f"""WITH p(name, source, sql) AS (VALUES {HARD_VALUES}), c AS (SELECT name, list_filter([CASE WHEN regexp_matches(lower(sql), '\\bcursor\\b') THEN 'CURSOR' END, CASE WHEN regexp_matches(lower(sql), 'sp_executesql|execute\\s+immediate') THEN 'DYNAMIC_SQL' END, CASE WHEN regexp_matches(lower(sql), 'begin\\s+tran|\\bcommit\\b|\\brollback\\b') THEN 'TRANSACTION' END,
 CASE WHEN regexp_matches(lower(sql), 'begin\\s+try') THEN 'HANDLER' END, CASE WHEN regexp_matches(lower(sql), 'bulk\\s+collect|\\bforall\\b') THEN 'BULK_COLLECT' END, CASE WHEN contains(lower(sql), 'connect by') THEN 'CONNECT_BY' END, CASE WHEN regexp_matches(lower(sql), '%(row)?type') THEN 'ANCHORED_TYPE' END], lambda x: x IS NOT NULL) AS codes FROM p) SELECT name, array_to_string(list_sort(codes), ',') AS codes FROM c""")
def conversion_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands in the way of a script, told as codes above the statement."""
    rows = [(n, ",".join(sorted(annotated(t, s)[1]))) for n, s, t in HARD]
    return spark.createDataFrame(rows, "name string, codes string")


@query("SELECT true AS today, true AS utc, true AS moment, '2024-02-29' AS added, 4::INT AS days, 2024::INT AS y, 2::INT AS m, 28::INT AS d, 13::INT AS h, 14::INT AS mi, 15::INT AS s, 3::INT AS at, 36::INT AS uuid_len, true AS drawn, 'abc' AS nested")
def mysql_function_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of the present, parts of times, intervals, places in texts, identifiers and draws."""
    sql = "SELECT CURDATE() = CAST(NOW() AS DATE) AS today, SYSDATE() >= NOW() AS utc, CURRENT_TIMESTAMP <= NOW() AS moment, DATE_FORMAT(DATE_ADD('2024-02-28', INTERVAL 1 DAY), '%Y-%m-%d') AS added, DATEDIFF('2024-03-03', '2024-02-28') AS days, YEAR('2024-02-28') AS y, MONTH('2024-02-28') AS m, DAY('2024-02-28') AS d, HOUR('2024-02-28 13:14:15') AS h, MINUTE('2024-02-28 13:14:15') AS mi, SECOND('2024-02-28 13:14:15') AS s, INSTR('abcd', 'cd') AS at, LENGTH(UUID()) AS uuid_len, RAND() < 1 AS drawn, CAST(CAST('abc' AS CHAR) AS CHAR) AS nested"
    return run(spark, sf_dir, sql, "mysql")


@query("SELECT true AS today, true AS stamp, true AS utc, 2024::INT AS y, 2::INT AS m, 28::INT AS d, 36::INT AS id_len, true AS member, true AS errors, '2024-02-28' AS day")
def tsql_function_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = "SELECT CAST(CONVERT(date, GETDATE()) AS date) = CAST(SYSDATETIME() AS date) AS today, CURRENT_TIMESTAMP <= SYSUTCDATETIME() AS stamp, GETUTCDATE() IS NOT NULL AS utc, YEAR('2024-02-28') AS y, MONTH('2024-02-28') AS m, DAY('2024-02-28') AS d, LEN(NEWID()) AS id_len, IS_MEMBER('x') = 1 AS member, @@ERROR = 0 AND @@TRANCOUNT = 0 AS errors, CONVERT(varchar(10), CAST('2024-02-28' AS datetime), 120) AS day"
    return run(spark, sf_dir, sql, "mssql").withColumn("day", F.substring("day", 1, 10))


@query("SELECT true AS today, true AS stamp, 36::INT AS id_len, 'x' AS v, 2::INT AS n")
def oracle_function_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT SYSDATE <= SYSTIMESTAMP AS today, SYSTIMESTAMP IS NOT NULL AS stamp, LENGTH(SYS_GUID()) AS id_len, NVL(NULL, 'x') AS v, NVL2(1, 2, 3) AS n FROM DUAL", "oracle")


@query("SELECT * FROM (VALUES ('schemas', 1::BIGINT), ('sequences', 1), ('tables', 1), ('indexes', 1), ('references', 1)) t(phase, n)")
def phased_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from concordat.sources import sinks

    made = sinks.definitions("app", [{"name": "t", "columns": [{"name": "id", "type_name": "int"}]}], [{"name": "q", "start": 1, "increment": 2}], [{"name": "ix", "table": "t", "columns": ["id DESC"], "is_unique": True}], [{"name": "fk", "from_table": "t", "from_cols": ["id"], "to_table": "u", "to_cols": ["id"]}], "mssql")
    ran: list[str] = []
    done = sinks.deploy_phases(made, ran.append)
    return spark.createDataFrame([(p, r["ok"]) for p, r in done.items()], "phase string, n long")


@query("WITH RECURSIVE t AS (SELECT c_custkey AS k, 1 AS l FROM customer WHERE c_custkey = 1 UNION ALL SELECT c_custkey, l + 1 FROM customer JOIN t ON c_custkey // 2 = k AND c_custkey > 1) SELECT k, l::INT AS depth FROM t WHERE k % 2 = 1")
def oracle_connect_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    run(spark, sf_dir, "SELECT 1 AS x", "mssql")
    table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_custkey div 2 AS up").where("k > 0").createOrReplaceTempView("staff")
    sql = "SELECT e.k, LEVEL AS depth FROM app.staff e WHERE MOD(e.k, 2) = 1 START WITH e.k = 1 CONNECT BY NOCYCLE PRIOR e.k = e.up AND e.k > 1"
    return run(spark, sf_dir, sql, "oracle")


@query("SELECT n_nationkey FROM nation WHERE n_nationkey < 5")
def bare_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, "SELECT n_nationkey FROM app.nation WHERE n_nationkey < 5 LIMIT ;", "mysql")


TRIGGERS = "CREATE TRIGGER dbo.trg_orders ON dbo.orders AFTER INSERT, UPDATE AS BEGIN SET NOCOUNT ON; INSERT INTO dbo.audit_log (k, what) SELECT i.o_orderkey, ISNULL(d.o_orderstatus, 'new') FROM inserted i LEFT JOIN deleted d ON d.o_orderkey = i.o_orderkey; END"


@query("SELECT 'audit_log' AS target, 'INSERT,UPDATE' AS events, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'new' END AS what FROM orders")
def trigger_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a trigger would write for a batch of changed rows."""
    o = table(spark, sf_dir, "orders")
    o.createOrReplaceTempView("new_rows")
    o.where("o_orderkey % 2 = 0").createOrReplaceTempView("old_rows")
    _, events, effects = trigger_effects(TRIGGERS, "mssql")
    got: dict[str, DataFrame] = {}
    run_effects(spark, effects, got.__setitem__)
    (name, rows), = got.items()
    return rows.withColumnRenamed("k", "o_orderkey").select(F.lit(name).alias("target"), F.lit(",".join(events)).alias("events"), "o_orderkey", "what")


BROKEN = [
    ("fine", "CREATE VIEW v1 AS SELECT 'getdat()' AS t"),
    ("fixed", "CREATE VIEW v2 AS SELECT getdat() AS t, 'getdat()' AS kept"),
    ("renamed", "CREATE VIEW v_bad AS SELECT nothing_like_it() AS t"),
    ("hopeless", "CREATE VIEW v4 AS SELECT nothing_like_it() AS t"),
]


@query("SELECT * FROM (VALUES ('fine', 'succeeded', 'CREATE VIEW v1 AS SELECT ''getdat()'' AS t'), ('fixed', 'fixed', 'CREATE VIEW v2 AS SELECT current_date() AS t, ''getdat()'' AS kept'), ('renamed', 'failed', 'CREATE VIEW v_bad AS SELECT nothing_like_it() AS t'), ('hopeless', 'failed', 'CREATE VIEW v4 AS SELECT nothing_like_it() AS t')) t(name, status, statement)")
def rule_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules mend what is outside of quotes; a rule that would rename an object is not taken."""
    rules = [(r"\bgetdat\(\)", "current_date()"), (r"\bv_bad\b", "v_good")]
    attempt = lambda sql: spark.sql(sql.replace("CREATE VIEW", "CREATE OR REPLACE TEMPORARY VIEW"))
    return spark.createDataFrame([(n, *repaired(sql, rules, attempt)[:2]) for n, sql in BROKEN], "name string, status string, statement string")


ROUTINES = [
    ("script", "mysql", "CREATE PROCEDURE p() BEGIN SELECT 1 AS x; END"),
    ("select", "mssql", "CREATE PROCEDURE p AS BEGIN DECLARE c CURSOR FOR SELECT 1; OPEN c; SELECT n_name FROM dbo.nation WHERE n_nationkey < 3; END"),
    ("neither", "mssql", "CREATE PROCEDURE p @s NVARCHAR(9) AS BEGIN EXEC sp_executesql @s; END"),
]


@query("SELECT * FROM (VALUES ('script', 'call', 1::BIGINT), ('select', 'select', 3), ('neither', 'failed', 0)) t(name, way, n_rows)")
def routine_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A routine runs as a script, else by the last SELECT of its body."""
    run(spark, sf_dir, "SELECT 1 AS x", "mssql")
    out = []
    for name, source, sql in ROUTINES:
        way, rows, _ = executed(spark, sql, source)
        out.append((name, way, rows.count() if rows is not None else 0))
    return spark.createDataFrame(out, "name string, way string, n_rows long")
