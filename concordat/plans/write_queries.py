"""Routines that write, run as transitions over the given tables, and routines and their counterparts compared by what they leave behind."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.operators.durable import shared_folder
from concordat.sources.dumps import insert_lines, statements, table_rows, text_lines
from concordat.sources.ledger import Ledger
from concordat.streaming.triggers import TriggerStream

from .registry import query, table
from .transitions import Tables, compare_routines, run_routine

SETTLE = """CREATE PROCEDURE dbo.settle @least DECIMAL(12,2), @day DATE = '1995-06-01' AS
BEGIN
  SET NOCOUNT ON;
  DECLARE @n INT = 0;
  BEGIN TRY
    BEGIN TRANSACTION;
    UPDATE o SET o.o_orderstatus = 'X', o_totalprice = o.o_totalprice * 2 FROM dbo.orders o JOIN dbo.customer c ON c.c_custkey = o.o_custkey WHERE c.c_acctbal < @least AND o.o_orderdate < @day;
    SET @n = @@ROWCOUNT;
    UPDATE dbo.orders SET o_orderstatus = CASE WHEN o_totalprice > 100000 THEN 'B' ELSE 'S' END WHERE o_orderstatus = 'O';
    DELETE FROM dbo.orders WHERE o_totalprice < 5000;
    DELETE o FROM dbo.orders o INNER JOIN dbo.customer AS c ON o.o_custkey = c.c_custkey WHERE c.c_mktsegment = 'BUILDING' AND o.o_orderkey % 7 = 0;
    SELECT o_custkey, COUNT(*) AS n INTO #many FROM dbo.orders GROUP BY o_custkey;
    INSERT INTO dbo.orders (o_orderkey, o_custkey, o_orderstatus, o_totalprice) SELECT -m.o_custkey, m.o_custkey, 'N', m.n FROM #many m WHERE m.n > 12;
    MERGE INTO dbo.customer AS t USING (SELECT o_custkey, SUM(o_totalprice) AS s FROM dbo.orders GROUP BY o_custkey) AS q ON t.c_custkey = q.o_custkey
      WHEN MATCHED AND q.s > 1000000 THEN UPDATE SET c_acctbal = t.c_acctbal + 1, c_mktsegment = 'GOLD'
      WHEN MATCHED AND t.c_custkey % 10 = 0 THEN DELETE
      WHEN NOT MATCHED BY TARGET THEN INSERT (c_custkey, c_name) VALUES (q.o_custkey, 'new')
      WHEN NOT MATCHED BY SOURCE AND t.c_acctbal < 0 THEN DELETE;
    IF @n > 100000000 ROLLBACK TRANSACTION; ELSE COMMIT TRANSACTION;
  END TRY
  BEGIN CATCH
    ROLLBACK TRANSACTION;
    THROW;
  END CATCH
  SELECT @n AS n;
END"""
#: The states that SETTLE goes through, for DuckDB.
STATES = """WITH o1 AS (SELECT o.*, coalesce(c_acctbal < 0 AND o_orderdate < DATE '1995-06-01', false) AS hit FROM orders o LEFT JOIN customer ON c_custkey = o_custkey),
o2 AS (SELECT * EXCLUDE (hit) REPLACE (CASE WHEN hit THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN hit THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice) FROM o1),
o3 AS (SELECT * REPLACE (CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus WHEN o_totalprice > 100000 THEN 'B' ELSE 'S' END AS o_orderstatus) FROM o2),
o4 AS (SELECT * FROM o3 WHERE NOT o_totalprice < 5000),
o5 AS (SELECT o4.* FROM o4 LEFT JOIN customer ON c_custkey = o_custkey WHERE NOT coalesce(c_mktsegment = 'BUILDING' AND o_orderkey % 7 = 0, false)),
o6 AS (SELECT * FROM o5 UNION ALL BY NAME SELECT -o_custkey AS o_orderkey, o_custkey, 'N' AS o_orderstatus, count(*)::DOUBLE AS o_totalprice FROM o5 GROUP BY o_custkey HAVING count(*) > 12),
q AS (SELECT o_custkey, sum(o_totalprice) AS s FROM o6 GROUP BY o_custkey),
c1 AS (SELECT c.*, q.*, CASE WHEN o_custkey IS NOT NULL AND c_custkey IS NOT NULL AND s > 1000000 THEN 'updated' WHEN o_custkey IS NOT NULL AND c_custkey IS NOT NULL AND c_custkey % 10 = 0 THEN 'deleted' WHEN c_custkey IS NULL THEN 'inserted'
  WHEN o_custkey IS NULL AND c_acctbal < 0 THEN 'deleted' ELSE 'kept' END AS what FROM customer c FULL OUTER JOIN q ON c_custkey = o_custkey)
"""


def settled(spark: SparkSession, sf_dir: str) -> Tables:
    tables = Tables(spark, "mssql", {n: table(spark, sf_dir, n) for n in ("orders", "customer")})
    run_routine(tables, SETTLE, {"least": 0})
    return tables


@query(STATES + "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM o6")
def written_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders after updates, deletes and inserts of a procedure."""
    return settled(spark, sf_dir).frames["orders"].selectExpr("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "date_format(o_orderdate, 'yyyy-MM-dd') AS o_orderdate")


@query(STATES + "SELECT coalesce(c_custkey, o_custkey) AS c_custkey, CASE what WHEN 'inserted' THEN 'new' ELSE c_name END AS c_name, c_acctbal + CASE what WHEN 'updated' THEN 1 ELSE 0 END AS c_acctbal, CASE what WHEN 'updated' THEN 'GOLD' ELSE c_mktsegment END AS c_mktsegment FROM c1 WHERE what <> 'deleted'")
def merged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer after a MERGE that updates, deletes and inserts."""
    return settled(spark, sf_dir).frames["customer"].select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query(STATES + """SELECT 1::INT AS step, 'orders' AS table_name, 0::BIGINT AS inserted, count_if(hit)::BIGINT AS updated, 0::BIGINT AS deleted FROM o1
UNION ALL SELECT 2, 'orders', 0, count_if(o_orderstatus = 'O'), 0 FROM o2 UNION ALL SELECT 3, 'orders', 0, 0, count_if(o_totalprice < 5000) FROM o3 UNION ALL SELECT 4, 'orders', 0, 0, (SELECT count(*) FROM o4) - (SELECT count(*) FROM o5)
UNION ALL SELECT 5, 'orders', (SELECT count(*) FROM o6) - (SELECT count(*) FROM o5), 0, 0 UNION ALL SELECT 6, 'customer', count_if(what = 'inserted'), count_if(what = 'updated'), count_if(what = 'deleted') FROM c1""")
def rows_taken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each write of a procedure inserted, updated and deleted."""
    return spark.createDataFrame(settled(spark, sf_dir).taken, "step int, table_name string, inserted long, updated long, deleted long")


MYSQL_RAISE = """CREATE DEFINER=`root`@`%` PROCEDURE `app`.`raise_all`(IN p_by INT)
BEGIN
  DECLARE EXIT HANDLER FOR SQLEXCEPTION BEGIN ROLLBACK; END;
  START TRANSACTION;
  UPDATE supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey SET s.s_acctbal = s.s_acctbal + p_by WHERE n.n_regionkey < 3;
  DELETE FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier);
  INSERT INTO nation (n_nationkey, n_name, n_regionkey) VALUES (100, 'ATLANTIS', p_by), (101, 'MU', NULL);
  COMMIT;
END"""
ORACLE_RAISE = """CREATE OR REPLACE PROCEDURE app.raise_all(p_amount IN NUMBER) IS
  v_n NUMBER(9) := 0;
BEGIN
  MERGE INTO supplier s USING (SELECT n_nationkey FROM nation WHERE n_regionkey < 3) n ON (s.s_nationkey = n.n_nationkey) WHEN MATCHED THEN UPDATE SET s.s_acctbal = s.s_acctbal + p_amount;
  DELETE FROM nation n WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey = n.n_nationkey);
  v_n := SQL%ROWCOUNT;
  IF v_n >= 0 THEN
    INSERT INTO nation (n_nationkey, n_name, n_regionkey) SELECT 100, 'ATLANTIS', p_amount FROM DUAL UNION ALL SELECT 101, 'MU', NULL FROM DUAL;
  END IF;
  COMMIT;
END raise_all;"""
#: As the others, but for suppliers of one region more.
WRONG_RAISE = ORACLE_RAISE.replace("n_regionkey < 3", "n_regionkey < 4")
#: A MERGE in which a supplier meets all orders of its key's remainder, and its counterpart on a table that isn't there.
TWICE = "CREATE PROCEDURE p AS BEGIN MERGE INTO supplier s USING nation n ON s.s_suppkey > n.n_nationkey WHEN MATCHED THEN UPDATE SET s_acctbal = 0; END"
LOST = "CREATE PROCEDURE p() BEGIN UPDATE no_such_table SET a = 1; END"


@query("""SELECT 'same' AS run, 'nation' AS table_name, 'PASS_WRITE_PROC' AS verdict UNION ALL SELECT 'same', 'supplier', 'PASS_WRITE_PROC' UNION ALL SELECT 'wrong', 'nation', 'PASS_WRITE_PROC'
UNION ALL SELECT 'wrong', 'supplier', CASE WHEN count(*) > 0 THEN 'FAIL_HASH' ELSE 'PASS_WRITE_PROC' END FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = 3
UNION ALL SELECT 'both', '', CASE WHEN max(n) > 1 THEN 'WRITE_EXPECTED_FAIL' ELSE 'FAIL_TARGET' END FROM (SELECT count(*) AS n FROM supplier JOIN nation ON s_suppkey > n_nationkey GROUP BY s_suppkey)""")
def write_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A routine against its counterpart of another dialect: the same, one that goes wrong, and two that fail."""
    make = lambda source: Tables(spark, source, {n: table(spark, sf_dir, n) for n in ("supplier", "nation")})
    runs = [("same", (MYSQL_RAISE, "mysql"), (ORACLE_RAISE, "oracle"), {"p_by": 7}), ("wrong", (MYSQL_RAISE, "mysql"), (WRONG_RAISE, "oracle"), {"p_by": 7}), ("both", (TWICE, "mssql"), (LOST, "mysql"), {})]
    rows = [(run, t, v) for run, a, b, given in runs for t, v, _ in compare_routines(make, a, b, given, {"p_by": "p_amount"})]
    return spark.createDataFrame(rows, "run string, table_name string, verdict string")


@query("SELECT 1::BIGINT AS run_number, count(*)::BIGINT AS total, count(*) FILTER (o_orderkey % 3 = 0)::BIGINT AS passed, count(*) FILTER (o_orderkey % 3 = 1)::BIGINT AS failed, count(*) FILTER (o_orderkey % 3 = 2)::BIGINT AS skipped, 'COMPLETE' AS status FROM orders UNION ALL SELECT 3, 0, 0, 0, 0, 'EMPTY'")
def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs begun, of which two are complete: the third's results aren't seen."""
    ledger = Ledger(spark, f"{shared_folder(spark)}/runs-{uuid.uuid4().hex}")
    results = table(spark, sf_dir, "orders").select("o_orderkey", F.element_at(F.array(*map(F.lit, ("PASS", "FAIL", "SKIPPED"))), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("verdict"))
    first, second, third = (ledger.begin("app", "target", ["s"]) for _ in range(3))
    for number, rows in ((first, results), (second, results), (third, results.limit(0))):
        ledger.write(number, "results", rows)
    for number in (first, third):
        ledger.complete(number, ["PASS"], ["SKIPPED"])
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return ledger.runs().select("run_number", *map(zero, ("total", "passed", "failed", "skipped")), "status")


AUDIT = "CREATE TRIGGER dbo.trg_orders ON dbo.orders AFTER INSERT, UPDATE AS BEGIN SET NOCOUNT ON; INSERT INTO dbo.audit_log (what, k) SELECT ISNULL(d.o_orderstatus, 'new;'), i.o_orderkey FROM inserted i LEFT JOIN deleted d ON d.o_orderkey = i.o_orderkey; END"


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 1 THEN o_orderstatus ELSE 'new;' END AS what FROM orders WHERE o_orderkey % 3 <> 2")
def trigger_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trigger's effects on three batches of changes, each of which comes twice: inserts, updates, and deletes that the trigger doesn't name."""
    stream = TriggerStream(spark, f"{shared_folder(spark)}/trigger-{uuid.uuid4().hex}", AUDIT, "mssql")
    row = F.struct("o_orderkey", "o_orderstatus")
    none = F.lit(None).cast("struct<o_orderkey: bigint, o_orderstatus: string>")
    orders = table(spark, sf_dir, "orders")
    for batch, (op, new, old) in enumerate((("INSERT", row, none), ("UPDATE", row, row), ("DELETE", none, row))):
        changes = orders.where(F.col("o_orderkey") % 3 == batch).select(F.lit(op).alias("op"), new.alias("new"), old.alias("old"))
        for _ in range(2):
            stream.run_batch(changes, batch)
    return stream.written("audit_log", "what string, k bigint")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority || ' it''s; ' || chr(10) || 'more' AS note FROM orders")
def dump_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as a dump of INSERT statements, whose texts hold quotes, semicolons and line breaks, and read back from splits of 256 KB."""
    orders = table(spark, sf_dir, "orders").withColumns({"note": F.concat("o_orderpriority", F.lit(" it's; \nmore")), "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")}).drop("o_orderpriority")
    path = f"{shared_folder(spark)}/dump-{uuid.uuid4().hex}"
    insert_lines(orders, "app.orders", "mysql").write.option("lineSep", "\n").text(path)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        found = statements(text_lines(spark, path), "mysql")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    return table_rows(found, "mysql", "orders", "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate string, note string")
