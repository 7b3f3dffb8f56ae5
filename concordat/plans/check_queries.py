"""Queries of structural checks, ledgers and predicates found in statements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.operators import catalog, scan, witness
from concordat.sources import sinks

from .registry import query, table

NAMES = ["aspnet_users_get", "tmp_fix_1", "GetOrders", "old_import", "sp_backup"]
GROUPS = [("membership", "^aspnet_"), ("temporary", "^tmp_|^old_"), ("maintenance", "^sp_")]


@query("SELECT n AS name, CASE WHEN lower(n) LIKE 'aspnet\\_%' ESCAPE '\\' THEN 'membership' WHEN regexp_matches(lower(n), '^tmp_|^old_') THEN 'temporary' WHEN starts_with(lower(n), 'sp_') THEN 'maintenance' ELSE 'current' END AS grp FROM (VALUES " + ", ".join(f"('{n}')" for n in NAMES) + ") t(n)")
def legacy_routines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in NAMES], "name string").select("name", scan.routine_group(F.col("name"), GROUPS).alias("grp"))


SQLS = [("v1", "SELECT * FROM a x JOIN b y ON x.id = y.id WHERE x.status = 'open' AND y.n >= 10"), ("v2", "SELECT 1"), ("v3", "SELECT * FROM t WHERE t.d <> 'a b' OR t.k = -3.5")]
SQL_VALUES = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in SQLS)


@query(f"WITH v(name, s) AS (VALUES {SQL_VALUES}) SELECT name, array_to_string(regexp_extract_all(s, '(\\w+\\.\\w+\\s*(?:=|<>|!=|<=|>=|<|>)\\s*(?:''[^'']*''|-?\\d+(?:\\.\\d+)?))', 1), ';') AS predicates FROM v")
def predicate_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(SQLS, "name string, s string").select("name", F.array_join(witness.predicate_columns(F.col("s")), ";").alias("predicates"))


@query("WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 4 <> 0 END AS expected, c_custkey % 11 = 0 AS failed FROM customer), o AS (SELECT o_custkey AS k, count(*)::BIGINT AS n FROM orders GROUP BY 1) SELECT status, count(*)::BIGINT AS n FROM (SELECT CASE WHEN expected IS NULL THEN 'unsupported' WHEN failed THEN 'failed' WHEN NOT expected THEN 'skipped' WHEN coalesce(o.n, 0) > 0 THEN 'validated' ELSE 'partial' END AS status FROM c LEFT JOIN o USING (k)) GROUP BY 1")
def chain_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey % 4 <> 0 END AS expected", "c_custkey % 11 = 0 AS failed")
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    status = witness.chain_status(F.col("expected"), F.coalesce("n", F.lit(0)), F.col("failed"))
    return c.join(n, "k", "left").select(status.alias("status")).groupBy("status").agg(F.count("*").alias("n"))


LEDGER = {"views": 6, "functions": 4, "procedures": 10}


@query(" UNION ALL ".join(f"SELECT '{p}' AS phase, 'o' || o_orderkey AS object_name, 'error ' || (o_orderkey % 3) AS error FROM orders WHERE o_orderkey % {1000 + m} = 0" for p, m in LEDGER.items()))
def failure_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of all phases in one table."""
    o = table(spark, sf_dir, "orders")
    rows = [o.where(F.col("o_orderkey") % (1000 + m) == 0).select(F.lit(p).alias("phase"), F.concat(F.lit("o"), F.col("o_orderkey")).alias("object_name"), F.concat(F.lit("error "), F.col("o_orderkey") % 3).alias("error")) for p, m in LEDGER.items()]
    return reduce(DataFrame.unionByName, rows)


CHECKS = ["nation", "region", "orders"]


@query("SELECT * FROM (VALUES ('nation', 3::BIGINT, 3::BIGINT, true), ('region', 2, 2, true), ('orders', 6, 5, false)) t(table_name, source_n, target_n, passed)")
def schema_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column counts of both sides, from schemas alone."""
    source = catalog.columns_of(spark, {t: table(spark, sf_dir, t) for t in CHECKS}).groupBy("table_name").agg(F.count("*").alias("source_n"))
    target = catalog.columns_of(spark, {t: table(spark, sf_dir, t).drop("o_orderpriority") for t in CHECKS}).groupBy("table_name").agg(F.count("*").alias("target_n"))
    return source.join(target, "table_name", "left").withColumn("passed", F.col("source_n") == F.col("target_n"))


@query("SELECT 'nation' AS t, string_agg(n_nationkey || chr(9) || n_name || chr(9) || CASE WHEN n_regionkey = 1 THEN 't' ELSE 'f' END || chr(9) || '\\N', chr(10) ORDER BY n_nationkey) AS body FROM nation")
def bulk_load_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of a bulk load of a small table."""
    n = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "n_name", "n_regionkey = 1 AS first", "cast(NULL AS string) AS none")
    lines = sinks.bulk_fields(n).select("value", F.split("value", "\t")[0].cast("int").alias("k"))
    return lines.agg(F.array_sort(F.collect_list(F.struct("k", "value"))).alias("x")).select(F.lit("nation").alias("t"), F.array_join("x.value", "\n").alias("body"))


@query("SELECT (o_orderkey % 7)::INT AS run_number, count(*)::BIGINT AS total, count(*) FILTER (o_orderkey % 3 = 0)::BIGINT AS passed, count(*) FILTER (o_orderkey % 3 = 1)::BIGINT AS skipped, count(*) FILTER (o_orderkey % 3 = 2)::BIGINT AS failed FROM orders GROUP BY 1")
def run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "orders").selectExpr("cast(o_orderkey % 7 AS int) AS run_number", "element_at(array('PASS', 'SKIPPED', 'FAIL'), cast(o_orderkey % 3 AS int) + 1) AS verdict")
    return sinks.run_row(r, ["PASS"], ["SKIPPED"])


@query("SELECT c_custkey, '***' AS api_token, c_name FROM customer")
def redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.redacted(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("api_token"), "c_name"))


@query("SELECT table_name, n FROM (SELECT *, row_number() OVER (ORDER BY table_name) AS p FROM (SELECT 'T' || (o_custkey % 60) AS table_name, count(*)::BIGINT AS n FROM orders GROUP BY 1)) WHERE p <= 30")
def structural_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column checks of the first thirty tables by name (the sample is the feature)."""
    g = table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("T"), F.col("o_custkey") % 60).alias("table_name")).agg(F.count("*").alias("n"))
    return g.orderBy("table_name").limit(30)


