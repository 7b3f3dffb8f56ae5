"""Witness rows for views whose conditions are solved together, and rows that survive a view's joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.operators import reducer, witness

from .registry import query, table

TABLES = ("part", "customer", "orders", "nation", "supplier")
#: Views, and which columns contradict each other in them.
VIEWS = {
    "bounds": ("SELECT * FROM part p WHERE p.p_size >= 900 AND p.p_size > 900 AND p.p_size <> 901", ""),
    "between_bounds": ("SELECT * FROM part p WHERE p.p_size > 1000 AND 1003 > p.p_size AND p.p_size <> 1001", ""),
    "no_whole_number": ("SELECT * FROM part p WHERE p.p_size > 1005 AND p.p_size < 1006", "part.p_size"),
    "sets": ("SELECT * FROM customer c WHERE c.c_mktsegment IN ('NONE', 'SUCH') AND c.c_mktsegment <> 'NONE' AND c.c_acctbal BETWEEN 0.001 AND 0.002", ""),
    "joined": ("SELECT * FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_custkey > 1000000000 AND c.c_custkey NOT IN (1000000001, 1000000002)", ""),
    "joined_apart": ("SELECT * FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_custkey > 1000000000 AND c.c_custkey < 10", "customer.c_custkey"),
    "patterns": ("SELECT * FROM part p WHERE p.p_name LIKE 'zz%' AND p.p_name LIKE '%qq' AND p.p_name NOT LIKE 'zzqq'", ""),
    "moments": ("SELECT * FROM orders o WHERE o.o_orderdate >= '2031-01-01' AND o.o_orderdate < '2031-01-02' AND o.o_orderdate <> '2031-01-01'", ""),
    "alternatives": ("SELECT * FROM nation n WHERE (n.n_regionkey = 1 AND n.n_regionkey = 2) OR (n.n_name = 'ATLANTIS' AND n.n_regionkey IS NULL)", ""),
    "three_tables": ("SELECT * FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN customer c ON c.c_nationkey = n.n_nationkey WHERE s.s_name IS NULL AND n.n_regionkey BETWEEN 100 AND 101 AND n.n_regionkey <> 100 AND c.c_acctbal > 1000000", ""),
}


@query(" UNION ALL ".join(f"SELECT '{name}' AS view_name, count(*)::BIGINT AS rows_before, {'false' if clash else 'true'} AS satisfied, '{clash}' AS contradictory FROM ({sql})" for name, (sql, clash) in VIEWS.items()))
def witness_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views that return nothing, and whether they return rows after a row more in each table, or which columns contradict each other."""
    tables = {t: table(spark, sf_dir, t) for t in TABLES}

    def counted(sql: str, held: dict[str, DataFrame]) -> DataFrame:
        for t, df in held.items():
            df.createOrReplaceTempView(t)
        return spark.sql(sql).agg(F.count("*").alias("n"))

    out = []
    for name, (sql, _) in VIEWS.items():
        before = counted(sql, tables).select(F.lit(name).alias("view_name"), F.col("n").alias("rows_before"))
        try:
            after, clash = counted(sql, witness.witness_rows(spark, sql, tables)).select(F.lit(name).alias("view_name"), (F.col("n") > 0).alias("satisfied")), ""
        except ValueError as e:
            after, clash = spark.range(1).select(F.lit(name).alias("view_name"), F.lit(False).alias("satisfied")), str(e).removeprefix("contradictory: ")
        out.append(before.join(after, "view_name").withColumn("contradictory", F.lit(clash)))
    counted("SELECT 1", tables)
    return reduce(DataFrame.unionByName, out)


SALES = """SELECT * FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE l.l_quantity > 45 AND o.o_totalprice > 100000 AND c.c_mktsegment = 'BUILDING' AND n.n_regionkey = 1"""
KEYS = {"lineitem": ("l_orderkey * 100 + l_linenumber", "l_quantity > 45"), "orders": ("o_orderkey", "o_totalprice > 100000"), "customer": ("c_custkey", "c_mktsegment = 'BUILDING'"), "nation": ("n_nationkey", "n_regionkey = 1")}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(DISTINCT {key})::BIGINT AS survivors, min({key})::BIGINT AS first_key, sum(DISTINCT {key})::BIGINT AS key_sum FROM ({SALES})" for t, (key, _) in KEYS.items()))
def surviving_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of four tables that a view's join returns, left by semi-joins of keys alone."""
    held = reducer.reduced({t: table(spark, sf_dir, t).where(w) for t, (_, w) in KEYS.items()}, witness.join_pairs(SALES))
    counts = [df.agg(F.lit(t).alias("table_name"), F.count_distinct(F.expr(KEYS[t][0])).alias("survivors"), F.min(F.expr(KEYS[t][0])).cast("long").alias("first_key"), F.sum_distinct(F.expr(KEYS[t][0])).cast("long").alias("key_sum")) for t, df in held.items()]
    return reduce(DataFrame.unionByName, counts)


@query(f"""WITH s AS ({SALES}), a AS (SELECT * FROM s ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity LIMIT 1) SELECT 'lineitem' AS table_name, l_orderkey::BIGINT AS key_value FROM a UNION ALL SELECT 'orders', o_orderkey FROM a UNION ALL SELECT 'customer', c_custkey FROM a UNION ALL SELECT 'nation', n_nationkey FROM a""")
def anchor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of each table that meet each other: values for all parameters of a routine together."""
    found = reducer.anchor({t: table(spark, sf_dir, t).where(w) for t, (_, w) in KEYS.items()}, witness.join_pairs(SALES)) or {}
    first = {"lineitem": "l_orderkey", "orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey"}
    return spark.createDataFrame([(t, int(row[first[t]])) for t, row in found.items()], "table_name string, key_value long")


@query("SELECT count(*)::BIGINT AS n, count(*)::BIGINT AS ids, count(*)::BIGINT AS codes, count(*)::BIGINT AS pairs, 0::BIGINT AS orphans FROM lineitem")
def seed_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many rows as lineitem has, with a key, a code and a pair of references that each row has alone, and no reference without its row."""
    rows = table(spark, sf_dir, "lineitem").count()
    customer, part = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    tasks = witness.tasks_for(spark, rows)
    made = spark.range(0, rows, 1, tasks).select("id", witness.permuted(F.col("id"), 10**9, 7).alias("number"), witness.unique_text(F.col("id"), 8).alias("code"))
    paired = witness.assign_unique_pairs(made.select("id"), "id", rows, (customer, "c_custkey", "customer"), (part, "p_partkey", "part"))
    counted = lambda df, *by: df.repartition(tasks, *by).groupBy(*by).agg(F.count("*").alias("rows"))  # noqa: E731  one column's values at a time, so that a task holds a share of one
    lost = F.col("customer").isNull() | F.col("part").isNull()
    whole = counted(paired, "customer", "part").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), F.count_if(~lost).alias("pairs"), F.coalesce(F.sum(F.when(lost, F.col("rows"))), F.lit(0)).alias("orphans"))
    ids, codes = (counted(made, c).agg(F.count(c).alias(name)) for c, name in (("number", "ids"), ("code", "codes")))
    return whole.crossJoin(F.broadcast(ids)).crossJoin(F.broadcast(codes)).select("n", "ids", "codes", "pairs", "orphans")  # a row each
