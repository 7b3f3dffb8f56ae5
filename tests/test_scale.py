"""What would hold up larger tables: ranks by one task, limits of a session, rows a task."""

import re

from concordat.operators import graph, witness
from concordat.plans import catalog_queries, object_queries, witness_queries  # noqa: F401
from concordat.plans.dialect_queries import run
from concordat.plans.registry import QUERIES


def test_places_are_not_counted_by_one_task(spark, sf_dir):
    for name in ("verdict_order", "graph_toposort"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "row_number() windowspecdefinition(__range" in plan and plan.count("row_number()") == 1, name


def test_a_tree_has_any_number_of_rows(spark, sf_dir):
    n = 1_000_010
    spark.range(n).selectExpr("id AS k", "IF(id = 0, NULL, 0) AS up").createOrReplaceTempView("wide")
    tree = run(spark, sf_dir, "SELECT w.k, SYS_CONNECT_BY_PATH(w.k, '/') AS p FROM app.wide w START WITH w.k = 0 CONNECT BY PRIOR w.k = w.up", "oracle")
    row = tree.selectExpr("count(*)", "count(DISTINCT p)", "max(length(p))").first()
    assert tuple(row) == (n, n, len("/0/1000009"))


def test_seeded_rows_are_dealt_to_more_tasks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(witness, "ROWS_A_TASK", 500)
    df = QUERIES["seed_unique_keys"](spark, sf_dir)
    n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and f"splits=Some({1 + n // 500})" in plan
    assert tuple(df.first()) == (n, n, n, n, 0)


def test_base_tables_are_not_broadcast(spark, sf_dir):
    df = QUERIES["graph_base_tables"](spark, sf_dir)
    df.collect()
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_first_rows_of_a_correlated_subquery_keep_their_order(spark, sf_dir):
    apply = QUERIES["tsql_apply_e2e"](spark, sf_dir)
    window = re.search(r"row_number\(\) windowspecdefinition\([^)]*", apply._jdf.queryExecution().optimizedPlan().toString())[0]
    assert "DESC" in window and "ASC" in window, window  # rows of a key come in any order from other machines
    sql = "SELECT n.n_nationkey, (SELECT TOP 1 c.c_mktsegment FROM dbo.customer c WHERE c.c_nationkey = n.n_nationkey GROUP BY c.c_mktsegment ORDER BY COUNT(*) DESC, MIN(c.c_custkey)) AS most FROM dbo.nation n"
    most = run(spark, sf_dir, sql, "mssql")
    assert re.search(r"row_number\(\) windowspecdefinition\([^)]*DESC", most._jdf.queryExecution().optimizedPlan().toString())
    counted = {}
    for r in spark.read.parquet(f"{sf_dir}/customer.parquet").groupBy("c_nationkey", "c_mktsegment").agg({"*": "count", "c_custkey": "min"}).collect():
        counted.setdefault(r[0], []).append((-r["count(1)"], r["min(c_custkey)"], r[1]))
    assert {r[0]: r[1] for r in most.collect() if r[1]} == {k: min(v)[2] for k, v in counted.items()}


def test_a_closure_is_not_written_again_in_each_round(spark, sf_dir, monkeypatch):
    written, of = [], graph.durable
    monkeypatch.setattr(graph, "durable", lambda df, name: (written.append((name, of(df, name))), written[-1][1])[1])
    pairs = QUERIES["graph_keys_closure"](spark, sf_dir).agg({"n": "sum"}).first()[0]
    assert sum(df.count() for name, df in written if name == "pairs") < pairs


def test_layers_set_aside_reach_what_a_walk_finds(spark):
    # a ring of three, two layers above it that meet again, a loop on the upper one, an edge twice
    edges = [(1, 2), (2, 3), (3, 1), (10, 1), (11, 1), (10, 5), *((20 + i, 10 + i % 2) for i in range(9)), (20, 5), (20, 1), (20, 10), (30, 30), (30, 20)]
    deps = spark.createDataFrame(edges, "src int, dst int")
    assert sorted(map(tuple, graph.doubled_closure(deps).collect())) == sorted(map(tuple, graph.closure(deps).collect()))


def test_edges_of_no_ring_are_not_written(spark, sf_dir, monkeypatch):
    written, of = [], graph.durable
    monkeypatch.setattr(graph, "durable", lambda df, name: (written.append(of(df, name)), written[-1])[1])
    QUERIES["graph_keys_components"](spark, sf_dir)
    assert max(df.count() for df in written) < spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def test_rings_are_the_components_of_two_nodes_or_more(spark):
    edges = [(1, 2), (2, 1), (2, 9), (9, 3), (3, 4), (4, 5), (5, 3), (6, 6), (7, 1), (1, 2), (None, 1), (5, None)]
    deps = spark.createDataFrame(edges, "src int, dst int")
    assert sorted(map(tuple, graph.rings(deps).collect())) == [(1, 1), (2, 1), (3, 3), (4, 3), (5, 3)]
    assert graph.rings(deps.where("src = 6")).count() == 0
