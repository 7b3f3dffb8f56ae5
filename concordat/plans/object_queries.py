"""Queries of graphs, scans of definitions, witness data and files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.operators import graph, scan, witness
from concordat.sources import files

from .registry import for_each, query, rows_for_parts, sql_for_parts, table

OBJECTS = [
    ("TABLE", "app.region", []), ("TABLE", "app.nation", ["app.region"]), ("TABLE", "app.customer", ["APP.NATION"]), ("TABLE", "app.orders", ["customer"]), ("TABLE", "app.part", []), ("TABLE", "app.lineitem", ["orders", "app.part", "app.lineitem"]),
    ("VIEW", "app.v_sales", ["app.orders", "app.lineitem"]), ("VIEW", "app.v_top", ["app.v_sales", "app.gone"]), ("VIEW", "rep.v_a", ["rep.v_b"]), ("VIEW", "rep.v_b", ["rep.v_a", "app.region"]), ("VIEW", "rep.v_c", ["rep.v_b", "nowhere.t"]),
]
OBJECT_VALUES = ", ".join(f"('{t}', '{f}', '{f.split('.')[1]}', [{', '.join(repr(d) for d in deps)}]::VARCHAR[])" for t, f, deps in OBJECTS)
#: One copy of the objects for each supplier, in schemas of its own; bare names are in all of them.
EDGES = f"""t(type, fqn, name, deps) AS (VALUES {OBJECT_VALUES}), o AS (SELECT type, replace(fqn, '.', s_suppkey || '.') AS fqn, name, list_transform(deps, lambda x: replace(x, '.', s_suppkey || '.')) AS deps FROM t, supplier), d AS (SELECT fqn, unnest(deps) AS dep FROM o),
c AS (SELECT d.fqn, d.dep, k.fqn AS dst, CASE WHEN upper(d.dep) = upper(k.fqn) THEN 0 WHEN split_part(d.fqn, '.', 1) = split_part(k.fqn, '.', 1) THEN 1 ELSE 2 END AS r FROM d JOIN o k ON upper(d.dep) = upper(k.fqn) OR upper(split_part(d.dep, '.', -1)) = upper(k.name)),
e AS (SELECT DISTINCT fqn AS src, dst FROM (SELECT *, row_number() OVER (PARTITION BY fqn, dep ORDER BY r, dst) AS p FROM c) WHERE p = 1 AND fqn <> dst)"""


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = for_each(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("k")), [(t, f, f.split(".")[1], d) for t, f, d in OBJECTS], "type string, fqn string, name string, depends_on array<string>")
    own = lambda c: F.replace(c, F.lit("."), F.concat("k", F.lit(".")))
    return rows.select("type", own(F.col("fqn")).alias("fqn"), "name", F.transform("depends_on", own).alias("depends_on"))


@query(f"WITH {EDGES} SELECT src, dst FROM e")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.edges(objects(spark, sf_dir))


CLOSURE = f"WITH RECURSIVE {EDGES}, up(src, dst, depth) AS (SELECT src, dst, 1 FROM e UNION ALL SELECT u.src, e.dst, u.depth + 1 FROM up u JOIN e ON u.dst = e.src WHERE u.depth < 30 AND u.src <> u.dst), cl AS (SELECT src, dst, min(depth) AS depth FROM up GROUP BY ALL), bad AS (SELECT src AS fqn FROM cl WHERE src = dst UNION SELECT c.src FROM cl c JOIN cl s ON c.dst = s.src AND s.src = s.dst)"
DEEP = ", lv AS (SELECT fqn, 0 AS l FROM o WHERE fqn NOT IN (SELECT fqn FROM bad) UNION ALL SELECT e.src, lv.l + 1 FROM lv JOIN e ON e.dst = lv.fqn WHERE e.src NOT IN (SELECT fqn FROM bad)), w AS (SELECT fqn, max(l) AS wave, false AS in_cycle FROM lv GROUP BY 1), z AS (SELECT * FROM w UNION ALL SELECT DISTINCT fqn, (SELECT max(wave) + 1 FROM w), true FROM bad)"


@query(CLOSURE + DEEP + " SELECT fqn, wave::INT AS wave, in_cycle FROM z")
def graph_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir)
    return graph.waves(o, graph.edges(o))


@query(CLOSURE + DEEP + " SELECT fqn, row_number() OVER (ORDER BY wave, fqn)::INT AS place, in_cycle AS cycle_warning FROM z")
def graph_toposort(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir)
    return graph.topological_order(graph.waves(o, graph.edges(o)))


@query(CLOSURE + " SELECT src, dst, depth::INT AS depth FROM cl")
def graph_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.closure(graph.edges(objects(spark, sf_dir)))


@query(CLOSURE + " SELECT src AS fqn FROM cl WHERE src = dst")
def graph_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.cycle_members(graph.edges(objects(spark, sf_dir)))


@query(CLOSURE + " SELECT src AS fqn, string_agg(dst, ',' ORDER BY dst) AS base_tables FROM cl WHERE src IN (SELECT fqn FROM o WHERE type = 'VIEW') AND dst IN (SELECT fqn FROM o WHERE type = 'TABLE') GROUP BY 1")
def graph_base_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir)
    return graph.base_tables(o, graph.edges(o))


@query(f"WITH {EDGES} SELECT DISTINCT fqn, dep AS missing FROM d WHERE upper(dep) NOT IN (SELECT upper(fqn) FROM o UNION SELECT upper(name) FROM o)")
def graph_missing_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.missing_references(objects(spark, sf_dir))


#: Keys as a graph: lines need orders and parts, orders customers, customers nations, nations regions; customers of a hundred's first three places need each other in a ring.
KEYS = """k(src, dst) AS (SELECT 'l' || l_orderkey || '-' || l_linenumber, 'o' || l_orderkey FROM lineitem UNION SELECT 'l' || l_orderkey || '-' || l_linenumber, 'p' || l_partkey FROM lineitem UNION SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders
UNION SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
UNION SELECT 'c' || c_custkey, 'c' || CASE WHEN c_custkey % 100 = 2 THEN c_custkey - 2 ELSE c_custkey + 1 END FROM customer WHERE c_custkey % 100 < 3)"""


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges, some perhaps twice."""
    line, orders, customer, nation = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation"))
    edge = lambda df, src, dst: df.selectExpr(f"concat({src}) AS src", f"concat({dst}) AS dst")
    number = "'l', l_orderkey, '-', l_linenumber"
    ring = edge(customer.where("c_custkey % 100 < 3"), "'c', c_custkey", "'c', CASE WHEN c_custkey % 100 = 2 THEN c_custkey - 2 ELSE c_custkey + 1 END")
    found = [edge(line, number, "'o', l_orderkey"), edge(line, number, "'p', l_partkey"), edge(orders, "'o', o_orderkey", "'c', o_custkey"), edge(customer, "'c', c_custkey", "'n', c_nationkey"), edge(nation, "'n', n_nationkey", "'r', n_regionkey"), ring]
    return reduce(DataFrame.union, found)


@query(f"WITH RECURSIVE {KEYS}, up(src, dst, depth) AS (SELECT src, dst, 1 FROM k UNION SELECT up.src, k.dst, depth + 1 FROM up JOIN k ON up.dst = k.src WHERE depth < 9), s AS (SELECT src, dst, min(depth) AS depth FROM up GROUP BY ALL) SELECT left(src, 1) AS src_kind, left(dst, 1) AS dst_kind, depth::INT AS depth, count(*)::BIGINT AS n FROM s GROUP BY ALL")
def graph_keys_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closure of more edges than the driver takes pairs, with rings in it: how many pairs of each kind lie how far apart."""
    return graph.doubled_closure(keys(spark, sf_dir)).groupBy(F.left("src", F.lit(1)).alias("src_kind"), F.left("dst", F.lit(1)).alias("dst_kind"), "depth").agg(F.count("*").alias("n"))


@query("WITH e AS (SELECT c_custkey - c_custkey % 100 AS first, c_custkey FROM customer WHERE c_custkey % 100 < 3), whole AS (SELECT first FROM e GROUP BY first HAVING count(*) = 3) SELECT 'c' || c_custkey AS node, 'c' || first AS component FROM e JOIN whole USING (first)")
def graph_keys_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of two nodes or more, found with joins: the rings."""
    return graph.rings(keys(spark, sf_dir))


TEXTS = [
    ("view", "dbo.v1", "SELECT a.x FROM [dbo].[Orders] a JOIN dbo.customers c ON a.id = c.id -- FROM comment"),
    ("view", "dbo.v2", "SELECT * FROM t PIVOT (SUM(x) FOR k IN ([a], [b])) p"),
    ("view", "dbo.v3", "SELECT getdate() AS d UNION SELECT CAST(x AS text) FROM other.tab"),
    ("procedure", "dbo.p1", "BEGIN DECLARE c CURSOR FOR SELECT 1; EXEC sp_executesql @s; END"),
    ("procedure", "dbo.p2", "BEGIN\n SELECT newid() FROM t1\nUPDATE t2 SET a = 1"),
    ("procedure", "dbo.aspnet_Membership_Get", "BEGIN SELECT 1 END"),
    ("function", "dbo.f1", "CREATE FUNCTION f() RETURNS TABLE AS RETURN (SELECT 1 AS a)"),
    ("function", "dbo.f2", "CREATE FUNCTION f() RETURNS INT AS BEGIN RETURN crypt('a', gen_salt('b')) END -- TODO"),
    ("table", "dbo.t1", "CREATE TABLE t1 (g geometry, id int)"),
    ("table", "dbo.t2", "CREATE TABLE t2 (id int) WITH (SYSTEM_VERSIONING = ON)"),
    ("table", "dbo.t3", ""),
    ("procedure", "dbo.p3", "BEGIN EXEC xp_cmdshell 'dir'; INSERT INTO pg_catalog.x VALUES (newid()) END"),
    ("view", "dbo.v4", "x FROM y"),
]
TEXT_ROWS = sql_for_parts("o", "type, fqn, ddl", TEXTS, "fqn")


@query(f"WITH {TEXT_ROWS} SELECT CASE WHEN type = 'table' THEN 'catalog' ELSE 'rewrite' END AS path, count(*)::BIGINT AS n FROM o GROUP BY 1")
def assess_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_for_parts(spark, sf_dir, TEXTS, "type string, fqn string, ddl string", "fqn").groupBy(scan.eligibility(F.col("type"), "mssql").alias("path")).agg(F.count("*").alias("n"))


@query(f"""WITH {TEXT_ROWS}, b AS (SELECT *, regexp_replace(regexp_replace(ddl, '--[^\\n]*', '', 'g'), '''(?:[^'']|'''')*''', '', 'g') AS bare FROM o), c AS (SELECT *, len(regexp_extract_all(bare, '\\(')) AS po, len(regexp_extract_all(bare, '\\)')) AS pc, len(regexp_extract_all(bare, '(?i)\\bbegin\\b')) + len(regexp_extract_all(bare, '(?i)\\bcase\\b')) AS bo, len(regexp_extract_all(bare, '(?i)\\bend\\b')) AS bc FROM b)
SELECT fqn, CASE WHEN trim(ddl) = '' THEN 'empty' WHEN po <> pc OR (type IN ('procedure', 'function', 'trigger') AND bo > bc) THEN 'truncated' WHEN NOT (CASE type WHEN 'view' THEN regexp_matches(bare, '(?i)\\bselect\\b') WHEN 'table' THEN regexp_matches(bare, '(?i)\\bcreate\\s+table\\b') ELSE regexp_matches(bare, '(?i)\\bbegin\\b|\\breturn\\b') END) THEN 'incomplete' WHEN regexp_matches(ddl, '(?i)\\bEWI-\\d{{4}}\\b|\\bTODO\\b|unconverted') THEN 'marked' ELSE 'ok' END AS issue FROM c""")
def audit_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.conversion_audit(rows_for_parts(spark, sf_dir, TEXTS, "type string, fqn string, ddl string", "fqn"))


@query(f"""WITH {TEXT_ROWS} SELECT fqn, array_to_string(list_sort(list_distinct(regexp_extract_all(regexp_replace(lower(ddl), '--[^\\n]*|[\\[\\]"`]', '', 'g'), '\\b(?:from|join|into|update|exec|execute)\\s+([a-z_][\\w$]*(?:\\.[a-z_][\\w$]*)*)', 1))), ',') AS refs,
 type = 'view' OR (type = 'function' AND regexp_matches(ddl, '(?is)\\breturns\\s+(@\\w+\\s+)?table\\b')) OR (type = 'procedure' AND regexp_matches(ddl, '(?im)^\\s*select\\b')) AS row_producing FROM o""")
def referenced_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = rows_for_parts(spark, sf_dir, TEXTS, "type string, fqn string, ddl string", "fqn")
    return o.select("fqn", F.array_join(graph.references(F.col("ddl")), ",").alias("refs"), scan.row_producing(F.col("type"), F.col("ddl")).alias("row_producing"))


@query("SELECT count(*)::BIGINT AS n, sum(len(text) - len(replace(lower(text), 'license', '')))::BIGINT // 7 AS hits FROM documents WHERE regexp_matches(text, '(?i)license')")
def document_rule_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule over a large text column: filter and counts in one scan."""
    d = table(spark, sf_dir, "documents").where(F.col("text").rlike("(?i)license"))
    return d.agg(F.count("*").alias("n"), F.sum(F.regexp_count(F.lower("text"), F.lit("license"))).cast("bigint").alias("hits"))


@query("""SELECT (i + 1)::INT AS id, 'name ' || (i + 1) AS full_name, 'user' || (i + 1) || '@example.com' AS email, i % 2 = 1 AS active, ['new', 'open', 'done'][i % 3 + 1] AS status, (5 + i % 6)::INT AS score, strftime(DATE '2024-01-01' + (i % 365)::INT, '%Y-%m-%d') AS day FROM range(0, 500) t(i)""")
def seed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [{"name": "id", "kind": "int"}, {"name": "full_name", "kind": "string"}, {"name": "email", "kind": "string"}, {"name": "active", "kind": "boolean"}, {"name": "status", "kind": "string", "choices": ["new", "open", "done"]}, {"name": "score", "kind": "int", "low": 5, "high": 10}, {"name": "day", "kind": "date"}]
    return witness.seed(spark, 500, columns).withColumn("day", F.col("day").cast("string"))


@query("SELECT i AS id, n_nationkey AS nation FROM range(0, 1000) t(i) JOIN (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS p, count(*) OVER () AS n FROM nation) ON i % n = p")
def seed_fk_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return witness.assign_parents(spark.range(1000), table(spark, sf_dir, "nation"), "id", "n_nationkey", "nation").select("id", "nation")


CHECKS = [("c1", "status IN ('open', 'closed', 'new')"), ("c2", "age >= 18 AND age <= 65"), ("c3", "qty BETWEEN 1 AND 10"), ("c4", "x > 0"), ("c5", "len(a) = len(b)")]


@query(f"""WITH {sql_for_parts("v", "name, d", CHECKS, "name")}, n AS (SELECT *, regexp_extract_all(d, '''([^'']*)''', 1) AS q FROM v) SELECT name, CASE WHEN regexp_matches(d, '(?i)\\bin\\s*\\(') AND len(q) > 0 THEN array_to_string(list_sort(q), ',') END AS choices,
 coalesce(nullif(regexp_extract(d, '(?i)between\\s+(-?\\d+)', 1), '')::BIGINT, nullif(regexp_extract(d, '>=\\s*\\(?(-?\\d+)', 1), '')::BIGINT, nullif(regexp_extract(d, '>\\s*\\(?(-?\\d+)', 1), '')::BIGINT + 1) AS low,
 coalesce(nullif(regexp_extract(d, '(?i)between\\s+-?\\d+\\s+and\\s+(-?\\d+)', 1), '')::BIGINT, nullif(regexp_extract(d, '<=\\s*\\(?(-?\\d+)', 1), '')::BIGINT, nullif(regexp_extract(d, '<\\s*\\(?(-?\\d+)', 1), '')::BIGINT - 1) AS high FROM n""")
def check_enum_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, low, high = witness.check_values(F.col("d"))
    return rows_for_parts(spark, sf_dir, CHECKS, "name string, d string", "name").select("name", F.array_join(c, ",").alias("choices"), low.alias("low"), high.alias("high"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 13 <> 0)")
def orphan_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return witness.orphans(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), table(spark, sf_dir, "customer").where("c_custkey % 13 <> 0"), "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query("WITH p AS (SELECT c_custkey FROM customer WHERE c_custkey % 13 <> 0) SELECT o_orderkey, CASE WHEN o_custkey IN (FROM p) THEN o_custkey ELSE (SELECT min(c_custkey) FROM p) END AS o_custkey, o_custkey NOT IN (FROM p) AS repaired FROM orders")
def orphan_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return witness.repair_orphans(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), table(spark, sf_dir, "customer").where("c_custkey % 13 <> 0"), "o_custkey", "c_custkey")


@query("SELECT 'id' AS param, max(o_custkey)::VARCHAR AS value FROM orders UNION ALL SELECT 'limit', '10' UNION ALL SELECT 'day', '2024-01-01' UNION ALL SELECT 'anchor', max(o_orderkey)::VARCHAR FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)")
def param_infer_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").agg(F.max("o_custkey").alias("m"), F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("a"))
    none = F.lit(None).cast("string")
    pair = lambda n, d, m, k: F.struct(F.lit(n).alias("param"), witness.parameter_value(d, m, k).alias("value"))
    return o.select(F.explode(F.array(pair("id", none, F.col("m"), "bigint"), pair("limit", F.lit("10"), F.col("m"), "int"), pair("day", none, none, "date"), pair("anchor", none, F.col("a"), "bigint"))).alias("p")).select("p.param", "p.value")


LOG = ['{"full_name": "App.P1", "status": "OK", "total_rows": 3}', "not json", '{"full_name": "app.p2", "status": "ERROR"}', '{"full_name": "APP.P1", "status": "ERROR", "total_rows": 0}']


@query("SELECT * FROM (VALUES ('app.p1', 'ERROR', 0::BIGINT), ('app.p2', 'ERROR', NULL)) t(full_name, status, total_rows)")
def jsonl_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.createDataFrame(list(enumerate(LOG)), "line long, value string")
    return files.execution_log(lines).select("full_name", "status", "total_rows")


EXPORTS = [("a.csv", "1\tx\ty\n2\tb\nc\td\n3\te\tf\n"), ("b.csv", "1+|x+|y&|2+|b\nc+|d&|")]


@query("SELECT * FROM (VALUES ('a.csv', 0::INT, '1', 'x', 'y'), ('a.csv', 1, '2', 'b' || chr(10) || 'c', 'd'), ('a.csv', 2, '3', 'e', 'f'), ('b.csv', 0, '1', 'x', 'y'), ('b.csv', 1, '2', 'b' || chr(10) || 'c', 'd')) t(file, record, f1, f2, f3)")
def csv_delim_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = files.sniffed_records(spark.createDataFrame(EXPORTS, "file string, value string"))
    return r.select("file", "record", *(F.get("fields", F.lit(i)).alias(f"f{i + 1}") for i in range(3)))


SCRIPT = "CREATE TABLE a (id int)\nGO\nCREATE VIEW v AS SELECT 1\nGO\nCREATE PROCEDURE p AS BEGIN SELECT ';' END\ngo\n"


@query("SELECT * FROM (VALUES (0::INT, 'table'), (1, 'view'), (2, 'procedure')) t(place, kind)")
def ddl_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.createDataFrame([("f", SCRIPT)], "file string, value string")
    return files.statements(s, "mssql").select("place", "kind")
