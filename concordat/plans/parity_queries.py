"""Queries of the parity and audit operators; the target side is a deterministic perturbation of the source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.functions.canonical import routine_cell
from concordat.operators import audit, digests, parity

from .registry import for_each, one_of, query, rows_for_parts, sql_for_parts, sql_rows, table

ORDERS_T = """t AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 97 <> 0
 UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 101 = 0 AND o_orderkey <> 0)"""
CELL = lambda c: f"coalesce(CASE WHEN regexp_replace({c}::VARCHAR, '\\.0$', '') = '-0' THEN '0' ELSE regexp_replace({c}::VARCHAR, '\\.0$', '') END, chr(1) || 'N')"
ROW = f"concat_ws(chr(31), o_orderkey::VARCHAR, o_custkey::VARCHAR, o_orderstatus, {CELL('o_totalprice')}, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority)"
HASHED = f"('0x' || substr(md5({ROW}), 1, 15))::BIGINT"
DIGEST = f"count(*)::BIGINT AS n, CAST(sum({HASHED}::HUGEINT) AS VARCHAR) AS s, bit_xor({HASHED}) AS x"


def orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    source = table(spark, sf_dir, "orders")
    return source, parity.perturbed(source, "o_orderkey", "o_totalprice")


VERDICT = "CASE WHEN a.n <> b.n THEN 'FAIL_COUNT' WHEN a.s <> b.s OR a.x <> b.x THEN 'FAIL_HASH' ELSE 'PASS' END AS verdict"
SIDES = "a.n AS source_n_rows, a.s AS source_digest_sum, a.x AS source_digest_xor, b.n AS target_n_rows, b.s AS target_digest_sum, b.x AS target_digest_xor"


@query(f"WITH {ORDERS_T}, a AS (SELECT {DIGEST} FROM orders), b AS (SELECT {DIGEST} FROM t) SELECT {SIDES}, {VERDICT} FROM a, b")
def parity_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.digest_parity(*orders(spark, sf_dir))


@query(f"WITH {ORDERS_T}, a AS (SELECT o_orderpriority, {DIGEST} FROM orders GROUP BY 1), b AS (SELECT o_orderpriority, {DIGEST} FROM t GROUP BY 1) SELECT o_orderpriority, {SIDES}, {VERDICT} FROM a JOIN b USING (o_orderpriority)")
def parity_row_hash_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.digest_parity(*orders(spark, sf_dir), by=["o_orderpriority"])


@query("""WITH r AS (SELECT c_nationkey, md5(concat_ws(chr(31), trim(c_name), trim(c_mktsegment), printf('%.4f', c_nationkey::DOUBLE))) AS h FROM customer),
l AS (SELECT c_nationkey, left(h, 3) AS range, count(*) AS n, sum(('0x' || left(h, 15))::BIGINT::HUGEINT) AS total, bit_xor(('0x' || left(h, 15))::BIGINT) AS mixed FROM r GROUP BY ALL)
SELECT c_nationkey, md5(string_agg(range || ':' || n || ':' || total || ':' || mixed, ',' ORDER BY range)) AS set_hash, sum(n)::BIGINT AS n_rows FROM l GROUP BY c_nationkey""")
def result_set_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hash for each nation's customers, whatever their order, from digests of ranges."""
    return digests.tree_hash(table(spark, sf_dir, "customer"), ["c_nationkey"], routine_cell, ["c_name", "c_mktsegment", "c_nationkey"])


TREE = f"""WITH {ORDERS_T}, s AS (SELECT md5(o_orderkey::VARCHAR) AS p, o_orderkey, o_custkey, o_totalprice FROM orders), u AS (SELECT md5(o_orderkey::VARCHAR) AS p, o_orderkey, o_custkey, o_totalprice FROM t),
d AS ((SELECT * FROM s EXCEPT ALL SELECT * FROM u) UNION ALL (SELECT * FROM u EXCEPT ALL SELECT * FROM s)),
lv AS (SELECT unnest([1, 2]) AS level), pre AS (SELECT DISTINCT level, left(p, (3 * level)::INT) AS r FROM d, lv)"""


@query(TREE + """, before AS (SELECT 2 AS level, r AS above FROM pre WHERE level = 1), rows_of AS (SELECT level, left(p, (3 * level)::INT) AS r, left(p, 3) AS above, side FROM lv, (SELECT p, 's' AS side FROM s UNION ALL SELECT p, 't' FROM u)),
seen AS (SELECT level, r, side FROM rows_of WHERE level = 1 OR above IN (SELECT above FROM before))
SELECT level::INT AS level, count(DISTINCT r)::BIGINT AS ranges, count(DISTINCT CASE WHEN hit THEN r END)::BIGINT AS differing, count(*) FILTER (hit AND side = 's')::BIGINT AS source_rows, count(*) FILTER (hit AND side = 't')::BIGINT AS target_rows
FROM (SELECT seen.*, pre.r IS NOT NULL AS hit FROM seen LEFT JOIN pre ON pre.level = seen.level AND pre.r = seen.r) GROUP BY level""")
def digest_tree_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two levels of digests narrow orders down to the rows in which the sides differ."""
    _, told = digests.digest_diff(*orders(spark, sf_dir), ["o_orderkey"], ["o_custkey", "o_totalprice"], levels=2, enough=0)
    return spark.createDataFrame(told, "level int, ranges long, differing long, source_rows long, target_rows long")


@query(f"""WITH {ORDERS_T}, s AS (SELECT o_orderkey AS k, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey) AS p, o_custkey AS c, {CELL('o_totalprice')} AS v FROM orders),
u AS (SELECT o_orderkey AS k, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey) AS p, o_custkey AS c, {CELL('o_totalprice')} AS v FROM t)
SELECT coalesce(s.k, u.k) AS o_orderkey, coalesce(s.p, u.p)::INT AS place, CASE WHEN u.k IS NULL THEN 'ROW_MISSING' WHEN s.k IS NULL THEN 'ROW_EXTRA' ELSE 'VALUE_DIFF' END AS kind,
 CASE WHEN s.k IS NOT NULL AND u.k IS NOT NULL THEN 'o_totalprice' ELSE '' END AS differing FROM s FULL JOIN u ON s.k = u.k AND s.p = u.p WHERE s.k IS NULL OR u.k IS NULL OR s.v <> u.v""")
def digest_tree_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row differences from only the ranges of keys whose digests differ."""
    return digests.digest_diff(*orders(spark, sf_dir), ["o_orderkey"], ["o_custkey", "o_totalprice"])[0]


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
KEYS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id"}


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, source_n, target_n, CASE WHEN target_n >= source_n THEN 'PASS' ELSE 'FAIL_DATA' END AS verdict, CASE WHEN target_n = source_n THEN 'PASS' ELSE 'FAIL_DATA' END AS verdict_equal, (source_n > 0) = (target_n > 0) AS view_pass, coalesce(abs(target_n - source_n) * 100.0 / nullif(source_n, 0) > 5, false) AS big_gap "
        f"FROM (SELECT count(*)::BIGINT AS source_n, (count(*) FILTER ({k} % 97 <> 0) + count(*) FILTER ({k} % 101 = 0 AND {k} <> 0))::BIGINT AS target_n FROM {t})"
        for t, k in KEYS.items()
    )
)
def parity_table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of all tables on both sides, one scan of the key column each."""
    counts = []
    for t, k in KEYS.items():
        key = F.col(k)
        counts.append(table(spark, sf_dir, t).agg(F.lit(t).alias("table_name"), F.count("*").alias("source_n"), (F.count_if(key % 97 != 0) + F.count_if((key % 101 == 0) & (key != 0))).alias("target_n")))
    s, t = F.col("source_n"), F.col("target_n")
    return reduce(DataFrame.unionByName, counts).select(
        "table_name",
        s,
        t,
        parity.count_verdict(s, t).alias("verdict"),
        parity.count_verdict(s, t, "equal").alias("verdict_equal"),
        (parity.view_verdict(s, t) == "PASS").alias("view_pass"),
        F.coalesce(F.abs(t - s) * 100.0 / F.nullif(s, F.lit(0)) > 5, F.lit(False)).alias("big_gap"),
    )


@query(f"""WITH {ORDERS_T}, s AS (SELECT o_orderkey AS k, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey) AS p, o_custkey AS c, {CELL('o_totalprice')} AS v FROM orders),
u AS (SELECT o_orderkey AS k, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_custkey) AS p, o_custkey AS c, {CELL('o_totalprice')} AS v FROM t)
SELECT coalesce(s.k, u.k) AS o_orderkey, coalesce(s.p, u.p)::INT AS place, CASE WHEN u.k IS NULL THEN 'ROW_MISSING' WHEN s.k IS NULL THEN 'ROW_EXTRA' ELSE 'VALUE_DIFF' END AS kind,
 CASE WHEN s.k IS NOT NULL AND u.k IS NOT NULL THEN 'o_totalprice' ELSE '' END AS differing FROM s FULL JOIN u ON s.k = u.k AND s.p = u.p WHERE s.k IS NULL OR u.k IS NULL OR s.v <> u.v""")
def parity_row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.diff_rows(*orders(spark, sf_dir), ["o_orderkey"], ["o_custkey", "o_totalprice"])


def diff_of(kind: str, name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return parity_row_diff(spark, sf_dir).where(F.col("kind") == kind).select("o_orderkey")

    run.__name__ = name
    sql = {"ROW_MISSING": "SELECT o_orderkey FROM orders WHERE o_orderkey % 97 = 0", "ROW_EXTRA": "SELECT -o_orderkey AS o_orderkey FROM orders WHERE o_orderkey % 101 = 0 AND o_orderkey <> 0", "VALUE_DIFF": "SELECT o_orderkey FROM orders WHERE o_orderkey % 89 = 0 AND o_orderkey % 97 <> 0"}
    query(sql[kind])(run)


diff_of("ROW_MISSING", "parity_rows_missing")
diff_of("ROW_EXTRA", "parity_rows_extra")
diff_of("VALUE_DIFF", "parity_value_diff")


@query("""WITH s AS (SELECT l_orderkey AS k, l_linenumber AS n, l_quantity AS q FROM lineitem), t AS (SELECT l_orderkey AS k, l_linenumber AS n, CASE WHEN l_orderkey % 89 = 0 THEN l_quantity + 1 ELSE l_quantity END AS q FROM lineitem WHERE l_orderkey % 97 <> 0),
a AS (SELECT 'source' AS side, * FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM t)), b AS (SELECT 'target' AS side, * FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM s))
SELECT side, k::VARCHAR || chr(31) || n::VARCHAR || chr(31) || rtrim(rtrim(printf('%.6f', q), '0'), '.') AS row FROM (FROM a UNION ALL FROM b)""")
def row_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of lineitem on one side only; its keys repeat, so rows are compared as multisets."""
    s = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS k", "l_linenumber AS n", "l_quantity AS q")
    t = s.where("k % 97 <> 0").withColumn("q", F.expr("CASE WHEN k % 89 = 0 THEN q + 1 ELSE q END"))
    return parity.row_set_difference(s, t)


INV = "s AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey % 7 <> 0), u AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey % 5 <> 0)"


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0").selectExpr("c_custkey AS k"), table(spark, sf_dir, "orders").where("o_custkey % 5 <> 0").selectExpr("o_custkey AS k")


@query(f"WITH {INV} SELECT coalesce(s.k, u.k) AS k, CASE WHEN u.k IS NULL THEN 'source_only' WHEN s.k IS NULL THEN 'target_only' ELSE 'matched' END AS presence FROM s FULL JOIN u ON s.k = u.k")
def inventory_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.inventory(*sides(spark, sf_dir), ["k"])


@query(f"WITH {INV} SELECT k FROM s WHERE k NOT IN (SELECT k FROM u)")
def inventory_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = sides(spark, sf_dir)
    return s.join(t, "k", "left_anti").distinct()


@query(f"WITH {INV} SELECT k FROM u WHERE k NOT IN (SELECT k FROM s)")
def inventory_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = sides(spark, sf_dir)
    return t.join(s, "k", "left_anti").distinct()


@query(f"WITH {INV} SELECT k FROM s WHERE k IN (SELECT k FROM u)")
def inventory_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = sides(spark, sf_dir)
    return s.join(t, "k", "left_semi").distinct()


@query(f"WITH {INV}, j AS (SELECT CASE WHEN u.k IS NULL THEN 'missing' WHEN s.k IS NULL THEN 'extra' ELSE 'matched' END AS p FROM s FULL JOIN u ON s.k = u.k) SELECT count(*) FILTER (p = 'matched')::BIGINT AS matched, count(*) FILTER (p = 'missing')::BIGINT AS missing, count(*) FILTER (p = 'extra')::BIGINT AS extra FROM j")
def structural_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("presence")
    return parity.inventory(*sides(spark, sf_dir), ["k"]).agg(F.count_if(p == "matched").alias("matched"), F.count_if(p == "source_only").alias("missing"), F.count_if(p == "target_only").alias("extra"))


COLUMN_SETS = [("a.v1", "id,name,amount", "id,name,amount"), ("a.v2", "id,name,amount", "id,amount"), ("a.v3", "id", "id,extra"), ("a.v4", "b,a", "a,b"), ("a.v5", "x,y", "y,z")]


@query(f"""WITH {sql_for_parts("v", "name, s, t", COLUMN_SETS, "name")}, w AS (SELECT name, string_split(s, ',') AS a, string_split(t, ',') AS b FROM v),
d AS (SELECT name, array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ',') AS only_source, array_to_string(list_sort(list_filter(b, lambda x: NOT list_contains(a, x))), ',') AS only_target, array_to_string(list_sort(list_filter(a, lambda x: list_contains(b, x))), ',') AS shared FROM w)
SELECT *, CASE WHEN only_source <> '' THEN 'FAIL' WHEN only_target <> '' THEN 'WARN' ELSE 'PASS' END AS verdict FROM d""")
def column_set_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = rows_for_parts(spark, sf_dir, COLUMN_SETS, "name string, s string, t string", "name").select("name", F.split("s", ",").alias("s"), F.split("t", ",").alias("t"))
    a, b, c = parity.set_diff(F.col("s"), F.col("t"))
    return v.select("name", F.array_join(a, ",").alias("only_source"), F.array_join(b, ",").alias("only_target"), F.array_join(c, ",").alias("shared"), parity.columns_verdict(F.col("s"), F.col("t")).alias("verdict"))


PARAMS = [("p1", "@id,@name", "p_id,p_name"), ("p2", "@id,@name", "par_name,par_id"), ("p3", "@id", "p_id,p_x"), ("p4", "@a,@b", "p_a,p_c")]


@query(f"""WITH {sql_for_parts("v", "name, s, t", PARAMS, "name")}, w AS (SELECT name, list_transform(string_split(s, ','), lambda x: regexp_replace(regexp_replace(lower(x), '^@', ''), '^(par_|p_)', '')) AS a, list_transform(string_split(t, ','), lambda x: regexp_replace(regexp_replace(lower(x), '^@', ''), '^(par_|p_)', '')) AS b FROM v)
SELECT name, CASE WHEN len(a) <> len(b) THEN 'PARAM_COUNT_DIFFERS' WHEN a = b THEN 'PASS' WHEN list_sort(a) = list_sort(b) THEN 'PARAM_ORDER_SWAPPED' ELSE 'PARAM_NAMES_DIFFER' END AS verdict,
 coalesce(array_to_string(list_transform(list_filter(list_zip(a, b), lambda z: z[1] IS DISTINCT FROM z[2]), lambda z: coalesce(z[1], '-') || ':' || coalesce(z[2], '-')), ','), '') AS pairs FROM w""")
def param_order_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = lambda c: F.transform(F.split(c, ","), parity.parameter_name)
    v = rows_for_parts(spark, sf_dir, PARAMS, "name string, s string, t string", "name").select("name", names("s").alias("s"), names("t").alias("t"))
    pairs = F.filter(F.arrays_zip("s", "t"), lambda z: ~z["s"].eqNullSafe(z["t"]))
    text = F.array_join(F.transform(pairs, lambda z: F.concat(F.coalesce(z["s"], F.lit("-")), F.lit(":"), F.coalesce(z["t"], F.lit("-")))), ",")
    return v.select("name", parity.params_verdict(F.col("s"), F.col("t")).alias("verdict"), text.alias("pairs"))


TYPES = [
    ("bit", "boolean"), ("INT", "integer"), ("int", "bigint"), ("bit", "integer"), ("datetime2", "timestamp with time zone"), ("datetime", "timestamp with time zone"), ("sysname", "name"), ("decimal", "numeric(10,2)"), ("nvarchar", "character varying(50)"),
    ("datetime", "date"), ("money", "numeric(19,4)"), ("uniqueidentifier", "uuid"), ("int", "text"), ("xml", "text"), ("text", "text"), ("IdList", "ARRAY"), ("int", "ARRAY"), ("hierarchyid", "ltree"), ("tinyint", "bigint"), ("real", "double precision"),
]


@query(f"""WITH {sql_for_parts("v", "s, t", TYPES)}, w AS (SELECT s, t, lower(s) AS a, trim(regexp_replace(lower(t), '\\(.*\\)', '')) AS b FROM v),
m(a, b) AS (VALUES ('bit', 'boolean'), ('bit', 'integer'), ('int', 'integer'), ('int', 'bigint'), ('bigint', 'integer'), ('tinyint', 'smallint'), ('tinyint', 'bigint'), ('real', 'float4'), ('float', 'double precision'), ('float', 'real'), ('decimal', 'numeric'), ('money', 'numeric'),
 ('nvarchar', 'character varying'), ('nvarchar', 'text'), ('datetime', 'timestamp with time zone'), ('datetime', 'timestamp'), ('datetime2', 'timestamp'), ('datetime2', 'timestamp without time zone'), ('sysname', 'name'), ('sysname', 'text'), ('uniqueidentifier', 'uuid'), ('xml', 'text'), ('hierarchyid', 'text'), ('text', 'text'))
SELECT s AS source_type, t AS target_type, a = b OR (a, b) IN (SELECT (a, b) FROM m) OR (b = 'array' AND a NOT IN (SELECT a FROM m)) AS equivalent FROM w""")
def type_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = rows_for_parts(spark, sf_dir, TYPES, "source_type string, target_type string")
    return v.withColumn("equivalent", parity.types_equivalent(F.col("source_type"), F.col("target_type")))


# name, source and target values as (type, value) that look alike in a double, in six places, or beside a separator
ADVERSARIES = [
    ("big_decimal", "decimal(20,0)", "9007199254740993", "9007199254740992", "FAIL_HASH"),
    ("small_double", "double", "1e-7", "4e-7", "FAIL_HASH"),
    ("scale", "decimal(10,4)", "32.3800", "32.38", "PASS"),
    ("separator", "string", "a\x1fb|c", "a|b\x1fc", "FAIL_HASH"),
    ("null_mark", "string", "\x01N|x", "null|x", "FAIL_HASH"),
    ("backslash", "string", "a\\u|b", "a\x1f|b", "FAIL_HASH"),
    ("zone", "string", "1996-07-04 00:00:00.000|x", "1996-07-04 00:00:00+00:00|x", "PASS"),
    ("zero", "double", "-0.0", "0.0", "PASS"),
]


@query(r"""SELECT * FROM (VALUES ('big_decimal', CASE WHEN 9007199254740993::DECIMAL(20,0) = 9007199254740992::DECIMAL(20,0) THEN 'PASS' ELSE 'FAIL_HASH' END), ('small_double', CASE WHEN 1e-7::DOUBLE = 4e-7::DOUBLE THEN 'PASS' ELSE 'FAIL_HASH' END), ('scale', CASE WHEN 32.3800 = 32.38 THEN 'PASS' ELSE 'FAIL_HASH' END),
 ('separator', CASE WHEN ('a' || chr(31) || 'b', 'c') = ('a', 'b' || chr(31) || 'c') THEN 'PASS' ELSE 'FAIL_HASH' END), ('null_mark', CASE WHEN (chr(1) || 'N') IS NOT DISTINCT FROM NULL THEN 'PASS' ELSE 'FAIL_HASH' END), ('backslash', CASE WHEN '\u' = chr(31) THEN 'PASS' ELSE 'FAIL_HASH' END),
 ('zone', CASE WHEN '1996-07-04 00:00:00.000'::TIMESTAMP = '1996-07-04 00:00:00'::TIMESTAMP THEN 'PASS' ELSE 'FAIL_HASH' END), ('zero', CASE WHEN -0.0::DOUBLE = 0.0::DOUBLE THEN 'PASS' ELSE 'FAIL_HASH' END)) t(probe, verdict)""")
def parity_exact_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that differ although they look alike, and rows that are equal although they don't."""

    def side(value: str, kind: str) -> DataFrame:
        cells = [None if x == "null" else x for x in value.split("|")]
        return spark.createDataFrame([tuple(cells)], ", ".join(f"c{i} string" for i in range(len(cells)))).select(*(F.col(f"c{i}").cast(kind).alias(f"c{i}") for i in range(len(cells))))

    rows = [parity.digest_parity(side(s, k), side(t, k)).select(F.lit(n).alias("probe"), "verdict") for n, k, s, t, _ in ADVERSARIES]
    return reduce(DataFrame.unionByName, rows)


# verdicts of orders as if each were an object of a validation run
RESULT = """r AS (SELECT 'S' || (o_custkey % 5) AS schema_name, CASE o_orderkey % 3 WHEN 0 THEN 'VIEW' WHEN 1 THEN 'PROCEDURE' ELSE 'FUNCTION' END AS object_type, 'obj' || (o_custkey % 200) AS object_name,
 (o_orderkey % 7)::INT AS run_number, CASE WHEN o_orderkey % 11 = 0 THEN 'SKIPPED' WHEN o_orderkey % 13 = 0 THEN 'FAIL' WHEN o_orderkey % 17 = 0 THEN 'TARGET_ERROR' WHEN o_orderkey % 19 = 0 THEN 'PASS_WRITE_PROC' WHEN o_orderkey % 23 = 0 THEN 'FAIL_MISSING_PREREQ' ELSE 'PASS' END AS verdict, o_orderkey FROM orders)"""
PASS_IN, SKIP_IN = ", ".join(f"'{x}'" for x in audit.PASSED), ", ".join(f"'{x}'" for x in audit.SKIPPED)
TALLY = f"count(*) FILTER (verdict IN ({PASS_IN}))::BIGINT AS n_pass, count(*) FILTER (verdict NOT IN ({PASS_IN}) AND verdict NOT IN ({SKIP_IN}))::BIGINT AS n_fail, count(*) FILTER (verdict IN ({SKIP_IN}))::BIGINT AS n_skip"
PCT = "CASE WHEN n_pass + n_fail = 0 THEN 'N/A' ELSE printf('%.1f%%', 100.0 * n_pass / (n_pass + n_fail)) END AS pass_pct"


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    verdict = F.when(k % 11 == 0, "SKIPPED").when(k % 13 == 0, "FAIL").when(k % 17 == 0, "TARGET_ERROR").when(k % 19 == 0, "PASS_WRITE_PROC").when(k % 23 == 0, "FAIL_MISSING_PREREQ").otherwise("PASS")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), F.col("o_custkey") % 5).alias("schema_name"),
        F.when(k % 3 == 0, "VIEW").when(k % 3 == 1, "PROCEDURE").otherwise("FUNCTION").alias("object_type"),
        F.concat(F.lit("obj"), F.col("o_custkey") % 200).alias("object_name"),
        (k % 7).cast("int").alias("run_number"),
        verdict.alias("verdict"),
        "o_orderkey",
    )


@query(f"WITH {RESULT}, g AS (SELECT CASE WHEN grouping(schema_name) = 1 THEN 'TOTAL' ELSE schema_name END AS schema_name, CASE WHEN grouping(schema_name) = 1 THEN 'TOTAL' ELSE object_type END AS object_type, count(*)::BIGINT AS n, {TALLY} FROM r GROUP BY GROUPING SETS ((schema_name, object_type), ())) SELECT *, {PCT} FROM g")
def verdict_summary_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.rollup(results(spark, sf_dir))


@query(f"WITH {RESULT} SELECT run_number, {TALLY} FROM r GROUP BY 1")
def verdict_filtered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(spark, sf_dir).groupBy("run_number").agg(*audit.tallies(F.col("verdict")))


@query(f"WITH {RESULT} SELECT verdict, object_type, run_number, count(*)::BIGINT AS n FROM r GROUP BY ALL")
def verdict_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(spark, sf_dir).groupBy("verdict", "object_type", "run_number").agg(F.count("*").alias("n"))


@query(f"WITH {RESULT}, g AS (SELECT schema_name, {TALLY} FROM r GROUP BY 1) SELECT schema_name, {PCT}, round(100.0 * n_pass / nullif(n_pass + n_fail + n_skip, 0), 1) AS pass_of_all FROM g")
def pass_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = results(spark, sf_dir).groupBy("schema_name").agg(*audit.tallies(F.col("verdict")))
    p, f, s = F.col("n_pass"), F.col("n_fail"), F.col("n_skip")
    return g.select("schema_name", audit.pass_percent(p, f).alias("pass_pct"), F.round(F.try_divide(100.0 * p, p + f + s), 1).alias("pass_of_all"))


@query(f"WITH {RESULT}, u AS (SELECT schema_name, object_name, run_number, min(verdict) AS verdict FROM r GROUP BY ALL) SELECT schema_name, object_name, run_number, verdict FROM (SELECT *, row_number() OVER (PARTITION BY schema_name, object_name ORDER BY verdict = 'SKIPPED', run_number DESC) AS p FROM u) WHERE p = 1")
def verdict_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = results(spark, sf_dir).groupBy("schema_name", "object_name", "run_number").agg(F.min("verdict").alias("verdict"))
    return audit.latest(one, ["schema_name", "object_name"])


RUNS = [(1, "full tables"), (2, "views only"), (3, "procs"), (4, "Views rerun"), (5, "all")]
RUN_VALUES = ", ".join(f"({a}, '{b}')" for a, b in RUNS)


@query(f"WITH v(run_number, notes) AS (VALUES {RUN_VALUES}) " + " UNION ALL ".join(f"SELECT '{w}' AS keyword, coalesce(max(run_number) FILTER (contains(lower(notes), '{w}')), max(run_number))::INT AS run_number FROM v" for w in ("views", "triggers")))
def latest_run_by_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spark.createDataFrame(RUNS, "run_number int, notes string")
    return reduce(DataFrame.union, [audit.latest_run(runs, w).select(F.lit(w).alias("keyword"), "run_number") for w in ("views", "triggers")])


@query(f"WITH {RESULT}, g AS (SELECT run_number, {TALLY}, count(*)::BIGINT AS n FROM r GROUP BY 1) SELECT run_number, CASE WHEN n_pass + n_fail = 0 THEN 'NOT STARTED' WHEN n_pass + n_fail < n THEN 'IN PROGRESS' WHEN n_fail > 0 THEN 'NEEDS ATTENTION' ELSE 'COMPLETE' END AS status, CASE WHEN n_fail > 100 THEN 'BLOCKED' WHEN n_fail > 0 THEN 'NEEDS ATTENTION' WHEN n_skip > n THEN 'IN PROGRESS' ELSE 'COMPLETE' END AS overall FROM g")
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = results(spark, sf_dir).groupBy("run_number").agg(*audit.tallies(F.col("verdict")), F.count("*").alias("n"))
    f, zero = F.col("n_fail"), F.lit(0)
    return g.select("run_number", audit.run_status(F.col("n"), F.col("n_pass") + f, f).alias("status"), audit.overall_status(f > 100, f, zero, F.col("n_skip") <= F.col("n"), zero).alias("overall"))


CALL = """c AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 29 = 0 THEN 'SKIPPED' WHEN o_orderkey % 7 = 0 THEN 'ERROR' ELSE 'OK' END AS s_status,
 CASE WHEN o_orderkey % 29 = 0 THEN 'SKIPPED' WHEN o_orderkey % 31 = 0 THEN 'FAIL_HARNESS' WHEN o_orderkey % 14 = 0 OR o_orderkey % 5 = 0 THEN 'ERROR' WHEN o_orderkey % 37 = 0 THEN 'NO_RESULTSET' ELSE 'OK' END AS t_status,
 o_orderkey % 28 = 0 AS prereq, o_custkey % 4 AS s_rows, (o_custkey + (CASE WHEN o_orderkey % 41 = 0 THEN 1 ELSE 0 END)) % 4 AS t_rows, CASE WHEN o_orderkey % 43 = 0 THEN 0 ELSE 1 END AS s_sets, CASE WHEN o_orderkey % 43 = 0 OR o_orderkey % 47 = 0 THEN 0 ELSE 1 END AS t_sets,
 CASE WHEN o_orderkey % 53 = 0 THEN 1 ELSE 0 END AS s_extra, o_totalprice AS s_hash, CASE WHEN o_orderkey % 59 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS t_hash FROM orders)"""


@query(f"""WITH {CALL} SELECT verdict, issues, count(*)::BIGINT AS n FROM (SELECT CASE WHEN s_status = 'SKIPPED' AND t_status = 'SKIPPED' THEN 'SKIPPED' WHEN t_status = 'FAIL_HARNESS' THEN 'FAIL_HARNESS'
 WHEN s_status = 'ERROR' AND t_status = 'ERROR' THEN CASE WHEN prereq THEN 'FAIL_MISSING_PREREQ' ELSE 'BOTH_FAILED' END WHEN s_status = 'ERROR' THEN 'SOURCE_ERROR' WHEN t_status = 'ERROR' THEN 'TARGET_ERROR'
 WHEN t_status = 'NO_RESULTSET' THEN CASE WHEN s_rows = 0 THEN 'PASS_DML_PROC' ELSE 'TARGET_NO_RESULTSET' END WHEN s_sets = 0 AND t_sets = 0 THEN 'PASS_DML_PROC'
 WHEN s_sets <> t_sets OR s_extra = 1 OR s_rows <> t_rows OR s_hash <> t_hash THEN 'FAIL' ELSE 'PASS' END AS verdict,
 concat_ws(',', CASE WHEN s_sets <> t_sets THEN 'RESULT_SET_COUNT' END, CASE WHEN s_extra = 1 THEN 'COLUMNS' END, CASE WHEN s_rows <> t_rows THEN 'ROW_COUNT' END, CASE WHEN s_hash <> t_hash THEN 'CONTENT' END) AS issues FROM c) GROUP BY ALL""")
def verdict_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_of_verdicts")
    calls = spark.sql(f"WITH {CALL.replace('FROM orders)', 'FROM orders_of_verdicts)')} SELECT *, array('a', 'b') AS t_columns, CASE WHEN s_extra = 1 THEN array('a', 'b', 'x') ELSE array('b', 'a') END AS s_columns FROM c")
    c = {x: F.col(x) for x in calls.columns}
    return calls.select(parity.routine_verdict(c).alias("verdict"), F.array_join(parity.routine_issues(c), ",").alias("issues")).groupBy("verdict", "issues").agg(F.count("*").alias("n"))


ERRORS = [
    (1, "app.p1", 'column "x" does not exist'),
    (2, "app.p2", 'relation "a.b" does not exist'),
    (3, "app.p3", "syntax error at or near \"BEGIN\""),
    (4, "app.p4", 'column "y" does not exist'),
    (5, "app.p5", "division by zero"),
    (6, "app.p1", 'column "x" does not exist'),
    (7, "app.p6", "something odd happened in the middle of a rather long message that goes on"),
    (8, "app.p7", None),
    (9, "app.p8", "cannot cast type text to integer"),
    (10, "app.p9", "ERROR 547 foreign key conflict"),
    (11, "app.p9", "SQLSTATE 23505 duplicate"),
    (12, "app.p2", 'type "t%rowcount" does not exist'),
    (13, "app.q1", 'type "ROWCOUNT" does not exist'),
    (14, "app.q2", "syntax error at or near \"```\""),
    (15, "app.q3", "cannot use RETURN QUERY in a non-SETOF function"),
    (16, "app.q4", "unterminated double quoted identifier"),
    (17, "app.q5", "cursor loop must have a bound cursor"),
    (18, "app.q6", "undeclared variable v_x"),
    (19, "app.q7", "operator does not exist: integer = text"),
    (20, "app.q8", "permission denied for table t"),
    (21, "app.q9", 'relation "t" already exists'),
    (22, "app.r1", "ambiguous column name"),
    (23, "app.r2", "function f(integer) does not exist"),
    (24, "app.r3", "syntax error in the middle"),
    (25, "app.r4", "   "),
]
quoted = lambda x: "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"
#: An error of each order: the one at the place that its key tells.
ERROR_ROWS = f"e AS (SELECT o_orderkey AS entry, object_name, error FROM orders JOIN (VALUES {sql_rows([(b, c) for _, b, c in ERRORS])}) t(place, object_name, error) ON o_orderkey % {len(ERRORS)} = place)"
LADDER = """CASE WHEN trim(coalesce(error, '')) = '' THEN 'unknown' WHEN lower(error) LIKE '%column _% does not exist%' THEN 'column_does_not_exist' WHEN lower(error) LIKE '%relation _% does not exist%' THEN 'relation_does_not_exist'
 WHEN lower(error) LIKE '%function _% does not exist%' THEN 'function_does_not_exist' WHEN regexp_matches(lower(error), 'type "(count|rowcount|_row_count)" does not exist') THEN 'rowcount_conversion_bug' WHEN lower(error) LIKE '%type _% does not exist%' THEN 'type_does_not_exist'
 WHEN lower(error) LIKE '%syntax error at or near_%`%' THEN 'code_fence_leak' WHEN lower(error) LIKE '%syntax error at or near%' THEN 'syntax_error' WHEN lower(error) LIKE '%cannot use return query in a non_setof%' THEN 'non_setof_return_query' WHEN lower(error) LIKE '%unterminated % quoted%' THEN 'unterminated_quoted_identifier'
 WHEN lower(error) LIKE '%division by zero%' THEN 'division_by_zero' WHEN lower(error) LIKE '%cursor%' THEN 'cursor_loop' WHEN lower(error) LIKE '%undeclared variable%' THEN 'undeclared_variable' WHEN lower(error) LIKE '%operator does not exist%' THEN 'operator_type_mismatch' WHEN lower(error) LIKE '%permission denied%' THEN 'permission_denied'
 WHEN lower(error) LIKE '%already exists%' THEN 'already_exists' WHEN lower(error) LIKE '%cannot cast%' THEN 'cast_error' WHEN lower(error) LIKE '%ambiguous column%' THEN 'ambiguous_column' ELSE 'other:' || substr(error, 1, 60) END"""


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("entry"))
    return one_of(orders, "entry", [(b, c) for _, b, c in ERRORS], "object_name string, error string")


@query(f"WITH {ERROR_ROWS} SELECT entry, {LADDER} AS error_class FROM e")
def error_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors(spark, sf_dir).select("entry", audit.classify_error(F.col("error")).alias("error_class"))


ROUTE = """CASE WHEN error_class IN ('column_does_not_exist', 'relation_does_not_exist', 'syntax_error', 'undeclared_variable', 'operator_type_mismatch') THEN 'rule' WHEN error_class = 'function_does_not_exist' THEN 'function-sub' WHEN error_class IN ('type_does_not_exist', 'cast_error') THEN 'type-mapping'
 WHEN error_class IN ('rowcount_conversion_bug', 'code_fence_leak', 'row_count_mismatch', 'missing_in_target') THEN 'script' ELSE 'prompt' END"""


@query(f"""WITH {ERROR_ROWS}, k AS (SELECT *, {LADDER} AS error_class FROM e), d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY object_name, error_class ORDER BY entry) AS p FROM k) WHERE p = 1),
g AS (SELECT error_class, count(*)::BIGINT AS n, array_to_string(list_sort(list_distinct(list(object_name))), ',') AS objects, first(error ORDER BY entry) AS first_error, min(entry) AS first_entry FROM d GROUP BY 1)
SELECT row_number() OVER (ORDER BY n DESC, first_entry)::INT AS rank, error_class, n, objects, first_error, {ROUTE} AS fix_route FROM g""")
def error_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = errors(spark, sf_dir).withColumn("kind", audit.classify_error(F.col("error")))
    return audit.failure_ranking(audit.deduplicated(kinds, ["object_name", "kind"], "entry"))


EXPECTED = "coalesce(regexp_extract(error, '(?i)(?:error|msg)\\s*:?\\s*(\\d+)', 1) IN ({}) OR substr(regexp_extract(error, '(?i)sqlstate\\W*([0-9A-Z]{{5}})', 1), 1, 2) IN ({}) OR {}, false)".format(
    ", ".join(map(quoted, parity.EXPECTED_CODES)), ", ".join(map(quoted, parity.EXPECTED_STATES)), " OR ".join(f"contains(lower(error), {quoted(p)})" for p in parity.EXPECTED_PHRASES)
)


@query(f"WITH {ERROR_ROWS} SELECT entry, {EXPECTED} AS expected, CASE WHEN error IS NULL THEN 'PASS_WRITE_PROC' WHEN {EXPECTED} THEN 'WRITE_EXPECTED_FAIL' ELSE 'WRITE_BOTH_FAILED' END AS verdict FROM e")
def expected_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("error")
    ok = e.isNull()
    return errors(spark, sf_dir).select("entry", parity.expected_error(e).alias("expected"), parity.write_verdict(ok, ok, e, e).alias("verdict"))


RULES = [("fk_parent", ["foreign key", "violates"], []), ("cast", [], ["cast", "integer"])]


@query(f"WITH {ERROR_ROWS} SELECT entry, CASE WHEN contains(error, 'foreign key') OR contains(error, 'violates') THEN 'fk_parent' WHEN contains(error, 'cast') AND contains(error, 'integer') THEN 'cast' END AS rule FROM e")
def error_reclassify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors(spark, sf_dir).select("entry", parity.reclassified(F.col("error"), RULES).alias("rule"))


MERGE = [("a", "tables", 1, 5, 1), ("a", "tables", 2, 6, 0), ("b", "tables", 1, 3, 2), ("a", "views", 1, 2, 2)]
MERGE_VALUES = ", ".join(f"('{a}', '{b}', {c}, {d}, {e})" for a, b, c, d, e in MERGE)


@query(f"WITH m(source_db, phase, seen, ok, failed) AS (VALUES {MERGE_VALUES}) SELECT phase, sum(ok)::BIGINT AS ok, sum(failed)::BIGINT AS failed FROM (SELECT *, row_number() OVER (PARTITION BY source_db, phase ORDER BY seen DESC) AS p FROM m) WHERE p = 1 GROUP BY phase")
def multi_db_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.merged_summaries(spark.createDataFrame(MERGE, "source_db string, phase string, seen int, ok int, failed int"), ["phase"])


@query("""WITH d AS (SELECT o_orderpriority AS p, sum(o_orderkey % 5 = 0)::BIGINT AS m, count(*)::BIGINT AS n FROM orders GROUP BY 1) SELECT p AS object_type, m AS markers, n AS objects, CASE WHEN m::DOUBLE / n >= 0.3 THEN 'high' WHEN m::DOUBLE / n >= 0.1 THEN 'medium' ELSE 'low' END AS density FROM d""")
def ewi_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("object_type")).agg(F.count_if(F.col("o_orderkey") % 5 == 0).alias("markers"), F.count("*").alias("objects"))
    return g.withColumn("density", audit.marker_density(F.col("markers"), F.col("objects")))


STATE = "CASE o_orderkey % 6 WHEN 0 THEN 'done' WHEN 1 THEN 'failed' WHEN 2 THEN 'pending' WHEN 3 THEN 'skipped' ELSE 'done' END"


@query(f"SELECT state, count(*)::BIGINT AS n, state NOT IN ('done', 'skipped') AS resume, state = 'failed' AS force_failed, true AS force_rerun FROM (SELECT {STATE} AS state FROM orders) GROUP BY state")
def manifest_needs(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = table(spark, sf_dir, "orders").select(F.expr(STATE).alias("state")).groupBy("state").agg(F.count("*").alias("n"))
    return states.select("state", "n", *(audit.objects_needing(F.col("state"), m).alias(m) for m in ("resume", "force_failed", "force_rerun")))


@query(f"SELECT tier, state, count(*)::BIGINT AS n FROM (SELECT unnest(['convert', 'deploy', 'validate']) AS tier, unnest([{STATE}, {STATE.replace('o_orderkey', '(o_orderkey // 6)')}, {STATE.replace('o_orderkey', '(o_orderkey // 36)')}]) AS state FROM orders) GROUP BY ALL")
def manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "orders").select(*(F.expr(STATE.replace("o_orderkey", f"(o_orderkey div {d})")).alias(t) for t, d in (("convert", 1), ("deploy", 6), ("validate", 36))))
    return wide.unpivot([], ["convert", "deploy", "validate"], "tier", "state").groupBy("tier", "state").agg(F.count("*").alias("n"))


@query(f"SELECT object_type, count(*)::BIGINT AS n, round(100.0 * sum((verdict = 'PASS')::INT) / count(*), 1) AS first_pass_rate, round(100.0 * sum((verdict = 'PASS_WRITE_PROC')::INT) / count(*), 1) AS repair_rate, round(100.0 * sum((verdict NOT IN ('PASS', 'PASS_WRITE_PROC'))::INT) / count(*), 1) AS manual_rate FROM (WITH {RESULT} FROM r) GROUP BY 1")
def conversion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("verdict")
    rate = lambda c: F.round(100.0 * F.count_if(c) / F.count("*"), 1)
    return results(spark, sf_dir).groupBy("object_type").agg(F.count("*").alias("n"), rate(v == "PASS").alias("first_pass_rate"), rate(v == "PASS_WRITE_PROC").alias("repair_rate"), rate(~v.isin("PASS", "PASS_WRITE_PROC")).alias("manual_rate"))


PHASES = [("table", 10, 10), ("view", 5, 10), ("index", 150, 150), ("function", 0, 0)]
PHASE_VALUES = ", ".join(f"('{a}', {b}, {c})" for a, b, c in PHASES)


@query(f"WITH p(kind, ok, total) AS (VALUES {PHASE_VALUES}) SELECT coalesce(round(100.0 * sum(ok) FILTER (kind <> 'index') / nullif(sum(total) FILTER (kind <> 'index'), 0), 1), 100.0) AS migration_pct FROM p")
def migration_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deployed objects as a share of the source's; indexes don't count, and nothing to do is all done."""
    p = spark.createDataFrame(PHASES, "kind string, ok int, total int").where("kind <> 'index'")
    return p.agg(F.coalesce(F.round(F.try_divide(100.0 * F.sum("ok"), F.sum("total")), 1), F.lit(100.0)).alias("migration_pct"))


@query("""WITH i AS (SELECT o_orderkey AS k, (o_orderkey % 10 < 8)::INT AS ok, (o_orderkey % 10 = 8 OR o_orderkey % 40 = 3)::INT AS bad, 0 AS skip FROM orders) SELECT CASE WHEN ok + bad + skip = 0 THEN 'unaccounted' WHEN ok + bad + skip = 1 THEN 'once' ELSE 'repeated' END AS accounted, count(*)::BIGINT AS n FROM i GROUP BY 1""")
def postcondition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every object must have ended in exactly one of succeeded, failed and skipped."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    done = o.where("k % 10 < 8").unionByName(o.where("k % 10 = 8 OR k % 40 = 3")).groupBy("k").agg(F.count("*").alias("ends"))
    ends = F.coalesce("ends", F.lit(0))
    return o.join(done, "k", "left").select(F.when(ends == 0, "unaccounted").when(ends == 1, "once").otherwise("repeated").alias("accounted")).groupBy("accounted").agg(F.count("*").alias("n"))


@query("""SELECT d.k AS o_orderkey, CASE WHEN d.failed AND p.k IS NOT NULL THEN 'rescued' WHEN d.failed THEN 'failed' WHEN p.k IS NULL THEN 'unproven' ELSE 'deployed' END AS state FROM (SELECT o_orderkey AS k, o_orderkey % 9 = 0 AS failed FROM orders) d LEFT JOIN (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 4 <> 1) p ON d.k = p.k""")
def reconcile_deploy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What deployment reports, corrected by what parity found on the target."""
    o = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderkey % 9 = 0 AS failed")
    proven = o.where("o_orderkey % 4 <> 1").selectExpr("o_orderkey", "true AS proven")
    state = F.when(F.col("failed") & F.col("proven"), "rescued").when(F.col("failed"), "failed").when(F.col("proven").isNull(), "unproven").otherwise("deployed")
    return o.join(proven, "o_orderkey", "left").select("o_orderkey", state.alias("state"))


@query("""WITH g AS (SELECT o_orderpriority AS area, count(*) FILTER (o_orderkey % 3 > 0) AS ok, count(*) AS n FROM orders GROUP BY 1) SELECT area, round(100.0 * ok / n, 1) AS success, CASE WHEN 100.0 * ok / n < 60 THEN 'review rules' WHEN 100.0 * ok / n < 67 THEN 'watch' ELSE 'keep' END AS advice FROM g""")
def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("area")).agg((100.0 * F.count_if(F.col("o_orderkey") % 3 > 0) / F.count("*")).alias("x"))
    return g.select("area", F.round("x", 1).alias("success"), F.when(F.col("x") < 60, "review rules").when(F.col("x") < 67, "watch").otherwise("keep").alias("advice"))


TRIGGERS = [("source", "app.trg_a_trigger", "t1", "INSERT,UPDATE"), ("source", "app.trg_b", "t2", "DELETE"), ("source", "app.trg_c", "t3", "INSERT"), ("target", "trg_a_fn", "t1", "UPDATE,INSERT"), ("target", "x.trg_b", "t2", "DELETE,INSERT"), ("target", "trg_d", "t9", "INSERT")]


@query(f"""WITH v AS (SELECT side, replace(name, 'trg', 'trg' || s_suppkey) AS name, tab, events FROM supplier, (VALUES {sql_rows(TRIGGERS)}) t(place, side, name, tab, events)), w AS (SELECT side, regexp_replace(regexp_replace(lower(name), '^.*\\.', ''), '(_trigger|_fn)$', '') AS name, tab, list_sort(string_split(events, ',')) AS events FROM v)
SELECT coalesce(s.name, t.name) AS name, CASE WHEN t.name IS NULL THEN 'SOURCE_ONLY' WHEN s.name IS NULL THEN 'TARGET_ONLY' WHEN s.tab <> t.tab THEN 'TABLE_DIFFERS' WHEN s.events <> t.events THEN 'EVENTS_DIFFER' ELSE 'PASS' END AS verdict FROM (FROM w WHERE side = 'source') s FULL JOIN (FROM w WHERE side = 'target') t ON s.name = t.name""")
def trigger_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = for_each(table(spark, sf_dir, "supplier").select("s_suppkey"), TRIGGERS, "side string, name string, tab string, events string")
    v = v.withColumn("name", F.replace("name", F.lit("trg"), F.concat(F.lit("trg"), "s_suppkey"))).select("side", parity.trigger_name(F.col("name")).alias("name"), "tab", F.array_sort(F.split("events", ",")).alias("events"))
    s, t = (v.where(F.col("side") == x).select("name", F.col("tab").alias(f"{x}_tab"), F.col("events").alias(f"{x}_events")) for x in ("source", "target"))
    verdict = F.when(F.col("target_tab").isNull(), "SOURCE_ONLY").when(F.col("source_tab").isNull(), "TARGET_ONLY").when(F.col("source_tab") != F.col("target_tab"), "TABLE_DIFFERS").when(F.col("source_events") != F.col("target_events"), "EVENTS_DIFFER").otherwise("PASS")
    return s.join(t, "name", "full_outer").select("name", verdict.alias("verdict"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*)::BIGINT AS n FROM {t}" for t in TABLES))
def union_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [table(spark, sf_dir, t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n")) for t in TABLES])




@query("SELECT o_custkey % 9 AS k, sum(o_orderkey % 3 = 0)::BIGINT AS p, sum(o_orderkey % 3 = 1)::BIGINT AS f, sum(o_orderkey % 3 = 2)::BIGINT AS s, round(100.0 * sum(o_orderkey % 3 = 0) / count(*))::INT || '%' AS pct FROM orders GROUP BY 1 UNION ALL SELECT -1, 0, 0, 0, '-'")
def share_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    g = o.groupBy((F.col("o_custkey") % 9).alias("k")).agg(*(F.count_if(F.col("o_orderkey") % 3 == i).alias(n) for i, n in enumerate("pfs")))
    g = g.unionByName(spark.createDataFrame([(-1, 0, 0, 0)], "k long, p long, f long, s long"))
    return g.withColumn("pct", audit.share_percent(F.col("p"), F.col("f"), F.col("s")))


@query("WITH m AS (SELECT 'o' || o_orderkey AS fqn, unnest(['EWI-' || (o_orderkey % 40), 'EWI-' || (o_custkey % 3)]) AS code FROM orders WHERE o_orderkey % 9 = 0) SELECT code, count(*)::BIGINT AS n, count(DISTINCT fqn)::BIGINT AS objects FROM m GROUP BY 1 HAVING count(*) >= 5")
def frequent_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = lambda c, n: F.concat(F.lit("EWI-"), F.col(c) % n)
    o = table(spark, sf_dir, "orders").where("o_orderkey % 9 = 0").select(F.concat(F.lit("o"), "o_orderkey").alias("fqn"), F.array(code("o_orderkey", 40), code("o_custkey", 3)).alias("codes"))
    return audit.frequent_markers(o)


ROUTINES = ["app.GetOrders", "app.UpdateOrder", "app.PosUserCartArchive", "app.audit_update_x", "app.list_insertions", "app.read"]


@query("SELECT n AS name, regexp_matches(lower(n), 'update|delete|insert|archive|cancel|upsert|moveprecart|closecartprocessing|menuitemlocationshare|processlogexport') AS skipped FROM (VALUES " + ", ".join(f"('{n}')" for n in ROUTINES) + ") t(n)")
def write_routines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in ROUTINES], "name string").withColumn("skipped", audit.writes(F.col("name")))


@query("SELECT o_orderstatus AS verdict, o_orderpriority AS name, count(*)::BIGINT AS n, row_number() OVER (ORDER BY o_orderstatus DESC, o_orderpriority) AS place FROM orders GROUP BY 1, 2")
def lexicographic_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("verdict"), F.col("o_orderpriority").alias("name")).agg(F.count("*").alias("n"))
    return g.selectExpr("*", "cast(row_number() OVER (ORDER BY verdict DESC, name) AS bigint) AS place")
