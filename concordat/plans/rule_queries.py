"""Queries of rules over definitions: one text for each code that has what it looks for and one that only looks like it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.operators import graph, scan

from .registry import for_each, one_of, query, table

TEXTS = [
    ("function", "a.block1", "CREATE FUNCTION f() LANGUAGE plpython2u"), ("function", "a.block1b", "LANGUAGE plphp"), ("function", "a.fine1", "CREATE FUNCTION f() LANGUAGE plpgsql"),
    ("script", "a.block2", "CREATE ROLE boss WITH SUPERUSER"), ("script", "a.block2b", "SET ROLE postgres"), ("script", "a.fine2", "CREATE ROLE clerk WITH LOGIN"),
    ("script", "a.block3", "ALTER SYSTEM SET x = 1"), ("script", "a.fine3", "ALTER TABLE system ADD x int"),
    ("function", "a.block4", "SELECT pg_ls_waldir()"), ("script", "a.block4b", "COPY t TO PROGRAM 'gzip'"), ("script", "a.fine4", "COPY t FROM STDIN"),
    ("script", "a.block5", "UPDATE pg_catalog.pg_class SET relname = 'x'"), ("view", "a.fine5", "SELECT * FROM pg_catalog.pg_class"),
    ("script", "a.block6", "CREATE EXTENSION IF NOT EXISTS timescaledb"), ("script", "a.block6b", 'CREATE EXTENSION "plr-x"'), ("script", "a.fine6", 'CREATE EXTENSION IF NOT EXISTS "uuid_ossp"'), ("script", "a.fine6b", "CREATE EXTENSION hstore"),
    ("table", "a.warn1", "CREATE TABLE t (g GEOGRAPHY)"), ("table", "a.fine7", "CREATE TABLE t (g geographical)"),
    ("script", "a.warn3", "SET wal_keep_size = 1"), ("script", "a.fine8", "SET search_path = x"),
    ("script", "a.warn4", "CREATE OR REPLACE PACKAGE p AS"), ("script", "a.warn5", "BEGIN dbms_scheduler.create_job; END"), ("script", "a.warn6", "FOREIGN DATA WRAPPER mysql_fdw"), ("script", "a.fine9", "FOREIGN DATA WRAPPER postgres_fdw"),
    ("procedure", "a.warn7", "DECLARE c CURSOR FOR SELECT 1"), ("view", "a.fine10", "SELECT * FROM c -- FETCH x"), ("procedure", "a.warn8", "EXEC sp_executesql @s"), ("procedure", "a.warn8b", "EXECUTE IMMEDIATE s"), ("procedure", "a.warn8c", "PREPARE s FROM @x"),
    ("view", "a.warn9", "SELECT * FROM t PIVOT (sum(x) FOR k IN ([a])) p"), ("procedure", "a.fine11", "-- PIVOT (x)"), ("table", "a.warn10", "CREATE TABLE t (h hierarchyid)"), ("procedure", "a.warn10b", "CREATE PROCEDURE p @t dbo.IdList READONLY AS"), ("view", "a.fine12", "SELECT readonly FROM t"),
    ("view", "a.warn11", "SELECT * FROM other.app.t"), ("view", "a.fine13", "SELECT * FROM app.t"), ("view", "a.warn12", "SELECT getdate() UNION SELECT CAST(x AS nvarchar) FROM t"), ("view", "a.fine14", "SELECT getdate() UNION SELECT x FROM t"),
    ("view", "a.warn13", "SELECT * FROM t JOIN u ON t.ObjectKey = u.ClientID"), ("view", "a.fine15", "SELECT ObjectKey FROM t"), ("table", "a.warn14", "CREATE TABLE t (a TINYINT(1), b tinyint( 1 ))"), ("table", "a.fine16", "CREATE TABLE t (a TINYINT(4))"),
    ("table", "b.uuid", "CREATE TABLE t (id uniqueidentifier DEFAULT newid())"), ("function", "b.uuid2", "SELECT sys_guid()"), ("function", "b.crypto", "SELECT HASHBYTES('MD5', x)"), ("function", "b.fine17", "SELECT md50(x)"), ("table", "b.none", None),
    ("procedure", "aspnet_x.p", "SELECT 1"), ("view", "dbo.vw_aspnet_users", "SELECT 1"), ("procedure", "dbo.aspnet_get", "SELECT 1"), ("table", "dbo.my_aspnet", "SELECT 1"), ("procedure", "dbo.job", "EXEC msdb.dbo.x"), ("procedure", "dbo.job2", "SELECT * FROM sysjobs"), ("procedure", "dbo.nojob", "SELECT * FROM mymsdbs"),
    ("view", "dbo.remote", "SELECT * FROM srv.db.dbo.tab"), ("view", "dbo.local", "SELECT * FROM db.dbo.tab"), ("script", "dbo.clr", "CREATE ASSEMBLY x FROM 'y'"), ("function", "dbo.clr2", "AS EXTERNAL NAME a.b"), ("function", "dbo.noclr", "SELECT clrx"), ("udtt", "dbo.ids", "x"), ("script", "dbo.ids2", "CREATE TYPE ids AS TABLE (id int)"),
    ("procedure", "dbo.xp_own", "SELECT 1"), ("procedure", "dbo.ext", "EXEC xp_logevent (1)"), ("procedure", "dbo.noext", "EXEC xp_logevent 1"), ("table", "dbo.hist", "CREATE TABLE t (x int) WITH (SYSTEM_VERSIONING = ON)"), ("view", "dbo.hist2", "SELECT * FROM t FOR SYSTEM_TIME ALL"), ("table", "dbo.nohist", "CREATE TABLE t (x int) WITH (SYSTEM_VERSIONING = OFF)"),
]
text = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'"
#: An object for each part: the text at the place that its key tells, under a name of its own.
OBJECTS = f"o AS (SELECT type, fqn || '_' || p_partkey AS fqn, coalesce(ddl, '') AS ddl, lower(coalesce(ddl, '')) AS d FROM part JOIN (VALUES " + ", ".join(f"({i}, {text(t)}, {text(f)}, {text(d)})" for i, (t, f, d) in enumerate(TEXTS)) + f") t(place, type, fqn, ddl) ON p_partkey % {len(TEXTS)} = place)"
word = lambda *ws: "regexp_matches(d, '\\b(" + "|".join(ws) + ")\\b')"

#: What each code means, written out again in SQL.
CODES = {
    "BLOCK-001": " OR ".join(f"contains(d, '{x}')" for x in ("plpython", "plperl", "pltcl", "plv8", "plcoffee", "plls", "plruby", "plr", "pljava", "plphp", "plscheme")),
    "BLOCK-002": "(regexp_matches(d, '(create|alter)\\s+role\\s+\\w+.*superuser') OR regexp_matches(d, 'set\\s+role\\s+(postgres|\\w*superuser)'))",
    "BLOCK-003": "regexp_matches(d, '\\balter\\s+system\\b')",
    "BLOCK-004": "(" + " OR ".join(f"contains(d, '{x}')" for x in ("pg_read_file", "pg_read_binary_file", "pg_ls_dir", "pg_ls_waldir", "pg_ls_logdir", "pg_stat_file", "lo_import", "lo_export", "pg_write_file")) + " OR regexp_matches(d, '\\bcopy\\b.+\\bprogram\\b'))",
    "BLOCK-005": "regexp_matches(d, '\\bpg_catalog\\b|\\bsystem\\s+catalog\\b') AND " + word("insert", "update", "delete", "alter"),
    "BLOCK-006": "regexp_extract(d, 'create\\s+extension\\s+(?:if\\s+not\\s+exists\\s+)?[\"'']?(\\w[\\w-]*)', 1) NOT IN ('', 'uuid_ossp', 'hstore')",
    "WARN-001": word("geography", "geometry", "sdo_geometry", "sdo_point_type"),
    "WARN-003": "regexp_matches(d, '\\bset\\s+(max_connections|shared_buffers|effective_cache_size|wal_level|archive_mode|wal_keep_size|max_wal_senders|max_replication_slots|shared_preload_libraries)\\b')",
    "WARN-005": "(" + word("dbms_scheduler", "pg_agent") + " OR contains(d, 'pg_cron.schedule'))",
    "WARN-006": "regexp_extract(d, 'foreign\\s+data\\s+wrapper\\s+(\\w+)', 1) NOT IN ('', 'postgres_fdw', 'file_fdw')",
    "WARN-007": "type IN ('procedure', 'function') AND (regexp_matches(d, '\\bdeclare\\s+\\w+\\s+cursor\\b') OR regexp_matches(d, '\\b(open|fetch)\\s+\\w+') OR regexp_matches(d, 'cursor\\s+for'))",
    "WARN-009": "type = 'view' AND regexp_matches(d, '\\bpivot\\s*\\(')",
    "WARN-012": "type = 'view' AND " + word("union") + " AND regexp_matches(d, '\\b(current_date|current_timestamp)\\b|getdate\\s*\\(\\s*\\)|now\\s*\\(\\s*\\)') AND regexp_matches(d, 'cast\\s*\\([^)]+as\\s+(text|varchar|nvarchar)\\s*\\)')",
    "WARN-013": "type = 'view' AND " + word("objectkey") + " AND " + word("orderid", "itemid", "clientid", "vendorid", "userid", "personid"),
}
DYNAMIC = {"mssql": "contains(d, 'sp_executesql')", "mysql": "regexp_matches(d, 'prepare\\s+\\w+\\s+from')", "oracle": "regexp_matches(d, 'execute\\s+immediate')"}


def found(source: str) -> str:
    rules = [(c, p) for c, p in CODES.items()] + [("WARN-008", DYNAMIC[source]), ("WARN-010", word("hierarchyid")), ("WARN-010", "type IN ('procedure', 'function') AND (" + word("readonly") + " OR regexp_matches(d, 'table\\s+type|as\\s+table\\s*\\('))")]
    if source == "oracle":
        rules.append(("WARN-004", "regexp_matches(d, 'create\\s+(or\\s+replace\\s+)?package\\b')"))
    if source == "mysql":
        rules.append(("WARN-011", "type = 'view' AND regexp_matches(d, '\\w+\\.\\w+\\.\\w+')"))
    parts = [f"SELECT fqn, '{c}' AS code, '{c.split('-')[0]}' AS severity FROM o WHERE {p}" for c, p in rules]
    parts += [
        f"SELECT '(pre-deploy)', 'RESOLVE-001', 'RESOLVE' FROM o WHERE {CODES['WARN-001']} HAVING count(*) > 0",
        f"SELECT '(pre-deploy)', 'RESOLVE-003', 'RESOLVE' FROM o WHERE {word('hierarchyid')} HAVING count(*) > 0",
        "SELECT min(fqn), 'RESOLVE-003', 'RESOLVE' FROM o WHERE regexp_matches(d, '\\b(newid|sys_guid|uuid_generate|gen_random_uuid|uuid)\\s*\\(') HAVING count(*) > 0",
        f"SELECT min(fqn), 'RESOLVE-005', 'RESOLVE' FROM o WHERE {word('hashbytes', 'md5', 'sha1', 'sha2', 'encrypt', 'decrypt', 'pgcrypto')} HAVING count(*) > 0",
    ]
    if source == "mysql":
        parts.append("SELECT '(schema-wide)', 'WARN-014', 'WARN' FROM o WHERE type = 'table' AND regexp_matches(d, '\\btinyint\\s*\\(\\s*1\\s*\\)') HAVING count(*) > 0")
    return f"WITH {OBJECTS}, f AS ({' UNION ALL '.join(parts)})"


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = one_of(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey", TEXTS, "type string, fqn string, ddl string")
    return rows.select("type", F.concat_ws("_", "fqn", "p_partkey").alias("fqn"), "ddl")


@query(found("mssql") + " SELECT * FROM f")
def assess_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.findings(objects(spark, sf_dir), "mssql")


@query(found("mysql") + " SELECT * FROM f")
def assess_findings_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.findings(objects(spark, sf_dir), "mysql")


@query(found("oracle") + " SELECT * FROM f")
def assess_findings_oracle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.findings(objects(spark, sf_dir), "oracle")


@query(found("mssql") + " SELECT count(*) FILTER (severity = 'BLOCK')::BIGINT AS blocks, count(*) FILTER (severity = 'WARN')::BIGINT AS warnings, count(*) FILTER (severity = 'RESOLVE')::BIGINT AS resolvable, round(greatest(0.0, least(1.0, 1 - 0.15 * count(*) FILTER (severity = 'BLOCK') - 0.05 * count(*) FILTER (severity = 'WARN'))), 2)::DOUBLE AS confidence FROM f")
def assess_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.confidence(scan.findings(objects(spark, sf_dir), "mssql"))


@query("SELECT * FROM (SELECT '(schema)' AS fqn, 'BLOCK-007' AS code, 'BLOCK' AS severity, count(*) AS n FROM part WHERE p_partkey % 30 <> 0 UNION ALL SELECT '(schema)', 'BLOCK-008', 'BLOCK', count(*) FROM part WHERE p_partkey % 30 = 0 AND p_partkey < 700) q WHERE n > CASE code WHEN 'BLOCK-007' THEN 64 ELSE 32 END".replace("SELECT * FROM (SELECT", "SELECT fqn, code, severity FROM (SELECT"))
def assess_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A role for most parts, which are too many, and a database for some, which are not."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").where((k % 30 != 0) | (k < 700))
    return scan.findings(p.select(F.lit("script").alias("type"), F.concat(F.lit("x"), k).alias("fqn"), F.when(k % 30 != 0, F.concat(F.lit("CREATE ROLE r"), k)).otherwise(F.concat(F.lit("CREATE DATABASE d"), k)).alias("ddl")), "mssql")


@query(f"WITH {OBJECTS} SELECT coalesce(sum(len(regexp_extract_all(d, 'tinyint\\s*\\(\\s*1\\s*\\)'))), 0)::BIGINT AS n_columns FROM o WHERE type = 'table'")
def tinyint_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.tinyint_columns(objects(spark, sf_dir))


@query(f"""WITH {OBJECTS}, p AS (SELECT 'postgis' AS extension, min(fqn) FILTER ({CODES['WARN-001']}) AS first FROM o UNION ALL SELECT 'ltree', min(fqn) FILTER ({word('hierarchyid')}) FROM o
 UNION ALL SELECT 'uuid-ossp', min(fqn) FILTER (regexp_matches(d, '\\b(newid|sys_guid|uuid_generate|gen_random_uuid|uuid)\\s*\\(')) FROM o UNION ALL SELECT 'pgcrypto', min(fqn) FILTER ({word('hashbytes', 'md5', 'sha1', 'sha2', 'encrypt', 'decrypt', 'pgcrypto')}) FROM o) SELECT * FROM p WHERE first IS NOT NULL""")
def extension_prerequisites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.prerequisites(objects(spark, sf_dir))


DEPRECATED = """SELECT fqn, 'aspnet_membership' AS grp, CASE WHEN starts_with(sch, 'aspnet_') THEN 'schema' WHEN starts_with(nam, 'aspnet_') OR starts_with(nam, 'vw_aspnet_') THEN 'name' END AS matched_by FROM n
 UNION ALL SELECT fqn, 'sql_server_agent', CASE WHEN regexp_matches(d, '\\b(msdb|xp_cmdshell|sp_add_job|sp_add_jobstep|sysjobs)\\b') THEN 'ddl' END FROM n UNION ALL SELECT fqn, 'linked_servers', CASE WHEN regexp_matches(d, '\\b[a-z_]\\w*\\.[a-z_]\\w*\\.[a-z_]\\w*\\.[a-z_]\\w+\\b') THEN 'ddl' END FROM n
 UNION ALL SELECT fqn, 'clr_objects', CASE WHEN regexp_matches(d, '\\b(external\\s+name|create\\s+assembly|with\\s+permission_set|clr)\\b') THEN 'ddl' END FROM n UNION ALL SELECT fqn, 'udtt', CASE WHEN type = 'udtt' THEN 'type' WHEN regexp_matches(d, 'create\\s+type\\b[^;]+\\bas\\s+table\\b') THEN 'ddl' END FROM n
 UNION ALL SELECT fqn, 'extended_procs', CASE WHEN starts_with(nam, 'xp_') THEN 'name' WHEN regexp_matches(d, '\\bxp_\\w+\\s*\\(') THEN 'ddl' END FROM n UNION ALL SELECT fqn, 'temporal_tables', CASE WHEN regexp_matches(d, 'system_versioning\\s*=\\s*on\\b|\\bfor\\s+system_time\\b') THEN 'ddl' END FROM n"""


@query(f"WITH {OBJECTS}, n AS (SELECT *, split_part(lower(fqn), '.', 1) AS sch, split_part(lower(fqn), '.', -1) AS nam FROM o) SELECT * FROM ({DEPRECATED}) WHERE matched_by IS NOT NULL")
def deprecated_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.deprecated(objects(spark, sf_dir))


LONG = [(f"o{i:03d}", f"o{i + 1:03d}") for i in range(100)]
LADDER = [(f"d{i:02d}", f"d{i:02d}{s}") for i in range(20) for s in "ab"] + [(f"d{i:02d}{s}", f"d{i + 1:02d}") for i in range(20) for s in "ab"]
RING = [("r0", "r1"), ("r1", "r2"), ("r2", "r0"), ("r3", "r0")]
#: One copy for each nation.
SHAPE = "e AS (SELECT n_nationkey || src AS src, n_nationkey || dst AS dst FROM nation, (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in [*LONG, *LADDER, *RING]) + ") t(src, dst))"
WALK = f"RECURSIVE {SHAPE}, up(src, dst) AS (SELECT src, dst FROM e UNION SELECT u.src, e.dst FROM up u JOIN e ON u.dst = e.src)"


def shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = for_each(table(spark, sf_dir, "nation").select("n_nationkey"), [*LONG, *LADDER, *RING], "src string, dst string")
    return rows.select(F.concat("n_nationkey", "src").alias("src"), F.concat("n_nationkey", "dst").alias("dst"))


@query(f"WITH {WALK} SELECT src, count(*)::BIGINT AS n_reached, min(dst) AS first, max(dst) AS last FROM up GROUP BY src")
def graph_closure_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chain of a hundred objects, twenty diamonds in a row, and a ring: no cap on depth, no work for each way."""
    return graph.closure(shape(spark, sf_dir)).groupBy("src").agg(F.count("*").alias("n_reached"), F.min("dst").alias("first"), F.max("dst").alias("last"))


@query(f"WITH {WALK} SELECT src AS fqn FROM up WHERE src = dst")
def graph_cycles_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.cycle_members(shape(spark, sf_dir))
