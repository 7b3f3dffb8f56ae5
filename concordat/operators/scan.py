"""Rules over object definitions: compatibility findings and score, deprecated groups, audit of conversions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Extensions that a target offers (a hyphen counts as an underscore), procedural languages that it lacks, parameters that it keeps to itself, functions that reach its files.
EXTENSIONS = (
    "address_standardizer address_standardizer_data_us amcheck age datasketches pgaudit autoinc bloom btree_gin btree_gist pg_buffercache citext pg_cron pgcrypto cube ddlx dict_int dict_xsyn earthdistance pg_freespacemap "
    "fuzzystrmatch h3 h3_postgis pg_hint_plan hll hstore http hypopg pg_incremental insert_username intagg intarray isn pg_ivm lo ltree pglogical moddatetime orafce pageinspect pgrowlocks pg_partman pg_lake postgis postgis_raster "
    "postgis_sfcgal postgis_topology postgres_fdw pg_prewarm pg_proctab refint pg_repack pgrouting semver pg_surgery seg sslinfo pg_stat_statements pgstattuple pg_squeeze tablefunc tsm_system_rows tsm_system_time tcn pg_trgm "
    "unaccent pg_visibility vector pgx_ulid uuid-ossp pg_uuidv7 pg_walinspect xml2"
).split()
LANGUAGES = "plpython plpython3u plpython2u plperlu plperl pltcl pltclu plv8 plcoffee plls plruby plr pljava plphp plscheme".split()
PROTECTED = "max_connections shared_buffers effective_cache_size wal_level archive_mode wal_keep_size max_wal_senders max_replication_slots shared_preload_libraries".split()
FILE_FUNCTIONS = "pg_read_file pg_read_binary_file pg_ls_dir pg_ls_waldir pg_ls_logdir pg_stat_file lo_import lo_export pg_write_file".split()
#: Findings as (code, severity, patterns of which all must match, types or *, sources or *).
RULES: list[tuple[str, str, list[str], str, str]] = [
    ("BLOCK-001", "BLOCK", ["|".join(LANGUAGES)], "*", "*"),
    ("BLOCK-002", "BLOCK", [r"\b(?:create|alter)\s+role\s+\w+[^\n]*superuser|\bset\s+role\s+(?:postgres|\w*superuser)\b"], "*", "*"),
    ("BLOCK-003", "BLOCK", [r"\balter\s+system\b"], "*", "*"),
    ("BLOCK-004", "BLOCK", ["|".join(FILE_FUNCTIONS) + r"|\bcopy\b[^\n]+\bprogram\b"], "*", "*"),
    ("BLOCK-005", "BLOCK", [r"\bpg_catalog\b|\bsystem\s+catalog\b", r"\b(?:insert|update|delete|alter)\b"], "*", "*"),
    ("BLOCK-006", "BLOCK", [r"\bcreate\s+extension\s+(?:if\s+not\s+exists\s+)?[\"']?(?!(?:if\s|(?:" + "|".join(x.replace("-", "_").replace("_", "[-_]") for x in EXTENSIONS) + r")(?![\w-])))\w"], "*", "*"),
    ("WARN-001", "WARN", [r"\b(?:geography|geometry|sdo_geometry|sdo_point_type)\b"], "*", "*"),
    ("WARN-003", "WARN", [r"\bset\s+(?:" + "|".join(PROTECTED) + r")\b"], "*", "*"),
    ("WARN-004", "WARN", [r"\bcreate\s+(?:or\s+replace\s+)?package\b"], "*", "oracle"),
    ("WARN-005", "WARN", [r"\b(?:dbms_scheduler|pg_agent|pg_cron\.schedule)\b"], "*", "*"),
    ("WARN-006", "WARN", [r"\bforeign\s+data\s+wrapper\s+(?!(?:postgres_fdw|file_fdw)\b)\w"], "*", "*"),
    ("WARN-007", "WARN", [r"\b(?:declare\s+\w+\s+cursor|open\s+\w+|fetch\s+\w+|cursor\s+for)\b"], "procedure,function", "*"),
    ("WARN-008", "WARN", [r"\bsp_executesql\b"], "*", "mssql"),
    ("WARN-008", "WARN", [r"\bprepare\s+\w+\s+from\b"], "*", "mysql"),
    ("WARN-008", "WARN", [r"\bexecute\s+immediate\b"], "*", "oracle,mariadb,other"),
    ("WARN-009", "WARN", [r"\bpivot\s*\("], "view", "*"),
    ("WARN-010", "WARN", [r"\bhierarchyid\b"], "*", "*"),
    ("WARN-010", "WARN", [r"\breadonly\b|\btable\s+type\b|\bas\s+table\s*\("], "procedure,function", "*"),
    ("WARN-011", "WARN", [r"\b\w+\.\w+\.\w+\b"], "view", "mysql,mariadb"),
    ("WARN-012", "WARN", [r"\bunion\b", r"\bcurrent_date\b|\bcurrent_timestamp\b|\b(?:getdate|now)\s*\(\s*\)", r"cast\s*\([^)]+as\s+(?:text|n?varchar)\s*\)"], "view", "*"),
    ("WARN-013", "WARN", [r"\bobjectkey\b", r"\b(?:orderid|itemid|clientid|vendorid|userid|personid)\b"], "view", "*"),
]
#: Extensions that must be there first: (code, extension, pattern, where the finding stands; without a name the least object that has it).
PREREQUISITES = [
    ("RESOLVE-001", "postgis", r"\b(?:geography|geometry|sdo_geometry|sdo_point_type)\b", "(pre-deploy)"),
    ("RESOLVE-003", "ltree", r"\bhierarchyid\b", "(pre-deploy)"),
    ("RESOLVE-003", "uuid-ossp", r"\b(?:newid|sys_guid|uuid_generate|gen_random_uuid|uuid)\s*\(", None),
    ("RESOLVE-005", "pgcrypto", r"\b(?:hashbytes|md5|sha1|sha2|encrypt|decrypt|pgcrypto)\b", None),
]
#: What a target holds at most.
MOST_ROLES, MOST_DATABASES = 64, 32
#: A name of a role or database, bare or in marks, of an account also with its host.
NAME = r"(?:(?:\"[^\"]+\"|'[^']+'|`[^`]+`|\[[^\]]+\]|[^\s;,()\"'`\[\]]+)@?)+"
#: Groups of deprecated objects: schemas, names, types and text, looked at in this order.
DEPRECATED: list[tuple[str, str | None, str | None, str | None, str | None]] = [
    ("aspnet_membership", r"^aspnet_", r"^(?:vw_)?aspnet_", None, None),
    ("sql_server_agent", None, None, None, r"\b(?:msdb|xp_cmdshell|sp_add_job|sp_add_jobstep|sysjobs|sql\s+server\s+agent)\b"),
    ("linked_servers", None, None, None, r"\b(?:[a-z_]\w*\.){3}[a-z_]\w+\b"),
    ("clr_objects", None, None, None, r"\b(?:external\s+name|create\s+assembly|with\s+permission_set|clr)\b"),
    ("udtt", None, None, r"^udtt$", r"\bcreate\s+type\b[^;]+\bas\s+table\b"),
    ("extended_procs", None, r"^xp_", None, r"\bxp_\w+\s*\("),
    ("temporal_tables", None, None, None, r"\bsystem_versioning\s*=\s*on\b|\b(?:period\s+)?for\s+system_time\b"),
]


def findings(objects: DataFrame, source: str) -> DataFrame:
    """(fqn, code, severity), one for each object and detector, and for all objects together: prerequisites once each, TINYINT(1)
    columns of MySQL, too many roles or databases, and the emulation that Oracle needs. objects: type, fqn, ddl.

    The few dozen rules are expressions of one projection, so a scan of any size needs neither join nor shuffle; what counts over all objects is one
    aggregate of one row, and only the names of roles and databases are shuffled.
    """
    kind, ddl = F.lower("type"), F.coalesce(F.col("ddl"), F.lit(""))
    of = source if source in ("mssql", "mysql", "mariadb", "oracle") else "other"

    def hit(patterns: list[str], types: str) -> Column:
        ok = reduce(lambda a, b: a & b, (ddl.rlike(f"(?i){p}") for p in patterns))
        return ok if types == "*" else ok & kind.isin(types.split(","))

    told = F.array_compact(F.array(*(F.when(hit(p, t), F.struct(F.lit(c).alias("code"), F.lit(s).alias("severity"))) for c, s, p, t, sources in RULES if sources == "*" or of in sources.split(","))))
    rows = objects.select("fqn", F.explode(told).alias("f")).select("fqn", "f.code", "f.severity")

    has = lambda p: ddl.rlike(f"(?i){p}")
    sums = [F.min(F.when(has(p), F.col("fqn"))).alias(f"p{i}") for i, (_, _, p, _) in enumerate(PREREQUISITES)]
    sums += [F.count_if(has(RULES[8][2][0])).alias("packages")]
    sums += [F.coalesce(F.sum(F.when(kind == "table", F.regexp_count(ddl, F.lit(r"(?i)\btinyint\s*\(\s*1\s*\)")))), F.lit(0)).alias("tinyints")]
    finding = lambda ok, fqn, code, severity: F.when(ok, F.struct(fqn.alias("fqn"), F.lit(code).alias("code"), F.lit(severity).alias("severity")))
    once = [finding(F.col(f"p{i}").isNotNull(), F.lit(where) if where else F.col(f"p{i}"), c, "RESOLVE") for i, (c, _, _, where) in enumerate(PREREQUISITES)]
    if source in ("mysql", "mariadb"):
        once.append(finding(F.col("tinyints") > 0, F.lit("(schema-wide)"), "WARN-014", "WARN"))
    if source == "oracle":  # a package has asked for the same already
        once.append(finding(F.col("packages") == 0, F.lit("(all objects)"), "RESOLVE-002", "RESOLVE"))
    whole = objects.agg(*sums).select(F.explode(F.array_compact(F.array(*once))).alias("f")).select("f.fqn", "f.code", "f.severity")
    return rows.unionByName(whole).unionByName(too_many(objects))


def too_many(objects: DataFrame) -> DataFrame:
    """(fqn, code, severity) if objects make more roles or databases than a target holds: of different names, whatever the case, as one that is made
    again in many scripts is still one; a statement may make several."""

    def made(what: str) -> Column:
        lists = F.regexp_extract_all(F.lower("ddl"), F.lit(rf"\bcreate\s+{what}\s+(?:if\s+not\s+exists\s+)?(?!(?:link|scoped|audit|encryption)\s)({NAME}(?:\s*,\s*{NAME})*)"), 1)
        return F.flatten(F.transform(lists, lambda x: F.transform(F.regexp_extract_all(x, F.lit(NAME), 0), lambda n: F.regexp_replace(n, r"[\"'`\[\]]", ""))))

    limits = [("BLOCK-007", MOST_ROLES, "role"), ("BLOCK-008", MOST_DATABASES, "database")]
    kinds = F.array(*(F.struct(F.lit(c).alias("code"), F.lit(most).alias("most"), made(what).alias("names")) for c, most, what in limits))
    names = objects.where(F.col("ddl").rlike(r"(?i)\bcreate\s+(?:role|database)\b")).select(F.explode(kinds).alias("k")).select("k.code", "k.most", F.explode("k.names").alias("name"))
    return names.distinct().groupBy("code", "most").agg(F.count("*").alias("n")).where("n > most").select(F.lit("(schema)").alias("fqn"), "code", F.lit("BLOCK").alias("severity"))


def tinyint_columns(objects: DataFrame) -> DataFrame:
    """n_columns: how many TINYINT(1) the tables' definitions have."""
    return objects.where(F.lower("type") == "table").agg(F.coalesce(F.sum(F.regexp_count("ddl", F.lit(r"(?i)\btinyint\s*\(\s*1\s*\)"))), F.lit(0)).cast("bigint").alias("n_columns"))


def prerequisites(objects: DataFrame) -> DataFrame:
    """(extension, first): each extension that some object asks for, once, with the least object that does."""
    ddl = F.coalesce(F.col("ddl"), F.lit(""))
    first = objects.agg(*(F.min(F.when(ddl.rlike(f"(?i){p}"), F.col("fqn"))).alias(f"p{i}") for i, (_, _, p, _) in enumerate(PREREQUISITES)))
    pairs = F.array(*(F.struct(F.lit(e).alias("extension"), F.col(f"p{i}").alias("first")) for i, (_, e, _, _) in enumerate(PREREQUISITES)))
    return first.select(F.explode(pairs).alias("p")).select("p.extension", "p.first").where("first IS NOT NULL")


def confidence(found: DataFrame) -> DataFrame:
    """blocks, warnings, resolvable and 1 - .15 blocks - .05 warnings within 0 and 1."""
    s = F.col("severity")
    counts = found.agg(F.count_if(s == "BLOCK").alias("blocks"), F.count_if(s == "WARN").alias("warnings"), F.count_if(s == "RESOLVE").alias("resolvable"))
    return counts.withColumn("confidence", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - 0.15 * F.col("blocks") - 0.05 * F.col("warnings"))), 2))


def eligibility(kind: Column, source: str) -> Column:
    return F.when((F.lower(kind) == "table") & F.lit(source in ("mssql", "mysql", "mariadb")), "catalog").otherwise("rewrite")


def deprecated(objects: DataFrame) -> DataFrame:
    """(fqn, grp, matched_by): for each object and group the first of schema, name, type and text that tells."""
    schema, name = F.lower(F.regexp_extract("fqn", r"^([^.]*)\.", 1)), F.lower(F.regexp_extract("fqn", r"([^.]*)$", 1))
    told: list[Column] = []
    for group, *patterns in DEPRECATED:
        by = None
        for where, c, p in reversed(list(zip(("schema", "name", "type", "ddl"), (schema, name, F.lower("type"), F.col("ddl")), patterns))):
            if p:
                by = F.when(c.rlike(f"(?is){p}"), where) if by is None else F.when(c.rlike(f"(?is){p}"), where).otherwise(by)
        told.append(F.when(by.isNotNull(), F.struct(F.lit(group).alias("grp"), by.alias("matched_by"))))
    return objects.select("fqn", F.explode(F.array_compact(F.array(*told))).alias("d")).select("fqn", "d.grp", "d.matched_by")


def conversion_audit(objects: DataFrame) -> DataFrame:
    """(fqn, issue): the gravest of empty, truncated (parentheses, quotes or blocks that don't balance), incomplete (no statement of
    its kind), marked (unconverted markers) and ok."""
    ddl = F.col("ddl")
    bare = F.regexp_replace(F.regexp_replace(ddl, r"--[^\n]*", ""), r"'(?:[^']|'')*'", "")
    count = lambda p: F.regexp_count(bare, F.lit(p))
    routine = F.lower("type").isin("procedure", "function", "trigger")
    truncated = (count(r"\(") != count(r"\)")) | (count("'") % 2 == 1) | (routine & (count(r"(?i)\bbegin\b") + count(r"(?i)\bcase\b") > count(r"(?i)\bend\b(?!\s+(?:if|loop|while)\b)")))
    made = F.when(F.lower("type") == "view", bare.rlike(r"(?i)\bselect\b")).when(F.lower("type") == "table", bare.rlike(r"(?i)\bcreate\s+table\b")).otherwise(bare.rlike(r"(?i)\bbegin\b|\breturn\b"))
    issue = F.when(F.btrim(F.coalesce(ddl, F.lit(""))) == "", "empty").when(truncated, "truncated").when(~made, "incomplete").when(ddl.rlike(r"(?i)\bEWI-\d{4}\b|\bTODO\b|unconverted"), "marked").otherwise("ok")
    return objects.select("fqn", issue.alias("issue"))


def routine_group(name: Column, rules: list[tuple[str, str]]) -> Column:
    """The group of the first rule (group, pattern) that a name matches, or current."""
    out = F.lit("current")
    for group, pattern in reversed(rules):
        out = F.when(F.lower(name).rlike(pattern), group).otherwise(out)
    return out


def row_producing(kind: Column, ddl: Column) -> Column:
    k = F.lower(kind)
    return (k == "view") | ((k == "function") & ddl.rlike(r"(?is)\breturns\s+(@\w+\s+)?table\b|\breturns\s+setof\b")) | ((k == "procedure") & ddl.rlike(r"(?im)^\s*select\b"))


def objects_frame(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "type string, fqn string, ddl string")


