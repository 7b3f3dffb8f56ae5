"""Catalogs of source systems and of a Spark target behind one set of names: schemas, tables, columns, keys, indexes, sequences and texts.

A source is read with statements on its own catalog; what they return has the same columns for each system, so that everything after is one
set of DataFrame operations. read(statement) gives a DataFrame: JDBC here, prepared rows in tests.
"""

from __future__ import annotations

import configparser
import os
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Read = Callable[[str], DataFrame]
#: How each system is reached.
DRIVERS = {
    "mssql": ("com.microsoft.sqlserver.jdbc.SQLServerDriver", "jdbc:sqlserver://{host}:{port};databaseName={database};encrypt=true;trustServerCertificate=true", 1433),
    "mysql": ("com.mysql.cj.jdbc.Driver", "jdbc:mysql://{host}:{port}/{database}", 3306),
    "mariadb": ("org.mariadb.jdbc.Driver", "jdbc:mariadb://{host}:{port}/{database}", 3306),
    "oracle": ("oracle.jdbc.OracleDriver", "jdbc:oracle:thin:@//{host}:{port}/{database}", 1521),
    "postgres": ("org.postgresql.Driver", "jdbc:postgresql://{host}:{port}/{database}", 5432),
}
#: Schemas that belong to the systems themselves.
SYSTEM_SCHEMAS = {
    "mssql": ["sys", "information_schema", "guest", "db_owner", "db_accessadmin", "db_securityadmin", "db_ddladmin", "db_backupoperator", "db_datareader", "db_datawriter", "db_denydatareader", "db_denydatawriter"],
    "mysql": ["mysql", "information_schema", "performance_schema", "sys"],
    "oracle": ["sys", "system", "outln", "xdb", "ctxsys", "mdsys", "dbsnmp", "wmsys", "ordsys"],
    "postgres": ["pg_catalog", "information_schema", "pg_toast"],
}
SYSTEM_SCHEMAS["mariadb"] = SYSTEM_SCHEMAS["mysql"]
COLUMNS = "schema_name, table_name, place, column_name, type_name, max_length, precision, scale, is_nullable, is_identity, seed, increment, default_expr, is_computed, computed_expr"
STATEMENTS: dict[str, dict[str, str]] = {
    "mssql": {
        "columns": """SELECT s.name AS schema_name, t.name AS table_name, c.column_id AS place, c.name AS column_name, y.name AS type_name, c.max_length, c.precision, c.scale, c.is_nullable, c.is_identity, CAST(i.seed_value AS BIGINT) AS seed, CAST(i.increment_value AS BIGINT) AS increment,
 d.definition AS default_expr, c.is_computed, p.definition AS computed_expr FROM sys.tables t JOIN sys.schemas s ON s.schema_id = t.schema_id JOIN sys.columns c ON c.object_id = t.object_id JOIN sys.types y ON y.user_type_id = c.user_type_id
 LEFT JOIN sys.identity_columns i ON i.object_id = c.object_id AND i.column_id = c.column_id LEFT JOIN sys.default_constraints d ON d.object_id = c.default_object_id LEFT JOIN sys.computed_columns p ON p.object_id = c.object_id AND p.column_id = c.column_id WHERE t.is_ms_shipped = 0""",
        "keys": """SELECT s.name AS schema_name, t.name AS table_name, x.key_ordinal AS ordinal, c.name AS column_name FROM sys.indexes i JOIN sys.index_columns x ON x.object_id = i.object_id AND x.index_id = i.index_id JOIN sys.columns c ON c.object_id = x.object_id AND c.column_id = x.column_id
 JOIN sys.tables t ON t.object_id = i.object_id JOIN sys.schemas s ON s.schema_id = t.schema_id WHERE i.is_primary_key = 1""",
        "foreign_keys": """SELECT f.name, x.constraint_column_id AS ordinal, a.name AS from_schema, b.name AS from_table, c.name AS from_col, d.name AS to_schema, e.name AS to_table, g.name AS to_col, f.delete_referential_action_desc AS on_delete, f.update_referential_action_desc AS on_update
 FROM sys.foreign_keys f JOIN sys.foreign_key_columns x ON x.constraint_object_id = f.object_id JOIN sys.tables b ON b.object_id = f.parent_object_id JOIN sys.schemas a ON a.schema_id = b.schema_id JOIN sys.columns c ON c.object_id = x.parent_object_id AND c.column_id = x.parent_column_id
 JOIN sys.tables e ON e.object_id = f.referenced_object_id JOIN sys.schemas d ON d.schema_id = e.schema_id JOIN sys.columns g ON g.object_id = x.referenced_object_id AND g.column_id = x.referenced_column_id""",
        "indexes": """SELECT s.name AS schema_name, t.name AS table_name, i.name AS index_name, i.type_desc AS kind, i.is_unique, i.is_primary_key, i.filter_definition AS predicate, x.key_ordinal AS ordinal, c.name AS column_name, x.is_descending_key AS is_desc, x.is_included_column AS is_included
 FROM sys.indexes i JOIN sys.tables t ON t.object_id = i.object_id JOIN sys.schemas s ON s.schema_id = t.schema_id JOIN sys.index_columns x ON x.object_id = i.object_id AND x.index_id = i.index_id JOIN sys.columns c ON c.object_id = x.object_id AND c.column_id = x.column_id""",
        "sequences": "SELECT s.name AS schema_name, q.name AS sequence_name, CAST(q.start_value AS BIGINT) AS start_value, CAST(q.increment AS BIGINT) AS increment, CAST(q.minimum_value AS BIGINT) AS min_value, CAST(q.maximum_value AS BIGINT) AS max_value, q.is_cycling FROM sys.sequences q JOIN sys.schemas s ON s.schema_id = q.schema_id",
        "texts": "SELECT s.name AS schema_name, o.name AS object_name, o.type_desc AS kind, 1 AS line, m.definition AS text FROM sys.sql_modules m JOIN sys.objects o ON o.object_id = m.object_id JOIN sys.schemas s ON s.schema_id = o.schema_id WHERE o.is_ms_shipped = 0",
        "parameters": "SELECT s.name AS schema_name, o.name AS routine_name, p.parameter_id AS place, p.name AS parameter_name, y.name AS type_name, p.is_output FROM sys.parameters p JOIN sys.objects o ON o.object_id = p.object_id JOIN sys.schemas s ON s.schema_id = o.schema_id JOIN sys.types y ON y.user_type_id = p.user_type_id WHERE p.parameter_id > 0",
    },
    "mysql": {
        "columns": """SELECT table_schema AS schema_name, table_name, ordinal_position AS place, column_name, CASE WHEN column_type = 'tinyint(1)' THEN 'tinyint_bool' ELSE data_type END AS type_name, character_maximum_length AS max_length, numeric_precision AS `precision`, numeric_scale AS scale, is_nullable = 'YES' AS is_nullable,
 extra LIKE '%auto_increment%' AS is_identity, 1 AS seed, 1 AS increment, column_default AS default_expr, generation_expression <> '' AS is_computed, generation_expression AS computed_expr FROM information_schema.columns JOIN information_schema.tables USING (table_schema, table_name) WHERE table_type = 'BASE TABLE' AND table_schema = DATABASE()""",
        "keys": "SELECT table_schema AS schema_name, table_name, ordinal_position AS ordinal, column_name FROM information_schema.key_column_usage WHERE constraint_name = 'PRIMARY' AND table_schema = DATABASE()",
        "foreign_keys": """SELECT k.constraint_name AS name, k.ordinal_position AS ordinal, k.table_schema AS from_schema, k.table_name AS from_table, k.column_name AS from_col, k.referenced_table_schema AS to_schema, k.referenced_table_name AS to_table, k.referenced_column_name AS to_col, r.delete_rule AS on_delete, r.update_rule AS on_update
 FROM information_schema.key_column_usage k JOIN information_schema.referential_constraints r ON r.constraint_schema = k.constraint_schema AND r.constraint_name = k.constraint_name WHERE k.referenced_table_name IS NOT NULL AND k.table_schema = DATABASE()""",
        "indexes": "SELECT table_schema AS schema_name, table_name, index_name, index_type AS kind, non_unique = 0 AS is_unique, index_name = 'PRIMARY' AS is_primary_key, NULL AS predicate, seq_in_index AS ordinal, column_name, collation = 'D' AS is_desc, false AS is_included FROM information_schema.statistics WHERE table_schema = DATABASE()",
        "texts": """SELECT routine_schema AS schema_name, routine_name AS object_name, routine_type AS kind, 1 AS line, routine_definition AS text FROM information_schema.routines WHERE routine_schema = DATABASE() UNION ALL SELECT table_schema, table_name, 'VIEW', 1, view_definition FROM information_schema.views WHERE table_schema = DATABASE()
 UNION ALL SELECT trigger_schema, trigger_name, 'TRIGGER', 1, action_statement FROM information_schema.triggers WHERE trigger_schema = DATABASE()""",
        "parameters": "SELECT specific_schema AS schema_name, specific_name AS routine_name, ordinal_position AS place, parameter_name, data_type AS type_name, parameter_mode <> 'IN' AS is_output FROM information_schema.parameters WHERE ordinal_position > 0 AND specific_schema = DATABASE()",
    },
    "oracle": {
        "columns": """SELECT owner AS schema_name, table_name, column_id AS place, column_name, data_type AS type_name, data_length AS max_length, data_precision AS precision, data_scale AS scale, CASE nullable WHEN 'Y' THEN 1 ELSE 0 END AS is_nullable, CASE identity_column WHEN 'YES' THEN 1 ELSE 0 END AS is_identity,
 1 AS seed, 1 AS increment, data_default AS default_expr, CASE virtual_column WHEN 'YES' THEN 1 ELSE 0 END AS is_computed, NULL AS computed_expr FROM all_tab_cols JOIN all_tables USING (owner, table_name) WHERE hidden_column = 'NO' AND owner = SYS_CONTEXT('USERENV', 'CURRENT_SCHEMA')""",
        "keys": "SELECT c.owner AS schema_name, c.table_name, x.position AS ordinal, x.column_name FROM all_constraints c JOIN all_cons_columns x ON x.owner = c.owner AND x.constraint_name = c.constraint_name WHERE c.constraint_type = 'P' AND c.owner = SYS_CONTEXT('USERENV', 'CURRENT_SCHEMA')",
        "foreign_keys": """SELECT c.constraint_name AS name, x.position AS ordinal, c.owner AS from_schema, c.table_name AS from_table, x.column_name AS from_col, r.owner AS to_schema, r.table_name AS to_table, y.column_name AS to_col, c.delete_rule AS on_delete, 'NO ACTION' AS on_update FROM all_constraints c
 JOIN all_cons_columns x ON x.owner = c.owner AND x.constraint_name = c.constraint_name JOIN all_constraints r ON r.owner = c.r_owner AND r.constraint_name = c.r_constraint_name JOIN all_cons_columns y ON y.owner = r.owner AND y.constraint_name = r.constraint_name AND y.position = x.position WHERE c.constraint_type = 'R' AND c.owner = SYS_CONTEXT('USERENV', 'CURRENT_SCHEMA')""",
        "indexes": """SELECT i.owner AS schema_name, i.table_name, i.index_name, i.index_type AS kind, CASE i.uniqueness WHEN 'UNIQUE' THEN 1 ELSE 0 END AS is_unique, CASE WHEN c.constraint_type = 'P' THEN 1 ELSE 0 END AS is_primary_key, NULL AS predicate, x.column_position AS ordinal, x.column_name, CASE x.descend WHEN 'DESC' THEN 1 ELSE 0 END AS is_desc, 0 AS is_included
 FROM all_indexes i JOIN all_ind_columns x ON x.index_owner = i.owner AND x.index_name = i.index_name LEFT JOIN all_constraints c ON c.owner = i.owner AND c.index_name = i.index_name AND c.constraint_type = 'P' WHERE i.owner = SYS_CONTEXT('USERENV', 'CURRENT_SCHEMA')""",
        "sequences": "SELECT sequence_owner AS schema_name, sequence_name, last_number AS start_value, increment_by AS increment, min_value, max_value, CASE cycle_flag WHEN 'Y' THEN 1 ELSE 0 END AS is_cycling FROM all_sequences WHERE sequence_owner = SYS_CONTEXT('USERENV', 'CURRENT_SCHEMA') AND sequence_name NOT LIKE 'ISEQ$$%'",
        "texts": "SELECT owner AS schema_name, name AS object_name, type AS kind, line, text FROM all_source WHERE owner = SYS_CONTEXT('USERENV', 'CURRENT_SCHEMA')",
        "view_texts": "SELECT owner AS schema_name, view_name AS object_name, 'VIEW' AS kind, 1 AS line, text FROM all_views WHERE owner = SYS_CONTEXT('USERENV', 'CURRENT_SCHEMA')",
        "parameters": "SELECT owner AS schema_name, object_name AS routine_name, position AS place, argument_name AS parameter_name, data_type AS type_name, CASE WHEN in_out = 'IN' THEN 0 ELSE 1 END AS is_output FROM all_arguments WHERE position > 0 AND owner = SYS_CONTEXT('USERENV', 'CURRENT_SCHEMA')",
    },
    "postgres": {
        "columns": "SELECT table_schema AS schema_name, table_name, ordinal_position AS place, column_name, data_type AS type_name, character_maximum_length AS max_length, numeric_precision AS precision, numeric_scale AS scale, is_nullable = 'YES' AS is_nullable, is_identity = 'YES' AS is_identity, 1 AS seed, 1 AS increment, column_default AS default_expr, is_generated = 'ALWAYS' AS is_computed, generation_expression AS computed_expr FROM information_schema.columns",
        "checks": "SELECT n.nspname AS schema_name, r.relname AS table_name, c.conname AS name, pg_get_constraintdef(c.oid) AS definition FROM pg_constraint c JOIN pg_class r ON r.oid = c.conrelid JOIN pg_namespace n ON n.oid = r.relnamespace WHERE c.contype = 'c'",
        "texts": "SELECT n.nspname AS schema_name, p.proname AS object_name, CASE p.prokind WHEN 'p' THEN 'PROCEDURE' ELSE 'FUNCTION' END AS kind, 1 AS line, pg_get_functiondef(p.oid) AS text FROM pg_proc p JOIN pg_namespace n ON n.oid = p.pronamespace WHERE p.prokind IN ('f', 'p') UNION ALL SELECT schemaname, viewname, 'VIEW', 1, definition FROM pg_views",
    },
}
STATEMENTS["mariadb"] = STATEMENTS["mysql"]


def connection(source: str, host: str, database: str, port: int | None = None, **options: str) -> dict[str, str]:
    """Options of a JDBC source by system; an unknown one is an error."""
    if source not in DRIVERS:
        raise ValueError(f"no such source: {source}; there are {', '.join(sorted(DRIVERS))}")
    driver, url, usual = DRIVERS[source]
    return {"driver": driver, "url": url.format(host=host, port=port or usual, database=database)} | options


def reader(spark: SparkSession, options: dict[str, str], fetch: int = 5000) -> Read:
    return lambda statement: spark.read.format("jdbc").options(**options).option("fetchsize", fetch).option("query", statement).load()


def settings(path: str, section: str | None = None) -> dict[str, str]:
    """Names and values of a file of settings: a section of a service file, or NAME=value lines; the environment's values go first."""
    if section is not None:
        p = configparser.ConfigParser(interpolation=None)
        p.read(path)
        return dict(p[section]) if p.has_section(section) else {}
    found = {}
    with open(path, encoding="utf-8") as f:
        for line in f:
            if m := re.match(r"^\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", line):
                found[m[1]] = os.environ.get(m[1], m[2].strip("\"'"))
    return found


def system_schema(c: Column, source: str) -> Column:
    """Whether a schema is the system's own."""
    own = F.lower(c).isin(SYSTEM_SCHEMAS[source])
    return own | F.lower(c).rlike(r"^pg_(?:toast|temp)") if source == "postgres" else own


class Catalog:
    """What a system holds. Booleans may come as numbers; rows of the system's own schemas are left out."""

    def __init__(self, source: str, read: Read) -> None:
        self.source, self.read = source, read

    def rows(self, what: str, schema: str = "schema_name") -> DataFrame:
        if what not in STATEMENTS[self.source]:
            raise ValueError(f"{self.source} has no {what}")
        df = self.read(STATEMENTS[self.source][what])
        df = df.toDF(*(c.lower() for c in df.columns))
        flags = [c for c in df.columns if c.startswith("is_")]
        return df.withColumns({c: F.col(c).cast("int") != 0 for c in flags}).where(~system_schema(F.col(schema), self.source))

    def schemas(self) -> DataFrame:
        return self.rows("columns").select("schema_name").distinct()

    def columns(self) -> DataFrame:
        return self.rows("columns")

    def column_counts(self) -> DataFrame:
        return self.columns().groupBy("schema_name", "table_name").agg(F.count("*").alias("n_columns"))

    def tables(self) -> DataFrame:
        """schema_name, table_name, columns (in order, with type, identity, default and computation) and primary_key (in order)."""
        fields = ["place", "column_name", "type_name", "max_length", "precision", "scale", "is_nullable", "is_identity", "seed", "increment", "default_expr", "is_computed", "computed_expr"]
        columns = self.columns().groupBy("schema_name", "table_name").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("columns"))
        keys = self.rows("keys").groupBy("schema_name", "table_name").agg(F.array_sort(F.collect_list(F.struct("ordinal", "column_name")))["column_name"].alias("primary_key"))
        return columns.join(keys, ["schema_name", "table_name"], "left").withColumn("primary_key", F.coalesce("primary_key", F.array().cast("array<string>")))

    def foreign_keys(self) -> DataFrame:
        """name, both tables, their columns in order of the key, and what happens on delete and update."""
        cols = F.array_sort(F.collect_list(F.struct("ordinal", "from_col", "to_col")))
        by = ["name", "from_schema", "from_table", "to_schema", "to_table", "on_delete", "on_update"]
        rows = self.rows("foreign_keys", "from_schema").groupBy(*by).agg(cols.alias("c"))
        return rows.select(*by, F.col("c.from_col").alias("from_cols"), F.col("c.to_col").alias("to_cols"))

    def indexes(self) -> DataFrame:
        """Indexes but for heaps and primary keys: columns in order (with DESC), included columns, whether unique, and the predicate."""
        rows = self.rows("indexes").where("NOT is_primary_key AND upper(kind) <> 'HEAP' AND index_name IS NOT NULL")
        text = F.concat("column_name", F.when(F.col("is_desc"), " DESC").otherwise(""))
        part = lambda included: F.transform(F.array_sort(F.filter(F.collect_list(F.struct("ordinal", text.alias("text"), "is_included")), lambda x: x["is_included"] == F.lit(included))), lambda x: x["text"])
        by = ["schema_name", "table_name", "index_name", "is_unique", "predicate"]
        return rows.groupBy(*by).agg(part(False).alias("columns"), part(True).alias("include_cols"))

    def sequences(self) -> DataFrame:
        return self.rows("sequences")

    def objects(self) -> DataFrame:
        """Views, routines and triggers as type, schema, name, fqn and ddl, lines joined in order."""
        kind = F.upper("kind")
        type_ = F.when(kind.contains("VIEW"), "VIEW").when(kind.contains("TRIGGER"), "TRIGGER").when(kind.contains("FUNCTION"), "FUNCTION").when(kind.contains("PACKAGE"), "PACKAGE").otherwise("PROCEDURE")
        texts = self.rows("texts")
        if "view_texts" in STATEMENTS[self.source]:  # a column of a type that no set operation takes, and whole only there
            texts = texts.unionByName(self.rows("view_texts"))
        lines = texts.select(type_.alias("type"), F.col("schema_name").alias("schema"), F.col("object_name").alias("name"), F.col("line").cast("int").alias("line"), "text")
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "")
        return lines.groupBy("type", "schema", "name").agg(text.alias("ddl")).withColumn("fqn", F.concat_ws(".", "schema", "name"))

    def parameters(self) -> DataFrame:
        """Routines with their parameters in order."""
        rows = self.rows("parameters").groupBy("schema_name", "routine_name").agg(F.array_sort(F.collect_list(F.struct("place", "parameter_name", "type_name", "is_output"))).alias("p"))
        return rows.select("schema_name", "routine_name", F.col("p.parameter_name").alias("names"), F.col("p.type_name").alias("types"))

    def checks(self) -> DataFrame:
        return self.rows("checks")


def catalog(spark: SparkSession, source: str, **where: object) -> Catalog:
    """The catalog of a system over JDBC."""
    return Catalog(source, reader(spark, connection(source, **where)))  # type: ignore[arg-type]


def session_catalog(spark: SparkSession, tables: dict[str, DataFrame], schema: str = "app") -> Catalog:
    """Tables of a session under the same names as a system's catalog, from their schemas, without a job. A session has columns only: what else a catalog is
    asked for raises ValueError."""
    rows = [(schema, t, i + 1, f.name, f.dataType.simpleString(), None, None, None, f.nullable, False, None, None, None, False, None) for t, df in tables.items() for i, f in enumerate(df.schema)]
    kinds = "schema_name string, table_name string, place int, column_name string, type_name string, max_length int, precision int, scale int, is_nullable boolean, is_identity boolean, seed long, increment long, default_expr string, is_computed boolean, computed_expr string"

    def read(statement: str) -> DataFrame:
        if statement != STATEMENTS["postgres"]["columns"]:
            raise ValueError("a session holds nothing but columns")
        return spark.createDataFrame(rows, kinds)

    return Catalog("postgres", read)


def sample(table: DataFrame, columns: list[str], most_needed: int = 3, key: str | None = None) -> DataFrame:
    """One row in which the first columns needed aren't null: the least by key, or by a hash of the row, so that it is the same each time."""
    for c in columns[:most_needed]:
        table = table.where(F.col(c).isNotNull())
    return table.orderBy(F.col(key) if key else F.xxhash64(*table.columns)).limit(1)


def first_rows(table: DataFrame, most: int = 5000) -> DataFrame:
    """A bounded load of a table: its first rows, which is the feature."""
    return table.limit(most)
