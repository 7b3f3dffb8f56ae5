"""Catalogs: columns, keys and indexes as DataFrames, types of sources as Spark types, definitions of tables."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types of the three source systems as Spark types; p and s are precision and scale.
SPARK_TYPES = {
    "bit": "boolean", "boolean": "boolean", "bool": "boolean", "tinyint_bool": "boolean",
    "tinyint": "smallint", "smallint": "smallint", "mediumint": "int", "int": "int", "integer": "int", "bigint": "bigint", "year": "smallint",
    "real": "float", "binary_float": "float", "float": "double", "double": "double", "double precision": "double", "binary_double": "double",
    "decimal": "decimal(p,s)", "numeric": "decimal(p,s)", "money": "decimal(19,4)", "smallmoney": "decimal(10,4)",
    "char": "string", "nchar": "string", "varchar": "string", "nvarchar": "string", "varchar2": "string", "nvarchar2": "string", "text": "string", "ntext": "string", "tinytext": "string", "mediumtext": "string", "longtext": "string",
    "clob": "string", "nclob": "string", "xml": "string", "xmltype": "string", "sysname": "string", "sql_variant": "string", "enum": "string", "set": "string", "rowid": "string", "uniqueidentifier": "string", "hierarchyid": "string",
    "geometry": "string", "geography": "string", "point": "string", "polygon": "string", "linestring": "string", "sdo_geometry": "string",
    "binary": "binary", "varbinary": "binary", "image": "binary", "tinyblob": "binary", "blob": "binary", "mediumblob": "binary", "longblob": "binary", "raw": "binary", "rowversion": "binary", "bfile": "binary",
    "datetime": "timestamp", "datetime2": "timestamp", "datetimeoffset": "timestamp", "smalldatetime": "timestamp_ntz", "date": "date", "time": "time(6)", "timestamp": "timestamp",
    "timestamp with time zone": "timestamp", "timestamp with local time zone": "timestamp", "interval year to month": "interval year to month", "interval day to second": "interval day to second", "json": "string",
}


def spark_type(name: str, source: str, precision: int | None = None, scale: int | None = None, unsigned: bool = False) -> str:
    """The Spark type of a source's type; unknown names are strings."""
    n = re.sub(r"\s*\(.*?\)", "", name.lower()).strip()
    if source == "mssql" and n == "timestamp":
        return "binary"
    if source == "oracle" and n == "date":
        return "timestamp"
    if source in ("mysql", "mariadb") and re.fullmatch(r"tinyint\s*\(\s*1\s*\)", name.strip().lower()):
        return "boolean"
    if source == "oracle" and n == "number":
        if precision is None:  # any number: int could not hold it
            return "decimal(38,10)" if scale is None else f"decimal(38,{max(scale, 0)})"
        if not scale:
            return "int" if precision <= 9 else "bigint" if precision <= 18 else f"decimal({min(precision, 38)},0)"
        return f"decimal({min(precision, 38)},{max(scale, 0)})"
    if source == "mysql" and n == "bit":
        return "binary" if (precision or 1) > 1 else "boolean"
    if unsigned:
        return {"tinyint": "smallint", "smallint": "int", "mediumint": "int", "int": "bigint", "bigint": "decimal(20,0)"}.get(n, SPARK_TYPES.get(n, "string"))
    kind = SPARK_TYPES.get(n, "string")
    return kind.replace("p,s", f"{min(precision, 38)},{scale or 0}" if precision else "38,10")


#: Functions in column defaults and what they are in Spark SQL.
DEFAULTS = [
    (r"(?i)^getdate\(\)$|^sysdatetime\(\)$|^sysutcdatetime\(\)$|^getutcdate\(\)$|^sysdate$|^systimestamp$|^current_timestamp(\(\))?$|^now\(\)$", "current_timestamp()"),
    (r"(?i)^newid\(\)$|^newsequentialid\(\)$|^sys_guid\(\)$|^uuid\(\)$", "uuid()"),
    (r"(?i)^suser_sname\(\)$|^user_name\(\)$|^app_name\(\)$", "current_user()"),
    (r"(?i)^null$", "NULL"),
]


def default_of(expression: str | None, kind: str) -> str | None:
    """A column default in Spark SQL; null where it can't be one (columns, concatenation, numbers for times)."""
    if expression is None:
        return None
    e = expression.strip()
    while e.startswith("(") and e.endswith(")") and balanced(e[1:-1]):
        e = e[1:-1].strip()
    e = re.sub(r"^N'", "'", e)
    for pattern, made in DEFAULTS:
        if re.match(pattern, e):
            return "current_date()" if kind == "date" and made == "current_timestamp()" else made
    if kind == "boolean":
        return {"0": "false", "1": "true", "'0'": "false", "'1'": "true", "b'0'": "false", "b'1'": "true"}.get(e, e if e.lower() in ("true", "false") else None)
    if re.fullmatch(r"-?\d+(\.\d+)?", e):
        return None if kind in ("date", "timestamp", "timestamp_ntz") else e
    if re.fullmatch(r"'(?:[^']|'')*'", e):
        return e
    return f"'{e}'" if re.fullmatch(r"\w+", e) and kind == "string" else None


def balanced(text: str) -> bool:
    depth = 0
    for c in text:
        depth += (c == "(") - (c == ")")
        if depth < 0:
            return False
    return depth == 0


def computed_convertible(expression: str) -> bool:
    """Whether a computed column can be an expression of other columns in Spark: no conversions, user functions or text joined by plus."""
    e = expression.lower()
    return not re.search(r"\btry_convert\b|\bconvert\s*\(|\btry_cast\b|\[\w+\]\.\[\w+\]\s*\(|\+\s*n?'|'\s*\+", e)


def computed_expression(expression: str) -> str:
    """A convertible computed column in Spark SQL."""
    e = re.sub(r"\[([^\]]+)\]", r"`\1`", expression)
    for old, new in (("len", "length"), ("isnull", "coalesce"), ("getdate", "now")):
        e = re.sub(rf"(?i)\b{old}\s*\(", f"{new}(", e)
    return e


def index_name(name: str, most: int = 63) -> str:
    """A name of at most most characters: cut, with six digits of its MD5."""
    return name if len(name) <= most else f"{name[: most - 7]}_{hashlib.md5(name.encode()).hexdigest()[:6]}"


def table_definition(schema: str, name: str, columns: list[dict], source: str) -> str:
    """CREATE TABLE for columns of name, type_name, precision, scale, is_nullable, is_computed, computed_expr and default_expr."""
    lines = []
    for c in columns:
        kind = spark_type(c["type_name"], source, c.get("precision"), c.get("scale"))
        line = f"`{c['name']}` {kind}"
        if c.get("is_computed") and computed_convertible(c.get("computed_expr") or ""):
            line += f" GENERATED ALWAYS AS ({computed_expression(c['computed_expr'])})"
        else:
            if c.get("is_nullable") is False:
                line += " NOT NULL"
            made = default_of(c.get("default_expr"), kind)
            line += f" DEFAULT {made}" if made and made != "NULL" else ""
        lines.append(line)
    return f"CREATE TABLE `{schema}`.`{name}` (\n  " + ",\n  ".join(lines) + "\n) USING parquet"


def columns_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, place, column_name, type_name) of DataFrames, from their schemas, without a job."""
    rows = [(t, i, f.name, f.dataType.simpleString()) for t, df in tables.items() for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "table_name string, place int, column_name string, type_name string")


def foreign_keys(rows: DataFrame) -> DataFrame:
    """(name, ordinal, from_table, from_col, to_table, to_col) with the columns of a key gathered in order."""
    cols = F.array_sort(F.collect_list(F.struct("ordinal", "from_col", "to_col")))
    return rows.groupBy("name", "from_table", "to_table").agg(cols.alias("c")).select("name", "from_table", "to_table", F.array_join("c.from_col", ",").alias("from_cols"), F.array_join("c.to_col", ",").alias("to_cols"))


def index_columns(rows: DataFrame) -> DataFrame:
    """(index_name, table_name, ordinal, column_name, is_desc, is_included) as key and included columns in order."""
    key = F.filter(F.array_sort(F.collect_list(F.struct("ordinal", "column_name", "is_desc", "is_included"))), lambda x: ~x["is_included"])
    more = F.filter(F.array_sort(F.collect_list(F.struct("ordinal", "column_name", "is_desc", "is_included"))), lambda x: x["is_included"])
    text = lambda a: F.array_join(F.transform(a, lambda x: F.concat(x["column_name"], F.when(x["is_desc"], " DESC").otherwise(""))), ",")
    return rows.groupBy("index_name", "table_name").agg(text(key).alias("columns"), text(more).alias("include_cols"))


def boolean_columns(columns: DataFrame) -> DataFrame:
    return columns.where(F.lower("type_name").isin("bit", "boolean", "tinyint(1)", "tinyint_bool")).groupBy("table_name").agg(F.array_join(F.array_sort(F.collect_list("column_name")), ",").alias("columns"))


def source_lines(rows: DataFrame) -> DataFrame:
    """(name, line, text) of definitions kept line by line, joined in order."""
    return rows.groupBy("name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "").alias("ddl"))


def struct_of(columns: list[dict], source: str) -> T.StructType:
    return T._parse_datatype_string(", ".join(f"`{c['name']}` {spark_type(c['type_name'], source, c.get('precision'), c.get('scale'))}" for c in columns))  # type: ignore[return-value]


def selected_by_name(df: DataFrame, target: list[str]) -> list[Column]:
    """Columns of df that target has, whatever the case, under target's names."""
    have = {c.lower(): c for c in df.columns}
    return [F.col(f"`{have[t.lower()]}`").alias(t) for t in target if t.lower() in have]


def copied_columns(source: list[dict], target: list[str]) -> list[str]:
    """Columns that a copy takes: of source those that aren't computed or generated and that target has, whatever the case, under target's names."""
    have = {t.lower(): t for t in target}
    return [have[c["name"].lower()] for c in source if not c.get("is_computed") and not c.get("is_generated") and c["name"].lower() in have]
