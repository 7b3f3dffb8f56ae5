"""Where queries register themselves, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        if f.__name__ in QUERIES:
            raise ValueError(f"there is a query {f.__name__} already")
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def for_each(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """Each row of df with each of a few rows of these columns: df's columns and theirs."""
    held = df.sparkSession.createDataFrame(rows, schema)
    names = held.columns
    literals = F.expr("array(" + ", ".join("struct(" + ", ".join(f"CAST({spelled(v)} AS {f.dataType.simpleString()}) AS `{f.name}`" for v, f in zip(r, held.schema)) + ")" for r in rows) + ")")
    return df.select("*", F.explode(literals).alias("__row")).select(*df.columns, *(F.col("__row")[n].alias(n) for n in names))


def one_of(df: DataFrame, key: str, rows: list[tuple], schema: str) -> DataFrame:
    """Each row of df with the one of these rows at the place that its key, modulo how many there are, tells."""
    placed = [(i, *r) for i, r in enumerate(rows)]
    return df.withColumn("__place", (F.col(key) % len(rows)).cast("int")).join(F.broadcast(df.sparkSession.createDataFrame(placed, f"__place int, {schema}")), "__place").drop("__place")  # a few rows


def spelled(value: object) -> str:
    """A value in SQL."""
    if value is None or isinstance(value, bool):
        return {None: "NULL", True: "true", False: "false"}[value]
    if isinstance(value, (list, tuple)):
        return "array(" + ", ".join(map(spelled, value)) + ")"
    return str(value) if not isinstance(value, str) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_rows(rows: list[tuple]) -> str:
    """Rows in DuckDB's SQL, each with its place in front."""
    cell = lambda v: {None: "NULL", True: "true", False: "false"}[v] if v is None or isinstance(v, bool) else str(v) if not isinstance(v, str) else "'" + v.replace("'", "''") + "'"
    return ", ".join(f"({i}, {', '.join(map(cell, r))})" for i, r in enumerate(rows))


def sql_for_parts(name: str, columns: str, rows: list[tuple], own: str | None = None) -> str:
    """A common table for DuckDB: for each part the row at the place that its key tells, with the key behind the column own."""
    made = ", ".join(f"{c} || '_' || p_partkey AS {c}" if c == own else c for c in columns.split(", "))
    return f"{name} AS (SELECT {made} FROM part JOIN (VALUES {sql_rows(rows)}) t(place, {columns}) ON p_partkey % {len(rows)} = place)"


def rows_for_parts(spark: SparkSession, sf_dir: str, rows: list[tuple], schema: str, own: str | None = None) -> DataFrame:
    """sql_for_parts() of Spark."""
    df = one_of(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey", rows, schema)
    return (df.withColumn(own, F.concat_ws("_", own, "p_partkey")) if own else df).drop("p_partkey")
