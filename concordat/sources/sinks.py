"""Where results go: bulk-load files, audit tables, logs, views in order of need, definitions in phases."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions.values import copy_field, masked
from concordat.operators.catalog import index_name, table_definition


def bulk_fields(df: DataFrame) -> DataFrame:
    """One text column of tab-separated fields: null as \\N, booleans t and f, bytes as \\x and hex, text escaped."""

    def field(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            return F.when(c.isNull(), "\\N").when(c, "t").otherwise("f")
        if isinstance(f.dataType, T.BinaryType):
            return F.coalesce(F.concat(F.lit("\\\\x"), F.lower(F.hex(c))), F.lit("\\N"))
        return copy_field(c.cast("string"))

    return df.select(F.concat_ws("\t", *map(field, df.schema)).alias("value"))


def with_retries(run: Callable[[], object], tries: int = 3, wait: float = 0.5, sleep: Callable[[float], object] = time.sleep) -> object:
    """What run gives; after an error it is run again, at most tries times, with a wait that doubles. The last error is raised."""
    for k in range(tries):
        try:
            return run()
        except Exception:  # noqa: BLE001  any error may pass
            if k == tries - 1:
                raise
            sleep(wait * 2**k)
    return None


def write_bulk(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    bulk_fields(df).write.mode(mode).text(path)


def write_by_name(df: DataFrame, target: list[tuple[str, str]], path: str, mode: str = "append") -> list[str]:
    """Writes the columns of df that target (name, type) has, whatever their case, cast to its types; returns their names."""
    have = {c.lower(): c for c in df.columns}
    kept = [(n, t) for n, t in target if n.lower() in have]
    df.select(*(F.col(f"`{have[n.lower()]}`").try_cast(t).alias(n) for n, t in kept)).write.mode(mode).parquet(path)
    return [n for n, _ in kept]


def write_and_read_back(df: DataFrame, path: str, most: int = 200) -> DataFrame:
    """Writes df and gives back the first most rows of what was written."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path).limit(most)


def append_results(results: DataFrame, path: str) -> None:
    """Appends verdicts of a run, laid out by run so that later reads skip the others."""
    results.write.mode("append").partitionBy("run_number").parquet(path)


def run_row(results: DataFrame, passed: list[str], skipped: list[str]) -> DataFrame:
    """The row of a run, counted from its results."""
    v = F.col("verdict")
    return results.groupBy("run_number").agg(F.count("*").alias("total"), F.count_if(v.isin(passed)).alias("passed"), F.count_if(v.isin(skipped)).alias("skipped"), F.count_if(~v.isin(passed) & ~v.isin(skipped)).alias("failed"))


def new_run(runs: DataFrame, source_db: str, target_db: str, schemas: list[str], notes: str = "") -> DataFrame:
    """The row of a run that begins: the number after the largest of runs, when, and what it compares; its counts come with completed_run()."""
    number = F.coalesce(F.max("run_number"), F.lit(0)) + 1
    row = runs.agg(number.cast("bigint").alias("run_number"))
    return row.select("run_number", F.uuid().alias("run_id"), F.current_timestamp().alias("started"), F.lit(source_db).alias("source_db"), F.lit(target_db).alias("target_db"), F.array(*map(F.lit, schemas)).alias("schemas"), F.lit(notes).alias("notes"))


def completed_run(run: DataFrame, results: DataFrame, passed: list[str], skipped: list[str]) -> DataFrame:
    """A run's row with the counts of its results, when it ended and its status."""
    return run.join(run_row(results, passed, skipped), "run_number", "left").withColumns({"ended": F.current_timestamp(), "status": F.when(F.coalesce("total", F.lit(0)) == 0, "EMPTY").otherwise("COMPLETE")})


def export_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def redacted(df: DataFrame) -> DataFrame:
    """df with values masked where a name tells of a secret: of a column, of a field at any depth of structs and lists, or a key of a map."""

    def masked_value(c: Column, kind: T.DataType, name: Column) -> Column:
        if isinstance(kind, T.StructType):
            fields = [masked_value(c[f.name], f.dataType, F.lit(f.name)).alias(f.name) for f in kind]
            return F.when(c.isNotNull(), F.struct(*fields))
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: masked_value(x, kind.elementType, name))
        if isinstance(kind, T.MapType):
            return F.transform_values(c, lambda k, v: masked_value(v, kind.valueType, k.cast("string")))
        return masked(c, name) if isinstance(kind, T.StringType) else c

    return df.select(*(masked_value(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name)).alias(f.name) for f in df.schema))


def definitions(schema: str, tables: list[dict], sequences: list[dict], indexes: list[dict], references: list[dict], source: str) -> list[tuple[str, list[str]]]:
    """Statements by phase for a catalog: schemas, sequences (as tables of their start and increment), tables, indexes and references (which Spark keeps
    as properties of their tables, since it has neither)."""
    name = lambda t: f"`{schema}`.`{t}`"
    made = [("schemas", [f"CREATE SCHEMA IF NOT EXISTS `{schema}`"])]
    made.append(("sequences", [f"CREATE TABLE {name(q['name'])} USING parquet AS SELECT cast({q['start']} AS bigint) AS start, cast({q['increment']} AS bigint) AS increment" for q in sequences]))
    made.append(("tables", [table_definition(schema, t["name"], t["columns"], source) for t in tables]))
    made.append(("indexes", [f"ALTER TABLE {name(i['table'])} SET TBLPROPERTIES ('index.{index_name(i['name'])}' = '{'unique ' if i.get('is_unique') else ''}{','.join(i['columns'])}')" for i in indexes]))
    made.append(("references", [f"ALTER TABLE {name(r['from_table'])} SET TBLPROPERTIES ('reference.{r['name']}' = '{','.join(r['from_cols'])} -> {r['to_table']}({','.join(r['to_cols'])})')" for r in references]))
    return made


def deploy_views(spark: SparkSession, views: list[tuple[str, str]], order: list[str], tables: dict[str, str] | None = None) -> list[tuple[str, str, str]]:
    """Creates views (name, select) in order: (name, status, error). A name that isn't found is tried once more under the full
    name that tables gives it. A view with an error doesn't stop the others."""
    bodies, out = dict(views), []
    for name in [*(n for n in order if n in bodies), *(n for n in bodies if n not in order)]:
        try:
            spark.sql(bodies[name]).createOrReplaceTempView(name)
            out.append((name, "succeeded", ""))
        except AnalysisException as first:
            missing = re.search(r"`(\w+)` cannot be found", str(first))
            full = (tables or {}).get(missing[1].lower()) if missing else None
            if not missing or not full:
                out.append((name, "failed", str(first).splitlines()[0]))
                continue
            try:
                spark.sql(re.sub(rf"(?i)\b{re.escape(missing[1])}\b", full, bodies[name])).createOrReplaceTempView(name)
                out.append((name, "auto_fixed", ""))
            except AnalysisException as second:
                out.append((name, "failed", str(second).splitlines()[0]))
    return out


def deploy_phases(phases: list[tuple[str, list[str]]], run: Callable[[str], object], workers: int = 8, alone: tuple[str, ...] = ("schemas", "sequences")) -> dict[str, dict[str, object]]:
    """Runs statements phase by phase, those of a phase side by side but for the phases in alone: ok, failed and failures of each."""

    def one(statement: str) -> str:
        try:
            run(statement)
            return ""
        except Exception as e:  # noqa: BLE001  whatever a statement raises is its result
            return str(e).splitlines()[0]

    out: dict[str, dict[str, object]] = {}
    for phase, statements in phases:
        with ThreadPoolExecutor(1 if phase in alone else workers) as pool:
            errors = list(pool.map(one, statements))
        out[phase] = {"ok": errors.count(""), "failed": len(errors) - errors.count(""), "failures": [(s[:80], e) for s, e in zip(statements, errors) if e]}
    return out
