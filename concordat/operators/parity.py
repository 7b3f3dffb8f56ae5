"""Parity of a source and a target: inventories, counts, column sets, row digests, row differences and verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.functions.canonical import canonical_row, set_digest, view_cell


def perturbed(df: DataFrame, key: str, value: str) -> DataFrame:
    """A target side for tests: drops keys divisible by 97, adds 1 to value where 89 divides the key, adds rows -key where 101 does."""
    k = F.col(key)
    changed = df.where(k % 97 != 0).withColumn(value, F.when(k % 89 == 0, F.col(value) + 1).otherwise(F.col(value)))
    return changed.unionByName(df.where((k % 101 == 0) & (k != 0)).withColumn(key, -k))


def inventory(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of either side with presence: matched, source_only or target_only."""
    s = source.select(*keys).distinct().withColumn("__s", F.lit(True))
    t = target.select(*keys).distinct().withColumn("__t", F.lit(True))
    side = F.when(F.col("__t").isNull(), "source_only").when(F.col("__s").isNull(), "target_only").otherwise("matched")
    return s.join(t, keys, "full_outer").select(*keys, side.alias("presence"))


def identifier(c: Column) -> Column:
    """A name for comparison: without brackets and quotes, in lower case."""
    return F.lower(F.regexp_replace(c, r'[\[\]"`]', ""))


def parameter_name(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "^@", ""), "^(par_|p_)", "")


def trigger_name(c: Column) -> Column:
    """Without schema and _trigger or _fn at its end."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"^.*\.", ""), "(_trigger|_fn)$", "")


def count_verdict(source: Column, target: Column, mode: str = "at_least") -> Column:
    """Table parity: at_least passes a target with as many rows or more, equal only as many."""
    ok = target >= source if mode == "at_least" else target == source
    return F.when(target.isNull(), "SOURCE_ONLY").when(source.isNull(), "TARGET_ONLY").when(ok, "PASS").otherwise("FAIL_DATA")


def view_verdict(source: Column, target: Column) -> Column:
    """View parity on rows: both with or both without rows pass."""
    return F.when(target.isNull(), "SOURCE_ONLY").when(source.isNull(), "TARGET_ONLY").when((source > 0) == (target > 0), "PASS").otherwise("FAIL_DATA")


def digest_parity(source: DataFrame, target: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Digests of both sides, by group if asked, and a verdict: row counts first, then content."""
    s, t = (set_digest(x, by).select(*(by or []), *(F.col(c).alias(f"{side}_{c}") for c in ("n_rows", "digest_sum", "digest_xor"))) for x, side in ((source, "source"), (target, "target")))
    both = s.join(t, by, "full_outer") if by else s.crossJoin(t)  # one row each without groups
    verdict = (
        F.when(F.col("target_n_rows").isNull(), "SOURCE_ONLY")
        .when(F.col("source_n_rows").isNull(), "TARGET_ONLY")
        .when(F.col("source_n_rows") != F.col("target_n_rows"), "FAIL_COUNT")
        .when((F.col("source_digest_sum") != F.col("target_digest_sum")) | (F.col("source_digest_xor") != F.col("target_digest_xor")), "FAIL_HASH")
        .otherwise("PASS")
    )
    return both.withColumn("verdict", verdict)


def diff_rows(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], cell=view_cell) -> DataFrame:
    """Rows that differ: keys, place (among rows with equal keys), kind (VALUE_DIFF, ROW_MISSING, ROW_EXTRA) and the columns that differ.

    Rows with equal keys are aligned as multisets: equal rows first, the rest in the order of their canonical text.
    """
    def side(df: DataFrame, sign: int) -> DataFrame:
        kinds = {f.name: f.dataType for f in df.schema}
        return df.select(*keys, F.array(*(cell(F.col(c), kinds[c]) for c in columns)).alias("cells"), F.lit(sign).alias("sign"))

    # equal rows cancel in one signed count over both sides, so that only the remains are ranked
    rest = side(source, 1).unionByName(side(target, -1)).groupBy(*keys, "cells").agg(F.sum("sign").alias("n")).where("n <> 0")
    rest = rest.withColumn("copy", F.explode(F.sequence(F.lit(1), F.abs("n").cast("int"))))
    place = F.row_number().over(Window.partitionBy(*keys, F.col("n") > 0).orderBy("cells", "copy"))
    rest = rest.withColumn("place", place)
    # a key's remains meet by place: one row of each side at most
    both = rest.groupBy(*keys, "place").agg(F.max(F.when(F.col("n") > 0, F.col("cells"))).alias("s"), F.max(F.when(F.col("n") < 0, F.col("cells"))).alias("t"))
    kind = F.when(F.col("t").isNull(), "ROW_MISSING").when(F.col("s").isNull(), "ROW_EXTRA").otherwise("VALUE_DIFF")
    differing = F.filter(F.array(*(F.when(F.col("s")[i] != F.col("t")[i], c) for i, c in enumerate(columns))), lambda x: x.isNotNull())
    return both.select(*keys, "place", kind.alias("kind"), F.array_join(F.when(kind == "VALUE_DIFF", differing).otherwise(F.array().cast("array<string>")), ",").alias("differing"))


def set_diff(source: Column, target: Column) -> tuple[Column, Column, Column]:
    """Of two arrays of names: only in source, only in target, in both; sorted."""
    return F.array_sort(F.array_except(source, target)), F.array_sort(F.array_except(target, source)), F.array_sort(F.array_intersect(source, target))


def columns_verdict(source: Column, target: Column, extra: str = "WARN") -> Column:
    """PASS for equal sets, FAIL where the target lacks a column, extra (WARN or FAIL) where it only has more."""
    only_s, only_t, _ = set_diff(source, target)
    return F.when(F.size(only_s) > 0, "FAIL").when(F.size(only_t) > 0, extra).otherwise("PASS")


def params_verdict(source: Column, target: Column) -> Column:
    return (
        F.when(F.size(source) != F.size(target), "PARAM_COUNT_DIFFERS").when(source == target, "PASS").when(F.array_sort(source) == F.array_sort(target), "PARAM_ORDER_SWAPPED").otherwise("PARAM_NAMES_DIFFER")
    )


#: For each type of a source, the types of a target that hold the same values.
EQUIVALENT = {
    "int": "integer, int4, int, bigint, int8",
    "bigint": "bigint, int8, integer, int4",
    "smallint": "smallint, int2, integer, int4",
    "tinyint": "smallint, integer, int2, int4, bigint",
    "bit": "boolean, integer, int4",
    "float": "double precision, float8, real, float4",
    "real": "real, float4",
    "decimal": "numeric, decimal",
    "numeric": "numeric, decimal",
    "money": "numeric, decimal, money",
    "smallmoney": "numeric, decimal",
    "varchar": "character varying, text, varchar",
    "nvarchar": "character varying, text, varchar",
    "char": "character, character varying, bpchar, text",
    "nchar": "character, character varying, bpchar, text",
    "text": "text",
    "ntext": "text",
    "datetime": "timestamp without time zone, timestamp, timestamp with time zone",
    "datetime2": "timestamp without time zone, timestamp",
    "smalldatetime": "timestamp without time zone, timestamp",
    "date": "date",
    "time": "time without time zone, time",
    "uniqueidentifier": "uuid",
    "binary": "bytea",
    "varbinary": "bytea",
    "image": "bytea",
    "xml": "xml, text",
    "geography": "geography, text",
    "geometry": "geometry, text",
    "sql_variant": "text, anyelement",
    "hierarchyid": "text",
    "sysname": "character varying, text, name",
}


def types_equivalent(source: Column, target: Column) -> Column:
    """Whether a target's type may hold a source's values: equal names, or by EQUIVALENT, with the target's precision left aside; a source type of no
    such name is a table type, which an array holds."""
    s, whole = F.lower(F.btrim(source)), F.lower(F.btrim(target))
    bare = F.btrim(F.regexp_replace(whole, r"\(.*\)", ""))
    known = F.create_map(*(x for k, v in EQUIVALENT.items() for x in (F.lit(k), F.split(F.lit(v), ", "))))
    held = F.try_element_at(known, s)
    by_map = F.coalesce(F.array_contains(held, bare) | F.array_contains(held, whole), F.lit(False))
    return (s == bare) | by_map | (held.isNull() & (bare == "array"))


#: Error texts of a database that a procedure raises on purpose or for want of data.
EXPECTED_CODES = ["50000", "547", "515", "2627", "2601", "8114", "245"]
EXPECTED_STATES = ["23", "22", "P0"]
EXPECTED_PHRASES = ["violates", "does not exist in parent", "must be provided", "cannot be null", "invalid parameter"]


def expected_error(c: Column) -> Column:
    code = F.regexp_extract(c, r"(?i)(?:error|msg)\s*:?\s*(\d+)", 1)
    state = F.substring(F.regexp_extract(c, r"(?i)sqlstate\W*([0-9A-Z]{5})", 1), 1, 2)
    phrase = reduce(lambda a, b: a | b, (F.lower(c).contains(p) for p in EXPECTED_PHRASES))
    return F.coalesce(code.isin(EXPECTED_CODES) | state.isin(EXPECTED_STATES) | phrase, F.lit(False))


def write_verdict(source_ok: Column, target_ok: Column, source_error: Column, target_error: Column) -> Column:
    """Verdict of a routine that writes, run on both sides and rolled back."""
    return (
        F.when(source_ok & target_ok, "PASS_WRITE_PROC")
        .when(~source_ok & ~target_ok & expected_error(source_error) & expected_error(target_error), "WRITE_EXPECTED_FAIL")
        .when(~source_ok & ~target_ok, "WRITE_BOTH_FAILED")
        .when(~target_ok, "WRITE_TARGET_ERROR")
        .otherwise("WRITE_SOURCE_ERROR")
    )


def routine_verdict(c: dict[str, Column]) -> Column:
    """Verdict of a routine's results, first rule that holds. c names columns: s_status, t_status, s_error, t_error, prereq (rule that
    asks for missing data), s_rows, t_rows, s_sets, t_sets, s_columns, t_columns (arrays), s_hash, t_hash."""
    skipped = (c["s_status"] == "SKIPPED") & (c["t_status"] == "SKIPPED")
    harness = (c["s_status"] == "FAIL_HARNESS") | (c["t_status"] == "FAIL_HARNESS")
    s_bad, t_bad = c["s_status"] == "ERROR", c["t_status"] == "ERROR"
    return (
        F.when(skipped, "SKIPPED")
        .when(harness, "FAIL_HARNESS")
        .when(s_bad & t_bad & c["prereq"], "FAIL_MISSING_PREREQ")
        .when(s_bad & t_bad, "BOTH_FAILED")
        .when(s_bad, "SOURCE_ERROR")
        .when(t_bad, "TARGET_ERROR")
        .when((c["t_status"] == "NO_RESULTSET") & (c["s_rows"] == 0), "PASS_DML_PROC")
        .when(c["t_status"] == "NO_RESULTSET", "TARGET_NO_RESULTSET")
        .when((c["s_sets"] == 0) & (c["t_sets"] == 0), "PASS_DML_PROC")
        .when(c["s_sets"] != c["t_sets"], "FAIL")
        .when(F.array_sort(c["s_columns"]) != F.array_sort(c["t_columns"]), "FAIL")
        .when(c["s_rows"] != c["t_rows"], "FAIL")
        .when(c["s_hash"] != c["t_hash"], "FAIL")
        .otherwise("PASS")
    )


def routine_issues(c: dict[str, Column]) -> Column:
    """All differences of two results that ran, as an array."""
    return F.array_compact(
        F.array(
            F.when(c["s_sets"] != c["t_sets"], "RESULT_SET_COUNT"),
            F.when(F.array_sort(c["s_columns"]) != F.array_sort(c["t_columns"]), "COLUMNS"),
            F.when(c["s_rows"] != c["t_rows"], "ROW_COUNT"),
            F.when(c["s_hash"] != c["t_hash"], "CONTENT"),
        )
    )


def reclassified(error: Column, rules: list[tuple[str, list[str], list[str]]]) -> Column:
    """The first rule (name, any of, all of) whose texts the error holds, or null."""
    out = F.lit(None).cast("string")
    for name, some, every in reversed(rules):
        hit = reduce(lambda a, b: a & b, (error.contains(x) for x in every), F.lit(True)) & (reduce(lambda a, b: a | b, (error.contains(x) for x in some)) if some else F.lit(True))
        out = F.when(hit, name).otherwise(out)
    return out


def row_set_difference(source: DataFrame, target: DataFrame, cell=view_cell) -> DataFrame:
    """Canonical rows on one side only, as multisets: side and row."""
    row = lambda df, sign: df.select(canonical_row(df, cell).alias("row"), F.lit(sign).alias("sign"))
    left = row(source, 1).unionByName(row(target, -1)).groupBy("row").agg(F.sum("sign").alias("n")).where("n <> 0")
    return left.select(F.when(F.col("n") > 0, "source").otherwise("target").alias("side"), "row", F.explode(F.sequence(F.lit(1), F.abs("n").cast("int"))).alias("copy")).select("side", "row")
