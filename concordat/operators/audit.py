"""Stored verdicts: the latest of each object, roll-ups, rates, run status, failure ranking and recommendations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Verdicts that count as passed and as skipped; others have failed.
PASSED = ["PASS", "PASS_DML_PROC", "PASS_WRITE_PROC", "WRITE_EXPECTED_FAIL"]
SKIPPED = ["SKIPPED", "SOURCE_ONLY", "TARGET_ONLY", "FAIL_MISSING_PREREQ"]


def latest(results: DataFrame, keys: list[str], run: str = "run_number", verdict: str = "verdict") -> DataFrame:
    """One row for each object: not skipped before skipped, then the newest run."""
    order = Window.partitionBy(*keys).orderBy((F.col(verdict) == "SKIPPED").cast("int"), F.col(run).desc())
    return results.withColumn("__place", F.row_number().over(order)).where("__place = 1").drop("__place")


def tallies(verdict: Column) -> list[Column]:
    bad = ~verdict.isin(PASSED) & ~verdict.isin(SKIPPED)
    return [F.count_if(verdict.isin(PASSED)).alias("n_pass"), F.count_if(bad).alias("n_fail"), F.count_if(verdict.isin(SKIPPED)).alias("n_skip")]


def pass_percent(passed: Column, failed: Column) -> Column:
    """Share of passed in both, to one place; N/A without any."""
    return F.when(passed + failed == 0, "N/A").otherwise(F.format_string("%.1f%%", 100.0 * passed / (passed + failed)))


def share_percent(passed: Column, failed: Column, skipped: Column) -> Column:
    """Share of passed in all, skipped ones too, as a whole number; a dash without any."""
    total = passed + failed + skipped
    return F.when(total == 0, "-").otherwise(F.concat(F.round(100.0 * passed / total).cast("int"), F.lit("%")))


def frequent_markers(objects: DataFrame, least: int = 5) -> DataFrame:
    """(code, n, objects): markers (array codes) met in least objects or more, by how often."""
    return objects.select("fqn", F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("n"), F.count_distinct("fqn").alias("objects")).where(F.col("n") >= least)


#: Parts of names that tell a routine that writes.
WRITE_WORDS = (
    "update delete insert archive cancel upsert precartdelete moveprecart posusercartarchive cartdeleteall closecartprocessing deleteschedulecart deleteuserhierarchyaccessbyuser deleteuserroles "
    "deletlocationcatalogaccessbylocation cancelpriceschedule locationcatalogdelete menuitemlocationshare processlogexport audit_update"
).split()


def writes(name: Column, words: tuple[str, ...] | list[str] = WRITE_WORDS) -> Column:
    """Whether a routine's name tells that it writes, so that it isn't run: by general words, and those that a database has besides."""
    return reduce(lambda a, b: a | b, (F.lower(name).contains(w.lower()) for w in words), F.lit(False))


def rollup(results: DataFrame, schema: str = "schema_name", kind: str = "object_type") -> DataFrame:
    """Tallies by schema and type, and a grand total (TOTAL, TOTAL)."""
    rows = results.groupingSets([[F.col(schema), F.col(kind)], []], F.col(schema), F.col(kind)).agg(F.grouping(schema).alias("__all"), F.count("*").alias("n"), *tallies(F.col("verdict")))
    name = lambda c: F.when(F.col("__all") == 1, "TOTAL").otherwise(F.col(c)).alias(c)
    return rows.select(name(schema), name(kind), "n", "n_pass", "n_fail", "n_skip", pass_percent(F.col("n_pass"), F.col("n_fail")).alias("pass_pct"))


def latest_run(runs: DataFrame, word: str) -> DataFrame:
    """The newest run whose notes hold word, else the newest of all; one row."""
    named = F.max(F.when(F.lower("notes").contains(word.lower()), F.col("run_number")))
    return runs.agg(F.coalesce(named, F.max("run_number")).alias("run_number"))


def run_status(total: Column, done: Column, failed: Column) -> Column:
    return F.when(done == 0, "NOT STARTED").when(done < total, "IN PROGRESS").when(failed > 0, "NEEDS ATTENTION").otherwise("COMPLETE")


def overall_status(blocked: Column, failing: Column, checks_failed: Column, parity_ran: Column, parity_failed: Column) -> Column:
    return F.when(blocked, "BLOCKED").when((failing > 0) | (checks_failed > 0) | (parity_failed > 0), "NEEDS ATTENTION").when(~parity_ran, "IN PROGRESS").otherwise("COMPLETE")


#: Kinds of errors by the texts that name them, tried in this order. Reports and routes are kept under these names.
ERROR_LADDER = [
    ("column_does_not_exist", r"column .+ does not exist"),
    ("relation_does_not_exist", r"relation .+ does not exist"),
    ("function_does_not_exist", r"function .+ does not exist"),
    ("rowcount_conversion_bug", r'type "(?:count|rowcount|_row_count)" does not exist'),
    ("type_does_not_exist", r"type .+ does not exist"),
    ("code_fence_leak", r"syntax error at or near.+`"),
    ("syntax_error", r"syntax error at or near"),
    ("non_setof_return_query", r"cannot use return query in a non.setof"),
    ("unterminated_quoted_identifier", r"unterminated .* quoted"),
    ("division_by_zero", r"division by zero"),
    ("cursor_loop", r"cursor"),
    ("undeclared_variable", r"undeclared variable"),
    ("operator_type_mismatch", r"operator does not exist"),
    ("permission_denied", r"permission denied"),
    ("already_exists", r"already exists"),
    ("cast_error", r"cannot cast"),
    ("ambiguous_column", r"ambiguous column"),
]


def classify_error(error: Column) -> Column:
    """Label of an error by the first rule of ERROR_LADDER that matches; else other: and its first 60 characters; unknown without text."""
    out = F.concat(F.lit("other:"), F.substring(error, 1, 60))
    for name, pattern in reversed(ERROR_LADDER):
        out = F.when(error.rlike(f"(?i){pattern}"), name).otherwise(out)
    return F.when(error.isNull() | (F.btrim(error) == ""), "unknown").otherwise(out)


#: What repairs which kind of error; others go to a prompt.
ROUTES = {
    "column_does_not_exist": "rule",
    "relation_does_not_exist": "rule",
    "function_does_not_exist": "function-sub",
    "type_does_not_exist": "type-mapping",
    "rowcount_conversion_bug": "script",
    "code_fence_leak": "script",
    "non_setof_return_query": "prompt",
    "syntax_error": "rule",
    "cursor_loop": "prompt",
    "undeclared_variable": "rule",
    "operator_type_mismatch": "rule",
    "cast_error": "type-mapping",
    "row_count_mismatch": "script",
    "missing_in_target": "script",
}


def route(kind: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in ROUTES.items() for x in kv)), kind), F.lit("prompt"))


def deduplicated(entries: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first entry of each key by order."""
    return entries.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("__place = 1").drop("__place")


def failure_ranking(entries: DataFrame, least: int = 1, sample: int = 20) -> DataFrame:
    """Kinds of errors by count: rank, objects (distinct, sorted, the first sample), first error by entry and route."""
    kinds = entries.withColumn("error_class", classify_error(F.col("error")))
    # a kind's objects are told apart and cut before they are gathered
    names = kinds.select("error_class", "object_name").distinct().withColumn("__p", F.row_number().over(Window.partitionBy("error_class").orderBy("object_name"))).where(F.col("__p") <= sample)
    names = names.groupBy("error_class").agg(F.array_join(F.array_sort(F.collect_list("object_name")), ",").alias("objects"))
    rows = kinds.groupBy("error_class").agg(F.count("*").alias("n"), F.min_by("error", "entry").alias("first_error"), F.min("entry").alias("first_entry")).join(names, "error_class", "left")
    rows = rows.where(F.col("n") >= least)
    return rows.select(F.row_number().over(Window.orderBy(F.col("n").desc(), "first_entry")).cast("int").alias("rank"), "error_class", "n", "objects", "first_error", route(F.col("error_class")).alias("fix_route"))


def marker_density(markers: Column, objects: Column) -> Column:
    """Level of unresolved markers by object: high from .3, medium from .1."""
    share = F.try_divide(markers.cast("double"), objects)
    return F.when(share >= 0.3, "high").when(share >= 0.1, "medium").otherwise("low")


def objects_needing(state: Column, mode: str) -> Column:
    """Whether a run of mode resume, force_rerun or force_failed takes up an object in a state."""
    if mode == "force_rerun":
        return F.lit(True)
    if mode == "force_failed":
        return state == "failed"
    return ~state.isin("done", "skipped")


def merged_summaries(summaries: DataFrame, keys: list[str]) -> DataFrame:
    """Counters of several databases added up; a database that was summed up again counts once, by its newest summary."""
    newest = Window.partitionBy("source_db", *keys).orderBy(F.col("seen").desc())
    return summaries.withColumn("__place", F.row_number().over(newest)).where("__place = 1").groupBy(*keys).agg(F.sum("ok").alias("ok"), F.sum("failed").alias("failed"))
