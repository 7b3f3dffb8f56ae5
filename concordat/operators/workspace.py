"""The documents of a run: read with their fall-backs, checked against their contracts, and the gates between phases."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Documents by name: the files that may hold each (the first that is there counts) and its schema.
DOCUMENTS = {
    "deployment_summary": (["deployment_summary.json", "parallel_deploy_summary.json"], "source_db string, elapsed_s double, phases map<string, struct<ok: int, failed: int>>, failures array<struct<label: string, phase: string, error: string>>"),
    "deploy_report": (["deploy_report.json"], "succeeded array<string>, failed array<struct<view: string, file: string, error: string>>, skipped array<string>, auto_fixed array<string>"),
    "repair_report": (["repair_report.json", "repair/repair_report.json"], "fixed_llm array<string>, fixed_rules array<string>, still_failed array<string>"),
    "procedures_deploy_report": (["procedures_deploy_report.json"], "succeeded array<string>, failed array<string>, skipped_legacy array<string>"),
    "catalog_verification": (["catalog_verification.json"], "summary map<string, int>, objects array<struct<source_fqn: string, target_fqn: string, type: string, status: string>>"),
    "validation_report": (["validation_report.json"], "checks array<struct<check: string, passed: boolean, source_count: int, target_count: int, details: string>>"),
}
#: The phases of a run, and the documents without which a phase can't begin.
PHASES = ["extract", "assess", "convert", "deploy", "repair", "validate", "report"]
NEEDS = {"deploy": [], "repair": ["deploy_report"], "validate": ["deployment_summary"], "report": ["deployment_summary", "validation_report"]}


def load_documents(texts: DataFrame) -> DataFrame:
    """(document, file, body) of a workspace's files (file, value): for each document the first of its files that is there and is a JSON object or list."""
    places = [(d, f, i) for d, (files, _) in DOCUMENTS.items() for i, f in enumerate(files)]
    known = F.broadcast(texts.sparkSession.createDataFrame(places, "document string, name string, place int"))
    path = F.regexp_replace(F.col("file"), r"\\", "/")
    rows = texts.join(known, path.endswith(F.col("name"))).where(F.try_parse_json("value").isNotNull() & F.trim("value").rlike(r"^[\[{]"))
    return rows.groupBy("document").agg(F.min_by(F.struct("file", "value"), F.struct("place", "file")).alias("x")).select("document", "x.file", F.col("x.value").alias("body"))


def document(documents: DataFrame, name: str) -> DataFrame:
    """A document's fields, by its schema; no row where it isn't there."""
    return documents.where(F.col("document") == name).select(F.from_json("body", DOCUMENTS[name][1]).alias("d")).select("d.*")


def contract_errors(documents: DataFrame) -> DataFrame:
    """(document, error): what contradicts a contract: a summary without phases, or with counts beside them; failures named twice; checks without
    a name or verdict; a document that isn't of its schema."""
    d = lambda n: documents.where(F.col("document") == n)
    summary = d("deployment_summary").select("document", F.from_json("body", DOCUMENTS["deployment_summary"][1]).alias("x"), "body")
    flat = summary.where("x.phases IS NULL OR cardinality(x.phases) = 0").select("document", F.lit("no phases").alias("error"))
    unnamed = summary.where(F.exists(F.map_values("x.phases"), lambda p: p["ok"].isNull() | p["failed"].isNull())).select("document", F.lit("a phase without counts").alias("error"))
    labels = F.transform(F.coalesce("x.failures", F.array().cast("array<struct<label: string, phase: string, error: string>>")), lambda f: F.concat_ws("|", f["phase"], f["label"]))
    twice = summary.where(F.size(labels) > F.size(F.array_distinct(labels))).select("document", F.lit("a failure named twice").alias("error"))
    report = d("validation_report").select("document", F.from_json("body", DOCUMENTS["validation_report"][1]).alias("x"))
    loose = report.where("x.checks IS NULL OR exists(x.checks, c -> c.check IS NULL OR c.passed IS NULL)").select("document", F.lit("a check without name or verdict").alias("error"))
    return flat.unionByName(unnamed).unionByName(twice).unionByName(loose)


def preflight(documents: DataFrame, phase: str) -> DataFrame:
    """(phase, document, there): what a phase needs, and whether it is there; it may begin where all is."""
    spark = documents.sparkSession
    needed = spark.createDataFrame([(phase, n) for n in NEEDS.get(phase, [])], "phase string, document string")
    return needed.join(documents.select("document", F.lit(True).alias("there")), "document", "left").select("phase", "document", F.coalesce("there", F.lit(False)).alias("there"))


def blocked_by(states: DataFrame, phase: str) -> DataFrame:
    """Earlier phases (phase, status) that aren't done, in order."""
    place = F.array_position(F.array(*map(F.lit, PHASES)), F.col("phase"))
    return states.where((place < PHASES.index(phase) + 1) & (F.col("status") != "done")).orderBy(place)


def feedback_entries(lines: DataFrame) -> DataFrame:
    """Entries of JSON lines (file, line, value) of a folder of feedback; broken lines are left out."""
    schema = "id string, timestamp string, tester string, scenario string, source_type string, phase string, object_type string, object_name string, error string, error_class string, repair_attempted boolean, repair_succeeded boolean"
    return lines.select("file", "line", F.from_json("value", schema).alias("e")).where("e.object_name IS NOT NULL").select("file", "line", "e.*")


def feedback_summary(entries: DataFrame, least: int = 1, most: int = 20) -> DataFrame:
    """(error_class, n, sources, testers, objects, first_error): distinct sorted names, the first most objects, the first error by file and line."""
    counts = entries.groupBy("error_class").agg(F.count("*").alias("n"), F.min_by("error", F.struct("file", "line")).alias("first_error")).where(F.col("n") >= least)

    def listed(column: str, name: str, first: int | None) -> DataFrame:
        """Distinct names of each class; where there may be many, tasks keep the first of their share before one has the class."""
        rows = entries.select("error_class", F.col(column).alias("v")).where("v IS NOT NULL").distinct()
        if first is not None:
            for shares in (64, 1):
                window = Window.partitionBy("error_class", F.pmod(F.xxhash64("v"), F.lit(shares))).orderBy("v")
                rows = rows.withColumn("place", F.row_number().over(window)).where(F.col("place") <= first).drop("place")
        return rows.groupBy("error_class").agg(F.array_join(F.array_sort(F.collect_list("v")), ",").alias(name))

    for column, name, first in (("source_type", "sources", None), ("tester", "testers", None), ("object_name", "objects", most)):
        counts = counts.join(listed(column, name, first).withColumnRenamed("error_class", "__class"), F.col("error_class").eqNullSafe(F.col("__class")), "left").drop("__class").withColumn(name, F.coalesce(name, F.lit("")))
    return counts


def rules(spark: SparkSession, read: Callable[[str], str | None], source: str, name: str, phase: str | None = None, context: str | None = None) -> DataFrame:
    """(place, pattern, replacement, code, phase, context) of a list of rules: the source's own, else the shared one, kept as JSON; those for a phase
    and context, and those for all. read(path) gives a file's text, or nothing."""
    text = read(str(PurePosixPath(source) / f"{name}.json")) or read(str(PurePosixPath("shared") / f"{name}.json")) or "[]"
    held = [(i, r["pattern"], r.get("replacement", ""), r.get("code"), r.get("phase"), r.get("context")) for i, r in enumerate(json.loads(text))]
    kept = [r for r in held if (phase is None or r[4] in (None, phase)) and (context is None or r[5] in (None, context))]
    return spark.createDataFrame(kept, "place int, pattern string, replacement string, code string, phase string, context string")


def applied(text: Column, found: list[tuple[str, str]]) -> Column:
    """A text after rules (pattern, replacement), in order, whatever the case."""
    for pattern, replacement in found:
        text = F.regexp_replace(text, f"(?i){pattern}", replacement)
    return text
