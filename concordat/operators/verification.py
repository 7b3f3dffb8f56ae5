"""Verification of a target against a source: catalogs object by object, structural checks, full parity of views, gates and roll-ups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .parity import digest_parity, identifier, row_set_difference, set_diff, trigger_name

#: The order in which verdicts are listed; others come last but for skipped ones.
VERDICT_ORDER = "FAIL FAIL_DATA FAIL_HASH FAIL_COUNT FAIL_HARNESS SOURCE_ERROR TARGET_ERROR TARGET_NO_RESULTSET BOTH_FAILED FAIL_MISSING_PREREQ WARN PASS_DML_PROC PASS SKIPPED SOURCE_ONLY TARGET_ONLY".split()


def match_status(found: Column, source_count: Column, target_count: Column, only_source: Column, only_target: Column) -> Column:
    return F.when(~found, "missing").when((F.size(only_source) > 0) | (F.size(only_target) > 0) | (source_count != target_count), "mismatch").otherwise("match")


def catalog_verification(source: DataFrame, target: DataFrame) -> DataFrame:
    """(fqn, type, target_fqn, status, only_source, only_target) for each object of source. Both sides: type, fqn, members (names of columns, or of
    parameters in order). A trigger may be there as the function that it became (name_fn). Status: match, col_mismatch, param_mismatch or missing."""
    s = source.select("type", "fqn", "members", identifier(F.col("fqn")).alias("key"))
    t = target.select(F.col("fqn").alias("target_fqn"), F.col("members").alias("target_members"), identifier(F.col("fqn")).alias("key"))
    straight = s.join(t, "key", "left")
    again = straight.where("target_fqn IS NULL AND type = 'TRIGGER'").select("type", "fqn", "members", F.concat("key", F.lit("_fn")).alias("key")).join(t, "key", "left")
    rows = straight.where("target_fqn IS NOT NULL OR type <> 'TRIGGER'").unionByName(again)
    lower = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), F.lower)
    only_s, only_t, _ = set_diff(lower(F.col("members")), lower(F.col("target_members")))
    plain = F.col("type").isin("TRIGGER", "SEQUENCE")
    none = F.array().cast("array<string>")
    rows = rows.withColumns({"only_source": F.when(plain, none).otherwise(only_s), "only_target": F.when(plain, none).otherwise(only_t)})
    status = match_status(F.col("target_fqn").isNotNull(), F.when(plain, 0).otherwise(F.size("members")), F.when(plain, 0).otherwise(F.size("target_members")), F.col("only_source"), F.col("only_target"))
    status = F.when(status == "mismatch", F.when(F.col("type").isin("TABLE", "VIEW"), "col_mismatch").otherwise("param_mismatch")).otherwise(status)
    found = F.col("target_fqn").isNotNull()
    return rows.select("fqn", "type", "target_fqn", status.alias("status"), F.when(found, F.array_join("only_source", ",")).otherwise("").alias("only_source"), F.when(found, F.array_join("only_target", ",")).otherwise("").alias("only_target"))


def verification_summary(verified: DataFrame) -> DataFrame:
    """Statuses by type."""
    return verified.groupBy("type").agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("match", "col_mismatch", "param_mismatch", "missing")))


def six_checks(source: dict[str, DataFrame], target: dict[str, DataFrame], sample: int = 10) -> DataFrame:
    """(check, source_n, target_n, passed) of table count, column counts and primary keys of a sample of tables, identity columns, foreign keys and
    indexes. Both sides: columns (table_name, column_name, is_identity, in_key), foreign_keys and indexes. The sample is of tables with the least
    hashes of their names, the same each time. Counts pass where the target has as many or more, keys where they are equal."""
    s, t = source["columns"], target["columns"]
    counted = lambda df, name: df.agg(F.count("*").alias(name))
    one = lambda name, a, b, ok: a.crossJoin(b).select(F.lit(name).alias("check"), "source_n", "target_n", ok.alias("passed"))  # noqa: E731  one row each
    enough, equal = F.col("target_n") >= F.col("source_n"), F.col("target_n") == F.col("source_n")
    names = s.select("table_name").distinct()
    picked = names.orderBy(F.xxhash64("table_name"), "table_name").limit(sample)
    per = lambda df: picked.join(df, "table_name", "left").groupBy("table_name").agg(F.count("column_name").alias("n"), F.array_sort(F.collect_list(F.when(F.col("in_key"), F.col("column_name")))).alias("key"))
    both = per(s).join(per(t).select("table_name", F.col("n").alias("m"), F.col("key").alias("other")), "table_name")
    right = lambda ok, name: both.agg(F.count("*").alias("source_n"), F.count_if(ok).alias("target_n")).select(F.lit(name).alias("check"), "source_n", "target_n", equal.alias("passed"))
    parts = [
        one("table_count", counted(names, "source_n"), counted(t.select("table_name").distinct(), "target_n"), enough),
        right(F.col("n") == F.col("m"), "column_counts"),
        right(F.col("key") == F.col("other"), "primary_keys"),
        one("identity_columns", counted(s.where("is_identity"), "source_n"), counted(t.where("is_identity"), "target_n"), enough),
        *(one(k, counted(source[k], "source_n"), counted(target[k], "target_n"), enough) for k in ("foreign_keys", "indexes")),
    ]
    return reduce(DataFrame.unionByName, parts)


def view_parity(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row for a view: row counts, columns on one side only, rows on one side only, and the verdict: columns, then count, then content."""
    shared = [c for c in source.columns if c.lower() in {x.lower() for x in target.columns}]
    only_s = sorted(c for c in source.columns if c not in shared)
    only_t = sorted(c for c in target.columns if c.lower() not in {x.lower() for x in shared})
    s, t = source.select(*shared), target.select(*(F.col(c).alias(c) for c in shared))
    told = digest_parity(s, t)
    sides = row_set_difference(s, t).agg(F.count_if(F.col("side") == "source").alias("rows_only_source"), F.count_if(F.col("side") == "target").alias("rows_only_target"))
    verdict = F.lit("FAIL_COLUMNS") if only_s or only_t else F.col("verdict")
    return told.crossJoin(sides).select("source_n_rows", "target_n_rows", F.lit(",".join(only_s)).alias("columns_only_source"), F.lit(",".join(only_t)).alias("columns_only_target"), "rows_only_source", "rows_only_target", verdict.alias("verdict"))


def trigger_parity(source: DataFrame, target: DataFrame) -> DataFrame:
    """(trigger, verdict) by normalised name. Both sides: name, table_name, events (array) and enabled: the first difference of table, events and state."""
    side = lambda df, p: df.select(trigger_name(F.col("name")).alias("trigger"), F.lower("table_name").alias(f"{p}_table"), F.array_sort(F.transform("events", F.upper)).alias(f"{p}_events"), F.col("enabled").alias(f"{p}_enabled"))
    both = side(source, "s").join(side(target, "t"), "trigger", "full_outer")
    verdict = (
        F.when(F.col("t_table").isNull(), "SOURCE_ONLY")
        .when(F.col("s_table").isNull(), "TARGET_ONLY")
        .when(F.col("s_table") != F.col("t_table"), "FAIL_TABLE")
        .when(F.col("s_events") != F.col("t_events"), "FAIL_EVENTS")
        .when(F.col("s_enabled") != F.col("t_enabled"), "FAIL_ENABLED")
        .otherwise("PASS")
    )
    return both.select("trigger", verdict.alias("verdict"))


def type_parity(source: DataFrame, target: DataFrame) -> DataFrame:
    """(type_name, verdict) of user types: there by name whatever its case, or not."""
    t = target.select(F.lower("type_name").alias("k")).distinct().withColumn("there", F.lit(True))
    rows = source.withColumn("k", F.lower("type_name")).join(t, "k", "left")
    return rows.select("type_name", F.when(F.col("there"), "PASS").otherwise("SOURCE_ONLY").alias("verdict"))


def split_routines(routines: DataFrame, triggers: DataFrame) -> DataFrame:
    """(kind, n, by_rules, by_hand): routines that a trigger's name (or name_fn) tells to be its function, and the others; with how each was repaired."""
    names = triggers.select(trigger_name(F.col("name")).alias("k")).distinct().withColumn("is_trigger", F.lit(True))
    rows = routines.withColumn("k", trigger_name(F.col("name"))).join(names, "k", "left")
    kind = F.when(F.col("is_trigger"), "trigger_function").otherwise("procedure")
    return rows.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.count_if(F.col("fixed_by") == "rules").alias("by_rules"), F.count_if(F.col("fixed_by") != "rules").alias("by_hand"))


def column_sample(counts: DataFrame, most: int = 30) -> DataFrame:
    """Verdicts on the column counts of each schema's first tables by name: (schema_name, table_name, source_n, target_n, verdict). A source without
    columns doesn't count."""
    first = Window.partitionBy("schema_name").orderBy("table_name")
    rows = counts.where("source_n > 0").withColumn("__p", F.row_number().over(first)).where(F.col("__p") <= most).drop("__p")
    return rows.withColumn("verdict", F.when(F.col("target_n").isNull(), "SOURCE_ONLY").when(F.col("source_n") == F.col("target_n"), "PASS").otherwise("FAIL"))


def in_verdict_order(rows: DataFrame, *then: str) -> DataFrame:
    """Rows by the gravity of their verdicts, then by columns."""
    place = F.array_position(F.array(*map(F.lit, VERDICT_ORDER)), F.col("verdict"))
    return rows.orderBy(F.when(place == 0, len(VERDICT_ORDER)).otherwise(place), *then)


def verdict_place(verdict: Column) -> Column:
    place = F.array_position(F.array(*map(F.lit, VERDICT_ORDER)), verdict)
    return F.when(place == 0, len(VERDICT_ORDER)).otherwise(place).cast("int")


def label_match(labels: DataFrame, names: DataFrame) -> DataFrame:
    """(label, fqn): the object a shortened label means: its full name, its bare name, or one of which the other is a beginning; the least
    full name of the best kind, or none. Beginnings meet by equality: each side is cut at the lengths that the other has, and of the names with one
    beginning only the least goes on, so that no pairs of labels and names are made."""
    label = labels.select("label").distinct().withColumn("text", F.lower("label"))
    own = {"full": F.lower("fqn"), "bare": F.lower(F.substring_index("fqn", ".", -1))}
    sizes = lambda df: [r[0] for r in df.select(F.length("text")).where("text IS NOT NULL").distinct().collect()]  # noqa: E731  at most as many as the longest has characters

    def least(text: Column) -> DataFrame:
        return names.select("fqn", text.alias("text")).groupBy("text").agg(F.min("fqn").alias("fqn"))

    def beginnings(df: DataFrame, lengths: list[int]) -> DataFrame:
        """Rows with each beginning of their text, of one of these lengths."""
        cuts = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("text"))
        return df.withColumn("text", F.explode(F.transform(cuts, lambda n: F.substring(F.col("text"), F.lit(1), n))))

    found = []
    for kind, text in ((1, own["full"]), (2, own["bare"])):
        found.append(label.join(least(text), "text").select("label", F.lit(kind).alias("kind"), "fqn"))
    for kind, text in ((3, own["bare"]), (4, own["full"])):
        known = least(text)
        found.append(label.join(beginnings(known, sizes(label)).groupBy("text").agg(F.min("fqn").alias("fqn")), "text").select("label", F.lit(kind).alias("kind"), "fqn"))
        found.append(beginnings(label, sizes(known)).join(known, "text").select("label", F.lit(kind).alias("kind"), "fqn"))
    best = reduce(DataFrame.unionByName, found).groupBy("label").agg(F.min_by("fqn", F.struct("kind", "fqn")).alias("fqn"))
    return label.select("label").join(best, "label", "left")


def overall_status(row: dict[str, Column]) -> Column:
    """One status of a run from its phases. row: blocked, failed_objects, checks and checks_failed, witness_ran and witness_failed, parity_ran, parity_failed
    and parity_missing."""
    passed = [
        ~row["blocked"],
        row["failed_objects"] == 0,
        (row["checks"] > 0) & (row["checks_failed"] == 0),
        row["witness_ran"] & (row["witness_failed"] == 0),
        row["parity_ran"] & (row["parity_failed"] == 0) & (row["parity_missing"] == 0),
    ]
    pending = (row["checks"] == 0) | ~row["witness_ran"] | ~row["parity_ran"]
    return F.when(row["blocked"], "BLOCKED").when(reduce(lambda a, b: a & b, passed), "COMPLETE").when(pending, "IN PROGRESS").otherwise("NEEDS ATTENTION")


#: The phases of an object, in order.
TIERS = ["conversion", "repair", "deployment", "validation", "parity"]


def needs(tier: str, states: dict[str, Column]) -> Column:
    """Whether an object needs a tier: repair after a failed deployment, deployment once converted, validation once deployed."""
    if tier == "repair":
        return states["deployment"].isin("failed") & ~states["repair"].isin("done")
    if tier == "deployment":
        return states["conversion"].isin("done") & ~states["deployment"].isin("done", "skipped")
    if tier == "validation":
        return states["deployment"].isin("done") & ~states["validation"].isin("done", "skipped")
    return ~states[tier].isin("done", "skipped")


def deployable(states: dict[str, Column]) -> Column:
    return states["conversion"].isin("done") & (states["repair"].isin("done", "skipped", "pending") | states["repair"].isNull())


def reclassified_by_family(error: Column, family: Column, rules: list[tuple[str, str | None, list[str], list[str]]]) -> Column:
    """The first rule (name, family or any, some texts, all texts) that holds for an error of a family of routines."""
    out = F.lit(None).cast("string")
    for name, of, some, every in reversed(rules):
        hit = reduce(lambda a, b: a & b, (error.contains(x) for x in every), F.lit(True))
        hit = hit & reduce(lambda a, b: a | b, (error.contains(x) for x in some)) if some else hit
        out = F.when(hit & (family == of) if of else hit, name).otherwise(out)
    return out


def recommendations(repairs: DataFrame, failures: DataFrame, gaps: DataFrame, markers: DataFrame) -> DataFrame:
    """(level, rule, subject, n) of four rules. repairs (fixed, failed): under 60 of 100 repaired. failures (error_class): kinds met twice or more.
    gaps (table_name, source_n, target_n): counts that differ by over 5 of 100. markers (n_markers, n_objects): density, high beyond .3, medium beyond .1."""
    r = repairs.agg(F.sum("fixed").alias("f"), F.sum("failed").alias("x")).where("x > 0 AND f / (f + x) < 0.6").select(F.lit("HIGH").alias("level"), F.lit("repair_rate").alias("rule"), F.lit("").alias("subject"), F.col("x").alias("n"))
    e = failures.groupBy(F.col("error_class").alias("subject")).agg(F.count("*").alias("n")).where("n >= 2").select(F.lit("MEDIUM").alias("level"), F.lit("error_pattern").alias("rule"), "subject", "n")
    g = gaps.where("abs(target_n - source_n) * 100.0 / nullif(source_n, 0) > 5").select(F.lit("MEDIUM").alias("level"), F.lit("row_gap").alias("rule"), F.col("table_name").alias("subject"), F.abs(F.col("target_n") - F.col("source_n")).alias("n"))
    m = markers.agg(F.sum("n_markers").alias("n"), F.sum("n_objects").alias("o")).where("n > 0")
    m = m.select(F.when(F.col("n") / F.col("o") > 0.3, "HIGH").when(F.col("n") / F.col("o") > 0.1, "MEDIUM").otherwise("LOW").alias("level"), F.lit("marker_density").alias("rule"), F.lit("").alias("subject"), "n")
    return reduce(DataFrame.unionByName, [r, e, g, m])


def markdown(df: DataFrame, most: int = 1000) -> str:
    """A small result as a table of Markdown, in its order; a report of more rows says so."""
    rows = df.limit(most + 1).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(cell(v) for v in r) + " |" for r in rows[:most])]
    return "\n".join([*lines, *([f"({most} rows shown)"] if len(rows) > most else [])])
