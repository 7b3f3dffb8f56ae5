"""Parity of two append-only streams by windows of event time: counts and digests close when the watermark has passed them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.functions.canonical import canonical_row, row_number_of


def windowed_digest(rows: DataFrame, time: str = "ts", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """window_start, n_rows and digest_sum of a stream or a batch, by windows of width; rows later than late are left out of a stream."""
    r = rows.select(F.col(time).cast("timestamp").alias("at"), row_number_of(canonical_row(rows)).alias("n"))
    r = r.withWatermark("at", late) if rows.isStreaming else r
    g = r.groupBy(F.window("at", width)).agg(F.count("*").alias("n_rows"), F.sum(F.col("n").cast("decimal(38,0)")).cast("string").alias("digest_sum"))
    return g.select(F.col("window.start").alias("window_start"), "n_rows", "digest_sum")


def compare_windows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Windows of two digests side by side with a verdict."""
    s = source.select("window_start", F.col("n_rows").alias("s_n"), F.col("digest_sum").alias("s_d"))
    t = target.select("window_start", F.col("n_rows").alias("t_n"), F.col("digest_sum").alias("t_d"))
    verdict = F.when(F.col("t_n").isNull(), "SOURCE_ONLY").when(F.col("s_n").isNull(), "TARGET_ONLY").when(F.col("s_n") != F.col("t_n"), "FAIL_COUNT").when(F.col("s_d") != F.col("t_d"), "FAIL_HASH").otherwise("PASS")
    return s.join(t, "window_start", "full_outer").select("window_start", verdict.alias("verdict"))
