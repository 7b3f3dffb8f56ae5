"""Numbers of rows in a global order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import durable


def numbered(df: DataFrame, *order: Column, place: str = "place", total: str | None = None) -> DataFrame:
    """df with the number (from 1) of each row in an order that tells all rows apart, and how many rows there are if asked.

    Rows are dealt out by ranges of the order; within a range a window counts, and what the ranges before it hold is added, of which there is one
    row a range.
    """
    ranged = durable(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")  # one choice of ranges for all uses
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    ahead = Window.orderBy("__range")  # ranges are numbered in order
    sums = sizes.select("__range", (F.sum("__n").over(ahead) - F.col("__n")).alias("__before"), F.sum("__n").over(Window.partitionBy(F.lit(1))).alias("__all"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    rows = ranged.withColumn("__k", within).join(F.broadcast(sums), "__range").withColumn(place, F.col("__before") + F.col("__k"))
    return (rows.withColumn(total, F.col("__all")) if total else rows).drop("__range", "__k", "__before", "__all")
