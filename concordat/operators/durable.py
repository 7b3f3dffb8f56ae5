"""Tables written in the folder that driver and executors share, and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, or the session's checkpoint folder; without either, one of our own if all runs on one machine, else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="concordat-"))
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return held.get().rstrip("/")


def durable(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read back: what follows survives lost executors and computes nothing twice. The files go when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)
