"""A ledger of runs on a shared file system: numbers that no two drivers take, and results that are seen when their run is complete."""

from __future__ import annotations

import json
import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import run_row


class Ledger:
    """Runs below a folder: claims has a file for each number that was taken, pending what unfinished runs have written, done what complete runs have.

    A number is taken by creating its file, which fails where it is there already, so that two drivers get different ones; gaps stay where a
    run never ended. A run's results go to a folder of its own, which one rename makes visible as a whole.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())
        for part in ("claims", "pending", "done"):
            self.fs.mkdirs(self.at(part))

    def at(self, part: str):
        return self.hadoop.Path(f"{self.path}/{part}" if part else self.path)

    def listed(self, part: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(part))) if self.fs.exists(self.at(part)) else []

    def created(self, part: str, text: str) -> bool:
        """Creates a file that isn't there; False if it is."""
        if self.fs.getScheme() == "file":  # Hadoop's local file system looks first and creates then, which two drivers may do at once
            try:
                handle = os.open(self.fs.makeQualified(self.at(part)).toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                return False
            with os.fdopen(handle, "w", encoding="utf-8") as f:
                f.write(text)
            return True
        try:
            out = self.fs.create(self.at(part), False)
        except Exception as e:  # noqa: BLE001  the file system's own kind of error
            if self.fs.exists(self.at(part)):
                return False
            raise e
        out.write(text.encode())
        out.close()
        return True

    def begin(self, source_db: str, target_db: str, schemas: list[str], notes: str = "") -> int:
        """Takes the next number for a run and notes what it compares."""
        number = max([0, *(int(n) for n in self.listed("claims") if n.isdigit())])
        text = json.dumps({"run_id": uuid.uuid4().hex, "source_db": source_db, "target_db": target_db, "schemas": schemas, "notes": notes})
        while True:
            number += 1
            if self.created(f"claims/{number:010d}", text):
                return number

    def write(self, number: int, name: str, rows: DataFrame) -> None:
        """Writes a table of an unfinished run, in place of what it wrote under that name before."""
        if f"{number:010d}" in self.listed("done"):
            raise ValueError(f"run {number} is complete")
        if not re.fullmatch(r"\w+", name):
            raise ValueError(f"not a name: {name}")
        rows.write.mode("overwrite").parquet(f"{self.path}/pending/{number:010d}/{name}")

    def complete(self, number: int, passed: list[str], skipped: list[str], results: str = "results") -> None:
        """Counts a run's results, writes its row and makes all it wrote visible at once. A run that is complete raises ValueError, as does one of another driver that was faster."""
        folder = f"{number:010d}"
        rows = self.spark.read.parquet(f"{self.path}/pending/{folder}/{results}").withColumn("run_number", F.lit(number).cast("long"))
        claim = self.spark.read.json(f"{self.path}/claims/{folder}", schema="run_id string, source_db string, target_db string, schemas array<string>, notes string")
        counts = run_row(rows, passed, skipped)
        row = claim.withColumn("run_number", F.lit(number).cast("long")).join(counts, "run_number", "left").withColumns({"ended": F.current_timestamp(), "status": F.when(F.coalesce("total", F.lit(0)) == 0, "EMPTY").otherwise("COMPLETE")})
        self.write(number, "run", row)
        if self.fs.exists(self.at(f"done/{folder}")) or not self.fs.rename(self.at(f"pending/{folder}"), self.at(f"done/{folder}")):
            raise ValueError(f"run {number} is complete")

    def read(self, name: str, schema: str) -> DataFrame:
        """A table of all complete runs, with their numbers."""
        paths = [f"{self.path}/done/{n}/{name}" for n in self.listed("done") if self.fs.exists(self.at(f"done/{n}/{name}"))]
        if not paths:
            return self.spark.createDataFrame([], schema).withColumn("run_number", F.lit(None).cast("long"))
        rows = self.spark.read.schema(schema).parquet(*paths)
        return rows.drop("run_number").withColumn("run_number", F.regexp_extract(F.input_file_name(), r"/done/(\d+)/", 1).cast("long"))

    def runs(self) -> DataFrame:
        """Rows of all complete runs."""
        return self.read("run", "run_id string, source_db string, target_db string, schemas array<string>, notes string, total long, passed long, skipped long, failed long, ended timestamp, status string")
