"""Triggers on a stream of changes: what a trigger would write, written once for each batch however often the batch is tried."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from concordat.plans.repairs import trigger_effects
from concordat.sources.ledger import Ledger


class TriggerStream:
    """A trigger's effects on changes (op: INSERT, UPDATE or DELETE; new and old: the row after and before as structures, null where there is none).

    Effects are grouped by the table they write and go to a folder of the batch below path, which a marker of the batch makes visible when all are
    written. A batch that is tried again after a failure writes its folders anew, and one whose marker is there writes nothing. Rows take
    the names of the statement's list of columns, or those of its query. Events that the trigger doesn't name have no effect.
    """

    def __init__(self, spark: SparkSession, path: str, trigger: str, source: str) -> None:
        self.table, self.events, self.effects = trigger_effects(trigger, source)
        self.ledger, self.path = Ledger(spark, path), path.rstrip("/")

    def marker(self, batch: int) -> str:
        return f"claims/batch-{batch:012d}"

    def run_batch(self, changes: DataFrame, batch: int) -> None:
        """Runs the effects for a batch, once."""
        if self.ledger.fs.exists(self.ledger.at(self.marker(batch))):
            return
        spark = changes.sparkSession
        mine = changes.where(F.col("op").isin(self.events))
        mine.where("new IS NOT NULL").select("new.*").createOrReplaceTempView("new_rows")
        mine.where("old IS NOT NULL").select("old.*").createOrReplaceTempView("old_rows")
        for k, (name, select) in enumerate(self.effects):
            spark.sql(select).write.mode("overwrite").parquet(f"{self.path}/written/{name}/{batch:012d}-{k}")
        self.ledger.created(self.marker(batch), "")

    def start(self, changes: DataFrame, checkpoint: str, **trigger: object) -> StreamingQuery:
        """Runs the effects for each batch of a stream."""
        return changes.writeStream.foreachBatch(self.run_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()

    def written(self, name: str, schema: str) -> DataFrame:
        """Rows that a table got from batches that are through."""
        done = {m.removeprefix("batch-") for m in self.ledger.listed("claims") if m.startswith("batch-")}
        paths = [f"{self.path}/written/{name}/{f}" for f in self.ledger.listed(f"written/{name}") if f.partition("-")[0] in done]
        spark = self.ledger.spark
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
