"""Runs that two drivers begin at once, and triggers on batches that come again."""

import threading

import pytest

from concordat.sources.ledger import Ledger
from concordat.streaming.triggers import TriggerStream


def test_no_number_is_taken_twice(spark, tmp_path):
    taken, lock = [], threading.Lock()

    def take():
        ledger = Ledger(spark, str(tmp_path / "runs"))
        for _ in range(15):
            n = ledger.begin("a", "b", ["s"])
            with lock:
                taken.append(n)

    threads = [threading.Thread(target=take) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(taken) == list(range(1, 61))


def test_results_are_seen_when_their_run_is_complete(spark, tmp_path):
    ledger = Ledger(spark, f"file://{tmp_path}/runs")
    first, second = ledger.begin("a", "b", ["s"], "it's"), ledger.begin("a", "b", ["s"])
    rows = spark.createDataFrame([("x", "PASS"), ("y", "FAIL"), ("z", "SKIPPED")], "name string, verdict string")
    ledger.write(first, "results", rows)
    ledger.write(second, "results", rows.limit(0))
    schema = "name string, verdict string"
    assert ledger.read("results", schema).count() == 0 and ledger.runs().count() == 0
    ledger.write(first, "results", rows)  # again, after a failure
    ledger.complete(first, ["PASS"], ["SKIPPED"])
    assert sorted(map(tuple, ledger.read("results", schema).collect())) == [("x", "PASS", 1), ("y", "FAIL", 1), ("z", "SKIPPED", 1)]
    (run,) = ledger.runs().collect()
    assert (run.run_number, run.notes, run.total, run.passed, run.skipped, run.failed, run.status) == (1, "it's", 3, 1, 1, 1, "COMPLETE")
    with pytest.raises(ValueError, match="complete"):
        ledger.write(first, "results", rows)
    ledger.complete(second, ["PASS"], [])
    assert {r.run_number: r.status for r in ledger.runs().collect()} == {1: "COMPLETE", 2: "EMPTY"} and ledger.begin("a", "b", []) == 3


TRIGGER = "CREATE TRIGGER t ON dbo.items AFTER INSERT, UPDATE AS BEGIN INSERT INTO log (what, k) SELECT ISNULL(d.v, 'none'), i.k FROM inserted i LEFT JOIN deleted d ON d.k = i.k; END"
CHANGES = "op string, new struct<k: int, v: string>, old struct<k: int, v: string>"


def test_a_batch_that_comes_again_writes_nothing_twice(spark, tmp_path):
    stream = TriggerStream(spark, str(tmp_path / "t"), TRIGGER, "mssql")
    first = spark.createDataFrame([("INSERT", (1, "a"), None), ("UPDATE", (2, "c"), (2, "b")), ("DELETE", None, (3, "x"))], CHANGES)
    for _ in range(2):
        stream.run_batch(first, 0)
    stream.run_batch(spark.createDataFrame([("INSERT", (4, "d"), None)], CHANGES), 1)
    spark.createDataFrame([("half", 9)], "what string, k int").write.parquet(str(tmp_path / "t/written/log/000000000002-0"))  # of a batch that never came through
    assert sorted(map(tuple, stream.written("log", "what string, k int").collect())) == [("b", 2), ("none", 1), ("none", 4)]
    assert stream.written("other", "a int").count() == 0


def test_effects_of_a_stream(spark, tmp_path):
    for k in range(2):
        spark.createDataFrame([("INSERT", (k, "a"), None)], CHANGES).write.parquet(str(tmp_path / "in" / str(k)))
    trigger = TriggerStream(spark, str(tmp_path / "t"), TRIGGER, "mssql")
    changes = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    for _ in range(2):  # the second finds nothing new
        query = trigger.start(changes, str(tmp_path / "checkpoint"), availableNow=True)
        query.awaitTermination(60)
    assert sorted(map(tuple, trigger.written("log", "what string, k int").collect())) == [("none", 0), ("none", 1)]
