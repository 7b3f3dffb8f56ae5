from concordat.sources import sinks


def test_views_are_created_in_order_and_repaired(spark):
    spark.range(3).createOrReplaceTempView("base_of_views")
    views = [("v_b", "SELECT id + 1 AS id FROM v_a"), ("v_a", "SELECT id FROM base_of_views"), ("v_c", "SELECT id FROM lost_name"), ("v_d", "SELECT nothing FROM v_a")]
    got = dict((n, s) for n, s, _ in sinks.deploy_views(spark, views, ["v_a", "v_b"], {"lost_name": "base_of_views"}))
    assert got == {"v_a": "succeeded", "v_b": "succeeded", "v_c": "auto_fixed", "v_d": "failed"}
    assert spark.table("v_b").count() == 3


def test_phases_count_their_failures():
    def run(s):
        if "bad" in s:
            raise ValueError(s)

    got = sinks.deploy_phases([("schemas", ["a"]), ("tables", ["b", "bad c", "d"])], run)
    assert got["tables"]["ok"] == 2 and got["tables"]["failed"] == 1 and got["schemas"]["failed"] == 0


def test_writes_by_name_and_reads_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "7", "x"), (2, "y", "z")], "ID int, Amount string, extra string")
    assert sinks.write_by_name(df, [("id", "bigint"), ("amount", "int"), ("absent", "int")], str(tmp_path / "t")) == ["id", "amount"]
    assert sorted((r.id, r.amount) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [(1, 7), (2, None)]
    assert sinks.write_and_read_back(df, str(tmp_path / "u"), 1).count() == 1
    sinks.write_bulk(df, str(tmp_path / "b"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "b")).collect()) == ["1\t7\tx", "2\ty\tz"]
