"""Written stages and counted broadcasts."""

from pathlib import Path

from pyspark.sql import functions as F

from lumenweave import session as S


def test_materialise_cuts_the_lineage(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    written = S.materialise(df)
    assert written.dtypes == df.dtypes and written.count() == 10
    assert "FileScan" in written._jdf.queryExecution().executedPlan().toString()
    assert S.materialise(df.limit(0)).count() == 0


def test_broadcast_only_what_is_small(spark):
    df = spark.range(11)
    assert S.small(df, 11) and not S.small(df, 10)
    texts = spark.createDataFrame([("x" * 100,), (None,)], "t string")
    assert S.small(texts, 5) and not S.small(texts, 5, 99) and S.small(texts.limit(0), 5)
    plan = lambda side: spark.range(100).join(side, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(S.broadcast_if_small(df, 11)) and "broadcast" not in plan(S.broadcast_if_small(df, 10))


def test_shared_folder(spark):
    folder = S.shared_dir(spark)
    assert folder == S.shared_dir(spark)


def test_look_up_of_hot_keys(spark):
    left = spark.createDataFrame([(i, "the" if i % 3 else f"w{i % 50}") for i in range(600)] + [(-1, None), (-2, "unknown")], "i int, w string")
    right = left.where("w != 'unknown'").groupBy("w").agg(F.count("*").alias("n")).withColumn("x", F.length("w")).where("w is not null")
    expected = sorted(map(tuple, left.join(right.drop("n"), "w").collect()))
    for rows, hot in ((1000, 10), (5, 10), (5, 1), (0, 1000)):
        got = S.look_up(left, right, ["w"], "n", "inner", rows, hot)
        assert got.columns == ["w", "i", "x"] and sorted(map(tuple, got.collect())) == expected
        semi, anti = (sorted(r["i"] for r in S.look_up(left, right, ["w"], "n", how, rows, hot).collect()) for how in ("left_semi", "left_anti"))
        assert semi == sorted(x[1] for x in expected) and anti == [-2, -1]
    assert S.look_up(left, right.limit(0), ["w"], "n").count() == 0


def test_stages_are_deleted(spark):
    stage = S.materialise(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count())
    folder = Path(stage._stage.removeprefix("file:"))
    assert folder.exists() and spark.conf.get(S._CLEANUP) == "false"
    S.forget(stage, spark.range(1))
    S.forget(stage)
    assert not folder.exists()
