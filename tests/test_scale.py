"""A key holding a third of the rows, without broadcasts: same results, hot partitions split."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from retailflow.operators import groups, keys, lookup as lk, scan

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot(spark, n=300_000):
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000))).alias("k"), "id", (F.col("id") % 97).alias("v"))


def final_plan(df):
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_hot_lookup_is_split(no_broadcast):
    dim = no_broadcast.range(6000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    out = lk.lookup(hot(no_broadcast), dim, "k", ["w"], unique=True)
    plan = final_plan(out)
    assert "skew=true" in plan and "Broadcast" not in plan
    assert out.filter("w != k * 2 OR w IS NULL").count() == 0 and out.count() == 300_000


def test_hot_group_total(no_broadcast):
    out = groups.with_group_total(hot(no_broadcast), "k", {"s": F.sum("v")})
    assert "skew=true" in final_plan(out)
    want = sum(i % 97 for i in range(0, 300_000, 3))
    assert out.filter("k = 7").agg(F.min("s")).first()[0] >= want and out.count() == 300_000


def test_one_day_scan_is_many_tasks(no_broadcast):
    df = hot(no_broadcast).withColumn("day", F.lit("d"))
    out = scan.run_id(df, "v", "id", ["day"], block_rows=10_000)
    assert out.agg(F.max("run_id")).first()[0] == 300_000
    assert out.filter("run_id != id + 1").count() == 0


def text_rows(df):
    return df.filter("k = 7").count()


def test_hot_first_row_and_text(no_broadcast):
    df = hot(no_broadcast)
    assert keys.first_per_key(df, "k", "id").filter("k = 7").first()["id"] == 0
    text = groups.collapse(df.withColumn("t", F.col("id").cast("string")), ["k"], "id", "|", {"t": "t"}, {"v": "v"}, block_rows=10_000)
    got = text.filter("k = 7").first()
    assert got["t"].startswith("0|3|") and got["t"].count("|") == text_rows(df) - 1 and rows(text.agg(F.sum("v"))) == [(sum(i % 97 for i in range(300_000)),)]


def test_a_task_is_given_a_bounded_share(spark):
    from retailflow.session import apply_settings
    keys_ = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    old = {k: spark.conf.get(k) for k in keys_}
    try:
        for given, held in ((["64MB", "134217728b"], ["16m", "32m"]), (["1g", "33m"], ["16m", "32m"]), (["8m", "16384k"], ["8m", "16384k"]), (["16777216", "32MB"], ["16777216", "32MB"])):
            for k, v in zip(keys_, given):
                spark.conf.set(k, v)
            apply_settings(spark)
            assert [spark.conf.get(k) for k in keys_] == held
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
