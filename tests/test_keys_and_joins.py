import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimwright.operators.joins import balanced_join, hot_keys
from dimwright.operators.surrogate import assign_surrogate_keys, next_start


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "3")


def test_keys_equal_row_number(spark, many_partitions):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    want = df.withColumn("sk", (F.row_number().over(Window.orderBy("v", "k")) + 40).cast("long"))
    got = assign_surrogate_keys(df, "sk", ["v", "k"], start=40)
    assert got.rdd.getNumPartitions() > 1
    assert rows(got, "k", "v", "sk") == rows(want, "k", "v", "sk")


def test_keys_survive_empty_partitions_and_empty_input(spark, many_partitions):
    df = spark.range(3).repartition(7)
    assert rows(assign_surrogate_keys(df, "sk"), "sk") == [(1,), (2,), (3,)]
    empty = assign_surrogate_keys(df.filter("id < 0"), "sk", ["id"], start=5)
    assert empty.count() == 0 and next_start(empty, "sk") == 0


def test_keys_are_stable_when_read_again(spark, many_partitions):
    df = assign_surrogate_keys(spark.range(1000).repartition(5), "sk")
    assert rows(df) == rows(df)
    assert df.select("sk").distinct().count() == 1000 and next_start(df, "sk") == 1000


def sides(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("row"),
    )
    right = spark.range(0, 2000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    return left, right.unionByName(spark.createDataFrame([(1, -1), (1, -2)], "k long, x long"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(shuffled, how):
    left, right = sides(shuffled)
    assert {k for (k,), _, _ in hot_keys(left, ["k"])} == {1, None}
    got = balanced_join(left, right, "k", how, hot=hot_keys(left, ["k"]))
    want = left.join(right, "k", how)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and got.columns == want.columns
    assert rows(got) == rows(want)


def test_salted_join_on_two_columns(shuffled):
    left = shuffled.range(900).select((F.col("id") % 2).alias("a"), F.lit("x").alias("b"), "id")
    right = shuffled.createDataFrame([(0, "x", 1), (1, "x", 2), (1, "y", 3)], "a long, b string, v int")
    got = balanced_join(left, right, ["a", "b"])
    assert rows(got) == rows(left.join(right, ["a", "b"]))


def test_small_side_is_broadcast(spark):
    left, right = sides(spark)
    plan = balanced_join(left, right, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
