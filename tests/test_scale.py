"""The distributed rankings against plain windows."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.operators import scale
from tillwright.session import materialise


def sample(spark, n, values, nulls=False, seed=1):
    rnd = random.Random(seed)
    data = [(i, None if nulls and rnd.random() < 0.1 else rnd.randrange(values), rnd.choice("abc")) for i in range(n)]
    return spark.createDataFrame(data, "k long, v long, g string").repartition(7)


ORDER = ["v", "k"]


@pytest.mark.parametrize("n,values", [(0, 1), (1, 1), (3, 2), (200, 5), (1000, 400)])
def test_row_number_and_ntile(spark, rows, n, values):
    df = sample(spark, n, values, nulls=True)
    order = [F.col(c) for c in ORDER]
    got = scale.global_row_number(df, order, "rn", "n")
    want = df.withColumn("rn", F.row_number().over(W.orderBy(*order))).withColumn("n", F.lit(n).cast("long"))
    assert rows(got) == rows(want)
    tiles = scale.global_ntile(df, 5, order, "t")
    assert rows(tiles) == rows(df.withColumn("t", F.ntile(5).over(W.orderBy(*order))))


def test_ntile_within_groups(spark, rows):
    df = sample(spark, 300, 20)
    order = [F.desc("v"), F.asc("k")]
    got = scale.global_ntile(df, 3, order, "t", by=["g"])
    assert rows(got) == rows(df.withColumn("t", F.ntile(3).over(W.partitionBy("g").orderBy(*order))))


@pytest.mark.parametrize("block", [1, 3, 64, 100_000])
def test_running_total_and_dense_rank(spark, rows, block):
    df = sample(spark, 500, 40, nulls=True)
    order = [F.desc("v"), F.asc("k")]
    got = scale.global_running(df, order, total_of="v", total="s", grand_total="all", dense_by="v", dense="d", block=block)
    want = (
        df.withColumn("s", F.sum("v").over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("all", F.sum("v").over(W.partitionBy(F.lit(1))))
        .withColumn("d", F.dense_rank().over(W.orderBy(F.desc("v"))))
    )
    assert rows(got) == rows(want)


def test_running_total_before_any_value_is_null(spark, rows):
    df = spark.createDataFrame([(1, None), (2, None), (3, 5)], "k long, v long")
    got = scale.global_running(df, [F.col("k")], total_of="v", total="s", block=1)
    assert rows(got, "k", "s") == [(1, None), (2, None), (3, 5)]


def test_empty_input(spark):
    df = sample(spark, 0, 1)
    assert scale.global_running(df, [F.col("v"), F.col("k")], total_of="v", dense_by="v").count() == 0
    assert scale.exact_quantiles(df, F.col("v"), {"m": 0.5}).first()["m"] is None


def test_exact_quantiles_with_a_hot_value(spark):
    df = spark.createDataFrame([(7,)] * 500 + [(i,) for i in range(1000)], "v long")
    got = scale.exact_quantiles(df, F.col("v"), {"lo": 0.0, "q1": 0.25, "m": 0.5, "hi": 1.0}).first()
    ordered = sorted([7] * 500 + list(range(1000)))
    assert (got["lo"], got["q1"], got["m"], got["hi"]) == (0, ordered[374], ordered[749], 999)


def test_materialise(spark, rows):
    df = sample(spark, 20, 5)
    stored = materialise(df)
    assert rows(stored) == rows(df) and stored.schema == df.schema
