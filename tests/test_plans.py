"""Physical plans: what must (not) be in them at any scale."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillwright.operators import metrics, staging
from tillwright.operators.combine import join_lines, one_row
from tillwright.plans import registry
from tillwright.plans.layers import Layers, StoredLayers
from tillwright.session import shared_folder

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def large_tables(spark):
    """Settings under which small tables are treated as large ones."""
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for key, value in NO_BROADCAST.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_hot_key_is_split_although_the_table_is_aggregated_on_it(spark, large_tables, how):
    lines = spark.range(0, 120_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )
    table = spark.range(1000).groupBy(F.col("id").alias("key")).agg(F.max("id").alias("label"))
    joined = join_lines(lines, table, "key", how)
    result = joined.agg(F.count("*").alias("n"), F.max("payload"))
    assert "SortMergeJoin(skew=true)" in final_plan(result)
    assert result.first()["n"] == 120_000


def test_one_row_has_no_join(spark):
    df = one_row(spark.range(3).agg(F.max("id").alias("a")), spark.range(5).agg(F.max("id").alias("b"), F.lit(None).cast("int").alias("c")))
    assert tuple(df.first()) == (2, 4, None)
    assert "Join" not in final_plan(df)


@pytest.mark.parametrize("name", ["v_sales_monthly", "v_base_sales", "view_rfm", "view_pareto_products", "master_sales_ext", "guard_monthly_parity"])
def test_no_cartesian_product_and_no_python(spark, name):
    plan = final_plan(registry.run(name, spark, SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


def test_scans_read_only_the_needed_columns(spark):
    plan = registry.run("v_sales_monthly", spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    line_scan = next(s for s in re.findall(r"ReadSchema: struct<[^>]*>", plan) if "l_orderkey" in s)
    assert "l_extendedprice" not in line_scan and "l_shipdate" not in line_scan


def test_quantities_of_the_earlier_mart_stay_out_of_the_join(spark):
    """The test for a positive quantity would repeat the whole expression there, too long a method to be compiled."""
    raw = Layers.from_test_data(spark, SMALL).raw
    staged = staging.typed_orders(registry._with_other_quantities(raw.orders))
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[[^]]*\], \[[^]]*\], Inner\n", plan)


def test_products_are_summed_by_month_before_their_categories_are_joined(spark):
    lines = Layers.from_test_data(spark, SMALL).lines
    plan = metrics.v_asp_category_monthly(lines)._jdf.queryExecution().executedPlan().toString()
    keys = {re.sub(r"#\d+L?", "", k) for k in re.findall(r"HashAggregate\(keys=\[([^]]*)\]", plan)}
    assert "order_ym, product_sk" in keys
    assert not any("order_ym" in k and "product_name" in k for k in keys)


def test_plans_are_shared_and_stored_tables_are_not(spark):
    layers = Layers.from_test_data(spark, SMALL)
    first, second = StoredLayers(layers), StoredLayers(layers)
    assert first.lines is second.lines
    assert first.stored("order_ym").inputFiles() != second.stored("order_ym").inputFiles()


def test_intermediate_tables_go_to_the_checkpoint_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert folder in StoredLayers(Layers.from_test_data(spark, SMALL)).stored("order_ym").inputFiles()[0]
