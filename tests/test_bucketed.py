"""Star join and customer histories over co-bucketed tables: right, and without an exchange by customer."""

import pytest

from tests.conftest import SMALL
from tillwright.plans import bucketed
from tillwright.plans.layers import Layers


@pytest.fixture(scope="module")
def database(spark):
    bucketed.build_bucketed(Layers.from_test_data(spark, SMALL), "by_customer", buckets=3)
    return "by_customer"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return [line.strip() for line in plan_of(df).splitlines() if "Exchange" in line and "Broadcast" not in line]


@pytest.fixture
def large_tables(spark):
    """As for tables that are too large to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_history_and_values_need_no_exchange(spark, database, large_tables):
    for ask in (bucketed.customer_history, bucketed.customer_values):
        assert exchanges(ask(spark, database)) == []
        assert ask(spark, database).count() > 0


def test_star_join_needs_none_for_customers(spark, database, large_tables):
    joined = bucketed.star_join(spark, database)
    found = exchanges(joined)
    assert found and not any("customer_sk" in line.split("hashpartitioning(")[1].split(")")[0] for line in found)
    assert "SortMergeJoin [customer_sk" in plan_of(joined)
    assert joined.count() == spark.table(f"{database}.fact_by_customer").count()


def test_buckets_are_sorted_files(spark, database):
    for name in ("fact_by_customer", "customers_by_key"):
        assert len(spark.table(f"{database}.{name}").inputFiles()) == 3
