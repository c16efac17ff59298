"""Co-bucketed managed tables: star joins and customer histories without an exchange.

The fact and the customer dimension are dealt to the same number of buckets by the customer's key, and sorted by it, once,
when they are written. What is asked by customer afterwards (the star join, sums and windows by customer) finds each
customer's rows in one sorted bucket. Lines without a customer have no key, so they are not in the fact at all; a customer
with very many lines makes one bucket larger, which the number of buckets must allow for. Joins by key are left plain here,
since a second join key would bring the exchange back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.functions import columns as C
from tillwright.operators import star
from tillwright.plans.layers import Layers
from tillwright.session import temporary_tables
from tillwright.sources.sequences import date_bounds

BUCKETS = 16
KEY = "customer_sk"
_BUCKETED = ("fact_by_customer", "customers_by_key")


def build_bucketed(layers: Layers, database: str, buckets: int = BUCKETS) -> None:
    """Write the fact and its dimensions as managed tables; the fact and the customers by buckets of ``customer_sk``.

    Each bucket is one sorted file: rows are brought together by the same hash that buckets go by before they are written.
    """
    spark = layers.orders.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def store(df: DataFrame, name: str) -> None:
        writer = df.write.mode("overwrite").format("parquet")
        if name in _BUCKETED:
            writer = df.repartition(buckets, KEY).write.mode("overwrite").format("parquet").bucketBy(buckets, KEY).sortBy(KEY)
        writer.saveAsTable(f"{database}.{name}")

    with temporary_tables(spark):
        fact = layers.lines.select(*star.FACT_COLUMNS, "order_date", "customer_email", "city", "product_name", "category_name")
        store(fact, "fact_by_customer")
        lines = spark.table(f"{database}.fact_by_customer")
        # The labels of a customer are found inside its bucket.
        store(star.dim_customer(lines), "customers_by_key")
        store(star.dim_product(lines), "products")
        store(star.dim_date(date_bounds(lines)), "dates")


def star_join(spark: SparkSession, database: str) -> DataFrame:
    """``v_base_sales`` over the bucketed tables; products and dates are broadcast if their measured size allows it."""
    fact = spark.table(f"{database}.fact_by_customer").select(*star.FACT_COLUMNS)
    calendar = spark.table(f"{database}.dates").select(
        "date_key", F.col("date").alias("order_date"), "year", "month", "quarter", C.year_month("date").alias("order_ym"),
        "day_of_week_num", "day_of_week_name",
    )
    joined = fact.join(spark.table(f"{database}.customers_by_key"), KEY)
    return joined.join(spark.table(f"{database}.products"), "product_sk").join(calendar, "date_key").select(*star.BASE_COLUMNS)


def customer_history(spark: SparkSession, database: str) -> DataFrame:
    """Each customer's days in order: ``customer_sk``, ``order_date``, ``lines``, ``sales``, ``visit`` (number of the day),
    ``lines_before``, ``sales_to_date`` and ``days_since_last`` (first day: null). One row per customer and day."""
    fact = spark.table(f"{database}.fact_by_customer").select(KEY, "order_date", "total_sales")
    days = fact.groupBy(KEY, "order_date").agg(F.count(F.lit(1)).alias("lines"), F.sum("total_sales").alias("sales"))
    in_order = W.partitionBy(KEY).orderBy("order_date")
    so_far = in_order.rowsBetween(W.unboundedPreceding, 0)
    return days.select(
        KEY, "order_date", "lines", "sales",
        F.row_number().over(in_order).cast("bigint").alias("visit"),
        (F.sum("lines").over(so_far) - F.col("lines")).alias("lines_before"),
        F.sum("sales").over(so_far).alias("sales_to_date"),
        C.days_between(F.col("order_date"), F.lag("order_date").over(in_order)).alias("days_since_last"),
    )


def customer_values(spark: SparkSession, database: str) -> DataFrame:
    """Lines, units, sales, first and last day of every customer with its labels: an aggregate and a join by one key."""
    fact = spark.table(f"{database}.fact_by_customer")
    totals = fact.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("order_qty").alias("qty"), F.sum("total_sales").alias("sales"),
        F.min("order_date").alias("first_purchase"), F.max("order_date").alias("last_purchase"),
    )
    return totals.join(spark.table(f"{database}.customers_by_key"), KEY).select(
        KEY, "customer_email", "city", "lines", "qty", "sales", "first_purchase", "last_purchase"
    )
