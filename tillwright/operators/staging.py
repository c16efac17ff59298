"""Typed, trimmed and deduplicated staging tables, and the checks on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.functions import columns as C
from tillwright.operators.combine import join_lines, one_row
from tillwright.operators.profiling import row_counts, rows_without_partner
from tillwright.sources.files import schema_snapshot


ORDER_COLUMNS = ("OrderID", "OrderDate", "CustomerID", "ProdNumber", "Quantity", "order_ym")


def first_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per non-NULL key: the smallest row, comparing all other columns from left to right.

    An aggregate rather than a window: every task reduces its own rows first, so a key with a huge number of copies
    ships one row per task.
    """
    rest = [c for c in df.columns if c != key]
    best = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("best"))
    return best.select(key, "best.*").select(*df.columns)


def stg_customers(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        C.safe_int("CustomerID").alias("CustomerID"),
        C.trim_all("FirstName").alias("FirstName"),
        C.trim_all("LastName").alias("LastName"),
        C.full_name("FirstName", "LastName").alias("CustomerName"),
        C.clean_email("CustomerEmail").alias("CustomerEmail"),
        C.digits_only("CustomerPhone").alias("CustomerPhone"),
        C.trim_all("CustomerAddress").alias("CustomerAddress"),
        C.trim_all("CustomerCity").alias("CustomerCity"),
        F.upper(C.trim_all("CustomerState")).alias("CustomerState"),
        C.trim_all("CustomerZip").alias("CustomerZip"),
    )
    return first_per_key(typed, "CustomerID")


def stg_product_category(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        C.safe_int("CategoryID").alias("CategoryID"),
        C.trim_all("CategoryName").alias("CategoryName"),
        F.upper(C.trim_all("CategoryAbbreviation")).alias("CategoryAbbreviation"),
    )
    return first_per_key(typed, "CategoryID")


def stg_products(raw: DataFrame, price_type: str = C.PRICE_TYPE) -> DataFrame:
    """Products with a category number and a positive price.

    Validity is tested before deduplication, so that a bad copy of a key never displaces a good one.
    """
    typed = raw.select(
        C.trim_all("ProdNumber").alias("ProdNumber"),
        C.trim_all("ProdName").alias("ProdName"),
        C.safe_int("Category").alias("CategoryID"),
        C.safe_decimal("Price", price_type).alias("Price"),
    )
    return first_per_key(typed.filter("CategoryID IS NOT NULL AND Price > 0"), "ProdNumber")


def typed_orders(raw: DataFrame, formats: Sequence[str] = C.DATE_FORMATS) -> DataFrame:
    """Order lines with typed columns, a valid date and a positive quantity; foreign keys are not checked.

    The date passes through an array of one element. The test for a valid date then stays above the parsing; without
    that, the optimizer moves the test into the scan and every date is parsed twice.
    """
    trimmed = raw.withColumn("Date", C.trim_all("Date"))
    typed = trimmed.select(
        C.safe_int("OrderID").alias("OrderID"),
        F.explode(F.array(C.safe_date("Date", formats, trimmed=True))).alias("OrderDate"),
        C.safe_int("CustomerID").alias("CustomerID"),
        C.trim_all("ProdNumber").alias("ProdNumber"),
        C.safe_int("Quantity").alias("Quantity"),
    ).filter("OrderID IS NOT NULL AND OrderDate IS NOT NULL AND Quantity > 0")
    return typed.withColumn("order_ym", C.year_month("OrderDate"))


def stg_orders(
    raw: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    formats: Sequence[str] = C.DATE_FORMATS,
    dedup: bool = False,
) -> DataFrame:
    """Order lines whose customer and product both survive staging.

    Order numbers are not unique by default; ``dedup=True`` keeps the smallest line of each.
    """
    lines = with_partners(typed_orders(raw, formats), customers, products)
    return first_per_key(lines, "OrderID") if dedup else lines


def with_partners(typed: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """``stg_orders`` of ``typed_orders``."""
    lines = join_lines(typed, customers.select("CustomerID"), "CustomerID", "left_semi")
    return join_lines(lines, products.select("ProdNumber"), "ProdNumber", "left_semi").select(*ORDER_COLUMNS)


# ---- checks -------------------------------------------------------------------------------------------------


def v_stg_rowcounts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return row_counts(tables).select(F.col("table_name").alias("name"), F.col("n_rows").alias("n"))


def v_stg_schema_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    return schema_snapshot(spark, tables).drop("ordinal_position")


def qa_rowcounts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return v_stg_rowcounts(tables).orderBy("name")


def qa_schema(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    return v_stg_schema_catalog(spark, tables).orderBy("table_name", "column_name")


def qa_order_nulls(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count("*").alias("rows_stg_orders"),
        *[
            F.count_if(F.col(c).isNull()).alias(f"null_{c.lower()}")
            for c in ("OrderID", "OrderDate", "CustomerID", "ProdNumber")
        ],
    )


def qa_coverage(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.min("OrderDate").alias("min_order_date"),
        F.max("OrderDate").alias("max_order_date"),
        F.count_distinct("CustomerID").alias("unique_customers"),
        F.count_distinct("ProdNumber").alias("unique_products"),
    )


def qa_orphans(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Lines without customer and without product after staging; both counts are 0 on a sound build."""
    return one_row(
        rows_without_partner(orders, customers, "CustomerID", "CustomerID", "orphan_orders_missing_customer"),
        rows_without_partner(orders, products, "ProdNumber", "ProdNumber", "orphan_orders_missing_product"),
    )


def latest_orders(orders: DataFrame, n: int = 10) -> DataFrame:
    shown = orders.select("OrderDate", F.col("order_ym").alias("ym"), "CustomerID", "ProdNumber", "Quantity")
    return shown.orderBy(F.desc("OrderDate"), "CustomerID", "ProdNumber", "Quantity").limit(n)


def top_cities(customers: DataFrame, n: int = 10) -> DataFrame:
    counts = customers.groupBy("CustomerCity").agg(F.count("*").alias("total_customers"))
    return counts.orderBy(F.desc("total_customers"), "CustomerCity").limit(n)


def top_products_by_lines(orders: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Most ordered products; lines are counted per product before the names are joined."""
    counts = orders.groupBy("ProdNumber").agg(F.count("*").alias("order_lines"))
    named = counts.join(products.select("ProdNumber", "ProdName"), "ProdNumber")
    return named.select("ProdNumber", "ProdName", "order_lines").orderBy(F.desc("order_lines"), "ProdNumber").limit(n)
