"""Flat line-grain sales table and its checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions import columns as C
from tillwright.operators.combine import join_lines

MASTER_COLUMNS = (
    "cust_email",
    "cust_city",
    "order_date",
    "order_qty",
    "product_name",
    "product_price",
    "category_name",
    "total_sales",
)


def _labelled(customers: DataFrame, products: DataFrame, categories: DataFrame, how: str = "inner") -> tuple[DataFrame, DataFrame]:
    """Customers and products with the labels of their lines."""
    product = (
        join_lines(products, categories.withColumn("has_category", F.lit(True)), "CategoryID", how)
        .select(
            "ProdNumber",
            F.col("ProdName").alias("product_name"),
            F.col("Price").alias("product_price"),
            F.col("CategoryName").alias("category_name"),
            F.coalesce("has_category", F.lit(False)).alias("has_category"),
        )
    )
    customer = customers.select(
        "CustomerID", F.col("CustomerEmail").alias("cust_email"), F.col("CustomerCity").alias("cust_city")
    )
    return customer, product


def _key(name: str) -> Column:
    return C.customer_key("cust_email") if name == "customer_sk" else C.product_key("product_name", "category_name")


def master_sales(
    orders: DataFrame, customers: DataFrame, products: DataFrame, categories: DataFrame, keys: bool = False
) -> DataFrame:
    """Order lines with customer, product and category, and ``total_sales`` = quantity × price.

    The staged tables are unique on their keys, so the inner joins also drop lines without a partner: ``orders`` may be
    the output of ``typed_orders`` or of ``stg_orders``, the result is the same. Product and category are joined first,
    so that the line table is joined twice only. ``keys=True`` appends ``customer_sk`` and ``product_sk``, hashed once
    per customer and product instead of once per line.
    """
    customer, product = _labelled(customers, products, categories)
    if keys:
        customer, product = customer.withColumn("customer_sk", _key("customer_sk")), product.withColumn("product_sk", _key("product_sk"))
    lines = orders.select("CustomerID", "ProdNumber", "OrderDate", "Quantity")
    return join_lines(join_lines(lines, customer, "CustomerID"), product, "ProdNumber").select(
        "cust_email",
        "cust_city",
        F.col("OrderDate").alias("order_date"),
        F.col("Quantity").alias("order_qty"),
        "product_name",
        "product_price",
        "category_name",
        (F.col("Quantity").cast(C.QTY_TYPE) * F.col("product_price")).alias("total_sales"),
        *(["customer_sk", "product_sk"] if keys else []),
    )


def staged_lines(orders: DataFrame, customers: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """What ``stg_orders`` and ``master_sales`` both take from: the lines whose customer and product survive staging, with
    their labels, from one join with each. ``has_category`` tells the lines of the master, whose product has a category
    that survives. ``orders`` as for ``master_sales``; the month is made anew of the date behind the joins, so that it does not
    go through them."""
    customer, product = _labelled(customers, products, categories, "left")
    return join_lines(join_lines(orders.drop("order_ym"), customer, "CustomerID"), product, "ProdNumber").select(
        *[C.year_month("OrderDate").alias(c) if c == "order_ym" else c for c in orders.columns],
        *[c for c in customer.columns if c != "CustomerID"],
        *[c for c in product.columns if c != "ProdNumber"],
    )


def master_of_staged(lines: DataFrame) -> DataFrame:
    """``master_sales`` with its keys and ``order_ym``, of ``staged_lines``. The keys are hashed line by line here: eight
    bytes each that do not compress would go through every exchange of the lines and lie in the staged table, too."""
    return lines.filter("has_category").select(
        "cust_email",
        "cust_city",
        F.col("OrderDate").alias("order_date"),
        F.col("Quantity").alias("order_qty"),
        "product_name",
        "product_price",
        "category_name",
        (F.col("Quantity").cast(C.QTY_TYPE) * F.col("product_price")).alias("total_sales"),
        _key("customer_sk").alias("customer_sk"),
        _key("product_sk").alias("product_sk"),
        "order_ym",
    )


def master_expected_rows(
    orders: DataFrame, customers: DataFrame, products: DataFrame, categories: DataFrame
) -> DataFrame:
    return master_sales(orders, customers, products, categories).agg(F.count("*").alias("expected_rows"))


def _validity(master: DataFrame, rows: str, qty: str, price: str) -> DataFrame:
    return master.agg(
        F.count("*").alias(rows),
        F.count_if(F.col("order_date").isNull()).alias("null_order_date"),
        F.count_if(F.col("order_qty").isNull() | (F.col("order_qty") <= 0)).alias(qty),
        F.count_if(F.col("product_price").isNull() | (F.col("product_price") <= 0)).alias(price),
    )


def qa_master_validity(master: DataFrame) -> DataFrame:
    return _validity(master, "rows_master", "invalid_qty", "invalid_price")


def ext_precheck(master: DataFrame) -> DataFrame:
    return _validity(master, "rows_master", "bad_qty", "bad_price")


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date"))


def _totals(master: DataFrame, *by) -> DataFrame:
    return master.groupBy(*by).agg(F.sum("total_sales").alias("total_revenue"), F.sum("order_qty").alias("total_units"))


def master_monthly(master: DataFrame) -> DataFrame:
    return _totals(master, C.year_month("order_date").alias("year_month"))


def master_by_category(master: DataFrame) -> DataFrame:
    return _totals(master, "category_name")


def newest_rows(df: DataFrame, columns: list[str], n: int = 20) -> DataFrame:
    """Newest ``n`` rows; ties are broken by all shown columns, so that the sample is reproducible."""
    rest = [c for c in columns if c != "order_date"]
    return df.select(*columns).orderBy(F.desc("order_date"), *rest).limit(n)


def master_spot_check(master: DataFrame, n: int = 20) -> DataFrame:
    return newest_rows(
        master,
        [
            "order_date",
            "cust_email",
            "cust_city",
            "product_name",
            "category_name",
            "order_qty",
            "product_price",
            "total_sales",
        ],
        n,
    )
