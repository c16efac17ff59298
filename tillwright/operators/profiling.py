"""Profiles and quality counts of raw tables; all raw columns are text."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.functions import columns as C
from tillwright.operators.combine import one_row
from tillwright.operators.states import BINS, checked_quantiles, merged_quantiles, quantile_summary
from tillwright.operators.scale import exact_quantiles
from tillwright.session import materialise
from tillwright.sources.retail import RawTables
from tillwright.sources.sequences import numbers

# The key of each raw table.
RAW_KEYS = {
    "raw_orders": "OrderID",
    "raw_customers": "CustomerID",
    "raw_products": "ProdNumber",
    "raw_product_category": "CategoryID",
}


def head_preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows in the order of all columns, so that the preview is reproducible."""
    return df.orderBy(*df.columns).limit(n)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def coverage(orders: DataFrame) -> DataFrame:
    day = C.safe_date("Date")
    return orders.agg(
        F.min(day).alias("min_order_date"),
        F.max(day).alias("max_order_date"),
        F.count("*").alias("n_orders"),
        F.count_distinct("CustomerID").alias("unique_customers"),
        F.count_distinct("ProdNumber").alias("unique_products"),
    )


def customer_completeness(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.count_if(C.is_blank("CustomerEmail")).alias("null_email"),
        F.count_if(C.is_blank("CustomerCity")).alias("null_city"),
    )


def _missing(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def _non_positive(value: Column) -> Column:
    return F.count_if(value <= 0)


def order_completeness(orders: DataFrame) -> DataFrame:
    return orders.agg(
        _missing("Date").alias("null_date"),
        _missing("CustomerID").alias("null_customer"),
        _missing("ProdNumber").alias("null_prod"),
        _missing("Quantity").alias("null_qty"),
        _non_positive(C.safe_int("Quantity")).alias("non_positive_qty"),
    )


def product_completeness(products: DataFrame) -> DataFrame:
    return products.agg(
        _missing("Category").alias("null_category"),
        _missing("Price").alias("null_price"),
        _non_positive(C.safe_decimal("Price")).alias("non_positive_price"),
    )


def duplicate_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, str] = RAW_KEYS) -> DataFrame:
    """Per table, the number of keys that occur more than once (keys, not surplus rows)."""
    parts = []
    for name, key in keys.items():
        repeated = tables[name].groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")
        parts.append(repeated.agg(F.count("*").alias("duplicate_rows")).select(F.lit(name).alias("table_name"), "duplicate_rows"))
    return reduce(DataFrame.unionByName, parts)


def rows_without_partner(left: DataFrame, right: DataFrame, key: str, right_key: str, name: str, rows: Column | None = None) -> DataFrame:
    """Number of ``left`` rows whose key is missing or absent from ``right``; ``rows`` says how many a row stands for.

    Both sides are reduced to one row per key before they meet, so that a hot key is a single row with a count.
    """
    mine = left.groupBy(F.col(key).alias("k")).agg((F.count("*") if rows is None else F.sum(rows)).alias("n"))
    theirs = right.select(F.col(right_key).alias("k")).distinct()
    return mine.join(theirs, "k", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias(name))


def orphan_orders_no_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return rows_without_partner(orders, customers, "CustomerID", "CustomerID", "orphan_orders_no_customer")


def orphan_orders_no_product(orders: DataFrame, products: DataFrame) -> DataFrame:
    return rows_without_partner(orders, products, "ProdNumber", "ProdNumber", "orphan_orders_no_product")


def orphan_products_no_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    return rows_without_partner(products, categories, "Category", "CategoryID", "orphan_products_no_category")


def products_never_ordered(products: DataFrame, orders: DataFrame) -> DataFrame:
    return rows_without_partner(products, orders, "ProdNumber", "ProdNumber", "products_never_ordered")


def categories_without_products(categories: DataFrame, products: DataFrame) -> DataFrame:
    return rows_without_partner(categories, products, "CategoryID", "Category", "categories_without_products")


def bad_email_format(customers: DataFrame) -> DataFrame:
    return customers.agg(F.count_if(~C.is_email("CustomerEmail")).alias("bad_email_format"))


def city_has_whitespace(customers: DataFrame) -> DataFrame:
    city = F.col("CustomerCity")
    return customers.agg(F.count_if(city != C.trim_all(city)).alias("city_has_whitespace"))


def _uncastable(c: str, cast: Column) -> Column:
    return F.count_if(F.col(c).isNotNull() & cast.isNull())


def bad_customerid_cast(customers: DataFrame) -> DataFrame:
    return customers.agg(_uncastable("CustomerID", C.safe_int("CustomerID")).alias("bad_customerid_cast"))


def order_cast_checks(orders: DataFrame) -> DataFrame:
    return orders.agg(
        _uncastable("Quantity", C.safe_int("Quantity")).alias("bad_quantity_cast"),
        F.count_if(C.trim_all("ProdNumber") == "").alias("empty_prodnumber"),
    )


def product_cast_checks(products: DataFrame) -> DataFrame:
    return products.agg(
        _uncastable("Price", C.safe_decimal("Price")).alias("bad_price_cast"),
        _uncastable("Category", C.safe_int("Category")).alias("bad_category_cast"),
    )


def _mean(value: Column) -> Column:
    return C.safe_ratio(F.sum(value), F.count(value))


def _quantiles(df: DataFrame, value: Column, wanted: dict[str, float], approx: bool, accuracy: int) -> DataFrame:
    if not approx:
        return exact_quantiles(df, value, wanted)
    points = df.agg(F.percentile_approx(value, list(wanted.values()), accuracy).alias("q"))
    return points.select(*[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(wanted)])


def quantity_profile(orders: DataFrame, approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Range, quartiles, mean and spread of the castable quantities; ``approx`` uses a mergeable sketch."""
    qty = C.safe_int("Quantity")
    quartiles = _quantiles(orders, qty, {"q1_qty": 0.25, "median_qty": 0.5, "q3_qty": 0.75}, approx, accuracy)
    moments = orders.agg(
        F.min(qty).alias("min_qty"), F.max(qty).alias("max_qty"), _mean(qty).alias("mean_qty"), F.stddev_pop(qty).alias("std_qty")
    )
    return one_row(moments, quartiles).select("min_qty", "q1_qty", "median_qty", "q3_qty", "max_qty", "mean_qty", "std_qty")


def price_profile(products: DataFrame, approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    price = C.safe_decimal("Price")
    points = _quantiles(products, price, {"p25_price": 0.25, "median_price": 0.5, "p75_price": 0.75}, approx, accuracy)
    moments = products.agg(
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        _mean(price).alias("mean_price"),
        F.stddev_pop(price).alias("std_price"),
        _non_positive(price).alias("non_positive_price_cnt"),
    )
    return one_row(moments, points).select(
        "min_price", "p25_price", "median_price", "p75_price", "max_price", "mean_price", "std_price", "non_positive_price_cnt"
    )


def quantile_check(df: DataFrame, value: Column, by: Column, wanted: dict[str, float], bins: int = BINS) -> DataFrame:
    """Quantiles merged from summaries of each group of ``by``, with the ranks that they really have and the error."""
    quantiles = merged_quantiles(materialise(quantile_summary(df, value, by, bins), "quantiles"), wanted)
    return checked_quantiles(df, value, quantiles, bins)


def quantity_quantiles(orders: DataFrame) -> DataFrame:
    """Quartiles of the castable quantities, from summaries by month (lines without a date are a group of their own)."""
    month = F.coalesce(C.year_month(C.safe_date("Date")), F.lit(""))
    return quantile_check(orders, C.safe_int("Quantity"), month, {"q1_qty": 0.25, "median_qty": 0.5, "q3_qty": 0.75})


def price_quantiles(products: DataFrame, bins: int = 100 * BINS) -> DataFrame:
    """Quartiles of the castable prices, from summaries by category."""
    wanted = {"p25_price": 0.25, "median_price": 0.5, "p75_price": 0.75}
    return quantile_check(products, C.safe_decimal("Price"), F.coalesce("Category", F.lit("")), wanted, bins)


def id_gaps(df: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Numbers between the smallest and largest key that no row has; with ``limit`` the lowest ones only.

    Gaps lie between neighbours, so the cost is that of sorting the distinct keys, however far apart they are. Each sorted
    piece is read by itself, and the last key of a piece is bridged with the first one of the next.
    """
    ids = df.select(C.safe_int(key).alias("id")).filter("id IS NOT NULL").distinct()
    pieces = materialise(ids.orderBy("id").select("id", F.shiftright(F.monotonically_increasing_id(), 33).alias("piece")), "ids")
    inside = pieces.select("id", F.lead("id").over(W.partitionBy("piece").orderBy("id")).alias("next"))
    # One row per sorted piece.
    ends = pieces.groupBy("piece").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    between = ends.select(F.col("hi").alias("id"), F.lead("lo").over(W.orderBy("piece")).alias("next"))
    gaps = inside.unionByName(between).filter("next > id + 1").select((F.col("id") + 1).alias("lo"), (F.col("next") - 1).alias("hi"))
    if limit is None:
        return numbers(gaps).select(F.col("n").alias("missing_id"))
    first = gaps.orderBy("lo").limit(limit).select("lo", F.least("hi", F.col("lo") + (limit - 1)).alias("hi"))
    return numbers(first).select(F.col("n").alias("missing_id")).orderBy("missing_id").limit(limit)


def top_cities(customers: DataFrame, n: int = 10) -> DataFrame:
    counts = customers.groupBy("CustomerCity").agg(F.count("*").alias("total_customers"))
    return counts.orderBy(F.desc("total_customers"), "CustomerCity").limit(n)


def top_products_by_qty(orders: DataFrame, n: int = 10) -> DataFrame:
    qty = C.safe_int("Quantity")
    totals = orders.groupBy("ProdNumber").agg(_mean(qty).alias("avg_qty"), F.sum(qty).alias("total_qty"))
    return totals.orderBy(F.desc("total_qty"), "ProdNumber").limit(n)


def summary_snapshot(raw: RawTables) -> DataFrame:
    """Eight totals on one row. Order lines are counted by customer and product once; all that is asked of them is added
    up from these counts."""
    counted = raw.orders.groupBy("CustomerID", "ProdNumber").agg(
        F.count("*").alias("lines"), _non_positive(C.safe_int("Quantity")).alias("bad_lines")
    )
    lines = F.col("lines")
    return one_row(
        raw.customers.agg(F.count("*").alias("total_customers")),
        counted.agg(
            F.coalesce(F.sum("lines"), F.lit(0).cast("bigint")).alias("total_orders"),
            F.coalesce(F.sum("bad_lines"), F.lit(0).cast("bigint")).alias("invalid_qty"),
        ),
        raw.products.agg(
            F.count("*").alias("total_products"), _non_positive(C.safe_decimal("Price")).alias("invalid_price")
        ),
        raw.categories.agg(F.count("*").alias("total_categories")),
        rows_without_partner(counted, raw.customers, "CustomerID", "CustomerID", "orphan_orders_no_customer", lines),
        rows_without_partner(counted, raw.products, "ProdNumber", "ProdNumber", "orphan_orders_no_product", lines),
    ).select(
        "total_customers",
        "total_orders",
        "total_products",
        "total_categories",
        "invalid_qty",
        "invalid_price",
        "orphan_orders_no_customer",
        "orphan_orders_no_product",
    )
