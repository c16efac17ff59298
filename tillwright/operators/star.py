"""Star schema: line table with keys, three dimensions, fact, and the checks on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions import columns as C
from tillwright.operators.combine import join_lines, one_row
from tillwright.sources.sequences import day_calendar

BASE_COLUMNS = (
    "date_key",
    "order_date",
    "year",
    "month",
    "quarter",
    "order_ym",
    "day_of_week_num",
    "day_of_week_name",
    "customer_sk",
    "customer_email",
    "city",
    "product_sk",
    "product_name",
    "category_name",
    "order_qty",
    "total_sales",
    "product_price",
)

FACT_COLUMNS = ("date_key", "customer_sk", "product_sk", "order_qty", "total_sales", "product_price")


def sales_lines(master: DataFrame) -> DataFrame:
    """Master lines with surrogate keys and calendar columns, in the shape of ``v_base_sales``.

    All columns are derived on the line itself, without any join, and unused ones are pruned; lines without a key or a
    date are dropped, as the fact joins do. Labels are those of the line; the metrics that group by a label settle on one
    label per key themselves (see ``label_table``), so they accept this frame and ``v_base_sales`` alike.
    """
    email, city = F.lower(C.trim_all("cust_email")), C.trim_all("cust_city")
    product, category = C.trim_all("product_name"), C.trim_all("category_name")
    customer_sk = F.col("customer_sk") if "customer_sk" in master.columns else C.customer_key("cust_email")
    product_sk = (
        F.col("product_sk") if "product_sk" in master.columns else C.product_key("product_name", "category_name")
    )
    day = F.col("order_date")
    lines = master.select(
        C.date_key(day).alias("date_key"),
        day,
        C.year(day).alias("year"),
        C.month(day).alias("month"),
        C.quarter(day).alias("quarter"),
        C.year_month(day).alias("order_ym"),
        C.day_of_week(day).alias("day_of_week_num"),
        C.day_name(day).alias("day_of_week_name"),
        customer_sk.alias("customer_sk"),
        email.alias("customer_email"),
        city.alias("city"),
        product_sk.alias("product_sk"),
        product.alias("product_name"),
        category.alias("category_name"),
        "order_qty",
        "total_sales",
        "product_price",
    )
    return lines.filter("customer_sk IS NOT NULL AND product_sk IS NOT NULL AND order_date IS NOT NULL")


def _keyed(master: DataFrame) -> DataFrame:
    """The master lines that ``sales_lines`` keeps: a key is missing only if what it is made of is."""
    return master.filter("cust_email IS NOT NULL AND product_name IS NOT NULL AND category_name IS NOT NULL AND order_date IS NOT NULL")


def customer_lines(master: DataFrame) -> DataFrame:
    """Of ``sales_lines``, for each spelling of a customer its keys, labels and latest day: what ``dim_customer`` needs.
    Keys are hashed and labels trimmed once per spelling, not once per line."""
    seen = _keyed(master).groupBy("cust_email", "cust_city").agg(F.max("order_date").alias("order_date"))
    email, city = F.lower(C.trim_all("cust_email")), C.trim_all("cust_city")
    return seen.select(C.customer_key("cust_email").alias("customer_sk"), email.alias("customer_email"), city.alias("city"), "order_date")


def product_lines(master: DataFrame) -> DataFrame:
    """As ``customer_lines``, for ``dim_product``."""
    seen = _keyed(master).groupBy("product_name", "category_name").agg(F.max("order_date").alias("order_date"))
    product, category = C.trim_all("product_name"), C.trim_all("category_name")
    key = C.product_key("product_name", "category_name")
    return seen.select(key.alias("product_sk"), product.alias("product_name"), category.alias("category_name"), "order_date")


def customer_months(master: DataFrame) -> DataFrame:
    """``customer_sk`` and ``order_ym`` of ``sales_lines``, once for each email and month."""
    seen = _keyed(master).groupBy("cust_email", C.year_month("order_date").alias("order_ym")).agg(F.count(F.lit(1)))
    return seen.select(C.customer_key("cust_email").alias("customer_sk"), "order_ym")


def sold_dates(master: DataFrame) -> DataFrame:
    """``order_date`` of ``sales_lines``; no key is hashed."""
    return _keyed(master).select("order_date")


def label_table(lines: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """One row per key with the labels of its latest order date, ties going to the greatest labels.

    The lines collapse to one row per distinct (key, labels) before labels are compared.
    """
    variants = lines.groupBy(key, *labels).agg(F.max("order_date").alias("seen"))
    latest = variants.groupBy(key).agg(F.max(F.struct("seen", *labels)).alias("latest"))
    return latest.select(key, *[f"latest.{c}" for c in labels])


def dim_date(bounds: DataFrame) -> DataFrame:
    """Calendar between ``lo`` and ``hi`` of a one-row frame (see ``date_bounds`` and ``fixed_bounds``)."""
    day = F.col("date")
    return day_calendar(bounds).select(
        C.date_key(day).alias("date_key"),
        day,
        C.year(day).alias("year"),
        C.quarter(day).alias("quarter"),
        C.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_name_short"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        C.day_of_week(day).alias("day_of_week_num"),
        C.day_name(day).alias("day_of_week_name"),
        C.week_sunday(day).alias("week_of_year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def dim_customer(lines: DataFrame) -> DataFrame:
    """One row per customer key, with the latest city."""
    return label_table(lines, "customer_sk", ["customer_email", "city"])


def dim_product(lines: DataFrame) -> DataFrame:
    """One row per product key, with the latest spelling of name and category."""
    return label_table(lines, "product_sk", ["product_name", "category_name"])


def fact_sales(lines: DataFrame, dates: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Keys and measures of the lines that are present in all three dimensions.

    The dimensions are unique on their keys and no column of theirs is taken, hence semi joins.
    """
    fact = lines.select(*FACT_COLUMNS)
    for key, dimension in (("date_key", dates), ("customer_sk", customers), ("product_sk", products)):
        fact = join_lines(fact, dimension.select(key), key, "left_semi")
    return fact.select(*FACT_COLUMNS)


def v_base_sales(
    fact: DataFrame, dates: DataFrame, customers: DataFrame, products: DataFrame, month: str | None = None
) -> DataFrame:
    """Canonical star join; which sides are broadcast is left to their measured sizes. ``month`` names a column of the
    fact that holds the month already, as one it is stored by does."""
    calendar = dates.select(
        "date_key",
        F.col("date").alias("order_date"),
        "year",
        "month",
        "quarter",
        C.year_month("date").alias("order_ym"),
        "day_of_week_num",
        "day_of_week_name",
    )
    if month:
        calendar = calendar.drop("order_ym")
    fact = fact.withColumnRenamed(month, "order_ym") if month else fact.select(*FACT_COLUMNS)
    joined = join_lines(join_lines(fact, calendar, "date_key"), customers, "customer_sk")
    return join_lines(joined, products, "product_sk").select(*BASE_COLUMNS)


# ---- checks -------------------------------------------------------------------------------------------------


def star_precheck(master: DataFrame) -> DataFrame:
    return master.agg(
        F.count("*").alias("rows_master"), F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date")
    )


def qa_row_parity(master: DataFrame, fact: DataFrame) -> DataFrame:
    """Row counts of both layers; they differ by the master lines without a key or outside the calendar."""
    return one_row(master.agg(F.count("*").alias("rows_master")), fact.agg(F.count("*").alias("rows_fact")))


def qa_null_keys(fact: DataFrame) -> DataFrame:
    keys = ("date_key", "customer_sk", "product_sk")
    return fact.agg(*[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys])


def qa_fact_date_window(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """First and last date of the fact, through the calendar; only the distinct keys are joined."""
    used = fact.select("date_key").distinct()
    return used.join(dates, "date_key").agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def qa_reaggregate(master: DataFrame, fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Monthly totals of both layers side by side; a month missing on one side shows as NULL."""
    upstream = master.groupBy(C.year_month("order_date").alias("ym")).agg(
        F.sum("total_sales").alias("master_sales"), F.sum("order_qty").alias("master_qty")
    )
    daily = fact.groupBy("date_key").agg(F.sum("total_sales").alias("sales"), F.sum("order_qty").alias("qty"))
    star = (
        daily.join(dates.select("date_key", C.year_month("date").alias("ym")), "date_key")
        .groupBy("ym")
        .agg(F.sum("sales").alias("fact_sales"), F.sum("qty").alias("fact_qty"))
    )
    return upstream.join(star, "ym", "full_outer").select("ym", "master_sales", "fact_sales", "master_qty", "fact_qty")


def star_sample(fact: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Sales by year, month and category; lines are summed per product and day before any dimension is joined."""
    daily = fact.groupBy("date_key", "product_sk").agg(F.sum("total_sales").alias("sales"), F.sum("order_qty").alias("qty"))
    return (
        daily.join(dates.select("date_key", "year", "month"), "date_key")
        .join(products.select("product_sk", "category_name"), "product_sk")
        .groupBy("year", "month", "category_name")
        .agg(F.sum("sales").alias("sales"), F.sum("qty").alias("qty"))
    )
