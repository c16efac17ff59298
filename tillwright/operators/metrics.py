"""KPI views over the sales lines.

``lines`` is the output of ``star.sales_lines`` or of ``star.v_base_sales``. An order is approximated by a customer on a
day. Views that group by a label (city, product, category) first sum per key and settle the label of each key on the
reduced rows, so that no dimension has to be joined to the lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.functions import columns as C
from tillwright.operators.combine import join_lines
from tillwright.operators.scale import global_running
from tillwright.operators.star import label_table
from tillwright.sources.sequences import month_calendar

CITY = ["city"]
PRODUCT = ["product_name", "category_name"]


def rollup(df: DataFrame, by: Sequence[str], *extra: Column, sales: str = "total_sales", qty: str = "order_qty") -> DataFrame:
    """Sales and units per group, plus any further aggregates."""
    return df.groupBy(*by).agg(F.sum(sales).alias("sales"), F.sum(qty).alias("qty"), *extra)


def resum(df: DataFrame, by: Sequence[str], *extra: Column) -> DataFrame:
    """``rollup`` of a frame that holds partial sums already."""
    return rollup(df, by, *extra, sales="sales", qty="qty")


def with_asp(df: DataFrame) -> DataFrame:
    """Average selling price: sales per unit."""
    return df.withColumn("asp", C.safe_ratio(F.col("sales"), F.col("qty")))


def _aov(sales: str = "sales", orders: str = "orders_proxy") -> Column:
    return C.safe_ratio(F.col(sales), F.col(orders)).alias("aov_proxy")


def per_key(lines: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Sales and units per surrogate key, with the key's latest labels."""
    variants = rollup(lines, [key, *labels], F.max("order_date").alias("seen"))
    totals = resum(variants, [key], F.max(F.struct("seen", *labels)).alias("latest"))
    return totals.select(key, *[f"latest.{c}" for c in labels], "sales", "qty")


def per_key_and(lines: DataFrame, by: Sequence[str], key: str, labels: Sequence[str]) -> DataFrame:
    """As ``per_key``, within groups of ``by``; a window settles the labels, over a key's rows per group only."""
    variants = rollup(lines, [*by, key, *labels], F.max("order_date").alias("seen"))
    latest = variants.withColumn("latest", F.max(F.struct("seen", *labels)).over(W.partitionBy(key)))
    return latest.select(*by, key, *[f"latest.{c}" for c in labels], "sales", "qty")


# ---- time ---------------------------------------------------------------------------------------------------


def v_sales_daily(lines: DataFrame) -> DataFrame:
    """Within one day the order proxy is the customer count, so one distinct count serves both."""
    daily = with_asp(rollup(lines, ["order_date"], F.count_distinct("customer_sk").alias("active_customers")))
    return daily.select("order_date", "sales", "qty", "active_customers", "asp", _aov(orders="active_customers"))


def v_sales_daily_min(lines: DataFrame) -> DataFrame:
    return rollup(lines, ["order_date"])


def v_sales_monthly(lines: DataFrame) -> DataFrame:
    monthly = with_asp(
        rollup(
            lines,
            ["order_ym"],
            F.min("order_date").alias("month_start"),
            F.max("order_date").alias("month_end"),
            F.count_distinct("customer_sk").alias("active_customers"),
        )
    )
    return monthly.select("order_ym", "month_start", "month_end", "sales", "qty", "active_customers", "asp")


def v_aov_monthly(lines: DataFrame) -> DataFrame:
    """Lines are summed per customer and day first; a row of that sum is an order, so rows are counted."""
    orders = lines.groupBy("order_ym", "customer_sk", "date_key").agg(F.sum("total_sales").alias("sales"))
    monthly = orders.groupBy("order_ym").agg(F.sum("sales").alias("sales"), F.count("*").alias("orders_proxy"))
    return monthly.select("order_ym", "sales", "orders_proxy", _aov())


def v_kpi_overview_monthly(lines: DataFrame) -> DataFrame:
    """Monthly headline figures in one pass: days per customer, customers per month."""
    days = rollup(lines, ["order_ym", "customer_sk", "date_key"])
    customers = resum(days, ["order_ym", "customer_sk"], F.count("*").alias("orders"))
    monthly = with_asp(
        resum(customers, ["order_ym"], F.count("*").alias("active_customers"), F.sum("orders").alias("orders_proxy"))
    )
    return monthly.select("order_ym", "sales", "qty", "active_customers", "asp", _aov())


def v_sales_by_dow(lines: DataFrame) -> DataFrame:
    """The day name hangs on the day number, so it is put on the seven result rows, not on the lines."""
    by_day = rollup(
        lines, ["day_of_week_num"], F.count_distinct("customer_sk").alias("active_customers"), F.min("order_date").alias("day")
    )
    return with_asp(by_day).select(
        "day_of_week_num", C.day_name("day").alias("day_of_week_name"), "sales", "qty", "asp", "active_customers"
    )


# ---- product, category, city --------------------------------------------------------------------------------


def v_category_performance(lines: DataFrame) -> DataFrame:
    return with_asp(resum(per_key(lines, "product_sk", PRODUCT), ["category_name"]))


def product_totals(lines: DataFrame) -> DataFrame:
    return with_asp(resum(per_key(lines, "product_sk", PRODUCT), PRODUCT))


def v_top_products(lines: DataFrame) -> DataFrame:
    order = [F.desc("sales"), F.asc("product_name"), F.asc("category_name")]
    return global_running(product_totals(lines), order, dense_by="sales", dense="sales_rank")


def _category_monthly(lines: DataFrame) -> DataFrame:
    """Lines are summed by product and month before the categories are joined: rows with labels are four times as wide, and
    there are almost as many of them as lines. Pass stored lines, as they are read twice."""
    categories = label_table(lines, "product_sk", PRODUCT).select("product_sk", "category_name")
    products = rollup(lines, ["order_ym", "product_sk"])
    return resum(join_lines(products, categories, "product_sk"), ["order_ym", "category_name"])


def v_mix_share_monthly(lines: DataFrame) -> DataFrame:
    month = W.partitionBy("order_ym")
    return _category_monthly(lines).select(
        "*",
        C.safe_ratio(F.col("sales"), F.sum("sales").over(month)).alias("sales_share"),
        C.safe_ratio(F.col("qty"), F.sum("qty").over(month)).alias("qty_share"),
    )


def v_asp_category_monthly(lines: DataFrame) -> DataFrame:
    return with_asp(_category_monthly(lines))


def v_city_performance(lines: DataFrame) -> DataFrame:
    """After summing per customer each row is a customer, so counting rows counts customers."""
    by_city = resum(per_key(lines, "customer_sk", CITY), ["city"], F.count("*").alias("unique_customers"))
    return with_asp(by_city).select("city", "sales", "qty", "asp", "unique_customers")


def v_city_category_monthly(lines: DataFrame) -> DataFrame:
    """Categories are joined first and summed away per customer and month before the cities are joined."""
    categories = label_table(lines, "product_sk", PRODUCT).select("product_sk", "category_name")
    cities = label_table(lines, "customer_sk", CITY)
    products = rollup(lines, ["order_ym", "customer_sk", "product_sk"])
    customers = resum(join_lines(products, categories, "product_sk"), ["order_ym", "customer_sk", "category_name"])
    return resum(join_lines(customers, cities, "customer_sk"), ["order_ym", "city", "category_name"])


def v_price_bucket_distribution(lines: DataFrame) -> DataFrame:
    """Needs ``price_bucket`` on the lines (``enrich.with_price_bucket`` or ``master_sales_ext``)."""
    buckets = rollup(lines, ["price_bucket"], F.count("*").alias("line_count"))
    return with_asp(buckets).select("price_bucket", "line_count", "sales", "qty", "asp")


def v_customer_activity(lines: DataFrame) -> DataFrame:
    months = rollup(
        lines,
        ["customer_sk", "order_ym"],
        F.min("order_date").alias("first_purchase"),
        F.max("order_date").alias("last_purchase"),
        F.count("*").alias("line_count"),
    )
    customers = resum(
        months,
        ["customer_sk"],
        F.min("first_purchase").alias("first_purchase"),
        F.max("last_purchase").alias("last_purchase"),
        F.sum("line_count").alias("line_count"),
        F.count("*").alias("active_months"),
    )
    return with_asp(customers).select(
        "customer_sk", "first_purchase", "last_purchase", "line_count", "active_months", "qty", "sales", "asp"
    )


def v_aov_category_monthly(lines: DataFrame) -> DataFrame:
    categories = label_table(lines, "product_sk", PRODUCT).select("product_sk", "category_name")
    narrow = lines.select("order_ym", "customer_sk", "date_key", "product_sk", "total_sales")
    baskets = (
        join_lines(narrow, categories, "product_sk")
        .groupBy("order_ym", "category_name", "customer_sk", "date_key")
        .agg(F.sum("total_sales").alias("sales"))
    )
    monthly = baskets.groupBy("order_ym", "category_name").agg(
        F.sum("sales").alias("sales"), F.count("*").alias("orders_proxy")
    )
    return monthly.select("order_ym", "category_name", "sales", "orders_proxy", _aov())


def v_aov_city_monthly(lines: DataFrame) -> DataFrame:
    days = per_key_and(lines, ["order_ym", "date_key"], "customer_sk", CITY)
    baskets = days.groupBy("customer_sk", "order_ym", "date_key", "city").agg(F.sum("sales").alias("sales"))
    monthly = baskets.groupBy("order_ym", "city").agg(F.sum("sales").alias("sales"), F.count("*").alias("orders_proxy"))
    return monthly.select("order_ym", "city", "sales", "orders_proxy", _aov())


# ---- growth, over one row per month -------------------------------------------------------------------------

def _by_month():
    return W.orderBy("order_ym")


def _months(monthly: DataFrame, calendar: bool) -> DataFrame:
    """With ``calendar`` every month between the first and the last has a row, so that row offsets are month offsets."""
    if not calendar:
        return monthly
    start = C.month_start("order_ym")
    span = monthly.agg(F.min(start).alias("lo"), F.max(start).alias("hi"))
    return month_calendar(span).withColumnRenamed("ym", "order_ym").join(monthly, "order_ym", "left")


def _previous(c: str, offset: int) -> Column:
    return F.lag(c, offset).over(_by_month())


def moving_average(c: str, months: int = 3) -> Column:
    window = _by_month().rowsBetween(1 - months, 0)
    return C.safe_ratio(F.sum(c).over(window), F.count(c).over(window))


def first_month(c: str) -> Column:
    return F.first(c).over(_by_month().rowsBetween(W.unboundedPreceding, 0))


def v_sales_monthly_yoy(monthly: DataFrame, calendar: bool = False) -> DataFrame:
    """Against twelve rows earlier; a missing month shifts the comparison unless ``calendar`` fills it in."""
    return _months(monthly, calendar).select(
        "order_ym",
        "sales",
        "qty",
        "active_customers",
        "asp",
        _previous("sales", 12).alias("sales_last_year"),
        C.growth(F.col("sales"), _previous("sales", 12)).alias("sales_yoy_pct"),
        _previous("qty", 12).alias("qty_last_year"),
        C.growth(F.col("qty"), _previous("qty", 12)).alias("qty_yoy_pct"),
    )


def v_sales_monthly_mom(monthly: DataFrame, calendar: bool = False) -> DataFrame:
    return _months(monthly, calendar).select(
        "order_ym",
        "sales",
        "qty",
        _previous("sales", 1).alias("sales_prev_month"),
        C.growth(F.col("sales"), _previous("sales", 1)).alias("sales_mom_pct"),
        _previous("qty", 1).alias("qty_prev_month"),
        C.growth(F.col("qty"), _previous("qty", 1)).alias("qty_mom_pct"),
    )


def v_sales_monthly_index(monthly: DataFrame) -> DataFrame:
    return monthly.select("order_ym", "sales", C.safe_ratio(F.col("sales"), first_month("sales")).alias("sales_index"))


def v_sales_monthly_rolling3(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "order_ym", "sales", moving_average("sales").alias("sales_ma3"), "qty", moving_average("qty").alias("qty_ma3")
    )
