"""Customer and product behaviour: RFM segments, cohorts, trend, Pareto curve, lifetime value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.functions import columns as C
from tillwright.operators.metrics import PRODUCT, first_month, moving_average, per_key, v_sales_monthly
from tillwright.operators.scale import global_ntile, global_running

# Number of score classes, the Pareto cut and the assumed margin.
SCORES = 5
PARETO_CUT = 0.80
MARGIN_RATE = 0.30


def customer_days(lines: DataFrame) -> DataFrame:
    """Per customer: first and last purchase, days with a purchase, revenue."""
    days = lines.groupBy("customer_sk", "order_date").agg(F.sum("total_sales").alias("revenue"))
    return days.groupBy("customer_sk").agg(
        F.min("order_date").alias("first_purchase"),
        F.max("order_date").alias("last_purchase"),
        F.count("*").alias("orders_proxy"),
        F.sum("revenue").alias("revenue_total"),
    )


def rfm_segment() -> Column:
    """Fixed rules and labels, tested from top to bottom."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 4), "Loyal")
        .when((r >= 4) & (f <= 2) & (m <= 2), "New Customers")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r == 1) & (f <= 2), "Lost")
        .otherwise("Regulars")
    )


def view_rfm(lines: DataFrame) -> DataFrame:
    """Quintile scores over all customers, ties broken by the customer key.

    The three rankings are global. Each customer becomes three rows (measure, value), so that one sort over all tasks
    ranks all measures (``scale.global_ntile``), and the scores are folded back onto one row per customer. Recency is
    ranked by the negative day number of the last purchase, which needs no reference date. All measures have the type of
    the revenue, so that none is rounded.
    """
    days = customer_days(lines)
    number = days.schema["revenue_total"].dataType
    measures = days.select(
        "customer_sk",
        F.explode(
            F.array(
                F.struct(F.lit("r").alias("measure"), (-F.unix_date("last_purchase")).cast(number).alias("value")),
                F.struct(F.lit("f").alias("measure"), F.col("orders_proxy").cast(number).alias("value")),
                F.struct(F.lit("m").alias("measure"), F.col("revenue_total").cast(number).alias("value")),
            )
        ).alias("m"),
    ).select("customer_sk", "m.measure", "m.value")
    tiled = global_ntile(measures, SCORES, [F.asc("value"), F.asc("customer_sk")], "tile", by=["measure"])

    def of(measure: str, c: str) -> Column:
        return F.max(F.when(F.col("measure") == measure, F.col(c)))

    scored = tiled.groupBy("customer_sk").agg(
        of("r", "value").cast("bigint").alias("age"),
        of("f", "value").cast("bigint").alias("frequency_orders"),
        of("m", "value").alias("monetary_value"),
        (F.lit(SCORES + 1) - of("r", "tile")).alias("r_score"),
        of("f", "tile").alias("f_score"),
        of("m", "tile").alias("m_score"),
    )
    latest = tiled.filter(F.col("measure") == "r").agg(F.min("value").cast("bigint")).scalar()
    return scored.select(
        "customer_sk",
        (F.col("age") - latest).alias("recency_days"),
        "frequency_orders",
        "monetary_value",
        "r_score",
        "f_score",
        "m_score",
        rfm_segment().alias("rfm_segment"),
    )


def view_monthly_cohort(lines: DataFrame) -> DataFrame:
    """Active customers per first-purchase month and months since.

    One row per customer and month is all that is needed; the first month comes from a window over a customer's months,
    and the cohort size from the row at distance zero, so nothing is joined.
    """
    active = lines.select("customer_sk", "order_ym").distinct()
    placed = active.withColumn("cohort_ym", F.min("order_ym").over(W.partitionBy("customer_sk")))
    age = C.month_diff(C.month_start("order_ym"), C.month_start("cohort_ym"))
    months = placed.groupBy("cohort_ym", "order_ym").agg(F.count("*").alias("active_customers"))
    at_start = F.max(F.when(F.col("months_since_first") == 0, F.col("active_customers"))).over(W.partitionBy("cohort_ym"))
    sized = months.withColumn("months_since_first", age).withColumn("cohort_size", at_start)
    return sized.select(
        "cohort_ym",
        "months_since_first",
        "active_customers",
        "cohort_size",
        C.safe_ratio(F.col("active_customers"), F.col("cohort_size")).alias("retention_rate"),
    )


def view_sales_trend(lines: DataFrame) -> DataFrame:
    by_month = W.orderBy("order_ym")
    sales = F.col("sales")
    return v_sales_monthly(lines).select(
        "order_ym",
        "sales",
        "qty",
        "active_customers",
        "asp",
        C.growth(sales, F.lag("sales", 12).over(by_month)).alias("sales_yoy_pct"),
        C.growth(sales, F.lag("sales", 1).over(by_month)).alias("sales_mom_pct"),
        C.safe_ratio(sales, first_month("sales")).alias("sales_index"),
        moving_average("sales").alias("sales_ma3"),
    )


def view_pareto_products(lines: DataFrame) -> DataFrame:
    """Products by falling sales with their cumulative share; the product that crosses 80 % is left out of the mask."""
    products = per_key(lines, "product_sk", PRODUCT).drop("qty")
    ranked = global_running(
        products,
        [F.desc("sales"), F.asc("product_sk")],
        total_of="sales",
        total="sales_cum",
        grand_total="sales_all",
        dense_by="sales",
        dense="sales_rank",
    )
    cumulative = C.safe_ratio(F.col("sales_cum"), F.col("sales_all"))
    return ranked.select(
        "product_sk",
        "product_name",
        "category_name",
        "sales",
        "sales_rank",
        C.safe_ratio(F.col("sales"), F.col("sales_all")).alias("sales_share"),
        cumulative.alias("cumulative_share"),
        (cumulative <= PARETO_CUT).alias("is_top_80_percent"),
    )


def view_clv_simple(lines: DataFrame, margin_rate: float = MARGIN_RATE) -> DataFrame:
    revenue = F.col("revenue_total")
    return customer_days(lines).select(
        "customer_sk",
        "first_purchase",
        "last_purchase",
        C.month_diff("last_purchase", "first_purchase").alias("tenure_months"),
        "orders_proxy",
        C.safe_ratio(revenue, F.col("orders_proxy")).alias("aov_proxy"),
        "revenue_total",
        F.lit(float(margin_rate)).alias("margin_rate"),
        (revenue.cast("double") * float(margin_rate)).alias("clv_margin_estimate"),
    )
