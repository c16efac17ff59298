"""Dashboard layer over the enriched line table: calculated fields, metrics, parameters and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions import columns as C
from tillwright.operators.enrich import PRICE_BUCKETS

ALL = "All"

# Tenure labels with the number of days below which each applies.
TENURE_SEGMENTS = (
    ("New (<30d)", 30),
    ("Growing (30–179d)", 180),
    ("Established (180–364d)", 365),
    ("Loyal (≥365d)", None),
)

# Allowed values of the parameters with a closed list.
METRICS = ("Sales", "Qty", "AOV")
CUSTOMER_TYPES = ("New", "Repeat")


# ---- calculated fields --------------------------------------------------------------------------------------


def year_month_key(d: Column | str = "order_date") -> Column:
    """Number to sort months by: 202103."""
    return C.year(d) * 100 + C.month(d)


def key_year_month(d: Column | str = "order_date") -> Column:
    return C.year_month(d)


def order_month_label(d: Column | str = "order_date") -> Column:
    """``Mar 2021``."""
    return F.date_format(C.col(d), "MMM yyyy")


def quarter_label(d: Column | str = "order_date") -> Column:
    """``Q1 2021``."""
    return F.concat(F.lit("Q"), C.quarter(d).cast("string"), F.lit(" "), C.year(d).cast("string"))


def customer_type() -> Column:
    return F.when(F.col("is_repeat_customer"), "Repeat").otherwise("New")


def tenure_segment() -> Column:
    days = F.col("days_since_first")
    label = F.when(days < TENURE_SEGMENTS[0][1], TENURE_SEGMENTS[0][0])
    for name, below in TENURE_SEGMENTS[1:-1]:
        label = label.when(days < below, name)
    return label.otherwise(TENURE_SEGMENTS[-1][0])


def price_bucket_sort_key() -> Column:
    position = F.lit(len(PRICE_BUCKETS))
    for i, name in enumerate(PRICE_BUCKETS[:-1], start=1):
        position = F.when(F.col("price_bucket") == name, i).otherwise(position)
    return position.cast("bigint")


def calculated_fields() -> dict[str, Column]:
    return {
        "year_month_key": year_month_key(),
        "key_year_month": key_year_month(),
        "order_month_label": order_month_label(),
        "quarter_label": quarter_label(),
        "customer_type": customer_type(),
        "tenure_segment": tenure_segment(),
        "price_bucket_sort_key": price_bucket_sort_key(),
    }


def with_fields(ext: DataFrame, *names: str) -> DataFrame:
    """The line table with the named calculated fields (all of them by default)."""
    fields = calculated_fields()
    return ext.withColumns({name: fields[name] for name in names or fields})


# ---- metrics: aggregate columns, to be used in agg() after any groupBy() ------------------------------------


def total_sales() -> Column:
    return F.sum("total_sales")


def total_quantity() -> Column:
    return F.sum("order_qty")


def aov_line() -> Column:
    """Sales per unit; the same formula serves as average selling price and as average price per product."""
    return C.safe_ratio(total_sales(), total_quantity())


asp = aov_line
avg_price_per_product = aov_line


def distinct_customers() -> Column:
    return F.count_distinct("cust_email")


def pct_repeat_sales() -> Column:
    return C.safe_ratio(F.sum(F.when(F.col("is_repeat_customer"), F.col("total_sales"))), total_sales())


def n_new_customers() -> Column:
    return F.count_distinct(F.when(~F.col("is_repeat_customer"), F.col("cust_email")))


def n_repeat_customers() -> Column:
    return F.count_distinct(F.when(F.col("is_repeat_customer"), F.col("cust_email")))


def repeat_rate() -> Column:
    return C.safe_ratio(n_repeat_customers(), distinct_customers())


def avg_orders_per_customer() -> Column:
    """Average over lines of the customer's number of lines: customers weigh in by their lines."""
    return C.safe_ratio(F.sum("customer_total_lines"), F.count("customer_total_lines"))


def avg_ltv_gross() -> Column:
    """Average over lines of the customer's lifetime value."""
    return C.safe_ratio(F.sum("customer_ltv_gross"), F.count("customer_ltv_gross"))


def city_sales_contribution() -> Column:
    """Sales over the sum of the city total repeated on every line."""
    return C.safe_ratio(total_sales(), F.sum("city_sales_total"))


def category_sales_contribution() -> Column:
    return C.safe_ratio(total_sales(), F.sum("category_sales_total"))


def metrics() -> dict[str, Column]:
    return {
        "total_sales": total_sales(),
        "total_quantity": total_quantity(),
        "aov_line": aov_line(),
        "asp": asp(),
        "distinct_customers": distinct_customers(),
        "pct_repeat_sales": pct_repeat_sales(),
        "n_new_customers": n_new_customers(),
        "n_repeat_customers": n_repeat_customers(),
        "repeat_rate": repeat_rate(),
        "avg_orders_per_customer": avg_orders_per_customer(),
        "avg_ltv_gross": avg_ltv_gross(),
        "avg_price_per_product": avg_price_per_product(),
        "city_sales_contribution": city_sales_contribution(),
        "category_sales_contribution": category_sales_contribution(),
    }


def summarise(ext: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Named metrics, grouped by columns or calculated fields. Several counts of customers go through ``customer_mix``."""
    if {"n_new_customers", "n_repeat_customers", "repeat_rate"}.intersection(names) and set(names) <= set(_REPEAT_METRICS):
        return customer_mix(ext, by).select(*by, *names)
    fields, chosen = calculated_fields(), metrics()
    keys = [fields[d].alias(d) if d in fields and d not in ext.columns else F.col(d) for d in by]
    return ext.groupBy(*keys).agg(*[chosen[name].alias(name) for name in names])


_REPEAT_METRICS = ("distinct_customers", "n_new_customers", "n_repeat_customers", "repeat_rate", "pct_repeat_sales")


def customer_mix(ext: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Customer counts and repeat shares. Lines are first reduced to one row per customer and group, which answers all
    the distinct counts at once instead of replicating every line per distinct count."""
    fields = calculated_fields()
    keys = [fields[d].alias(d) if d in fields and d not in ext.columns else F.col(d) for d in by]
    repeat = F.col("is_repeat_customer")
    customers = ext.groupBy(*keys, "cust_email").agg(
        F.sum("total_sales").alias("sales"),
        F.sum(F.when(repeat, F.col("total_sales"))).alias("repeat_sales"),
        F.max(repeat).alias("has_repeat"),
        F.max(~repeat).alias("has_new"),
    )
    known = F.col("cust_email").isNotNull()
    counts = customers.groupBy(*by).agg(
        F.count("cust_email").alias("distinct_customers"),
        F.count_if(known & F.col("has_new")).alias("n_new_customers"),
        F.count_if(known & F.col("has_repeat")).alias("n_repeat_customers"),
        F.sum("sales").alias("sales"),
        F.sum("repeat_sales").alias("repeat_sales"),
    )
    return counts.withColumns(
        {
            "repeat_rate": C.safe_ratio(F.col("n_repeat_customers"), F.col("distinct_customers")),
            "pct_repeat_sales": C.safe_ratio(F.col("repeat_sales"), F.col("sales")),
        }
    ).select(*by, *_REPEAT_METRICS)


def customer_averages(ext: DataFrame) -> DataFrame:
    """Averages over lines, as on the dashboard, and next to them the averages over customers."""
    customers = ext.groupBy("cust_email").agg(
        F.count("*").alias("lines"),
        F.max("customer_total_lines").alias("total_lines"),
        F.max("customer_ltv_gross").alias("ltv"),
        # Added up, not multiplied: a product of a count and an amount would lose decimals.
        F.sum("customer_ltv_gross").alias("ltv_of_lines"),
    )
    lines = F.sum("lines")
    return customers.agg(
        C.safe_ratio(F.sum(F.col("lines") * F.col("total_lines")), lines).alias("avg_orders_per_customer"),
        C.safe_ratio(F.sum("ltv_of_lines"), lines).alias("avg_ltv_gross"),
        C.safe_ratio(F.sum("total_lines"), F.count("*")).alias("avg_orders_by_customer"),
        C.safe_ratio(F.sum("ltv"), F.count("*")).alias("avg_ltv_by_customer"),
    )


def _contribution(ext: DataFrame, key: str, total: str, name: str) -> DataFrame:
    groups = ext.groupBy(key).agg(
        F.sum("total_sales").alias("sales"), F.sum(total).alias("repeated_total"), F.max(total).alias("key_total")
    )
    grand_total = ext.agg(F.sum("total_sales")).scalar()
    return groups.select(
        key,
        C.safe_ratio(F.col("sales"), F.col("repeated_total")).alias(name),
        C.safe_ratio(F.col("sales"), grand_total).alias("true_share"),
    )


def city_contribution(ext: DataFrame) -> DataFrame:
    """The dashboard's city contribution (its denominator repeats the city total per line) and the real share."""
    return _contribution(ext, "cust_city", "city_sales_total", "city_sales_contribution")


def category_contribution(ext: DataFrame) -> DataFrame:
    return _contribution(ext, "category_name", "category_sales_total", "category_sales_contribution")


# ---- parameters ---------------------------------------------------------------------------------------------


def metric_picker(p_metric: str = "Sales") -> Column:
    """The aggregate behind the metric selector."""
    choice = {"Sales": total_sales, "Qty": total_quantity, "AOV": aov_line}
    if p_metric not in choice:
        raise ValueError(f"p_metric must be one of {', '.join(METRICS)}")
    return choice[p_metric]()


def filter_category(df: DataFrame, p_category: str = ALL) -> DataFrame:
    return df if p_category == ALL else df.filter(F.col("category_name") == p_category)


def filter_city(df: DataFrame, p_city: str = ALL) -> DataFrame:
    return df if p_city == ALL else df.filter(F.col("cust_city") == p_city)


def filter_customer_type(df: DataFrame, p_customer_type: str = ALL) -> DataFrame:
    """``New`` and ``Repeat`` select lines by the repeat flag; an unknown value hides every line."""
    if p_customer_type == ALL:
        return df
    if p_customer_type not in CUSTOMER_TYPES:
        return df.filter(F.lit(False))
    return df.filter(F.col("is_repeat_customer") == (p_customer_type == "Repeat"))


def filter_price_bucket(df: DataFrame, p_price_bucket: str = ALL) -> DataFrame:
    return df if p_price_bucket == ALL else df.filter(F.col("price_bucket") == p_price_bucket)


def filter_dates(df: DataFrame, start: Column, end: Column | None = None) -> DataFrame:
    """Lines from ``start`` on and, if given, before ``end``, both first days of a month. The range is put on the date and,
    where there is one, on the month column: if the lines are stored by it, files of other months are not opened."""
    tests = [(F.col("order_date"), start, end)]
    if "order_ym" in df.columns:
        tests.append((F.col("order_ym"), C.year_month(start), None if end is None else C.year_month(end)))
    for value, low, high in tests:
        df = df.filter(value >= low) if high is None else df.filter((value >= low) & (value < high))
    return df


def filter_year(df: DataFrame, p_year: int | None = None) -> DataFrame:
    """Lines of one year, by default the latest; written as a range of dates and months so that it reaches the scan."""
    if p_year is not None:
        return filter_dates(df, F.lit(f"{p_year:04d}-01-01").cast("date"), F.lit(f"{p_year + 1:04d}-01-01").cast("date"))
    return filter_dates(df, df.agg(F.trunc(F.max("order_date"), "year")).scalar())


def parameter_domain(ext: DataFrame, parameter: str) -> DataFrame:
    """Values a parameter may take."""
    spark = ext.sparkSession
    closed = {"p_metric": METRICS, "p_customer_type": (ALL, *CUSTOMER_TYPES), "p_price_bucket": (*PRICE_BUCKETS, ALL)}
    if parameter in closed:
        return spark.createDataFrame([(v,) for v in closed[parameter]], "value string")
    if parameter == "p_year":
        return ext.select(C.year("order_date").cast("string").alias("value")).distinct()
    column = {"p_category": "category_name", "p_city": "cust_city"}[parameter]
    values = ext.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct()
    return values.unionByName(spark.range(1).select(F.lit(ALL).alias("value")))


def dashboard_slice(ext: DataFrame, by: Sequence[str], params: Mapping[str, object] | None = None) -> DataFrame:
    """The query behind a chart: all parameter filters, then the chosen metric per group as ``metric``.

    ``params`` may set ``p_category``, ``p_city``, ``p_customer_type``, ``p_price_bucket``, ``p_metric`` and ``p_year``;
    the defaults show everything of the latest year as sales. ``p_year=None`` means the latest year, ``"All"`` every year.
    """
    given = dict(params or {})
    year = given.pop("p_year", None)
    metric = metric_picker(given.pop("p_metric", "Sales"))
    filters = {
        "p_category": filter_category,
        "p_city": filter_city,
        "p_customer_type": filter_customer_type,
        "p_price_bucket": filter_price_bucket,
    }
    df = ext if year == ALL else filter_year(ext, year)
    for name, value in given.items():
        df = filters[name](df, value)
    fields = calculated_fields()
    keys = [fields[d].alias(d) if d in fields and d not in df.columns else F.col(d) for d in by]
    return df.groupBy(*keys).agg(metric.alias("metric"))
