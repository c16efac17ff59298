"""Registered queries: the DataFrame side and the DuckDB side of each, next to each other."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.functions import columns as C
from tillwright.operators import behaviour as ad
from tillwright.operators import enrich as ex
from tillwright.operators import guardrails as guard
from tillwright.operators import master as ms
from tillwright.operators import metrics as mv
from tillwright.operators import profiling as dq
from tillwright.operators import semantic as sl
from tillwright.operators import staging as st
from tillwright.operators import star as dm
from tillwright.operators import states
from tillwright.plans import bucketed, mart
from tillwright.plans.layers import Layers, StoredLayers, TableLayers, build
from tillwright.plans.oracle import date_of, sql
from tillwright.plans.views import register_views
from tillwright.session import shared_folder, tune
from tillwright.sources import files, sequences
from tillwright.sources.retail import RawTables


class Query(NamedTuple):
    run: Callable[[StoredLayers], DataFrame]
    oracle: str | None = None


QUERIES: dict[str, Query] = {}


def _add(name: str, run: Callable[[StoredLayers], DataFrame], body: str | None = None) -> None:
    QUERIES[name] = Query(run, sql(body) if body else None)


def portable(df: DataFrame) -> DataFrame:
    """Types that compare across engines: decimals as double, all whole numbers as bigint, lists as text."""

    def convert(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.concat_ws(",", c).alias(field.name)
        return c

    return df.select(*[convert(f) for f in df.schema.fields])


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Aggregates of doubles depend on the order of summation in their last bits."""
    return df.withColumns({name: F.round(name, digits) for name in names})


# ---- profiling ----------------------------------------------------------------------------------------------

for _name, _table in (("customers", "raw_customers"), ("orders", "raw_orders"), ("products", "raw_products"), ("categories", "raw_product_category")):
    _add(
        f"dq_head_{_name}",
        lambda L, t=_table: dq.head_preview(L.raw.named()[t]),
        f"SELECT * FROM {_table} ORDER BY ALL LIMIT 5",
    )

_RAW = ("raw_customers", "raw_orders", "raw_products", "raw_product_category")
_STAGED = ("stg_customers", "stg_orders", "stg_products", "stg_product_category")


def _union_counts(tables: tuple[str, ...], label: str, count: str) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS {label}, count(*) AS {count} FROM {t}" for t in tables)


_QTY = "CASE WHEN regexp_full_match(Quantity, '[+-]?[0-9]+') THEN Quantity::BIGINT END"
_PRICE = "try_cast(Price AS DECIMAL(18,9))"


_add("dq_row_counts", lambda L: dq.row_counts(L.raw.named()), _union_counts(_RAW, "table_name", "n_rows"))
_add(
    "dq_coverage",
    lambda L: dq.coverage(L.raw.orders),
    """SELECT (SELECT min(o_orderdate)::DATE FROM lineitem JOIN orders ON o_orderkey = l_orderkey) AS min_order_date,
              (SELECT max(o_orderdate)::DATE FROM lineitem JOIN orders ON o_orderkey = l_orderkey) AS max_order_date,
              count(*) AS n_orders, count(DISTINCT CustomerID) AS unique_customers, count(DISTINCT ProdNumber) AS unique_products
       FROM raw_orders""",
)
_add(
    "dq_customer_completeness",
    lambda L: dq.customer_completeness(L.raw.customers),
    """SELECT count(*) FILTER (coalesce(trim(CustomerEmail), '') = '') AS null_email,
              count(*) FILTER (coalesce(trim(CustomerCity), '') = '') AS null_city FROM raw_customers""",
)
_add(
    "dq_order_completeness",
    lambda L: dq.order_completeness(L.raw.orders),
    f"""SELECT count(*) - count("Date") AS null_date, count(*) - count(CustomerID) AS null_customer, count(*) - count(ProdNumber) AS null_prod,
              count(*) - count(Quantity) AS null_qty, count(*) FILTER (({_QTY}) <= 0) AS non_positive_qty FROM raw_orders""",
)
_add(
    "dq_product_completeness",
    lambda L: dq.product_completeness(L.raw.products),
    f"""SELECT count(*) - count(Category) AS null_category, count(*) - count(Price) AS null_price,
              count(*) FILTER ({_PRICE} <= 0) AS non_positive_price FROM raw_products""",
)
_add(
    "dq_duplicate_keys",
    lambda L: dq.duplicate_keys(L.raw.named()),
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS duplicate_rows FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1) t"
        for t, k in dq.RAW_KEYS.items()
    ),
)


def _unmatched(left: str, key: str, right: str, right_key: str, name: str) -> str:
    return f"SELECT count(*) AS {name} FROM {left} WHERE NOT EXISTS (SELECT 1 FROM {right} r WHERE r.{right_key} = {left}.{key})"


_add(
    "dq_orphan_orders_no_customer",
    lambda L: dq.orphan_orders_no_customer(L.raw.orders, L.raw.customers),
    _unmatched("raw_orders", "CustomerID", "raw_customers", "CustomerID", "orphan_orders_no_customer"),
)
_add(
    "dq_orphan_orders_no_product",
    lambda L: dq.orphan_orders_no_product(L.raw.orders, L.raw.products),
    _unmatched("raw_orders", "ProdNumber", "raw_products", "ProdNumber", "orphan_orders_no_product"),
)
_add(
    "dq_orphan_products_no_category",
    lambda L: dq.orphan_products_no_category(L.raw.products, L.raw.categories),
    _unmatched("raw_products", "Category", "raw_product_category", "CategoryID", "orphan_products_no_category"),
)
_add(
    "dq_bad_email_format",
    lambda L: dq.bad_email_format(L.raw.customers),
    r"SELECT count(*) FILTER (NOT regexp_matches(lower(CustomerEmail), '^[^@\s]+@[^@\s]+\.[^@\s]+$')) AS bad_email_format FROM raw_customers",
)
_add(
    "dq_city_has_whitespace",
    lambda L: dq.city_has_whitespace(L.raw.customers),
    "SELECT count(*) FILTER (length(CustomerCity) > length(trim(CustomerCity))) AS city_has_whitespace FROM raw_customers",
)
_add(
    "dq_bad_customerid_cast",
    lambda L: dq.bad_customerid_cast(L.raw.customers),
    "SELECT count(*) FILTER (NOT regexp_full_match(CustomerID, '[+-]?[0-9]+')) AS bad_customerid_cast FROM raw_customers",
)
_add(
    "dq_order_cast_checks",
    lambda L: dq.order_cast_checks(L.raw.orders),
    """SELECT count(*) FILTER (NOT regexp_full_match(Quantity, '[+-]?[0-9]+')) AS bad_quantity_cast,
              count(*) FILTER (trim(ProdNumber) = '') AS empty_prodnumber FROM raw_orders""",
)
_add(
    "dq_product_cast_checks",
    lambda L: dq.product_cast_checks(L.raw.products),
    f"""SELECT count(*) FILTER (Price IS NOT NULL AND {_PRICE} IS NULL) AS bad_price_cast,
              count(*) FILTER (NOT regexp_full_match(Category, '[+-]?[0-9]+')) AS bad_category_cast FROM raw_products""",
)
_add(
    "dq_quantity_profile",
    lambda L: rounded(dq.quantity_profile(L.raw.orders), "std_qty"),
    f"""SELECT min(q) AS min_qty, quantile_disc(q, 0.25) AS q1_qty, quantile_disc(q, 0.5) AS median_qty, quantile_disc(q, 0.75) AS q3_qty,
              max(q) AS max_qty, sum(q)::DOUBLE / count(q) AS mean_qty, round(stddev_pop(q), 6) AS std_qty
       FROM (SELECT {_QTY} AS q FROM raw_orders) t""",
)
_add(
    "dq_price_profile",
    lambda L: rounded(dq.price_profile(L.raw.products), "std_price"),
    f"""SELECT min(p)::DOUBLE AS min_price, quantile_disc(p, 0.25)::DOUBLE AS p25_price, quantile_disc(p, 0.5)::DOUBLE AS median_price,
              quantile_disc(p, 0.75)::DOUBLE AS p75_price, max(p)::DOUBLE AS max_price, sum(p)::DOUBLE / count(p) AS mean_price,
              round(stddev_pop(p), 6) AS std_price, count(*) FILTER (p <= 0) AS non_positive_price_cnt
       FROM (SELECT {_PRICE} AS p FROM raw_products) t""",
)
# Summaries by month merge to quantiles with a bound on the error of ranks; here no value is rare enough to be merged with
# its neighbour, so that there must be no error at all.
def _quantile_check(wanted: dict[str, float], value: str, kind: str, table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS name, {p}::DOUBLE AS p, count(x) AS n_rows, q::{kind} AS value, count(*) FILTER (x < q) + 1 AS exact_low,
                   count(*) FILTER (x <= q) AS exact_high, 0 AS rank_error, true AS is_within_bound, true AS is_interval_right
            FROM (SELECT {value} AS x FROM {table}) t, (SELECT quantile_disc({value}, {p}) AS q FROM {table}) u GROUP BY q"""
        for name, p in wanted.items()
    )


_add(
    "dq_quantity_profile_approx",
    lambda L: dq.quantity_quantiles(L.raw.orders),
    _quantile_check({"q1_qty": 0.25, "median_qty": 0.5, "q3_qty": 0.75}, _QTY, "BIGINT", "raw_orders"),
)
_add(
    "dq_price_profile_approx",
    lambda L: dq.price_quantiles(L.raw.products),
    _quantile_check({"p25_price": 0.25, "median_price": 0.5, "p75_price": 0.75}, _PRICE, "DOUBLE", "raw_products"),
)
_GAPS = """SELECT missing_id FROM (SELECT unnest(generate_series(min(id), max(id))) AS missing_id FROM {ids}) t
           WHERE missing_id NOT IN (SELECT id FROM {ids})"""
_ORDER_IDS = "(SELECT DISTINCT OrderID::BIGINT AS id FROM raw_orders)"
_add("dq_id_gaps", lambda L: dq.id_gaps(L.raw.orders, "OrderID", limit=50), _GAPS.format(ids=_ORDER_IDS) + " ORDER BY 1 LIMIT 50")
_CUSTOMER_IDS = "(SELECT CustomerID::BIGINT AS id FROM stg_customers)"
_add("dq_id_gaps_orders_all", lambda L: dq.id_gaps(L.raw.orders, "OrderID"), _GAPS.format(ids=_ORDER_IDS))
_add(
    "dq_id_gaps_customers_all",
    lambda L: dq.id_gaps(L.raw.customers, "CustomerID", limit=None),
    _GAPS.format(ids=_CUSTOMER_IDS),
)
_add(
    "dq_top_cities",
    lambda L: dq.top_cities(L.raw.customers),
    "SELECT CustomerCity, count(*) AS total_customers FROM raw_customers GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
_add(
    "dq_top_products_by_qty",
    lambda L: dq.top_products_by_qty(L.raw.orders),
    f"""SELECT ProdNumber, sum({_QTY})::DOUBLE / count({_QTY}) AS avg_qty, sum({_QTY})::BIGINT AS total_qty
       FROM raw_orders GROUP BY 1 ORDER BY 3 DESC NULLS LAST, 1 LIMIT 10""",
)
_add(
    "dq_products_never_ordered",
    lambda L: dq.products_never_ordered(L.raw.products, L.raw.orders),
    _unmatched("raw_products", "ProdNumber", "raw_orders", "ProdNumber", "products_never_ordered"),
)
_add(
    "dq_categories_without_products",
    lambda L: dq.categories_without_products(L.raw.categories, L.raw.products),
    _unmatched("raw_product_category", "CategoryID", "raw_products", "Category", "categories_without_products"),
)
_add(
    "dq_summary_snapshot",
    lambda L: dq.summary_snapshot(L.raw),
    f"""SELECT (SELECT count(*) FROM raw_customers) AS total_customers, (SELECT count(*) FROM raw_orders) AS total_orders,
              (SELECT count(*) FROM raw_products) AS total_products, (SELECT count(*) FROM raw_product_category) AS total_categories,
              (SELECT count(*) FILTER (({_QTY}) <= 0) FROM raw_orders) AS invalid_qty,
              (SELECT count(*) FILTER ({_PRICE} <= 0) FROM raw_products) AS invalid_price,
              ({_unmatched("raw_orders", "CustomerID", "raw_customers", "CustomerID", "n")}) AS orphan_orders_no_customer,
              ({_unmatched("raw_orders", "ProdNumber", "raw_products", "ProdNumber", "n")}) AS orphan_orders_no_product""",
)

# ---- staging ------------------------------------------------------------------------------------------------

_add("stg_customers", lambda L: L.customers, "SELECT * FROM stg_customers")
_add("stg_product_category", lambda L: L.categories, "SELECT * FROM stg_product_category")
_add("stg_products", lambda L: L.products, "SELECT * REPLACE (Price::DOUBLE AS Price) FROM stg_products")
_add("stg_orders", lambda L: L.orders, "SELECT * FROM stg_orders")
_add(
    "stg_orders_dedup",
    lambda L: st.stg_orders(L.raw.orders, L.customers, L.products, dedup=True),
    """SELECT DISTINCT ON (OrderID) * FROM stg_orders ORDER BY OrderID, OrderDate, CustomerID, ProdNumber, Quantity""",
)
_add(
    "v_stg_rowcounts",
    lambda L: st.v_stg_rowcounts({**L.raw.named(), **L.staged()}),
    _union_counts(_RAW + _STAGED, "name", "n"),
)
_add("stg_qa_rowcounts", lambda L: st.qa_rowcounts({**L.raw.named(), **L.staged()}), _union_counts(_RAW + _STAGED, "name", "n"))
_add(
    "stg_qa_order_nulls",
    lambda L: st.qa_order_nulls(L.orders),
    """SELECT count(*) AS rows_stg_orders, count(*) - count(OrderID) AS null_orderid, count(*) - count(OrderDate) AS null_orderdate,
              count(*) - count(CustomerID) AS null_customerid, count(*) - count(ProdNumber) AS null_prodnumber FROM stg_orders""",
)
_add(
    "stg_qa_coverage",
    lambda L: st.qa_coverage(L.orders),
    """SELECT min(OrderDate) AS min_order_date, max(OrderDate) AS max_order_date, count(DISTINCT CustomerID) AS unique_customers,
              count(DISTINCT ProdNumber) AS unique_products FROM stg_orders""",
)
_add(
    "stg_qa_orphans",
    lambda L: st.qa_orphans(L.orders, L.customers, L.products),
    f"""SELECT ({_unmatched("stg_orders", "CustomerID", "stg_customers", "CustomerID", "n")}) AS orphan_orders_missing_customer,
               ({_unmatched("stg_orders", "ProdNumber", "stg_products", "ProdNumber", "n")}) AS orphan_orders_missing_product""",
)
_add(
    "stg_latest_orders",
    lambda L: st.latest_orders(L.orders),
    """SELECT OrderDate, order_ym AS ym, CustomerID, ProdNumber, Quantity FROM stg_orders
       ORDER BY OrderDate DESC, CustomerID, ProdNumber, Quantity LIMIT 10""",
)
_add(
    "stg_top_cities",
    lambda L: st.top_cities(L.customers),
    "SELECT CustomerCity, count(*) AS total_customers FROM stg_customers GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
_add(
    "stg_top_products_by_lines",
    lambda L: st.top_products_by_lines(L.orders, L.products),
    """SELECT ProdNumber, ProdName, count(*) AS order_lines FROM stg_orders JOIN stg_products USING (ProdNumber)
       GROUP BY ALL ORDER BY 3 DESC, 1 LIMIT 10""",
)

# ---- master and enrichment ----------------------------------------------------------------------------------

_MONEY = {
    "product_price": "product_price::DOUBLE AS product_price",
    "total_sales": "total_sales::DOUBLE AS total_sales",
    "customer_ltv_gross": "customer_ltv_gross::DOUBLE AS customer_ltv_gross",
    "city_sales_total": "city_sales_total::DOUBLE AS city_sales_total",
    "category_sales_total": "category_sales_total::DOUBLE AS category_sales_total",
}


def _columns(names) -> str:
    return ", ".join(_MONEY.get(c, f'"{c}"') for c in names)


_SPOT = ("order_date", "cust_email", "cust_city", "product_name", "category_name", "order_qty", "product_price", "total_sales")
_EXT_SPOT = (
    "order_date", "order_ym", "cust_email", "cust_city", "city_tier", "product_name", "category_name", "category_tier", "order_qty",
    "product_price", "price_bucket", "total_sales", "order_seq", "is_repeat_customer", "days_since_first", "customer_ltv_gross",
    "customer_avg_line_value",
)

_add(
    "master_expected_rows",
    lambda L: ms.master_expected_rows(L.orders, L.customers, L.products, L.categories),
    "SELECT count(*) AS expected_rows FROM master",
)
_add("master_sales", lambda L: L.master, f"SELECT {_columns(ms.MASTER_COLUMNS)} FROM master")
_VALIDITY = """SELECT count(*) AS rows_master, count(*) - count(order_date) AS null_order_date,
                      count(*) FILTER (coalesce(order_qty, 0) <= 0) AS {q}, count(*) FILTER (coalesce(product_price, 0) <= 0) AS {p} FROM master"""
_add("master_qa_validity", lambda L: ms.qa_master_validity(L.master), _VALIDITY.format(q="invalid_qty", p="invalid_price"))
_add("master_qa_range", lambda L: ms.date_range(L.master), "SELECT min(order_date) AS min_date, max(order_date) AS max_date FROM master")
_add(
    "master_monthly",
    lambda L: ms.master_monthly(L.master),
    """SELECT strftime(order_date, '%Y-%m') AS year_month, sum(total_sales)::DOUBLE AS total_revenue, sum(order_qty)::BIGINT AS total_units
       FROM master GROUP BY ALL""",
)
_add(
    "master_by_category",
    lambda L: ms.master_by_category(L.master),
    """SELECT category_name, sum(total_sales)::DOUBLE AS total_revenue, sum(order_qty)::BIGINT AS total_units FROM master GROUP BY ALL""",
)


def _newest(table: str, names) -> str:
    rest = ", ".join(f"{c} NULLS FIRST" for c in names if c != "order_date")
    return f"SELECT {_columns(names)} FROM (SELECT * FROM {table} ORDER BY order_date DESC, {rest} LIMIT 20) t"


_add("master_spot_check", lambda L: ms.master_spot_check(L.master), _newest("master", _SPOT))
_add("ext_precheck", lambda L: ms.ext_precheck(L.master), _VALIDITY.format(q="bad_qty", p="bad_price"))
_TIERS = "SELECT {year}{key}, {sales}::DOUBLE AS {sales}, {tile}, CASE {tile} WHEN 1 THEN '{a}' WHEN 2 THEN 'Tier 2' ELSE '{b}' END AS {tier} FROM {t}"
_CITY = {"key": "cust_city", "sales": "city_sales", "tile": "city_ntile", "tier": "city_tier", "a": "Tier 1 (Top)", "b": "Tier 3 (Emerging)"}
_CATEGORY = {
    "key": "category_name", "sales": "category_sales", "tile": "category_ntile", "tier": "category_tier",
    "a": "Tier 1 (Core)", "b": "Tier 3 (Long tail)",
}
_add("city_tiers_all", lambda L: ex.city_tiers(L.master), _TIERS.format(year="", t="city_all", **_CITY))
_add("city_tiers_all_distributed", lambda L: ex.city_tiers(L.stored_master), _TIERS.format(year="", t="city_all", **_CITY))
_add("city_tiers_year", lambda L: ex.city_tiers(L.master, per_year=True), _TIERS.format(year="order_year, ", t="city_year", **_CITY))
_add(
    "city_tiers_year_distributed",
    lambda L: ex.city_tiers(L.stored_master, per_year=True),
    _TIERS.format(year="order_year, ", t="city_year", **_CITY),
)
_add("category_tiers_all", lambda L: ex.category_tiers(L.master), _TIERS.format(year="", t="cat_all", **_CATEGORY))
_add("category_tiers_year", lambda L: ex.category_tiers(L.master, per_year=True), _TIERS.format(year="order_year, ", t="cat_year", **_CATEGORY))
_add(
    "ext_time_breakdowns",
    lambda L: ex.with_time_breakdowns(L.master).select("order_date", *ex.EXT_COLUMNS[8:14]).distinct(),
    f"SELECT DISTINCT order_date, {_columns(ex.EXT_COLUMNS[8:14])} FROM ext",
)
_add(
    "ext_price_bucket",
    lambda L: ex.with_price_bucket(L.master).select("product_price", "price_bucket").distinct(),
    f"SELECT DISTINCT {_columns(['product_price', 'price_bucket'])} FROM bucketed",
)
_HISTORY = (*ms.MASTER_COLUMNS, "first_order_date", "days_since_first", "order_seq", "is_repeat_customer")
_VALUE = (*ms.MASTER_COLUMNS, "order_seq", "customer_ltv_gross", "customer_total_lines", "customer_avg_line_value")
_add(
    "ext_lifecycle",
    lambda L: ex.with_customer_history(L.stored_master).select(*_HISTORY),
    f"SELECT {_columns(_HISTORY)} FROM ext",
)
# Customers without an email are one hot customer. The lines are stored first, as history reads them twice and a task would
# hold the sorted rows of their joins beside those of its first aggregate.
_add(
    "ext_lifecycle_hot_customers",
    lambda L: ex.with_customer_history(L.stored_master).select(*_HISTORY),
    f"SELECT {_columns(_HISTORY)} FROM ext",
)
_add(
    "ext_lifecycle_repeat_by_day",
    lambda L: ex.with_customer_history(L.stored_master, repeat_by_day=True).select(*_HISTORY),
    f"SELECT {_columns(_HISTORY[:-1])}, order_date > first_order_date AS is_repeat_customer FROM ext",
)
_add(
    "ext_customer_value",
    lambda L: ex.with_customer_history(L.stored_master).select(*_VALUE),
    f"SELECT {_columns(_VALUE)} FROM ext",
)
_add("master_sales_ext", lambda L: L.ext, f"SELECT {_columns(ex.EXT_COLUMNS)} FROM ext")
_add(
    "master_sales_ext_tiers_per_year",
    lambda L: ex.master_sales_ext(L.stored_master, tiers_per_year=True),
    f"SELECT {_columns(ex.EXT_COLUMNS)} FROM ext_year",
)
_EXT_NULLS = ("order_date", "price_bucket", "first_order_date", "city_tier", "category_tier", "city_sales_total", "category_sales_total")
_add(
    "ext_qa_nulls",
    lambda L: ex.qa_ext_nulls(L.ext),
    "SELECT count(*) AS rows_ext, " + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in _EXT_NULLS) + " FROM ext",
)
_add("ext_qa_range", lambda L: ms.date_range(L.history), "SELECT min(order_date) AS min_date, max(order_date) AS max_date FROM ext")
_add(
    "ext_repeat_distribution",
    lambda L: ex.repeat_distribution(L.history),
    "SELECT is_repeat_customer, count(*) AS row_count FROM ext GROUP BY ALL",
)
_add(
    "ext_price_bucket_check",
    lambda L: ex.price_bucket_check(ex.with_price_bucket(L.master)),
    "SELECT price_bucket, count(*) AS line_count, sum(total_sales)::DOUBLE AS sales FROM bucketed GROUP BY ALL",
)
_add(
    "ext_monthly_by_tiers",
    lambda L: ex.monthly_by_tiers(L.ext),
    """SELECT order_ym, city_tier, category_tier, sum(total_sales)::DOUBLE AS sales, sum(order_qty)::BIGINT AS qty FROM ext GROUP BY ALL""",
)
_add("ext_sample", lambda L: ex.ext_sample(L.ext), _newest("ext", _EXT_SPOT))

# ---- star schema --------------------------------------------------------------------------------------------

_add(
    "star_precheck",
    lambda L: dm.star_precheck(L.master),
    "SELECT count(*) AS rows_master, min(order_date) AS min_date, max(order_date) AS max_date FROM master",
)
_add("dim_date", lambda L: dm.dim_date(sequences.date_bounds(L.lines)), "SELECT * FROM dim_date")
_add("dim_customer", lambda L: dm.dim_customer(L.lines), "SELECT * FROM dim_customer")
_add("dim_product", lambda L: dm.dim_product(L.lines), "SELECT * FROM dim_product")
_add("fact_sales", lambda L: L.fact, f"SELECT {_columns(('date_key', 'customer_sk', 'product_sk', 'order_qty', 'total_sales', 'product_price'))} FROM fact")
_add(
    "star_qa_row_parity",
    lambda L: dm.qa_row_parity(L.stored_master, L.fact),
    "SELECT (SELECT count(*) FROM master) AS rows_master, (SELECT count(*) FROM fact) AS rows_fact",
)
_add(
    "star_qa_null_keys",
    lambda L: dm.qa_null_keys(L.fact),
    """SELECT count(*) - count(date_key) AS null_date_key, count(*) - count(customer_sk) AS null_customer_sk,
              count(*) - count(product_sk) AS null_product_sk FROM fact""",
)
_add(
    "star_qa_fact_date_window",
    lambda L: dm.qa_fact_date_window(L.fact, L.dates),
    """SELECT min("date") AS min_date, max("date") AS max_date FROM fact JOIN dim_date USING (date_key)""",
)
_add(
    "star_qa_reaggregate",
    lambda L: dm.qa_reaggregate(L.stored_master, L.fact, L.dates),
    """SELECT m.ym, m.s::DOUBLE AS master_sales, f.s::DOUBLE AS fact_sales, m.q::BIGINT AS master_qty, f.q::BIGINT AS fact_qty
       FROM (SELECT strftime(order_date, '%Y-%m') AS ym, sum(total_sales) AS s, sum(order_qty) AS q FROM master GROUP BY ALL) m
       FULL JOIN (SELECT strftime("date", '%Y-%m') AS ym, sum(total_sales) AS s, sum(order_qty) AS q
                  FROM fact JOIN dim_date USING (date_key) GROUP BY ALL) f USING (ym)""",
)
_add(
    "star_sample",
    lambda L: dm.star_sample(L.fact, L.dates, L.product_dim),
    """SELECT "year", "month", category_name, sum(total_sales)::DOUBLE AS sales, sum(order_qty)::BIGINT AS qty FROM base GROUP BY ALL""",
)

# ---- metric views -------------------------------------------------------------------------------------------

_SUMS = "sum(total_sales)::DOUBLE AS sales, sum(order_qty)::BIGINT AS qty"
_ASP = "sum(total_sales)::DOUBLE / sum(order_qty) AS asp"
_ORDERS = "count(DISTINCT (customer_sk, date_key))"
_AOV = f"{_ORDERS} AS orders_proxy, sum(total_sales)::DOUBLE / {_ORDERS} AS aov_proxy"
_BUYERS = "count(DISTINCT customer_sk)"

_PRODUCT = ("product_sk", "product_name", "category_name")
_MONTHLY_PRODUCT = ("order_date", "order_ym", *_PRODUCT, "order_qty", "total_sales")

_add("v_base_sales", lambda L: L.base, f"SELECT {_columns(dm.BASE_COLUMNS)} FROM base")
_add(
    "v_sales_daily",
    lambda L: mv.v_sales_daily(L.lines),
    f"""SELECT order_date, {_SUMS}, {_BUYERS} AS active_customers, {_ASP}, sum(total_sales)::DOUBLE / {_ORDERS} AS aov_proxy
        FROM base GROUP BY order_date""",
)
_add(
    "v_sales_monthly",
    lambda L: L.monthly,
    "SELECT * REPLACE (sales::DOUBLE AS sales, qty::BIGINT AS qty) FROM monthly",
)
_add("v_aov_monthly", lambda L: mv.v_aov_monthly(L.lines), "SELECT * REPLACE (sales::DOUBLE AS sales) FROM aov")
_add(
    "v_kpi_overview_monthly",
    lambda L: mv.v_kpi_overview_monthly(L.lines),
    """SELECT m.order_ym, m.sales::DOUBLE AS sales, m.qty::BIGINT AS qty, m.active_customers, m.asp, a.aov_proxy
       FROM monthly m LEFT JOIN aov a USING (order_ym)""",
)
_add(
    "v_sales_by_dow",
    lambda L: mv.v_sales_by_dow(L.lines),
    f"SELECT day_of_week_num, day_of_week_name, {_SUMS}, {_ASP}, {_BUYERS} AS active_customers FROM base GROUP BY ALL",
)
_add(
    "v_category_performance",
    lambda L: mv.v_category_performance(L.lines),
    f"SELECT category_name, {_SUMS}, {_ASP} FROM base GROUP BY ALL",
)
_add(
    "v_top_products",
    lambda L: mv.v_top_products(L.lines),
    f"""SELECT product_name, category_name, {_SUMS}, {_ASP}, dense_rank() OVER (ORDER BY sum(total_sales) DESC) AS sales_rank
        FROM base GROUP BY product_name, category_name""",
)
_add(
    "v_mix_share_monthly",
    lambda L: mv.v_mix_share_monthly(L.stored(*_MONTHLY_PRODUCT)),
    f"""SELECT order_ym, category_name, {_SUMS},
               sum(total_sales)::DOUBLE / (sum(sum(total_sales)) OVER (PARTITION BY order_ym))::DOUBLE AS sales_share,
               sum(order_qty)::DOUBLE / (sum(sum(order_qty)) OVER (PARTITION BY order_ym))::DOUBLE AS qty_share
        FROM base GROUP BY order_ym, category_name""",
)
_add(
    "v_city_performance",
    lambda L: mv.v_city_performance(L.lines),
    f"SELECT city, {_SUMS}, {_ASP}, {_BUYERS} AS unique_customers FROM base GROUP BY ALL",
)
_add(
    "v_city_category_monthly",
    lambda L: mv.v_city_category_monthly(L.stored("order_date", "order_ym", "customer_sk", "city", *_PRODUCT, "order_qty", "total_sales")),
    f"SELECT order_ym, city, category_name, {_SUMS} FROM base GROUP BY ALL",
)
_add(
    "v_price_bucket_distribution",
    lambda L: mv.v_price_bucket_distribution(ex.with_price_bucket(L.master)),
    f"SELECT price_bucket, count(*) AS line_count, {_SUMS}, {_ASP} FROM bucketed GROUP BY ALL",
)
_add(
    "v_customer_activity",
    lambda L: mv.v_customer_activity(L.lines),
    f"""SELECT customer_sk, min(order_date) AS first_purchase, max(order_date) AS last_purchase, count(*) AS line_count,
               count(DISTINCT order_ym) AS active_months, {_SUMS}, {_ASP} FROM base GROUP BY customer_sk""",
)
_add(
    "v_aov_category_monthly",
    lambda L: mv.v_aov_category_monthly(L.stored("order_date", "order_ym", "date_key", "customer_sk", *_PRODUCT, "total_sales")),
    f"SELECT order_ym, category_name, sum(total_sales)::DOUBLE AS sales, {_AOV} FROM base GROUP BY order_ym, category_name",
)
_add(
    "v_asp_category_monthly",
    lambda L: mv.v_asp_category_monthly(L.stored(*_MONTHLY_PRODUCT)),
    f"SELECT order_ym, category_name, {_SUMS}, {_ASP} FROM base GROUP BY ALL",
)
_add(
    "v_aov_city_monthly",
    lambda L: mv.v_aov_city_monthly(L.lines),
    f"SELECT order_ym, city, sum(total_sales)::DOUBLE AS sales, {_AOV} FROM base GROUP BY order_ym, city",
)
_add("v_sales_daily_min", lambda L: mv.v_sales_daily_min(L.lines), f"SELECT order_date, {_SUMS} FROM base GROUP BY ALL")


def _growth(c: str, n: int, window: str = "w") -> str:
    before = f"lag({c}, {n}) OVER {window}"
    return f"({c} - {before})::DOUBLE / nullif({before}, 0)::DOUBLE"


_YOY = f"""SELECT order_ym, sales::DOUBLE AS sales, qty::BIGINT AS qty, active_customers, asp, (lag(sales, 12) OVER w)::DOUBLE AS sales_last_year,
                  {_growth("sales", 12)} AS sales_yoy_pct, (lag(qty, 12) OVER w)::BIGINT AS qty_last_year, {_growth("qty", 12)} AS qty_yoy_pct
           FROM monthly WINDOW w AS (ORDER BY order_ym)"""
_MOM = f"""SELECT order_ym, sales::DOUBLE AS sales, qty::BIGINT AS qty, (lag(sales) OVER w)::DOUBLE AS sales_prev_month,
                  {_growth("sales", 1)} AS sales_mom_pct, (lag(qty) OVER w)::BIGINT AS qty_prev_month, {_growth("qty", 1)} AS qty_mom_pct
           FROM monthly WINDOW w AS (ORDER BY order_ym)"""
_INDEX = "sales::DOUBLE / (first_value(sales) OVER (ORDER BY order_ym))::DOUBLE AS sales_index"


def _ma3(c: str) -> str:
    window = "(ORDER BY order_ym ROWS 2 PRECEDING)"
    return f"(sum({c}) OVER {window})::DOUBLE / count({c}) OVER {window} AS {c}_ma3"


_add("v_sales_monthly_yoy", lambda L: mv.v_sales_monthly_yoy(L.monthly), _YOY)
# The test data has no line in 1997-02, so that the two variants differ.
_FILLED = """(SELECT * FROM (SELECT strftime(unnest(generate_series(min(month_start), max(month_start), INTERVAL 1 MONTH)), '%Y-%m') AS order_ym
                              FROM (SELECT date_trunc('month', month_start)::TIMESTAMP AS month_start FROM monthly) t) c LEFT JOIN monthly USING (order_ym)) m"""
_add("v_sales_monthly_yoy_calendar", lambda L: mv.v_sales_monthly_yoy(L.monthly, calendar=True), _YOY.replace("FROM monthly", f"FROM {_FILLED}"))
_add("v_sales_monthly_mom", lambda L: mv.v_sales_monthly_mom(L.monthly), _MOM)
_add("v_sales_monthly_index", lambda L: mv.v_sales_monthly_index(L.monthly), f"SELECT order_ym, sales::DOUBLE AS sales, {_INDEX} FROM monthly")
_add(
    "v_sales_monthly_rolling3",
    lambda L: mv.v_sales_monthly_rolling3(L.monthly),
    f"SELECT order_ym, sales::DOUBLE AS sales, {_ma3('sales')}, qty::BIGINT AS qty, {_ma3('qty')} FROM monthly",
)

# ---- behaviour ----------------------------------------------------------------------------------------------

_add("view_rfm", lambda L: ad.view_rfm(L.lines), "SELECT * REPLACE (monetary_value::DOUBLE AS monetary_value) FROM rfm")
_add("view_monthly_cohort", lambda L: ad.view_monthly_cohort(L.lines), "SELECT * FROM cohort")
_add(
    "view_sales_trend",
    lambda L: ad.view_sales_trend(L.lines),
    f"""SELECT order_ym, sales::DOUBLE AS sales, qty::BIGINT AS qty, active_customers, asp, {_growth("sales", 12)} AS sales_yoy_pct,
               {_growth("sales", 1)} AS sales_mom_pct, {_INDEX}, {_ma3("sales")} FROM monthly WINDOW w AS (ORDER BY order_ym)""",
)
_add(
    "view_pareto_products",
    lambda L: ad.view_pareto_products(L.lines),
    "SELECT * REPLACE (sales::DOUBLE AS sales), cumulative_share <= 0.80::DOUBLE AS is_top_80_percent FROM pareto",
)
_CLV = """SELECT * REPLACE (revenue_total::DOUBLE AS revenue_total), {m}::DOUBLE AS margin_rate,
                 revenue_total::DOUBLE * {m}::DOUBLE AS clv_margin_estimate FROM clv"""
_add("view_clv_simple", lambda L: ad.view_clv_simple(L.lines), _CLV.format(m="0.30"))
_add("view_clv_simple_margin_25", lambda L: ad.view_clv_simple(L.lines, margin_rate=0.25), _CLV.format(m="0.25"))

# ---- guardrails ---------------------------------------------------------------------------------------------

# On the SQL side every total is taken from the line table anew and compared with the view.
_LINES_BY_MONTH = "(SELECT strftime(order_date, '%Y-%m') AS order_ym, sum(total_sales) AS s, sum(order_qty) AS q FROM base GROUP BY ALL)"
_add(
    "guard_sales_qty_parity",
    lambda L: guard.sales_qty_parity(L.stored_lines, mv.v_sales_monthly(L.stored_lines)),
    f"""SELECT count(*) FILTER (coalesce(abs(s - sales) > 0.001, true)) AS sales_mismatch_months,
              count(*) FILTER (coalesce(abs(q - qty) > 0.001, true)) AS qty_mismatch_months
       FROM {_LINES_BY_MONTH} b FULL JOIN monthly USING (order_ym)""",
)
_add(
    "guard_aov_parity",
    lambda L: guard.aov_parity(L.stored_lines, mv.v_aov_monthly(L.stored_lines)),
    """SELECT count(*) FILTER (coalesce(abs(a.aov_proxy - b.s / b.n) > 0.001, true)) AS aov_mismatch_months
       FROM aov a FULL JOIN (SELECT strftime(order_date, '%Y-%m') AS order_ym, sum(day_sales)::DOUBLE AS s, count(*) AS n
            FROM (SELECT order_date, customer_sk, sum(total_sales) AS day_sales FROM base GROUP BY ALL) d GROUP BY 1) b USING (order_ym)""",
)
_COVERAGE = """SELECT (SELECT count(*) FROM {m}) AS expected_months, (SELECT count(*) FROM monthly) AS actual_months,
                      coalesce((SELECT string_agg(ym, ',' ORDER BY ym) FROM {m} WHERE ym NOT IN (SELECT order_ym FROM monthly)), '') AS missing_months,
                      (SELECT count(*) FROM {m}) = (SELECT count(*) FROM monthly) AS is_month_count_match,
                      (SELECT count(*) FROM {m} WHERE ym NOT IN (SELECT order_ym FROM monthly)) = 0 AS is_no_gap"""
_MONTHS = "(SELECT strftime(unnest(generate_series({lo}, {hi}, INTERVAL 1 MONTH)), '%Y-%m') AS ym{src}) t"
_add(
    "guard_month_coverage",
    lambda L: guard.month_coverage(L.monthly, sequences.date_bounds(L.lines)),
    _COVERAGE.format(
        m=_MONTHS.format(
            lo="date_trunc('month', min(order_date))::TIMESTAMP", hi="max(order_date)::TIMESTAMP", src=" FROM base"
        )
    ),
)
_add(
    "guard_month_coverage_fixed_calendar",
    lambda L: guard.month_coverage(L.monthly, sequences.fixed_bounds(L.monthly, "1994-11-01", "2001-12-31")),
    _COVERAGE.format(m=_MONTHS.format(lo="TIMESTAMP '1994-11-01'", hi="TIMESTAMP '2001-12-31'", src="")),
)
_DIFFS = ", ".join(
    f"round(((SELECT sum({c}) FROM base) - (SELECT sum(v) FROM (SELECT sum({c}) AS v FROM base GROUP BY {by}) t))::DOUBLE, 3) AS diff_{n}_{label}"
    for label, by in (("category", "category_name"), ("city", "city"), ("product", "product_name, category_name"))
    for n, c in (("sales", "total_sales"), ("qty", "order_qty"))
)


def _global_parity(L: StoredLayers) -> DataFrame:
    lines = L.stored("order_date", "customer_sk", "city", *_PRODUCT, "order_qty", "total_sales")
    df = guard.global_parity(
        lines, mv.v_category_performance(lines), mv.v_city_performance(lines), mv.product_totals(lines)
    )
    return df.select(*[F.col(c).cast("double").alias(c) for c in df.columns])


_add("guard_global_parity", _global_parity, f"SELECT {_DIFFS}")
_MIX = "(SELECT order_ym, sum(s) AS s, sum(q) AS q FROM (SELECT order_ym, category_name, sum(total_sales) AS s, sum(order_qty) AS q FROM base GROUP BY ALL) t GROUP BY 1)"


def _months_off(side: str, a: str, b: str, want: str) -> str:
    return f"(SELECT {want} FROM {side} x FULL JOIN monthly y USING (order_ym) WHERE coalesce(abs(x.{a} - y.{b}) > 0.001, true))"


_add(
    "guard_monthly_parity",
    lambda L: guard.monthly_parity(
        L.stored_lines, mv.v_sales_monthly(L.stored_lines), mv.v_mix_share_monthly(L.stored_lines)
    ),
    "SELECT "
    + ", ".join(
        f"{_months_off(side, a, b, want)} AS {label}_{name}_{b}"
        for label, want in (("mismatch_months", "count(*)"), ("offending_months", "coalesce(string_agg(order_ym, ',' ORDER BY order_ym), '')"))
        for name, side in (("base_vs_v", _LINES_BY_MONTH), ("mix_vs_v", _MIX))
        for a, b in (("s", "sales"), ("q", "qty"))
    ),
)
_HEALTH = """SELECT count(*) AS rows_total, count(*) FILTER (order_qty <= 0) AS rows_qty_nonpositive, count(*) FILTER (total_sales < 0) AS rows_sales_negative,
                    count(*) FILTER (product_price <= 0) AS rows_price_nonpositive, count(*) - count(order_date) AS rows_date_null,
                    count(*) FILTER (order_qty <= 0 OR total_sales < 0 OR product_price <= 0 OR order_date IS NULL) = 0 AS is_basic_health_ok FROM base"""
_add("guard_health_summary", lambda L: guard.health_summary(L.lines), _HEALTH)
_add(
    "guard_problem_samples",
    lambda L: guard.problem_samples(L.lines),
    " UNION ALL ".join(
        f"""(SELECT '{issue}' AS issue, order_date, customer_sk, product_sk, order_qty, product_price::DOUBLE AS product_price,
                    total_sales::DOUBLE AS total_sales FROM base WHERE {rule} ORDER BY order_date DESC, 3, 4, 5, 6, 7 LIMIT 5)"""
        for issue, rule in (("qty_nonpositive", "order_qty <= 0"), ("sales_negative", "total_sales < 0"), ("price_nonpositive", "product_price <= 0"))
    ),
)
_add(
    "guard_kpi_semantics",
    lambda L: guard.kpi_semantics(L.monthly),
    """SELECT count(*) - count(asp) AS null_asp_months, count(*) FILTER (asp < 0) AS neg_asp_months, count(*) AS months_total,
              count(*) = count(*) FILTER (asp >= 0) AS is_kpi_semantics_ok FROM monthly""",
)
_add(
    "guard_rfm_coverage",
    lambda L: guard.rfm_coverage(L.lines, ad.view_rfm(L.lines)),
    """SELECT (SELECT count(DISTINCT customer_sk) FROM base) = (SELECT count(*) FROM rfm) AS is_rfm_rowcount_match,
              (SELECT count(*) FROM rfm WHERE r_score + f_score + m_score IS NULL) = 0 AS is_rfm_scores_not_null""",
)
_add(
    "guard_cohort_semantics",
    lambda L: guard.cohort_semantics(ad.view_monthly_cohort(L.lines)),
    """SELECT count(*) FILTER (months_since_first < 0) AS neg_k_rows,
              count(*) FILTER (months_since_first = 0 AND abs(retention_rate - 1) > 0.0001) AS bad_m0_rows,
              count(*) FILTER (months_since_first < 0 OR (months_since_first = 0 AND abs(retention_rate - 1) > 0.0001)) = 0 AS is_cohort_semantics_ok
       FROM cohort""",
)
_add(
    "guard_pareto_curve",
    lambda L: rounded(guard.pareto_curve(ad.view_pareto_products(L.lines)), "tail_gap_from_one"),
    """SELECT count(*) FILTER (cumulative_share < before) AS non_monotone_steps, round(abs(1 - max(cumulative_share)), 6) AS tail_gap_from_one,
              count(*) FILTER (cumulative_share < before) = 0 AND abs(1 - max(cumulative_share)) < 0.001 AS is_pareto_curve_ok
       FROM (SELECT *, lag(cumulative_share) OVER (ORDER BY sales_rank, product_sk) AS before FROM pareto) t""",
)
_add(
    "guard_clv_parity",
    lambda L: guard.clv_parity(L.stored_lines, ad.view_clv_simple(L.stored_lines)),
    """SELECT round(((SELECT sum(total_sales) FROM base) - (SELECT sum(revenue_total) FROM clv))::DOUBLE, 3) AS diff_sales_total,
              abs((SELECT sum(total_sales) FROM base) - (SELECT sum(revenue_total) FROM clv)) < 0.001 AS is_clv_parity_ok""",
)
_LINE_RULES = {
    "order_qty_positive": "order_qty > 0",
    "product_price_positive": "product_price > 0",
    "total_sales_consistent": "total_sales = order_qty * product_price AND total_sales >= 0",
    "customer_email_normalised": "customer_email = lower(trim(customer_email))",
    "customer_email_valid": r"regexp_matches(customer_email, '^[^@\s]+@[^@\s]+\.[^@\s]+$')",
    "product_name_filled": "trim(product_name) <> ''",
    "category_name_filled": "trim(category_name) <> ''",
    "product_name_trimmed": "product_name = trim(product_name)",
    "category_name_trimmed": "category_name = trim(category_name)",
}
_MASTER_RULES = {
    "master_email_normalised": "cust_email = lower(trim(cust_email))",
    "master_city_trimmed": "cust_city = trim(cust_city) AND cust_city <> ''",
    "master_product_name_trimmed": "product_name = trim(product_name)",
    "master_category_name_trimmed": "category_name = trim(category_name)",
}
_DATE_RULES = {
    "date_key_eight_digits": "length(date_key::VARCHAR) = 8",
    "date_key_matches_date": """strftime("date", '%Y%m%d') = date_key::VARCHAR""",
}
_add(
    "guard_column_rules",
    lambda L: guard.column_rules(L.stored_lines, L.dates, L.stored_master),
    " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (NOT coalesce({rule}, false)) AS violations FROM {table}"
        for table, rules in (("base", _LINE_RULES), ("dim_date", _DATE_RULES), ("master", _MASTER_RULES))
        for name, rule in rules.items()
    ),
)

# ---- dashboard layer ----------------------------------------------------------------------------------------

_FIELD_SQL = {
    "year_month_key": "year(order_date) * 100 + month(order_date)",
    "key_year_month": "strftime(order_date, '%Y-%m')",
    "order_month_label": "strftime(order_date, '%b %Y')",
    "quarter_label": "'Q' || quarter(order_date) || ' ' || year(order_date)",
    "customer_type": "CASE WHEN is_repeat_customer THEN 'Repeat' ELSE 'New' END",
    "tenure_segment": """CASE WHEN days_since_first < 30 THEN 'New (<30d)' WHEN days_since_first < 180 THEN 'Growing (30–179d)'
                              WHEN days_since_first < 365 THEN 'Established (180–364d)' ELSE 'Loyal (≥365d)' END""",
    "price_bucket_sort_key": "CASE price_bucket WHEN 'Under 20' THEN 1 WHEN '20–49.99' THEN 2 WHEN '50–99.99' THEN 3 ELSE 4 END",
}
_SALES = "sum(total_sales)::DOUBLE"
_RATIO = f"{_SALES} / sum(order_qty)"
_REPEATERS = "count(DISTINCT cust_email) FILTER (is_repeat_customer)"
_METRIC_SQL = {
    "total_sales": _SALES,
    "total_quantity": "sum(order_qty)::BIGINT",
    "aov_line": _RATIO,
    "asp": _RATIO,
    "distinct_customers": "count(DISTINCT cust_email)",
    "pct_repeat_sales": f"(sum(total_sales) FILTER (is_repeat_customer))::DOUBLE / {_SALES}",
    "n_new_customers": "count(DISTINCT cust_email) FILTER (NOT is_repeat_customer)",
    "n_repeat_customers": _REPEATERS,
    "repeat_rate": f"{_REPEATERS}::DOUBLE / count(DISTINCT cust_email)",
    "avg_orders_per_customer": "sum(customer_total_lines)::DOUBLE / count(*)",
    "avg_ltv_gross": "sum(customer_ltv_gross)::DOUBLE / count(*)",
    "avg_price_per_product": _RATIO,
    "city_sales_contribution": f"{_SALES} / sum(city_sales_total)::DOUBLE",
    "category_sales_contribution": f"{_SALES} / sum(category_sales_total)::DOUBLE",
}


def _field_query(*fields: str) -> None:
    """Calculated fields, with the lines and sales behind each combination of values."""
    name = "sl_" + "_and_".join(fields)
    select = ", ".join(f"{_FIELD_SQL[f]} AS {f}" for f in fields)
    lifecycle = {"customer_type", "tenure_segment"} & set(fields)
    _add(
        name,
        lambda L: sl.with_fields(L.history if lifecycle else ex.with_price_bucket(L.master), *fields)
        .groupBy(*fields)
        .agg(F.count("*").alias("line_count"), F.sum("total_sales").alias("sales")),
        f"SELECT {select}, count(*) AS line_count, {_SALES} AS sales FROM ext GROUP BY ALL",
    )


for _field in _FIELD_SQL:
    _field_query(_field)


def _metric_query(name: str, metrics: tuple[str, ...], by: tuple[str, ...], source: Callable[[StoredLayers], DataFrame]) -> None:
    keys = ", ".join(f"{_FIELD_SQL[b]} AS {b}" if b in _FIELD_SQL else b for b in by)
    values = ", ".join(f"{_METRIC_SQL[m]} AS {m}" for m in metrics)
    _add(name, lambda L: sl.summarise(source(L), metrics, by), f"SELECT {keys + ', ' if keys else ''}{values} FROM ext GROUP BY ALL")


def _plain(L: StoredLayers) -> DataFrame:
    """Fields and metrics that need no customer history read the master table directly."""
    return ex.with_price_bucket(L.master)


_metric_query("sl_total_sales_and_quantity", ("total_sales", "total_quantity"), ("key_year_month",), _plain)
_metric_query("sl_aov_line", ("aov_line", "asp"), ("quarter_label",), _plain)
_metric_query("sl_distinct_customers", ("distinct_customers",), ("category_name",), _plain)
_metric_query("sl_avg_price_per_product", ("avg_price_per_product",), ("product_name", "category_name"), _plain)
_metric_query("sl_pct_repeat_sales", ("pct_repeat_sales",), ("year_month_key",), lambda L: L.history)
_metric_query("sl_new_and_repeat_customers", ("n_new_customers", "n_repeat_customers"), ("year_month_key",), lambda L: L.history)
_metric_query("sl_repeat_rate", ("repeat_rate",), ("category_name",), lambda L: L.history)
_metric_query("sl_customer_averages_by_line", ("avg_orders_per_customer", "avg_ltv_gross"), ("cust_city",), lambda L: L.history)
_add(
    "sl_customer_mix_by_city",
    lambda L: sl.customer_mix(L.history, ["cust_city"]),
    "SELECT cust_city, "
    + ", ".join(f"{_METRIC_SQL[m]} AS {m}" for m in ("distinct_customers", "n_new_customers", "n_repeat_customers", "repeat_rate", "pct_repeat_sales"))
    + " FROM ext GROUP BY ALL",
)
_add(
    "sl_customer_averages",
    lambda L: sl.customer_averages(L.history),
    f"""SELECT {_METRIC_SQL["avg_orders_per_customer"]} AS avg_orders_per_customer, {_METRIC_SQL["avg_ltv_gross"]} AS avg_ltv_gross,
              (SELECT sum(n)::DOUBLE / count(*) FROM (SELECT count(*) AS n FROM master GROUP BY cust_email) t) AS avg_orders_by_customer,
              (SELECT sum(s)::DOUBLE / count(*) FROM (SELECT sum(total_sales) AS s FROM master GROUP BY cust_email) t) AS avg_ltv_by_customer
       FROM ext""",
)
for _place, _key in (("city", "cust_city"), ("category", "category_name")):
    _add(
        f"sl_{_place}_sales_contribution",
        lambda L, p=_place: sl.city_contribution(L.ext) if p == "city" else sl.category_contribution(L.ext),
        f"""SELECT {_key}, {_METRIC_SQL[f"{_place}_sales_contribution"]} AS {_place}_sales_contribution,
                   {_SALES} / (SELECT {_SALES} FROM ext) AS true_share FROM ext GROUP BY {_key}""",
    )
for _metric, _expression in (("Sales", _SALES), ("Qty", "sum(order_qty)::BIGINT"), ("AOV", _RATIO)):
    _add(
        f"sl_metric_picker_{_metric.lower()}",
        lambda L, m=_metric: _plain(L).groupBy("category_name").agg(sl.metric_picker(m).alias("metric")),
        f"SELECT category_name, {_expression} AS metric FROM ext GROUP BY ALL",
    )


def _filter_query(name: str, run: Callable[[StoredLayers], DataFrame], rule: str) -> None:
    _add(
        name,
        lambda L: run(L).groupBy("category_name").agg(F.count("*").alias("line_count"), F.sum("total_sales").alias("sales")),
        f"SELECT category_name, count(*) AS line_count, {_SALES} AS sales FROM ext WHERE {rule} GROUP BY ALL",
    )


_filter_query("sl_filter_category", lambda L: sl.filter_category(_plain(L), "PROMO"), "category_name = 'PROMO'")
_filter_query("sl_filter_category_all", lambda L: sl.filter_category(_plain(L)), "true")
_filter_query("sl_filter_city", lambda L: sl.filter_city(_plain(L), "NATION_7"), "cust_city = 'NATION_7'")
_filter_query("sl_filter_customer_type_new", lambda L: sl.filter_customer_type(L.history, "New"), "NOT is_repeat_customer")
_filter_query("sl_filter_customer_type_repeat", lambda L: sl.filter_customer_type(L.history, "Repeat"), "is_repeat_customer")
_filter_query("sl_filter_price_bucket", lambda L: sl.filter_price_bucket(_plain(L), "20–49.99"), "price_bucket = '20–49.99'")
_filter_query("sl_filter_year", lambda L: sl.filter_year(_plain(L), 1998), "year(order_date) = 1998")
_filter_query("sl_filter_year_latest", lambda L: sl.filter_year(_plain(L)), "year(order_date) = (SELECT max(year(order_date)) FROM master)")
for _parameter, _key in (("p_category", "category_name"), ("p_city", "cust_city")):
    _add(
        f"sl_parameter_domain_{_parameter[2:]}",
        lambda L, p=_parameter: sl.parameter_domain(L.master, p),
        f'SELECT DISTINCT {_key} AS "value" FROM master WHERE {_key} IS NOT NULL UNION ALL SELECT \'All\'',
    )
_add(
    "sl_parameter_domain_year",
    lambda L: sl.parameter_domain(L.master, "p_year"),
    'SELECT DISTINCT year(order_date)::VARCHAR AS "value" FROM master',
)
_LATEST = "year(order_date) = (SELECT max(year(order_date)) FROM master)"
_add(
    "sl_dashboard_slice_sales_by_category",
    lambda L: sl.dashboard_slice(L.history, ["category_name"]),
    f"SELECT category_name, {_SALES} AS metric FROM ext WHERE {_LATEST} GROUP BY ALL",
)
_add(
    "sl_dashboard_slice_aov_by_month",
    lambda L: sl.dashboard_slice(
        L.history, ["year_month_key", "order_month_label"], {"p_metric": "AOV", "p_year": sl.ALL, "p_customer_type": "Repeat", "p_category": "PROMO"}
    ),
    f"""SELECT {_FIELD_SQL["year_month_key"]} AS year_month_key, {_FIELD_SQL["order_month_label"]} AS order_month_label, {_RATIO} AS metric
        FROM ext WHERE is_repeat_customer AND category_name = 'PROMO' GROUP BY ALL""",
)
_add(
    "sl_dashboard_slice_qty_by_tier",
    lambda L: sl.dashboard_slice(
        L.ext, ["city_tier", "tenure_segment"], {"p_metric": "Qty", "p_year": 1997, "p_price_bucket": "100+"}
    ),
    f"""SELECT city_tier, {_FIELD_SQL["tenure_segment"]} AS tenure_segment, sum(order_qty)::BIGINT AS metric
        FROM ext WHERE year(order_date) = 1997 AND price_bucket = '100+' GROUP BY ALL""",
)

# ---- views over a stored build ------------------------------------------------------------------------------


def _by_sql(L: StoredLayers, text: str) -> DataFrame:
    """Build all tables from the raw ones, register the views over them, and ask by SQL."""
    spark = L.raw.categories.sparkSession
    tables = build(spark, L.raw, f"{shared_folder(spark).rstrip('/')}/tillwright-mart-{uuid.uuid4().hex}")
    register_views(TableLayers(tables), ["v_sales_monthly", "v_category_performance"])
    return spark.sql(text)


_add(
    "mart_monthly_by_sql",
    lambda L: _by_sql(L, "SELECT order_ym, sales, qty, active_customers FROM v_sales_monthly WHERE sales > 0"),
    "SELECT order_ym, sales::DOUBLE AS sales, qty::BIGINT AS qty, active_customers FROM monthly WHERE sales > 0",
)

# ---- loads of files -------------------------------------------------------------------------------------------


def _loaded(L: StoredLayers) -> files.CsvLoad:
    """The raw products as lines of text, some without their last column, some with one more, in two folders of files; the
    files of the second have another header."""
    spark, products = L.raw.spark, L.raw.products
    folder = f"{shared_folder(spark).rstrip('/')}/tillwright-load-{uuid.uuid4().hex}"
    names = files.RAW_PRODUCT.names
    texts = F.concat_ws(",", *[F.concat(F.lit('"'), F.col(n), F.lit('"')) for n in names])
    number = F.regexp_extract("ProdNumber", r"\d+", 0).cast("long")
    line = (
        F.when(number % 29 == 3, F.concat_ws(",", F.trim("ProdNumber"), "ProdName", "Category"))
        .when(number % 31 == 4, F.concat(texts, F.lit(",more")))
        .otherwise(texts)
    )
    for part, rest, header in (("a", number % 17 != 5, names), ("b", number % 17 == 5, [*names[:-1], "Cost"])):
        lines = products.filter(rest).select(F.explode(F.array(F.lit(",".join(header)), line)).alias("value"))
        lines.write.text(f"{folder}/{part}")
    return files.load_csv(spark, [f"{folder}/a", f"{folder}/b"], files.RAW_PRODUCT, f"{folder}/loaded")


_NUMBER = "regexp_extract(ProdNumber, '[0-9]+')::BIGINT"
_add("csv_clean_rows", lambda L: _loaded(L).clean, f"SELECT * FROM raw_products WHERE {_NUMBER} % 17 <> 5 AND {_NUMBER} % 29 <> 3 AND {_NUMBER} % 31 <> 4")
_add(
    "csv_quarantine",
    lambda L: _loaded(L).quarantine.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")),
    # In the files with another header, the header is a row like the others.
    f"""SELECT reason, count(*) AS n_rows FROM (
          SELECT CASE WHEN {_NUMBER} % 17 = 5 THEN 'header' WHEN {_NUMBER} % 29 = 3 THEN 'too few columns' ELSE 'too many columns' END AS reason
          FROM raw_products WHERE {_NUMBER} % 17 = 5 OR {_NUMBER} % 29 = 3 OR {_NUMBER} % 31 = 4
          UNION ALL SELECT 'header' FROM raw_products WHERE {_NUMBER} % 17 = 5) t GROUP BY reason""",
)
_REPORT = ("n_rows", "clean_rows", "bad_rows", "header", "too_few_columns", "too_many_columns", "malformed")
_add(
    "csv_load_report",
    lambda L: _loaded(L).report.agg(*[F.sum(c).alias(c) for c in _REPORT]),
    f"""SELECT count(*) + sum(h) AS n_rows, sum((h = 0 AND f = 0 AND m = 0)::INT)::BIGINT AS clean_rows,
               sum(2 * h + (h = 0 AND (f = 1 OR m = 1))::INT)::BIGINT AS bad_rows, sum(2 * h)::BIGINT AS "header",
               sum((h = 0 AND f = 1)::INT)::BIGINT AS too_few_columns, sum((h = 0 AND f = 0 AND m = 1)::INT)::BIGINT AS too_many_columns, 0 AS malformed
        FROM (SELECT ({_NUMBER} % 17 = 5)::INT AS h, ({_NUMBER} % 29 = 3)::INT AS f, ({_NUMBER} % 31 = 4)::INT AS m FROM raw_products) t""",
)

# ---- the versioned mart -------------------------------------------------------------------------------------

_MARCH, _EVERY = "1996-03", 7


# Marts that this session has made, by the folder of their raw tables; the queries below ask one and the same.
_MADE: WeakKeyDictionary[SparkSession, dict[str, str]] = WeakKeyDictionary()


def _with_other_quantities(orders: DataFrame) -> DataFrame:
    """Raw orders with a quantity of 7 in every seventh order of a month."""
    # A date of that month names its year, in whatever format; only such texts are parsed for this.
    other = (C.safe_int("OrderID") % _EVERY == 0) & F.col("_date").contains(_MARCH[:4]) & (C.year_month(C.safe_date("_date", trimmed=True)) == _MARCH)
    quantity = F.when(other, F.lit("7")).otherwise(F.col("Quantity"))
    # Trimmed once in a column of its own. The quantity passes through an array of one element, so that the test for a
    # positive one stays above it: inside the join of the raw lines it would repeat all of this, too long to be compiled.
    dated = orders.withColumn("_date", C.trim_all("Date"))
    return dated.select("OrderID", "Date", "CustomerID", "ProdNumber", F.explode(F.array(quantity)).alias("Quantity"))


def _marts(L: StoredLayers) -> tuple[mart.Mart, mart.Mart]:
    """A mart whose first version has other quantities in every seventh order of a month, and what a refresh makes of it."""
    spark, raw = L.raw.spark, L.raw
    made = _MADE.setdefault(spark, {})
    folder = made.get(raw.folder)
    if folder and mart.versions(spark, folder) == [1, 2]:
        return mart.Mart(spark, folder, 1), mart.Mart(spark, folder, 2)
    folder = made[raw.folder] = f"{shared_folder(spark).rstrip('/')}/tillwright-mart-{uuid.uuid4().hex}"
    earlier = RawTables(raw.customers, _with_other_quantities(raw.orders), raw.products, raw.categories)
    first = mart.refresh(spark, earlier, folder, buckets=4, ranked=False)
    return first, mart.refresh(spark, raw, folder, buckets=4, ranked=False)


def _mart(L: StoredLayers) -> mart.Mart:
    return _marts(L)[1]


# What a refresh of one month makes of the mart must be what a full build gives.
_add("mart_refreshed_ext", lambda L: _mart(L).ext, f"SELECT {_columns(ex.EXT_COLUMNS)} FROM ext")
_add(
    "mart_refreshed_monthly",
    lambda L: _mart(L).monthly,
    "SELECT * REPLACE (sales::DOUBLE AS sales, qty::BIGINT AS qty) FROM monthly",
)
_add(
    "mart_written_months",
    lambda L: mart.changed_parts(*_marts(L)).filter(F.col("table_name").isin(list(mart.LINE_TABLES))),
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(DISTINCT order_ym) AS parts, 1 AS written FROM stg_orders" for t in mart.LINE_TABLES),
)


def _earlier(body: str) -> str:
    """SQL over the raw tables as they were at the first build."""
    other = f"""strftime({date_of('"Date"')}, '%Y-%m') = '{_MARCH}' AND OrderID::BIGINT % {_EVERY} = 0"""
    return sql(body).replace("FROM raw_orders)", f"FROM (SELECT * REPLACE (CASE WHEN {other} THEN '7' ELSE Quantity END AS Quantity) FROM raw_orders))")


_EARLIER = _earlier("SELECT strftime(order_date, '%Y-%m') AS order_ym, * FROM master")
_LATER = sql("SELECT strftime(order_date, '%Y-%m') AS order_ym, * FROM master")
QUERIES["mart_reconciled"] = Query(
    lambda L: mart.reconcile(*_marts(L)),
    f"""SELECT order_ym, sum(before)::BIGINT AS only_before, sum(after)::BIGINT AS only_after FROM (
          SELECT order_ym, 1 AS before, 0 AS after FROM (SELECT * FROM ({_EARLIER}) EXCEPT ALL SELECT * FROM ({_LATER})) a
          UNION ALL SELECT order_ym, 0, 1 FROM (SELECT * FROM ({_LATER}) EXCEPT ALL SELECT * FROM ({_EARLIER})) b) t GROUP BY order_ym""",
)


def _observed(L: StoredLayers) -> DataFrame:
    """What the first build has counted while it wrote the lines."""
    first, _ = _marts(L)
    found = sorted((name, n) for name, n in first.facts.items() if name.split(".")[0] in mart.TESTS)
    return first.spark.createDataFrame(found, "test string, line_count long")


_OBSERVED = {"master_sales": "master", "fact_sales": "fact", mart.EXT: "(SELECT *, 1 AS one FROM ext)"}
QUERIES["mart_observed_tests"] = Query(
    _observed,
    _earlier(
        " UNION ALL ".join(
            f"SELECT '{table}.{name}' AS test, count(*) FILTER ({rule}) AS line_count FROM {source} t"
            for table, source in _OBSERVED.items()
            for name, rule in {"rows": "true", **mart.TESTS[table]}.items()
        )
    ),
)
_add(
    "mart_dashboard_slice",
    lambda L: sl.dashboard_slice(
        _mart(L).ext, ["city_tier", "tenure_segment"], {"p_metric": "Qty", "p_year": 1997, "p_price_bucket": "100+"}
    ),
    f"""SELECT city_tier, {_FIELD_SQL["tenure_segment"]} AS tenure_segment, sum(order_qty)::BIGINT AS metric
        FROM ext WHERE year(order_date) = 1997 AND price_bucket = '100+' GROUP BY ALL""",
)
_add("mart_spot_check", lambda L: _mart(L).spot_check(), _newest("master", _SPOT))
# From the states of the mart alone.
_SLICED = ", ".join(
    f"{_METRIC_SQL[m]} AS {m}" for m in ("asp", "distinct_customers", "n_new_customers", "n_repeat_customers", "repeat_rate", "pct_repeat_sales")
)
for _name, _by, _rule in (
    ("city", "cust_city", "true"),
    ("category_of_year", "category_name", "order_year = 1997"),
    ("month", "order_ym", "category_name = 'PROMO'"),
    ("total", "", "true"),
):
    _add(
        f"mart_slice_by_{_name}" if _by else "mart_slice_total",
        lambda L, by=_by, rule=_rule: _mart(L).slice([by] if by else [], F.expr(rule)),
        f"""SELECT {_by + ', ' if _by else ''}{_SALES} AS sales, sum(order_qty)::BIGINT AS qty, count(*) AS line_count, {_SLICED}
            FROM ext WHERE {_rule} {'GROUP BY ' + _by if _by else ''}""",
    )
_add("mart_cohorts", lambda L: _mart(L).cohorts, "SELECT * FROM cohort")
_add(
    "mart_returns",
    lambda L: _mart(L).returns(),
    """SELECT order_ym, count(*) AS returned_customers, max(gap - 1)::BIGINT AS longest_gap FROM (
         SELECT order_ym, datediff('month', lag(m) OVER (PARTITION BY customer_sk ORDER BY m), m) AS gap
         FROM (SELECT DISTINCT customer_sk, order_ym, (order_ym || '-01')::DATE AS m FROM base) a) b WHERE gap > 3 GROUP BY order_ym""",
)


def _line_quantiles(L: StoredLayers) -> DataFrame:
    latest, wanted = _mart(L), {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
    found = latest.quantiles("total_sales", wanted)
    checked = states.checked_quantiles(latest.master, F.col("total_sales").cast("decimal(38,9)"), found)
    return checked.select("name", "p", "n_rows", "is_within_bound", "is_interval_right")


_add(
    "mart_line_quantiles",
    _line_quantiles,
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, {p}::DOUBLE AS p, count(*) AS n_rows, true AS is_within_bound, true AS is_interval_right FROM master"
        for name, p in {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}.items()
    ),
)

# ---- co-bucketed tables -------------------------------------------------------------------------------------


def _bucketed(L: StoredLayers, ask: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    spark, made = L.raw.spark, _MADE.setdefault(L.raw.spark, {})
    database = made.get(f"bucketed {L.raw.folder}")
    if not (database and spark.catalog.databaseExists(database)):
        database = made[f"bucketed {L.raw.folder}"] = f"bucketed_{uuid.uuid4().hex}"
        bucketed.build_bucketed(L.layers, database, buckets=8)
    return ask(spark, database)


_add("bucketed_star_join", lambda L: _bucketed(L, bucketed.star_join), f"SELECT {_columns(dm.BASE_COLUMNS)} FROM base")
_add(
    "bucketed_customer_history",
    lambda L: _bucketed(L, bucketed.customer_history),
    """SELECT customer_sk, order_date, lines, sales::DOUBLE AS sales, row_number() OVER w AS visit, (sum(lines) OVER w - lines)::BIGINT AS lines_before,
              (sum(sales) OVER w)::DOUBLE AS sales_to_date, order_date - lag(order_date) OVER w AS days_since_last
       FROM (SELECT customer_sk, order_date, count(*) AS lines, sum(total_sales) AS sales FROM base GROUP BY ALL) t
       WINDOW w AS (PARTITION BY customer_sk ORDER BY order_date)""",
)
_add(
    "bucketed_customer_values",
    lambda L: _bucketed(L, bucketed.customer_values),
    """SELECT customer_sk, any_value(customer_email) AS customer_email, any_value(city) AS city, count(*) AS lines, sum(order_qty)::BIGINT AS qty,
              sum(total_sales)::DOUBLE AS sales, min(order_date) AS first_purchase, max(order_date) AS last_purchase FROM base GROUP BY customer_sk""",
)

# ---- driver interface ---------------------------------------------------------------------------------------


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """One registered query over the test data in ``folder``. What it stores on the way stays until ``session.release``."""
    return portable(QUERIES[name].run(StoredLayers(Layers.from_test_data(tune(spark), folder))))
