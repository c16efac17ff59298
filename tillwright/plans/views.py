"""The named views of the mart, over any layers: straight from raw tables, or over the tables of a finished build."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from tillwright.operators import behaviour, metrics, staging
from tillwright.plans.layers import TableLayers
from tillwright.sources import files

VIEWS: dict[str, Callable[[TableLayers], DataFrame]] = {
    "v_stg_rowcounts": lambda L: staging.v_stg_rowcounts(L.staged()),
    "v_stg_schema_catalog": lambda L: staging.v_stg_schema_catalog(L.customers.sparkSession, L.staged()),
    "v_base_sales": lambda L: L.lines,
    "v_sales_daily": lambda L: metrics.v_sales_daily(L.lines),
    "v_sales_daily_min": lambda L: metrics.v_sales_daily_min(L.lines),
    "v_sales_monthly": lambda L: L.monthly,
    "v_aov_monthly": lambda L: metrics.v_aov_monthly(L.lines),
    "v_kpi_overview_monthly": lambda L: metrics.v_kpi_overview_monthly(L.lines),
    "v_sales_by_dow": lambda L: metrics.v_sales_by_dow(L.lines),
    "v_category_performance": lambda L: metrics.v_category_performance(L.lines),
    "v_top_products": lambda L: metrics.v_top_products(L.lines),
    "v_mix_share_monthly": lambda L: metrics.v_mix_share_monthly(L.lines),
    "v_city_performance": lambda L: metrics.v_city_performance(L.lines),
    "v_city_category_monthly": lambda L: metrics.v_city_category_monthly(L.lines),
    "v_price_bucket_distribution": lambda L: metrics.v_price_bucket_distribution(L.ext),
    "v_customer_activity": lambda L: metrics.v_customer_activity(L.lines),
    "v_aov_category_monthly": lambda L: metrics.v_aov_category_monthly(L.lines),
    "v_asp_category_monthly": lambda L: metrics.v_asp_category_monthly(L.lines),
    "v_aov_city_monthly": lambda L: metrics.v_aov_city_monthly(L.lines),
    "v_sales_monthly_yoy": lambda L: metrics.v_sales_monthly_yoy(L.monthly),
    "v_sales_monthly_mom": lambda L: metrics.v_sales_monthly_mom(L.monthly),
    "v_sales_monthly_index": lambda L: metrics.v_sales_monthly_index(L.monthly),
    "v_sales_monthly_rolling3": lambda L: metrics.v_sales_monthly_rolling3(L.monthly),
    "view_rfm": lambda L: behaviour.view_rfm(L.lines),
    "view_monthly_cohort": lambda L: behaviour.view_monthly_cohort(L.lines),
    "view_sales_trend": lambda L: behaviour.view_sales_trend(L.lines),
    "view_pareto_products": lambda L: behaviour.view_pareto_products(L.lines),
    "view_clv_simple": lambda L: behaviour.view_clv_simple(L.lines),
}


def register_views(layers: TableLayers, names: Iterable[str] = tuple(VIEWS)) -> None:
    """Make the views readable by SQL under their names. The global rankings (``v_top_products``, ``view_rfm``,
    ``view_pareto_products``) store what they have sorted when they are registered; the others only hold a plan."""
    files.register_views({name: VIEWS[name](layers) for name in names})
