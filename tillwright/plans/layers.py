"""From raw tables to staging, master, enriched master and star schema.

``Layers`` wires the operators together: reading an attribute builds a plan, never a result, so one object can serve any
number of queries. ``StoredLayers`` adds what one query wants written down, because it reads it several times; its tables
go to the shared folder of the session and belong to that query alone. ``build`` writes every layer for good.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.functions.columns import PRICE_TYPE
from tillwright.operators import enrich, master, metrics, star, staging
from tillwright.session import materialise, temporary_tables
from tillwright.sources import files, retail
from tillwright.sources.sequences import date_bounds


# What the dimensions, the fact and the checks need from a line.
STAR_COLUMNS = (
    "date_key",
    "order_date",
    "order_ym",
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


class Layers:
    def __init__(self, raw: retail.RawTables, price_type: str = PRICE_TYPE):
        self.raw, self.price_type = raw, price_type

    @classmethod
    def from_test_data(cls, spark: SparkSession, folder: str) -> "Layers":
        return cls(retail.TestDataTables(spark, folder))

    # staging

    @cached_property
    def customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers)

    @cached_property
    def categories(self) -> DataFrame:
        return staging.stg_product_category(self.raw.categories)

    @cached_property
    def products(self) -> DataFrame:
        return staging.stg_products(self.raw.products, self.price_type)

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders, self.customers, self.products)

    def staged(self) -> dict[str, DataFrame]:
        return {
            "stg_customers": self.customers,
            "stg_orders": self.orders,
            "stg_products": self.products,
            "stg_product_category": self.categories,
        }

    # master; the inner joins make the foreign-key check of stg_orders redundant

    def _master(self, keys: bool) -> DataFrame:
        lines = staging.typed_orders(self.raw.orders)
        return master.master_sales(lines, self.customers, self.products, self.categories, keys=keys)

    @cached_property
    def master(self) -> DataFrame:
        return self._master(keys=False)

    # sales lines and metrics

    @cached_property
    def lines(self) -> DataFrame:
        return star.sales_lines(self._master(keys=True))

    @cached_property
    def monthly(self) -> DataFrame:
        return metrics.v_sales_monthly(self.lines)


class TableLayers(Layers):
    """The layers of a finished build: ``tables`` by name, as ``build`` returns them or read back later."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = tables
        self.customers, self.categories = tables["stg_customers"], tables["stg_product_category"]
        self.products, self.orders = tables["stg_products"], tables["stg_orders"]
        self.master, self.ext = tables["master_sales"], tables["master_sales_ext"]

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str) -> "TableLayers":
        return cls({name: spark.read.parquet(f"{folder.rstrip('/')}/{name}") for name in TABLES})

    @classmethod
    def from_database(cls, spark: SparkSession, database: str) -> "TableLayers":
        return cls({name: spark.table(f"{database}.{name}") for name in TABLES})

    @cached_property
    def lines(self) -> DataFrame:
        t = self.tables
        return star.v_base_sales(t["fact_sales"], t["dim_date"], t["dim_customer"], t["dim_product"])


class StoredLayers:
    """The plans of ``layers``, and the tables that one query stores on the way."""

    def __init__(self, layers: Layers):
        self.layers = layers

    def __getattr__(self, name: str):
        return getattr(self.layers, name)

    def stored(self, *columns: str) -> DataFrame:
        """The named columns of the sales lines, stored; for views that read the lines more than once."""
        return materialise(self.layers.lines.select(*columns), "lines")

    @cached_property
    def stored_master(self) -> DataFrame:
        return materialise(self.layers.master, "master")

    @cached_property
    def stored_lines(self) -> DataFrame:
        return self.stored(*STAR_COLUMNS)

    @cached_property
    def ext(self) -> DataFrame:
        return enrich.master_sales_ext(self.stored_master)

    @cached_property
    def history(self) -> DataFrame:
        """``ext`` without tiers, for queries that ask for none: finding them takes passes over all lines."""
        return enrich.with_line_columns(self.stored_master)

    @cached_property
    def dates(self) -> DataFrame:
        return star.dim_date(date_bounds(self.stored_lines))

    @cached_property
    def customer_dim(self) -> DataFrame:
        return star.dim_customer(self.stored_lines)

    @cached_property
    def product_dim(self) -> DataFrame:
        return star.dim_product(self.stored_lines)

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact_sales(self.stored_lines, self.dates, self.customer_dim, self.product_dim)

    @cached_property
    def base(self) -> DataFrame:
        # The inner joins drop what the fact would not have.
        lines = self.stored_lines.select("date_key", "customer_sk", "product_sk", "order_qty", "total_sales", "product_price")
        return star.v_base_sales(lines, self.dates, self.customer_dim, self.product_dim)


# The tables of a full build in dependency order. The line tables are stored by month: their month column, or the
# expression that gives one. Readers see the columns of the table only, and files of one month have narrow date ranges,
# so a date filter skips the other months either way.
TABLES: dict[str, str | None] = {
    "stg_customers": None,
    "stg_product_category": None,
    "stg_products": None,
    "stg_orders": "order_ym",
    "master_sales": "date_format(order_date, 'yyyy-MM')",
    "master_sales_ext": "order_ym",
    "dim_date": None,
    "dim_customer": None,
    "dim_product": None,
    "fact_sales": "date_key div 100",
}


def build(
    spark: SparkSession, raw: retail.RawTables, folder: str, tiers_per_year: bool = False, price_type: str = PRICE_TYPE
) -> dict[str, DataFrame]:
    """Write all ten tables under ``folder``, each from the stored tables before it, and return their readers.

    A full rebuild replaces what is there, one table after the other; see ``build_database`` for a switch at the end.
    """

    def store(name: str, df: DataFrame, partition_by: list[str]) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}"
        files.write_parquet(df, path, partition_by)
        return spark.read.schema(df.schema).parquet(path)

    return _build(spark, raw, store, tiers_per_year, price_type)


def build_database(
    spark: SparkSession, raw: retail.RawTables, database: str, tiers_per_year: bool = False, price_type: str = PRICE_TYPE
) -> str:
    """Write all ten tables as managed tables of a run of its own, and switch the views ``database.<name>`` to them when
    all are complete: readers see the last complete run, also if this one fails. Returns the name of the run, which ends
    the names of its tables; ``drop_runs`` removes those of other runs."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    run = uuid.uuid4().hex[:12]

    def store(name: str, df: DataFrame, partition_by: list[str]) -> DataFrame:
        files.write_table(df, f"{database}.{name}_{run}", partition_by)
        return spark.table(f"{database}.{name}_{run}")

    for name, table in _build(spark, raw, store, tiers_per_year, price_type).items():
        columns = ", ".join(f"`{c}`" for c in table.columns)
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {columns} FROM {database}.{name}_{run}")
    return run


def drop_runs(spark: SparkSession, database: str, keep: str) -> None:
    for table in spark.catalog.listTables(database):
        name, _, run = table.name.rpartition("_")
        if name in TABLES and run != keep and table.tableType == "MANAGED":
            spark.sql(f"DROP TABLE {database}.{table.name}")


def _build(
    spark: SparkSession, raw: retail.RawTables, store_as: Callable[[str, DataFrame, list[str]], DataFrame], tiers_per_year: bool, price_type: str
) -> dict[str, DataFrame]:
    stored: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        month = TABLES[name]
        laid_out = df if month is None or month in df.columns else df.withColumn("stored_month", F.expr(month))
        column = month if month in df.columns else "stored_month"
        stored[name] = store_as(name, laid_out, [column] if month else []).select(*df.columns)
        return stored[name]

    with temporary_tables(spark):
        customers = store("stg_customers", staging.stg_customers(raw.customers))
        categories = store("stg_product_category", staging.stg_product_category(raw.categories))
        products = store("stg_products", staging.stg_products(raw.products, price_type))
        orders = store("stg_orders", staging.stg_orders(raw.orders, customers, products))
        sales = store("master_sales", master.master_sales(orders, customers, products, categories))
        store("master_sales_ext", enrich.master_sales_ext(sales, tiers_per_year))
        lines = star.sales_lines(sales)
        dates = store("dim_date", star.dim_date(date_bounds(star.sold_dates(sales))))
        buyers = store("dim_customer", star.dim_customer(star.customer_lines(sales)))
        goods = store("dim_product", star.dim_product(star.product_lines(sales)))
        store("fact_sales", star.fact_sales(lines, dates, buyers, goods))
    return stored
