"""Raw retail tables derived from the TPC-H-like test data.

The test data is clean, so fixed arithmetic on its keys adds the dirt (blanks, bad numbers, mixed date formats,
missing emails and dates, a month without orders, long fractions, repeated and orphan keys) that the cleansing layer exists for. All columns are text, as in a raw load.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tillwright.sources.files import read_parquet


class RawTables:
    """The four raw tables of a shop; give any four frames, or use ``from_test_data``."""

    def __init__(self, customers: DataFrame, orders: DataFrame, products: DataFrame, categories: DataFrame):
        self.customers, self.orders, self.products, self.categories = customers, orders, products, categories

    def named(self) -> dict[str, DataFrame]:
        return {
            "raw_customers": self.customers,
            "raw_orders": self.orders,
            "raw_products": self.products,
            "raw_product_category": self.categories,
        }


class TestDataTables(RawTables):
    """Raw tables on top of the parquet files in a folder; a table that is not used is not even planned."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._found: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        """A table of the folder; its schema is looked up once for this object, since every look-up is a job."""
        if name not in self._found:
            self._found[name] = read_parquet(self.spark, self.folder, name)
        return self._found[name]

    @cached_property
    def _category_ids(self) -> DataFrame:
        # The window runs over the distinct product types only, a handful of rows at any scale.
        types = self._read("part").select("p_type").distinct()
        return types.selectExpr("p_type", "CAST(dense_rank() OVER (ORDER BY p_type) AS string) AS category_id")

    @cached_property
    def categories(self) -> DataFrame:
        used = self._category_ids.selectExpr(
            "category_id AS CategoryID",
            "' ' || p_type || ' ' AS CategoryName",
            "lower(substring(p_type, 1, 2)) AS CategoryAbbreviation",
        )
        unused = self.spark.range(1).selectExpr(
            "'99' AS CategoryID", "'UNUSED' AS CategoryName", "'un' AS CategoryAbbreviation"
        )
        return used.unionByName(unused)

    @cached_property
    def products(self) -> DataFrame:
        return (
            self._read("part")
            .join(self._category_ids, "p_type")
            .selectExpr("*", "explode(sequence(0, CAST(p_partkey % 50 = 1 AS int))) AS copy")
            .selectExpr(
                "CASE WHEN p_partkey % 10 = 0 THEN ' P' || p_partkey || ' ' ELSE 'P' || p_partkey END AS ProdNumber",
                "p_name || ' ' || p_partkey AS ProdName",
                "CASE WHEN p_partkey % 97 = 5 THEN 'bad' ELSE category_id END AS Category",
                """CASE WHEN p_partkey % 101 = 7 THEN '0' WHEN p_partkey % 103 = 9 THEN 'n/a' WHEN p_partkey % 59 = 3 THEN '19.995'
                        WHEN p_partkey % 61 = 4 THEN CAST(CAST(p_size * 2.5 + 2.494567 AS decimal(12,6)) AS string)
                        ELSE CAST(CAST(p_size * 2.5 + 2.49 AS decimal(10,2)) AS string) END AS Price""",
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        return (
            self._read("customer")
            .join(self._read("nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
            .selectExpr(
                "CASE WHEN c_custkey % 53 = 11 THEN 'X' || c_custkey ELSE CAST(c_custkey AS string) END AS CustomerID",
                "'Customer' AS FirstName",
                "' ' || c_custkey || ' ' AS LastName",
                """CASE WHEN c_custkey % 37 = 5 THEN NULL WHEN c_custkey % 47 = 6 THEN ' c' || c_custkey || '@example.com'
                        WHEN c_custkey % 41 = 4 THEN 'bad-email-' || c_custkey
                        WHEN c_custkey % 3 = 0 THEN 'C' || c_custkey || '@Example.com#mailto:C' || c_custkey || '@Example.com#'
                        WHEN c_custkey % 3 = 1 THEN 'mailto:c' || c_custkey || '@example.com'
                        ELSE 'c' || c_custkey || '@example.com' END AS CustomerEmail""",
                "'+1 (555) ' || lpad(CAST(c_custkey AS string), 7, '0') AS CustomerPhone",
                "' Street ' || c_custkey AS CustomerAddress",
                """CASE WHEN c_custkey % 43 = 8 THEN '  ' WHEN c_custkey % 7 = 2 THEN n_name || ' '
                        ELSE n_name END AS CustomerCity""",
                "lower(c_mktsegment) AS CustomerState",
                "lpad(CAST(c_nationkey AS string), 5, '0') AS CustomerZip",
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        days = self._read("orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey", "CAST(o_orderdate AS date) AS day")
        return (
            self._read("lineitem")
            # Both sides grow with the data, so this join is never a broadcast one.
            .join(days.hint("merge"), "l_orderkey")
            .selectExpr(
                "CAST(l_orderkey AS string) AS OrderID",
                """CASE WHEN l_orderkey % 211 = 9 OR date_format(day, 'yyyy-MM') = '1997-02' THEN NULL
                        WHEN l_orderkey % 3 = 0 THEN date_format(day, 'yyyy-MM-dd')
                        WHEN l_orderkey % 3 = 2 AND day(day) > 12 THEN date_format(day, 'dd/MM/yyyy')
                        ELSE date_format(day, 'MM/dd/yyyy') END AS Date""",
                "CAST(o_custkey AS string) AS CustomerID",
                "CASE WHEN l_partkey % 307 = 3 THEN 'ZZ' ELSE 'P' END || l_partkey AS ProdNumber",
                """CASE WHEN (l_suppkey + l_linenumber) % 89 = 0 THEN '0'
                        WHEN (l_suppkey + l_linenumber) % 97 = 0 THEN 'x'
                        ELSE CAST(CAST(l_quantity AS bigint) AS string) END AS Quantity""",
            )
        )
