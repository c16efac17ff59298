"""File and table readers, catalog metadata and writers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.functions import columns as C
from tillwright.operators.combine import join_lines


def strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Columns of the raw tables, all read as text.
RAW_CATEGORY = strings(["CategoryID", "CategoryName", "CategoryAbbreviation"])
RAW_PRODUCT = strings(["ProdNumber", "ProdName", "Category", "Price"])
RAW_CUSTOMER = strings(
    [
        "CustomerID",
        "FirstName",
        "LastName",
        "CustomerEmail",
        "CustomerPhone",
        "CustomerAddress",
        "CustomerCity",
        "CustomerState",
        "CustomerZip",
    ]
)
RAW_ORDER = strings(["OrderID", "Date", "CustomerID", "ProdNumber", "Quantity"])
# Why a row of a CSV file is set aside.
REASONS = ("header", "too few columns", "too many columns", "malformed")
EMPLOYEE = strings(["IDKaryawan", "NamaDepan", "NamaBelakang", "Jabatan", "Email", "HireDate", "Extension"])
JOB = strings(["Jabatan", "Department"])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """CSV with a header line; nothing is inferred, every column is the text in the file."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


class CsvLoad(NamedTuple):
    """``clean``: rows as in the schema; ``quarantine``: ``file``, ``reason``, ``record``; ``report``: row counts by file."""

    clean: DataFrame
    quarantine: DataFrame
    report: DataFrame


def load_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, folder: str, sep: str = ",") -> CsvLoad:
    """CSV with header lines, loaded into ``folder``; rows that do not fit are stored with the reason, not nulled.

    A row is set aside if it has too few or too many columns or is broken otherwise (an open quote), and all rows of a file
    without the expected header. A row that repeats the header is no data. Every file is parsed once, with all its columns,
    as the parser only counts the columns that it is asked for.
    """
    names = schema.names
    parsed = spark.read.schema(T.StructType([*schema.fields, T.StructField("_record", T.StringType())]))
    parsed = parsed.option("sep", sep).option("escape", "\"").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record").csv(path)
    is_header = reduce(lambda a, b: a & b, [F.trim(F.coalesce(F.col(n), F.lit(""))) == n for n in names]) & F.col("_record").isNull()
    parsed.select(*names, "_record", F.col("_metadata.file_path").alias("_file"), is_header.alias("_is_header")).write.parquet(f"{folder.rstrip('/')}/rows")
    rows = spark.read.parquet(f"{folder.rstrip('/')}/rows")
    headed = rows.groupBy("_file").agg(F.max("_is_header").alias("_headed"))
    rows = join_lines(rows.filter("NOT _is_header"), headed, "_file")
    quoted = F.regexp_replace("_record", '"([^"]|"")*"', "")
    columns = F.size(F.split(quoted, re.escape(sep)))
    reason = (
        F.when(~F.col("_headed"), "header")
        .when(F.col("_record").isNull(), F.lit(None).cast("string"))
        .when(columns < len(names), "too few columns")
        .when(columns > len(names), "too many columns")
        .otherwise("malformed")
    )
    record = F.coalesce("_record", F.concat_ws(sep, *[F.coalesce(F.col(n), F.lit("")) for n in names]))
    bad = rows.select(F.col("_file").alias("file"), reason.alias("reason"), record.alias("record")).filter("reason IS NOT NULL")
    bad.write.parquet(f"{folder.rstrip('/')}/quarantine")
    quarantine = spark.read.parquet(f"{folder.rstrip('/')}/quarantine")
    clean = rows.filter("_headed AND _record IS NULL").select(*names)
    counted = quarantine.groupBy("file").agg(
        F.count(F.lit(1)).alias("bad_rows"), *[F.count_if(F.col("reason") == r).alias(r.replace(" ", "_")) for r in REASONS]
    )
    total = rows.groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
    zero = F.lit(0).cast("long")
    report = total.join(counted, "file", "left").na.fill(0).withColumn("clean_rows", F.col("n_rows") - F.coalesce("bad_rows", zero))
    return CsvLoad(clean, quarantine, report)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Managed table by (qualified) name."""
    return spark.table(name)


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def clean_employees(raw: DataFrame) -> DataFrame:
    """Employee file with typed id, extension and hire date (day first) and clean email."""
    return raw.select(
        C.safe_int("IDKaryawan").alias("IDKaryawan"),
        C.trim_all("NamaDepan").alias("NamaDepan"),
        C.trim_all("NamaBelakang").alias("NamaBelakang"),
        C.trim_all("Jabatan").alias("Jabatan"),
        C.clean_email("Email").alias("Email"),
        C.safe_date("HireDate", ["%d/%m/%Y"]).alias("HireDate"),
        C.safe_int("Extension").alias("Extension"),
    )


def schema_snapshot(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of each table with type and nullability, from the schemas alone: no job reads any data."""
    rows = [
        (name, field.name, field.dataType.simpleString(), "YES" if field.nullable else "NO", position)
        for name, df in tables.items()
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, column_name string, data_type string, is_nullable string, ordinal_position bigint",
    )


def write_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Create or replace a managed table; rows of one partition value are brought together before the write."""
    _writer(df, partition_by).saveAsTable(name)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), placed: bool = False) -> None:
    """``placed``: the rows come from files that each hold one partition value, and are written without an exchange."""
    _writer(df, partition_by, placed).parquet(path)


def _writer(df: DataFrame, partition_by: Sequence[str], placed: bool = False):
    if not partition_by:
        return df.write.mode("overwrite").format("parquet")
    if placed:
        return df.write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    # The rebalance hint lets adaptive execution split a month that holds most of the rows over several files,
    # which repartition() by the month alone would not.
    return df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite").format("parquet").partitionBy(*partition_by)


def write_csv(df: DataFrame, path: str) -> None:
    """Flat files with a header for tools outside Spark; several part files, never one task for all rows."""
    df.write.mode("overwrite").option("header", True).csv(path)


def register_views(views: Mapping[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
