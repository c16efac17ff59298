"""Generated day, month and number sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions import columns as C


def day_calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between ``lo`` and ``hi`` of a one-row frame."""
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))


def month_calendar(bounds: DataFrame) -> DataFrame:
    """One ``ym`` row per month between ``lo`` and ``hi`` of a one-row frame."""
    first, last = F.trunc("lo", "month"), F.trunc("hi", "month")
    months = bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month"))
    return months.select(C.year_month("month").alias("ym"))


def date_bounds(df: DataFrame, column: str = "order_date") -> DataFrame:
    """One row with the first and last date of a frame, as input for the calendars."""
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def fixed_bounds(df: DataFrame, lo: str, hi: str) -> DataFrame:
    """One row with given dates, in the session of ``df``."""
    return df.sparkSession.range(1).select(F.lit(lo).cast("date").alias("lo"), F.lit(hi).cast("date").alias("hi"))


def numbers(bounds: DataFrame, block: int = 1 << 16, keep: Sequence[str] = ()) -> DataFrame:
    """Every whole number between ``lo`` and ``hi`` of each row, as ``n``; ``keep`` names columns to carry along.

    Blocks first, then the numbers in a block, so that no row ever holds the whole range.
    """
    index = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(hi - lo) div {block}")))
    blocks = bounds.select("lo", "hi", *keep, index.alias("index")).withColumn("first", F.col("lo") + F.col("index") * block)
    last = F.least("hi", F.col("first") + (block - 1))
    return blocks.select(F.explode(F.sequence("first", last)).alias("n"), *keep)
