"""Joins of lines with their dimensions, and one-row results placed side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(*frames: DataFrame) -> DataFrame:
    """Columns of several one-row frames on one row.

    A union folded by MAX: every column has one row that sets it, the others leave it NULL.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for f in frames for c in f.columns])


def join_lines(lines: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of a line table with a table that is unique on ``key``, safe against a hot key.

    Adaptive execution splits the partition of a hot key over several tasks, but only when both inputs of the join are
    plain exchanges. A deduplicated or aggregated table arrives partitioned by the key already, and would be joined
    without one. A bit of the hash as second join key gives each side an exchange of its own; that costs one more shuffle of
    the smaller table. Small tables are still broadcast, by their measured size.
    """
    # One bit, since a whole hash is eight bytes of each line that no compression makes smaller.
    spread = F.xxhash64(key).bitwiseAND(1)
    return (
        lines.withColumn("_spread", spread)
        .join(table.withColumn("_spread", spread), [key, "_spread"], how)
        .drop("_spread")
    )
