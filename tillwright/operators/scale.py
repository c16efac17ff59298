"""Ranking and running totals over a whole table.

A window without PARTITION BY moves every row to one task. The functions here sort the table over many tasks instead,
number the rows inside each sorted piece, and add what lies before the piece. Two things make this exact:

* the sorted and numbered table is written once (``materialise``), because the bounds of a range sort are drawn from a
  sample and must not be drawn a second time for the offsets;
* the sort order must end in a unique key, so that a recomputed piece numbers its rows in the same way.

Only the offsets are broadcast: one row per sorted piece (as many as the sort has partitions), or one per block of rows
(at most ``MAX_BLOCKS``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.session import materialise

# monotonically_increasing_id() holds the partition in the bits above 33 and the row within it below.
_ROW_BITS = 33
BLOCK_ROWS = 100_000
# Blocks grow with the table, so that there are never more than this many and their totals can be broadcast. Results do
# not depend on the size of blocks.
MAX_BLOCKS = 100_000


def block_of(position: str, rows: str, block: int = BLOCK_ROWS) -> Column:
    """Number of the block that holds a 1-based position."""
    return F.expr(f"({position} - 1) div greatest({block}L, {rows} div {MAX_BLOCKS} + 1)")


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number", total: str | None = None) -> DataFrame:
    """1-based position of each row in ``order``; with ``total`` also the number of rows, as a column."""
    slot = F.col("_slot")
    numbered = materialise(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), "sorted")
    pieces = numbered.groupBy(F.shiftright(slot, _ROW_BITS).alias("_piece")).agg(F.count("*").alias("_rows"))
    everything = W.orderBy("_piece").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = pieces.select(
        "_piece",
        (F.sum("_rows").over(W.orderBy("_piece").rowsBetween(W.unboundedPreceding, 0)) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(everything).alias("_total"),
    )
    located = numbered.withColumn("_piece", F.shiftright(slot, _ROW_BITS)).join(F.broadcast(offsets), "_piece")
    position = F.col("_before") + slot.bitwiseAND((1 << _ROW_BITS) - 1) + 1
    kept = [position.alias(name)] + ([F.col("_total").alias(total)] if total else [])
    return located.select(*df.columns, *kept)


def ntile_of(position: str, rows: str, n: int) -> Column:
    """Tile 1…n of a 1-based position among ``rows`` rows; the first ``rows mod n`` tiles hold one row more."""
    small = f"({rows} div {n})"
    long_part = f"({rows} % {n}) * ({small} + 1)"
    return F.expr(
        f"CASE WHEN {position} <= {long_part} THEN ({position} - 1) div ({small} + 1) + 1 "
        f"ELSE ({rows} % {n}) + ({position} - 1 - {long_part}) div greatest({small}, 1L) + 1 END"
    )


def global_ntile(df: DataFrame, n: int, order: Sequence[Column], name: str = "ntile", by: Sequence[str] = ()) -> DataFrame:
    """NTILE(n) over the whole table, or over each group of ``by``."""
    numbered = global_row_number(df, [F.col(c) for c in by] + list(order), "_rn", "_n")
    if by:
        groups = numbered.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(
            (F.min("_rn") - 1).alias("_start"), F.count("*").alias("_size")
        )
        same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
        numbered = (
            numbered.join(groups, same)
            .withColumn("_rn", F.col("_rn") - F.col("_start"))
            .withColumn("_n", F.col("_size"))
        )
    return numbered.withColumn(name, ntile_of("_rn", "_n", n)).select(*df.columns, name)


def global_running(
    df: DataFrame,
    order: Sequence[Column],
    *,
    total_of: str | None = None,
    total: str = "running_total",
    grand_total: str | None = None,
    dense_by: str | None = None,
    dense: str = "dense_rank",
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Running sum of ``total_of`` and/or dense rank of ``dense_by`` along ``order``.

    ``order`` must start with ``dense_by`` for the rank to mean anything. The numbered rows are cut into blocks of
    at least ``block`` rows, every block is scanned by itself, and the totals of the blocks before it are added. With
    ``grand_total`` the sum over all rows is put on each row too.
    """
    numbered = global_row_number(df, order, "_rn", "_n").withColumn("_block", block_of("_rn", "_n", block))
    in_block = W.partitionBy("_block").orderBy("_rn")
    so_far = in_block.rowsBetween(W.unboundedPreceding, 0)
    scanned, per_block, before = numbered, [], []
    blocks_so_far = W.orderBy("_block").rowsBetween(W.unboundedPreceding, 0)
    output = list(df.columns)
    if total_of:
        scanned = scanned.withColumn("_run", F.sum(total_of).over(so_far))
        per_block.append(F.sum(total_of).alias("_sum"))
        before.append(F.sum("_sum").over(blocks_so_far.rowsBetween(W.unboundedPreceding, -1)).alias("_sum_before"))
        before.append(F.sum("_sum").over(blocks_so_far.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("_sum_all"))
    if dense_by:
        value = F.col(dense_by)
        fresh = F.when(F.lag("_rn").over(in_block).isNotNull() & F.lag(value).over(in_block).eqNullSafe(value), 0).otherwise(1)
        scanned = scanned.withColumn("_fresh", fresh).withColumn("_level", F.sum("_fresh").over(so_far))
        per_block += [
            F.max("_level").alias("_levels"),
            F.min_by(F.struct(value), "_rn").alias("_first"),
            F.max_by(F.struct(value), "_rn").alias("_last"),
        ]
        # A block that starts with the value its predecessor ended with opens one level less.
        shared = F.when(F.col("_first") == F.lag("_last").over(W.orderBy("_block")), 1).otherwise(0)
        before.append(shared.alias("_shared"))
    offsets = scanned.groupBy("_block").agg(*per_block).select("*", *before)
    if dense_by:
        offsets = offsets.withColumn(
            "_level_before", F.sum(F.col("_levels") - F.col("_shared")).over(blocks_so_far) - F.col("_levels")
        ).drop("_first", "_last")
    joined = scanned.join(F.broadcast(offsets), "_block")
    if total_of:
        # NULL only while every value so far is NULL, as for a plain running SUM.
        run = F.coalesce(F.col("_sum_before") + F.col("_run"), F.col("_run"), F.col("_sum_before"))
        output.append(run.alias(total))
        if grand_total:
            output.append(F.col("_sum_all").alias(grand_total))
    if dense_by:
        output.append((F.col("_level") + F.col("_level_before")).cast("bigint").alias(dense))
    return joined.select(*output)


def exact_quantiles(df: DataFrame, value: Column, wanted: dict[str, float]) -> DataFrame:
    """One row with discrete quantiles (an element of the data, no interpolation) under the names in ``wanted``.

    Works on one row per distinct value, so that neither a hot value nor many values end up in one task.
    """
    counts = df.select(value.alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n"))
    curve = global_running(counts, [F.col("v")], total_of="n", total="cum", grand_total="rows")
    return curve.agg(
        *[
            F.min(F.when(F.col("cum") >= F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("rows"))), F.col("v"))).alias(name)
            for name, p in wanted.items()
        ]
    )
