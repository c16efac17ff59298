"""Mergeable states: small tables by month that answer slices and merge when a month arrives, without the lines.

* *Customer sets*: customers have dense numbers, and a set of them is a few bitmaps of 32,768 numbers each. The state
  holds the customers of every month, city, category and of new and repeat lines. Sets are joined by OR, so distinct
  customers of any slice are exact, and nothing is counted from lines again.
* *Active months* of a customer, as bits; retention, returns and gaps are read off them.
* *Quantile summaries* of a month's values, which merge with a bound on the error of ranks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.functions import columns as C
from tillwright.operators.combine import join_lines
from tillwright.operators.scale import global_row_number, global_running
from tillwright.session import materialise

SLICE = ("order_ym", "cust_city", "category_name", "is_repeat_customer")


# ---- customer sets ------------------------------------------------------------------------------------------


def customer_numbers(lines: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``cust_email`` and ``number`` from 1, dense. Those ``known`` keep their numbers, others follow.

    New customers are numbered city by city, so that the customers of a city share few bitmaps. A missing email is no
    customer.
    """
    found = lines.filter("cust_email IS NOT NULL").groupBy("cust_email").agg(F.min("cust_city").alias("_city"))
    if known is not None:
        found = join_lines(found, known.select("cust_email"), "cust_email", "left_anti")
    fresh = global_row_number(found, [F.col("_city"), F.col("cust_email")], "number").select("cust_email", "number")
    if known is None:
        return fresh
    last = known.agg(F.coalesce(F.max("number"), F.lit(0).cast("long"))).scalar()
    return known.select("cust_email", "number").unionByName(fresh.withColumn("number", F.col("number") + last))


def customer_sets(ext: DataFrame, numbers: DataFrame, by: Sequence[str] = SLICE) -> DataFrame:
    """``by``, ``part`` (which 32,768 numbers) and ``members`` (bitmap), from enriched lines.

    Lines are exchanged for the numbers by customer, and reduced to one row per customer and group where they then are. The
    rows of a bitmap (at most 32,768) are brought together before it is made: a task that made bitmaps of its own rows would
    pass on, and sort, one of 4 KB for almost every row.
    """
    spread = F.xxhash64("cust_email").bitwiseAND(1).alias("_spread")  # as in join_lines, for a hot customer
    lines = ext.filter("cust_email IS NOT NULL").select(*by, "cust_email", spread)
    numbered = lines.join(numbers.select("cust_email", "number", spread), ["cust_email", "_spread"])
    # With the keys of the join among its own this takes no exchange, but after a split of a hot customer.
    pairs = numbered.groupBy("cust_email", "_spread", "number", *by).agg(F.count(F.lit(1)).alias("_lines"))
    placed = pairs.select(*by, F.bitmap_bucket_number("number").alias("part"), "number").repartition(*by, "part")
    return placed.groupBy(*by, "part").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("members")
    )


def slice_sums(ext: DataFrame, by: Sequence[str] = SLICE) -> DataFrame:
    """Sales, units and number of lines of each group."""
    return ext.groupBy(*by).agg(
        F.sum("total_sales").alias("sales"), F.sum("order_qty").alias("qty"), F.count(F.lit(1)).alias("line_count")
    )


def _distinct(sets: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    joined = sets.groupBy(*by, "part").agg(F.bitmap_or_agg("members").alias("members"))
    return joined.groupBy(*by).agg(F.sum(F.bitmap_count("members")).alias(name))


def sliced(sums: DataFrame, sets: DataFrame, by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Figures of a slice, from the states alone: ``sales``, ``qty``, ``line_count``, ``asp``, ``distinct_customers``,
    ``n_new_customers``, ``n_repeat_customers``, ``repeat_rate``, ``pct_repeat_sales``.

    ``by`` names columns of the states or ``order_year``; ``where`` is a condition on them.
    """
    year = F.substring("order_ym", 1, 4).cast("bigint")
    sums, sets = (df.withColumn("order_year", year).filter(F.lit(True) if where is None else where) for df in (sums, sets))
    repeat = F.col("is_repeat_customer")
    totals = sums.groupBy(*by).agg(
        F.sum("sales").alias("sales"),
        F.sum("qty").alias("qty"),
        F.sum("line_count").alias("line_count"),
        F.sum(F.when(repeat, F.col("sales"))).alias("_repeat_sales"),
    )
    # One pass over the sets: OR by new and repeat, then both together.
    kinds = sets.groupBy(*by, "part", "is_repeat_customer").agg(F.bitmap_or_agg("members").alias("members"))
    size = F.bitmap_count("members")
    joined = kinds.groupBy(*by, "part").agg(
        F.bitmap_count(F.bitmap_or_agg("members")).alias("all"),
        F.sum(F.when(~repeat, size)).alias("new"),
        F.sum(F.when(repeat, size)).alias("repeat"),
    )
    zero = F.lit(0).cast("long")
    counts = joined.groupBy(*by).agg(F.sum("all").alias("_all"), F.sum("new").alias("_new"), F.sum("repeat").alias("_repeat"))
    if by:
        renamed = counts.withColumnsRenamed({c: f"_by_{c}" for c in by})
        met = totals.join(renamed, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by], "left")
    else:
        met = totals.join(counts)  # one row each
    distinct, new, again = (F.coalesce(F.col(c), zero) for c in ("_all", "_new", "_repeat"))
    return met.select(
        *by,
        "sales",
        "qty",
        "line_count",
        C.safe_ratio(F.col("sales"), F.col("qty")).alias("asp"),
        distinct.alias("distinct_customers"),
        new.alias("n_new_customers"),
        again.alias("n_repeat_customers"),
        C.safe_ratio(again, distinct).alias("repeat_rate"),
        C.safe_ratio(F.col("_repeat_sales"), F.col("sales")).alias("pct_repeat_sales"),
    )


# ---- active months ------------------------------------------------------------------------------------------

# Months in one row of bits; the first month of all is January of this year.
_SPAN, _EPOCH = 60, 1900


def _month_number(ym: Column) -> Column:
    return (F.substring(ym, 1, 4).cast("int") - _EPOCH) * 12 + F.substring(ym, 6, 2).cast("int") - 1


def active_months(lines: DataFrame) -> DataFrame:
    """``customer_sk``, ``span`` (which 60 months) and ``bits`` of the months in which the customer has a line."""
    n = _month_number(F.col("order_ym"))
    return lines.groupBy("customer_sk", F.floor(n / _SPAN).cast("int").alias("span")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(n, F.lit(_SPAN)).cast("int"))).alias("bits")
    )


def merge_active_months(*states: DataFrame) -> DataFrame:
    """States of different lines as one."""
    together = states[0]
    for state in states[1:]:
        together = together.unionByName(state)
    return together.groupBy("customer_sk", "span").agg(F.bit_or("bits").alias("bits")).filter("bits <> 0")


def without_months(state: DataFrame, months: Sequence[str]) -> DataFrame:
    """The state as if there were no lines of ``months``; months whose lines have changed are put back from these."""
    masks: dict[int, int] = {}
    for ym in months:
        n = (int(ym[:4]) - _EPOCH) * 12 + int(ym[5:7]) - 1
        masks[n // _SPAN] = masks.get(n // _SPAN, 0) | 1 << n % _SPAN
    mask = F.lit(0).cast("long")
    for span, bits in masks.items():
        mask = F.when(F.col("span") == span, F.lit(bits).cast("long")).otherwise(mask)
    return state.withColumn("bits", F.col("bits").bitwiseAND(F.bitwise_not(mask))).filter("bits <> 0")


def _months_of(state: DataFrame) -> DataFrame:
    """``customer_sk`` and its sorted month numbers."""
    bit = F.sequence(F.lit(0), F.lit(_SPAN - 1))
    numbers = F.transform(
        F.filter(bit, lambda i: F.expr("bits").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0),
        lambda i: F.col("span") * _SPAN + i,
    )
    return state.groupBy("customer_sk").agg(F.array_sort(F.flatten(F.collect_list(numbers))).alias("months"))


def _ym(n: Column) -> Column:
    return F.concat(F.lpad((F.floor(n / 12) + _EPOCH).cast("string"), 4, "0"), F.lit("-"), F.lpad((F.pmod(n, F.lit(12)) + 1).cast("string"), 2, "0"))


def cohorts(state: DataFrame) -> DataFrame:
    """Retention by cohort (``behaviour.view_monthly_cohort``), from the bits."""
    months = _months_of(state).select(F.col("months")[0].alias("first"), F.explode("months").alias("n"))
    counts = months.groupBy(_ym(F.col("first")).alias("cohort_ym"), (F.col("n") - F.col("first")).cast("bigint").alias("months_since_first")).agg(
        F.count(F.lit(1)).alias("active_customers")
    )
    size = F.max(F.when(F.col("months_since_first") == 0, F.col("active_customers"))).over(W.partitionBy("cohort_ym"))
    return counts.withColumn("cohort_size", size).withColumn(
        "retention_rate", C.safe_ratio(F.col("active_customers"), F.col("cohort_size"))
    ).select("cohort_ym", "months_since_first", "active_customers", "cohort_size", "retention_rate")


def returns(state: DataFrame, gap: int = 3) -> DataFrame:
    """Customers who came back after at least ``gap`` months without a line, by the month of their return."""
    months = _months_of(state)
    pairs = F.arrays_zip(F.expr("slice(months, 1, size(months) - 1)").alias("a"), F.expr("slice(months, 2, size(months) - 1)").alias("b"))
    steps = months.filter(F.size("months") > 1).select(F.explode(pairs).alias("s")).select("s.a", "s.b").filter(F.col("b") - F.col("a") > gap)
    return steps.groupBy(_ym(F.col("b")).alias("order_ym")).agg(
        F.count(F.lit(1)).alias("returned_customers"), F.max(F.col("b") - F.col("a") - 1).cast("bigint").alias("longest_gap")
    )


# ---- quantiles ----------------------------------------------------------------------------------------------

BINS = 1000


def quantile_summary(df: DataFrame, value: Column, by: Column, bins: int = BINS) -> DataFrame:
    """``by``, ``lo``, ``hi``, ``n``: ranges of neighbouring values of a group, with the number of its rows in each.

    A value that more than one row in ``bins`` has is a range of its own. Any other range holds fewer than two rows in
    ``bins``, so that the summary has at most about ``2 * bins`` rows a group. Groups are summarised by themselves, and
    summaries are merged by putting them together.
    """
    rows = df.select(by.alias("by"), value.alias("v")).filter("by IS NOT NULL AND v IS NOT NULL")
    counts = materialise(rows.groupBy("by", "v").agg(F.count(F.lit(1)).alias("n")), "counts")
    curve = global_running(counts, [F.col("by"), F.col("v")], total_of="n", total="upto")
    groups = counts.groupBy("by").agg(F.sum("n").alias("rows"))
    placed = join_lines(curve, groups, "by")
    # Positions in steps of rows / bins along all groups; a heavy value, and what follows it, begin a range.
    heavy = F.col("n") * bins > F.col("rows")
    step = F.expr(f"((upto - n) * {bins}) div rows")
    return placed.groupBy("by", step.alias("step"), heavy.alias("heavy"), F.when(heavy, F.col("v")).alias("own")).agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("n")
    ).select("by", "lo", "hi", "n")


def merged_quantiles(summary: DataFrame, wanted: Mapping[str, float]) -> DataFrame:
    """``name``, ``p``, ``n_rows``, ``value`` and the ranks it may have (``rank_low`` to ``rank_high``) by the summaries alone.

    The value is the end of the first range at which the merged counts reach p. Only ranges that begin below the value and
    end above it are uncertain; their rows are what the interval is wide by.
    """
    ends = summary.groupBy("hi").agg(F.sum("n").alias("n"))
    curve = global_running(ends, [F.col("hi")], total_of="n", total="cum", grand_total="n_rows")
    points = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p")) for name, p in wanted.items()])
    chosen = curve.select("*", F.explode(points).alias("q")).filter(F.col("cum") >= F.greatest(F.lit(1), F.ceil(F.col("q.p") * F.col("n_rows"))))
    values = chosen.groupBy("q.name", "q.p").agg(F.min(F.struct("hi", "n_rows")).alias("v")).select("name", "p", "v.n_rows", F.col("v.hi").alias("value"))
    # One row for each wanted quantile.
    return (
        summary.join(F.broadcast(values))
        .groupBy("name", "p", "n_rows", "value")
        .agg(
            F.coalesce(F.sum(F.when(F.col("hi") < F.col("value"), F.col("n"))), F.lit(0)).alias("_below"),
            F.coalesce(F.sum(F.when(F.col("lo") <= F.col("value"), F.col("n"))), F.lit(0)).alias("rank_high"),
        )
        .select("name", "p", "n_rows", "value", (F.col("_below") + 1).alias("rank_low"), "rank_high")
    )


def checked_quantiles(df: DataFrame, value: Column, quantiles: DataFrame, bins: int = BINS) -> DataFrame:
    """``merged_quantiles`` with the ranks that the value has in ``df``, and whether the wanted rank is as near to them as
    the summaries promise: within two rows in ``bins``. One pass over ``df``."""
    rows = df.select(value.alias("_v")).filter("_v IS NOT NULL").groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    exact = rows.join(F.broadcast(quantiles)).groupBy(*quantiles.columns).agg(
        F.coalesce(F.sum(F.when(F.col("_v") < F.col("value"), F.col("_n"))), F.lit(0)).alias("_below"),
        F.coalesce(F.sum(F.when(F.col("_v") <= F.col("value"), F.col("_n"))), F.lit(0)).alias("exact_high"),
    )
    rank = F.greatest(F.lit(1), F.ceil(F.col("p") * F.col("n_rows")))
    error = F.greatest(F.lit(0), F.col("_below") + 1 - rank, rank - F.col("exact_high"))
    return exact.select(
        "name", "p", "n_rows", "value", (F.col("_below") + 1).alias("exact_low"), "exact_high",
        error.alias("rank_error"), (error * bins <= 2 * F.col("n_rows")).alias("is_within_bound"),
        ((F.col("rank_low") <= F.col("_below") + 1) & (F.col("exact_high") <= F.col("rank_high"))).alias("is_interval_right"),
    )
