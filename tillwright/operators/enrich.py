"""Line-level enrichment: calendar, price bucket, customer lifecycle and value, city and category tiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.functions import columns as C
from tillwright.operators.master import MASTER_COLUMNS, newest_rows
from tillwright.operators.scale import global_ntile
from tillwright.session import materialise

# Labels and bounds.
PRICE_BUCKETS = ("Under 20", "20–49.99", "50–99.99", "100+")
PRICE_BOUNDS = (20, 50, 100)
CITY_TIERS = ("Tier 1 (Top)", "Tier 2", "Tier 3 (Emerging)")
CATEGORY_TIERS = ("Tier 1 (Core)", "Tier 2", "Tier 3 (Long tail)")

# Up to this many keys, counted before, are ranked in one window; more of them by a sort over all tasks, with the same result.
WINDOW_KEYS = 100_000

# A day of a customer with more lines than this is cut by product before its lines are numbered.
DAY_LINES = 100_000

# Identical lines are unfolded in pieces of this many.
_COPIES_PER_ROW = 1 << 16


# ---- columns ------------------------------------------------------------------------------------------------


def with_time_breakdowns(df: DataFrame) -> DataFrame:
    day = F.col("order_date")
    return df.withColumns(
        {
            "order_year": C.year(day),
            "order_month": C.month(day),
            "order_ym": C.year_month(day),
            "dow_name": C.day_name(day),
            "dow_num": C.day_of_week(day),
            "week_of_year": C.week_sunday(day),
        }
    )


def price_bucket(price: Column | str) -> Column:
    """Label of the price range; a missing price falls into the last one."""
    p = C.col(price)
    label = F.when(p < PRICE_BOUNDS[0], PRICE_BUCKETS[0])
    for bound, name in zip(PRICE_BOUNDS[1:], PRICE_BUCKETS[1:]):
        label = label.when(p < bound, name)
    return label.otherwise(PRICE_BUCKETS[-1])


def with_price_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn("price_bucket", price_bucket("product_price"))


# ---- customer lifecycle and value ---------------------------------------------------------------------------

# Order of a customer's lines: by day, product, and then these; rows that tie on all of them are identical.
_SEQUENCE_KEYS = ("cust_email", "order_date", "product_name")
_SEQUENCE = ("category_name", "product_price", "total_sales", "cust_city", "order_qty")
# Stands for a missing day; no date has it as its number.
_NO_DAY = -(1 << 31)


def _never_missing(text: str) -> Column:
    """A text as a key that is never missing and sorts as the text does, missing ones first."""
    return F.coalesce(F.concat(F.lit("@"), F.col(text)), F.lit(""))


def _or_missing(key: str) -> Column:
    return F.when(F.col(key) != "", F.expr(f"substring({key}, 2)"))


# Of the key of a customer (never missing) and the number of a day: where its lines are wanted, as one value.
Place = Callable[[Column, Column], Column]


def with_customer_history(master: DataFrame, repeat_by_day: bool = False, place: Place | None = None) -> DataFrame:
    """First purchase, sequence number, repeat flag, lifetime value, number of lines and average line of a customer.

    Lines without an email count as one customer, which can have any share of all lines; so no window holds all lines of
    a customer. What lies before a line is the sum of its customer's earlier days (a window over one row per day) and its
    place among the lines of its day, for which the lines are exchanged once. The days are summed and stored first: a day
    on which one customer has more than ``DAY_LINES`` lines is cut by product, see ``_numbered_products``.

    The repeat flag is a property of the line: the second line of a first basket already counts as repeat. With
    ``repeat_by_day=True`` only lines after the first day do.

    With ``place`` the lines are exchanged by it instead, and come out brought together by it: who writes them by month, say,
    needs no second exchange.
    """
    columns = master.columns
    # Keys that are never missing: windows and joins on them share one exchange of the lines, null-safe joins would not.
    plain = master.select(
        _never_missing("cust_email").alias("_e"),
        F.coalesce(F.unix_date("order_date"), F.lit(_NO_DAY)).alias("_d"),
        _never_missing("product_name").alias("_p"),
        *[c for c in columns if c not in _SEQUENCE_KEYS],
    )
    day = F.when(F.col("_d") > _NO_DAY, F.date_from_unix_date("_d"))
    days = materialise(plain.groupBy("_e", "_d").agg(F.count("*").alias("_n"), F.sum("total_sales").alias("_sales")), "days")
    # One row in DAY_LINES lines at most.
    large = days.filter(F.col("_n") > DAY_LINES).select("_e", "_d")
    some = not large.isEmpty()
    small = plain.join(F.broadcast(large), ["_e", "_d"], "left_anti") if some else plain
    customer = W.partitionBy("_e")
    per_day = days.select(
        "_e",
        "_d",
        (F.sum("_n").over(customer.orderBy("_d").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).alias("_days_before"),
        F.sum("_n").over(customer).alias("customer_total_lines"),
        F.min(day).over(customer).alias("first_order_date"),
        F.sum("_sales").over(customer).alias("customer_ltv_gross"),
    )
    cut = _numbered_products(plain.join(F.broadcast(large), ["_e", "_d"], "left_semi")) if some else None
    if place:
        numbered = _numbered_with_days(small, per_day, place)
        if some:
            numbered = numbered.unionByName(_brought(cut.join(per_day, ["_e", "_d"]), place).drop("_place"))
    else:
        numbered = _numbered_days(small)
        numbered = (numbered.unionByName(cut) if some else numbered).join(per_day, ["_e", "_d"])
    lines = (
        numbered.withColumn("order_seq", F.col("_days_before") + F.col("_in_day"))
        .withColumns({"cust_email": _or_missing("_e"), "order_date": day, "product_name": _or_missing("_p")})
        .select(*columns, "first_order_date", "customer_ltv_gross", "customer_total_lines", "order_seq")
    )
    repeat = F.col("order_date") > F.col("first_order_date") if repeat_by_day else F.col("order_seq") > 1
    return lines.withColumns(
        {
            "days_since_first": C.days_between("order_date", "first_order_date"),
            "is_repeat_customer": repeat,
            "customer_avg_line_value": C.safe_ratio(F.col("customer_ltv_gross"), F.col("customer_total_lines")),
        }
    )


def _numbered_days(plain: DataFrame) -> DataFrame:
    """``_in_day``: the place of a line among those of its customer and day."""
    in_day = W.partitionBy("_e", "_d").orderBy("_p", *_SEQUENCE)
    return plain.withColumn("_in_day", F.row_number().over(in_day).cast("bigint"))


def _brought(df: DataFrame, place: Place) -> DataFrame:
    return df.withColumn("_place", place(F.col("_e"), F.col("_d"))).repartition("_place")


def _numbered_with_days(plain: DataFrame, per_day: DataFrame, place: Place) -> DataFrame:
    """``_numbered_days`` with the columns of ``per_day``, by ``place``. The row of a customer's day goes through the exchange
    of the lines and is the first of its day: a join would exchange the lines once more, by customer and day."""
    told = [c for c in per_day.columns if c not in ("_e", "_d")]
    both = plain.unionByName(per_day.select("_e", "_d", F.struct(*told).alias("_day")), allowMissingColumns=True)
    is_line = F.col("_day").isNull()
    in_day = W.partitionBy("_place", "_e", "_d").orderBy(is_line, "_p", *_SEQUENCE)
    placed = _brought(both, place).withColumns(
        {"_in_day": F.row_number().over(in_day).cast("bigint") - 1, "_first": F.first("_day").over(in_day.rowsBetween(W.unboundedPreceding, 0))}
    )
    return placed.filter(is_line).select(*plain.columns, "_in_day", *[F.col(f"_first.{c}").alias(c) for c in told])


def _numbered_products(plain: DataFrame) -> DataFrame:
    """As ``_numbered_days``, for days of any number of lines: the day's earlier products, and the earlier lines with the same
    product. Identical lines are counted instead of shipped."""
    keys = ["_e", "_d", "_p"]
    distinct = plain.groupBy(*plain.columns).agg(F.count("*").alias("_copies"))
    products = plain.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = W.partitionBy("_e", "_d").orderBy("_p").rowsBetween(W.unboundedPreceding, 0)
    offsets = products.select(*keys, (F.sum("_n").over(before) - F.col("_n")).alias("_before"))
    in_product = W.partitionBy(*keys).orderBy(*_SEQUENCE).rowsBetween(W.unboundedPreceding, 0)
    return (
        distinct.withColumn("_last", F.sum("_copies").over(in_product))
        .join(offsets, keys)
        .withColumn("_last", F.col("_before") + F.col("_last"))
        .withColumn("_first", F.col("_last") - F.col("_copies") + 1)
        .withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_copies - 1) div {_COPIES_PER_ROW}"))))
        .withColumn("_first", F.col("_first") + F.col("_piece") * _COPIES_PER_ROW)
        .withColumn("_in_day", F.explode(F.sequence("_first", F.least("_last", F.col("_first") + (_COPIES_PER_ROW - 1)))))
        .select(*plain.columns, "_in_day")
    )


# ---- tiers --------------------------------------------------------------------------------------------------


def _tiers(master: DataFrame, key: str, labels: tuple[str, ...], sales: str, tile: str, tier: str, per_year: bool) -> DataFrame:
    lines = master.select(key, C.year("order_date").alias("order_year"), "total_sales") if per_year else master
    by = ["order_year"] if per_year else []
    totals = materialise(lines.groupBy(*by, key).agg(F.sum("total_sales").alias(sales)), "totals")
    order = [F.desc(sales), F.asc(key)]
    if totals.count() <= WINDOW_KEYS:
        tiled = totals.withColumn(tile, F.ntile(3).over(W.partitionBy(*by).orderBy(*order)).cast("bigint"))
    else:
        tiled = global_ntile(totals, 3, order, tile, by)
    return tiled.withColumn(tier, _tier_label(tile, labels))


def _tier_label(tile: str, labels: tuple[str, ...]) -> Column:
    # A key without a tile (a missing city) reads as the last tier.
    return F.when(F.col(tile) == 1, labels[0]).when(F.col(tile) == 2, labels[1]).otherwise(labels[2])


def city_tiers(master: DataFrame, per_year: bool = False) -> DataFrame:
    """Cities in three tiers by sales, over all time or within each year; ties go by name. Cities are free text, as many
    as there may be: when they are more than ``WINDOW_KEYS``, they are ranked without bringing them into one task."""
    return _tiers(master, "cust_city", CITY_TIERS, "city_sales", "city_ntile", "city_tier", per_year)


def category_tiers(master: DataFrame, per_year: bool = False) -> DataFrame:
    return _tiers(master, "category_name", CATEGORY_TIERS, "category_sales", "category_ntile", "category_tier", per_year)


def _lookup_tier(df: DataFrame, tiers: DataFrame, key: str, sales: str, tier: str, labels: tuple[str, ...], per_year: bool) -> DataFrame:
    by = [key] + (["order_year"] if per_year else [])
    found = tiers.select(*by, F.col(tier).alias("_tier"), F.col(sales).alias(f"{sales}_total"))
    return (
        df.join(found, by, "left")
        .withColumn(tier, F.coalesce("_tier", F.lit(labels[2])))
        .drop("_tier")
    )


EXT_COLUMNS = MASTER_COLUMNS + (
    "order_year",
    "order_month",
    "order_ym",
    "dow_name",
    "dow_num",
    "week_of_year",
    "price_bucket",
    "first_order_date",
    "days_since_first",
    "order_seq",
    "is_repeat_customer",
    "customer_ltv_gross",
    "customer_total_lines",
    "customer_avg_line_value",
    "city_tier",
    "city_sales_total",
    "category_tier",
    "category_sales_total",
)


TIER_COLUMNS = ("city_tier", "city_sales_total", "category_tier", "category_sales_total")


def with_tiers(lines: DataFrame, cities: DataFrame, categories: DataFrame, per_year: bool = False) -> DataFrame:
    """Tier and total of each line's city and category.

    The look-ups carry no broadcast hint: small tier tables are broadcast by their measured size, large ones are joined
    by sort and merge.
    """
    lines = _lookup_tier(lines, cities, "cust_city", "city_sales", "city_tier", CITY_TIERS, per_year)
    return _lookup_tier(lines, categories, "category_name", "category_sales", "category_tier", CATEGORY_TIERS, per_year)


def with_line_columns(master: DataFrame, repeat_by_day: bool = False, place: Place | None = None) -> DataFrame:
    """The line table but for the tiers, which hang on the sales of all lines; ``place`` as for ``with_customer_history``."""
    lines = with_price_bucket(with_time_breakdowns(with_customer_history(master, repeat_by_day, place)))
    return lines.select(*[c for c in EXT_COLUMNS if c not in TIER_COLUMNS])


def master_sales_ext(master: DataFrame, tiers_per_year: bool = False, repeat_by_day: bool = False) -> DataFrame:
    """The 26-column line table. ``master`` is read several times: pass a stored table."""
    cities, categories = city_tiers(master, tiers_per_year), category_tiers(master, tiers_per_year)
    return with_tiers(with_line_columns(master, repeat_by_day), cities, categories, tiers_per_year).select(*EXT_COLUMNS)


# ---- checks and samples -------------------------------------------------------------------------------------


def qa_ext_nulls(ext: DataFrame) -> DataFrame:
    """Row and NULL counts. A missing city still gets a tier label, so the tier totals are tested as well."""
    tested = ("order_date", "price_bucket", "first_order_date", "city_tier", "category_tier")
    totals = ("city_sales_total", "category_sales_total")
    return ext.agg(
        F.count("*").alias("rows_ext"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in tested + totals]
    )


def repeat_distribution(ext: DataFrame) -> DataFrame:
    return ext.groupBy("is_repeat_customer").agg(F.count("*").alias("row_count"))


def price_bucket_check(df: DataFrame) -> DataFrame:
    return df.groupBy("price_bucket").agg(F.count("*").alias("line_count"), F.sum("total_sales").alias("sales"))


def monthly_by_tiers(ext: DataFrame) -> DataFrame:
    return ext.groupBy("order_ym", "city_tier", "category_tier").agg(
        F.sum("total_sales").alias("sales"), F.sum("order_qty").alias("qty")
    )


def ext_sample(ext: DataFrame, n: int = 20) -> DataFrame:
    return newest_rows(
        ext,
        [
            "order_date",
            "order_ym",
            "cust_email",
            "cust_city",
            "city_tier",
            "product_name",
            "category_name",
            "category_tier",
            "order_qty",
            "product_price",
            "price_bucket",
            "total_sales",
            "order_seq",
            "is_repeat_customer",
            "days_since_first",
            "customer_ltv_gross",
            "customer_avg_line_value",
        ],
        n,
    )
