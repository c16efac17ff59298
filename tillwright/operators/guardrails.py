"""Reconciliation checks. Each gives counts that are 0, and flags that are true, on sound data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.functions import columns as C
from tillwright.operators.combine import one_row
from tillwright.operators.metrics import resum, rollup
from tillwright.operators.scale import BLOCK_ROWS, block_of, global_row_number
from tillwright.sources.sequences import month_calendar

# Tolerances.
EPSILON = 0.001
COHORT_EPSILON = 0.0001


def _differs(a: Column, b: Column, epsilon: float = EPSILON) -> Column:
    """True when the values differ by more than ``epsilon``, or when one side is missing."""
    return F.coalesce(F.abs(a - b).cast("double") > epsilon, F.lit(True))


def _side_by_side(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Full outer join by month, so that a month missing on one side counts as a mismatch."""
    left = a.select("order_ym", *[F.col(c).alias(f"a_{c}") for c in columns])
    right = b.select("order_ym", *[F.col(c).alias(f"b_{c}") for c in columns])
    return left.join(right, "order_ym", "full_outer")


def _recomputed(lines: DataFrame) -> DataFrame:
    return rollup(lines.withColumn("order_ym", C.year_month("order_date")), ["order_ym"])


def sales_qty_parity(lines: DataFrame, monthly: DataFrame) -> DataFrame:
    both = _side_by_side(_recomputed(lines), monthly, ["sales", "qty"])
    return both.agg(
        *[F.count_if(_differs(F.col(f"a_{c}"), F.col(f"b_{c}"))).alias(f"{c}_mismatch_months") for c in ("sales", "qty")]
    )


def aov_parity(lines: DataFrame, aov: DataFrame) -> DataFrame:
    """Recomputes the order value with a distinct count, independently of the two-step view."""
    again = (
        lines.groupBy(C.year_month("order_date").alias("order_ym"))
        .agg(F.sum("total_sales").alias("sales"), F.count_distinct("customer_sk", "date_key").alias("orders"))
        .select("order_ym", C.safe_ratio(F.col("sales"), F.col("orders")).alias("aov_proxy"))
    )
    both = _side_by_side(again, aov, ["aov_proxy"])
    return both.agg(F.count_if(_differs(F.col("a_aov_proxy"), F.col("b_aov_proxy"))).alias("aov_mismatch_months"))


def month_coverage(monthly: DataFrame, bounds: DataFrame) -> DataFrame:
    """Expected months between ``lo`` and ``hi`` of ``bounds`` against the months present; lists are never NULL."""
    expected = month_calendar(bounds)
    missing = expected.join(monthly.select(F.col("order_ym").alias("ym")), "ym", "left_anti")
    counts = one_row(
        expected.agg(F.count("*").alias("expected_months")),
        monthly.agg(F.count("*").alias("actual_months")),
        missing.agg(F.array_sort(F.collect_list("ym")).alias("missing_months")),
    )
    return counts.withColumns(
        {
            "is_month_count_match": F.col("expected_months") == F.col("actual_months"),
            "is_no_gap": F.size("missing_months") == 0,
        }
    )


def global_parity(lines: DataFrame, by_category: DataFrame, by_city: DataFrame, by_product: DataFrame) -> DataFrame:
    def total(df: DataFrame, name: str, sales: str = "sales", qty: str = "qty") -> DataFrame:
        return df.agg(F.sum(sales).alias(f"sales_{name}"), F.sum(qty).alias(f"qty_{name}"))

    totals = one_row(
        total(lines, "base", "total_sales", "order_qty"),
        total(by_category, "category"),
        total(by_city, "city"),
        total(by_product, "product"),
    )
    return totals.select(
        *[
            F.round(F.col(f"{m}_base") - F.col(f"{m}_{name}"), 3).alias(f"diff_{m}_{name}")
            for name in ("category", "city", "product")
            for m in ("sales", "qty")
        ]
    )


def monthly_parity(lines: DataFrame, monthly: DataFrame, mix: DataFrame) -> DataFrame:
    """Base against the monthly view, and category mix against the monthly view: counts and lists of bad months."""

    def compare(a: DataFrame, name: str) -> DataFrame:
        both = _side_by_side(a, monthly, ["sales", "qty"])
        bad = {m: _differs(F.col(f"a_{m}"), F.col(f"b_{m}")) for m in ("sales", "qty")}
        # At most one entry per month.
        return both.agg(
            *[F.count_if(c).alias(f"mismatch_months_{name}_{m}") for m, c in bad.items()],
            *[
                F.array_sort(F.collect_list(F.when(c, F.col("order_ym")))).alias(f"offending_months_{name}_{m}")
                for m, c in bad.items()
            ],
        )

    pairs = [(name, m) for name in ("base_vs_v", "mix_vs_v") for m in ("sales", "qty")]
    return one_row(compare(_recomputed(lines), "base_vs_v"), compare(resum(mix, ["order_ym"]), "mix_vs_v")).select(
        *[f"mismatch_months_{name}_{m}" for name, m in pairs], *[f"offending_months_{name}_{m}" for name, m in pairs]
    )


def health_summary(lines: DataFrame) -> DataFrame:
    counts = lines.agg(
        F.count("*").alias("rows_total"),
        F.count_if(F.col("order_qty") <= 0).alias("rows_qty_nonpositive"),
        F.count_if(F.col("total_sales") < 0).alias("rows_sales_negative"),
        F.count_if(F.col("product_price") <= 0).alias("rows_price_nonpositive"),
        F.count_if(F.col("order_date").isNull()).alias("rows_date_null"),
    )
    bad = [F.col(c) == 0 for c in counts.columns if c != "rows_total"]
    return counts.withColumn("is_basic_health_ok", reduce(lambda a, b: a & b, bad))


def problem_samples(lines: DataFrame, n: int = 5) -> DataFrame:
    """Newest ``n`` offending lines of each kind."""
    shown = ["order_date", "customer_sk", "product_sk", "order_qty", "product_price", "total_sales"]
    issues = {
        "qty_nonpositive": F.col("order_qty") <= 0,
        "sales_negative": F.col("total_sales") < 0,
        "price_nonpositive": F.col("product_price") <= 0,
    }
    parts = [
        lines.filter(rule).select(F.lit(issue).alias("issue"), *shown).orderBy(F.desc("order_date"), *shown[1:]).limit(n)
        for issue, rule in issues.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def kpi_semantics(monthly: DataFrame) -> DataFrame:
    counts = monthly.agg(
        F.count_if(F.col("asp").isNull()).alias("null_asp_months"),
        F.count_if(F.col("asp") < 0).alias("neg_asp_months"),
        F.count("*").alias("months_total"),
    )
    return counts.withColumn("is_kpi_semantics_ok", (F.col("null_asp_months") == 0) & (F.col("neg_asp_months") == 0))


def rfm_coverage(lines: DataFrame, rfm: DataFrame) -> DataFrame:
    no_score = F.col("r_score").isNull() | F.col("f_score").isNull() | F.col("m_score").isNull()
    counts = one_row(
        lines.agg(F.count_distinct("customer_sk").alias("customers")),
        rfm.agg(F.count("*").alias("rows"), F.count_if(no_score).alias("unscored")),
    )
    return counts.select(
        (F.col("customers") == F.col("rows")).alias("is_rfm_rowcount_match"),
        (F.col("unscored") == 0).alias("is_rfm_scores_not_null"),
    )


def cohort_semantics(cohort: DataFrame) -> DataFrame:
    k = F.col("months_since_first")
    off = F.abs(F.col("retention_rate") - 1.0) > COHORT_EPSILON
    counts = cohort.agg(F.count_if(k < 0).alias("neg_k_rows"), F.count_if((k == 0) & off).alias("bad_m0_rows"))
    return counts.withColumn("is_cohort_semantics_ok", (F.col("neg_k_rows") == 0) & (F.col("bad_m0_rows") == 0))


def pareto_curve(pareto: DataFrame, block: int = BLOCK_ROWS) -> DataFrame:
    """The curve must not fall along (rank, product key) and must end at 1.

    The products are numbered along that order over all tasks and compared with their predecessor inside blocks of at
    least ``block`` rows; the first row of a block is compared with the last of the block before.
    """
    share = F.col("cumulative_share")
    curve = pareto.select("product_sk", "sales_rank", "cumulative_share")
    numbered = global_row_number(curve, [F.col("sales_rank"), F.col("product_sk")], "position", "rows")
    blocked = numbered.withColumn("block", block_of("position", "rows", block))
    steps = blocked.withColumn("previous", F.lag(share).over(W.partitionBy("block").orderBy("position")))
    runs = steps.groupBy("block").agg(
        F.count_if(share < F.col("previous")).alias("falls"),
        F.min_by(share, "position").alias("first"),
        F.max_by(share, "position").alias("last"),
        F.max(share).alias("highest"),
    )
    between = (F.col("first") < F.lag("last").over(W.orderBy("block"))).cast("bigint")
    checked = runs.withColumn("falls", F.col("falls") + F.coalesce(between, F.lit(0)))
    counts = checked.agg(
        F.coalesce(F.sum("falls"), F.lit(0).cast("bigint")).alias("non_monotone_steps"),
        F.abs(1.0 - F.max("highest")).alias("tail_gap_from_one"),
    )
    return counts.withColumn(
        "is_pareto_curve_ok", (F.col("non_monotone_steps") == 0) & (F.col("tail_gap_from_one") < EPSILON)
    )


def clv_parity(lines: DataFrame, clv: DataFrame) -> DataFrame:
    totals = one_row(lines.agg(F.sum("total_sales").alias("base")), clv.agg(F.sum("revenue_total").alias("clv")))
    gap = F.col("base") - F.col("clv")
    return totals.select(
        F.round(gap, 3).alias("diff_sales_total"), (F.abs(gap).cast("double") < EPSILON).alias("is_clv_parity_ok")
    )


def column_rules(lines: DataFrame, dates: DataFrame, master: DataFrame | None = None) -> DataFrame:
    """Violations per column rule; a NULL violates a rule as well.

    ``lines`` are normalised already (fact with its dimensions); ``master`` holds the columns as they came.
    """

    def broken(rule: Column) -> Column:
        return F.count_if(~F.coalesce(rule, F.lit(False)))

    email, amount = F.col("customer_email"), F.col("order_qty").cast(C.QTY_TYPE) * F.col("product_price")
    line_rules = {
        "order_qty_positive": F.col("order_qty") > 0,
        "product_price_positive": F.col("product_price") > 0,
        "total_sales_consistent": (F.col("total_sales") == amount) & (F.col("total_sales") >= 0),
        "customer_email_normalised": email == F.lower(C.trim_all(email)),
        "customer_email_valid": C.is_email(email),
        "product_name_filled": ~C.is_blank("product_name"),
        "category_name_filled": ~C.is_blank("category_name"),
        "product_name_trimmed": F.col("product_name") == C.trim_all("product_name"),
        "category_name_trimmed": F.col("category_name") == C.trim_all("category_name"),
    }
    master_rules = {
        "master_email_normalised": F.col("cust_email") == F.lower(C.trim_all("cust_email")),
        "master_city_trimmed": (F.col("cust_city") == C.trim_all("cust_city")) & ~C.is_blank("cust_city"),
        "master_product_name_trimmed": F.col("product_name") == C.trim_all("product_name"),
        "master_category_name_trimmed": F.col("category_name") == C.trim_all("category_name"),
    }
    date_rules = {
        "date_key_eight_digits": F.col("date_key").between(10_000_101, 99_991_231),
        "date_key_matches_date": F.col("date_key") == C.date_key("date"),
    }

    def report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
        counts = df.agg(*[broken(rule).alias(name) for name, rule in rules.items()])
        return counts.unpivot([], list(rules), "rule", "violations")

    found = report(lines, line_rules).unionByName(report(dates, date_rules))
    return found if master is None else found.unionByName(report(master, master_rules))
