"""Enrichment, metrics, behaviour, guardrails and dashboard layer on hand-made rows."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tests.test_layers import line
from tillwright.operators import behaviour, enrich, guardrails, metrics, semantic, star
from tillwright.sources.sequences import fixed_bounds

D = datetime.date


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the lines belong to one customer, and a third of those are copies of one line; some have no email."""
    rnd = random.Random(3)
    data = []
    for i in range(600):
        email = "hot@x.org" if i % 3 == 0 else (None if i % 20 == 1 else f"c{rnd.randrange(40)}@x.org")
        if i % 9 == 0:
            data.append((email, "Oslo", D(2021, 1, 1), 1, "Robot", 10, "Kits"))
        else:
            product = rnd.randrange(8)
            data.append((email, rnd.choice(["Oslo", None]), D(2021, 1, 1 + rnd.randrange(20)), rnd.randrange(1, 4), f"P{product}", 5 * product + 1, f"K{product % 3}"))
    return line(spark, *data)


def plain_history(master):
    customer = W.partitionBy("cust_email")
    order = ["order_date", "product_name", "category_name", "product_price", "total_sales", "cust_city", "order_qty"]
    return master.withColumns(
        {
            "order_seq": F.row_number().over(customer.orderBy(*order)),
            "first_order_date": F.min("order_date").over(customer),
            "customer_ltv_gross": F.sum("total_sales").over(customer),
            "customer_total_lines": F.count("*").over(customer),
        }
    )


@pytest.mark.parametrize("copies", [1, 7, 1 << 16])
def test_history_equals_plain_windows(skewed, rows, copies, monkeypatch):
    monkeypatch.setattr(enrich, "_COPIES_PER_ROW", copies)
    want = plain_history(skewed)
    assert rows(enrich.with_customer_history(skewed).select(*want.columns)) == rows(want)


def test_history_with_missing_keys(spark, rows):
    """Lines without an email, day or product have their place, too; a text that reads as a key of another stays apart."""
    schema = "cust_email string, cust_city string, order_date date, order_qty long, product_name string, product_price decimal(18,9), category_name string, total_sales decimal(38,9)"
    days, names, emails = [None, datetime.date(1969, 12, 31), datetime.date(2021, 1, 5)], [None, "", "@", "a"], [None, "", "@", "x@y.zz"]
    data = [(e, "c", d, i, p, Decimal(i + 1), "k", Decimal(i)) for e in emails for d in days for p in names for i in (1, 2, 2)]
    master = spark.createDataFrame(data, schema)
    want = plain_history(master)
    assert rows(enrich.with_customer_history(master).select(*want.columns)) == rows(want)


def test_lines_are_exchanged_twice_for_their_history(spark):
    """Once to count identical ones, once by customer, day and product; the join with what lies before takes no third."""
    master = line(spark, ("a@b.cc", "c", datetime.date(2021, 1, 5), 1, "p", 1, "k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = enrich.with_customer_history(master)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") <= 8


@pytest.mark.parametrize("day_lines", [0, 5, 60])
@pytest.mark.parametrize("copies", [1, 7, 1 << 16])
def test_history_of_large_days(skewed, rows, day_lines, copies, monkeypatch):
    """Days with more lines than fit are cut by product; with those that are not they give what plain windows give."""
    monkeypatch.setattr(enrich, "DAY_LINES", day_lines)
    monkeypatch.setattr(enrich, "_COPIES_PER_ROW", copies)
    want = plain_history(skewed)
    assert rows(enrich.with_customer_history(skewed).select(*want.columns)) == rows(want)


def by_month(who, day):
    date = F.date_from_unix_date(day)
    return F.year(date) * 12 + F.month(date)


@pytest.mark.parametrize("day_lines", [0, 5, enrich.DAY_LINES])
def test_history_by_place(skewed, rows, day_lines, monkeypatch):
    """Lines that are brought together by month have the history that plain windows give, and each month is one task's."""
    monkeypatch.setattr(enrich, "DAY_LINES", day_lines)
    want = plain_history(skewed)
    found = enrich.with_customer_history(skewed, place=by_month)
    assert rows(found.select(*want.columns)) == rows(want)
    if day_lines != 5:  # or the lines of the two kinds of days are written by two tasks
        tasks = found.select(F.date_format("order_date", "yyyy-MM").alias("m"), F.spark_partition_id().alias("t")).groupBy("m").agg(F.count_distinct("t").alias("n"))
        assert {r["n"] for r in tasks.collect()} == {1}


def test_lines_brought_together_by_place_take_one_exchange(spark):
    """The lines pass through one exchange, and so does the row of a customer's day; no join follows."""
    master = line(spark, ("a@b.cc", "c", datetime.date(2021, 1, 5), 1, "p", 1, "k"))
    plan = enrich.with_customer_history(master, place=by_month)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2 and plan.count("REPARTITION_BY_COL") == 1


def test_lines_are_exchanged_once_for_their_history(spark):
    """By customer and day; all other exchanges have one row for each customer and day."""
    master = line(spark, ("a@b.cc", "c", datetime.date(2021, 1, 5), 1, "p", 1, "k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = enrich.with_customer_history(master)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") <= 3


def test_repeat_flag_by_line_and_by_day(spark, rows):
    sales = line(spark, ("a@x", "O", D(2021, 1, 1), 1, "A", 10, "K"), ("a@x", "O", D(2021, 1, 1), 1, "B", 10, "K"), ("a@x", "O", D(2021, 1, 2), 1, "A", 10, "K"))
    flags = lambda **kw: [r[1] for r in rows(enrich.with_customer_history(sales, **kw), "order_seq", "is_repeat_customer")]
    assert flags() == [False, True, True]
    assert flags(repeat_by_day=True) == [False, False, True]


def test_missing_city_and_price(spark):
    sales = line(spark, ("a@x", None, D(2021, 1, 1), 1, "A", None, "K"), ("a@x", "O", D(2021, 1, 1), 2, "A", 10, "K"))
    ext = enrich.master_sales_ext(sales)
    lost = ext.filter("cust_city IS NULL").first()
    assert (lost.price_bucket, lost.city_tier, lost.city_sales_total) == ("100+", "Tier 3 (Emerging)", None)
    nulls = enrich.qa_ext_nulls(ext).first()
    assert (nulls.null_city_tier, nulls.null_city_sales_total) == (0, 1)


def test_price_bucket_bounds(spark):
    prices = spark.createDataFrame([(p,) for p in (19.99, 20.0, 49.99, 50.0, 99.99, 100.0)], "p double")
    labels = [r[0] for r in prices.select(enrich.price_bucket("p")).collect()]
    assert labels == ["Under 20", "20–49.99", "20–49.99", "50–99.99", "50–99.99", "100+"]


@pytest.mark.parametrize("window_keys", [0, 1000])
def test_tiers_equal_plain_windows(skewed, rows, monkeypatch, window_keys):
    monkeypatch.setattr(enrich, "WINDOW_KEYS", window_keys)
    for key, sales, tile, tiers in (("cust_city", "city_sales", "city_ntile", enrich.city_tiers), ("category_name", "category_sales", "category_ntile", enrich.category_tiers)):
        for by in ([], ["order_year"]):
            totals = skewed.withColumn("order_year", F.year("order_date").cast("bigint")).groupBy(*by, key).agg(F.sum("total_sales").alias(sales))
            order = W.partitionBy(*by).orderBy(F.desc(sales), F.asc(key))
            want = totals.withColumn(tile, F.ntile(3).over(order).cast("bigint"))
            assert rows(tiers(skewed, bool(by)).select(*want.columns)) == rows(want)


def test_metrics_accept_lines_and_star_base(skewed, rows):
    lines = star.sales_lines(skewed)
    from tillwright.sources.sequences import date_bounds

    dates = star.dim_date(date_bounds(lines))
    customers, products = star.dim_customer(lines), star.dim_product(lines)
    base = star.v_base_sales(star.fact_sales(lines, dates, customers, products), dates, customers, products)
    for view in (
        metrics.v_category_performance,
        metrics.v_city_performance,
        metrics.v_mix_share_monthly,
        metrics.v_aov_city_monthly,
        metrics.v_aov_category_monthly,
        metrics.v_city_category_monthly,
    ):
        assert rows(view(lines)) == rows(view(base)), view.__name__


def test_missing_month_shifts_rows_unless_filled(spark):
    months = [f"2020-{m:02d}" for m in range(1, 13) if m != 6] + ["2021-01", "2021-02"]
    monthly = spark.createDataFrame([(ym, i + 1, 1, 1, 1.0) for i, ym in enumerate(months)], "order_ym string, sales long, qty long, active_customers long, asp double")
    last = lambda df: {r.order_ym: r.sales_last_year for r in df.collect()}
    by_row, by_month = last(metrics.v_sales_monthly_yoy(monthly)), last(metrics.v_sales_monthly_yoy(monthly, calendar=True))
    assert (by_row["2021-01"], by_row["2021-02"]) == (None, 1)
    assert (by_month["2021-01"], by_month["2021-02"], by_month["2020-06"]) == (1, 2, None)
    gaps = guardrails.month_coverage(monthly, fixed_bounds(monthly, "2020-01-01", "2021-02-28")).first()
    assert gaps.missing_months == ["2020-06"] and not gaps.is_no_gap and not gaps.is_month_count_match


def test_zero_quantity_month_has_no_price(spark):
    lines = star.sales_lines(line(spark, ("a@x", "O", D(2021, 1, 1), 0, "A", 10, "K")))
    monthly = metrics.v_sales_monthly(lines)
    assert monthly.first().asp is None
    assert tuple(guardrails.kpi_semantics(monthly).first()) == (1, 0, 1, False)


def test_rfm_breaks_ties_by_key(spark, rows):
    sales = line(spark, *[(f"c{i}@x.org", "O", D(2021, 1, 1), 1, "A", 10, "K") for i in range(7)])
    rfm = behaviour.view_rfm(star.sales_lines(sales))
    ordered = rows(rfm, "customer_sk", "f_score", "m_score", "r_score")
    assert [r[1] for r in ordered] == [r[2] for r in ordered] == [1, 1, 2, 2, 3, 4, 5]
    assert [r[3] for r in ordered] == [5, 5, 4, 4, 3, 2, 1]


def test_pareto_leaves_out_the_crossing_product(spark, rows):
    sales = line(spark, *[("a@x", "O", D(2021, 1, 1), 1, f"P{i}", p, "K") for i, p in enumerate((50, 25, 15, 6, 4))])
    pareto = behaviour.view_pareto_products(star.sales_lines(sales))
    assert rows(pareto, "sales_rank", "cumulative_share", "is_top_80_percent") == [
        (1, 0.5, True), (2, 0.75, True), (3, 0.9, False), (4, 0.96, False), (5, 1.0, False),
    ]
    assert tuple(guardrails.pareto_curve(pareto, block=2).first()) == (0, 0.0, True)
    for block in (1, 2, 100):
        broken = pareto.withColumn("cumulative_share", F.when(F.col("sales_rank") == 3, 0.1).otherwise(F.col("cumulative_share")))
        assert guardrails.pareto_curve(broken, block).first().non_monotone_steps == 1


def test_cohorts(spark, rows):
    sales = line(spark, ("a@x", "O", D(2021, 1, 31), 1, "A", 10, "K"), ("a@x", "O", D(2021, 2, 1), 1, "A", 10, "K"), ("b@x", "O", D(2021, 1, 2), 1, "A", 10, "K"))
    cohort = behaviour.view_monthly_cohort(star.sales_lines(sales))
    assert rows(cohort) == [("2021-01", 0, 2, 2, 1.0), ("2021-01", 1, 1, 2, 0.5)]
    assert guardrails.cohort_semantics(cohort).first().is_cohort_semantics_ok
    broken = guardrails.cohort_semantics(cohort.withColumn("retention_rate", F.lit(0.5))).first()
    assert (broken.bad_m0_rows, broken.is_cohort_semantics_ok) == (1, False)


def test_guardrails_fire(skewed):
    lines = star.sales_lines(skewed)
    monthly = metrics.v_sales_monthly(lines)
    mix = metrics.v_mix_share_monthly(lines)
    assert tuple(guardrails.sales_qty_parity(lines, monthly).first()) == (0, 0)
    off = monthly.withColumn("sales", F.col("sales") + 1)
    assert tuple(guardrails.sales_qty_parity(lines, off).first()) == (1, 0)
    assert tuple(guardrails.sales_qty_parity(lines, monthly.limit(0)).first()) == (1, 1)
    aov = metrics.v_aov_monthly(lines)
    assert guardrails.aov_parity(lines, aov).first()[0] == 0
    assert guardrails.aov_parity(lines, aov.withColumn("aov_proxy", F.col("aov_proxy") + 1)).first()[0] == 1
    months = guardrails.monthly_parity(lines, off, mix).first()
    assert months.offending_months_base_vs_v_sales == ["2021-01"] and months.offending_months_mix_vs_v_qty == []
    by_city = metrics.v_city_performance(lines)
    parity = guardrails.global_parity(lines, by_city, by_city, by_city.filter("city IS NOT NULL")).first()
    assert parity.diff_sales_city == 0 and parity.diff_qty_product > 0
    clv = behaviour.view_clv_simple(lines)
    assert guardrails.clv_parity(lines, clv).first().is_clv_parity_ok
    assert not guardrails.clv_parity(lines, clv.limit(1)).first().is_clv_parity_ok
    rfm = behaviour.view_rfm(lines)
    assert tuple(guardrails.rfm_coverage(lines, rfm).first()) == (True, True)
    assert tuple(guardrails.rfm_coverage(lines, rfm.withColumn("f_score", F.lit(None))).first()) == (True, False)


def test_health_and_column_rules_fire(spark, rows):
    sales = line(spark, ("a@x.org", "O", D(2021, 1, 1), 0, "A", 10, "K"), ("bad", "O", D(2021, 1, 2), -1, " ", 10, "K"), ("a@x.org", "O", D(2021, 1, 3), 1, "A", -1, "K"))
    lines = star.sales_lines(sales)
    health = guardrails.health_summary(lines).first()
    assert tuple(health) == (3, 2, 2, 1, 0, False)
    samples = rows(guardrails.problem_samples(lines, n=1), "issue", "order_date")
    assert samples == [("price_nonpositive", D(2021, 1, 3)), ("qty_nonpositive", D(2021, 1, 2)), ("sales_negative", D(2021, 1, 3))]
    dates = star.dim_date(fixed_bounds(lines, "2021-01-01", "2021-01-03")).withColumn("date_key", F.col("date_key") + 1)
    broken = dict(rows(guardrails.column_rules(lines, dates)))
    assert broken == {
        "order_qty_positive": 2,
        "product_price_positive": 1,
        "total_sales_consistent": 2,
        "customer_email_normalised": 0,
        "customer_email_valid": 1,
        "product_name_filled": 1,
        "category_name_filled": 0,
        "product_name_trimmed": 0,
        "category_name_trimmed": 0,
        "date_key_eight_digits": 0,
        "date_key_matches_date": 3,
    }
    loose = line(spark, (" A@x.org", "O ", D(2021, 1, 1), 1, "A ", 10, "K"), (None, None, D(2021, 1, 1), 1, "A", 10, "K"))
    as_it_came = dict(rows(guardrails.column_rules(lines, dates, loose)))
    assert [as_it_came[f"master_{n}"] for n in ("email_normalised", "city_trimmed", "product_name_trimmed", "category_name_trimmed")] == [2, 2, 1, 0]


def test_parameters(spark, skewed):
    ext = enrich.master_sales_ext(skewed)
    assert semantic.filter_customer_type(ext, "nobody").count() == 0
    new, repeat = (semantic.filter_customer_type(ext, t).count() for t in ("New", "Repeat"))
    assert new + repeat == ext.count() and new > 0
    with pytest.raises(ValueError):
        semantic.metric_picker("Profit")
    assert [r.value for r in semantic.parameter_domain(ext, "p_metric").collect()] == ["Sales", "Qty", "AOV"]
    assert semantic.parameter_domain(ext, "p_price_bucket").count() == 5
    assert semantic.dashboard_slice(ext, ["category_name"], {"p_city": "Oslo", "p_metric": "Qty"}).count() == 4
    plan = semantic.filter_year(spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumnRenamed("o_orderdate", "order_date"), 1998)
    assert "GreaterThanOrEqual(o_orderdate" in plan._jdf.queryExecution().executedPlan().toString()
