"""Customer sets, active months and quantile summaries on small rows."""

import random

from pyspark.sql import functions as F

from tillwright.operators import states


def test_numbers_are_dense_and_stay(spark):
    people = spark.createDataFrame([(f"p{i:02}", f"c{i % 3}") for i in range(20)] * 2 + [(None, "c1")], "cust_email string, cust_city string")
    first = states.customer_numbers(people.filter("cust_email < 'p12' OR cust_email IS NULL"))
    assert sorted(r["number"] for r in first.collect()) == list(range(1, 13))
    more = states.customer_numbers(people, first)
    assert sorted(r["number"] for r in more.collect()) == list(range(1, 21))
    assert set(first.collect()) <= set(more.collect())


def test_sets_of_many_customers(spark):
    """Numbers in several bitmaps, customers in several groups, and lines without a customer or a city."""
    lines = spark.range(100_000).select(
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("e"), (F.col("id") % 70_000).cast("string"))).alias("cust_email"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))).alias("cust_city"),
        F.lit("x").alias("category_name"),
        F.when(F.col("id") % 2 == 0, "2021-01").otherwise("2021-02").alias("order_ym"),
        (F.col("id") >= 70_000).alias("is_repeat_customer"),
        F.col("id").cast("decimal(38,9)").alias("total_sales"),
        F.lit(1).cast("long").alias("order_qty"),
    )
    numbers = states.customer_numbers(lines)
    sets, sums = states.customer_sets(lines, numbers), states.slice_sums(lines)
    assert sets.select("part").distinct().count() == 2 + 1
    exact = {
        r[0]: tuple(r[1:])
        for r in lines.groupBy("cust_city")
        .agg(
            F.count_distinct("cust_email"),
            F.count_distinct(F.when(~F.col("is_repeat_customer"), F.col("cust_email"))),
            F.count_distinct(F.when(F.col("is_repeat_customer"), F.col("cust_email"))),
            F.count("*"),
        )
        .collect()
    }
    found = states.sliced(sums, sets, ["cust_city"]).collect()
    assert {r["cust_city"]: (r["distinct_customers"], r["n_new_customers"], r["n_repeat_customers"], r["line_count"]) for r in found} == exact
    nobody = states.sliced(sums, sets, [], F.col("order_ym") == "1999-01").first()
    assert nobody["distinct_customers"] == 0 and nobody["sales"] is None


def test_active_months_merge(spark):
    rng = random.Random(4)
    months = [f"{y}-{m:02}" for y in (1899, 1959, 1960, 2021) for m in (1, 2, 6, 12)]
    rows = [(c, m) for c in range(30) for m in rng.sample(months, rng.randrange(1, 9))]
    lines = spark.createDataFrame(rows, "customer_sk long, order_ym string")
    whole = states.active_months(lines)
    parts = [states.active_months(lines.filter(F.col("order_ym").isin(months[i::3]))) for i in range(3)]
    assert sorted(states.merge_active_months(*parts).collect()) == sorted(whole.collect())
    gone = states.without_months(whole, months[:2])
    assert sorted(gone.collect()) == sorted(states.active_months(lines.filter(~F.col("order_ym").isin(months[:2]))).collect())
    number = lambda m: int(m[:4]) * 12 + int(m[5:])
    held = {c: sorted({number(m) for d, m in rows if d == c}) for c, _ in rows}
    expected = {}
    for ns in held.values():
        for n in ns:
            key = (f"{(ns[0] - 1) // 12}-{(ns[0] - 1) % 12 + 1:02}", n - ns[0])
            expected[key] = expected.get(key, 0) + 1
    found = {(r["cohort_ym"], r["months_since_first"]): r["active_customers"] for r in states.cohorts(whole).collect()}
    assert found == expected
    backs = [b for ns in held.values() for a, b in zip(ns, ns[1:], strict=False) if b - a > 5]
    assert sum(r["returned_customers"] for r in states.returns(whole, 5).collect()) == len(backs)


def test_quantile_errors_are_bounded(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), rng.choice([7, 7, rng.randrange(5000), rng.randrange(90)])) for _ in range(6000)] + [("a", None), (None, 3)]
    df = spark.createDataFrame(rows, "g string, v long")
    known = df.filter("g IS NOT NULL")
    wanted = {f"q{p}": p / 100 for p in (0, 1, 25, 50, 75, 99, 100)}
    for bins in (10, 50, 100_000):
        summary = states.quantile_summary(df, F.col("v"), F.col("g"), bins)
        assert summary.agg(F.sum("n")).first()[0] == 6000
        if bins == 50:
            assert summary.count() <= 2 * (2 * bins + 1)
        found = states.checked_quantiles(known, F.col("v"), states.merged_quantiles(summary, wanted), bins).collect()
        assert len(found) == len(wanted) and all(r["is_within_bound"] and r["is_interval_right"] for r in found)
        if bins == 100_000:
            assert all(r["rank_error"] == 0 for r in found)
    assert states.merged_quantiles(states.quantile_summary(df.filter("v < 0"), F.col("v"), F.col("g")), wanted).count() == 0


def test_rows_of_a_bitmap_are_brought_together_before_it_is_made(spark):
    """No exchange between the two halves of the aggregate: tasks would pass on a bitmap of 4 KB for almost every row."""
    lines = spark.createDataFrame([("a", "c", "x", "2021-01", True)], "cust_email string, cust_city string, category_name string, order_ym string, is_repeat_customer boolean")
    numbers = spark.createDataFrame([("a", 1)], "cust_email string, number long")
    plan = states.customer_sets(lines, numbers)._jdf.queryExecution().executedPlan().toString()
    last = plan.index("bitmap_construct_agg(")
    assert "Exchange" not in plan[last : plan.index("partial_bitmap_construct_agg(", last)]


def test_lines_are_exchanged_by_customer_and_by_bitmap_only(spark):
    """Two exchanges of lines: for the join with the numbers, and for the bitmaps."""
    lines = spark.createDataFrame([("a", "c", "x", "2021-01", True)], "cust_email string, cust_city string, category_name string, order_ym string, is_repeat_customer boolean")
    numbers = spark.createDataFrame([("a", 1)], "cust_email string, number long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = states.customer_sets(lines, numbers)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 3  # one of them of the numbers
