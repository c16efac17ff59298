import datetime

import pytest
from pyspark.sql import functions as F

from tillwright.functions import columns as C

D = datetime.date


def values(spark, data, column, data_type="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {data_type}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_safe_int(spark):
    assert values(spark, ["12", " 12 ", "2.5", "abc", "", None, "-7", "1e3"], C.safe_int("x")) == [12, 12, None, None, None, None, -7, None]


def test_safe_decimal(spark):
    got = values(spark, ["12", " 12.50 ", "abc", "", None], C.safe_decimal("x"))
    assert [None if v is None else float(v) for v in got] == [12.0, 12.5, None, None, None]


def test_safe_date_formats_in_turn(spark):
    text = ["2021-03-04", "2021-3-4", "03/04/2021", "13/04/2021", " 2021-03-04\t", "2021", "31/31/2021", "2021-02-30", "1/2/2021 9:00", None]
    march, april = D(2021, 3, 4), D(2021, 4, 13)
    assert values(spark, text, C.safe_date("x")) == [march, march, march, april, march, None, None, None, None, None]


def test_safe_date_custom_formats(spark):
    assert values(spark, ["03/04/2021", "3.4.2021"], C.safe_date("x", ["%d/%m/%Y", "%d.%m.%Y"])) == [D(2021, 4, 3)] * 2
    with pytest.raises(ValueError):
        C.safe_date("x", ["%Y%m%d"])


def test_clean_email(spark):
    text = ["a@h#mailto:a@h#", "mailto:A@h.c", "MAILTO:a@h.c", " a@h.c", "", None, "a@h.c trailing"]
    assert values(spark, text, C.clean_email("x")) == ["a@h", "a@h.c", "mailto:a@h.c", None, None, None, "a@h.c"]


def test_is_email(spark):
    assert values(spark, ["a@h.c", "a@h", "a b@h.c", "A@H.CO"], C.is_email("x")) == [True, False, False, True]


def test_text_helpers(spark):
    assert values(spark, ["\t a b \n", " x　"], C.trim_all("x")) == ["a b", "x"]
    assert values(spark, ["+1 (555) 007"], C.digits_only("x")) == ["1555007"]
    assert values(spark, [None, "", " \t", "x"], C.is_blank("x")) == [True, True, True, False]
    assert values(spark, ["Li", None], C.full_name("x", F.lit(None).cast("string"))) == ["Li", ""]


def test_week_starts_on_sunday(spark):
    # strftime %U is the same rule: week 0 before the first Sunday
    days = [D(2021, 1, 1), D(2021, 1, 2), D(2021, 1, 3), D(2020, 12, 31), D(2020, 2, 29), D(2023, 1, 1), D(2016, 12, 31)]
    assert values(spark, days, C.week_sunday("x"), "date") == [int(d.strftime("%U")) for d in days]


def test_calendar_parts(spark):
    day = [D(2021, 3, 7)]
    assert values(spark, day, C.day_of_week("x"), "date") == [1]
    assert values(spark, day, C.day_name("x"), "date") == ["Sun"]
    assert values(spark, day, C.date_key("x"), "date") == [20210307]
    assert values(spark, day, C.year_month("x"), "date") == ["2021-03"]
    assert values(spark, ["2021-03"], C.month_start("x")) == [D(2021, 3, 1)]


def test_month_difference_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(D(2021, 1, 31), D(2021, 2, 1)), (D(2021, 1, 1), D(2021, 1, 31)), (D(2020, 11, 5), D(2021, 2, 1))], "a date, b date"
    )
    assert [r[0] for r in df.select(C.month_diff("b", "a")).collect()] == [1, 0, 3]


def test_ratio_and_key(spark):
    one = spark.range(1)
    assert one.select(C.safe_ratio(F.lit(1), F.lit(0))).first()[0] is None
    assert one.select(C.growth(F.lit(3), F.lit(2))).first()[0] == 0.5
    keys = values(spark, ["A@h.c", " a@H.c ", None], C.customer_key("x"))
    assert keys[0] == keys[1] >= 0 and keys[2] is None


def test_dates_are_parsed_without_splitting_by_regular_expressions(spark, rows):
    texts = ["2021-03-04", "2021-3-4", "3/4/2021", "13/04/2021", "13/13/2021", "30/2/2021", "1/2/3/2021", "/1/2021", "1//2021", "01/02/21", " 1/2/2021 ", "", None, "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.safe_date("t").alias("d"))
    assert "split(" not in df._jdf.queryExecution().optimizedPlan().toString()
    found = {t: d and d.isoformat() for t, d in df.collect()}
    wanted = {"2021-03-04": "2021-03-04", "2021-3-4": "2021-03-04", "3/4/2021": "2021-03-04", "13/04/2021": "2021-04-13", " 1/2/2021 ": "2021-01-02"}
    assert found == {t: wanted.get(t) for t in texts}
