"""Sources, staging, master, star schema and the stored build on hand-made rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from tillwright.operators import enrich, master, profiling, star, staging
from tillwright.plans.layers import TABLES, build
from tillwright.sources import files, sequences
from tillwright.sources.retail import RawTables

D = datetime.date


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


@pytest.fixture(scope="module")
def raw(spark):
    return RawTables(
        customers=frame(
            spark,
            files.RAW_CUSTOMER,
            ("1", "Ann", " Lee ", "mailto:Ann@x.org", "+1 555", " a ", " Oslo ", "no", "007"),
            ("1", "Zoe", "Lee", "zoe@x.org", "1", "a", "Bergen", "no", "007"),
            ("2", None, "Ray", None, None, None, None, None, None),
            ("x3", "Bad", "Id", "b@x.org", "1", "a", "Oslo", "no", "1"),
        ),
        orders=frame(
            spark,
            files.RAW_ORDER,
            ("10", "2021-01-05", "1", "P1", "2"),
            ("10", "01/05/2021", "1", " P2 ", "1"),
            ("11", "25/12/2021", "2", "P1", "3"),
            ("12", "2021-02-01", "1", "P1", "0"),
            ("13", "2021-02-01", "1", "P1", "x"),
            ("14", "2021-02-30", "1", "P1", "1"),
            ("15", "2021-02-01", "9", "P1", "1"),
            ("16", "2021-02-01", "1", "P9", "1"),
            (None, "2021-02-01", "1", "P1", "1"),
        ),
        products=frame(
            spark,
            files.RAW_PRODUCT,
            ("P1", "Robot", "1", "n/a"),
            (" P1", "Robot", "1", "10.00"),
            ("P2", "Drone", "2", "60"),
            ("P3", "Free", "1", "0"),
            ("P4", "Lost", "bad", "5"),
        ),
        categories=frame(spark, files.RAW_CATEGORY, ("1", " Robots ", "rb"), ("2", "Drones", "dr"), ("1", "Zebra", "zz")),
    )


def test_first_row_per_key_is_the_smallest(spark, raw, rows):
    got = staging.stg_customers(raw.customers)
    assert rows(got, "CustomerID", "CustomerName", "CustomerEmail", "CustomerCity", "CustomerState", "CustomerPhone") == [
        (1, "Ann  Lee", "ann@x.org", "Oslo", "NO", "1555"),
        (2, "Ray", None, None, None, None),
    ]
    assert rows(staging.stg_product_category(raw.categories)) == [(1, "Robots", "RB"), (2, "Drones", "DR")]


def test_bad_copy_does_not_displace_a_good_one(raw, rows):
    assert rows(staging.stg_products(raw.products), "ProdNumber", "CategoryID", F.col("Price").cast("double")) == [
        ("P1", 1, 10.0),
        ("P2", 2, 60.0),
    ]


def test_orders_are_validated(raw, rows):
    customers, products = staging.stg_customers(raw.customers), staging.stg_products(raw.products)
    got = staging.stg_orders(raw.orders, customers, products)
    assert rows(got) == [
        (10, D(2021, 1, 5), 1, "P1", 2, "2021-01"),
        (10, D(2021, 1, 5), 1, "P2", 1, "2021-01"),
        (11, D(2021, 12, 25), 2, "P1", 3, "2021-12"),
    ]
    assert staging.stg_orders(raw.orders, customers, products, dedup=True).count() == 2
    orphans = staging.qa_orphans(staging.typed_orders(raw.orders), customers, products).first()
    assert tuple(orphans) == (1, 1)


def test_master_is_the_same_with_and_without_the_key_check(raw, rows):
    customers, products = staging.stg_customers(raw.customers), staging.stg_products(raw.products)
    categories = staging.stg_product_category(raw.categories)
    checked = master.master_sales(staging.stg_orders(raw.orders, customers, products), customers, products, categories)
    direct = master.master_sales(staging.typed_orders(raw.orders), customers, products, categories)
    assert rows(checked) == rows(direct)
    assert sorted(float(r.total_sales) for r in direct.collect()) == [20.0, 30.0, 60.0]


def test_huge_quantity_is_kept(spark):
    big = 9_000_000_000_000_000_000
    orders = frame(spark, "OrderID long, OrderDate date, CustomerID long, ProdNumber string, Quantity long", (1, D(2021, 1, 1), 1, "P", big))
    products = spark.sql("SELECT 'P' AS ProdNumber, 'p' AS ProdName, 1L AS CategoryID, CAST(99.99 AS decimal(18,2)) AS Price")
    customers = spark.sql("SELECT 1L AS CustomerID, 'a@b.c' AS CustomerEmail, 'x' AS CustomerCity")
    categories = spark.sql("SELECT 1L AS CategoryID, 'c' AS CategoryName")
    got = master.master_sales(orders, customers, products, categories).first()
    assert got.total_sales * 100 == big * 9999


def test_full_build(spark, raw, tmp_path, rows):
    stored = build(spark, raw, str(tmp_path))
    again = build(spark, raw, str(tmp_path))
    assert set(stored) == set(again) == set(TABLES)
    assert again["master_sales"].count() == 3
    assert again["master_sales_ext"].columns == list(enrich.EXT_COLUMNS)
    # the line without an email stays in the master and leaves at the fact
    assert tuple(star.qa_row_parity(again["master_sales"], again["fact_sales"]).first()) == (3, 2)
    assert again["dim_date"].count() == 1
    base = star.v_base_sales(again["fact_sales"], again["dim_date"], again["dim_customer"], again["dim_product"])
    assert rows(base, "customer_email", "product_name") == [("ann@x.org", "Drone"), ("ann@x.org", "Robot")]


MASTER = (
    "cust_email string, cust_city string, order_date date, order_qty long, product_name string, product_price decimal(18,2), "
    "category_name string, total_sales decimal(38,2)"
)


def line(spark, *data):
    """(email, city, date, qty, product, price, category) rows as a master table."""
    from decimal import Decimal

    full = [(e, c, d, q, p, None if x is None else Decimal(x), k, None if x is None else Decimal(x) * q) for e, c, d, q, p, x, k in data]
    return spark.createDataFrame(full, MASTER)


def test_two_cities_do_not_multiply_the_fact(spark, rows):
    sales = line(
        spark,
        ("A@x.org", "Oslo", D(2021, 1, 1), 1, "Robot", 10, "Kits"),
        ("a@x.org", "Bergen", D(2021, 3, 1), 1, "ROBOT", 10, "Kits"),
        ("a@x.org ", "Molde", D(2021, 3, 1), 1, "Robot", 10, "kits"),
    )
    lines = star.sales_lines(sales)
    customers, products = star.dim_customer(lines), star.dim_product(lines)
    assert rows(customers, "customer_email", "city") == [("a@x.org", "Molde")]
    assert rows(products, "product_name", "category_name") == [("Robot", "kits")]
    dates = star.dim_date(sequences.date_bounds(lines))
    fact = star.fact_sales(lines, dates, customers, products)
    assert fact.count() == 3 and star.v_base_sales(fact, dates, customers, products).count() == 3


def test_lines_outside_the_calendar_leave_at_the_fact(spark):
    sales = line(spark, ("a@x.org", "Oslo", D(2021, 1, 1), 1, "R", 10, "K"), ("a@x.org", "Oslo", D(2025, 1, 1), 1, "R", 10, "K"))
    lines = star.sales_lines(sales)
    dates = star.dim_date(sequences.fixed_bounds(lines, "2020-01-01", "2021-12-31"))
    assert dates.count() == 731
    assert star.fact_sales(lines, dates, star.dim_customer(lines), star.dim_product(lines)).count() == 1


def test_month_calendar(spark, rows):
    bounds = sequences.fixed_bounds(spark.range(1), "2020-01-15", "2021-12-31")
    months = rows(sequences.month_calendar(bounds))
    assert len(months) == 24 and months[0] == ("2020-01",) and months[-1] == ("2021-12",)


@pytest.mark.parametrize("lo,hi,block", [(0, 0, 4), (-5, 9, 4), (3, 10, 4), (1, 8, 8)])
def test_numbers(spark, lo, hi, block):
    bounds = spark.createDataFrame([(lo, hi)], "lo long, hi long")
    assert sorted(r.n for r in sequences.numbers(bounds, block).collect()) == list(range(lo, hi + 1))


@pytest.mark.parametrize("limit", [2, 50, None])
def test_id_gaps_against_brute_force(spark, limit):
    ids = {-3, -1, 0, 5, 65_534, 65_537, 140_000, 140_002}
    df = spark.createDataFrame([(str(i),) for i in ids] + [("5",), ("x",), (None,)], "id string")
    want = [i for i in range(-3, 140_003) if i not in ids]
    got = sorted(r.missing_id for r in profiling.id_gaps(df, "id", limit).collect())
    assert got == (want if limit is None else want[:limit])
    assert profiling.id_gaps(df.filter("id = 'x'"), "id").count() == 0


def test_id_gaps_of_far_ids(spark):
    df = spark.createDataFrame([("1",), ("3",), (str(10**18),)], "id string")
    assert sorted(r.missing_id for r in profiling.id_gaps(df, "id", 4).collect()) == [2, 4, 5, 6]


def test_duplicates_orphans_and_previews(spark, raw, rows):
    assert dict(rows(profiling.duplicate_keys(raw.named()))) == {
        "raw_customers": 1,
        "raw_orders": 1,
        "raw_product_category": 1,
        "raw_products": 0,
    }
    assert profiling.orphan_orders_no_product(raw.orders, raw.products).first()[0] == 2
    assert profiling.head_preview(raw.orders, 2).count() == 2
    snapshot = rows(files.schema_snapshot(spark, {"raw_orders": raw.orders}), "ordinal_position", "column_name", "data_type")
    assert snapshot[:2] == [(1, "OrderID", "string"), (2, "Date", "string")]


def test_csv_sources_and_sinks(spark, tmp_path, rows):
    (tmp_path / "people.csv").write_text(
        "IDKaryawan;NamaDepan;NamaBelakang;Jabatan;Email;HireDate;Extension\n"
        "7;Ann;Lee;Designer;ann@x.org#mailto:ann@x.org#;28/10/2012;1628\n"
    )
    people = files.clean_employees(files.read_csv(spark, str(tmp_path / "people.csv"), files.EMPLOYEE, sep=";"))
    assert rows(people, "IDKaryawan", "Email", "HireDate") == [(7, "ann@x.org", D(2012, 10, 28))]
    (tmp_path / "goods.csv").write_text("ProdNumber,ProdName,Category,Price\nB1,A Drone,1,9.99\n")
    goods = files.read_csv(spark, str(tmp_path / "goods.csv"), files.RAW_PRODUCT)
    assert rows(goods) == [("B1", "A Drone", "1", "9.99")]
    files.write_csv(goods, str(tmp_path / "out"))
    assert rows(files.read_csv(spark, str(tmp_path / "out"), files.RAW_PRODUCT)) == rows(goods)
    files.write_parquet(goods, str(tmp_path / "table"), ["Category"])
    assert rows(spark.read.parquet(str(tmp_path / "table")), "ProdNumber") == [("B1",)]
    for _ in range(2):
        files.write_table(goods, "stored_goods", ["Category"])
    assert rows(files.read_table(spark, "stored_goods"), "ProdNumber", "Price") == [("B1", "9.99")]
    files.register_views({"goods": goods})
    assert files.read_table(spark, "goods").count() == 1


def test_csv_rows_that_do_not_fit_are_kept_apart(spark, tmp_path, rows):
    source = tmp_path / "in"
    source.mkdir()
    (source / "good.csv").write_text('ProdNumber,ProdName,Category,Price\nB1,"Drone, small",1,9.99\nB2,short,1\nB3,long,1,2,3\n\nB4,,2,\nProdNumber,ProdName,Category,Price\nB5,"a ""b""",1,1\n')
    (source / "other.csv").write_text("ProdNumber,Price,Category,ProdName\nC1,9.99,1,Kite\n")
    load = files.load_csv(spark, str(source), files.RAW_PRODUCT, str(tmp_path / "load"))
    assert rows(load.clean) == [("B1", "Drone, small", "1", "9.99"), ("B4", None, "2", None), ("B5", 'a "b"', "1", "1")]
    assert rows(load.clean, "Price") == [(None,), ("1",), ("9.99",)]
    assert rows(load.quarantine, "reason", "record") == [
        ("header", "C1,9.99,1,Kite"),
        ("header", "ProdNumber,Price,Category,ProdName"),
        ("too few columns", "B2,short,1"),
        ("too many columns", "B3,long,1,2,3"),
    ]
    assert rows(load.report, "n_rows", "clean_rows", "bad_rows", "too_few_columns") == [(2, 0, 2, 0), (5, 3, 2, 1)]
    assert rows(files.load_csv(spark, str(source / "good.csv"), files.RAW_PRODUCT, str(tmp_path / "again")).clean, "ProdNumber") == [("B1",), ("B4",), ("B5",)]


def test_dimensions_from_spellings_equal_those_from_lines(spark, rows):
    some = lambda *x: [None, *x]
    days = some(datetime.date(2021, 1, 5), datetime.date(2021, 2, 1))
    data = [(e, c, d, 1, p, 1, k) for e in some("A@b.cc", " a@b.cc", "") for c in some("X", "x ", " X") for d in days for p in some("p", "P ") for k in some("k")]
    master = line(spark, *data)
    lines = star.sales_lines(master)
    assert rows(star.dim_customer(star.customer_lines(master))) == rows(star.dim_customer(lines))
    assert rows(star.dim_product(star.product_lines(master))) == rows(star.dim_product(lines))
    assert rows(star.customer_months(master).distinct()) == rows(lines.select("customer_sk", "order_ym").distinct())
    assert rows(star.sold_dates(master)) == rows(lines.select("order_date"))
