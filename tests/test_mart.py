"""The versioned mart: refreshes that write what has changed only, failed tests, pruning, and views in another session."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillwright.functions import columns as C
from tillwright.operators import enrich
from tillwright.operators import semantic as sl
from tillwright.plans import mart
from tillwright.plans.layers import Layers
from tillwright.plans.views import VIEWS
from tillwright.session import lean_disk
from tillwright.sources.retail import RawTables


def with_orders(raw, change):
    return RawTables(raw.customers, change(raw.orders), raw.products, raw.categories)


@pytest.fixture(scope="module")
def raw(spark):
    """The lines of one year, so that there are few files."""
    return with_orders(Layers.from_test_data(spark, SMALL).raw, lambda o: o.filter(C.year(C.safe_date("Date")) == 1996))


def in_march(orders, every=7):
    month = C.year_month(C.safe_date("Date"))
    return F.coalesce((month == "1996-03") & (C.safe_int("OrderID") % every == 0), F.lit(False))


@pytest.fixture(scope="module")
def refreshed(spark, raw, tmp_path_factory):
    """A mart whose first version lacks some lines of a month and has others with another quantity."""
    folder = str(tmp_path_factory.mktemp("mart"))
    earlier = with_orders(raw, lambda o: o.filter(~in_march(o, 40)).withColumn("Quantity", F.when(in_march(o, 35), "7").otherwise(F.col("Quantity"))))
    first = mart.refresh(spark, earlier, folder, buckets=4)
    listed = {t: set(glob.glob(f"{folder}/{t}/run=*/**/part-*", recursive=True)) for t in [*mart.LINE_TABLES, mart.EXT]}
    return first, mart.refresh(spark, raw, folder, buckets=4), listed


@pytest.fixture(scope="module")
def full(spark, raw, tmp_path_factory):
    return mart.refresh(spark, raw, str(tmp_path_factory.mktemp("full")), buckets=4)


def contents(version, table):
    return {(p.month, p.bucket): p.content for p in version.of(table)}


def test_fingerprint_sums_all_bits_of_the_hashes(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("text"))
    h = F.xxhash64("id", F.col("id").isNull(), "text", F.col("text").isNull())
    want = df.agg(F.count("*"), F.sum(h.cast("decimal(28,0)")).cast("string"), F.bit_xor(h)).first()
    assert tuple(df.agg(*mart.fingerprint(df.columns)).first()) == tuple(want)
    assert tuple(df.limit(0).agg(*mart.fingerprint(df.columns)).first()) == (0, "0", 0)


def test_lines_of_the_master_keep_the_keys_of_the_star(refreshed):
    _, latest, _ = refreshed
    keys = ["customer_sk", "product_sk"]
    hashed = latest.master.select(C.customer_key("cust_email").alias("c"), C.product_key("product_name", "category_name").alias("p"))
    assert latest.table("master_sales").select(*keys).exceptAll(hashed).isEmpty()


def test_refresh_equals_full_build(refreshed, full):
    _, latest, _ = refreshed
    for table in {p.table_name for p in full.parts}:
        assert contents(latest, table) == contents(full, table), table
    assert latest.ext.exceptAll(full.ext).isEmpty() and full.ext.exceptAll(latest.ext).isEmpty()
    assert full.ext.columns == list(enrich.EXT_COLUMNS)


def test_refresh_leaves_other_months_alone(refreshed):
    first, latest, before = refreshed
    written = {r["table_name"]: (r["parts"], r["written"]) for r in mart.changed_parts(first, latest).collect()}
    for table in mart.LINE_TABLES:
        assert written[table] == (12, 1)
    parts, rewritten = written[mart.EXT]
    assert 0 < rewritten < parts
    # The files of every other part are still there under their names, and are what is read.
    for table, count, fresh in (("master_sales", 12, 1), (mart.EXT, parts, rewritten)):
        used = {r[0] for r in latest.table(table).select(F.input_file_name()).distinct().collect()}
        assert len(used) == count and len({f.removeprefix("file://") for f in used} & before[table]) == count - fresh
    for table in ("stg_customers", "stg_products", "dim_date"):
        assert written[table] == (1, 0)


def test_states_of_other_months_stay(spark, raw, refreshed, full, tmp_path):
    """Lines written anew for their sequence or lifetime value leave the states of their month alone; a month in which a line
    turns from a repeated to a first one does not."""
    first, latest, _ = refreshed
    for table in ("customer_sets", "slice_sums"):
        old = {(p.month, p.run) for p in first.of(table)}
        fresh = {p.month for p in latest.of(table) if (p.month, p.run) not in old}
        lines = {p.month for p in latest.of(mart.EXT) if p not in first.parts}
        assert "1996-03" in fresh and fresh < lines, table
    # The earlier version has lines of one customer in February that are gone later: a line of another month becomes the first.
    ranked = full.ext.filter("cust_email IS NOT NULL AND order_seq = 1 AND order_ym > '1996-02'").orderBy("cust_email").first()
    buyer = full.customers.filter(F.col("CustomerEmail") == ranked["cust_email"]).agg(F.min("CustomerID")).scalar()
    of_buyer = (C.safe_int("CustomerID") == buyer) & (C.year_month(C.safe_date("Date")) == ranked["order_ym"])
    earlier = with_orders(raw, lambda o: o.unionByName(o.filter(of_buyer).withColumn("Date", F.lit("1996-02-01"))))
    before = mart.refresh(spark, earlier, str(tmp_path), buckets=4, ranked=False)
    after = mart.refresh(spark, raw, str(tmp_path), buckets=4, ranked=False)
    for table in (mart.EXT, "customer_sets", "slice_sums"):
        assert contents(after, table) == contents(full, table), table
        fresh = {p.month for p in after.of(table) if p not in before.parts}
        assert {"1996-02", ranked["order_ym"]} <= fresh, table
        assert table == mart.EXT or fresh == {"1996-02", ranked["order_ym"]}


def test_nothing_changed_makes_no_version(spark, raw, refreshed):
    _, latest, _ = refreshed
    assert mart.refresh(spark, raw, latest.folder, buckets=4).version == latest.version == 2
    assert mart.versions(spark, latest.folder) == [1, 2]


def test_earlier_version_is_still_read(refreshed, rows):
    first, latest, _ = refreshed
    months = {m: n for m, n in first.monthly.select("order_ym", "qty").collect()}
    now = {m: n for m, n in latest.monthly.select("order_ym", "qty").collect()}
    assert {m for m in now if now[m] != months[m]} == {"1996-03"}
    found = mart.reconcile(first, latest).collect()
    assert [r["order_ym"] for r in found] == ["1996-03"] and found[0]["only_after"] > found[0]["only_before"] > 0
    plan = mart.reconcile(first, latest)._jdf.queryExecution().executedPlan().toString()
    assert "1996-03" in plan and "1996-04" not in plan


def test_customers_and_products_reach_their_months(spark, raw, full, tmp_path_factory, rows):
    """A customer moves and a product changes its price: their months are written, with lines of nobody else changed."""
    folder = str(tmp_path_factory.mktemp("moved"))
    buyer, goods = full.orders.orderBy("CustomerID", "ProdNumber").select("CustomerID", "ProdNumber").first()
    moved = F.when(C.safe_int("CustomerID") == buyer, "ELSEWHERE").otherwise(F.col("CustomerCity"))
    dearer = F.when(C.trim_all("ProdNumber") == goods, "123.45").otherwise(F.col("Price"))
    earlier = RawTables(raw.customers.withColumn("CustomerCity", moved), raw.orders, raw.products.withColumn("Price", dearer), raw.categories)
    first = mart.refresh(spark, earlier, folder, buckets=4, ranked=False)
    latest = mart.refresh(spark, raw, folder, buckets=4, ranked=False)
    for table in ("master_sales", "fact_sales", mart.EXT, "dim_customer", "dim_product", "city_tiers"):
        assert contents(latest, table) == contents(full, table), table
    touched = {r[0] for r in full.orders.filter((F.col("CustomerID") == buyer) | (F.col("ProdNumber") == goods)).select("order_ym").distinct().collect()}
    written = {p.month for p in latest.of("master_sales")} - {p.month for p in first.of("master_sales") if p in latest.parts}
    assert written == touched


def test_failed_tests_keep_the_last_version(spark, raw, refreshed, monkeypatch):
    _, latest, _ = refreshed
    monkeypatch.setitem(mart.TESTS, "fact_sales", {"too_many_units": "order_qty > 49"})
    more = with_orders(raw, lambda o: o.withColumn("Quantity", F.when(in_march(o, 3), "50").otherwise(F.col("Quantity"))))
    with pytest.raises(mart.FailedTests, match="fact_sales.too_many_units"):
        mart.refresh(spark, more, latest.folder, buckets=4)
    assert mart.versions(spark, latest.folder)[-1] == latest.version
    runs = {p.run for p in mart.Mart(spark, latest.folder, 1).parts + latest.parts}
    assert {os.path.basename(f)[4:] for f in glob.glob(f"{latest.folder}/*/run=*")} == runs


def test_tests_are_counted_while_writing(full, raw):
    assert full.facts["master_sales.rows"] == full.master.count() and full.facts["master_sales.invalid_price"] == 0
    assert full.facts["fact_sales.rows"] == full.table("fact_sales").count()


def test_dates_prune_months(full):
    spring = sl.filter_dates(full.table(mart.EXT), F.lit("1996-03-01").cast("date"), F.lit("1996-06-01").cast("date"))
    assert {r[0] for r in spring.select("order_ym").distinct().collect()} == {"1996-03", "1996-04", "1996-05"}
    scanned = spring.select("order_date", "total_sales")
    scanned.collect()
    scan = scanned._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert 0 < scan.metrics().apply("numFiles").value() <= 3 * 4 < len(full.of(mart.EXT))
    year = sl.filter_year(full.ext, 1996)._jdf.queryExecution().executedPlan().toString()
    assert "1996-01" in year.split("PartitionFilters: [", 1)[1].split("], PushedFilters")[0]
    assert full.latest_months(1) == [full.months[-1]] == ["1996-12"]
    assert full.spot_check().collect() == mart.master.master_spot_check(full.master).collect()


def test_states_answer_without_lines(refreshed, full):
    """Slices, cohorts and quantiles of the refreshed mart are those of the full one, and their plans read no line."""
    _, latest, _ = refreshed
    for ask in (
        lambda m: m.slice(["cust_city"]),
        lambda m: m.slice([], F.col("order_ym") >= "1996-06"),
        lambda m: m.cohorts,
        lambda m: m.returns(1),
        lambda m: m.quantiles("order_qty", {"median": 0.5}, ["1996-03", "1996-04"]),
    ):
        found = ask(latest)
        assert sorted(map(str, found.collect())) == sorted(map(str, ask(full).collect())) != []
        plan = found._jdf.queryExecution().toString()
        assert "ext_lines" not in plan and "master_sales" not in plan and "fact_sales" not in plan
    whole = full.slice().first()
    people = full.ext.agg(F.count_distinct("cust_email"), F.count("*")).first()
    assert (whole["distinct_customers"], whole["line_count"]) == tuple(people)


def test_views_by_name_in_another_session(spark, refreshed):
    """A session that knows nothing but the folder reads all views; the ranked ones are not sorted again."""
    _, latest, _ = refreshed
    other = spark.newSession()
    mart.Mart(other, latest.folder).register_views(VIEWS)
    for name in VIEWS:
        assert other.sql(f"SELECT * FROM {name}").count() > 0, name
    for name in mart.RANKED:
        plan = other.table(name)._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and f"/{name}" in plan


def test_old_files_go(spark, refreshed, full):
    _, latest, _ = refreshed
    mart.drop_old(latest)
    assert mart.versions(spark, latest.folder) == [2]
    assert len(glob.glob(f"{latest.folder}/master_sales/run=*/order_ym=*")) == 12
    assert len(glob.glob(f"{latest.folder}/{mart.EXT}/run=*/order_ym=*/bucket=*")) == len(latest.of(mart.EXT))
    again = mart.Mart(spark, latest.folder)
    assert contents(again, "master_sales") == contents(full, "master_sales") and again.ext.count() == full.ext.count()


def test_lines_are_joined_once_and_written_as_they_lie(spark, raw, full, tmp_path, monkeypatch):
    """The staged lines, the master and the fact are written without a join or an exchange of their own."""
    plans, write = {}, mart.files.write_parquet

    def kept(df, path, *options):
        plans[path.split("/")[-2]] = df._jdf.queryExecution().executedPlan().toString()
        write(df, path, *options)

    monkeypatch.setattr(mart.files, "write_parquet", kept)
    made = mart.refresh(spark, raw, str(tmp_path), buckets=4, ranked=False)
    for table in ("stg_orders", "master_sales", "fact_sales"):
        assert "Join" not in plans[table] and "Exchange" not in plans[table], table
        assert contents(made, table) == contents(full, table)
    assert made.orders.exceptAll(Layers(raw).orders.select(*made.orders.columns)).isEmpty() and made.orders.count() == Layers(raw).orders.count()


def test_products_without_category_stay_staged(spark):
    """A line whose product has no category that survives is a staged line and none of the master."""
    customers = spark.createDataFrame([(1, "a@x.org", "Aa"), (2, None, None)], "CustomerID long, CustomerEmail string, CustomerCity string")
    products = spark.createDataFrame([("P1", "One", 1, 2.5), ("P2", "Two", 9, 3.0)], "ProdNumber string, ProdName string, CategoryID long, Price double")
    products = products.withColumn("Price", F.col("Price").cast(C.PRICE_TYPE))
    categories = spark.createDataFrame([(1, None)], "CategoryID long, CategoryName string")
    rows = [(7, c, p, 2) for c in (1, 2, 3, None) for p in ("P1", "P2", "P3", None)] * 2
    orders = spark.createDataFrame(rows, "OrderID long, CustomerID long, ProdNumber string, Quantity long")
    orders = orders.withColumns({"OrderDate": F.lit("2021-03-04").cast("date"), "order_ym": F.lit("2021-03")}).select(*mart.staging.ORDER_COLUMNS)
    staged = mart.master.staged_lines(orders, customers, products, categories)
    assert sorted(map(str, staged.select("CustomerID", "ProdNumber").collect())) == sorted(
        f"Row(CustomerID={c}, ProdNumber='{p}')" for c in (1, 2) for p in ("P1", "P2") for _ in range(2)
    )
    plain = mart.master.master_sales(orders, customers, products, categories, keys=True)
    found = mart.master.master_of_staged(staged).drop("order_ym")
    assert found.schema == plain.schema and sorted(map(str, found.collect())) == sorted(map(str, plain.collect())) and found.count() == 4


def test_only_months_that_may_have_changed_are_joined(spark, raw, refreshed, full, tmp_path, monkeypatch):
    """A refresh joins the typed lines of the months with other hashes only; a line without a customer makes no version."""
    joined, partners = [], mart.staging.with_partners

    def seen(typed, customers, products):
        joined.append({r[0] for r in typed.select("order_ym").distinct().collect()})
        return partners(typed, customers, products)

    folder = str(tmp_path)
    first = mart.refresh(spark, raw, folder, buckets=4, ranked=False)
    monkeypatch.setattr(mart.staging, "with_partners", seen)
    nobody = with_orders(raw, lambda o: o.unionByName(o.filter(in_march(o)).withColumn("CustomerID", F.lit("-5"))))
    assert mart.refresh(spark, nobody, folder, buckets=4, ranked=False).version == first.version
    more = with_orders(raw, lambda o: o.unionByName(o.filter(in_march(o))))
    assert mart.refresh(spark, more, folder, buckets=4, ranked=False).version == first.version + 1
    assert mart.refresh(spark, raw, folder, buckets=4, ranked=False).version == first.version + 2
    assert joined == [{"1996-03"}] * 3
    latest = mart.Mart(spark, folder)
    for table in ("stg_orders", "master_sales", mart.EXT, mart.TYPED):
        assert contents(latest, table) == contents(full, table), table


def test_lines_of_other_customers_are_written_as_they_lie(spark, raw, full, tmp_path, monkeypatch):
    """In large parts the lines of unchanged customers pass through no exchange; parts of many files are brought together."""
    monkeypatch.setattr(mart, "SMALL_PART", 1)
    monkeypatch.setattr(mart, "FILE_LINES", 20)  # several places to a part
    plans, placed, write = {}, {}, mart.files.write_parquet

    def kept(df, path, *options):
        table = path.split("/")[-2]
        plans[table], placed[table] = df._jdf.queryExecution().executedPlan().toString(), options[1:] == (True,)
        write(df, path, *options)

    monkeypatch.setattr(mart.files, "write_parquet", kept)
    folder, earlier = str(tmp_path), with_orders(raw, lambda o: o.withColumn("Quantity", F.when(in_march(o), "7").otherwise(F.col("Quantity"))))
    first = mart.refresh(spark, earlier, folder, buckets=4, ranked=False)
    assert plans[mart.EXT].count("REPARTITION_BY_COL") == 1 and placed[mart.EXT]
    files = len(glob.glob(f"{folder}/{mart.EXT}/run=*/*/*/part-*"))
    assert files <= mart.PART_FILES * len(first.of(mart.EXT))
    latest = mart.refresh(spark, raw, folder, buckets=4, ranked=False)
    stays = plans[mart.EXT].split("REBALANCE")[0]
    assert placed[mart.EXT] and "BroadcastHashJoin" in stays
    assert "SortMergeJoin" not in stays and stays.count("Exchange hashpartitioning") <= 1  # that of the few fresh lines
    assert contents(latest, mart.EXT) == contents(full, mart.EXT)
    monkeypatch.setattr(mart, "PART_FILES", 0)
    again = mart.refresh(spark, earlier, folder, buckets=4, ranked=False)
    assert not placed[mart.EXT] and contents(again, mart.EXT) == contents(first, mart.EXT)


def test_typed_and_staged_lines_go_when_the_master_is_written(spark, raw, tmp_path, monkeypatch):
    shared, seen, enriched = spark.conf.get("spark.checkpoint.dir"), set(), mart.enrich.with_line_columns

    def kept(*args, **options):
        seen.update(os.path.basename(p) for p in glob.glob(f"{shared}/tillwright-*"))
        return enriched(*args, **options)

    before = {os.path.basename(p) for p in glob.glob(f"{shared}/tillwright-*")}
    monkeypatch.setattr(mart.enrich, "with_line_columns", kept)
    made = mart.refresh(spark, raw, str(tmp_path), buckets=4, ranked=False)
    assert {f.rsplit("-", 1)[0] for f in seen - before} >= {"tillwright-hashes"}
    assert not {f.rsplit("-", 1)[0] for f in seen - before} & {"tillwright-orders", "tillwright-staged"}
    assert {os.path.basename(p) for p in glob.glob(f"{shared}/tillwright-*")} <= before
    written = glob.glob(f"{made.folder}/{mart.EXT}/run=*/**/part-*", recursive=True)
    assert written and all(".zstd." in f for f in written)


def test_shuffles_go_with_their_action(spark, tmp_path):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def shuffles():
        return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}

    def left(name):
        before = shuffles()
        spark.range(1000).groupBy(F.col("id") % 7).count().write.parquet(str(tmp_path / name))
        for _ in range(50):
            if not shuffles() - before:
                break
            time.sleep(0.1)
        return shuffles() - before

    assert left("plain")
    setting = spark.conf.get("spark.sql.parquet.compression.codec")
    with lean_disk(spark):
        assert not left("lean")
    assert spark.conf.get("spark.sql.parquet.compression.codec") == setting and left("after")
