"""A stored mart that is refreshed month by month, and read by version.

A version is one small table: which run wrote each table, month and bucket of the mart, with the number of its rows and
an order-independent hash over them. Writing it switches all tables at once; readers of an earlier version go on reading
the files they began with. A refresh

* compares the hashes of the typed lines by month, and looks for the months of customers and products that have changed; of
  these months only it joins the lines with customers and products, to see whether their staged lines have changed;
* writes the lines of these months again;
* compares the old and new lines of these months by customer, and writes the enriched lines of the customers that differ,
  in whatever month they are: first purchase, sequence and lifetime value hang on all lines of a customer. The enriched
  lines are stored by month and bucket of customers, and only buckets with such a line are written;
* writes a small table only if its hash has changed.

Beside the lines, a version holds states by month (``operators.states``): customer sets, sums of slices, months in which
customers were active, quantile summaries. They are written with the months they are made of, and merged when asked.

What hangs on all lines (the tiers of cities and categories) is not stored with the lines but looked up when they are
read. Rows are counted and tested while they are written, and a version whose tests fail is never made.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import cached_property, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.functions import columns as C
from tillwright.functions.columns import PRICE_TYPE
from tillwright.operators import behaviour, enrich, master, metrics, star, staging, states
from tillwright.operators.combine import join_lines
from tillwright.plans.layers import Layers
from tillwright.session import discard, lean_disk, materialise, open_writers, temporary_tables, together
from tillwright.sources import files, retail
from tillwright.sources.sequences import date_bounds

# Buckets of customers that a month of enriched lines is split into. More of them make a refresh write less.
BUCKETS = 8
MONTH, BUCKET, RUN = "order_ym", "bucket", "run"
LINE_TABLES = ("stg_orders", "master_sales", "sales_months", "fact_sales", "line_quantiles")
EXT = "ext_lines"
# Hashes of the typed lines by month.
TYPED = "typed_months"
# A part of the enriched lines has another file for each so many of its lines.
FILE_LINES = 500_000
# Parts with fewer lines are brought together in one file each when some of their lines are written anew.
SMALL_PART = 50_000
# Up to so many customers with changed lines are broadcast.
FEW_CUSTOMERS = 500_000
# Parts with more files than this are brought together, too.
PART_FILES = 8
# What the states made of enriched lines take from them.
STATE_COLUMNS = (*states.SLICE, "cust_email", "order_qty", "total_sales")
# Values of lines that are summarised by month.
MEASURES = ("order_qty", "total_sales")
# Views whose rows are ranked over all lines; they are stored with a version, so that reading them sorts nothing.
RANKED = {"v_top_products": metrics.v_top_products, "view_rfm": behaviour.view_rfm, "view_pareto_products": behaviour.view_pareto_products}

# Tests of lines while they are written: none may hold for any line.
TESTS: dict[str, dict[str, str]] = {
    "master_sales": {
        "null_order_date": "order_date IS NULL",
        "invalid_qty": "order_qty IS NULL OR order_qty <= 0",
        "invalid_price": "product_price IS NULL OR product_price <= 0",
    },
    EXT: {
        "null_first_order_date": "first_order_date IS NULL",
        "bad_order_seq": "order_seq IS NULL OR order_seq < 1 OR order_seq > customer_total_lines",
        "null_price_bucket": "price_bucket IS NULL",
    },
    "fact_sales": {
        "null_date_key": "date_key IS NULL",
        "null_customer_sk": "customer_sk IS NULL",
        "null_product_sk": "product_sk IS NULL",
        "sales_negative": "total_sales IS NULL OR total_sales < 0",
    },
}


class FailedTests(ValueError):
    """Lines that break a test; the version they were written for has not been made."""


class Part(NamedTuple):
    """One stored piece of a table: a month (and bucket) of a line table, or a whole small table."""

    table_name: str
    month: str | None
    bucket: int | None
    run: str
    n_rows: int
    hash_sum: str
    hash_xor: int
    schema: str

    @property
    def content(self) -> tuple:
        return self.n_rows, self.hash_sum, self.hash_xor

    @property
    def place(self) -> str:
        return "/".join([self.run, *(str(x) for x in (self.month, self.bucket) if x is not None)])


_PARTS = "table_name string, month string, bucket int, run string, n_rows long, hash_sum string, hash_xor long, schema string"


def fingerprint(columns: Iterable[str]) -> list[Column]:
    """Aggregates that tell one multiset of rows from another, whatever their order: number, sum and exclusive or of
    hashes. Missing values are hashed by their place. The halves of a hash are summed as longs, which hold the sums of
    2,147,483,648 rows; decimals would take most of the time."""
    h = F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])
    high, low = (F.sum(half).cast("decimal(20,0)") for half in (F.shiftright(h, 32), h.bitwiseAND(0xFFFFFFFF)))
    total = F.coalesce((high * F.lit(1 << 32).cast("decimal(10,0)") + low).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).cast("string")
    return [F.count(F.lit(1)).alias("n_rows"), total.alias("hash_sum"), F.coalesce(F.bit_xor(h), F.lit(0).cast("long")).alias("hash_xor")]


def _hadoop(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _delete(spark: SparkSession, path: str) -> None:
    system, found = _hadoop(spark, path)
    system.delete(found, True)


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete versions under ``folder``, ascending."""
    system, found = _hadoop(spark, f"{folder.rstrip('/')}/versions/*/_SUCCESS")
    return sorted(int(status.getPath().getParent().getName()) for status in system.globStatus(found) or [])


class Mart(Layers):
    """One version of a stored mart (by default the latest), with the tables and views of ``Layers``.

    Line tables carry ``order_ym``, the month they are stored by, so that a filter on it (``semantic.filter_year`` adds
    one) opens the files of these months only.
    """

    def __init__(self, spark: SparkSession, folder: str, version: int | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        found = versions(spark, folder)
        if not found:
            raise ValueError(f"no complete version of a mart in {folder}")
        self.version = found[-1] if version is None else version
        rows = spark.read.schema(_PARTS + ", facts string").parquet(f"{self.folder}/versions/{self.version:08d}").collect()
        self.facts: dict[str, int] = next((json.loads(r["facts"]) for r in rows if r["facts"]), {})
        self.parts = [Part(*r[:-1]) for r in rows if r["table_name"]]

    def of(self, name: str) -> list[Part]:
        return [p for p in self.parts if p.table_name == name]

    def table(self, name: str, places: Sequence[Part] | None = None) -> DataFrame:
        """A table, or only some of its parts; line tables with their month and bucket as last columns."""
        return _read(self.spark, self.folder, self.of(name) if places is None else places, self.of(name))

    @property
    def months(self) -> list[str]:
        return sorted(p.month for p in self.of("master_sales"))

    def latest_months(self, n: int) -> list[str]:
        """The latest months that hold at least ``n`` lines, by the row counts of the version; no file is read."""
        found, rows = [], 0
        for part in sorted(self.of("master_sales"), key=lambda p: p.month, reverse=True):
            found.append(part.month)
            rows += part.n_rows
            if rows >= n:
                break
        return sorted(found)

    def spot_check(self, n: int = 20) -> DataFrame:
        """The newest lines of the master, from the files of the months that hold them."""
        return master.master_spot_check(self.master.filter(F.col(MONTH).isin(self.latest_months(n))), n)

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("stg_customers")

    @cached_property
    def categories(self) -> DataFrame:
        return self.table("stg_product_category")

    @cached_property
    def products(self) -> DataFrame:
        return self.table("stg_products")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("stg_orders")

    @cached_property
    def master(self) -> DataFrame:
        return self.table("master_sales").select(*master.MASTER_COLUMNS, MONTH)

    @cached_property
    def ext(self) -> DataFrame:
        lines = enrich.with_tiers(self.table(EXT), self.table("city_tiers"), self.table("category_tiers"))
        return lines.select(*enrich.EXT_COLUMNS)

    def slice(self, by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
        """Figures of any slice by month, year, city, category and new or repeat lines (``states.sliced``); exact, and
        without reading a line."""
        return states.sliced(self.table("slice_sums"), self.table("customer_sets"), by, where)

    @cached_property
    def cohorts(self) -> DataFrame:
        return states.cohorts(self.table("active_months"))

    def returns(self, gap: int = 3) -> DataFrame:
        return states.returns(self.table("active_months"), gap)

    def quantiles(self, measure: str, wanted: Mapping[str, float], months: Sequence[str] | None = None) -> DataFrame:
        """Quantiles of a measure of the lines (of some months), merged from the summaries of its months."""
        found = self.table("line_quantiles").filter(F.col("measure") == measure)
        return states.merged_quantiles(found if months is None else found.filter(F.col(MONTH).isin(list(months))), wanted)

    @cached_property
    def lines(self) -> DataFrame:
        """``v_base_sales``; the month is that of the stored fact, not looked up in the calendar."""
        dimensions = [self.table(name) for name in ("dim_date", "dim_customer", "dim_product")]
        return star.v_base_sales(self.table("fact_sales"), *dimensions, month=MONTH)

    def register_views(self, views: Mapping[str, object]) -> None:
        """Make the named views readable by SQL in this session. Ranked ones are read from what the version has stored."""
        stored = {p.table_name for p in self.parts}
        files.register_views({name: self.table(name) if name in stored else view(self) for name, view in views.items()})


def _read(spark: SparkSession, folder: str, parts: Sequence[Part], of_table: Sequence[Part]) -> DataFrame:
    """The rows of ``parts``. Which folders they are is a filter on partition columns: the driver opens no other."""
    schema = T.StructType.fromJson(json.loads(of_table[0].schema))
    if not parts:
        return spark.createDataFrame([], schema)
    keys = [RUN] + [c for c, there in ((MONTH, parts[0].month), (BUCKET, parts[0].bucket)) if there is not None]
    stored = T.StructType([f for f in schema.fields if f.name not in keys])
    types = {RUN: T.StringType(), MONTH: T.StringType(), BUCKET: T.IntegerType()}
    for key in keys:
        stored = stored.add(key, types[key])
    df = spark.read.schema(stored).parquet(f"{folder}/{parts[0].table_name}")
    wanted = sorted({p.place for p in parts})
    return df.filter(F.concat_ws("/", *keys).isin(wanted)).select(*schema.names)


class _Run:
    """What one refresh writes. Tables are written from several threads, so ``parts`` are copied before they are looped over."""

    def __init__(self, spark: SparkSession, folder: str, old: Mart | None):
        self.spark, self.folder, self.old, self.name = spark, folder.rstrip("/"), old, uuid.uuid4().hex[:12]
        self.parts: dict[tuple, Part] = {(p.table_name, p.month, p.bucket): p for p in (old.parts if old else [])}
        self.facts: dict[str, int] = {}
        self.touched: list[str] = []

    def _write(self, table: str, df: DataFrame, keys: Sequence[str], placed: bool) -> None:
        self.touched.append(table)
        seen = Observation()
        tests = TESTS.get(table, {})
        counted = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.expr(rule)).alias(name) for name, rule in tests.items()]]
        files.write_parquet(df.observe(seen, *counted), f"{self.folder}/{table}/{RUN}={self.name}", keys, placed)
        found = {f"{table}.{name}": int(n or 0) for name, n in seen.get.items()}
        self.facts |= found
        broken = {name: n for name, n in found.items() if n and not name.endswith(".rows")}
        if broken:
            raise FailedTests(", ".join(f"{name}: {n} lines" for name, n in broken.items()))

    def lines(self, table: str, df: DataFrame, places: set[tuple], bucketed: bool = False, placed: bool = False) -> None:
        """Write the rows of ``places`` (months, or months and buckets) anew; a place without rows is no part any more.
        ``placed``: the rows come from files by month already."""
        keys = [MONTH, BUCKET] if bucketed else [MONTH]
        for key in [k for k in list(self.parts) if k[0] == table and (k[1:] if bucketed else k[1:2]) in places]:
            del self.parts[key]
        self._write(table, df, keys, placed)
        schema = df.schema
        stored = T.StructType([f for f in schema.fields if f.name not in keys]).add(MONTH, T.StringType())
        stored = stored.add(BUCKET, T.IntegerType()) if bucketed else stored
        back = self.spark.read.schema(stored).parquet(f"{self.folder}/{table}/{RUN}={self.name}")
        for r in back.groupBy(*keys).agg(*fingerprint(c for c in schema.names if c not in keys)).collect():
            bucket = r[BUCKET] if bucketed else None
            self.parts[(table, r[MONTH], bucket)] = Part(table, r[MONTH], bucket, self.name, r["n_rows"], r["hash_sum"], r["hash_xor"], schema.json())

    def small(self, table: str, df: DataFrame) -> DataFrame:
        """Write a table without months; if it has the rows it had, what was there stays."""
        path, before = f"{self.folder}/{table}/{RUN}={self.name}", self.parts.get((table, None, None))
        seen = Observation()
        files.write_parquet(df.observe(seen, *fingerprint(df.columns)), path)
        found = {"n_rows": 0, "hash_sum": "0", "hash_xor": 0} | {k: v for k, v in seen.get.items() if v is not None}
        part = Part(table, None, None, self.name, int(found["n_rows"]), found["hash_sum"], int(found["hash_xor"]), df.schema.json())
        if before and before.content == part.content:
            _delete(self.spark, path)
        else:
            self.touched.append(table)
            self.parts[(table, None, None)] = part
        return self.table(table)

    def of(self, table: str) -> list[Part]:
        return [p for p in list(self.parts.values()) if p.table_name == table]

    def table(self, table: str, months: Iterable[str] | None = None) -> DataFrame:
        parts = self.of(table) or self.old.of(table)
        chosen = self.of(table) if months is None else [p for p in self.of(table) if p.month in set(months)]
        return _read(self.spark, self.folder, chosen, parts)

    def commit(self) -> None:
        number = self.old.version + 1 if self.old else 1
        rows = [(*part, None) for part in self.parts.values()] + [(*[None] * len(Part._fields), json.dumps(self.facts))]
        table = self.spark.createDataFrame(rows, _PARTS + ", facts string").coalesce(1)
        # Fails if another refresh has made this version meanwhile.
        table.write.mode("errorifexists").parquet(f"{self.folder}/versions/{number:08d}")

    def discard(self) -> None:
        for table in self.touched:
            _delete(self.spark, f"{self.folder}/{table}/{RUN}={self.name}")


def _who() -> Column:
    """The customer of a line as a key that is never missing."""
    return F.coalesce(F.concat(F.lit("@"), F.col("cust_email")), F.lit(""))


def _differing(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values of ``keys`` (never missing) whose rows are not the same in both frames."""
    sides = []
    for df, side in ((a, "a"), (b, "b")):
        grouped = df.groupBy(*keys).agg(*fingerprint(c for c in df.columns if c not in keys))
        sides.append(grouped.withColumnsRenamed({c: f"{c}_{side}" for c in grouped.columns if c not in keys}))
    same = [F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")) for c in ("n_rows", "hash_sum", "hash_xor")]
    return sides[0].join(sides[1], list(keys), "full_outer").filter(~(same[0] & same[1] & same[2])).select(*keys)


def _hashes(lines: DataFrame) -> DataFrame:
    return lines.groupBy(MONTH).agg(*fingerprint(c for c in lines.columns if c != MONTH))


def _by_month(hashes: DataFrame) -> dict[str, tuple]:
    return {r[MONTH]: (r["n_rows"], r["hash_sum"], r["hash_xor"]) for r in hashes.collect()}


def _goods(products: DataFrame, categories: DataFrame) -> DataFrame:
    """What lines take from a product: nothing but that it is there if its category does not survive."""
    named = join_lines(products, categories.drop("CategoryAbbreviation").withColumn("_there", F.lit(True)), "CategoryID", "left")
    return named.select("ProdNumber", *[F.when(F.col("_there"), F.col(c)).alias(c) for c in named.columns if c != "ProdNumber"])


def _changed_months(run: _Run, orders: DataFrame, hashes: DataFrame) -> list[str]:
    """Months whose staged lines are not those of the last version, or whose customers or products are not. ``orders`` are
    typed; only those of months that may have changed are joined with customers and products."""
    old = run.old
    now, before = _by_month(hashes), _by_month(old.table(TYPED)) if old.of(TYPED) else {}
    maybe = {m for m in before.keys() | now.keys() if before.get(m) != now.get(m)}
    kept = {p.table_name: p.run for p in old.parts if p.month is None}
    others: dict[str, DataFrame] = {}
    if run.parts[("stg_customers", None, None)].run != kept["stg_customers"]:
        told = ("CustomerID", "CustomerEmail", "CustomerCity")
        others["CustomerID"] = _differing(old.customers.select(*told), run.table("stg_customers").select(*told), ["CustomerID"])
    if any(run.parts[(k, None, None)].run != kept[k] for k in ("stg_products", "stg_product_category")):
        new = _goods(run.table("stg_products"), run.table("stg_product_category"))
        others["ProdNumber"] = _differing(_goods(old.products, old.categories), new, ["ProdNumber"])

    def months_with_others(lines: DataFrame) -> set[str]:
        return {r[0] for key, other in others.items() for r in join_lines(lines, other, key, "left_semi").select(MONTH).distinct().collect()}

    maybe |= months_with_others(orders)
    if not maybe:
        return []
    some = orders.filter(F.col(MONTH).isin(sorted(maybe)))
    lines = materialise(staging.with_partners(some, run.table("stg_customers"), run.table("stg_products")), "changed")
    was, found = {p.month: p.content for p in old.of("stg_orders")}, _by_month(_hashes(lines))
    changed = {m for m in maybe if was.get(m) != found.get(m)} | months_with_others(lines)
    discard(lines)
    return sorted(changed)


def _place(buckets: int, cuts: int = 1) -> enrich.Place:
    """Month and bucket of a customer's day, cut into ``cuts`` by customer and day."""

    def place(who: Column, day: Column) -> Column:
        date = F.date_from_unix_date(day)
        month = (F.year(date) * 12 + F.month(date)).cast("long")
        return (month * buckets + F.pmod(F.xxhash64(who), F.lit(buckets))) * cuts + F.pmod(F.xxhash64(who, day), F.lit(cuts))

    return place


def _ext_rows(lines: DataFrame, buckets: int, cuts: int = 1) -> DataFrame:
    """Enriched lines, brought together by month and bucket by the one exchange that their history takes."""
    return enrich.with_line_columns(lines, place=_place(buckets, cuts)).withColumn(BUCKET, F.pmod(F.xxhash64(_who()), F.lit(buckets)).cast("int"))


def _few_large_files(run: _Run, parts: Sequence[Part]) -> bool:
    """Whether these parts of the enriched lines hold many lines, in few files."""
    if not parts or sum(p.n_rows for p in parts) < len(parts) * SMALL_PART:
        return False
    places, n_files = {f"{RUN}={p.run}/{MONTH}={p.month}/{BUCKET}={p.bucket}" for p in parts}, 0
    for name in {p.run for p in parts}:
        system, found = _hadoop(run.spark, f"{run.folder}/{EXT}/{RUN}={name}/*/*/part-*")
        for status in system.globStatus(found) or []:
            n_files += "/".join(status.getPath().toUri().getPath().split("/")[-4:-1]) in places
    return n_files <= len(parts) * PART_FILES


def _refresh_ext(run: _Run, months: list[str] | None, buckets: int) -> list[str] | None:
    """Enriched lines of all customers who have a line that was not there, or is not there any more. Returns the months
    whose states have to be made anew (None: all): those in which these customers have not the same lines, as far as states
    are made of them. Many more months are written, for the sequence and the lifetime values."""
    old = run.old
    if not old:
        stored = run.of("master_sales")
        cuts = 1 + sum(p.n_rows for p in stored) // max(1, len(stored) * buckets * FILE_LINES)
        df = _ext_rows(run.table("master_sales").select(*master.MASTER_COLUMNS), buckets, cuts)
        run.lines(EXT, df, set(), bucketed=True, placed=True)
        return None
    columns = [*master.MASTER_COLUMNS, MONTH]
    before = old.table("master_sales", [p for p in old.of("master_sales") if p.month in set(months)]).select(*columns)
    now = run.table("master_sales", months).select(*columns)
    # Held by month, so that a line that moves to another month counts as changed, too.
    who = materialise(_differing(before.withColumn("_who", _who()), now.withColumn("_who", _who()), ["_who"]), "customers")
    run.facts["customers_changed"] = who.count()
    few = run.facts["customers_changed"] <= FEW_CUSTOMERS

    def theirs(lines: DataFrame, how: str = "left_semi") -> DataFrame:
        lines = lines.withColumn("_who", _who())
        return lines.join(F.broadcast(who), "_who", how) if few else join_lines(lines, who, "_who", how)

    lines = theirs(run.table("master_sales").select(*master.MASTER_COLUMNS))
    fresh = materialise(_ext_rows(materialise(lines.drop("_who"), "lines"), buckets), "lines")
    numbers = [r[0] for r in who.select(F.pmod(F.xxhash64("_who"), F.lit(buckets)).cast("int")).distinct().collect()]
    was = old.table(EXT, [p for p in old.of(EXT) if p.bucket in set(numbers)]).select(BUCKET, *STATE_COLUMNS)
    was = materialise(theirs(was).drop("_who"), "stored")
    places = was.select(MONTH, BUCKET).distinct()
    touched = {tuple(r) for r in places.unionByName(fresh.select(MONTH, BUCKET).distinct()).distinct().collect()}
    changed = _differing(was.select(*STATE_COLUMNS), fresh.select(*STATE_COLUMNS), [MONTH])
    parts = [p for p in old.of(EXT) if (p.month, p.bucket) in touched]
    stays = theirs(old.table(EXT, parts), "left_anti").drop("_who")
    # If they can be, written as they lie, with no exchange; the fresh lines of a part are a file beside them.
    lie = few and _few_large_files(run, parts)
    run.lines(EXT, stays.unionByName(fresh.hint("rebalance", MONTH, BUCKET) if lie else fresh), touched, bucketed=True, placed=lie)
    return sorted(r[0] for r in changed.collect())


def _refresh_quantiles(run: _Run, lines: DataFrame, months: list[str] | None) -> None:
    parts = [lines.select(MONTH, F.lit(m).alias("measure"), F.col(m).cast("decimal(38,9)").alias("v")) for m in MEASURES]
    group = F.concat_ws("/", MONTH, "measure")
    summary = states.quantile_summary(reduce(DataFrame.unionByName, parts), F.col("v"), group)
    summary = summary.withColumns({MONTH: F.split("by", "/")[0], "measure": F.split("by", "/")[1]}).drop("by")
    run.lines("line_quantiles", summary, {(m,) for m in months or []})


def _refresh_active_months(run: _Run, lines: DataFrame, months: list[str] | None) -> None:
    keyed = lines.filter("customer_sk IS NOT NULL AND product_sk IS NOT NULL AND order_date IS NOT NULL")
    active = states.active_months(keyed.select("customer_sk", MONTH))
    if run.old:
        active = states.merge_active_months(states.without_months(run.old.table("active_months"), months or []), active)
    run.small("active_months", active)


def _ext_states(run: _Run, numbers: DataFrame, written: list[str] | None) -> list[Callable[[], object]]:
    """What writes the states made of enriched lines. ``written``: the months in which these are not what they were."""
    ext, places = run.table(EXT, written), {(m,) for m in written or []}
    return [
        lambda: run.lines("customer_sets", states.customer_sets(ext, numbers), places),
        lambda: run.lines("slice_sums", states.slice_sums(ext), places),
    ]


def refresh(
    spark: SparkSession, raw: retail.RawTables, folder: str, buckets: int = BUCKETS, price_type: str = PRICE_TYPE, ranked: bool = True
) -> Mart:
    """Bring the mart in ``folder`` up to the raw tables, or make its first version, and return the latest version.

    Nothing is written if nothing has changed. ``buckets`` must stay what it was when the mart was made. With ``ranked``
    the views that rank all lines are stored, too. If a test of the lines fails (``TESTS``), ``FailedTests`` is raised,
    what was written is deleted and the last version stays the latest.
    """
    old = Mart(spark, folder) if versions(spark, folder) else None
    run = _Run(spark, folder, old)
    try:
        with temporary_tables(spark), open_writers(spark), lean_disk(spark):
            together(
                spark,
                lambda: run.small("stg_customers", staging.stg_customers(raw.customers)),
                lambda: run.small("stg_product_category", staging.stg_product_category(raw.categories)),
                lambda: run.small("stg_products", staging.stg_products(raw.products, price_type)),
            )
            # Read twice: for their hashes, by which the next refresh finds the months that have changed, and to be joined.
            orders = materialise(staging.typed_orders(raw.orders), "orders")
            hashes = materialise(_hashes(orders), "hashes")
            months = _changed_months(run, orders, hashes) if old else None
            if months or not old or run.touched:
                run.small(TYPED, hashes)
                rest = _refresh_lines(run, orders, months, buckets) if months is None or months else []
                _refresh_small(run, ranked, rest)
                run.commit()
    except BaseException:
        run.discard()
        raise
    return Mart(spark, folder)


def _refresh_lines(run: _Run, orders: DataFrame, months: list[str] | None, buckets: int) -> list[Callable[[], object]]:
    """Write the lines and the states made of them; returns what writes the states made of enriched lines."""
    chosen = orders if months is None else orders.filter(F.col(MONTH).isin(months))
    places = {(m,) for m in months or []}
    tables = [run.table(t) for t in ("stg_customers", "stg_products", "stg_product_category")]
    # Joined and brought together by month once; the tables of lines are then written as they lie.
    staged = materialise(master.staged_lines(chosen, *tables), "staged", by=[MONTH])
    discard(orders)
    together(
        run.spark,
        lambda: run.lines("master_sales", master.master_of_staged(staged), places, placed=True),
        lambda: run.lines("stg_orders", staged.select(*staging.ORDER_COLUMNS), places, placed=True),
    )
    discard(staged)
    sales = run.table("master_sales", months)
    by_month = sales.groupBy(MONTH, "cust_city", "category_name").agg(F.sum("total_sales").alias("total_sales"))
    # The dimensions are made of the same lines, so that every line with keys finds its partners.
    fact = star.sales_lines(sales).select(*star.FACT_COLUMNS, MONTH)
    known = run.old and run.old.table("customer_numbers")
    written, numbers, *_ = together(
        run.spark,
        lambda: _refresh_ext(run, months, buckets),
        lambda: run.small("customer_numbers", states.customer_numbers(sales, known)),
        lambda: run.lines("fact_sales", fact, places, placed=True),
        lambda: run.lines("sales_months", by_month.withColumn("order_date", C.month_start(MONTH)), places),
        lambda: _refresh_quantiles(run, sales, months),
        lambda: _refresh_active_months(run, sales, months),
    )
    return _ext_states(run, numbers, written)


def _refresh_small(run: _Run, ranked: bool, rest: Sequence[Callable[[], object]]) -> None:
    """Write the tables without months, and beside them what ``rest`` writes."""
    totals, sales = run.table("sales_months"), run.table("master_sales")
    dates, buyers, goods, *_ = together(
        run.spark,
        lambda: run.small("dim_date", star.dim_date(date_bounds(star.sold_dates(sales)))),
        lambda: run.small("dim_customer", star.dim_customer(star.customer_lines(sales))),
        lambda: run.small("dim_product", star.dim_product(star.product_lines(sales))),
        *rest,
        lambda: run.small("city_tiers", enrich.city_tiers(totals)),
        lambda: run.small("category_tiers", enrich.category_tiers(totals)),
    )
    if ranked:
        base = star.v_base_sales(run.table("fact_sales"), dates, buyers, goods)
        for name, view in RANKED.items():
            run.small(name, view(base))


# ---- between versions ---------------------------------------------------------------------------------------


def changed_parts(before: Mart, after: Mart) -> DataFrame:
    """Of each table: its parts, and those whose files are not the same in both versions. Reads only the two versions."""
    files_before = {(p.table_name, p.month, p.bucket): p.run for p in before.parts}
    rows: dict[str, list[int]] = {}
    for p in after.parts:
        row = rows.setdefault(p.table_name, [0, 0])
        row[0] += 1
        row[1] += files_before.get((p.table_name, p.month, p.bucket)) != p.run
    return after.spark.createDataFrame([(t, *n) for t, n in sorted(rows.items())], "table_name string, parts long, written long")


def reconcile(before: Mart, after: Mart, table: str = "master_sales") -> DataFrame:
    """Lines of a table that only one of two versions (or marts) has, counted by month.

    Months whose row counts and hashes agree are not read.
    """
    a, b = ({p.month: p.content for p in m.of(table)} for m in (before, after))
    months = {m for m in a.keys() | b.keys() if a.get(m) != b.get(m)}
    sides = []
    for mart, sign in ((before, -1), (after, 1)):
        df = mart.table(table, [p for p in mart.of(table) if p.month in months])
        sides.append(df.withColumn("_sign", F.lit(sign)))
    columns = [c for c in sides[0].columns if c != "_sign"]
    surplus = sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("_sign").alias("n")).filter("n <> 0")
    return surplus.groupBy(MONTH).agg(
        F.coalesce(F.sum(F.when(F.col("n") < 0, -F.col("n"))), F.lit(0)).alias("only_before"),
        F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("n"))), F.lit(0)).alias("only_after"),
    )


def drop_old(mart: Mart) -> None:
    """Delete the versions before ``mart``, and the files that it does not read."""
    spark, folder = mart.spark, mart.folder
    kept = {f"{p.table_name}/{RUN}={p.run}" for p in mart.parts}
    for p in mart.parts:
        place = f"{p.table_name}/{RUN}={p.run}/{MONTH}={p.month}"
        kept |= {place, f"{place}/{BUCKET}={p.bucket}"}
    system, _ = _hadoop(spark, folder)
    top = _hadoop(spark, folder)[1].toUri().getPath()
    for depth in (f"{RUN}=*", f"{RUN}=*/{MONTH}=*", f"{RUN}=*/{MONTH}=*/{BUCKET}=*"):
        for status in system.globStatus(_hadoop(spark, f"{folder}/*/{depth}")[1]) or []:
            if status.getPath().toUri().getPath().removeprefix(f"{top}/") not in kept:
                system.delete(status.getPath(), True)
    for number in versions(spark, folder):
        if number < mart.version:
            _delete(spark, f"{folder}/versions/{number:08d}")
