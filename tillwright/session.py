"""Session for local work, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar
from weakref import WeakKeyDictionary

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A join with one hot key is split by adaptive execution even when that costs one more exchange further up.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(
    cpus: str | int = "*", shuffle_partitions: int = 8, app: str = "tillwright", conf: dict[str, str] | None = None
) -> SparkSession:
    """Single-machine session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.gettempdir() + "/tillwright-warehouse")
    )
    for name, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to a session somebody else made."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may do without it, and then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tillwright-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_STORED: WeakKeyDictionary[SparkSession, list[str]] = WeakKeyDictionary()
# Where the frames that ``materialise`` returns are stored.
_PLACES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


# Actions that ``together`` runs at a time.
AT_ONCE = 4

_Result = TypeVar("_Result")


def together(spark: SparkSession, *actions: Callable[[], _Result]) -> list[_Result]:
    """Results of actions that do not need each other, run from several threads: the tasks of one fill the cores that the
    last tasks, the planning and the commit of another leave idle. All have ended when this returns or raises."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    return [future.result() for future in futures]


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# Files that a task of ``open_writers`` holds open at a time.
OPEN_FILES = 64


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Tasks that write by partition value keep a file of each value open (up to ``OPEN_FILES``) instead of sorting their
    rows by it first; what exceeds these is sorted as usual."""
    with _settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}):
        yield


LEAN_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def lean_disk(spark: SparkSession) -> Iterator[None]:
    """The files of a shuffle are deleted when the action that made them has ended, not when the driver happens to collect
    garbage; without that, all shuffles of a long job lie on the disks together. What is written is compressed with zstd."""
    with _settings(spark, LEAN_CONF):
        yield


def materialise(df: DataFrame, label: str = "stage", by: Sequence[str] = (), **options: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back; ``options`` go to the Parquet writer. Rows are
    brought together ``by`` columns, and stored in files that each hold one value of them.

    Used where a result feeds several branches, or where it must not be computed twice because it depends on
    sampled range bounds. Unlike a cached frame it survives the loss of executors, and unlike a checkpoint it keeps
    column pruning and filter pushdown for its readers. The table stays until ``release`` or the end of a
    ``temporary_tables`` block.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tillwright-{label}-{uuid.uuid4().hex}"
    _STORED.setdefault(spark, []).append(path)
    rows = df.hint("rebalance", *[F.col(c) for c in by]) if by else df
    rows.write.mode("errorifexists").options(**options).partitionBy(*by).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    _PLACES[stored] = path
    return stored


def _delete(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def discard(stored: DataFrame) -> None:
    """Delete the table behind a frame that ``materialise`` has returned, before its block or session ends."""
    # Its name stays among the stored ones: blocks count them.
    _delete(stored.sparkSession, _PLACES.pop(stored))


def release(spark: SparkSession, keep: int = 0) -> None:
    """Delete the tables this session has stored, but for the first ``keep``."""
    stored = _STORED.get(spark, [])
    while len(stored) > keep:
        _delete(spark, stored.pop())


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """What is stored inside the block is deleted at its end; write or collect results before."""
    before = len(_STORED.get(spark, []))
    try:
        yield
    finally:
        release(spark, before)
