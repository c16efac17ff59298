"""Ranked lexical search: exact inner products over ball trees of sparse document vectors.

A document is a vector with one whole number for each search term in it: the term's weight times its saturated
frequency. Its score for a query is the inner product with the query's term counts. Documents are taken in blocks, and
each block becomes a ball tree: a ball has the mean of its documents and the radius that holds them all, and is split
between two documents that lie far apart. No document of a ball can score more than

    query · mean + |query| · radius.

In thousands of dimensions that radius is long, but a query has few of them: a ball also has its radius along each axis
(how far its documents reach beyond the mean there), and no document can score more than

    query · (mean + radius along each axis).

The lesser of both counts. A query goes from ball to ball, the highest bound first, and stops when no bound reaches its
k-th best score so far; leaves are scored exactly, in 64-bit integers. The first bound is computed in floating point and
raised by more than the rounding of all its operations together, the second in whole numbers, so that nothing is cut that
could be among the best.

Every task keeps the k best documents of each query over all its blocks; the k best of all tasks are the result. Queries
are a stated set and are searched in blocks of ``QUERY_TERMS`` terms (and those of one query more at most), which bounds
what tasks receive.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.session import materialise

# Terms of the queries that are searched together.
QUERY_TERMS = 60_000
# Documents, and terms in them, of one tree; documents of a leaf.
BLOCK_DOCS, BLOCK_ENTRIES, LEAF_DOCS = 8192, 2_000_000, 24
# Terms are runs of letters, digits and everything beyond ASCII; only A-Z are lowered. On UTF-8 bytes:
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


# ---- queries ------------------------------------------------------------------------------------------------


class Queries(NamedTuple):
    """A block of queries: ids, the numbers of their terms with how often each occurs, and all terms by number."""

    ids: list
    terms: list[np.ndarray]
    counts: list[np.ndarray]
    vocabulary: dict[bytes, int]


def query_blocks(queries: DataFrame, query_terms: int = QUERY_TERMS) -> Iterator[Queries]:
    """Queries (``item_id``, ``text``) with terms, in blocks.

    Terms are counted and blocks numbered by Spark, and stored; the driver reads one block at a time.
    """
    item, words = F.col("item_id"), F.split(F.translate("_plain", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), " ")
    plain = F.regexp_replace(F.col("text").cast("string"), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ")
    rows = queries.select(item, plain.alias("_plain")).select("item_id", F.filter(words, lambda w: w != "").alias("_terms"))
    counted = (
        rows.filter(F.size("_terms") > 0)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_size", F.size(F.array_distinct("_terms")))
        .withColumn("_part", F.spark_partition_id())
    )
    stored = materialise(counted, "queries")
    # Blocks of rows of one partition in their order: a block ends where the running number of terms passes the limit.
    in_part = W.partitionBy("_part").orderBy("_row").rowsBetween(W.unboundedPreceding, 0)
    numbered = stored.withColumn("_block", F.floor((F.sum("_size").over(in_part) - 1) / query_terms))
    numbered = materialise(numbered, "query-blocks")
    for block in numbered.select("_part", "_block").distinct().orderBy("_part", "_block").toLocalIterator():
        found = numbered.filter((F.col("_part") == block["_part"]) & (F.col("_block") == block["_block"])).orderBy("_row")
        yield _queries(found.select("item_id", "_terms").collect())


def _queries(rows: list[Row]) -> Queries:
    vocabulary: dict[bytes, int] = {}
    out = Queries([], [], [], vocabulary)
    for item, words in rows:
        counts = Counter(w.encode() for w in words)
        out.ids.append(item)
        out.terms.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in counts], dtype=np.int64))
        out.counts.append(np.array(list(counts.values()), dtype=np.int64))
    return out


# ---- document vectors ---------------------------------------------------------------------------------------

_VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>, n_docs long, n_terms long, df_terms array<int>, dfs array<long>"


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Each document's number of terms, and how often it holds those of ``vocabulary``; documents without any of these
    are only counted. One more row for each task has its numbers of documents and terms, and document frequencies."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))]
        + [("n_docs", pa.int64()), ("n_terms", pa.int64()), ("df_terms", pa.list_(pa.int32())), ("dfs", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        known, dfs = number.keys(), np.zeros(len(number), dtype=np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            ids, ns, terms, tfs = [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = terms_of(text.as_py() or b"")
                if not words:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + len(words)
                counts = Counter(words)
                found = sorted((number[w], counts[w]) for w in known & counts.keys())
                if found:
                    mine = [t for t, _ in found]
                    dfs[mine] += 1
                    ids.append(doc)
                    ns.append(len(words))
                    terms.append(mine)
                    tfs.append([c for _, c in found])
            none = [None] * len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, ns, terms, tfs, none, none, none, none), schema, strict=True)], schema=schema)
        seen = np.flatnonzero(dfs)
        total = [[None], [None], [None], [None], [n_docs], [n_terms], [seen.tolist()], [dfs[seen].tolist()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(total, schema, strict=True)], schema=schema)

    return materialise(rows.mapInArrow(run, _VECTORS), "term-vectors")


class Statistics(NamedTuple):
    n_docs: int
    n_terms: int
    weights: np.ndarray  # of each term of the vocabulary


def statistics(stored: DataFrame, n_vocabulary: int) -> Statistics:
    """Over all documents; document frequencies are at most one row for each term of a block of queries."""
    tasks = stored.filter("n_docs IS NOT NULL")
    n_docs, n_terms = tasks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    pairs = tasks.select(F.explode(F.arrays_zip("df_terms", "dfs")).alias("p")).groupBy("p.df_terms").agg(F.sum("p.dfs").alias("df"))
    dfs = np.zeros(n_vocabulary, dtype=np.int64)
    for term, df in pairs.collect():
        dfs[term] = df
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in dfs]
    return Statistics(n_docs, n_terms, np.array(weights, dtype=np.int64))


# ---- ball trees ---------------------------------------------------------------------------------------------


class Block:
    """Sparse rows, one for each document: term numbers, whole-number values, and where each row begins."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, values: np.ndarray, starts: np.ndarray) -> None:
        self.docs, self.terms, self.values, self.starts = docs, terms, values, starts

    def rows(self, chosen: np.ndarray) -> Block:
        lengths = self.starts[chosen + 1] - self.starts[chosen]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(starts[-1]) + np.repeat(self.starts[chosen] - starts[:-1], lengths)
        return Block(self.docs[chosen], self.terms[at], self.values[at], starts)

    def dot(self, dense: np.ndarray) -> np.ndarray:
        # No row is empty, so reduceat adds up each by itself.
        return np.add.reduceat(dense[self.terms] * self.values, self.starts[:-1])


class Tree:
    """Balls over a block: of each ball its bound for every query, its two halves, or the documents of a leaf."""

    def __init__(self, block: Block, queries: Queries, leaf_docs: int) -> None:
        self.leaf_docs = leaf_docs
        width = len(queries.vocabulary)
        self.flat_terms = np.concatenate(queries.terms)
        self.whole_counts = np.concatenate(queries.counts)
        self.flat_counts = self.whole_counts.astype(float)
        self.query_starts = np.concatenate([[0], np.cumsum([len(t) for t in queries.terms])])[:-1]
        self.query_norms = np.sqrt(np.array([float(c @ c) for c in queries.counts]))
        # Every sum here has at most this many terms and a few roundings besides, each below 2**-53 of what is added.
        self.slack = (width + max(len(t) for t in queries.terms) + 64) * 2.0**-51
        self.bounds: list[np.ndarray] = []
        self.halves: list[tuple[int, int] | None] = []
        self.leaves: dict[int, Block] = {}
        self.width = width
        self._build(block)

    def _build(self, block: Block) -> tuple[int, np.ndarray]:
        """The number of the ball, and how far its documents reach along each axis."""
        n = len(block.docs)
        number = len(self.bounds)
        values = block.values.astype(float)
        mean = np.bincount(block.terms, weights=values, minlength=self.width) / n
        squares = np.add.reduceat(values * values, block.starts[:-1])
        floats = Block(block.docs, block.terms, values, block.starts)
        size = float(mean @ mean)
        far = squares - 2 * floats.dot(mean) + size
        # Cancellation leaves an error of a few units in the last place of what was subtracted.
        error = (float(squares.max()) + size) * self.slack
        radius = math.sqrt(max(0.0, float(far.max())) + 4 * error)
        at_mean = np.add.reduceat(mean[self.flat_terms] * self.flat_counts, self.query_starts)
        bound = at_mean + self.query_norms * radius
        self.bounds.append(bound + bound * self.slack + 1)
        self.halves.append(None)
        if n <= self.leaf_docs:
            self.leaves[number] = block
            reach = np.zeros(self.width, dtype=np.int64)
            np.maximum.at(reach, block.terms, block.values)
            return self._along_axes(number, reach)
        first = int(far.argmax())
        from_first = squares + squares[first] - 2 * floats.dot(self._dense(floats, first))
        second = int(from_first.argmax())
        side = floats.dot(self._dense(floats, first) - self._dense(floats, second))
        order = np.lexsort((block.docs, side))
        left, reach = self._build(block.rows(np.sort(order[: n // 2])))
        right, reach_right = self._build(block.rows(np.sort(order[n // 2 :])))
        self.halves[number] = (left, right)
        return self._along_axes(number, np.maximum(reach, reach_right))

    def _along_axes(self, number: int, reach: np.ndarray) -> tuple[int, np.ndarray]:
        highest = np.add.reduceat(reach[self.flat_terms] * self.whole_counts, self.query_starts)
        self.bounds[number] = np.minimum(self.bounds[number], highest)
        return number, reach

    def _dense(self, block: Block, row: int) -> np.ndarray:
        out = np.zeros(self.width)
        at = slice(block.starts[row], block.starts[row + 1])
        out[block.terms[at]] = block.values[at]
        return out

    def search(self, query: int, dense: np.ndarray, best: list[tuple[int, int]], k: int) -> int:
        """Put the documents into ``best`` (a heap of score and negated doc_id) that belong to its ``k`` highest; the
        number of leaves that were scored. What could equal the k-th best score is not cut, as ties go by doc_id."""
        balls = [(-self.bounds[0][query], 0)]
        scored = 0
        while balls:
            bound, ball = heapq.heappop(balls)
            if len(best) == k and -bound < best[0][0]:
                break
            if self.halves[ball]:
                for half in self.halves[ball]:
                    if len(best) < k or self.bounds[half][query] >= best[0][0]:
                        heapq.heappush(balls, (-self.bounds[half][query], half))
                continue
            scored += 1
            leaf = self.leaves[ball]
            scores = leaf.dot(dense)
            for i in np.flatnonzero(scores >= best[0][0] if len(best) == k else scores > 0):
                found = (int(scores[i]), -int(leaf.docs[i]))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return scored


# Stands for a missing doc_id, which comes after all others.
_NO_ID = (1 << 63) - 1


def _blocks(batches: Iterator[pa.RecordBatch], stats: Statistics, docs: int, entries: int) -> Iterator[Block]:
    held: list[tuple[np.ndarray, ...]] = []
    n_docs = n_entries = 0

    def joined() -> Block:
        ids, terms, values, lengths = (np.concatenate(c) for c in zip(*held, strict=True))
        return Block(ids, terms, values, np.concatenate([[0], np.cumsum(lengths)]))

    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            piece = batch.slice(at, 512)
            ids = piece.column("doc_id").fill_null(_NO_ID).to_numpy()
            lists = piece.column("terms")
            terms, tfs = lists.flatten().to_numpy().astype(np.int64), piece.column("tfs").flatten().to_numpy().astype(np.int64)
            lengths = lists.value_lengths().to_numpy().astype(np.int64)
            # Python's integers, as 75 * n * N can pass 64 bits in very large corpora.
            m = np.array([25 + 75 * n * stats.n_docs // stats.n_terms for n in piece.column("n").to_pylist()], dtype=np.int64)
            values = stats.weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * np.repeat(m, lengths)))
            held.append((ids, terms, values, lengths))
            n_docs, n_entries = n_docs + len(ids), n_entries + len(terms)
            if n_docs >= docs or n_entries >= entries:
                yield joined()
                held, n_docs, n_entries = [], 0, 0
    if held:
        yield joined()


def best_of_tasks(
    stored: DataFrame, queries: Queries, stats: Statistics, k: int, block_docs: int, block_entries: int, leaf_docs: int
) -> DataFrame:
    """``query`` (its number), ``doc_id`` and ``score`` of the ``k`` best documents of each query in each task."""
    shared = stored.sparkSession.sparkContext.broadcast((queries, stats))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, stats = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in queries.ids]
        dense = np.zeros(len(queries.vocabulary), dtype=np.int64)
        for block in _blocks(batches, stats, block_docs, block_entries):
            tree = Tree(block, queries, leaf_docs)
            for q, (terms, counts) in enumerate(zip(queries.terms, queries.counts, strict=True)):
                dense[terms] = counts
                tree.search(q, dense, best[q], k)
                dense[terms] = 0
        rows = [(q, None if doc == -_NO_ID else -doc, score) for q, found in enumerate(best) for score, doc in found]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["query", "doc_id", "score"])

    found = stored.filter("n IS NOT NULL").select("doc_id", "n", "terms", "tfs")
    return found.mapInArrow(run, "query long, doc_id long, score long")


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    query_terms: int = QUERY_TERMS,
    block_docs: int = BLOCK_DOCS,
    block_entries: int = BLOCK_ENTRIES,
    leaf_docs: int = LEAF_DOCS,
) -> DataFrame:
    """The ``k`` highest-scoring documents above 0 of each query: ``item_id``, ``rank`` from 1, ``doc_id``, ``score``.

    ``docs`` has ``doc_id`` and ``text``, ``queries`` ``item_id`` and ``text``; other columns are not read. Terms are the
    runs of ASCII letters and digits and of everything beyond ASCII, A-Z lowered; a null or empty text has none. Such a
    document is not counted and never found, such a query gives no rows, nor does a table without rows. Equal scores go
    by ascending doc_id, a missing one last. Rows that share a doc_id are documents of their own, and rows that share an
    item_id queries of their own.
    """
    spark: SparkSession = docs.sparkSession
    items = dict(queries.dtypes)["item_id"]
    out = None
    for number, block in enumerate(query_blocks(queries, query_terms)):
        stored = vectors(docs, block.vocabulary)
        stats = statistics(stored, len(block.vocabulary))
        found = best_of_tasks(stored, block, stats, k, block_docs, block_entries, leaf_docs)
        order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"query long, item_id {items}")
        # One row for each query of the block.
        part = materialise(ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"), f"ranked-{number}")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], f"item_id {items}, rank int, doc_id long, score long") if out is None else out
