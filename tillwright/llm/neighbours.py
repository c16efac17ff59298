"""Approximate nearest neighbours by largest inner product, from a tiny index of stable projections.

Vectors get one more component, which makes all of them as long as the longest, and queries are scaled to that length;
then the largest inner product is the smallest Euclidean distance. A few projections on normally distributed directions
follow: the squared projected distance of two points is their squared distance times a chi-square variable.

The projections are indexed by a kd-tree whose upper part cuts the table into cells, and whose lower part is built in the
task that holds a cell. A search reads projected neighbours in ascending order, leaf by leaf, verifies them on the
original vectors, and stops when the chi-square test holds: a point that is not yet read, and nearer than the k-th best
one, would have come by now with probability ``confidence``. Each neighbour is thus found with that probability at least.

A query first searches its own cell, which bounds its k-th distance and with it the cells that can still hold a
neighbour; only those are searched next. The splits of the upper tree come from a bounded sample, every row is indexed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.session import materialise

DIMENSIONS = 12
CONFIDENCE = 0.9
# Rows of a cell that one task holds at a time; larger cells (many equal vectors) are searched in parts.
PART_ROWS = 8_192
LEAF_ROWS = 32
SAMPLE_ROWS = 16_384
# Queries that meet a part of a cell in one task.
QUERY_ROWS = 65_536


def chi_square_quantile(p: float, m: int) -> float:
    """x with P(chi-square of m degrees, m even, <= x) = p."""
    low, high = 0.0, 1000.0
    while high - low > 1e-9:
        x = (low + high) / 2
        tail = math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(m // 2))
        low, high = (x, high) if 1 - tail < p else (low, x)
    return high


def usable(vector: str) -> Column:
    """True for vectors that take part: not null, not zero, all components present and finite."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


class Projection:
    """Stable projections of lengthened vectors."""

    def __init__(self, width: int, longest: float, dimensions: int = DIMENSIONS) -> None:
        self.longest = longest
        self.directions = np.random.default_rng(6).standard_normal((width + 1, dimensions))

    def points(self, x: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0.0))
        return x @ self.directions[:-1] + more[:, None] * self.directions[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return self.scaled(q) @ self.directions[:-1]

    def scaled(self, q: np.ndarray) -> np.ndarray:
        return q * (self.longest / np.sqrt((q * q).sum(axis=1)))[:, None]


def split_points(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Upper tree: dimension and value of each inner node, by level; children of node i are 2i + 1 and 2i + 2."""
    nodes: list[tuple[int, float]] = []
    level = [np.arange(len(points))]
    for _ in range(depth):
        below = []
        for rows in level:
            spread = np.ptp(points[rows], axis=0) if len(rows) else np.zeros(points.shape[1])
            axis = int(np.argmax(spread))
            value = float(np.median(points[rows, axis])) if len(rows) else 0.0
            nodes.append((axis, value))
            right = points[rows, axis] > value
            below += [rows[~right], rows[right]]
        level = below
    return nodes


def cells_of(points: np.ndarray, nodes: list[tuple[int, float]], depth: int) -> np.ndarray:
    at = np.zeros(len(points), dtype=np.int64)
    axes, values = np.array([n[0] for n in nodes], dtype=np.int64), np.array([n[1] for n in nodes])
    for _ in range(depth):
        at = 2 * at + 1 + (points[np.arange(len(points)), axes[at]] > values[at])
    return at - ((1 << depth) - 1)


class Leaves:
    """Lower tree: points of a part of a cell in leaves of at most ``LEAF_ROWS``, each with its bounding box."""

    def __init__(self, points: np.ndarray) -> None:
        order, todo, ends = [], [np.arange(len(points))], []
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF_ROWS:
                order.append(rows)
                ends.append(len(rows))
                continue
            axis = int(np.argmax(np.ptp(points[rows], axis=0)))
            half = np.argpartition(points[rows, axis], len(rows) // 2)
            todo += [rows[half[: len(rows) // 2]], rows[half[len(rows) // 2 :]]]
        self.rows = np.concatenate(order)
        self.starts = np.concatenate([[0], np.cumsum(ends)])
        self.points = points[self.rows]
        self.low = np.minimum.reduceat(self.points, self.starts[:-1])
        self.high = np.maximum.reduceat(self.points, self.starts[:-1])


def box_distances(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point from boxes."""
    gap = np.maximum(np.maximum(low - point, point - high), 0.0)
    return (gap * gap).sum(axis=-1)


class Part:
    """Rows of one cell (or of a part of it), searched query by query."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projection: Projection) -> None:
        self.leaves = Leaves(projection.points(vectors))
        self.ids, self.vectors = ids[self.leaves.rows], vectors[self.leaves.rows]
        self.projection = projection

    def search(self, query_id: int, query: np.ndarray, bound: float, k: int, quantile: float) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows found (ids, inner products). ``bound``: a squared distance within which k rows are known."""
        point = self.projection.queries(query[None])[0]
        leaves, longest = self.leaves, self.projection.longest
        gaps = box_distances(point, leaves.low, leaves.high)
        order = np.argsort(gaps, kind="stable")
        gaps = gaps[order]
        # Squared distance of lengthened and scaled vectors, from the inner product.
        scale = 2 * longest / math.sqrt(query @ query)
        best, scores = np.empty(0, np.int64), np.empty(0)
        at, step = 0, 8
        while at < len(order) and gaps[at] <= quantile * bound:
            # Few leaves first, for a bound, then more at a time.
            end = min(at + step, int(np.searchsorted(gaps, quantile * bound, "right")))
            rows = np.concatenate([np.arange(leaves.starts[leaf], leaves.starts[leaf + 1]) for leaf in order[at:end]])
            at, step = end, step * 4
            ahead = leaves.points[rows] - point
            rows = rows[(np.einsum("ij,ij->i", ahead, ahead) <= quantile * bound) & (self.ids[rows] != query_id)]
            if not len(rows):
                continue
            best, scores = np.concatenate([best, rows]), np.concatenate([scores, self.vectors[rows] @ query])
            if len(best) > k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                near = scores >= kth - 1e-9 * longest * longest  # ties stay until the exact scores are known
                best, scores = best[near], scores[near]
            if len(best) >= k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                bound = min(bound, max(2 * longest * longest - scale * kth, 0.0) * (1 + 1e-9) + 1e-12)
        exact = (self.vectors[best] * query).sum(axis=1)
        ids = self.ids[best]
        first = np.lexsort((ids, -exact))[:k]
        return ids[first], exact[first]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, confidence: float = CONFIDENCE, dimensions: int = DIMENSIONS,
    sample_rows: int = SAMPLE_ROWS, part_rows: int = PART_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (inner product) of the k nearest rows found of each query.

    ``vectors`` has an integer ``vec_id`` and an array ``embedding``; other columns are ignored. Every row but the
    query's own id is a candidate; equal scores rank by smaller vec_id. Rows without an id or a usable vector, and rows
    whose number of components is not the most frequent one, take no part; with fewer candidates than k, all are
    returned. Of rows with one vec_id each can be returned, and each asks as a query of its own under that id (its
    neighbours are ranked together).
    """
    spark = vectors.sparkSession
    clean = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks")
    ).filter(F.col("vec_id").isNotNull() & usable("x"))
    kinds = clean.groupBy(F.size("x").alias("width")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)).alias("square")
    )
    kind = kinds.orderBy(F.desc("n"), F.desc("width")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if kind is None:
        return spark.createDataFrame([], schema)
    clean = clean.filter(F.size("x") == kind["width"])
    projection = (kind["width"], math.sqrt(kind["square"]), dimensions)
    quantile = chi_square_quantile(confidence, dimensions)

    sample = clean.orderBy(F.xxhash64("vec_id", "x")).limit(sample_rows).select("x").toArrow()
    points = Projection(*projection).points(_matrix(sample.column("x").combine_chunks()))
    depth = max(0, min(math.ceil(math.log2(max(1, kind["n"] / part_rows))), int(math.log2(max(1, len(points) / 8)))))
    nodes = split_points(points, depth)
    indexed = materialise(_in_cells(clean, projection, nodes, depth), "cells")

    # One row for each cell, of which there are at most sample_rows / 8.
    per_cell = indexed.groupBy("cell").agg(
        F.count("*").alias("n"),
        *[F.min(F.col("p")[i]).alias(f"lo{i}") for i in range(dimensions)],
        *[F.max(F.col("p")[i]).alias(f"hi{i}") for i in range(dimensions)],
    )
    boxes = sorted(tuple(r) for r in per_cell.collect())
    cells = np.array([b[0] for b in boxes], dtype=np.int64)
    parts = np.array([-(-b[1] // part_rows) for b in boxes], dtype=np.int64)
    low, high = np.array([b[2 : 2 + dimensions] for b in boxes]), np.array([b[2 + dimensions :] for b in boxes])
    queries = indexed.filter("asks").select(F.col("vec_id").alias("query_id"), "x", "cell")
    n_queries = queries.count()
    blocks = max(1, -(-n_queries // QUERY_ROWS))
    shared = spark.sparkContext.broadcast((cells, parts, low, high))

    def route(first: bool) -> DataFrame:
        """Queries with the parts they are searched in: first those of the own cell, then what the bound leaves."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells, parts, low, high = shared.value
            space = Projection(*projection)
            for batch in batches:
                x = _matrix(batch.column("x"))
                own = np.searchsorted(cells, batch.column("cell").to_numpy())
                bounds = batch.column("bound").to_numpy(zero_copy_only=False)
                rows, to, part = [], [], []
                for i, point in enumerate(space.queries(x) if len(x) else ()):
                    if first:
                        wanted = own[i : i + 1]
                    else:
                        reach = box_distances(point, low, high) <= quantile * bounds[i]
                        reach[own[i]] = False
                        wanted = np.flatnonzero(reach)
                    each = parts[wanted]
                    rows.append(np.full(int(each.sum()), i))
                    to.append(np.repeat(cells[wanted], each))
                    part.append(np.concatenate([np.arange(n) for n in each]) if len(each) else np.empty(0, np.int64))
                rows_, to_, part_ = (np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64) for c in (rows, to, part))
                for at in range(0, len(rows_), 10_000):
                    some = pa.array(rows_[at : at + 10_000])
                    columns = [pa.array(to_[at : at + 10_000]), pa.array(part_[at : at + 10_000]), *(batch.column(c).take(some) for c in ("query_id", "x", "bound"))]
                    yield pa.RecordBatch.from_arrays(columns, ["cell", "part", "id", "x", "bound"])

        source = queries.withColumn("bound", F.lit(float("inf"))) if first else queries.join(bounds, "query_id", "left").fillna(float("inf"), ["bound"])
        routed = source.select("query_id", "x", "cell", "bound").mapInArrow(run, "cell long, part long, id long, x array<double>, bound double")
        return routed.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))

    per_part = spark.createDataFrame([(int(c), int(n)) for c, n in zip(cells, parts, strict=True)], "cell long, parts long")
    # At most sample_rows / 8 rows.
    candidates = indexed.join(F.broadcast(per_part), "cell").select(
        "cell", F.pmod(F.xxhash64("vec_id"), "parts").alias("part"), F.col("vec_id").alias("id"), "x", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    )

    home = materialise(_searched(candidates, route(True), projection, k, quantile), "home")
    # The k-th best of the own cell bounds the distance; of equal ids the loosest bound holds for all.
    twice = 2 * projection[1] ** 2
    ranked = home.withColumn("_rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    bounds = ranked.filter(F.col("_rank") == k).select("query_id", F.col("score").alias("kth"))
    lengths = queries.groupBy("query_id").agg(F.max(F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))).alias("length"), F.count("*").alias("rows"))
    bounds = bounds.join(lengths, "query_id").select(
        "query_id",
        F.when(F.col("rows") == 1, F.greatest(F.lit(twice) - 2 * F.col("kth") * projection[1] / F.col("length"), F.lit(0.0)) * (1 + 1e-9) + 1e-12)
        .otherwise(float("inf")).alias("bound"),
    )
    found = home.unionByName(_searched(candidates, route(False), projection, k, quantile))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _in_cells(clean: DataFrame, projection: tuple[int, float, int], nodes: list[tuple[int, float]], depth: int) -> DataFrame:
    """Rows with their projections ``p`` and their ``cell``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Projection(*projection)
        for batch in batches:
            if not len(batch):
                continue
            points = space.points(_matrix(batch.column("x")))
            cell = cells_of(points, nodes, depth)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, points.size + 1, points.shape[1]), pa.int32()), pa.array(points.ravel()))
            columns = [batch.column("vec_id"), batch.column("x"), batch.column("asks"), flat, pa.array(cell)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "x", "asks", "p", "cell"])

    return clean.select("vec_id", "x", "asks").mapInArrow(run, "vec_id long, x array<double>, asks boolean, p array<double>, cell long")


def _searched(candidates: DataFrame, routed: DataFrame, projection: tuple[int, float, int], k: int, quantile: float) -> DataFrame:
    """Each part of a cell meets its queries in one task, candidates first; queries then stream past them."""
    both = candidates.withColumn("bound", F.lit(None).cast("double")).withColumn("ask", F.lit(0)).unionByName(routed.withColumn("ask", F.lit(1)))
    key = ["cell", "part", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Projection(*projection)
        at: tuple[int, ...] | None = None
        ids: list[np.ndarray] = []
        rows: list[np.ndarray] = []
        part: Part | None = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in (*key, "ask")], axis=1)
            if not len(keys):
                continue
            x, own = _matrix(batch.column("x")), batch.column("id").to_numpy()
            bound = batch.column("bound").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1), len(keys)]
            asked, near, scores = [], [], []
            for a, b in zip(edges, edges[1:], strict=False):
                if at != tuple(keys[a, :3]):
                    at, ids, rows, part = tuple(keys[a, :3]), [], [], None
                if keys[a, 3] == 0:
                    ids.append(own[a:b])
                    rows.append(x[a:b])
                    continue
                if part is None and ids:
                    part = Part(np.concatenate(ids), np.concatenate(rows), space)
                for i in range(a, b) if part else ():
                    found, score = part.search(own[i], x[i], bound[i], k, quantile)
                    asked.append(np.full(len(found), own[i]))
                    near.append(found)
                    scores.append(score)
            if asked:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (asked, near, scores)], ["query_id", "vec_id", "score"])

    return both.repartition(*key).sortWithinPartitions(*key, "ask").mapInArrow(run, "query_id long, vec_id long, score double")
