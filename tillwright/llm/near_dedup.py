"""Near-duplicate groups: circulant MinHash, banding, exact Jaccard verification, connected components.

A document is the set of its word shingles. Two random permutations of one universe make its signature: the first
spreads the shingles over the universe, the second is read there and at the following places, so that coordinate k is
the least value of the second permutation shifted circularly by k. Coordinates are cut into bands; documents that agree
in a band share a bucket and may be alike.

What keeps the work linear, with all links kept:

* documents with one and the same set are one class, represented by the smallest id, before anything else is done;
* in a bucket every member is first compared with one pivot only (the member with the least hash), and what is linked
  becomes components;
* members outside the largest component of their bucket are then compared with a few of its members, drawn by hash;
* what is then still in a bucket of several components is searched by prefix: the shingles of these sets are counted and
  put into one order, frequent ones last, and two sets that are alike enough share one among the first of both: of the
  smaller set the first ninth, of the larger the first fifth. Copies of one text with edits of their own begin with these, so that
  no pair of them arises unless they are links. Pairs that share such a shingle, in places that leave room for the
  common part that a link takes, and lie in different components, are compared in full. No link is lost.

All comparisons use the full sets. Intermediate tables are in the shared folder, so that lost executors cost a task and
not the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.token_files import release_memory
from tillwright.session import materialise

SHINGLE_WORDS = 5
# A link takes 100 * intersection >= PERCENT * union.
PERCENT = 80
# A pair of similarity 0.8 shares no bucket with probability (1 - 0.8**7)**50 < 1e-5, one of 0.9 with less than 1e-14.
BANDS, BAND_ROWS = 50, 7
UNIVERSE_BITS = 20
# Ids of compared documents are broadcast up to this number (8 bytes each), else joined.
BROADCAST_IDS = 2_000_000
# Members of the largest component that an outsider meets in a bucket before it is compared with all.
DRAWN = 16
# Shingles that at least so many of the sets searched by prefix hold are looked up by broadcast, the most frequent ones up to
# this number (16 bytes each); the others are joined.
HOT_SETS, HOT_SHINGLES = 100, 50_000
# Hashes of words that a task keeps (about 140 bytes each), and documents whose sets it holds at a time.
KEPT_WORDS, HELD_SETS = 100_000, 1_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """64-bit hash by word, kept for the words met last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(columns: np.ndarray) -> np.ndarray:
    """One 64-bit hash of each row of a (rows, n) array of 64-bit hashes, in order."""
    out = np.zeros(len(columns), dtype=np.uint64)
    for k in range(columns.shape[1]):
        out = (out ^ columns[:, k]) * _ODD
        out ^= out >> np.uint64(29)
    return out


def shingle_set(text: bytes, hashes: dict, shingle_words: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; A-Z lower-cased, words apart by blanks and \\t to \\r.

    A text with fewer words than a shingle has its whole word sequence as its only shingle; without words it has none.
    """
    words = text.lower().split()
    n = min(shingle_words, len(words))
    if not n:
        return np.empty(0, dtype=np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    return np.unique(_mix(np.lib.stride_tricks.sliding_window_view(each, n)))


class _Circulant:
    """Band keys of shingle sets, from two permutations of the universe."""

    def __init__(self, bands: int, band_rows: int) -> None:
        size, k = 1 << UNIVERSE_BITS, bands * band_rows
        rng = np.random.default_rng(20)
        self.first = rng.permutation(size).astype(np.uint32)
        second = rng.permutation(size).astype(np.uint32)
        self.second = np.lib.stride_tricks.sliding_window_view(np.concatenate([second, second[:k]]), k)
        self.shape = (bands, band_rows)
        self.names = np.arange(bands, dtype=np.uint64)[:, None]

    def keys(self, found: np.ndarray) -> np.ndarray:
        places = self.first[(found >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)]
        least = np.full(self.second.shape[1], 1 << UNIVERSE_BITS, dtype=np.uint32)
        for at in range(0, len(places), 2048):  # 3 MB at a time, whatever the length of the text
            np.minimum(least, self.second[places[at : at + 2048]].min(axis=0), out=least)
        return _mix(np.hstack([self.names, least.reshape(self.shape).astype(np.uint64)])).view(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, at most ``HELD_SETS`` at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, HELD_SETS):
            yield batch.slice(at, HELD_SETS)


def signatures(docs: DataFrame, shingle_words: int, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``digest`` of the set (null if it is empty) and ``bands``, the bucket keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        hashes, circulant = _WordHashes(), _Circulant(bands, band_rows)
        for batch in _pieces(batches):
            sizes, digests, keys = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                found = shingle_set(text.as_py() or b"", hashes, shingle_words)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(circulant.keys(found) if len(found) else [])
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "bands"])
        # The worker serves other stages next, and must not hold this task's words and sets meanwhile.
        del hashes, circulant
        release_memory()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, bands array<long>"
    )


def _sets(docs: DataFrame, ids: DataFrame, shingle_words: int) -> DataFrame:
    """``node`` and its shingle set, for the documents named in ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        hashes = _WordHashes()
        for batch in _pieces(batches):
            sets = [shingle_set(t or b"", hashes, shingle_words).view(np.int64) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "found"])
            del sets
        del hashes
        release_memory()

    few = ids.count() <= BROADCAST_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    return texts.join(F.broadcast(ids) if few else ids, "node", "left_semi").mapInArrow(run, "node long, found array<long>")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a``, ``b`` of ``pairs`` with the sizes of the intersection (``both``) and the union (``either``) of their sets.

    Two sets are held at a time, however long they are.
    """
    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("found").alias("found_b")), "b")
    with_both = with_b.join(sets.select(F.col("node").alias("a"), F.col("found").alias("found_a")), "a")
    sizes = F.size("found_a") + F.size("found_b")
    counted = with_both.select("a", "b", F.size(F.array_intersect("found_a", "found_b")).cast("long").alias("both"), sizes.cast("long").alias("sizes"))
    return counted.select("a", "b", "both", (F.col("sizes") - F.col("both")).alias("either"))


def _may_link(x: str, y: str) -> Column:
    """False where the sizes of two sets exclude a link."""
    return 100 * F.least(x, y) >= PERCENT * F.greatest(x, y)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the smallest node it is connected with (``component``), for all nodes of ``edges`` (``a``, ``b``).

    Every round hangs the neighbours of a node on their smallest one, first those above the node, then those below it;
    chains thus halve at least. It ends when a round changes nothing: all that is left are stars around the smallest.
    """
    stars = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
        around = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        above = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        below = above.groupBy("a").agg(F.min("b").alias("m"))
        hung = above.join(below, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = materialise(hung.unionByName(below.select("a", F.col("m").alias("b"))).distinct(), "links")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, bands: int = BANDS, band_rows: int = BAND_ROWS
) -> DataFrame:
    """One row per row of ``docs`` (integer ``doc_id``, ``text``; other columns are ignored): ``doc_id``, ``n_shingles``,
    ``component_id`` (smallest doc_id in the group) and ``kept`` (true for that document).

    A null or empty text, or one without words, has no shingles and is a group of its own. Rows with one doc_id are one
    document: what one of them is linked with, all are. Rows without a doc_id are in no group (null) and kept.
    """
    marked = materialise(signatures(docs, shingle_words, bands, band_rows), "signatures")
    classes = materialise(
        marked.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("size"), F.first("bands").alias("bands")),
        "classes",
    )
    buckets = classes.select(F.explode("bands").alias("bucket"), "node", "size")
    pivots = (
        buckets.groupBy("bucket")
        .agg(F.min(F.struct(F.xxhash64("node").alias("h"), F.col("node"), F.col("size"))).alias("pivot"), F.count("*").alias("members"))
        .filter("members > 1")
        .select("bucket", "members", F.col("pivot.node").alias("pivot"), F.col("pivot.size").alias("pivot_size"))
    )
    members = materialise(buckets.join(pivots, "bucket"), "members")
    sets = materialise(_sets(docs, members.select("node").distinct(), shingle_words), "sets")

    spokes = members.filter((F.col("node") != F.col("pivot")) & _may_link("size", "pivot_size"))
    spokes = spokes.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    compared = materialise(_compared(spokes, sets), "compared")
    links = compared.filter(f"100 * both >= {PERCENT} * either").select("a", "b")
    found = components(links)

    for search in (_drawn_pairs, _prefix_pairs):
        rest = search(members, sets, compared, found)
        if rest is None or (rest := materialise(rest, "unsettled")).isEmpty():
            continue
        compared = compared.unionByName(materialise(_compared(rest, sets), "compared"))
        links = compared.filter(f"100 * both >= {PERCENT} * either").select("a", "b")
        hung = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = components(hung.unionByName(links))

    grouped = classes.select("digest", "node").join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    whole = marked.select("doc_id", "n_shingles", "digest").join(grouped, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return whole.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", kept)


def _drawn_pairs(members: DataFrame, sets: DataFrame, compared: DataFrame, found: DataFrame) -> DataFrame:
    """Members outside the largest component of their bucket, with about ``DRAWN`` members of it, unless a bound excludes a
    link: the sizes of the sets, or their distances from the pivot (Jaccard distance obeys the triangle inequality)."""
    gap = F.lit(1.0) - F.col("both") / F.col("either")
    near = compared.select(F.col("a").alias("pivot"), F.col("b").alias("node"), gap.alias("gap"))
    placed = (
        members.filter("members > 2 AND node <> pivot")
        .join(near, ["pivot", "node"], "left")
        .join(found, "node", "left")
        .select("bucket", "node", "size", "gap", F.coalesce("component", "node").alias("component"))
    )
    shares = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = shares.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    slots = F.ceil(F.col("main.n") / DRAWN)
    open_ = placed.join(mixed.select("bucket", slots.alias("slots"), F.col("main.component").alias("main")), "bucket")
    one = open_.filter("component <> main").withColumn("slot", F.pmod(F.xxhash64("node", "bucket"), "slots"))
    two = open_.filter("component = main").withColumn("slot", F.pmod(F.xxhash64("node"), "slots"))
    columns = ["node", "size", "gap", "component"]
    one = one.select("bucket", "slot", "main", *[F.col(c).alias(f"{c}_1") for c in columns])
    two = two.select("bucket", "slot", *[F.col(c).alias(f"{c}_2") for c in columns])
    # Without a gap (the pivot's size excluded a link) nothing follows from it. The margin covers rounding.
    apart = F.coalesce(F.abs(F.col("gap_1") - F.col("gap_2")) > 1 - PERCENT / 100 + 1e-9, F.lit(False))
    pairs = one.join(two, ["bucket", "slot"]).filter((F.col("component_1") != F.col("component_2")) & _may_link("size_1", "size_2") & ~apart)
    return _not_compared(pairs, compared)


def _not_compared(pairs: DataFrame, compared: DataFrame) -> DataFrame:
    pairs = pairs.select(F.least("node_1", "node_2").alias("a"), F.greatest("node_1", "node_2").alias("b")).distinct()
    known = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.join(known, ["a", "b"], "left_anti")


def _prefixes(sets: DataFrame) -> DataFrame:
    """``shingle``, ``node``, ``size``, ``component``, ``place`` and ``indexed``: the beginnings of ``sets`` (``node``, ``size``,
    ``component``, ``found``) in the order of how many sets hold a shingle, without shingles of one component.

    The order covers all sets and is the same for each: first what only one component holds, which makes no pair and needs no
    row, then by number and hash. The most frequent shingles are looked up in a broadcast table of bounded size, so that the
    join by shingle has no hot key.
    """
    each = sets.select("node", "size", "component", F.explode("found").alias("shingle"))
    held = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    held = materialise(held.filter("lo < hi").select("shingle", "n"), "held")
    hot = held.filter(f"n >= {HOT_SETS}").orderBy(F.desc("n"), "shingle").limit(HOT_SHINGLES)
    hot = materialise(hot, "hot")
    often = each.join(F.broadcast(hot), "shingle")
    seldom = each.join(F.broadcast(hot.select("shingle")), "shingle", "left_anti").join(held, "shingle")
    own = Window.partitionBy("node")
    size, percent = F.col("size"), F.lit(PERCENT)
    # Of the larger set of a link, at most size - ceil(80 %) shingles are not in the other one; of the smaller, fewer.
    probe = size - F.ceil(percent * size / 100) + 1
    index = size - F.ceil(2 * percent * size / (100 + percent)) + 1
    place = size - F.count("*").over(own) + F.row_number().over(own.orderBy("n", "shingle"))
    placed = often.unionByName(seldom).withColumn("place", place).filter(F.col("place") <= probe)
    return placed.select("shingle", "node", "size", "component", "place", (F.col("place") <= index).alias("indexed"))


def _prefix_pairs(members: DataFrame, sets: DataFrame, compared: DataFrame, found: DataFrame) -> DataFrame | None:
    """Pairs of nodes of buckets with several components that share a shingle of their prefixes, and may be links."""
    placed = members.join(found, "node", "left").select("bucket", "node", "size", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    nodes = materialise(placed.join(mixed.select("bucket"), "bucket", "left_semi").select("node", "size", "component").distinct(), "open")
    if nodes.isEmpty():
        return None
    prefixes = materialise(_prefixes(materialise(sets.join(nodes, "node"), "open-sets")), "prefixes")
    # A shingle that one component has there, or none in the short prefix, makes no pair. Of the others, the members of the
    # largest component do not meet each other.
    shares = prefixes.groupBy("shingle", "component").agg(F.count("*").alias("n"), F.max("indexed").alias("any"))
    met = shares.groupBy("shingle").agg(F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("parts"), F.max("any").alias("any"))
    met = met.filter("parts > 1 AND any").select("shingle", F.col("main.component").alias("main"))
    of_many = prefixes.join(met, "shingle").withColumn("outside", F.col("component") != F.col("main"))
    columns = ["node", "size", "component", "place"]
    one = of_many.select("shingle", "outside", *[F.col(c).alias(f"{c}_1") for c in columns])
    two = of_many.filter("indexed").select("shingle", "outside", *[F.col(c).alias(f"{c}_2") for c in columns])
    outsiders = one.filter("outside").join(two.drop("outside"), "shingle")
    insiders = one.filter("NOT outside").join(two.filter("outside").drop("outside"), "shingle")
    joined = outsiders.drop("outside").unionByName(insiders.drop("outside"))
    larger = F.struct("size_1", "node_1") > F.struct("size_2", "node_2")
    # At the first shingle that both have, what can still be common must be enough for a link.
    room = 1 + F.least(F.col("size_1") - F.col("place_1"), F.col("size_2") - F.col("place_2"))
    enough = (100 + PERCENT) * room >= PERCENT * (F.col("size_1") + F.col("size_2"))
    pairs = joined.filter(larger & (F.col("component_1") != F.col("component_2")) & _may_link("size_1", "size_2") & enough)
    return _not_compared(pairs, compared)


def deduplicate(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest doc_id (all columns as they are).

    Of several rows with that doc_id, one is left, with the greatest text. Rows without a doc_id all stay.
    """
    kept = near_duplicates(docs.select("doc_id", "text"), shingle_words).filter("kept").select("doc_id").distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", whole)
    chosen = rows.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.max_by("doc", F.struct("text", F.xxhash64("doc"))).alias("doc"))
    return chosen.select("doc.*").unionByName(rows.filter("doc_id IS NULL").select("doc.*"))
