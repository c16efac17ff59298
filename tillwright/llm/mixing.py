"""Mixing sources to target weights.

The words of each source form one stream, cut into blocks of ``block_words``. A mix has as many slots as its targets
need; slots are dealt to output shards, and every shard draws how many of its slots each source gets (multinomially, by
what the sources still have to give, so that the totals come out exactly). The j-th slot of a source takes the block at
place j of a pseudorandom permutation of the source's block numbers; a second pass over a source is another permutation.
Blocks and documents then meet in a join by source and block number.

No slot depends on another, so shards can be made, and made again, independently; every draw comes from a fixed seed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window as W

from tillwright.llm.token_files import release_memory
from tillwright.session import materialise

BLOCK_WORDS = 64
SHARD_SLOTS = 1 << 18
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_PASSES = 2
# Pieces of a source's stream that are laid out one by one; it bounds what one task of a hot source holds, not the data.
STRIPES = 1024
# What ends a word: the blank and \t to \r.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_starts(text: bytes) -> np.ndarray:
    """Byte positions at which words begin."""
    blank = _BLANK[np.frombuffer(text, dtype=np.uint8)]
    return np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(blank) else np.empty(0, dtype=np.int64)


def sizes_of(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``source`` and ``size``, the number of words of the text (null: 0), written once.

    ``docs`` must be a stored table, so that its rows are numbered alike at every reading.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(word_starts(t or b"")) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sizes, pa.int64())], [*names, "size"])
        release_memory()

    names = ["row", "doc_id", "source"]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "text")
    return materialise(rows.mapInArrow(run, rows.select(*names).withColumn("size", F.lit(0).cast("long")).schema), "sizes")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_passes: float = MAX_PASSES) -> DataFrame:
    """One row per source: ``source``, ``source_no``, ``source_size``, ``target`` (words the mix should take from it).

    Sources by code point, null last, get the weights in turn. ``share`` of all words is divided by weight; a target ends
    at ``max_passes`` times its source, and what is above goes to the others by weight until none is above. That end
    state is found in one step: in ascending order of limit / weight, sources are full as long as an equal share of what
    is left, for their weight, would be more than their limit. The table has one row per source, so its windows are small.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    position = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (position % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * float(max_passes)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    fill = W.orderBy("_ratio", "source_no")
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    after = fill.rowsBetween(0, W.unboundedFollowing)
    ranked = (
        per_source.withColumn("source_no", position.cast("int"))
        .withColumn("_weight", weight)
        .withColumn("_cap", cap)
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_budget", F.sum("source_size").over(everything) * float(share))
        .withColumn("_left", F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.sum("_weight").over(after))
    )
    # The level only rises while sources fill up; the first one that does not fill sets it for all after it.
    level = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "source_no", "_level"))).over(everything)
    shared = F.coalesce(level["_level"], F.lit(float("inf")))
    target = F.least(F.col("_cap"), F.col("_weight") * shared)
    return ranked.select("source", "source_no", "source_size", target.alias("target"))


@dataclass(frozen=True)
class Mix:
    """``targets`` by source; ``pieces`` of blocks (source_no, block, row, size, first, words); ``slots`` of the mix
    (shard, slot, source_no, turn, block), each to be filled with the pieces of its block."""

    targets: DataFrame
    pieces: DataFrame
    slots: DataFrame


def mix(
    sizes: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 1, weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE, max_passes: float = MAX_PASSES,
) -> Mix:
    """Lay out the blocks of ``sizes`` (``row``, ``doc_id``, ``source``, ``size``) and draw the mix.

    Every row is a document of its own, also if its doc_id repeats. Rows without words fill no block. A null doc_id or
    source is a value like any other. Empty tables give empty mixes.
    """
    wanted = materialise(targets(sizes, weights, share, max_passes), "targets")
    return Mix(wanted, _pieces(_placed(sizes, wanted), block_words), _slots(wanted, block_words, shard_slots, seed))


def _placed(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every document with ``at``, the place of its first word in the stream of its source.

    A stream runs through its stripes (by hash of the id) and through each by id; so the running sum inside a stripe and
    the sums of the stripes before it give the place, and no source is ever in one task.
    """
    numbered = sizes.join(wanted.select(F.col("source").alias("_source"), "source_no"), F.col("source").eqNullSafe(F.col("_source")))
    striped = numbered.drop("_source").withColumn("stripe", F.pmod(F.xxhash64("doc_id"), F.lit(STRIPES)))
    inside = W.partitionBy("source_no", "stripe").orderBy("doc_id", "row").rowsBetween(W.unboundedPreceding, 0)
    running = striped.withColumn("_run", F.sum("size").over(inside))
    per_stripe = striped.groupBy("source_no", "stripe").agg(F.sum("size").alias("_sum"))
    earlier = W.partitionBy("source_no").orderBy("stripe").rowsBetween(W.unboundedPreceding, 0)
    offsets = per_stripe.select("source_no", "stripe", (F.sum("_sum").over(earlier) - F.col("_sum")).alias("_before"))
    at = F.col("_before") + F.col("_run") - F.col("size")
    return running.join(offsets, ["source_no", "stripe"]).select("row", "source_no", "size", at.alias("at"))


def _pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """What each document gives to each block: ``first`` word in the document and number of ``words``."""
    b = F.lit(block_words).cast("long")
    cut = placed.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("at") / b), F.floor((F.col("at") + F.col("size") - 1) / b)))
    )
    first = F.greatest(F.col("block") * b - F.col("at"), F.lit(0).cast("long"))
    end = F.least((F.col("block") + 1) * b - F.col("at"), F.col("size"))
    return cut.select("source_no", "block", "row", "size", first.alias("first"), (end - first).alias("words"))


def _slots(wanted: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """Draw the shards from the table of targets (one task: its rows are sources, its output counts by shard), then
    unfold the counts to slots and map each to a block."""
    # A source's last block may be short. Its slots are as many as its target has blocks of the mean length.
    n_blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    quota = F.round(F.col("target") / F.col("source_size") * F.col("blocks")).cast("long")
    plan = wanted.filter("source_size > 0").withColumn("blocks", n_blocks).withColumn("quota", quota)
    plan = plan.select("source_no", "blocks", "quota").coalesce(1).sortWithinPartitions("source_no")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        names, blocks, quotas = (np.array(rows.column(c)) for c in ("source_no", "blocks", "quota"))
        given = np.zeros(len(quotas), dtype=np.int64)
        for shard in range(-(-int(quotas.sum()) // shard_slots)):
            counts = _drawn(quotas - given, shard_slots, np.random.default_rng([seed, shard]))
            taken = np.flatnonzero(counts)
            columns = [np.full(len(taken), shard), names[taken], blocks[taken], given[taken], counts[taken]]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["shard", "source_no", "blocks", "start", "n"])
            given += counts

    drawn = plan.mapInArrow(draw, "shard long, source_no long, blocks long, start long, n long")
    # Slots are unfolded in runs of 1024, so that the slots of a shard are spread over tasks: a given number, since the
    # runs are few bytes and adaptive execution would put them into one.
    tasks = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = drawn.select(
        "shard", "source_no", "blocks", F.col("start"), F.col("n"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / 1024))).alias("run")
    ).repartition(tasks, "shard", "source_no", "run")
    lo = F.col("start") + F.col("run") * 1024
    hi = F.least(F.col("start") + F.col("n"), lo + 1024) - 1
    places = runs.select("shard", F.col("source_no").cast("int").alias("source_no"), "blocks", F.explode(F.sequence(lo, hi)).alias("place"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, blocks, place = (np.array(batch.column(c)).astype(np.int64) for c in ("source_no", "blocks", "place"))
            turn = place // np.maximum(blocks, 1)
            block = permuted(place % np.maximum(blocks, 1), blocks, source, turn, seed)
            columns = [batch.column("shard"), batch.column("place"), batch.column("source_no"), pa.array(turn), pa.array(block)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "slot", "source_no", "turn", "block"])

    return places.mapInArrow(look_up, "shard long, slot long, source_no int, turn long, block long")


def _drawn(left: np.ndarray, slots: int, rng: np.random.Generator) -> np.ndarray:
    """Slots by source: multinomial by what is left of each, nobody getting more than that."""
    slots = min(slots, int(left.sum()))
    counts = np.zeros(len(left), dtype=np.int64)
    while missing := slots - int(counts.sum()):
        rest = left - counts
        counts = np.minimum(left, counts + rng.multinomial(missing, rest / rest.sum()))
    return counts


def permuted(place: np.ndarray, blocks: np.ndarray, source: np.ndarray, turn: np.ndarray, seed: int) -> np.ndarray:
    """Image of each place in the permutation of 0 … blocks - 1 that belongs to its source and turn.

    A four-round Feistel network permutes the numbers of an even count of bits that just holds the blocks; where it
    leads outside, it is followed further until it comes back.
    """
    counts, which = np.unique(blocks, return_inverse=True)
    half = np.array([(max(int(n) - 1, 1).bit_length() + 1) // 2 for n in counts], dtype=np.uint64)[which]
    mask = (np.uint64(1) << half) - np.uint64(1)
    key = (source.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (turn.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) ^ np.uint64(seed)
    x = place.astype(np.uint64)
    open_ = np.ones(len(x), dtype=bool)
    while open_.any():
        i = np.flatnonzero(open_)
        left, right = x[i] >> half[i], x[i] & mask[i]
        for k in range(4):
            f = (right ^ key[i]) + np.uint64(k + 1) * np.uint64(0x165667B19E3779F9)
            f = (f ^ (f >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & mask[i])
        x[i] = (left << half[i]) | right
        open_[i] = x[i] >= blocks[i].astype(np.uint64)
    return x.astype(np.int64)


def taken(sizes: DataFrame, mixed: Mix) -> DataFrame:
    """``sizes`` with ``source_size``, ``target`` and ``taken``: the words the mix takes of the row, repeats counted."""
    times = mixed.slots.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    # Spark takes slots for as small as the targets they are unfolded from; without the hint it would broadcast them.
    per_row = mixed.pieces.join(times.hint("merge"), ["source_no", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    wanted = mixed.targets.select(F.col("source").alias("_source"), "source_size", "target")
    return (
        sizes.join(per_row, "row", "left")
        .join(wanted, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents, with the columns of ``docs`` (a stored table).

    A document gives one row for each turn in which blocks of it were drawn (at most ``max_passes``); its text there is
    what the blocks hold of it: all of it, or the passages taken, in order and on lines of their own.
    """
    mixed = mix(sizes_of(docs), **options)
    parts = (
        mixed.pieces.join(mixed.slots.hint("merge"), ["source_no", "block"])
        .groupBy("row", "turn")
        .agg(F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("first", "words"))).alias("parts"))
    )
    names = docs.columns
    text = next(c for c in names if c.lower() == "text")
    others = F.struct(*[F.col(f"`{c}`") for c in names if c != text], F.lit(0).alias("_")).alias("others")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{text}`").alias("text"), others).join(parts, "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, parts, sizes = (batch.column(c).to_pylist() for c in ("text", "parts", "size"))
            cut = [_passages(t.encode(), p, n).decode() for t, p, n in zip(bodies, parts, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("others"), pa.array(cut, pa.string())], ["others", "text"])
            del bodies, parts, cut
        release_memory()

    schema = StructType([rows.schema["others"], StructField("text", StringType())])
    cut = rows.select("text", "others", "parts", "size").mapInArrow(run, schema)
    return cut.select(*[F.col("text").alias(c) if c == text else F.col("others").getField(c).alias(c) for c in names])


def _passages(text: bytes, parts: list[dict], size: int) -> bytes:
    spans: list[list[int]] = []
    for part in parts:
        if spans and spans[-1][1] == part["first"]:
            spans[-1][1] += part["words"]
        else:
            spans.append([part["first"], part["first"] + part["words"]])
    if spans == [[0, size]]:
        return text
    starts = word_starts(text)
    return b"\n".join(text[starts[a] : starts[b] if b < size else len(text)].strip(b" \t\n\r\v\f") for a, b in spans)
