"""Packing of documents into token sequences of one length, by minimum bin slack.

A document longer than a sequence gives full sequences; its rest, and every shorter document, waits. Waiting pieces are
known by their lengths and how many there are of each. A sequence takes the longest waiting piece, and a subset-sum table
over the others, a bit for each sum that can be reached, tells how close to its end they can come; going back through
the table gives how many of each length to take. What the lengths allow once is repeated as often as they allow it. If
the best choice leaves a gap, the gap is filled with the beginning of the longest piece that still waits, whose rest
waits on. What is too little for a sequence at the end of a task becomes sequences of powers of two, which take no
padding: no sequence is padded at all, and beside long documents only few are cut.

Texts are encoded where they are read and never moved. A task holds ``BUFFER_IDS`` waiting ids at most, and the ids of
the document it reads.
"""

from __future__ import annotations

import re
import sys
import types
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.llm.token_files import CACHED_WORDS, Encoder
from tillwright.session import materialise

SEQUENCE_IDS = 4096
# Ids that wait in a task until sequences are made of them.
BUFFER_IDS = 4_000_000
_BATCH_BYTES = 4 << 20
_BLANK = re.compile(rb"[ \t\n\r\x0b\x0c]")
_SCHEMA = "part int, sequence long, offset long, doc_id long, start long, length long, doc_tokens long, ids binary"


# Bytes of text that are encoded together.
CHUNK_BYTES = 8 << 20


class ChunkEncoder:
    """Token ids of many texts at a time: each different word of a chunk is looked up once, and the ids of all words are
    gathered by the places of theirs."""

    def __init__(self, tokenizer: str, end_id: int | None) -> None:
        self.single = Encoder(tokenizer, None)
        self.end = np.array([] if end_id is None else [end_id], dtype="<u4").tobytes()

    def __call__(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        held: list[bytes] = []
        size = 0
        for text in texts:
            if held and size + len(text) > CHUNK_BYTES:
                yield from self._chunk(held)
                held, size = [], 0
            if len(text) > CHUNK_BYTES:
                yield b"".join(ids for part in self._parts(text) for ids in self._encoded([part])) + self.end
                continue
            held.append(text)
            size += len(text)
        yield from self._chunk(held)

    def _parts(self, text: bytes) -> Iterator[bytes]:
        """Parts of a long text, cut at blanks; a text with a special string stays whole."""
        if any(s in text.lower() for s in self.single.special_lower):
            yield text
            return
        at = 0
        while at < len(text):
            blank = _BLANK.search(text, at + CHUNK_BYTES)
            end = blank.start() if blank else len(text)
            yield text[at:end]
            at = end

    def _chunk(self, texts: list[bytes]) -> Iterator[bytes]:
        for ids in self._encoded(texts) if texts else ():
            yield ids + self.end

    def _encoded(self, texts: list[bytes]) -> list[bytes]:
        single, whole = self.single, {}
        known = single.known
        if len(known) > CACHED_WORDS:
            known.clear()
            single.pieces.clear()
        plain = pa.array(texts, pa.large_binary()).view(pa.large_string())
        if single.lowers:
            low = pc.ascii_lower(plain)
            for special in single.special_lower:
                for i in np.flatnonzero(pc.match_substring(low, special.decode()).to_numpy(zero_copy_only=False)):
                    whole[int(i)] = next(single([texts[i]]))
            plain = low
        words = pc.ascii_split_whitespace(plain)
        codes = words.values.dictionary_encode()
        found = [known[w] if w else b"" for w in codes.dictionary.view(pa.large_binary()).to_pylist()]
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        lengths = np.array([len(f) // 4 for f in found], dtype=np.int64)
        begins = np.cumsum(lengths) - lengths
        places = codes.indices.to_numpy()
        counts = lengths[places]
        ends = np.concatenate([[0], np.cumsum(counts)])
        gathered = ids[np.arange(ends[-1]) + np.repeat(begins[places] - ends[:-1], counts)]
        bounds = ends[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return [whole[i] if i in whole else gathered[bounds[i] : bounds[i + 1]].tobytes() for i in range(len(texts))]


def worker_encoder(tokenizer: str, end_id: int | None) -> ChunkEncoder:
    """The encoder of this Python worker, which keeps the words it knows for the worker's later tasks."""
    kept = sys.modules.setdefault("_tillwright_worker", types.ModuleType("_tillwright_worker")).__dict__
    if kept.get("encoder_of") != (tokenizer, end_id):
        kept["encoder"], kept["encoder_of"] = ChunkEncoder(tokenizer, end_id), (tokenizer, end_id)
    return kept["encoder"]


class Piece(NamedTuple):
    doc_id: int | None
    doc_tokens: int
    start: int
    length: int
    ids: bytes  # uint32

    def cut(self, n: int) -> tuple[Piece, Piece]:
        """The first ``n`` ids, and the rest."""
        head = Piece(self.doc_id, self.doc_tokens, self.start, n, self.ids[: 4 * n])
        return head, Piece(self.doc_id, self.doc_tokens, self.start + n, self.length - n, self.ids[4 * n :])


def least_slack(lengths: Iterable[tuple[int, int]], room: int) -> dict[int, int]:
    """How many of each length to take, so that their sum comes as near to ``room`` as it can without exceeding it.

    ``lengths`` holds (length, number there are), tried in this order. Bit s of ``reach`` is set if s is a sum of the
    lengths seen so far; numbers are taken in powers of two, so that each length costs few steps.
    """
    reach, all_bits = 1, (1 << room + 1) - 1
    steps = []
    for length, number in lengths:
        number, batch = min(number, room // length), 1
        while number > 0:
            batch = min(batch, number)
            steps.append((length, batch, reach))
            reach |= reach << batch * length & all_bits
            number -= batch
            batch *= 2
        if reach >> room:
            break
    taken: dict[int, int] = {}
    at = reach.bit_length() - 1
    for length, batch, before in reversed(steps):
        if not before >> at & 1:
            taken[length] = taken.get(length, 0) + batch
            at -= batch * length
    return taken


class Packer:
    """Takes documents and gives lists of pieces, each list a sequence."""

    def __init__(self, size: int = SEQUENCE_IDS, buffer_ids: int = BUFFER_IDS) -> None:
        self.size, self.buffer_ids = size, max(buffer_ids, 2 * size)
        self.waiting: dict[int, list[Piece]] = {}
        self.lengths: list[int] = []  # those that wait, ascending
        self.ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[list[Piece]]:
        n = len(ids) // 4
        whole = n - n % self.size
        for start in range(0, whole, self.size):
            yield [Piece(doc_id, n, start, self.size, ids[4 * start : 4 * (start + self.size)])]
        if n > whole:
            self._wait(Piece(doc_id, n, whole, n - whole, ids[4 * whole :]))
        if self.ids >= self.buffer_ids:
            yield from self._sequences(self.buffer_ids // 2)

    def end(self) -> Iterator[list[Piece]]:
        yield from self._sequences(self.size)
        # Less than a sequence is left, and is dealt to the powers of two that it consists of.
        rest = [p for length in reversed(self.lengths) for p in self.waiting[length]]
        room = 1 << self.size.bit_length()
        while rest:
            while room > sum(p.length for p in rest):
                room //= 2
            sequence, free = [], room
            while free:
                piece = rest.pop(0)
                if piece.length > free:
                    piece, later = piece.cut(free)
                    rest.insert(0, later)
                sequence.append(piece)
                free -= piece.length
            yield sequence
        self.waiting, self.lengths, self.ids = {}, [], 0

    def _wait(self, piece: Piece) -> None:
        if piece.length not in self.waiting:
            self.waiting[piece.length] = []
            insort(self.lengths, piece.length)
        self.waiting[piece.length].append(piece)
        self.ids += piece.length

    def _take(self, length: int) -> Piece:
        pieces = self.waiting[length]
        piece = pieces.pop()
        if not pieces:
            del self.waiting[length]
            del self.lengths[bisect_right(self.lengths, length) - 1]
        self.ids -= length
        return piece

    def _sequences(self, left: int) -> Iterator[list[Piece]]:
        """Sequences, until fewer than ``left`` ids wait."""
        while self.ids >= left:
            longest = self.lengths[-1]
            room = self.size - longest
            fitting = self.lengths[: bisect_right(self.lengths, room)]
            others = ((n, len(self.waiting[n]) - (n == longest)) for n in reversed(fitting))
            wanted = least_slack(others, room)
            gap = room - sum(n * times for n, times in wanted.items())
            wanted[longest] = wanted.get(longest, 0) + 1
            for _ in range(1 if gap else min(len(self.waiting[n]) // times for n, times in wanted.items())):
                sequence = [self._take(n) for n, times in wanted.items() for _ in range(times)]
                if gap:
                    head, later = self._take(self.lengths[-1]).cut(gap)
                    sequence.append(head)
                    self._wait(later)
                yield sequence
                if self.ids < left:
                    break


def pack(
    docs: DataFrame, tokenizer: str, end_id: int | None = 2, size: int = SEQUENCE_IDS, buffer_ids: int = BUFFER_IDS
) -> DataFrame:
    """Pieces of all documents (``doc_id``, ``text``; null: empty), each with its place in a sequence of ``size`` ids.

    ``doc_id``; ``start``, ids of its document before the piece; ``length``; ``doc_tokens``, ids of the whole document;
    ``sequence_id`` from 0; ``offset`` in the sequence, gapless from 0; ``ids`` (uint32 bytes, little-endian). ``end_id``
    ends every document; without one, documents without ids give no piece. Every id lies in one piece. ``size`` must be
    a power of two. All sequences are full, but for those at the end of a task, whose sizes are lesser powers of two.

    Rows with one doc_id, or without, are documents of their own; other columns are not read. No rows give no pieces.
    The pieces are stored; which documents share a sequence depends on the tasks that read them.
    """
    if size & size - 1:
        raise ValueError("size must be a power of two")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, part = worker_encoder(tokenizer, end_id), Packer(size, buffer_ids), TaskContext.get().partitionId()

        def made() -> Iterator[list[Piece]]:
            for batch in batches:
                texts = (t.as_py() or b"" for t in batch.column("text"))
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(texts), strict=True):
                    yield from packer.add(doc_id, ids)
            yield from packer.end()

        held: list[tuple[int, int, Piece]] = []
        waiting = 0  # bytes
        for number, pieces in enumerate(made()):
            offset = 0
            for piece in pieces:
                held.append((number, offset, piece))
                offset += piece.length
            waiting += 4 * offset
            if waiting >= _BATCH_BYTES:
                yield _batch(part, held)
                held, waiting = [], 0
        if held:
            yield _batch(part, held)

    stored = materialise(rows.mapInArrow(run, _SCHEMA), "packed", compression="zstd")
    so_far = W.orderBy("part").rowsBetween(W.unboundedPreceding, 0)  # one row for each task
    tasks = stored.groupBy("part").agg((F.max("sequence") + 1).alias("_n")).select("part", (F.sum("_n").over(so_far) - F.col("_n")).alias("_before"))
    return stored.join(F.broadcast(tasks), "part").select(
        "doc_id", "start", "length", "doc_tokens", (F.col("_before") + F.col("sequence")).alias("sequence_id"), "offset", "ids"
    )


def _batch(part: int, held: list[tuple[int, int, Piece]]) -> pa.RecordBatch:
    pieces = [p for _, _, p in held]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part] * len(held), pa.int32()),
            pa.array([n for n, _, _ in held], pa.int64()),
            pa.array([o for _, o, _ in held], pa.int64()),
            pa.array([p.doc_id for p in pieces], pa.int64()),
            pa.array([p.start for p in pieces], pa.int64()),
            pa.array([p.length for p in pieces], pa.int64()),
            pa.array([p.doc_tokens for p in pieces], pa.int64()),
            pa.array([p.ids for p in pieces], pa.binary()),
        ],
        ["part", "sequence", "offset", "doc_id", "start", "length", "doc_tokens", "ids"],
    )


def sequences(packed: DataFrame, size: int = SEQUENCE_IDS, pad_id: int = 0) -> DataFrame:
    """``sequence_id``, ``n_ids``, ``n_pieces`` and ``ids`` (uint32 bytes) of every sequence of ``pack``.

    A sequence is padded with ``pad_id`` to ``size`` ids unless its length is a power of two. It holds ``size`` ids at
    most, so that bringing its pieces together is bounded.
    """
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    n = F.col("n_ids").cast("int")
    power = F.bit_count(n) == 1
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), F.lit(size) - n))
    return (
        packed.groupBy("sequence_id")
        .agg(F.sum("length").alias("n_ids"), F.count("*").alias("n_pieces"), pieces.alias("_pieces"))
        .withColumn("ids", F.aggregate("_pieces", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"])))
        .select("sequence_id", "n_ids", "n_pieces", F.when(power, F.col("ids")).otherwise(F.concat("ids", pad)).alias("ids"))
    )
