"""Token counts without token ids.

A byte-level BPE tokenizer first splits a text into pre-tokens and then each of them into pieces, always in the same way.
So the pieces are counted once for every distinct pre-token of the corpus, and a document's count is the sum over its
pre-tokens of frequency times pieces. The steps:

1. Documents are read in blocks. A block gives one row for each of its distinct pre-tokens, with the documents it stands
   in (as often as it does) packed in bytes: frequencies meet pre-tokens without a row for each pair.
2. Pre-tokens that are one piece of the vocabulary by themselves need no look-up (the vocabulary has a fixed size); they
   are added up in the block. These are the frequent ones, so no key of the shuffle is hot.
3. The rows of a pre-token come together, sorted, in one task. There its pieces are counted, once, and joined to its
   rows in a merge that streams; the products are summed by document, packed by block.

Texts are split at single blanks between other characters, where a new pre-token always begins. What stands between is
split once for each distinct stretch in a block: by the tokenizer, or, for common characters, from a table of what the
tokenizer does with each of them (all goes through the tokenizer if its rules turn out to be others on a few probes).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 16_384
BLOCK_BYTES = 10 << 20
# A blank next to other white space does not begin a pre-token by itself.
_BLANKS = re.compile(r" \s|\s ")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
# Keys of rows that carry the documents of a block; no pre-token of a byte-level tokenizer holds a line end.
_DOCUMENTS = "\n"
_PROBES = (" don't", "we'll", " l'Été", " x1y22z", "!?a--b", " 'S", " 3.14%", " a_b", "x\ny", " x.\n12", " ¿qué?", "½x²", " Ĳſǅ", "'", " ''s")
_SUM = [("row", "<u2"), ("n", "<u4")]
_DOCUMENT = [("doc_id", "<i8"), ("null", "u1"), ("bytes", "<u8"), ("tokens", "<u8")]


class Splitter:
    """Pre-tokens of texts, numbered by block."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for each task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.parts = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        model = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.whole = {token for token in vocabulary if len(model.tokenize(token)) == 1}
        self._learn()

    def _learn(self) -> None:
        """Byte form of single characters, and whether they are letters, digits or neither."""
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.bytes = {ord(" "): split(" x")[0][0][:-1], ord("\n"): split("\n")[0][0]}
        kinds: dict[str, str] = {"letter": "", "digit": "", "simple": ""}
        for code in range(0x21, 0x250):
            c = chr(code)
            found = split(f"x{c}x")
            if c.isspace() or len(split(f" {c}")) != 1:
                continue
            kinds["simple"] += c
            self.bytes[code] = split(c)[0][0]
            if len(found) == 1:
                kinds["letter"] += c
            elif len(split(f"1{c}1")) == 1:
                kinds["digit"] += c
        letter, digit, simple = (re.escape(k) for k in kinds.values())
        self.simple = re.compile(f" ?[{simple}]+(?:\n[{simple}]+)*")
        self.cut = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^ \n{letter}{digit}]+|\n")
        if any(self._short(p) != self._whole(p) for p in _PROBES):
            self.simple = re.compile("(?!)")

    def _short(self, text: str) -> list[str]:
        return [piece.translate(self.bytes) for piece in self.cut.findall(text)]

    def _whole(self, text: str) -> list[str]:
        return [token for token, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def chunk(self, text: str) -> list[str]:
        """Pre-tokens of a stretch of text that begins and ends where pre-tokens do, in the byte alphabet."""
        return self._short(text) if self.simple.fullmatch(text) else self._whole(text)

    def chunks(self, text: str) -> Iterable[str]:
        """The stretches of a text; all but the first of a part begin with a blank."""
        if self.parts is None or not self.parts.search(text):
            yield from self._stretches(text)
            return
        at = 0
        for found in self.parts.finditer(text):
            yield from self._stretches(text[at : found.start()])
            yield found.group()
            at = found.end()
        yield from self._stretches(text[at:])

    def _stretches(self, text: str) -> list[str]:
        if not text:
            return []
        pieces = _BETWEEN.split(text) if _BLANKS.search(text) else text.split(" ")
        if pieces[0] == "":  # the text begins with a blank, which belongs to the next word
            pieces = pieces[1:]
            return [" " + p for p in pieces]
        return [pieces[0], *[" " + p for p in pieces[1:]]]

    def block(self, texts: Iterable[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pre-tokens, and of each (pre-token, text) its numbers and frequency, ascending."""
        numbers: dict[str, int] = {}
        chunk_of: dict[str, int] = {}
        flat: list[int] = []
        starts = [0]
        chunk_ids: list[np.ndarray] = []
        for text in texts:
            found = list(self.chunks(text))
            ids = np.fromiter((chunk_of.setdefault(c, len(chunk_of)) for c in found), dtype=np.int32, count=len(found))
            chunk_ids.append(ids)
        for chunk in chunk_of:
            tokens = [chunk] if chunk in self.special else self.chunk(chunk)
            flat.extend(numbers.setdefault(t, len(numbers)) for t in tokens)
            starts.append(len(flat))
        flat_ids, first = np.array(flat, dtype=np.int64), np.array(starts, dtype=np.int64)
        chunks = np.concatenate(chunk_ids) if chunk_ids else np.empty(0, np.int64)
        row = np.repeat(np.arange(len(chunk_ids)), [len(c) for c in chunk_ids])
        count = first[chunks + 1] - first[chunks]
        ends = np.cumsum(count)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count) + np.repeat(first[chunks], count)
        key = (flat_ids[at] << 16) | np.repeat(row, count)
        pairs, n = np.unique(key, return_counts=True)
        return list(numbers), pairs >> 16, pairs & 0xFFFF, n

    def pieces(self, token: str) -> int:
        return 1 if token in self.special else len(self.tokenizer.model.tokenize(token))


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Rows of a partition, in blocks."""
    ids: list[int | None] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
            body = text.as_py() or b""
            if ids and (len(ids) == BLOCK_ROWS or size + len(body) > BLOCK_BYTES):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(body)
            size += len(body)
    if ids:
        yield ids, texts


def _packed(records: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary array: the next ``counts[i]`` records as bytes."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * records.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(records.tobytes())])


def postings(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``token``, ``block`` and packed ``rows``: of every block its documents, and its pre-tokens of several pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(tokenizer)
        partition = TaskContext.get().partitionId()
        for number, (ids, texts) in enumerate(_blocks(batches)):
            tokens, token, row, n = splitter.block(t.decode() for t in texts)
            whole = np.fromiter((t in splitter.whole or t in splitter.special for t in tokens), dtype=bool, count=len(tokens))
            block = (partition << 24) + number
            single = whole[token] if len(token) else np.empty(0, bool)
            documents = np.zeros(len(ids), dtype=_DOCUMENT)
            documents["doc_id"] = [d or 0 for d in ids]
            documents["null"] = [d is None for d in ids]
            documents["bytes"] = [len(t) for t in texts]
            documents["tokens"] = np.bincount(row[single], weights=n[single], minlength=len(ids))
            token, row, n = token[~single], row[~single], n[~single]
            found, first = np.unique(token, return_index=True)
            counts = np.add.reduceat(n, first) if len(found) else np.empty(0, np.int64)
            packed = pa.concat_arrays([pa.array([documents.tobytes()], pa.binary()), _packed(np.repeat(row, n).astype("<u2"), counts)])
            names = pa.array([f"{_DOCUMENTS}{block}", *(tokens[i] for i in found)], pa.string())
            table = pa.Table.from_arrays([names, pa.array(np.full(len(names), block), pa.int64()), packed], ["token", "block", "rows"])
            del texts, tokens, token, row, n
            yield from table.combine_chunks().to_batches(max_chunksize=10_000)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "token string, block long, rows binary")


def _products(tokenizer: str):
    """By block: its documents, or tokens to be added to them, packed and added up as far as they come together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(tokenizer)
        keys: list[np.ndarray] = []
        sums: list[np.ndarray] = []
        last, pieces, held = None, 0, 0

        def added() -> pa.RecordBatch:
            key, which = np.unique(np.concatenate(keys), return_inverse=True)
            entries = np.zeros(len(key), dtype=_SUM)
            entries["row"], entries["n"] = key & 0xFFFF, np.bincount(which, weights=np.concatenate(sums))
            block, counts = np.unique(key >> 16, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(block), pa.nulls(len(block), pa.binary()), _packed(entries, counts)], ["block", "documents", "sums"])

        for batch in batches:
            names, bodies = batch.column("token").to_pylist(), batch.column("rows").to_pylist()
            blocks = batch.column("block").to_numpy()
            each = np.zeros(len(names), dtype=np.int64)
            times = np.zeros(len(names), dtype=np.int64)
            for i, (name, body) in enumerate(zip(names, bodies, strict=True)):
                if name.startswith(_DOCUMENTS):
                    yield pa.RecordBatch.from_arrays([pa.array([blocks[i]]), pa.array([body]), pa.nulls(1, pa.binary())], ["block", "documents", "sums"])
                    bodies[i] = b""
                    continue
                if name != last:
                    last, pieces = name, splitter.pieces(name)
                each[i], times[i] = len(body) // 2, pieces
            entries = np.frombuffer(b"".join(bodies), dtype="<u2")
            keys.append(np.repeat(blocks << 16, each) + entries)
            sums.append(np.repeat(times, each))
            held += len(entries)
            if held > 1_000_000:
                yield added()
                keys, sums, held = [], [], 0
        if held:
            yield added()

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block come one after the other: its documents with all that is to be added to them."""
    at: int | None = None
    documents: np.ndarray | None = None
    total = np.zeros(1 << 16)

    def finished() -> pa.RecordBatch:
        ids = pa.array(documents["doc_id"].astype(np.int64), mask=documents["null"].astype(bool))
        tokens = documents["tokens"].astype(np.int64) + total[: len(documents)].astype(np.int64)
        return pa.RecordBatch.from_arrays([ids, pa.array(documents["bytes"].astype(np.int64)), pa.array(tokens)], ["doc_id", "n_bytes", "n_tokens"])

    for batch in batches:
        for block, found, sums in zip(*(batch.column(c).to_pylist() for c in ("block", "documents", "sums")), strict=True):
            if block != at:
                if documents is not None:
                    yield finished()
                at, documents = block, None
                total[:] = 0
            if found is not None:
                documents = np.frombuffer(found, dtype=_DOCUMENT)
            else:
                entries = np.frombuffer(sums, dtype=_SUM)
                total[entries["row"]] += entries["n"]
    if documents is not None:
        yield finished()


def token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row of ``docs`` (``doc_id``, ``text``).

    A null text counts as empty: 0 and 0. Special strings in a text count as the tokenizer takes them by default, as one
    token. Rows with one doc_id, or none, are counted each by itself. ``docs`` must be a stored table, since its
    blocks are numbered by partition, also if a lost task reads them again.
    """
    together = postings(docs, tokenizer).repartition("token").sortWithinPartitions("token")
    parts = together.mapInArrow(_products(tokenizer), "block long, documents binary, sums binary")
    by_block = parts.repartition("block").sortWithinPartitions("block")
    return by_block.mapInArrow(_summed, "doc_id long, n_bytes long, n_tokens long")
