"""Token-id files: independent zstandard frames with a trailing seek table and checksums.

A file holds a range of documents in ascending order of doc_id, as

* data frames, each a zstandard frame of its own with whole documents: their number (uint32), doc_ids (int64), whether
  each id is null (uint8), numbers of tokens (uint64), and all token ids (uint32), little-endian;
* an index, in a skippable frame: for each data frame its first and last doc_id (int64), documents and ids (uint64);
* the seek table, in a skippable frame: compressed and decompressed size and checksum (low half of xxh64 of the
  decompressed bytes) of every frame before it, as in the seekable format of zstandard.

A reader gets the seek table from the end, the index from there, and decompresses only frames that hold what it is asked
for. Files become part of a data set by the manifest, written when all are complete: files of lost or repeated tasks,
which have names of their own, are never read.
"""

from __future__ import annotations

import ctypes
import gc
import os
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

FRAME_BYTES = 1 << 20
CACHED_WORDS = 450_000
# Fixed values of the zstandard formats: a skippable frame's first word, the seek table's kind and last word.
_SKIPPABLE, _SEEK_TABLE, _SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_ENTRY, _FOOTER, _INDEX = "<III", "<IBI", "<qqQQ"
_INT64_MIN = -(1 << 63)
_PROBES = ("don't", "WE'LL", "l'Été", "x1y22z", "!?a--b", "'S", "rock'n'roll", "3.14%", "a_b", "ÀÉÎÕÜ", "¿qué?", "½x²", "''", "Ĳſǅ")


def release_memory() -> None:
    """Give back what earlier tasks of this Python worker have left: it serves one task after the other."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class _Known(dict):
    """Ids of words, encoded when first asked for."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, word: bytes) -> bytes:
        self[word] = ids = self.encode(word)
        return ids


class Encoder:
    """Token ids of texts, as uint32 bytes, for tokenizers that drop blanks and never look across them.

    Words between ASCII blanks are encoded once and kept for later texts. Most of the library's time goes into normalising
    and splitting; for words of common characters that is done here, from a table of what the library itself does with
    each character, and only the pieces of a pre-token are asked from its model. All other words go through the library
    as a whole, as all do if its rules turn out to be others on a few probes.
    """

    def __init__(self, path: str, end_id: int | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for each task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.is_special = re.compile("|".join(map(re.escape, self.special)) or "(?!)").search
        self.end = b"" if end_id is None else struct.pack("<I", end_id)
        self.known = _Known(self._encoded)
        self.pieces: dict[str, bytes] = {}
        self._learn()
        if any(self._short(w) != self._whole(w) for w in _PROBES):
            self.simple = re.compile("(?!)")
        # Where the library makes all text lower-case, A-Z can be lowered first: fewer different words.
        self.lowers = self._whole("AbC") == self._whole("abc")
        self.special_lower = [s.lower().encode() for s in self.special]

    def _learn(self) -> None:
        """Lower case and byte form of single characters, and whether they are letters, digits or neither."""
        normalizer, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer.pre_tokenize_str
        normal = normalizer.normalize_str if normalizer else str
        self.lower, self.bytes = {}, {}
        kinds: dict[str, str] = {"letter": "", "digit": "", "simple": ""}
        for code in range(0x21, 0x250):
            low = normal(chr(code))
            if len(low) != 1 or low.isspace() or normal(f"x{chr(code)}x") != f"x{low}x" or normal(low) != low:
                continue
            kinds["simple"] += chr(code)
            self.lower[code], self.bytes[ord(low)] = low, split(low)[0][0]
            if len(split(f"x{low}x")) == 1:
                kinds["letter"] += low
            elif len(split(low + low)) == 2:
                kinds["digit"] += low
        letter, digit, simple = (re.escape(k) for k in kinds.values())
        self.simple = re.compile(f"[{simple}]+")
        self.cut = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{digit}]|[^{letter}{digit}]+")
        # Whether ASCII is lowered as usual, is its own byte form, and A-Z are letters: no table is needed then.
        plain = [chr(c) for c in range(0x21, 0x7F) if c in self.lower]
        self.ascii = all(self.lower[ord(c)] == c.lower() and self.bytes[ord(c.lower())] == c.lower() for c in plain)
        self.ascii = self.ascii and all(c in kinds["letter"] for c in "abcdefghijklmnopqrstuvwxyz")

    def _short(self, word: str) -> bytes:
        if self.ascii and word.isascii():
            word = word.lower()
            if word.isalpha():
                return self.pieces.get(word) or self._piece(word)
        else:
            word = word.translate(self.lower)
        return b"".join([self.pieces.get(piece) or self._piece(piece) for piece in self.cut.findall(word)])

    def _piece(self, piece: str) -> bytes:
        form = piece if self.ascii and piece.isascii() else piece.translate(self.bytes)
        found = [t.id for t in self.tokenizer.model.tokenize(form)]
        ids = self.pieces[piece] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def _whole(self, word: str) -> bytes:
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        for text in texts:
            if self.lowers:
                low = text.lower()
                # Special strings are told by their case.
                text = text if any(s in low for s in self.special_lower) else low
            if len(self.known) > CACHED_WORDS:
                self.known.clear()
            if len(self.pieces) > CACHED_WORDS:
                self.pieces.clear()
            yield b"".join([*map(self.known.__getitem__, text.split()), self.end])

    def _encoded(self, raw: bytes) -> bytes:
        word = raw.decode()
        return self._short(word) if self.simple.fullmatch(word) and not self.is_special(word) else self._whole(word)


class Writer:
    """Writes one file, frame by frame."""

    def __init__(self, out: pa.NativeFile, frame_bytes: int) -> None:
        self.out, self.frame_bytes = out, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=3)
        self.table: list[bytes] = []
        self.index: list[bytes] = []
        self.documents = self.ids = 0
        self._clear()

    def _clear(self) -> None:
        self.docs: list[int | None] = []
        self.bodies: list[bytes] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.docs and self.size + len(ids) > self.frame_bytes:
            self.flush()
        self.docs.append(doc_id)
        self.bodies.append(ids)
        self.size += len(ids)

    def flush(self) -> None:
        if not self.docs:
            return
        n = len(self.docs)
        numbers = np.array([_INT64_MIN if d is None else d for d in self.docs], dtype="<i8")
        lengths = np.array([len(b) // 4 for b in self.bodies], dtype="<u8")
        nulls = np.array([d is None for d in self.docs], dtype="u1")
        plain = b"".join([struct.pack("<I", n), numbers.tobytes(), nulls.tobytes(), lengths.tobytes(), *self.bodies])
        packed = self.compressor.compress(plain)
        self.out.write(packed)
        self.table.append(struct.pack(_ENTRY, len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        ids = int(lengths.sum())
        self.index.append(struct.pack(_INDEX, int(numbers[0]), int(numbers[-1]), n, ids))
        self.documents += n
        self.ids += ids
        self._clear()

    def close(self) -> None:
        self.flush()
        index = b"".join(self.index)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(index)) + index)
        self.table.append(struct.pack(_ENTRY, len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = b"".join(self.table) + struct.pack(_FOOTER, len(self.table), 0x80, _SEEKABLE)
        self.out.write(struct.pack("<II", _SEEK_TABLE, len(table)) + table)
        self.out.close()


def frames(file: pa.NativeFile, wanted: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """Of each frame: ids in the file before it, doc_ids, nulls, numbers of tokens, all its ids.

    With ``wanted`` (sorted doc_ids) only frames are read whose range holds one of them. A frame whose checksum does not
    match raises ValueError.
    """
    size = file.size()
    count, _, magic = struct.unpack(_FOOTER, file.read_at(struct.calcsize(_FOOTER), size - struct.calcsize(_FOOTER)))
    if magic != _SEEKABLE:
        raise ValueError("no seek table at the end of the file")
    table = file.read_at(count * struct.calcsize(_ENTRY), size - struct.calcsize(_FOOTER) - count * struct.calcsize(_ENTRY))
    entries = list(struct.iter_unpack(_ENTRY, table))
    index_at = sum(e[0] for e in entries[:-1])
    index = struct.iter_unpack(_INDEX, file.read_at(entries[-1][0] - 8, index_at + 8))
    at = before = 0
    decompressor = zstandard.ZstdDecompressor()
    for (packed, plain_size, checksum), (first, last, n, ids) in zip(entries, index, strict=False):
        if wanted is None or np.searchsorted(wanted, last, "right") > np.searchsorted(wanted, first, "left"):
            plain = decompressor.decompress(file.read_at(packed, at), max_output_size=plain_size)
            if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame at byte {at} is damaged")
            docs = np.frombuffer(plain, "<i8", n, 4)
            nulls = np.frombuffer(plain, "u1", n, 4 + 8 * n).astype(bool)
            lengths = np.frombuffer(plain, "<u8", n, 4 + 9 * n).astype(np.int64)
            yield before, docs, nulls, lengths, plain[4 + 17 * n :]
        at += packed
        before += ids


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith(("file:", "/")) else (fs.LocalFileSystem(), folder)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 1, frame_bytes: int = FRAME_BYTES) -> None:
    """Encode every text (null: empty) of ``docs`` (``doc_id``, ``text``) and write it to ``folder``, which all executors reach.

    Files follow each other in ascending order of doc_id, null first; rows with one doc_id in an order fixed by their
    texts. ``end_id`` ends every document. The tokenizer must be one for which blanks only part words.
    """
    order = ["doc_id", F.xxhash64("text").alias("_h"), "text"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        encoder, writer, path = Encoder(tokenizer, end_id), None, ""
        for batch in batches:
            texts = (t.as_py() or b"" for t in batch.column("text").cast(pa.binary()))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(texts), strict=True):
                if writer is None:
                    context = TaskContext.get()
                    where, top = _open(folder)
                    where.create_dir(top, recursive=True)
                    path = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.ids.zst"
                    writer = Writer(where.open_output_stream(f"{top}/{path}", compression=None), frame_bytes)
                writer.add(doc_id, ids)
        if writer:
            writer.close()
            row = [[TaskContext.get().partitionId()], [path], [writer.documents], [writer.ids]]
            yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int64()), pa.array(row[1]), *(pa.array(c, pa.int64()) for c in row[2:])], ["part", "path", "documents", "ids"])
        # The words of this task are of no use to what its worker does next, which may be another stage for a long time.
        del encoder, writer
        release_memory()

    manifest = rows.sortWithinPartitions(*order).mapInArrow(run, "part long, path string, documents long, ids long")
    manifest.write.parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (uint32 bytes) of every document,
    or of those in ``doc_ids`` (a short list), for which only their frames are decompressed."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    so_far = W.orderBy("part").rowsBetween(W.unboundedPreceding, 0)  # one row per file
    files = manifest.select("path", (F.sum("ids").over(so_far) - F.col("ids")).alias("before"))
    wanted = None if doc_ids is None else np.unique(np.array(doc_ids, dtype=np.int64))
    names = ["doc_id", "start", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, top = _open(folder)
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
                with where.open_input_file(f"{top}/{path}") as file:
                    for earlier, docs, nulls, lengths, body in frames(file, wanted):
                        ends = np.cumsum(lengths)
                        rows = np.arange(len(docs)) if wanted is None else np.flatnonzero(np.isin(docs, wanted) & ~nulls)
                        ids = [body[4 * (ends[i] - lengths[i]) : 4 * ends[i]] for i in rows]
                        columns = [
                            pa.array(docs[rows], pa.int64(), mask=nulls[rows]),
                            pa.array(before + earlier + (ends - lengths)[rows], pa.int64()),
                            pa.array(lengths[rows], pa.int64()),
                            pa.array(ids, pa.binary()),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, names)

    tasks = max(1, manifest.count())
    return files.repartition(tasks, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
