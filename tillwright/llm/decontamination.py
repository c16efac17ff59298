"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items are put into one suffix automaton. A document is read word by word while the automaton keeps
the longest run of words, ending here, that also stands in some item. Where that run is at least one window long
(``window`` consecutive item words, or all words of a shorter item), the words of the window are hit and the items that
hold it are noted. The work per document word is constant, however many items there are.

Items are taken in chunks of at most ``CHUNK_WORDS`` words, which bounds what the driver and a task hold: one automaton a
chunk, one pass over the documents for each. Results do not depend on the chunks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.token_files import release_memory
from tillwright.session import materialise

WINDOW = 10
# Words of test items in one automaton (it has at most twice as many states).
CHUNK_WORDS = 250_000
# A word is a run of letters a-z, digits and everything beyond ASCII, after lower-casing A-Z. On UTF-8 bytes:
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


class Automaton:
    """Suffix automaton of several word sequences, with the windows each state completes."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = []
        for _, words in items:
            last, path = 0, []
            for word in words:
                last = self._extend(last, self.ids.setdefault(word, len(self.ids) + 1))
                path.append(last)
            ends.append(path)
        self._note_windows(items, ends)

    def _extend(self, last: int, word: int) -> int:
        known = self.step[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            found = self.step[at][word]
            self.link[new] = found if self.length[found] == self.length[at] + 1 else self._split(at, word, found)
        return new

    def _state(self, length: int) -> int:
        self.step.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, at: int, word: int, found: int) -> int:
        """A copy of ``found`` for the runs that reach it from ``at`` and shorter ones."""
        copy = self._state(self.length[at] + 1)
        self.step[copy] = dict(self.step[found])
        self.link[copy] = self.link[found]
        self.link[found] = copy
        while at >= 0 and self.step[at].get(word) == found:
            self.step[at][word] = copy
            at = self.link[at]
        return copy

    def _note_windows(self, items: list[tuple[str, list[bytes]]], ends: list[list[int]]) -> None:
        """``whole``: window length and items by the state that a completed window is in."""
        found: dict[int, dict[int, set[str]]] = {}
        for (item, words), path in zip(items, ends, strict=True):
            size = min(self.window, len(words))
            for end in range(size - 1, len(words)) if size else ():
                state = path[end]
                while self.length[self.link[state]] >= size:
                    state = self.link[state]
                found.setdefault(state, {}).setdefault(size, set()).add(item)
        self.whole = {state: sorted((n, sorted(names)) for n, names in sizes.items()) for state, sizes in found.items()}
        # Windows that end in a state or in one of its shorter endings, longest ending first.
        self.ending: dict[int, list[tuple[int, list[str]]]] = {}
        for state in sorted(range(len(self.length)), key=self.length.__getitem__):
            above = self.ending.get(self.link[state], []) if state else []
            here = self.whole.get(state, []) + above
            if here:
                self.ending[state] = here

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans [first, end) in ascending order, overlapping ones merged, and the items with a window in ``words``."""
        numbers = self.ids
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        known = [i for i, w in enumerate(words) if w in numbers]
        step, link, length, ending = self.step, self.link, self.length, self.ending
        state, run, before = 0, 0, -2
        for i in known:
            if i != before + 1:
                state, run = 0, 0
            before = i
            word = numbers[words[i]]
            to = step[state].get(word)
            while to is None and state:
                state = link[state]
                run = length[state]
                to = step[state].get(word)
            if to is None:
                continue
            state, run = to, run + 1
            if state in ending:
                for size, names in ending[state]:
                    if size <= run:
                        items.update(names)
                        first = i + 1 - size
                        while spans and spans[-1][1] >= first:
                            first = min(first, spans.pop()[0])
                        spans.append((first, i + 1))
        return spans, items


_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ascending spans, those that touch or overlap joined."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def scan(docs: DataFrame, chunk: list[tuple[str, list[bytes]]], window: int) -> DataFrame:
    """What one chunk of items adds to ``n_words``, ``spans`` and ``items`` of each row."""
    shared = docs.sparkSession.sparkContext.broadcast((chunk, window))
    kept = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    text = next(c for c in kept if c.lower() == "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        automaton = Automaton(*shared.value)
        for batch in batches:
            counts, spans, items = [], batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for i, body in enumerate(batch.column(text).cast(pa.binary())):
                words = words_of(body.as_py() or b"")
                hit, found = automaton.scan(words)
                counts.append(len(words))
                if hit:
                    spans[i] = [{"first": a, "end": b} for a, b in _merged(hit + [(s["first"], s["end"]) for s in spans[i]])]
                    items[i] = sorted(found.union(items[i]))
            columns = [*(batch.column(c) for c in kept), pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_words", "spans", "items"])
        del automaton
        release_memory()

    return docs.mapInArrow(run, docs.schema)


def chunks_of(benchmark: DataFrame, chunk_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items with words, in chunks of at most ``chunk_words`` words (an item longer than that is a chunk of its own).

    Rows stream through the driver a partition at a time, and one chunk is held. An item id on several rows stands for all
    their texts.
    """
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("body"))
    chunk: list[tuple[str, list[bytes]]] = []
    size = 0
    for row in rows.filter("item IS NOT NULL AND body IS NOT NULL").orderBy("item", "body").toLocalIterator():
        words = words_of(row["body"].encode())
        if not words:
            continue
        if chunk and size + len(words) > chunk_words:
            yield chunk
            chunk, size = [], 0
        chunk.append((row["item"], words))
        size += len(words)
    if chunk:
        yield chunk


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``docs`` (any columns) with ``n_words``, ``spans`` of hit words and ``items``.

    ``spans`` holds ``first`` and ``end`` word positions, ascending and apart; ``items`` the sorted ids of the items with
    a window in the text. Columns of these names are replaced. A null or empty text has no words. Items without an id,
    a text or words match nothing; without items nothing is hit. Rows are neither moved nor merged.
    """
    kept = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in ("n_words", "spans", "items")])
    found = kept.select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<first:int,end:int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    number = -1
    for number, chunk in enumerate(chunks_of(benchmark, chunk_words)):
        # Written between the passes, so that a task holds one automaton.
        found = scan(materialise(found, "scanned") if number else found, chunk, window)
    return found if number >= 0 else scan(found, [], window)


def n_hit() -> Column:
    """Number of hit words of a row of ``find``."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """Text from which the words of the spans, and what stands between them, are cut."""
    words = list(_WORD.finditer(text.lower()))
    kept, at = [], 0
    for first, end in spans:
        kept.append(text[at : words[first].start()])
        at = words[end - 1].end()
    return b"".join([*kept, text[at:]])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, chunk_words: int = CHUNK_WORDS
) -> DataFrame:
    """``docs`` without benchmark passages, same columns.

    Hit spans, of all items, are cut, again until none is left (a cut can bring two halves of a window together); a
    document that loses more than ``max_coverage`` of its words goes as a whole. Documents without a hit stay as they are.
    The result does not depend on ``chunk_words``: nothing is cut before all chunks have been searched.
    """
    text = next(c for c in docs.columns if c.lower() == "text")
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text], F.lit(0).alias("_")).alias("others")
    kept = docs.select(F.col(f"`{text}`").alias("text"), others, F.lit(0.0).alias("lost"))
    chunks = chunks_of(benchmark, chunk_words)
    first, second = next(chunks, None), next(chunks, None)
    if second is not None:
        kept = _cut_in_passes(kept, benchmark, window, chunk_words)
    elif first is not None:
        kept = _cut(kept, first, window)
    kept = kept.filter(F.col("lost") <= max_coverage)
    return kept.select(*[F.col("text").alias(c) if c == text else F.col("others").getField(c).alias(c) for c in docs.columns])


def _cut_in_passes(docs: DataFrame, benchmark: DataFrame, window: int, chunk_words: int) -> DataFrame:
    """As ``_cut``, for items of several chunks: all spans of a row are found, then cut, and changed rows are searched again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cut = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("cut").to_pylist()
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                found = [(s["first"], s["end"]) for s in spans]
                if found:
                    texts[i] = without_spans(texts[i], found)
                    cut[i] += sum(end - first for first, end in found)
            words = [n if m is None else m for n, m in zip(batch.column("n_words").to_pylist(), batch.column("words").to_pylist(), strict=True)]
            columns = [pa.array(texts, pa.binary()).cast(pa.string()), batch.column("others"), pa.array(cut, pa.int64()), pa.array(words, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["text", "others", "cut", "words"])

    lost = F.when(F.col("words") > 0, F.col("cut") / F.col("words")).otherwise(0.0).alias("lost")
    rows = docs.select("text", "others", F.lit(0).cast("long").alias("cut"), F.lit(None).cast("long").alias("words"))
    done: list[DataFrame] = []
    while True:
        found = materialise(find(rows, benchmark, window, chunk_words), "found")
        hit = F.size("spans") > 0
        done.append(found.filter(~hit).select("text", "others", lost))
        changed = found.filter(hit)
        if changed.isEmpty():
            return reduce(DataFrame.unionByName, done)
        rows = materialise(changed.mapInArrow(run, rows.schema), "cut")


def _cut(docs: DataFrame, chunk: list[tuple[str, list[bytes]]], window: int) -> DataFrame:
    """``text`` without windows of the chunk, and in ``lost`` the share of all words cut so far."""
    shared = docs.sparkSession.sparkContext.broadcast((chunk, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        automaton = Automaton(*shared.value)
        for batch in batches:
            changed: dict[int, bytes] = {}
            lost = batch.column("lost").to_pylist()
            for i, scalar in enumerate(batch.column("text").cast(pa.binary())):
                body = scalar.as_py() or b""
                words = words_of(body)
                n, cut = len(words), 0
                while spans := automaton.scan(words)[0]:
                    cut += sum(end - first for first, end in spans)
                    changed[i] = body = without_spans(body, spans)
                    words = words_of(body)
                if cut:
                    lost[i] += (1 - lost[i]) * cut / n
            if changed:
                texts = [changed.get(i, t) for i, t in enumerate(batch.column("text").cast(pa.binary()).to_pylist())]
                batch = pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.binary()).cast(pa.string()), batch.column("others"), pa.array(lost, pa.float64())], ["text", "others", "lost"]
                )
            yield batch
        del automaton
        release_memory()

    return docs.mapInArrow(run, docs.schema)
