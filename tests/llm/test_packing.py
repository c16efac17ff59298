"""Sequences of one length: every id once, no padding, and the sums that a sequence can reach."""

import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tillwright.llm import packing, queries

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def ids_of(tokenizer, text, end=2):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


def check(rows, texts, tokenizer, size=4096):
    """``rows`` (doc, start, length, crc, doc_tokens, sequence, offset) hold all ids of ``texts`` once and fill their sequences."""
    documents, made = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, total, sequence, offset in rows:
        documents[doc].append((start, length, crc, total))
        made[sequence].append((offset, length))
    assert documents.keys() == texts.keys()
    for doc, pieces in documents.items():
        ids, at = ids_of(tokenizer, texts[doc]), 0
        for start, length, crc, total in sorted(pieces):
            assert start == at and length > 0 and total == len(ids)
            at += length
            assert crc == zlib.crc32(ids[start:at].tobytes())
        assert at == len(ids)
    sizes = []
    assert sorted(made) == list(range(len(made)))
    for pieces in made.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        sizes.append(at)
    assert all(n <= size and n & n - 1 == 0 for n in sizes)  # full, or a power of two: none is padded
    return sizes


def digest(packed):
    shown = packed.select("doc_id", "start", "length", F.crc32("ids"), "doc_tokens", "sequence_id", "offset")
    return [tuple(r) for r in shown.collect()]


def test_query_packs_all_documents(spark, tokenizer):
    texts = dict(duckdb.execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    found = queries.QUERIES["op11_sequence_packing"](spark, SMALL)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    sizes = check([tuple(r) for r in found.collect()], texts, tokenizer)
    assert sum(n == 4096 for n in sizes) >= len(sizes) - 12


def test_small_buffers_and_hostile_rows(spark, tokenizer, tmp_path):
    long = " ".join(f"word{i % 997}" for i in range(5000))
    texts = dict(enumerate([None, "", " \n ", "x", long, "a b", "<|endoftext|> in<|endoftext|>side", "naïve Σ́ ½ 漢字 😀", *["same text again"] * 40]))
    rows = [(i, t, 1, "x") for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id int, text string, start int, sequence_id string").write.parquet(str(tmp_path / "odd"))
    docs = spark.read.parquet(str(tmp_path / "odd"))
    for buffer in (1, 500, 1 << 20):
        check(digest(packing.pack(docs, WORDS, size=64, buffer_ids=buffer)), texts, tokenizer, 64)
    assert packing.pack(docs.filter("doc_id < 0"), WORDS).count() == 0
    # Rows that share a doc_id, or have none, are documents of their own.
    twice = docs.filter("doc_id = 5").unionAll(docs.filter("doc_id = 5")).unionAll(docs.filter("doc_id = 3").withColumn("doc_id", F.lit(None).cast("int")))
    found = packing.pack(twice, WORDS, size=64).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in found} == {5: 6, None: 2}
    with pytest.raises(ValueError):
        packing.pack(docs, WORDS, size=100)


def test_sequences_hold_the_ids_of_their_pieces(spark, tokenizer):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    packed = packing.pack(docs, WORDS)
    whole = {r["sequence_id"]: r for r in packing.sequences(packed, pad_id=7).collect()}
    for r in packed.collect():
        assert bytes(whole[r["sequence_id"]]["ids"])[4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])
    few = packed.filter("offset = 0").limit(5)
    for r in packing.sequences(few, pad_id=7).collect():
        n = r["n_ids"]
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == (n if n & n - 1 == 0 else 4096) and (ids[n:] == 7).all()


def test_least_slack_is_the_least():
    drawn = random.Random(5)
    for _ in range(300):
        room = drawn.randrange(0, 60)
        lengths = [(n, drawn.randrange(0, 4)) for n in sorted(drawn.sample(range(1, 40), drawn.randrange(0, 6)), reverse=True)]
        sums = {0}
        for n, times in lengths:
            sums = {s + n * k for s in sums for k in range(times + 1) if s + n * k <= room}
        taken = packing.least_slack(lengths, room)
        assert sum(n * k for n, k in taken.items()) == max(sums)
        assert all(0 < k <= dict(lengths)[n] for n, k in taken.items())


def test_equal_lengths_are_cut_and_filled():
    packer = packing.Packer(64, 256)
    made = [s for i in range(100) for s in packer.add(i, bytes(4 * 48))] + list(packer.end())
    assert sum(p.length for s in made for p in s) == 4800 and all(sum(p.length for p in s) == 64 for s in made)
    packer = packing.Packer(64, 256)
    made = [s for i in range(100) for s in packer.add(i, bytes(4 * (16 + 16 * (i % 3))))] + list(packer.end())
    # 16, 32 and 48 fill sequences as they are: nothing is cut but what is left at the end.
    assert sum(len(s) for s in made) <= 104


def test_chunks_of_texts_are_encoded_alike(tokenizer, monkeypatch):
    texts = ["  a <|endoftext|> b ", "", " ", "x" * 50, "naïve Σ́ ½ 漢字   \x85 \x1c 😀", "Don't WE'LL " * 30, *(f"w{i} It's {i}.5%" for i in range(50))]
    raw = [t.encode() for t in texts]
    expected = [ids_of(tokenizer, t).tobytes() for t in texts]
    for size in (1 << 20, 100, 1):
        monkeypatch.setattr(packing, "CHUNK_BYTES", size)
        assert list(packing.ChunkEncoder(WORDS, 2)(raw)) == expected
