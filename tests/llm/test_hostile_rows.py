"""Nulls, empty and long texts, ties, repeated rows, empty tables, and columns with clashing names."""

import random
import struct

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.compare import difference
from tillwright.llm import decontamination, extraction, licenses, mixing, near_dedup, neighbours, quality, queries, quotes, token_counts, token_files

BPE, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 997} and{i % 13}" for i in range(30_000))
ODD = [None, "", " \n\t ", "x", LONG, "a b", "a b", "  two  blanks \n and\tmore", "<|endoftext|> in<|endoftext|>side", "naïve Σ́ ½ 漢字   \x85 \x1c 😀"]


@pytest.fixture
def odd(spark, tmp_path):
    """Odd texts in a stored table with clashing names; null ids and sources; one row twice."""
    rows = [(i, t, "s" if i % 3 else None, f"row{i}", i, "x") for i, t in enumerate(ODD)] + [(None, "no id", "s", "n", 0, "y"), (3, "x", "s", "row3", 3, "x")]
    schema = "doc_id long, text string, source string, row string, size int, items string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "odd"))
    return spark.read.parquet(str(tmp_path / "odd"))


@pytest.fixture
def nothing(odd):
    return odd.filter("doc_id < -1")


def plain(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is not None, str(v)) for v in r])


def test_mixing(odd, nothing):
    sizes = mixing.sizes_of(odd)
    rows = mixing.taken(sizes, mixing.mix(sizes, block_words=8)).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        text = dict(enumerate(ODD)).get(r["doc_id"], "no id") or ""
        assert r["size"] == len(text.encode().split()) and 0 <= r["taken"] <= 2 * r["size"]
    mixed = mixing.mixed_documents(odd, block_words=8)
    assert mixed.columns == odd.columns
    for r in mixed.collect():
        whole = dict(enumerate(ODD)).get(r["doc_id"], "no id")
        assert r["text"] and set(r["text"].encode().split()) <= set(whole.encode().split())
    assert mixing.mixed_documents(nothing).count() == 0
    empty = mixing.sizes_of(nothing)
    assert mixing.taken(empty, mixing.mix(empty)).count() == 0


def test_permutations_are_permutations():
    for n in (1, 2, 3, 5, 64, 1000):
        place = np.arange(n)
        images = [mixing.permuted(place, np.full(n, n), np.full(n, 3), np.full(n, turn), 1) for turn in (0, 1)]
        assert all(sorted(i) == list(range(n)) for i in images)
        assert n < 64 or (images[0] != images[1]).any()


def test_slots_have_the_quotas(spark):
    rows = [(i, i, f"s{i % 4}", 10 + i % 7) for i in range(400)]
    sizes = spark.createDataFrame(rows, "row long, doc_id long, source string, size long")
    mixed = mixing.mix(sizes, block_words=4, shard_slots=50)
    slots = mixed.slots.collect()
    assert len({(s["source_no"], s["turn"], s["block"]) for s in slots}) == len(slots)
    per_shard = {}
    for s in slots:
        per_shard[s["shard"]] = per_shard.get(s["shard"], 0) + 1
    assert all(n == 50 for shard, n in per_shard.items() if shard < max(per_shard))


def test_token_counts(odd, nothing):
    tokenizer = Tokenizer.from_file(BPE)
    texts = [t or "" for t in ODD] + ["no id", "x"]
    ids = [*range(len(ODD)), None, 3]
    wanted = [(d, len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids)) for d, t in zip(ids, texts, strict=True)]
    assert plain(token_counts.token_counts(odd, BPE).collect()) == plain(wanted)
    assert token_counts.token_counts(nothing, BPE).count() == 0


def strange_texts(n, seed):
    rng = random.Random(seed)
    points = [c for c in range(1, 0x2FFFF) if not 0xD800 <= c < 0xE000]
    some = [" ", " ", "  ", "   ", "\n", " \n", "\t", "<|endoftext|>", "<|startoftext|>", "'s", "'ll", "Σ", "́", " ", "\x85", "\x1c"]
    pick = [lambda: chr(rng.choice(points)), lambda: chr(rng.randrange(33, 127)), lambda: chr(rng.randrange(97, 123)), lambda: rng.choice(some)]
    return ["".join(rng.choice(pick)() for _ in range(rng.randrange(50))) for _ in range(n)]


def test_pre_tokens_of_strange_texts():
    tokenizer, splitter = Tokenizer.from_file(BPE), token_counts.Splitter(BPE)
    texts = strange_texts(1500, 1)
    tokens, token, row, n = splitter.block(texts)
    counts = np.bincount(row, weights=np.array([splitter.pieces(t) for t in tokens])[token] * n, minlength=len(texts))
    assert list(counts) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_words_of_strange_texts():
    tokenizer, encoder = Tokenizer.from_file(WORDS), token_files.Encoder(WORDS, 1)
    texts = strange_texts(1500, 2)
    for text, ids in zip(texts, encoder([t.encode() for t in texts]), strict=True):
        assert list(np.frombuffer(ids, "<u4")) == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_token_files(spark, odd, nothing, tmp_path):
    folder = str(tmp_path / "ids")
    token_files.write(odd, folder, WORDS, frame_bytes=64)
    rows = sorted(token_files.read(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 0, 1, 2, 3, 3, *range(4, len(ODD))]
    tokenizer, start = Tokenizer.from_file(WORDS), 0
    for r in rows:
        text = "no id" if r["doc_id"] is None else ODD[r["doc_id"]] or ""
        assert list(np.frombuffer(r["ids"], "<u4")) == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert (r["start"], r["n_tokens"]) == (start, len(r["ids"]) // 4)
        start += r["n_tokens"]
    some = token_files.read(spark, folder, [3, 7, 10**12]).collect()
    assert plain(some) == plain(r for r in rows if r["doc_id"] in (3, 7))
    token_files.write(nothing, folder + "-empty", WORDS)
    assert token_files.read(spark, folder + "-empty").count() == 0


def test_seek_table_is_that_of_the_format(tmp_path):
    path = str(tmp_path / "one")
    with open(path, "wb") as out:
        writer = token_files.Writer(out, 40)
        for i in range(9):
            writer.add(i, struct.pack(f"<{i}I", *range(i)))
        writer.close()
    data = open(path, "rb").read()
    # A plain zstandard reader skips index and seek table.
    reader = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True)
    assert reader.read().count(b"") > 0
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    assert magic == 0x8F92EAB1 and flags == 0x80
    sizes = [struct.unpack("<III", data[-9 - 12 * (count - i) :][:12])[0] for i in range(count)]
    assert sum(sizes) + 8 + 12 * count + 9 == len(data)


def test_damaged_frames_are_noticed(tmp_path):
    from pyarrow import fs

    path = str(tmp_path / "one")
    with open(path, "wb") as out:
        writer = token_files.Writer(out, 1000)
        writer.add(1, struct.pack("<4I", 1, 2, 3, 4))
        writer.close()
    data = bytearray(open(path, "rb").read())
    data[12] ^= 1
    open(path, "wb").write(data)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.frames(fs.LocalFileSystem().open_input_file(path)))


def test_licenses(spark, odd, nothing):
    mit = licenses.TEMPLATES[0][1]
    texts = [
        (1, "Some text here.\nReleased under the MIT license\nMore text."),
        (2, mit.replace("ANY KIND", "any sort").replace(". ", ".\n")),
        (3, "All rights reserved. All rights reserved."),
        (4, "We released a license to the public under many terms."),
        (5, "x\n\n" + "Licensed under the Apache License,\nVersion 2.0." + "\n\ny"),
        (6, None),
    ]
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [found[i]["licenses"] for i in range(1, 7)] == ["MIT", "MIT", "LicenseRef-All-Rights-Reserved", "", "Apache-2.0", ""]
    assert found[1]["best_dice"] == 1 and found[6]["best_license"] is None
    assert len(licenses.scan(odd).collect()) == len(ODD) + 2 and licenses.scan(nothing).count() == 0


def test_licenses_of_several_paragraphs(spark):
    by_name = {}
    for name, body in licenses.TEMPLATES:
        by_name.setdefault(name, body)
    mit = by_name["MIT"].replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")
    apache = by_name["Apache-2.0"].replace("License. You", "License.\nYou").replace("2.0 Unless", "2.0\n\nUnless").replace(", software", ",\n  software")
    gpl = by_name["GPL-3.0-or-later"].replace("version. This", "version.\n\nThis").replace("details. You", "details.\n\nYou")
    more = "\n".join(f"Words number {i} of a long text stand here, and there are others of them. So it goes on in line {i}." for i in range(400))
    texts = [
        (1, f"{more}\n\n{mit}\n\n{more}"),
        (2, f"{more}\n\n{apache}\n\n{more}"),
        (3, f"Title\n\n{gpl}\n\n{more}"),
        (4, f"{more}\nIt is here. Released under\nthe MIT License. There is more.\n{more}"),
        (5, f"{more}\n\n{mit}\n\n{more}\n\n{apache}"),
        (6, f"{more}\n\n" + mit.split("\n\n")[1]),
        (7, more),
        (8, "All rights reserved.\n" * 3000),
    ]
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    names = [set(found[i]["licenses"].split(",")) for i in range(1, 9)]
    assert names[0] == names[3] == {"MIT"} and "Apache-2.0" in names[1] and "GPL-3.0-or-later" in names[2] and names[4] == {"MIT", "Apache-2.0"}
    assert names[5] == names[6] == {""} and names[7] == {"LicenseRef-All-Rights-Reserved"}
    assert [found[i]["best_dice"] for i in (1, 2, 3, 4, 5, 8)] == [1.0] * 6
    # The last: a line, and the text of such lines.
    assert [found[i]["n_matches"] for i in (1, 4, 8)] == [1, 1, 2]


CHAT = [
    (1, 0, "user", "Hello there.\nWhat is the plan?"),
    (1, 1, "assistant", "Plan A it is.\n\nWe meet at noon."),
    (1, 2, "user", "On Monday Bob wrote:\n> We meet at  noon.\nFine.\n> unknown line"),
    (1, 3, "assistant", "> On Monday Bob wrote:\n> > We meet at noon.\n> Fine.\nSee you.\n\n>> Plan A it is."),
    (1, 4, "user", None),
    (1, None, "user", "> Hello there."),
    (2, 0, "user", "> We meet at noon."),
    (2, 1, None, "a > b is no quote"),
    (2, 1, None, "a > b is no quote"),
    (2, 5, "user", "> a > b is no quote\nyes"),
    (None, 3, "user", "> Fine.\nalone"),
    (3, 0, "user", "first line\nof a paragraph"),
    (3, 5000, "user", "> first line of\n> a paragraph\nok"),
]


def test_quotes(spark, nothing, tmp_path):
    spark.createDataFrame(CHAT, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    stored = spark.read.parquet(str(tmp_path / "conversations.parquet"))
    found = {(r["conv_id"], r["turn"], r["role"]): r for r in quotes.conversations(stored).collect()}
    reply = {k: (r["reply_to"], r["by_quote"], r["n_quoted"], r["text"]) for k, r in found.items()}
    assert reply[1, 2, "user"] == (1, True, 2, "Fine.")
    assert reply[1, 3, "assistant"] == (1, True, 4, "See you.")
    assert reply[1, 4, "user"] == (3, False, 0, "")
    assert reply[1, None, "user"] == (None, False, 1, "")
    assert reply[2, 0, "user"] == (None, False, 1, "")
    assert reply[2, 5, "user"] == (1, True, 1, "yes")
    assert reply[2, 1, "unknown"] == (0, False, 0, "a > b is no quote")
    assert reply[None, 3, "user"] == (None, False, 1, "alone")
    assert reply[3, 5000, "user"] == (0, True, 2, "ok")
    assert found[3, 5000, "user"]["position"] == 2 and found[1, None, "user"]["position"] == 1 and found[1, 4, "user"]["position"] == 6
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert difference(quotes.conversations(stored), con, queries.ORACLE_SQL["op5_quotation_links"]) is None
    assert quotes.conversations(stored.filter("turn > 9999")).count() == 0


def test_quoted_parts(spark, tmp_path):
    long = "We could go by train. The bus is cheaper, but it takes longer. I would rather walk\nall the way to the sea\nand back again, if it is dry."
    chat = [
        (1, 0, "user", long),
        (1, 1, "assistant", "Second paragraph here\nis wrapped.\n\nThird one follows."),
        (1, 2, "user", "Ok."),
        (1, 3, "assistant", "> The bus is cheaper, but it takes longer.\nTrue."),
        (1, 4, "user", "> all the way to the\n> sea and back\nReally?"),
        (1, 5, "user", "> Second paragraph\n> here is wrapped. Third one\n> follows.\nYes."),
        (1, 6, "user", "> We could go by train. [...] I would rather walk all the way\nNo."),
        (1, 7, "user", "It is ok with me."),
        (1, 8, "user", "> Ok.\nGood."),
        (1, 9, "user", "> The bus is cheaper, but it takes shorter\nNever."),
        (2, 0, "user", "Another conversation"),
        (2, 1, "user", "Yes"),
        (2, 2, "user", "> The bus is cheaper, but it takes longer.\nWhat?"),
    ]
    spark.createDataFrame(chat, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    stored = spark.read.parquet(str(tmp_path / "conversations.parquet"))
    reply = {(r["conv_id"], r["turn"]): (r["reply_to"], r["by_quote"]) for r in quotes.conversations(stored).collect()}
    assert [reply[1, i] for i in range(3, 10)] == [(0, True), (0, True), (1, True), (0, True), (6, False), (2, True), (8, False)]
    assert reply[2, 2] == (1, False)


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(v) for v in rng.standard_normal(6)], i) for i in range(300)]
    rows += [(300 + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 0) for i in range(80)]
    bad = [None, [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] * 6, [1.0, 2.0], []]
    rows += [(400 + 20 * i, v, 0) for i, v in enumerate(bad)] + [(None, [1.0] * 6, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell long")
    found = neighbours.nearest(frame, F.col("vec_id") % 20 == 0, part_rows=64).collect()
    x = np.array([np.float32(r[1]) for r in rows[:380]], dtype=float)
    hits = 0
    for q in range(0, 380, 20):
        scores = x @ x[q]
        best = [i for i in np.lexsort((np.arange(380), -scores)) if i != q][:20]
        mine = [r for r in found if r["query_id"] == q]
        assert len(mine) == 20 and q not in {r["vec_id"] for r in mine}
        hits += len(set(best) & {r["vec_id"] for r in mine})
    assert hits >= 0.9 * 19 * 20 and {r["query_id"] for r in found} == set(range(0, 380, 20))
    few = neighbours.nearest(frame.filter("vec_id < 5"), F.lit(True)).collect()
    assert sorted((r["query_id"], r["rank"]) for r in few) == [(q, k) for q in range(5) for k in range(1, 5)]
    assert neighbours.nearest(frame.filter("vec_id < 0"), F.lit(True)).count() == 0
    assert neighbours.nearest(frame.filter("vec_id = 3"), F.lit(True)).count() == 0


def test_chi_square_quantile():
    for p, m, x in ((0.95, 2, 5.991), (0.9, 12, 18.549), (0.99, 8, 20.090)):
        assert neighbours.chi_square_quantile(p, m) == pytest.approx(x, abs=1e-3)


def test_quality(spark, odd, nothing):
    clean = [(i, f"The {i} of a plain text, as it stands.", 1) for i in range(60)]
    junk = [(i, "BUY!! NOW$$$ " * 5, 0) for i in range(60, 120)]
    frame = spark.createDataFrame(clean + junk, "doc_id long, text string, quality int")
    labels = frame.select("doc_id", "quality").unionByName(frame.select(F.lit(None).cast("long").alias("doc_id"), "quality").limit(1))
    model = quality.train(frame.select("doc_id", "text"), labels, sample_rows=50)
    scored = {r["doc_id"]: r["score"] for r in quality.with_scores(frame, model).collect()}
    assert all((scored[i] >= 0.3) == (i < 60) for i in range(120))
    shown = quality.with_scores(odd.withColumn("score", F.lit("old")), model).collect()
    assert len(shown) == len(ODD) + 2 and all(0 <= r["score"] <= 1 for r in shown)
    assert quality.with_scores(nothing, model).count() == 0
    one = quality.train(frame, labels.filter("quality = 1"))
    assert all(r["score"] > 0.9 for r in quality.with_scores(odd, one).collect())
    none = quality.train(frame, labels.filter("quality > 1"))
    assert all(r["score"] == 0.5 for r in quality.with_scores(odd, none).collect())


def test_pages(spark):
    from tillwright.llm.extraction import main_text

    text = "This is a paragraph of the article that has enough words to be one of its own, and it is long."
    more = "There is more of it in the next one, with a <a href='/x'>link</a> to what was said before this."
    page = (
        f"<header><h1>Site of the day</h1><p>{text}</p></header><div id='cookie-notice'><p>{text}</p></div><div class='entry-header'><h1>Title</h1></div>"
        f"<p>{text}<p>{more}<br>Short &amp; sweet&nbsp;!</p><p>Yes.</p><form><p>{text}</p></form><aside>{text}</aside>"
        f"<ul class='menu'><li><a>One</a><li><a>Two</a></ul><section class='comments'><p>{text}</p></section><footer>{text}</footer><script>var t='<p>{text}</p>'"
    )
    assert main_text(page) == "\n\n".join(["Title", text, more.replace("<a href='/x'>", "").replace("</a>", "") + " Short & sweet !", "Yes."])
    assert main_text(f"<div class='has-sidebar'><p>{text}</p></div><p class=ad>{text}") == text
    for broken in ("", "<", "<p", "<!--", "<p>a</b></p></div><", "no markup at all", "<script>", "</p>", "<a href='", "&#0;&#x110000;&bogus;"):
        assert isinstance(main_text(broken), str)
    rows = [(1, "u", page, "old", 3), (2, None, None, None, None), (None, "", "", "x", 1), (2, None, None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = extraction.extract(frame)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert plain(found.collect()) == plain([(1, "u", main_text(page), len(main_text(page))), (2, None, "", 0), (None, "", "", 0), (2, None, "", 0)])
    assert main_text("<article>" + f"<p>{text}</p>" * 20_000 + "</article>").count(text) == 20_000


def test_pages_with_open_heads_and_named_wrappers():
    from tillwright.llm.extraction import main_text

    text = "This is the text of an article, and it has words that are in any of the texts which people write for others to read. " * 3
    text = text.strip()
    other = "There is more to be said about the days that were, and what we would do if all of it came back to us in one night."
    assert main_text(f"<html><head><title>T</title><meta charset=utf-8><body><p>{text}</p></body></html>") == text
    assert main_text(f"<head><title>T</title><link rel=x><p>{text}</p>") == text
    assert main_text(f"<head><title>T</title><noscript><body><p>{text}</p>") == text
    assert main_text(f"<head><style>p {{}}</style>{text}") == text
    assert main_text(f"<head><script>let a = 1</script></head><p>{text}</p>") == text
    for names in ("layout sidebar-right", "content-with-sidebar", "nav-fixed", "page-without-ads"):
        for body in (f"<article><p>{text}</p></article>", f"<main><p>{text}</p></main>", f"<p>{text}</p>"):
            assert main_text(f"<div class='{names}'>{body}</div><p>Short.</p>").startswith(text)
            assert main_text(f"<div class='{names}'>{body}<div class='comments'><p>{other * 9}</p></div></div>") == text
    assert main_text(f"<div class='ads-right'><article>{text}</article><div class=ad>{other}</div></div>") == text
    # What is named rightly stays out.
    assert main_text(f"<p>{text}</p><div class='sidebar'><p>{other}</p></div>") == text
    assert main_text(f"<article>{text}</article><div class='related'><article>{other}</article></div>") == text
    assert main_text(f"<p>{text}</p><div class='comments'><article class='comment'>{other * 9}</article></div>") == text
    assert main_text(f"<div class='sidebar' hidden><article>{other}</article></div><p>{text}</p>") == text
    assert main_text(f"<aside><article>{other}</article></aside><p>{text}</p>") == text
    assert main_text("<div class=ad>" * 20_000 + text) == ""


ITEMS = [("b", " ".join(f"w{i}" for i in range(14))), ("a", "tiny item"), ("c", None), ("d", ""), (None, "w1 w2"), ("e", "Tiny, ITEM!"), ("f", " ".join(["z"] * 12)), ("a", "w3 w4")]


def windows(items):
    """Windows by item, naively."""
    for item, text in items:
        words = decontamination.words_of((text or "").encode())
        n = min(10, len(words))
        if item is not None and n:
            yield from ((item, words[i : i + n]) for i in range(len(words) - n + 1))


@pytest.mark.parametrize("chunk_words", [1000, 15])
def test_decontamination(spark, odd, nothing, chunk_words):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(14)] + ["tiny", "item", "z", "other"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += [f"x {ITEMS[0][1]} y", "z " * 30, "a tiny item, W3 - w4 b", " ".join(f"w{i}" for i in range(2, 12)), None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    for r in decontamination.find(docs, items, chunk_words=chunk_words).collect():
        words = decontamination.words_of((texts[r["doc_id"]] or "").encode())
        hit, names = set(), set()
        for item, window in windows(ITEMS):
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    names.add(item)
        assert r["n_words"] == len(words) and r["items"] == sorted(names)
        assert {i for s in r["spans"] for i in range(s["first"], s["end"])} == hit
    cleaned = decontamination.decontaminate(docs, items, chunk_words=chunk_words)
    assert decontamination.find(cleaned, items).filter("size(spans) > 0").count() == 0
    untouched = {r["doc_id"] for r in decontamination.find(docs, items).filter("size(spans) = 0").collect()}
    assert {r["doc_id"]: r["text"] for r in cleaned.collect() if r["doc_id"] in untouched} == {i: texts[i] for i in untouched}
    none = items.filter("item_id = 'q'")
    assert plain(decontamination.decontaminate(odd, none).collect()) == plain(odd.collect())
    assert decontamination.find(nothing, items).count() == 0


def linked(texts, words):
    """Smallest index reachable, by comparing all pairs."""
    sets = []
    for text in texts:
        parts = (text or "").lower().split(" ") if text else []
        parts = [p for p in parts if p]
        n = min(words, len(parts))
        sets.append({tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)} if n else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def test_near_duplicates(spark, odd, nothing):
    rng = random.Random(4)
    texts = [None, "", "one", "One", "one two", "a b c d e f", "a b c d e f"]
    for group in range(4):
        base = [f"g{group}v{rng.randrange(60)}" for _ in range(80)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(8)):
                copy[rng.randrange(80)] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    found = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 2).collect()
    roots, sizes = linked(texts, 2)
    for r in found:
        assert (r["n_shingles"], r["component_id"]) == (sizes[r["doc_id"]], roots[r["doc_id"]])
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    shown = near_dedup.near_duplicates(odd).collect()
    assert plain((r["doc_id"], r["component_id"], r["kept"]) for r in shown) == plain(
        [(i, 5 if i == 6 else i, i != 6) for i in range(len(ODD))] + [(None, None, True), (3, 3, True)]
    )
    kept = near_dedup.deduplicate(odd)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i in [*range(6), 7, 8, 9, None])
    assert near_dedup.near_duplicates(nothing).count() == 0 and near_dedup.deduplicate(nothing).count() == 0


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (7, 7)] + [(300, 300 + i) for i in range(1, 30)]
    found = dict(map(tuple, near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(found[i] == 0 for i in range(1, 41)) and found[200] == 100 and all(found[300 + i] == 300 for i in range(1, 30))


@pytest.mark.parametrize("chunk_words", [1000, 25, 10, 1])
def test_cuts_do_not_depend_on_chunks(spark, chunk_words):
    """Windows of items of different chunks overlap in a text, and a cut brings halves of another chunk's window together."""
    w = [f"w{i}" for i in range(1, 40)]
    items = spark.createDataFrame([(1, " ".join(w[:10])), (2, " ".join(w[5:15])), (3, " ".join(w[20:30])), (4, "a b c")], "item_id int, text string")
    rest = " ".join(f"z{i}" for i in range(60))
    texts = {0: " ".join(w[:15]) + " " + rest, 1: " ".join([*w[20:25], *w[:10], *w[25:30]]) + " " + rest, 2: rest, 3: None, 4: " ".join(w[:10]), 5: f"{rest} a a b c b c a a b c b c end"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in decontamination.decontaminate(docs, items, chunk_words=chunk_words).collect()}
    assert found.keys() == {0, 1, 2, 3, 5}
    assert found[0].split() == found[1].split() == rest.split() and found[2] == rest and found[3] is None
    assert found[5].split() == [*rest.split(), "end"]


PROSE = ["The first paragraph of the story is here, and it says what there is to say about the matter.", "It was a long day for all of them, but in the end they had the answer that they were looking for."]


def _paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


def test_extraction_of_other_languages():
    chinese = ["今天上午，市政府宣布了一项新的城市交通计划，旨在缓解高峰时段的拥堵问题，并改善公共交通服务。", "根据该计划，未来三年内将新增多条公交线路，同时扩建地铁网络，预计将惠及数百万居民。"]
    russian = ["Сегодня утром городские власти объявили о новом плане развития транспорта, который должен уменьшить пробки.", "По этому плану за три года появятся новые автобусные маршруты, а сеть метро станет заметно длиннее."]
    for texts in (chinese, russian):
        page = f"<html><body><div class='menu'><a href='/'>x</a></div><div>{_paragraphs(texts)}</div></body></html>"
        assert extraction.main_text(page) == "\n\n".join(texts)


def test_extraction_of_quotes_in_tags():
    third = "And so the third one ends the text, as it was meant to be from the start of the whole thing."
    page = f"<body><p data-x=it's>{PROSE[0]}</p><p title=\"a > b\">{PROSE[1]}</p><p class='x' don't>{third}</p></body>"
    assert extraction.main_text(page) == "\n\n".join([*PROSE, third])


def test_extraction_of_what_surrounds_an_article():
    comment = "I do not think that this is right, but it was good to read what you have to say about it."
    cookie = "We use cookies on this site so that we can give you the best of what we have for you and your family."
    article = f"<article><h1>Story</h1>{_paragraphs(PROSE * 2)}</article>"
    expected = "\n\n".join(["Story", *PROSE * 2])
    for page in (
        f"{article}<section><h2>Comments</h2><div>{_paragraphs([comment] * 2)}</div></section>",
        f"<div>{cookie}</div>{article}",
        f"{article}<div class=relatedPosts>{_paragraphs([comment])}</div>",
        f"{article}<div>Copyright 2020 Acme</div>",
    ):
        assert extraction.main_text(f"<html><body>{page}</body></html>") == expected
    plain = f"<div>{_paragraphs(PROSE)}</div>"
    for page in (f"{plain}<div>Copyright 2020 Acme</div>", f"{plain}<h2>3 Kommentare</h2>{_paragraphs([comment])}", f"{plain}<div class=relatedPosts>{_paragraphs([comment])}</div>"):
        assert extraction.main_text(page) == "\n\n".join(PROSE)
    # A short teaser in an article does not displace the text of the page.
    assert PROSE[1] in extraction.main_text(f"<article><p>A short teaser.</p></article>{_paragraphs(PROSE)}")


def test_extraction_of_many_open_elements():
    import time

    page = "<body>" + "<i>" * 50_000 + "<p>x</i>" * 50_000 + _paragraphs(PROSE)
    began = time.process_time()
    assert PROSE[0] in extraction.main_text(page)
    assert time.process_time() - began < 5


def test_extraction_of_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string, text int")
    assert extraction.extract(pages).columns == ["page_id", "url", "text", "n_chars"] and extraction.extract(pages).count() == 0
