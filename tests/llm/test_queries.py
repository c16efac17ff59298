"""Every registered corpus query at the smallest scale: against DuckDB, or against a plain version of the same rules."""

import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.compare import connect, difference
from tests.conftest import SMALL
from tillwright.llm import queries



@pytest.fixture(scope="module")
def documents():
    return duckdb.execute(f"SELECT doc_id, coalesce(text, ''), source FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_sql(name, spark):
    assert difference(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLE_SQL[name]) is None


def test_all_queries_are_registered():
    import __spark_entry__ as driver

    names = driver.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_mix_comes_near_its_targets(spark, documents):
    rows = queries.QUERIES["op1_source_mixing"](spark, SMALL).collect()
    again = queries.QUERIES["op1_source_mixing"](spark, SMALL).collect()
    assert sorted(rows) == sorted(again)
    assert {r["doc_id"]: r["size"] for r in rows} == {d: len(t.encode().split()) for d, t, _ in documents}
    sizes, taken, targets = Counter(), Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
    wanted = filled(dict(sizes))
    for source, target in wanted.items():
        assert targets[source] == pytest.approx(target, rel=1e-9)
        assert abs(taken[source] - target) <= 0.02 * target + 64


def filled(sizes, weights=(5, 2, 1), share=1.5, passes=2):
    """Targets, one round of resharing after the other."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > passes * sizes[s]]
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = passes * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def test_token_counts_are_the_tokenizer_s(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r["doc_id"]: r for r in queries.QUERIES["op2_token_counts"](spark, SMALL).collect()}
    for doc, text, _ in documents:
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (found[doc]["n_bytes"], found[doc]["n_tokens"], found[doc]["over_limit"]) == (len(text.encode()), n, n > 512)


def test_token_files_hold_the_tokenizer_s_ids(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {r["doc_id"]: r for r in queries.QUERIES["op3_token_id_files"](spark, SMALL).collect()}
    start = 0
    for doc, text, _ in documents:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        assert (found[doc]["start"], found[doc]["n_tokens"], found[doc]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_neighbours_have_recall(spark):
    rows = duckdb.execute(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet' WHERE embedding IS NOT NULL ORDER BY vec_id").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    found = queries.QUERIES["op6_nearest_neighbours"](spark, SMALL).collect()
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[q]
        best = [i for i in np.lexsort((ids, -scores)) if i != q][:20]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == ids[q])
        assert [m[0] for m in mine] == list(range(1, len(best) + 1))
        assert [m[2] for m in mine] == sorted((m[2] for m in mine), reverse=True)
        hits += len({ids[i] for i in best} & {m[1] for m in mine})
        total += len(best)
    assert hits >= 0.9 * total


def test_classifier_is_right_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = dict(duckdb.execute(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall())
    rows = queries.QUERIES["op7_quality_classifier"](spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_pages_give_their_articles(spark):
    import html
    import re

    pages = dict(duckdb.execute(f"SELECT page_id, html FROM '{SMALL}/pages.parquet'").fetchall())
    for r in queries.QUERIES["op8_html_extraction"](spark, SMALL).collect():
        inside = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inside)]
        assert r["text"] == "\n\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


def test_pipeline(spark, documents):
    """Every stage by itself, on what the one before it kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = dict(duckdb.execute(f"SELECT doc_id, quality FROM '{SMALL}/labels.parquet'").fetchall())
    kept, texts = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SMALL)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/{name.replace(' ', '-')}"
        result.write.mode("overwrite").parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        kept[name] = [r["doc_id"] for r in docs.collect()]
        texts[name] = docs
    good = set(kept["quality classifier"])
    assert sum((d in good) == (q == 1) for d, q in labels.items()) >= 0.95 * len(labels)
    assert len(set(kept["minhash near-dedup"])) == len(kept["minhash near-dedup"]) < len(good)
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    from tillwright.llm.decontamination import find

    assert find(texts["minhash near-dedup"], items).filter("size(spans) > 0").count() > 0
    assert find(texts["benchmark decontamination"], items).filter("size(spans) > 0").count() == 0
    assert max(Counter(kept["source mixing"]).values()) <= 2
    assert sorted(kept["token id files"]) == sorted(kept["source mixing"])
    assert texts["source mixing"].columns == spark.read.parquet(f"{SMALL}/documents.parquet").columns


def test_rest_of_the_library_does_not_use_this(tmp_path):
    top = Path(__file__).resolve().parents[2]
    for file in (top / "tillwright").rglob("*.py"):
        if "llm" not in file.parts:
            assert "tillwright.llm" not in file.read_text()
