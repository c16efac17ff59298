"""Ranked search against SQL, on small trees and hostile rows; bounds that never cut what is among the best."""

import duckdb
import numpy as np
import pytest

from tests.compare import difference
from tillwright.llm import lexical_search as ls
from tillwright.llm import queries

SQL = queries.ORACLE_SQL["op12_ranked_search"]


def stored(spark, tmp_path, docs, items):
    con = duckdb.connect()
    frames = []
    for name, rows, schema in (
        ("documents", docs, "doc_id long, text string, item_id string, score string, n long, terms string"),
        ("benchmark", items, "item_id long, text string, doc_id string, query int, rank int"),
    ):
        path = str(tmp_path / name)
        width = len(schema.split(",")) - 2
        spark.createDataFrame([(*r, *[None] * width) for r in rows], schema).write.parquet(path)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'")
        frames.append(spark.read.parquet(path))
    return *frames, con


def corpus(n):
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(60)] + ["Éa", "漢字", "x1"])
    share = 1 / np.arange(1, len(words) + 1)
    return [(i, " ".join(rng.choice(words, rng.integers(1, 40), p=share / share.sum()))) for i in range(n)]


ODD = [(None, "w1 w2 w3"), (900, None), (901, ""), (902, " .,-! "), (903, "W1 w1,W1;w59\tw59"), (904, "w59 " * 30_000), (905, "w5 w6"), (906, "w5 w6"), (905, "w5 w6")]
ITEMS = [(0, "w59 w58 Éa"), (1, "w5 W6 w5"), (1, "w1"), (None, "w2 漢字"), (3, None), (4, "... "), (5, "nowhere"), (6, " ".join(f"w{i}" for i in range(60)))]


@pytest.mark.parametrize("sizes", [{}, {"block_docs": 1, "leaf_docs": 3, "query_terms": 4}, {"block_entries": 50, "leaf_docs": 1}])
def test_search_equals_sql(spark, tmp_path, sizes):
    docs, items, con = stored(spark, tmp_path, corpus(700) + ODD, ITEMS)
    assert difference(ls.search(docs, items, **sizes), con, SQL) is None


def test_empty_tables(spark, tmp_path):
    docs, items, _ = stored(spark, tmp_path, corpus(5), ITEMS)
    found = ls.search(docs.filter("doc_id < 0"), items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0
    assert ls.search(docs, items.filter("item_id < 0")).count() == 0
    assert ls.search(docs, items, k=3).groupBy("item_id").count().agg({"count": "max"}).first()[0] <= 6


def test_balls_bound_their_documents_and_are_pruned():
    rng = np.random.default_rng(11)
    queries_ = ls.Queries([0, 1], [np.array([0, 1, 2]), np.array([30, 31])], [np.array([1, 2, 1]), np.array([1, 1])], {bytes([i]): i for i in range(40)})
    # Two groups that share no terms: a query of one leaves the other's balls alone.
    lengths = rng.integers(1, 12, 400)
    terms = np.concatenate([np.sort(rng.choice(20, n, replace=False)) + 20 * (i % 2) for i, n in enumerate(lengths)])
    values = rng.integers(1, 5_000_000_000, lengths.sum())
    block = ls.Block(np.arange(400), terms, values, np.concatenate([[0], np.cumsum(lengths)]))
    tree = ls.Tree(block, queries_, 8)
    for q, (t, c) in enumerate(zip(queries_.terms, queries_.counts, strict=True)):
        dense = np.zeros(40, dtype=np.int64)
        dense[t] = c
        for ball, leaf in tree.leaves.items():
            assert leaf.dot(dense).max() <= tree.bounds[ball][q]
        best = []
        scored = tree.search(q, dense, best, 5)
        scores = block.dot(dense)
        expected = sorted(((int(s), -i) for i, s in enumerate(scores)), reverse=True)[:5]
        assert sorted(best, reverse=True) == expected and scored < 0.7 * len(tree.leaves)
