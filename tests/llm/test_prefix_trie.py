"""The trie of rebuilt conversations against SQL, and the decomposition against plain sums."""

import random

import duckdb
from pyspark.sql import functions as F

from tests.compare import difference
from tests.conftest import SMALL
from tillwright.llm import prefix_trie as pt
from tillwright.llm import queries

SQL = queries.ORACLE_SQL["op13_conversation_trie"]
SCHEMA = "conv_id long, turn long, role string, text string, depth int, weight string, p1 int, n_turns string"


def stored(spark, tmp_path, rows):
    path = str(tmp_path / "conversations")
    spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    return spark.read.parquet(path), con


def drawn(seed=7):
    """Shared beginnings, copies, gaps, ties, nulls and conversations that lose all their turns."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(-25, 65), 400, 401, 1000003]:
        for turn in range(rng.choice([1, 1, 2, 3, 4, 9])):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", "user", None]), rng.choice(["a b", "a b", "c", "", None, "d\te f "])))
    rows += [(None, 0, "user", "a b"), (None, None, None, None)]
    return rows + rows[:9]


def test_trie_equals_sql(spark, tmp_path):
    conversations, con = stored(spark, tmp_path, drawn())
    for local in (pt.LOCAL_NODES, 60):
        assert difference(pt.prefix_trie(*pt.rebuilt(conversations), local_nodes=local), con, SQL) is None
    convs, turns = pt.rebuilt(conversations)
    assert convs.filter("n_turns = 0").count() > 0
    nodes = pt.prefix_trie(convs, turns)
    assert pt.with_turns(nodes, turns).filter("text IS NULL").select("depth").collect() == [(0,)]


def test_long_conversations_and_copies(spark, monkeypatch):
    """Turns in several windows, ids in several pieces, a deep trie that is split level by level."""
    monkeypatch.setattr(pt, "BLOCK_TURNS", 16)
    monkeypatch.setattr(pt, "CHUNK_IDS", 7)
    long = [(1, d, "user", f"turn {d}") for d in range(1, 301)]
    fork = [(2, d, "user", f"turn {d}" if d <= 200 else f"other {d}") for d in range(1, 251)]
    copies = [(c, d, "user", "same words here") for c in range(10, 60) for d in (1, 2)]
    turns = spark.createDataFrame(long + fork + copies, "conv_id long, depth long, role string, text string").repartition(5)
    convs = turns.groupBy("conv_id").agg(F.max("depth").alias("n_turns"))
    found = {(r["conv_id"], r["depth"]): r for r in pt.prefix_trie(convs, turns, local_nodes=120).collect()}
    assert len(found) == 1 + 300 + 50 + 2
    root = found[(1, 0)]
    assert (root["n_convs"], root["n_children"], root["n_leaves"], root["saved_tokens"]) == (52, 2, 3, 200 * 2 + 2 * 49 * 3)
    assert (found[(1, 150)]["n_leaves"], found[(1, 150)]["saved_tokens"], found[(2, 201)]["parent_conv_id"]) == (2, 51 * 2, 1)
    import hashlib

    assert found[(10, 2)]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(10, 60))).encode()).hexdigest()
    assert found[(10, 1)]["ends_sha256"] == hashlib.sha256(b"").hexdigest()


def test_no_conversations(spark):
    conversations = spark.read.parquet(f"{SMALL}/conversations.parquet").filter("conv_id < 0")
    assert pt.prefix_trie(*pt.rebuilt(conversations)).count() == 0


def test_decomposition_of_random_trees():
    rng = random.Random(2)
    for n in [1, 2, 3, 10, 60, 400]:
        for shape in range(4):
            parents = [0] + [rng.randrange(max(0, i - 1) if shape == 0 else 0 if shape == 1 else max(0, i - 5), i) for i in range(1, n)]
            parents = [0] + [i - 1 for i in range(1, n)] if shape == 3 else parents
            own, value = [rng.randrange(1, 4) for _ in range(n)], [rng.randrange(9) for _ in range(n)]
            weight, plain = own[:], value[:]
            for i in range(n - 1, 0, -1):
                weight[parents[i]] += weight[i]
                plain[parents[i]] += plain[i]
            sums = [0] * n
            pt.decompose(parents, weight[:], [value], [sums])
            assert sums == plain
