"""Many near copies of one text, with edits of their own just above and just below what makes a link."""

import random
from itertools import combinations

import pyarrow as pa
import pytest

from tillwright.llm import near_dedup


def copies(n, words, edits, seed):
    """Texts that differ from a base in words of their own; an edit changes two 2-word shingles."""
    rng = random.Random(seed)
    base = [f"base{i}" for i in range(words)]
    texts = []
    for c in range(n):
        text = base[:]
        for place in rng.sample(range(1, words - 1, 2), rng.choice(edits)):
            text[place] = f"own{seed}x{c}x{place}"
        texts.append(" ".join(text))
    return texts


def components_of(texts):
    sets = [{(a, b) for a, b in zip(t.split(), t.split()[1:], strict=False)} for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return {i: find(i) for i in range(len(texts))}


@pytest.mark.parametrize("edits", [(5, 6), (6, 7), (2, 6, 9)])
def test_components_equal_brute_force(spark, edits):
    # 100 shingles: with 5 edits each two copies have 80 common ones of 120, with 2 edits 92 of 108.
    texts = copies(120, 101, edits, 1) + copies(60, 61, (3, 4), 2) + ["one two", "one two three"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, shingle_words=2).collect()}
    assert found == components_of(texts)


def test_pairs_of_unlinked_copies_do_not_arise(spark):
    """Edits above the limit: the prefixes consist of edits, and no pair is compared but with pivots and drawn members."""
    made = {}
    original = near_dedup._prefix_pairs
    for n in (100, 400):
        def counted(*args, n=n):
            found = original(*args)
            made[n] = 0 if found is None else found.count()
            return found

        near_dedup._prefix_pairs = counted
        try:
            docs = spark.createDataFrame(list(enumerate(copies(n, 101, (7, 8), 3))), "doc_id long, text string").repartition(4)
            assert near_dedup.near_duplicates(docs, shingle_words=2).filter("NOT kept").count() == 0
        finally:
            near_dedup._prefix_pairs = original
    assert made[400] <= 400


def test_tasks_hold_few_sets_and_words(monkeypatch):
    """Batches are worked on in pieces of bounded size, in order and whole, and words are forgotten before there are too many."""
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2 * near_dedup.HELD_SETS + 5))})
    pieces = list(near_dedup._pieces(iter([batch, batch.slice(0, 0), batch.slice(0, 3)])))
    assert [p.num_rows for p in pieces] == [near_dedup.HELD_SETS, near_dedup.HELD_SETS, 5, 3]
    assert pa.Table.from_batches(pieces).column("doc_id").to_pylist() == [*range(batch.num_rows), 0, 1, 2]
    monkeypatch.setattr(near_dedup, "KEPT_WORDS", 50)
    few, many = near_dedup._WordHashes(), {}
    for n in range(500):
        word = b"w%d" % (n % 120)
        assert few[word] == many.setdefault(word, few[word]) and len(few) <= 50
