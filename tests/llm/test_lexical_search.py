"""Dual-tree search against scoring every pair."""

import gc
import math
import re
import tracemalloc

import numpy as np
import pytest

from lingmill.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, top):
    held = [(d, split(t)) for d, t in docs]
    held = [(d, t) for d, t in held if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    out = []
    for item, text in set(items):
        scored = []
        for d, words in held:
            m = 100 - 50 + (50 * len(words) * n_docs) // n_terms
            score = 0
            for term in set(split(text)):
                df = sum(term in w for _, w in held)
                tf = words.count(term)
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                score += weight * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, top):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS rank", "2 AS key")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS score", "3 AS item")
    rows = lexical_search.search(d.repartition(5), i, top=top)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in rows.collect()), key=repr)


DOCS = [
    (1, "Red fox, red hen!"), (2, "red FOX red hen"), (2, "red fox red hen"), (3, None), (4, ""), (5, " \t\x00 .,"),
    (None, "fox fox"), (None, "a hen"), (6, "Äpfel äpfel 日本 42"), (7, "fox " * 30_000 + "needle"), (8, "x" * 70_000),
    (9, "hen _under_score_ it's"), (10, "É é fox"),
]
ITEMS = [
    (1, "red fox"), (1, "red fox"), (1, "hen"), (2, None), (3, ""), (None, "Äpfel 日本"), (4, "needle NEEDLE"),
    (5, "nothing here"), (6, "under it s"), (7, "x" * 70_000), (8, "é"),
]


@pytest.mark.parametrize("top", [1, 3, 50])
def test_odd_rows(spark, top):
    assert found(spark, DOCS, ITEMS, top) == brute_force(DOCS, ITEMS, top)


def test_random_rows_in_small_blocks_and_trees(spark, monkeypatch):
    rng = np.random.default_rng(3)

    def text(longest):
        return " ".join(f"w{int(x)}" for x in rng.zipf(1.4, int(rng.integers(1, longest))) % 90)

    copies = text(20)
    docs = [(i, copies if i % 3 == 0 else text(60)) for i in range(700)]
    items = [(i, text(12)) for i in range(90)]
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 40)
    monkeypatch.setattr(lexical_search, "TREE_ITEMS", 17)
    monkeypatch.setattr(lexical_search, "CELLS", 8000)
    assert found(spark, docs, items, 7) == brute_force(docs, items, 7)


def test_nothing_to_search(spark):
    assert found(spark, [], ITEMS, 3) == []
    assert found(spark, DOCS, [], 3) == []
    assert found(spark, [(1, None)], ITEMS, 3) == []


def test_pairs_of_nodes_are_pruned(monkeypatch):
    """Documents that cannot reach the bar are never scored one by one."""
    sets = [frozenset([i]) for i in range(64)]
    items = lexical_search.Items(sets, np.full(64, 10), 64, 2)
    points = np.zeros((512, 64))
    points[np.arange(512), np.arange(512) // 8] = 100 + np.arange(512) % 8
    docs = np.stack([np.zeros(512, np.int64), np.arange(512)], axis=1)
    scored = []
    offer = items.offer
    monkeypatch.setattr(items, "offer", lambda item, scores, rows: (scored.append(len(rows)), offer(item, scores, rows)))
    items.search(points, docs)
    assert sum(scored) == 512  # of 32,768 pairs
    for number, scores, held in items.best():
        assert held[:, 1].tolist() == [8 * number + 7, 8 * number + 6]


def test_large_weights_are_summed_as_integers():
    items = lexical_search.Items([frozenset([0, 1])], np.array([10**10, 1]), 2, 5)
    assert items.kind is np.int64
    items.search(np.array([[999_999, 3]]), np.array([[0, 8]]))
    assert [s.tolist() for _, s, _ in items.best()] == [[999_999 * 10**10 + 3]]


def test_batches_are_let_go_once_searched():
    """A task holds one batch of documents, however many it reads, also before Python looks for cycles."""
    rng = np.random.default_rng(5)
    items = lexical_search.Items([frozenset([i, i + 1]) for i in range(200)], np.full(201, 10), 201, 3)
    points = rng.integers(0, 1000, (1000, 201)).astype(items.kind)
    docs = np.stack([np.zeros(1000, np.int64), np.arange(1000)], axis=1)
    items.search(points, docs)
    gc.collect()
    gc.disable()
    tracemalloc.start()
    try:
        for _ in range(6):
            items.search(points, docs)
        now, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
        gc.enable()
    assert now < points.nbytes / 2
    assert most < 2 * points.nbytes
