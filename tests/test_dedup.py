import numpy as np
import pytest
from pyspark.sql import functions as F

from lingmill.operators import dedup
from tests.conftest import plan_of


def brute(rows, threshold):
    kept = []
    for key, group, vec, order in rows:
        earlier = [r for r in rows if r[1] == group and r[3] < order]
        if vec is None or group is None or not any(
            r[2] is not None and np.dot(r[2], vec) > threshold for r in earlier
        ):
            kept.append(key)
    return sorted(kept)


def made_rows(count=400, copies=120, seed=3):
    """Random unit vectors, a third of them copies, in an order unlike the key's."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(count, 8))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[rng.choice(count, copies, replace=False)] = vectors[0]
    groups = rng.choice(["a", "b", "hot", "hot", "hot"], count)
    order = rng.permutation(count)
    rows = [(int(i), str(groups[i]), [float(x) for x in vectors[i]], f"o{order[i]:05d}") for i in range(count)]
    rows[5] = (5, "hot", None, rows[5][3])
    rows[6] = (6, None, rows[6][2], rows[6][3])
    return rows


SCHEMA = "k long, g string, v array<double>, o string"


@pytest.mark.parametrize("block_rows", [7, 64, 8192])
@pytest.mark.parametrize("threshold", [0.8, 0.3])
def test_near_duplicates_equal_brute_force(spark, block_rows, threshold):
    rows = made_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    kept = dedup.drop_near_duplicates(df, "k", "g", "v", ["o"], threshold, block_rows)
    assert sorted(r.k for r in kept.collect()) == brute(rows, threshold)


def test_vectors_that_are_not_normalised(spark):
    rows = [(i, "a", [0.5, 0.0], f"{i}") for i in range(4)] + [(9, "a", [9.0, 9.0], "9")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(r.k for r in dedup.drop_near_duplicates(df, "k", "g", "v", ["o"]).collect())
    assert got == brute(rows, 0.8) == [0, 1, 2, 3]


def test_removed_rows_still_remove_others(spark):
    def at(degrees):
        return [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]

    # Neighbours are 30 degrees apart (0.87), next ones 60 (0.5): a chain loses all but its head.
    rows = [(i, "a", at(30 * i), f"{i}") for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r.k for r in dedup.drop_near_duplicates(df, "k", "g", "v", ["o"]).collect()] == [0]


def test_the_threshold_is_exclusive(spark):
    rows = [(0, "a", [1.0, 0.0], "0"), (1, "a", [0.8, 0.6], "1")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert dedup.drop_near_duplicates(df, "k", "g", "v", ["o"], 0.8).count() == 2


def test_pairs_are_never_joined(spark):
    df = spark.createDataFrame(made_rows(50, 10), SCHEMA)
    plan = plan_of(dedup.near_duplicate_keys(df, "k", "g", "v", ["o"]))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_copies_of_short_vectors_match_others_only(spark):
    """A vector below the threshold in length does not match its copies, but a longer one does."""
    rows = [(0, "a", [0.5, 0.0], "0"), (1, "a", [4.0, 0.0], "1"), (2, "a", [0.5, 0.0], "2"), (3, "a", [0.5, 0.0], "3"), (4, "b", [0.5, 0.0], "4")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(r.k for r in dedup.drop_near_duplicates(df, "k", "g", "v", ["o"]).collect())
    assert got == brute(rows, 0.8) == [0, 4]


def test_blocks_that_cannot_match_are_skipped(spark):
    """Clusters far apart and tight: most pairs of blocks are never compared, none is lost."""
    rng = np.random.default_rng(9)
    rows = []
    for c in range(12):
        centre = np.zeros(12)
        centre[c] = 1
        for _ in range(60):
            v = centre + rng.normal(scale=0.02, size=12)
            rows.append((len(rows), "a", [float(x) for x in v / np.linalg.norm(v)], f"{rng.integers(10**9):09d}-{len(rows)}"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    kept = dedup.drop_near_duplicates(df, "k", "g", "v", ["o"], 0.8, 20)
    assert sorted(r.k for r in kept.collect()) == brute(rows, 0.8)
    report = dedup.near_duplicate_pruning(df, "k", "g", "v", ["o"], 0.8, 20).first()
    assert report.n_vectors == 720 and report.n_pairs == 720 * 719 // 2
    assert report.n_skipped > 0.4 * report.n_pairs
    assert report.copies_sent < report.n_blocks / 2


def test_copies_count_as_one_vector(spark):
    rows = [(i, "a", [1.0, 0.0], f"{i:04d}") for i in range(500)] + [(600, "a", [0.0, 1.0], "9")]
    df = spark.createDataFrame(rows, SCHEMA)
    report = dedup.near_duplicate_pruning(df, "k", "g", "v", ["o"]).first()
    assert (report.n_vectors, report.n_pairs) == (2, 1)
    assert [r.k for r in dedup.drop_near_duplicates(df, "k", "g", "v", ["o"]).sort("k").collect()] == [0, 600]


def test_exact_duplicates_keep_the_first_by_order(spark):
    rows = [(i, "fr" if i % 2 else "en", "hot" if i % 3 else f"t{i % 30}") for i in range(300)] + [(900, "aa", None), (901, "aa", None)]
    df = spark.createDataFrame(rows, "k int, l string, t string").repartition(7)
    kept = dedup.drop_exact_duplicates(df, ["t"], ["l", "k"])
    first = {}
    for k, l, t in sorted(rows, key=lambda r: (r[1], r[0])):
        first.setdefault(t, k)
    assert sorted(r.k for r in kept.collect()) == sorted(first.values())
    assert "row_number(), 1, Partial" in plan_of(kept)


def test_dedup_prompts_runs_all_three_steps(spark):
    rows = [
        (1, "en", "same", [1.0, 0.0]),
        (2, "en", "close", [0.99, 0.1]),
        (3, "en", "far", [0.0, 1.0]),
        (4, "fr", "same", [1.0, 0.0]),
        (5, "fr", None, [0.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "k int, l string, p string, v array<double>")
    assert sorted(r.k for r in dedup.dedup_prompts(df, "k", "l", "p", "v").collect()) == [1, 3]
