import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lingmill.functions import draws
from lingmill.operators import sampling
from lingmill.sources import writers
from tests.conftest import plan_of


def skewed(spark, parts):
    """One group holds most rows; one is small; one is null."""
    group = F.when(F.col("id") < 6000, "big").when(F.col("id") < 6040, "small").when(F.col("id") < 6500, "mid")
    return spark.range(6600).select("id", group.alias("g"), F.concat(F.lit("p"), "id").alias("payload")).repartition(parts)


def expected(rows, n, seed):
    by_group = {}
    for r in rows:
        if r.g is not None:
            h = hashlib.md5(f"{r.id}|{seed}".encode()).hexdigest()
            by_group.setdefault(r.g, []).append((h, r.id))
    return {(g, i) for g, items in by_group.items() for _, i in sorted(items)[:n]}


@pytest.mark.parametrize("n", [1, 10, 11, 300, 5000])
def test_sample_is_exact_and_independent_of_partitions(spark, n):
    want = expected(skewed(spark, 3).collect(), n, 7)
    for parts in (1, 9):
        got = sampling.sample_per_group(skewed(spark, parts), ["g"], ["id"], n, 7).collect()
        assert {(r.g, r.id) for r in got} == want
        assert len(got) == len(want)
        assert all(r.payload == f"p{r.id}" for r in got)


@pytest.mark.parametrize("slack", [-8.0, -2.0])
def test_groups_that_fall_short_are_looked_at_again(spark, monkeypatch, slack):
    """Thresholds that are far too low at first."""
    monkeypatch.setattr(sampling, "SLACK", slack)
    rounds = []
    settle = sampling.settle
    monkeypatch.setattr(sampling, "settle", lambda df, label: rounds.append(label) or settle(df, label))
    got = sampling.sample_per_group(skewed(spark, 4), ["g"], ["id"], 200, 1).collect()
    assert {(r.g, r.id) for r in got} == expected(skewed(spark, 4).collect(), 200, 1)
    assert rounds.count("short-groups") >= 1


def test_sample_ranks_are_places(spark):
    got = sampling.sample_per_group(skewed(spark, 4), ["g"], ["id"], 50, 1, rank="place").collect()
    for g, size in (("big", 50), ("small", 40), ("mid", 50)):
        assert sorted(r.place for r in got if r.g == g) == list(range(1, size + 1))


@pytest.mark.parametrize("n", [5, 1000])
def test_rows_beyond_the_threshold_are_not_kept(spark, monkeypatch, n):
    """Of 300,000 rows in one group about n are written and exchanged; the rest stays where it is."""
    written = []
    settle = sampling.settle
    monkeypatch.setattr(sampling, "settle", lambda df, label: written.append((label, settle(df, label))) or written[-1][1])
    df = spark.range(300_000).select("id", F.lit("hot").alias("g"))
    got = sampling.sample_per_group(df, ["g"], ["id"], n)
    assert got.count() == n
    rows = {label: table.count() for label, table in written}
    assert rows["group-sizes"] == 1 and n <= rows["sample"] <= n + 6 * (n**0.5 + 6) * 2
    assert [label for label, _ in written] == ["group-sizes", "sample"]
    plan = plan_of(got)
    assert plan.count("Exchange") <= 1 and "range" not in plan.lower()


@pytest.mark.parametrize("parts", [1, 7])
def test_row_index_is_contiguous_and_ordered(spark, parts):
    df = spark.range(0, 5000, 3).repartition(parts)
    rows = sampling.with_row_index(df, ["id"]).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(len(rows)))
    assert [r.id for r in rows] == sorted(r.id for r in rows)


def test_row_index_with_nulls_and_two_columns(spark):
    rows = [(None, 2, "a"), (None, 1, "b"), ("x", None, "c"), ("x", 1, "d"), ("w", 9, "e")]
    df = spark.createDataFrame(rows, "g string, n int, payload string").repartition(3)
    got = {r.payload: r.row_index for r in sampling.with_row_index(df, ["g", "n"]).collect()}
    assert got == {"b": 0, "a": 1, "e": 2, "c": 3, "d": 4}


def test_wide_rows_are_written_once(spark, monkeypatch, tmp_path):
    """Only keys and numbers are written on the way to chunk files, which keep the order."""
    written = []
    settle = sampling.settle
    monkeypatch.setattr(sampling, "settle", lambda df, label: written.append(df.columns) or settle(df, label))
    df = spark.range(5000).select("id", F.concat(F.lit("wide "), "id").alias("payload")).repartition(7)
    writers.write_chunks(df, str(tmp_path / "chunks"), ["id"], 700)
    assert written and all("payload" not in columns for columns in written)
    stored = spark.read.parquet(str(tmp_path / "chunks"))
    assert stored.count() == 5000 and stored.select("chunk_id").distinct().count() == 8
    one = spark.read.parquet(f"{tmp_path}/chunks/chunk_id=000700").select("id").collect()
    assert sorted(r.id for r in one) == list(range(700, 1400))


def test_chunks_are_named_by_their_first_row(spark):
    rows = sampling.with_chunks(spark.range(1234), ["id"], 500, 7, shift=217_000).collect()
    assert Counter(r.chunk_id for r in rows) == {"0217000": 500, "0217500": 500, "0218000": 234}
    assert all(int(r.chunk_id) - 217_000 == r.id - r.id % 500 for r in rows)


def test_shuffle_peek_and_resume(spark):
    df = spark.range(100)
    order = [r.id for r in sampling.full_shuffle(df, ["id"], 42).collect()]
    assert sorted(order) == list(range(100)) and order != list(range(100))
    assert order == [r.id for r in sampling.full_shuffle(df.repartition(9), ["id"], 42).collect()]
    assert [r.id for r in sampling.peek(df, ["id"], 42).collect()] == order[:1]
    left = sampling.not_done(df, spark.range(0, 100, 2), ["id"])
    assert sorted(r.id for r in left.collect()) == list(range(1, 100, 2))


def test_draws_are_even_and_match_md5(spark):
    df = spark.range(4000).select("id", draws.draw_below([F.col("id")], "s", 7).alias("d"))
    rows = df.collect()
    assert all(r.d == int(hashlib.md5(f"{r.id}|s".encode()).hexdigest()[:8], 16) % 7 for r in rows)
    assert min(Counter(r.d for r in rows).values()) > 450
    kinds = spark.range(4000).select(sampling.draw_prompt_type(["id"]).alias("t"))
    kinds = kinds.groupBy("t").count().collect()
    assert {r.t for r in kinds} == {"command", "question"} and all(1800 < r["count"] < 2200 for r in kinds)


def test_item_samples_have_no_repeats_and_vary(spark):
    items = [f"s{i}" for i in range(60)]
    df = spark.range(20).withColumn("items", F.array(*[F.lit(i) for i in items]))
    rows = df.select(sampling.sample_items(F.col("items"), 25, [F.col("id")]).alias("s")).collect()
    assert all(len(set(r.s)) == 25 and set(r.s) <= set(items) for r in rows)
    assert len({tuple(r.s) for r in rows}) == 20


def test_replication(spark):
    rows = sampling.replicate(spark.createDataFrame([("a",), ("b",)], "l string"), 50).collect()
    assert Counter(r.l for r in rows) == {"a": 50, "b": 50}
    assert sorted(r.repeat_id for r in rows if r.l == "a") == list(range(1, 51))
