import numpy as np
import pytest
from pyspark.sql import functions as F

from lingmill.operators import stats


def numbers(spark, xs, parts=5):
    return spark.createDataFrame([(float(x) if x is not None else None,) for x in xs], "x double").repartition(parts)


SAMPLES = {
    "plain": np.random.default_rng(1).normal(size=501),
    "one": [4.0],
    "constant": [2.5] * 40,
    "hot": [1.0] * 300 + list(np.linspace(0, 9, 101)),
    "heavy tail": list(np.random.default_rng(2).pareto(0.3, 400)),
    "two": [1.0, 3.0],
}


@pytest.mark.parametrize("name", SAMPLES)
def test_quantiles_equal_numpy(spark, name):
    xs = SAMPLES[name]
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0, "f": 0.333}
    got = stats.exact_quantiles(numbers(spark, [*xs, None, float("nan")]), F.col("x"), wanted).first()
    for key, q in wanted.items():
        assert got[key] == pytest.approx(np.quantile(xs, q), rel=1e-12, abs=1e-12)


def test_quantiles_of_nothing(spark):
    got = stats.exact_quantiles(numbers(spark, [None, float("nan")]), F.col("x"), {"a": 0.5}).collect()
    assert [r.a for r in got] == [None]


@pytest.mark.parametrize("name", ["plain", "constant", "hot", "one"])
def test_histogram_equals_numpy(spark, name):
    xs = SAMPLES[name]
    counts, edges = np.histogram(xs, bins=20)
    got = stats.histogram(numbers(spark, [*xs, None]), F.col("x"), 20).orderBy("bin").collect()
    assert [r.n for r in got] == counts.tolist()
    assert [r.bin_start for r in got] == pytest.approx(edges[:-1].tolist())


def test_grouped_histogram_equals_single_ones(spark):
    rows = [("a", float(i * i)) for i in range(50)] + [("b", 3.0)] * 7
    df = spark.createDataFrame(rows, "g string, x double")
    got = stats.grouped_histogram(df, "g", F.col("x"), 10)
    for g in "ab":
        want = stats.histogram(df.where(F.col("g") == g), F.col("x"), 10).orderBy("bin").collect()
        have = got.where(F.col("g") == g).orderBy("bin").collect()
        assert [(r.bin, r.n) for r in have] == [(r.bin, r.n) for r in want]


def test_tail_rollup_loses_exactly_the_floor(spark):
    df = spark.createDataFrame([("a", 900), ("b", 500), ("c", 499), ("d", 2)], "l string, n long")
    got = {r.l: r.n for r in stats.tail_rollup(df, "l").collect()}
    assert got == {"a": 900, "Other": 501}
    small = {r.l: r.n for r in stats.tail_rollup(df.where("l <> 'd'"), "l").collect()}
    assert small == {"a": 900}


def test_confidence_counts_skip_the_cut_itself(spark):
    df = spark.createDataFrame([("a", 0.9), ("a", 0.8), ("a", 0.1), ("b", 0.8)], "l string, s double")
    got = {r.l: (r.n_above, r.n_below) for r in stats.confidence_counts(df, "l", F.col("s")).collect()}
    assert got == {"a": (1, 1), "b": (0, 0)}


def test_counts_slices_shares_rates(spark):
    df = spark.createDataFrame([(c,) for c in "aaabbccd"] + [(None,)], "l string")
    assert [(r.l, r.n) for r in stats.value_counts(df, "l").collect()] == [("a", 3), ("b", 2), ("c", 2), ("d", 1)]
    assert [r.l for r in stats.value_counts_slice(df, "l", 1, 3).collect()] == ["b", "c"]
    assert [r.l for r in stats.top_values(df, "l", 2).collect()] == ["a", "b"]
    shares = stats.add_share(stats.value_counts(df, "l")).collect()
    assert sum(r.share for r in shares) == pytest.approx(1)
    assert stats.rate(df, F.col("l") == "a").first().rate == pytest.approx(3 / 9)


def test_cost(spark):
    df = spark.createDataFrame([(1000, 2000), (10, 0)], "p int, c int")
    assert stats.total_cost(df, F.col("p"), F.col("c")).first().dollars == 0.07


def test_mean_and_correlation_skip_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", nan, 5.0), ("b", nan, 1.0)], "g string, x double, y double")
    got = {r.g: (r["mean"], r.n) for r in stats.mean_and_size(df, "g", F.col("x")).collect()}
    assert got == {"a": (1.5, 2), "b": (None, 0)}
    assert stats.correlation(df, F.col("x"), F.col("y")).first().r == pytest.approx(1.0)
