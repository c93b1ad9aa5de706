"""Summaries. Every one aggregates partially before it shuffles, so a value
that holds a third of all rows costs no more than a rare one."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import messages
from lingmill.session import settle


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, largest first, nulls left out, ties by value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )


def top_values(df: DataFrame, column: str, k: int = 40) -> DataFrame:
    return value_counts(df, column).limit(k)


def value_counts_slice(df: DataFrame, column: str, start: int = 20, stop: int = 60) -> DataFrame:
    """Positions ``start`` to ``stop`` of the value counts, ties by value."""
    return value_counts(df, column).offset(start).limit(stop - start)


def confidence_counts(
    df: DataFrame, group: str, score: Column, cut: float = fixed.DETECTION_CONFIDENCE
) -> DataFrame:
    """Rows above and below the cut; a score equal to it counts in neither."""
    return df.groupBy(group).agg(
        F.count_if(score > cut).alias("n_above"), F.count_if(score < cut).alias("n_below")
    )


def add_share(counts: DataFrame, count: str = "n", share: str = "share") -> DataFrame:
    """Each count over the total. ``counts`` is already aggregated."""
    # One row a group, so the window over all of them is small and the input is read once.
    return counts.withColumn(share, F.col(count) / F.sum(count).over(Window.partitionBy()))


def rate(df: DataFrame, predicate: Column, name: str = "rate") -> DataFrame:
    """Share of rows where the predicate is true; false for null."""
    return df.agg(F.avg(F.coalesce(predicate, F.lit(False)).cast("double")).alias(name))


def _bin_of(x: Column, lo: Column, width: Column, bins: int) -> Column:
    """Bin number of ``x``, exact at the edges ``lo + i * width``; the last bin is closed.

    Division can land one bin off when a value sits on an edge.
    """
    guess = F.least(F.floor((x - lo) / width), F.lit(bins - 1))
    below = (x < lo + guess * width).cast("long")
    above = ((x >= lo + (guess + 1) * width) & (guess < bins - 1)).cast("long")
    return (guess - below + above).cast("long")


def histogram(df: DataFrame, value: Column, bins: int = 100) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed, empty bins included.

    NaN and null are skipped. A constant column gets a range of width 1 around it.
    """
    x = value.cast("double")
    values = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    ends = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ends = ends.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    lo = ends.select("lo").scalar()
    width = ends.select((F.col("hi") - F.col("lo")) / bins).scalar()
    bucket = _bin_of(F.col("x"), lo, width, bins)
    counts = values.groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return frame.join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values; partial distinct per task, then one count."""
    return df.agg(F.countDistinct(column).alias("n_distinct"))


def tail_rollup(
    counts: DataFrame, label: str, count: str = "n", floor: int = fixed.ROLLUP_FLOOR
) -> DataFrame:
    """Fold small counts into "Other", then keep counts above the floor.

    Counts below ``floor`` go into Other; then everything at or below it is
    dropped, so exactly ``floor`` is lost, and so is a small Other.
    """
    other = counts.where(F.col(count) < floor).agg(F.sum(count).cast("long").alias(count))
    other = other.select(F.lit("Other").alias(label), count)
    return counts.select(label, count).unionByName(other).where(F.col(count) > floor)


def exact_quantiles(
    df: DataFrame, value: Column, quantiles: Mapping[str, float], slices: int | None = None
) -> DataFrame:
    """Linearly interpolated exact quantiles as one row, NaN and null skipped.

    Rows are counted per distinct value; the distinct values are cut into ``slices`` ranges
    of about equally many values (the session's shuffle partitions unless given). Only
    ranges that hold a wanted rank are put in order, so neither hot values nor a
    heavy tail gather in one task.
    """
    x = value.cast("double")
    values = settle(
        df.select(x.alias("x"))
        .where(F.col("x").isNotNull() & ~F.isnan("x"))
        .groupBy("x")
        .agg(F.count(F.lit(1)).alias("c")),
        "quantile-values",
    )
    total = values.agg(F.sum("c")).first()[0]
    if not total:
        nothing = [F.lit(None).cast("double").alias(name) for name in quantiles]
        return df.sparkSession.range(1).select(*nothing)
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written, as a second run of the range exchange could cut elsewhere.
    sliced = settle(
        values.repartitionByRange(slices, "x").withColumn("slice", F.spark_partition_id().cast("long")),
        "quantile-slices",
    )
    ranks = {name: q * (total - 1) for name, q in quantiles.items()}
    wanted = sorted({r for at in ranks.values() for r in (math.floor(at), math.ceil(at))})

    running = Window.partitionBy(F.lit(1)).orderBy("slice")
    sizes = sliced.groupBy("slice").agg(F.sum("c").alias("size"))
    offsets = sizes.withColumn("end", F.sum("size").over(running)).withColumn(
        "start", F.col("end") - F.col("size")
    )
    rank = F.explode(F.array(*[F.lit(r).cast("long") for r in wanted])).alias("rank")
    found = (
        offsets.select("slice", "start", "end", rank)
        .where((F.col("start") <= F.col("rank")) & (F.col("rank") < F.col("end")))
    )
    inside = Window.partitionBy("slice").orderBy("x")
    ordered = (
        sliced.join(found.select("slice", "start").distinct(), "slice")
        .withColumn("to", F.col("start") + F.sum("c").over(inside))
        .withColumn("from", F.col("to") - F.col("c"))
    )

    def at_rank(r: int) -> Column:
        return F.max(F.when((F.col("from") <= r) & (F.col("to") > r), F.col("x")))

    columns = []
    for name, at in ranks.items():
        below, above = at_rank(math.floor(at)), at_rank(math.ceil(at))
        columns.append((below + (above - below) * (at - math.floor(at))).alias(name))
    return ordered.agg(*columns)


def mean_and_size(df: DataFrame, group: str, value: Column) -> DataFrame:
    """Mean of non-NaN values and their number, per group."""
    clean = F.when(~F.isnan(value), value)
    return df.groupBy(group).agg(F.avg(clean).alias("mean"), F.count(clean).alias("n"))


def correlation(df: DataFrame, left: Column, right: Column, name: str = "r") -> DataFrame:
    """Pearson correlation over rows where neither value is NaN."""
    return df.where(~F.isnan(left) & ~F.isnan(right)).agg(F.corr(left, right).alias(name))


def total_cost(
    df: DataFrame, prompt_tokens: Column, completion_tokens: Column, by: Sequence[str] = ()
) -> DataFrame:
    """Dollars spent, rounded to 3 places."""
    cost = F.sum(messages.call_cost(prompt_tokens, completion_tokens))
    return df.groupBy(*by).agg(F.round(cost, 3).alias("dollars"))


def audit_languages(
    df: DataFrame, language: str, score: Column, cut: float = fixed.DETECTION_CONFIDENCE
) -> DataFrame:
    """Per language: rows above and below the cut and their shares of all such rows."""
    counts = confidence_counts(df, language, score, cut)
    everything = Window.partitionBy(F.lit(1))
    return counts.select(
        language,
        "n_above",
        "n_below",
        F.try_divide("n_above", F.sum("n_above").over(everything)).alias("share_above"),
        F.try_divide("n_below", F.sum("n_below").over(everything)).alias("share_below"),
    )


def grouped_histogram(df: DataFrame, group: str, value: Column, bins: int = 10) -> DataFrame:
    """Equal-width histogram per group over its own range, empty bins included."""
    values = df.select(group, value.cast("double").alias("x")).where(
        F.col("x").isNotNull() & ~F.isnan("x")
    )
    ends = values.groupBy(group).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ranges = settle(
        ends.select(
            group,
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            ((F.when(flat, F.lit(1.0)).otherwise(F.col("hi") - F.col("lo"))) / bins).alias("width"),
        ),
        "histogram-ranges",
    )
    bucket = _bin_of(F.col("x"), F.col("lo"), F.col("width"), bins)
    counts = (
        values.join(ranges, group)
        .groupBy(group, bucket.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
    return frame.join(counts, [group, "bin"], "left").select(
        group,
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
