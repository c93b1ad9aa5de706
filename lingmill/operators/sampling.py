"""Repeatable sampling, shuffling, slicing and replication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import draws, text
from lingmill.session import settle

# Standard deviations by which a sample's threshold exceeds what is needed on average, and by
# how much it grows for groups that still fall short.
SLACK = 6.0
WIDER = 4.0


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def sample_per_group(
    df: DataFrame,
    groups: Sequence[str],
    key: Sequence[str],
    n: int,
    seed: int | str = 0,
    rank: str | None = None,
) -> DataFrame:
    """min(n, group size) rows of every group, those of smallest hash of ``key``.

    Rows with a null group are left out. ``rank`` names a column for the row's
    place (from 1) in its group's random order.

    Groups are counted; the share of a group that has ``n`` rows, and some more, gives a
    threshold for its hashes, and rows beyond it are neither exchanged nor kept. Groups in
    which fewer than min(n, size) are below theirs, which is very rare, are looked at again
    with a higher one. So about ``n`` rows of a group meet in one task, however large it is.
    """
    keyed = df.where(_no_nulls(groups)).withColumn("_order", draws.order_hash(_columns(key), seed))
    at = F.conv(F.substring("_order", 1, 13), 16, 10).cast("double") / float(1 << 52)
    ample = n + SLACK * (n**0.5 + SLACK)
    sizes = keyed.groupBy(*groups).agg(F.count(F.lit(1)).alias("_size"))
    wanted = settle(sizes.withColumn("_share", F.lit(float(ample)) / F.col("_size")), "group-sizes")
    kept = []
    while True:
        below = keyed.join(wanted.select(*groups, "_share"), list(groups)).where(at < F.col("_share")).drop("_share")
        found = settle(below, "sample")
        counts = found.groupBy(*groups).agg(F.count(F.lit(1)).alias("_found"))
        few = F.coalesce("_found", F.lit(0)) < F.least(F.lit(n), F.col("_size"))
        short = wanted.join(counts, list(groups), "left").where(few)
        if short.isEmpty():
            kept.append(found)
            break
        wanted = settle(short.select(*groups, "_size", (F.col("_share") * WIDER).alias("_share")), "short-groups")
        kept.append(found.join(wanted.select(*groups), list(groups), "left_anti"))
    place = Window.partitionBy(*groups).orderBy("_order", *key)
    ranked = reduce(DataFrame.unionByName, kept).withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= n)
    ranked = ranked.select(*df.columns, "_place")
    return ranked.withColumnRenamed("_place", rank) if rank else ranked.drop("_place")


def _no_nulls(names: Sequence[str]) -> Column:
    ok = F.lit(True)
    for name in names:
        ok = ok & F.col(name).isNotNull()
    return ok


def numbered(df: DataFrame, order_by: Sequence[str], name: str = "row_index") -> DataFrame:
    """Number rows from 0 in ``order_by`` order (which must be unique); for narrow rows.

    Range-partitions and sorts once, writes that out, and adds each partition's
    offset; no task sees more than one range.
    """
    ranged = (
        df.repartitionByRange(*_columns(order_by))
        .sortWithinPartitions(*_columns(order_by))
        .withColumn("_at", F.monotonically_increasing_id())
    )
    stored = settle(ranged, "row-index").withColumn("_part", F.shiftright("_at", 33))
    # One row per partition of the range shuffle.
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = (
        Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = settle(
        sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")),
        "row-offsets",
    )
    inside = F.col("_at").bitwiseAND((1 << 33) - 1)
    return (
        stored.join(offsets, "_part")
        .withColumn(name, (F.col("_offset") + inside).cast("long"))
        .drop("_at", "_part", "_offset")
    )


def with_row_index(df: DataFrame, order_by: Sequence[str], name: str = "row_index") -> DataFrame:
    """Number rows from 0 in ``order_by`` order, which must be unique; nulls come first.

    Only the columns of the order are sorted and written; the rows meet their numbers by them.
    """
    keys = [f"_k{i}" for i in range(len(order_by))]
    narrow = df.select(*(F.col(c).alias(k) for c, k in zip(order_by, keys)))
    numbers = settle(numbered(narrow, keys, name), "row-numbers")
    same = [df[c].eqNullSafe(numbers[k]) for c, k in zip(order_by, keys)]
    return df.join(numbers, same).drop(*keys)


def with_chunks(
    df: DataFrame, order_by: Sequence[str], size: int, digits: int = 6, shift: int = 0, index: str | None = None
) -> DataFrame:
    """Add ``chunk_id``: the zero-padded index of the chunk's first row plus ``shift``.

    ``index`` names a column for the row's own index, if wanted.
    """
    start = F.col("_index") - F.pmod(F.col("_index"), F.lit(size)) + F.lit(shift)
    chunked = with_row_index(df, order_by, "_index").withColumn("chunk_id", text.zero_padded(start, digits))
    return chunked.withColumnRenamed("_index", index) if index else chunked.drop("_index")


def not_done(df: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    """Resume: rows whose key has no result yet."""
    return df.join(done.select(*key).distinct(), list(key), "left_anti")


def full_shuffle(df: DataFrame, key: Sequence[str], seed: int | str = 0) -> DataFrame:
    """All rows in a repeatable random order."""
    return df.orderBy(draws.order_hash(_columns(key), seed), *key)


def scatter(df: DataFrame, key: Sequence[str], partitions: int) -> DataFrame:
    """Spread rows over partitions regardless of how their source was laid out."""
    return df.repartition(partitions, *_columns(key))


def peek(df: DataFrame, key: Sequence[str], seed: int | str = 0, rows: int = 1) -> DataFrame:
    """A few random rows, for looking at."""
    return full_shuffle(df, key, seed).limit(rows)


def replicate(df: DataFrame, times: int = fixed.REQUESTS_PER_LANGUAGE, name: str = "repeat_id") -> DataFrame:
    """Each row ``times`` times, numbered from 1."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(times))))


def draw_prompt_type(key: Sequence[str], seed: int | str = 0) -> Column:
    """"command" or "question", evenly."""
    return F.when(draws.coin(_columns(key), f"type-{seed}"), "command").otherwise("question")


def draw_prompt_category(prompt_type: Column, key: Sequence[str], seed: int | str = 0) -> Column:
    """One of seven categories for the row's prompt type."""
    tag = f"category-{seed}"
    return F.when(
        prompt_type == "question", draws.pick(fixed.QUESTION_CATEGORIES, _columns(key), tag)
    ).otherwise(draws.pick(fixed.COMMAND_CATEGORIES, _columns(key), tag))


def shuffled(items: Column, key: Sequence[Column], seed: int | str = 0) -> Column:
    """An array in an order drawn from the key and each item."""
    tagged = F.transform(
        items, lambda m: F.struct(draws.order_hash([*key, m], seed).alias("h"), m.alias("m"))
    )
    return F.transform(F.array_sort(tagged), lambda s: s["m"])


def sample_items(items: Column, n: int, key: Sequence[Column], seed: int | str = 0) -> Column:
    """``n`` items of an array without repeats, drawn anew for each key."""
    return F.slice(shuffled(items, key, seed), 1, n)
