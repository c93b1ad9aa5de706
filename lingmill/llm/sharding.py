"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

How many rows of each input partition go to each shard is drawn first, exactly as a
uniform permutation of all rows would deal them. Each partition then permutes its own
rows, hands out as many as drawn, and each shard permutes what it has received.
Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingmill.functions.binding import let
from lingmill.session import settle

# Standard deviations on either side of the mode that a draw considers; what lies beyond
# has less than 1e-30 of the probability.
REACH = 12
# Tasks that draw the matrix at most.
MATRIX_TASKS = 1024
# Rows of a shard that one task orders.
SLOT_ROWS = 1 << 17


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 53 bits, fixed by the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0**-53)


def hypergeometric(draws: Column, good: Column, total: Column, u: Column) -> Column:
    """How many of ``draws`` items out of ``total`` are among the ``good`` ones.

    Inverts ``u`` over the counts in the order mode, mode + 1, ..., then mode - 1 and
    down. Weights are relative to the mode's, so none overflows.
    """
    n, k, all_ = draws.cast("double"), good.cast("double"), total.cast("double")
    least = F.greatest(F.lit(0.0), n + k - all_)
    most = F.least(n, k)
    mode = F.least(most, F.greatest(least, F.floor((n + 1) * (k + 1) / (all_ + 2)).cast("double")))
    spread = F.sqrt(n * k / all_ * (1 - k / all_) * (all_ - n) / F.greatest(all_ - 1, F.lit(1.0)))
    return let(
        F.struct(
            n.alias("n"), k.alias("k"), all_.alias("all"), mode.alias("mode"), u.alias("u"),
            F.greatest(least, mode - F.ceil(spread * REACH) - REACH).alias("low"),
            F.least(most, mode + F.ceil(spread * REACH) + REACH).alias("high"),
        ),
        lambda s: _invert(s),
    )


def _steps(a: Column, b: Column) -> Column:
    """a, ..., b rising or falling; empty if a > b."""
    return F.when(a <= b, F.sequence(a.cast("long"), b.cast("long"))).otherwise(F.array().cast("array<long>"))


def _invert(s: Column) -> Column:
    def up(x: Column) -> Column:  # weight of x + 1 over that of x
        return (s["k"] - x) * (s["n"] - x) / ((x + 1) * (s["all"] - s["k"] - s["n"] + x + 1))

    rise = _steps(s["mode"], s["high"] - 1)
    fall = F.reverse(_steps(s["low"] + 1, s["mode"]))
    one = F.lit(1.0)

    def walk(start: Column, finish: Callable[[Column], Column]) -> Column:
        def after(state: Column, ratio: Column, value: Column) -> Column:
            weight = state["weight"] * ratio
            left = state["left"] - weight
            return F.struct(
                weight.alias("weight"), left.alias("left"),
                F.when(state["found"].isNull() & (left < 0), value).otherwise(state["found"]).alias("found"),
            )

        first = F.struct(
            one.alias("weight"), (start - 1).alias("left"),
            F.when(start - 1 < 0, s["mode"]).alias("found"),
        )
        risen = F.aggregate(
            rise, first, lambda t, x: after(t, up(x.cast("double")), x.cast("double") + 1)
        )
        turned = let(risen, lambda t: F.struct(one.alias("weight"), t["left"].alias("left"), t["found"].alias("found")))
        return F.aggregate(
            fall, turned, lambda t, x: after(t, 1 / up(x.cast("double") - 1), x.cast("double") - 1), finish
        )

    # With nothing to use up, what is left over is minus the sum of all weights.
    weights = walk(F.lit(0.0), lambda t: -t["left"])
    found = walk(s["u"] * weights, lambda t: F.coalesce(t["found"], s["mode"]))
    return found.cast("long")


def deal(draws: Column, room: Column, seeds: Callable[[Column], Column]) -> Column:
    """How many of ``draws`` rows go to each shard, of which ``room`` holds the free places."""
    total = F.aggregate(room, F.lit(0).cast("long"), lambda a, x: a + x)
    start = F.struct(
        draws.cast("long").alias("draws"), total.alias("total"), F.array().cast("array<long>").alias("out")
    )

    def step(state: Column, free: Column) -> Column:
        return let(
            hypergeometric(state["draws"], free, state["total"], seeds(F.size(state["out"]))),
            lambda x: F.struct(
                (state["draws"] - x).alias("draws"), (state["total"] - free).alias("total"),
                F.concat(state["out"], F.array(x)).alias("out"),
            ),
        )

    # A shard without room, or nothing left to deal: zero, with no division by nothing left.
    def guarded(state: Column, free: Column) -> Column:
        none = (state["draws"] == 0) | (free == 0)
        skip = F.struct(
            state["draws"].alias("draws"), (state["total"] - free).alias("total"),
            F.concat(state["out"], F.array(F.lit(0).cast("long"))).alias("out"),
        )
        return F.when(none, skip).otherwise(step(state, free))

    return F.aggregate(room, start, guarded, lambda t: t["out"])


def communication_matrix(sizes: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, counts array<long>): rows from each part to each shard.

    ``sizes`` has (part, n), one row per input partition. The parts are halved again and
    again: each half draws its share of every shard's places from what both have, and
    the halves go on side by side. Every few steps they are written, spread over as many
    tasks as there are halves, up to ``MATRIX_TASKS``; the first steps are one task's.
    """
    ordered = sizes.agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("parts"), F.sum("n").alias("rows"))
    room = F.array(*[F.floor(F.col("rows") / shards) + F.when(F.col("rows") % shards > j, 1).otherwise(0) for j in range(shards)])
    nodes = settle(ordered.where("rows > 0").select("parts", room.cast("array<long>").alias("room")), "matrix")
    parts = sizes.count()
    for level in range(math.ceil(math.log2(parts)) if parts > 1 else 0):
        half = F.floor((F.size("parts") + 1) / 2).cast("int")
        left = F.slice("parts", F.lit(1), half)
        draws = F.aggregate(left, F.lit(0).cast("long"), lambda a, p: a + p["n"])
        first = F.col("parts")[0]["part"]
        counts = deal(draws, F.col("room"), lambda j: uniform(F.lit(seed), F.lit(level), first, j))
        split = let(counts, lambda c: F.array(
            F.struct(left.alias("parts"), c.alias("room")),
            F.struct(
                F.slice("parts", half + 1, F.greatest(F.size("parts") - half, F.lit(1))).alias("parts"),
                F.zip_with("room", c, lambda a, b: a - b).alias("room"),
            ),
        ))
        same = F.array(F.struct(F.col("parts"), F.col("room")))
        nodes = nodes.select(F.explode(F.when(F.size("parts") > 1, split).otherwise(same)).alias("node")).select("node.*")
        if level % 4 == 3:
            # A number of its own, which adaptive execution leaves as it is.
            spread = nodes.repartition(min(2 ** (level + 1), MATRIX_TASKS), F.col("parts")[0]["part"])
            nodes = settle(spread, "matrix")
    return nodes.select(F.col("parts")[0]["part"].alias("part"), F.col("room").alias("counts"))


def shuffle_into_shards(rows: DataFrame, shards: int, seed: int = 42) -> DataFrame:
    """``rows`` with a shard in [0, shards) and a slot in it, gapless from 0.

    Shard sizes differ by one at most, and every arrangement is equally likely. Pass
    narrow rows: they are written once with their input partition and their place in it,
    which fixes the draw should an executor be lost, and exchanged twice. Rows may repeat
    and hold nulls; keys play no part, so no value is a hot key. Fewer rows than shards
    leave the last shards empty; an empty table gives an empty one. Added columns:
    ``shard`` and ``slot``, which the input must not have.
    """
    names = rows.columns
    placed = settle(
        rows.withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()}), "placed"
    )
    sizes = settle(placed.groupBy(F.col("__part").alias("part")).agg(F.count(F.lit(1)).alias("n")), "part-sizes")
    matrix = communication_matrix(sizes, shards, seed)
    ends = settle(matrix.select(
        F.col("part").alias("__part"),
        F.aggregate(
            "counts", F.array().cast("array<long>"),
            lambda a, x: F.concat(a, F.array(x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)))),
        ).alias("__ends"),
    ), "matrix")
    permuted = Window.partitionBy("__part").orderBy(F.xxhash64(F.lit(seed), F.lit("deal"), "__place"), "__place")
    dealt = placed.withColumn("__rank", F.row_number().over(permuted)).join(ends, "__part").withColumn(
        "shard", F.size(F.filter("__ends", lambda e: e < F.col("__rank"))).cast("int")
    )
    order = F.xxhash64(F.lit(seed), F.lit("slot"), "__place")
    total = placed.count()
    groups = max(1, -(-total // (shards * SLOT_ROWS)))
    # The high bits of a uniform hash cut a shard into even runs of its final order.
    group = F.floor(F.shiftrightunsigned(order, 32).cast("double") * (groups / 2.0**32)).cast("int")
    received = settle(dealt.select(*names, "shard", order.alias("__order"), "__place", group.alias("__group")), "received")
    counts = received.groupBy("shard", "__group").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(
        counts.select("shard", "__group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start")), "starts"
    )
    within = Window.partitionBy("shard", "__group").orderBy("__order", "__place")
    return received.withColumn("__rank", F.row_number().over(within)).join(starts, ["shard", "__group"]).select(
        *names, "shard", (F.col("__start") + F.col("__rank") - 1).alias("slot")
    )
