"""Exact and near-duplicate removal."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingmill import fixed
from lingmill.operators import filters, vectors
from lingmill.session import settle

# Rows of one similarity block, and the tile of it multiplied at a time.
BLOCK_ROWS = 8_192
TILE_ROWS = 1_024
# Rows of a group, at most, whose angles to all others help to skip pairs of blocks.
PIVOTS = 16
SLACK = 1e-6


def drop_exact_duplicates(df: DataFrame, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the first row in ``order_by`` order of every distinct value.

    Spark keeps one row per value in each map task before it shuffles, so a
    value shared by a third of all rows does not pile up. Null counts as a value.
    Strings are compared by their SHA-256, which is narrower to sort and exchange.
    """
    kinds = dict(df.dtypes)
    keys = [F.sha2(F.col(c).cast("binary"), 256) if kinds.get(c) == "string" else F.col(c) for c in columns]
    place = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")


def distinct_vectors(rows: DataFrame, pivots: DataFrame, orders: list[str]) -> DataFrame:
    """Every different vector of a group once: ``_group, _vid, _vec, _first, _copied, _norm,
    _angles, _home, _shell``.

    ``_first`` is the smallest order among its rows, ``_copied`` whether it has several, ``_angles``
    those to the group's pivots, ``_home`` the nearest pivot and ``_shell`` the whole
    degrees to it. A vector is known by 128 bits of hash.
    """
    order = F.struct(*orders)
    distinct = rows.groupBy("_group", "_vid").agg(
        F.first("_vec").alias("_vec"), F.min(order).alias("_first"), (F.count(F.lit(1)) > 1).alias("_copied")
    )
    schema = T.StructType([
        *distinct.schema.fields, T.StructField("_norm", T.DoubleType()), T.StructField("_angles", T.ArrayType(T.DoubleType())),
        T.StructField("_home", T.IntegerType()), T.StructField("_shell", T.IntegerType()),
    ])

    def work(batches: Iterator[pa.RecordBatch], known: vectors.Known) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms = np.zeros(batch.num_rows)
            angles = np.zeros((batch.num_rows, PIVOTS))
            home = np.zeros(batch.num_rows, dtype=np.int32)
            for name, here in vectors.by_group(batch, "_group", known):
                _, centers = known[name]
                own = vectors.matrix(batch.column("_vec").take(pa.array(here)))
                norms[here] = np.linalg.norm(own, axis=1)
                scale = np.linalg.norm(centers, axis=1)[None, :] * norms[here, None]
                found = np.arccos(np.clip(np.divide(own @ centers.T, scale, out=np.zeros_like(scale), where=scale > 0), -1, 1))
                # A small group may have fewer pivots.
                angles[here, : found.shape[1]] = found
                home[here] = found.argmin(axis=1)
            shell = np.degrees(angles[np.arange(len(home)), home]).astype(np.int32)
            columns = [*batch.columns, pa.array(norms), pa.array(list(angles), pa.list_(pa.float64())), pa.array(home), pa.array(shell)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return vectors.against_centers(distinct, pivots, "_group", work, schema, "distinct-vectors", vectors.BLOCK_BYTES)


def blocks_of(distinct: DataFrame, block_rows: int) -> DataFrame:
    """``distinct`` with ``_block``: runs of shells, pivot by pivot, of about ``block_rows`` vectors;
    a shell of more vectors is split by their digests."""
    shells = distinct.groupBy("_group", "_home", "_shell").agg(F.count(F.lit(1)).alias("_n"))
    inward = Window.partitionBy("_group").orderBy("_home", "_shell")
    before = F.coalesce(F.sum("_n").over(inward.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = shells.select(
        "_group", "_home", "_shell", F.floor(before / block_rows).alias("_from"),
        F.greatest(F.ceil(F.col("_n") / block_rows), F.lit(1)).alias("_parts"),
    )
    part = F.pmod(F.xxhash64("_vid"), F.col("_parts"))
    block = F.concat_ws(".", F.col("_from").cast("string"), part.cast("string"))
    return distinct.join(settle(cuts, "shell-cuts"), ["_group", "_home", "_shell"]).withColumn("_block", block).drop("_from", "_parts")


def block_pairs(blocked: DataFrame, threshold: float) -> DataFrame:
    """``_group, _a, _b, _size_a, _size_b, _near``: the pairs of a group's blocks, a block with itself
    included, and whether two of their vectors can be above the threshold.

    The angle between vectors is at least the difference of their angles to any pivot,
    and their product at most the product of their norms times its cosine.
    """
    blocks = blocked.groupBy("_group", "_block").agg(
        F.count(F.lit(1)).alias("_size"), F.max("_norm").alias("_norm"),
        F.array(*[F.min(F.col("_angles")[p]) for p in range(PIVOTS)]).alias("_low"),
        F.array(*[F.max(F.col("_angles")[p]) for p in range(PIVOTS)]).alias("_high"),
    )
    a, b = (blocks.select("_group", *(F.col(c).alias(f"{c}_{side}") for c in ("_block", "_size", "_norm", "_low", "_high"))) for side in "ab")
    apart = F.greatest(*[
        F.greatest(F.col("_low_a")[p] - F.col("_high_b")[p], F.col("_low_b")[p] - F.col("_high_a")[p]) for p in range(PIVOTS)
    ])
    # Rounding of angles and products must not lose a pair.
    bound = F.col("_norm_a") * F.col("_norm_b") * F.cos(F.greatest(apart - SLACK, F.lit(0.0))) * (1 + SLACK)
    near = (F.col("_block_a") == F.col("_block_b")) | (bound + SLACK >= threshold)
    return a.join(b, "_group").where(F.col("_block_a") <= F.col("_block_b")).select(
        "_group", F.col("_block_a").alias("_a"), F.col("_block_b").alias("_b"), "_size_a", "_size_b", near.alias("_near")
    )


def earliest_matches(
    vectors_a: np.ndarray, vectors_b: np.ndarray, rank_a: np.ndarray, rank_b: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """For the vectors of two blocks, the smallest rank of a match in the other; -1 for none.

    No match has the rank of the vector itself.
    """
    none = np.iinfo(np.int64).max
    best_a, best_b = np.full(len(vectors_a), none), np.full(len(vectors_b), none)
    for i in range(0, len(vectors_a), TILE_ROWS):
        rows = slice(i, i + TILE_ROWS)
        hit = (vectors_a[rows] @ vectors_b.T > threshold) & (rank_a[rows, None] != rank_b[None, :])
        at_a, at_b = np.nonzero(hit)
        np.minimum.at(best_a, at_a + i, rank_b[at_b])
        np.minimum.at(best_b, at_b, rank_a[rows][at_a])
    return np.where(best_a == none, -1, best_a), np.where(best_b == none, -1, best_b)


def _prepared(
    df: DataFrame, key: str, group: str, vector: str, order_by: Sequence[str], threshold: float, block_rows: int
) -> tuple[DataFrame, list[str], DataFrame, DataFrame]:
    """(rows, names of their order, vectors with their blocks, pairs of blocks)."""
    orders = [f"_o{i}" for i in range(len(order_by))]
    rows = df.where(F.col(vector).isNotNull() & F.col(group).isNotNull()).select(
        F.col(key).alias("_key"), F.col(group).alias("_group"), F.col(vector).alias("_vec"),
        F.concat_ws(":", F.xxhash64(vector), F.xxhash64(F.lit(1), F.col(vector))).alias("_vid"), *(F.col(c).alias(o) for c, o in zip(order_by, orders)),
    )
    # A row of each of so many parts of a group; a task hands on one each.
    part = F.pmod(F.xxhash64("_vid"), F.lit(PIVOTS)).alias("label")
    pivots = settle(rows.groupBy("_group", part).agg(F.min_by("_vec", "_vid").alias("center")), "pivots")
    blocked = blocks_of(distinct_vectors(rows, pivots, orders), block_rows)
    return rows, orders, blocked, block_pairs(blocked, threshold)


def near_duplicate_keys(
    df: DataFrame,
    key: str,
    group: str,
    vector: str,
    order_by: Sequence[str],
    threshold: float = fixed.NEAR_DUPLICATE_DOT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Keys of rows with an earlier row of their group above the dot-product threshold.

    Earlier rows count even when they are removed themselves. ``order_by`` must
    order a group totally. Rows without a vector or group are never removed.

    Exact for any group size. Equal vectors are compared once, so a mass of copies costs no
    more than its count. The rest lie in blocks of about ``block_rows`` around pivots, and
    pairs of blocks whose vectors cannot reach the threshold are skipped
    (``near_duplicate_pruning`` counts them); each other pair is one matrix product in one
    task. A vector is sent once for each block that its own is compared with. Similar pairs are never emitted.
    """
    rows, orders, blocked, pairs = _prepared(df, key, group, vector, order_by, threshold, block_rows)
    near = settle(pairs.where("_near").select("_group", "_a", "_b"), "block-pairs")
    sides = near.select("_group", "_a", "_b", F.explode(F.array_distinct(F.array("_a", "_b"))).alias("_block"))
    paired = blocked.select("_group", "_block", "_vid", "_vec", "_copied", F.col("_first.*")).join(sides, ["_group", "_block"])
    schema = T.StructType([
        paired.schema["_group"], T.StructField("_vid", T.StringType()), *(paired.schema[o] for o in orders),
    ])

    def compare(table: pa.Table) -> pa.Table:
        ordered = table.select(orders).to_pandas().sort_values(orders, kind="stable")
        rank = np.empty(len(ordered), dtype=np.int64)
        rank[ordered.index.to_numpy()] = np.arange(len(ordered))
        own = vectors.matrix(table["_vec"])
        in_a = pc.equal(table["_block"], table["_a"]).to_numpy()
        best = np.full(len(rank), -1, dtype=np.int64)
        if in_a.all():
            # A block against itself: every vector is on both sides.
            best, _ = earliest_matches(own, own, rank, rank, threshold)
        else:
            a, b = np.flatnonzero(in_a), np.flatnonzero(~in_a)
            best[a], best[b] = earliest_matches(own[a], own[b], rank[a], rank[b], threshold)
        # A later match counts only for copies that may be later still.
        tell = np.flatnonzero((best >= 0) & ((best < rank) | table["_copied"].to_numpy()))
        row_of = np.argsort(rank)
        match = table.select(orders).take(pa.array(row_of[best[tell]]))
        return pa.Table.from_arrays([*table.select(["_group", "_vid"]).take(pa.array(tell)).columns, *match.columns], schema.names)

    matches = paired.groupBy("_group", "_a", "_b").applyInArrow(compare, schema)
    # Copies of a vector match its first row, if it is long enough.
    alike = blocked.where(F.col("_copied") & (F.col("_norm") * F.col("_norm") > threshold)).select("_group", "_vid", "_first.*")
    earliest = settle(
        matches.unionByName(alike).groupBy("_group", "_vid").agg(F.min(F.struct(*orders)).alias("_earliest")), "earliest-matches"
    )
    return rows.drop("_vec").join(earliest, ["_group", "_vid"]).where(F.struct(*orders) > F.col("_earliest")).select(F.col("_key").alias(key))


def near_duplicate_pruning(
    df: DataFrame,
    key: str,
    group: str,
    vector: str,
    order_by: Sequence[str],
    threshold: float = fixed.NEAR_DUPLICATE_DOT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """What ``near_duplicate_keys`` compares, per group: ``n_vectors`` different ones, ``n_blocks``,
    pairs of vectors in all and in blocks that are skipped, and how often a vector is sent."""
    *_, pairs = _prepared(df, key, group, vector, order_by, threshold, block_rows)
    own = F.col("_a") == F.col("_b")
    work = F.when(own, F.col("_size_a") * (F.col("_size_a") - 1) / 2).otherwise(F.col("_size_a") * F.col("_size_b"))
    sent = F.when(F.col("_near"), F.when(own, F.col("_size_a")).otherwise(F.col("_size_a") + F.col("_size_b"))).otherwise(0)
    counted = pairs.groupBy(F.col("_group").alias(group)).agg(
        F.sum(F.when(own, F.col("_size_a"))).alias("n_vectors"), F.sum(own.cast("long")).alias("n_blocks"),
        F.sum(work).cast("long").alias("n_pairs"), F.sum(F.when(~F.col("_near"), work).otherwise(0)).cast("long").alias("n_skipped"),
        F.sum(sent).alias("_sent"),
    )
    return counted.withColumn("copies_sent", F.col("_sent") / F.col("n_vectors")).drop("_sent")


def drop_near_duplicates(
    df: DataFrame,
    key: str,
    group: str,
    vector: str,
    order_by: Sequence[str],
    threshold: float = fixed.NEAR_DUPLICATE_DOT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``df`` without its near duplicates (see ``near_duplicate_keys``)."""
    removed = near_duplicate_keys(df, key, group, vector, order_by, threshold, block_rows)
    # Written first: with its true size a small set is broadcast and vectors stay in place.
    return df.join(settle(removed, "removed-keys"), key, "left_anti")


def dedup_prompts(
    df: DataFrame,
    key: str,
    language: str,
    prompt: str,
    vector: str,
    threshold: float = fixed.NEAR_DUPLICATE_DOT,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Near duplicates within a language, then equal prompts across languages
    (first by language, then ``order_by``, by default the key), then rows with any null."""
    order = list(order_by or [key])
    distinct = drop_near_duplicates(df, key, language, vector, order, threshold)
    return filters.drop_incomplete_rows(drop_exact_duplicates(distinct, [prompt], [language, *order]))
