"""Mini-batch k-means for all languages in one job, seeded by k-means||."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingmill import fixed
from lingmill.functions import draws
from lingmill.operators import sampling
from lingmill.operators.vectors import BLOCK_BYTES, Known, against_centers, by_group, matrix, nearest
from lingmill.session import settle

# Rounds of seeding, and rows that a round is expected to draw, as a multiple of k.
SEED_ROUNDS = 2
OVERSAMPLING = 2
# Centres with less than this share of their group's largest weight are starved.
STARVED_SHARE = 0.01

def assign_clusters(
    df: DataFrame, centroids: DataFrame, key: str, group: str, vector: str, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Rows of groups that have centroids, without their vector, with the nearest one's ``label``
    and ``gap``, the squared distance to it. Rows without a vector have no nearest centroid
    and are left out. The result is a written table; vectors stay where they are.
    """
    rest = [c for c in df.columns if c != vector]
    schema = T.StructType([*(df.schema[c] for c in rest), T.StructField("label", T.LongType()), T.StructField("gap", T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch], known: Known) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.full(batch.num_rows, -1, dtype=np.int64)
            gaps = np.zeros(batch.num_rows)
            met = np.zeros(batch.num_rows, dtype=bool)
            for name, rows in by_group(batch, group, known):
                ids, centers = known[name]
                found, gaps[rows] = nearest(matrix(batch.column(vector).take(pa.array(rows))), centers)
                labels[rows], met[rows] = ids[found], True
            kept = batch.select(rest).append_column("label", pa.array(labels)).append_column("gap", pa.array(gaps))
            yield kept.filter(pa.array(met))

    return against_centers(df.where(F.col(vector).isNotNull()), centroids, group, work, schema, "assigned", block_bytes)


def sums_per_center(df: DataFrame, centroids: DataFrame, group: str, vector: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``group, label, total, n``: the vectors nearest each centre added up, and their number.

    A task hands on one row for each centre that its rows meet; no vector leaves it.
    """
    schema = T.StructType([
        df.schema[group], T.StructField("label", T.LongType()), T.StructField("total", T.ArrayType(T.DoubleType())),
        T.StructField("n", T.LongType()),
    ])

    def work(batches: Iterator[pa.RecordBatch], known: Known) -> Iterator[pa.RecordBatch]:
        totals: dict[object, np.ndarray] = {}
        counts: dict[object, np.ndarray] = {}
        kind = None
        for batch in batches:
            kind = batch.schema.field(group).type
            for name, rows in by_group(batch, group, known):
                _, centers = known[name]
                vectors = matrix(batch.column(vector).take(pa.array(rows)))
                found, _ = nearest(vectors, centers)
                if name not in totals:
                    totals[name], counts[name] = np.zeros_like(centers), np.zeros(len(centers), dtype=np.int64)
                order = np.argsort(found, kind="stable")
                heads = np.flatnonzero(np.diff(found[order], prepend=-1))
                totals[name][found[order][heads]] += np.add.reduceat(vectors[order], heads, axis=0)
                counts[name] += np.bincount(found, minlength=len(centers))
        for name, total in totals.items():
            met = np.flatnonzero(counts[name])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(met), kind), pa.array(known[name][0][met]),
                    pa.array(list(total[met]), pa.list_(pa.float64())), pa.array(counts[name][met]),
                ],
                schema.names,
            )

    parts = against_centers(df.where(F.col(vector).isNotNull()), centroids, group, work, schema, "center-sums", block_bytes)
    return parts.groupBy(group, "label").agg(
        vector_to_array(Summarizer.sum(array_to_vector(F.col("total")))).alias("total"), F.sum("n").alias("n")
    )


def draw_candidates(df: DataFrame, key: str, group: str, vector: str, k: int, seed: int, rounds: int = SEED_ROUNDS) -> DataFrame:
    """``key, group, label, center``: rows to choose centres from, by k-means||.

    One row of each group is drawn by hash. Each round then draws every row on its own, with
    probability ``OVERSAMPLING * k`` times its share of the squared distances of its group's
    rows to what was drawn before. Groups that come out with fewer than k get k more by hash.
    """
    rows = df.select(key, group, F.col(vector).cast("array<double>").alias("center"))
    place = F.struct(draws.order_hash([F.col(key)], f"center-{seed}"), F.col(key))
    drawn = rows.groupBy(group).agg(F.min_by(F.struct(key, "center"), place).alias("_row")).select("_row.*", group)
    candidates = settle(drawn.withColumn("label", F.lit(0).cast("long")).select(key, group, "center", "label"), "candidates")

    def numbered(keys: DataFrame, start: int) -> DataFrame:
        # About OVERSAMPLING * k rows of a group.
        place = F.row_number().over(Window.partitionBy(group).orderBy(key))
        found = rows.join(settle(keys, "drawn-keys"), key, "left_semi")
        return settle(found.withColumn("label", place.cast("long") + start), "candidates")

    for number in range(rounds):
        gaps = assign_clusters(rows, candidates, key, group, "center")
        sums = gaps.groupBy(group).agg((F.sum("gap") / (OVERSAMPLING * k)).alias("_unit"))
        chance = draws.uniform([F.col(key)], f"round-{number}-{seed}") * F.col("_unit")
        keys = gaps.join(sums, group).where(chance < F.col("gap")).select(key)
        candidates = candidates.unionByName(numbered(keys, (number + 1) << 40))
    short = candidates.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < k).select(group)
    if short.isEmpty():
        return candidates
    lacking = rows.select(key, group).join(settle(short, "short-groups"), group, "left_semi")
    extra = sampling.sample_per_group(lacking, [group], [key], k, f"center-{seed}").join(candidates.select(key), key, "left_anti")
    return candidates.unionByName(numbered(extra.select(key), (rounds + 1) << 40))


def chosen_centers(vectors: np.ndarray, weights: np.ndarray, waits: np.ndarray, k: int) -> list[int]:
    """Row numbers of up to ``k`` different vectors, by weighted k-means++.

    The next is the one whose exponential waiting time, at a rate of its weight
    times its squared distance from those chosen, is over first.
    """
    rate = weights.astype(np.float64)
    gaps = np.full(len(vectors), np.inf)
    chosen: list[int] = []
    while len(chosen) < min(k, len(vectors)):
        with np.errstate(divide="ignore"):
            times = np.where(rate > 0, waits / rate, np.inf)
        best = int(np.argmin(times))
        if not np.isfinite(times[best]):
            break
        chosen.append(best)
        gaps = np.minimum(gaps, ((vectors - vectors[best]) ** 2).sum(axis=1))
        rate = weights * gaps
    return chosen


def initial_centroids(df: DataFrame, key: str, group: str, vector: str, k: int, seed: int) -> DataFrame:
    """``group, label, center``: k centres of every group, by k-means|| and weighted k-means++.

    Candidates are weighted by the rows nearest them, and reduced to k in one task a
    group, which holds about ``SEED_ROUNDS * OVERSAMPLING * k`` of them. A group of fewer
    than k different vectors gets one centre each.
    """
    candidates = draw_candidates(df, key, group, vector, k, seed)
    weighted = candidates.join(settle(sums_per_center(df, candidates, group, vector).select(group, "label", "n"), "candidate-weights"), [group, "label"])
    wait = -F.log(draws.uniform([F.col(key)], f"wait-{seed}"))
    schema = T.StructType([df.schema[group], T.StructField("label", T.LongType()), T.StructField("center", T.ArrayType(T.DoubleType()))])

    def reduce_group(table: pa.Table) -> pa.Table:
        table = table.sort_by("label")
        rows = chosen_centers(matrix(table["center"]), table["n"].to_numpy(), table["wait"].to_numpy(), k)
        return table.take(pa.array(rows)).select([group, "center"]).add_column(1, "label", pa.array(np.arange(len(rows))))

    return weighted.select(group, "label", "center", "n", wait.alias("wait")).groupBy(group).applyInArrow(reduce_group, schema)


def replace_starved(rows: DataFrame, centers: DataFrame, key: str, group: str, vector: str, tag: str) -> DataFrame:
    """``centers`` with the starved ones moved to rows of the batch drawn by hash.

    A moved centre gets the smallest weight among those of its group that stay. At most
    half as many centres move as the batch has rows.
    """
    largest = centers.groupBy(group).agg((F.max("weight") * STARVED_SHARE).alias("_bar"))
    marked = centers.join(largest, group).withColumn("_starved", F.col("weight") < F.col("_bar")).drop("_bar")
    short = marked.groupBy(group).agg(
        F.sum(F.col("_starved").cast("int")).alias("_many"), F.min(F.when(~F.col("_starved"), F.col("weight"))).alias("_least")
    ).where(F.col("_many") > 0)
    if short.isEmpty():
        return centers
    short = settle(short, "starved-groups")
    halves = rows.join(short, group, "left_semi").groupBy(group).agg(F.floor(F.count(F.lit(1)) / 2).alias("_half"))
    most = short.agg(F.max("_many")).first()[0]
    drawn = sampling.sample_per_group(rows.select(group, key, vector).join(short.select(group), group, "left_semi"), [group], [key], most, tag, rank="_place")
    starved = sampling.sample_per_group(marked.where("_starved"), [group], ["label"], most, tag, rank="_place")
    starved = starved.join(settle(halves, "half-batches"), group).where(F.col("_place") <= F.col("_half"))
    moved = starved.join(drawn.select(group, "_place", F.col(vector).cast("array<double>").alias("_center")), [group, "_place"]).join(short, group)
    fresh = settle(moved.select(group, "label", "_center", "_least"), "moved-centers")
    return settle(
        centers.join(fresh, [group, "label"], "left").select(
            group, "label", F.coalesce("_center", "center").alias("center"), F.coalesce("_least", "weight").alias("weight")
        ),
        "centroids",
    )


def seeding_rows(usable: DataFrame, first: DataFrame, sizes: DataFrame, group: str, k: int) -> DataFrame:
    """The rows of the first batch; all rows of groups of which it holds fewer than k."""
    held = first.groupBy(group).agg(F.count(F.lit(1)).alias("_held"))
    short = sizes.where("_batches > 0").join(held, group, "left").where(F.coalesce("_held", F.lit(0)) < k).select(group)
    if short.isEmpty():
        return first
    short = settle(short, "short-batches")
    names = first.columns
    return first.join(short, group, "left_anti").select(names).unionByName(usable.join(short, group, "left_semi").select(names))


def fit_clusters(
    df: DataFrame,
    key: str,
    group: str,
    vector: str,
    k: int = fixed.CLUSTERS_PER_LANGUAGE,
    batches: int = 5,
    seed: int = 0,
) -> DataFrame:
    """Centroids per group: ``group, label, center, weight``.

    Rows are dealt by key hash into ``batches`` disjoint batches, fewer for a
    group whose batches would fall below k rows, so each row is used once. The first batch,
    or all rows where it has fewer than k, gives the initial centres (``initial_centroids``). Each batch moves every centre to the running
    mean of the rows assigned to it so far, and then, but for the last one, centres that
    hardly any row is near are moved to rows of the batch (``replace_starved``).
    Groups of fewer than k rows get no centroids; rows without a vector are left out.

    Filling a buffer file by file, and fitting whenever it holds k rows, would leave out what
    remains at the end if it is less than k rows; here no row is left out, and a
    group of k to 2k rows is one batch, whose rows are both the first and the last.
    """
    df = df.where(F.col(vector).isNotNull())
    sizes = settle(
        df.groupBy(group).agg(
            F.least(F.lit(batches), F.floor(F.count(F.lit(1)) / k)).cast("int").alias("_batches")
        ),
        "cluster-batches",
    )
    # Vectors are stored once, a directory per batch, so a round reads only its own.
    usable = settle(
        df.select(key, group, vector)
        .join(sizes.where("_batches > 0"), group)
        .withColumn("_batch", F.pmod(draws.draw_below([F.col(key)], f"batch-{seed}", 1 << 32), F.col("_batches")).cast("int"))
        .drop("_batches"),
        "cluster-rows",
        ["_batch"],
    )
    centers = None
    for batch in range(batches):
        rows = usable.where(F.col("_batch") == batch).select(key, group, vector)
        if centers is None:
            first = seeding_rows(usable, rows, sizes, group, k).select(key, group, vector)
            centers = settle(initial_centroids(first, key, group, vector, k, seed).withColumn("weight", F.lit(0.0)), "centroids")
        moved = sums_per_center(rows, centers, group, vector)
        mean = F.transform("total", lambda x: x / F.col("n"))
        share = F.coalesce(F.col("n") / (F.col("weight") + F.col("n")), F.lit(0.0))
        moved_center = F.zip_with("center", mean, lambda old, new: old + (new - old) * share)
        centers = settle(
            centers.join(moved, [group, "label"], "left").select(
                group,
                "label",
                F.coalesce(moved_center, F.col("center")).alias("center"),
                (F.col("weight") + F.coalesce("n", F.lit(0))).alias("weight"),
            ),
            "centroids",
        )
        if batch < batches - 1:
            centers = replace_starved(rows, centers, key, group, vector, f"starved-{batch}-{seed}")
    return centers


def label_rows(
    df: DataFrame, centroids: DataFrame, key: str, group: str, vector: str, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Every row, without its vector, with a cluster ``label``.

    Rows of groups without centroids are each a cluster of their own, numbered
    from 0 over all such rows in (group, key) order. So are rows without a vector,
    numbered from -1 downwards, which no cluster is.
    """
    assigned = assign_clusters(df, centroids, key, group, vector, block_bytes).drop("gap")
    grouped = settle(centroids.select(group).distinct().withColumn("_grouped", F.lit(True)), "clustered-groups")
    rest = df.withColumn("_blank", F.col(vector).isNull()).drop(vector).join(grouped, group, "left")
    alone = settle(rest.where("_blank or _grouped is null").drop("_grouped"), "unclustered")
    if alone.isEmpty():
        return assigned
    # Rows without a vector come last, so that one numbering serves both.
    numbered = sampling.numbered(alone, ["_blank", group, key], "label")
    given = alone.where("not _blank").count()
    label = F.when(F.col("_blank"), given - 1 - F.col("label")).otherwise(F.col("label"))
    return assigned.unionByName(numbered.withColumn("label", label).drop("_blank"))
