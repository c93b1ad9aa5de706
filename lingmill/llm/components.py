"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingmill.session import settle


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Indices of links that connect anew; the others close a cycle among those before."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kept = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(i)
    return np.array(kept, dtype=np.int64)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of a link; component is any fixed node of it.

    Each round sends a node to whichever of itself and its neighbours has the smallest
    hash, and rewrites the links between those; nodes and links shrink by a constant
    share a round. Nothing is gathered: a node with many neighbours is a partial
    minimum and a join that adaptive execution can split. Every round is a written
    table. Null ends and self links are ignored; an empty table has no rows.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    left = settle(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    moves: list[DataFrame] = []
    while not left.isEmpty():
        place = len(moves)

        def drawn(c: str, place: int = place) -> F.Column:
            return F.struct(F.xxhash64(F.col(c), F.lit(place)).alias("h"), F.col(c).alias("id"))

        both = left.union(left.select("b", "a"))
        move = settle(
            both.groupBy("a").agg(F.min(drawn("b")).alias("near"))
            .select(F.col("a").alias("node"), F.least(drawn("a"), F.col("near"))["id"].alias("to")),
            "moves",
        )
        moves.append(move)
        to_a = move.select(F.col("node").alias("a"), F.col("to").alias("x"))
        to_b = move.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = left.join(to_a, "a").join(to_b, "b").where("x <> y")
        left = settle(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = moves.pop().withColumnRenamed("to", "component")
    while moves:
        further = labels.withColumnRenamed("node", "to")
        labels = moves.pop().join(further, "to", "left").select(
            "node", F.coalesce("component", "to").alias("component")
        )
    return settle(labels, "components")
