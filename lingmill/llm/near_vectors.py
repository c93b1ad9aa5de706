"""Near-duplicate vectors through navigable small-world graphs, one per shard.

Every vector queries the graph of every shard. Two shards are compared in one task, in
both directions, so a link counts for both of its ends or for neither.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingmill.llm import hnsw
from lingmill.llm.components import components
from lingmill.session import settle

THRESHOLD = 0.9
# Shards at least, and bytes of the vectors of one, about.
LEAST_SHARDS = 4
SHARD_BYTES = 256 * 1024 * 1024
FIRST_BEAM = 32
LAST_BEAM = 256
# Queries that an audit also answers by comparing with all vectors of the shard, at first and at
# most; how many of their links tell good from bad, and the share that a beam must find.
AUDIT_QUERIES = 512
MOST_AUDIT_QUERIES = 2048
AUDIT_LINKS = 200
AUDIT_RECALL = 0.98
QUERIES_AT_ONCE = 256
# Cosines that a task holds at a time.
EXACT_CELLS = 1 << 22


def usable(vector: str) -> F.Column:
    """Whether a vector has a direction: no null or non-finite component, not all zero."""
    infinite = F.lit(float("inf")).cast("double")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < infinite))
    return F.coalesce(F.col(vector).isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def link_rows(
    graph: hnsw.Graph, queries: np.ndarray, threshold: float
) -> Iterator[tuple[int, np.ndarray]]:
    """(first query, links with every vector of the shard as booleans) in blocks of bounded size."""
    step = max(1, EXACT_CELLS // max(1, graph.size))
    for at in range(0, len(queries), step):
        yield at, queries[at : at + step] @ graph.vectors.T >= threshold


def beam_pairs(
    graph: hnsw.Graph, queries: np.ndarray, threshold: float, beam: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, node) of the links that a beam finds, and the queries that need more.

    A query with more than half a beam of links may have more than a beam holds, and has
    none of them here: it is to be compared with the whole shard.
    """
    beam = min(beam, graph.size)
    none = np.empty(0, dtype=np.int64)
    left, right, full = [none], [none], [none]
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        rows = queries[at : at + QUERIES_AT_ONCE]
        found, sims = graph.search(rows, beam)
        # Rounding of the graph's single precision; the link itself is checked in double.
        near = (sims >= threshold - 1e-4) & (found < graph.size)
        many = near.sum(axis=1) * 2 > beam
        full.append(at + np.flatnonzero(many))
        a, b = np.nonzero(near & ~many[:, None])
        node = found[a, b]
        real = np.einsum("nd,nd->n", rows[a], graph.vectors[node]) >= threshold
        left.append(at + a[real])
        right.append(node[real])
    return np.concatenate(left), np.concatenate(right), np.concatenate(full)


def audit_sample(graph: hnsw.Graph, queries: np.ndarray, threshold: float, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Queries spread over all, and how many links each has; a query's match with itself is none.

    There are more of them until they have ``AUDIT_LINKS`` links.
    """
    size = AUDIT_QUERIES
    while True:
        sample = np.unique(np.linspace(0, len(queries) - 1, min(size, len(queries))).astype(np.int64))
        true = np.concatenate([near.sum(axis=1) for _, near in link_rows(graph, queries[sample], threshold)]) - own
        if true.sum() >= AUDIT_LINKS or size >= MOST_AUDIT_QUERIES or len(sample) == len(queries):
            return sample, true
        size *= 2


def found_pairs(
    graph: hnsw.Graph, queries: np.ndarray, threshold: float, own: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``beam_pairs`` of the first beam that an audit accepts; without one, every query
    needs the whole shard. ``own`` tells that the queries are the graph's nodes.

    The audit compares a sample's links with those of all vectors. Where links are so rare that
    a sample tells little, a beam is also compared with one twice as wide, over all
    queries: what the wider one found is accepted if the other had found its share of that.
    """

    def links(a: np.ndarray, b: np.ndarray, asked: np.ndarray) -> int:
        apart = b != asked[a] if own else np.ones(len(a), dtype=bool)
        return len(np.unique(a[apart] * graph.size + b[apart]))

    sample, true = audit_sample(graph, queries, threshold, own)
    every = np.arange(len(queries))
    rare = true.sum() < AUDIT_LINKS
    beam, before = FIRST_BEAM, None
    while beam <= LAST_BEAM:
        if rare:
            a, b, full = before or beam_pairs(graph, queries, threshold, beam)
            before = beam_pairs(graph, queries, threshold, 2 * beam)
            there = np.isin(before[0], sample)
            known = links(before[0][there], before[1][there], every) + true[np.isin(sample, before[2])].sum()
            settled = links(a, b, every) >= AUDIT_RECALL * links(*before[:2], every) and len(full) >= len(before[2])
            if settled and known >= AUDIT_RECALL * true.sum():
                return before
        else:
            a, b, full = beam_pairs(graph, queries[sample], threshold, beam)
            if links(a, b, sample) + true[full].sum() >= AUDIT_RECALL * true.sum():
                return beam_pairs(graph, queries, threshold, beam)
        beam *= 2
    none = np.empty(0, dtype=np.int64)
    return none, none, every


class Tally:
    """Links among the nodes of a task, held as a count per node and trees that connect them.

    A dense node has had its whole row compared, so a group of any number of near copies
    takes a block of rows at a time; its pairs are never held.
    """

    def __init__(self, weights: np.ndarray):
        self.weights = weights.astype(np.float64)
        self.links = np.zeros(len(weights))
        self.dense = np.zeros(len(weights), dtype=bool)
        self.parent = np.arange(len(weights))
        none = np.empty(0, dtype=np.int64)
        self.ends: tuple[list[np.ndarray], list[np.ndarray]] = ([none], [none])

    def add_pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs in any order, repeats included; those with a dense end are in its row."""
        apart = (a != b) & ~self.dense[a] & ~self.dense[b]
        size = len(self.links)
        pairs = np.unique(np.minimum(a, b)[apart] * size + np.maximum(a, b)[apart])
        a, b = pairs // max(1, size), pairs % max(1, size)
        self.links += np.bincount(a, self.weights[b], size) + np.bincount(b, self.weights[a], size)
        self.ends[0].append(a)
        self.ends[1].append(b)

    def add_rows(self, rows: np.ndarray, others: np.ndarray, near: np.ndarray) -> None:
        """Dense nodes with all their links among ``others``."""
        near &= rows[:, None] != others
        counted = near.astype(np.float64)
        self.links[rows] += counted @ self.weights[others]
        # A dense node counts its links in its own row.
        self.links[others] += np.where(self.dense[others], 0, self.weights[rows] @ counted)
        for row, linked in zip(rows, near):
            ends = others[linked]
            if len(ends):
                self.join(np.append(ends, row))
        self.parent = self.parent[self.parent]

    def join(self, nodes: np.ndarray) -> None:
        top = self.parent[nodes]
        while ((above := self.parent[top]) != top).any():
            top = above
        low = top.min()
        rest = np.unique(top[top != low])
        self.parent[rest] = low
        self.ends[0].append(np.full(len(rest), low))
        self.ends[1].append(rest)


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, a fixed node of its component) over pairs: labels sink along links and
    jump to their label's label until nothing changes."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        np.minimum.at(low, y, label[x])
        low = low[low]
        if (low == label).all():
            return nodes, nodes[label]
        label = low


def matched(first: hnsw.Graph, second: hnsw.Graph | None, threshold: float) -> pa.RecordBatch:
    """(node, links, root) over one or two shards; one row per node that has a link."""
    graphs = [first] if second is None else [first, second]
    tally = Tally(np.concatenate([graph.weights for graph in graphs]))
    numbers = [np.arange(first.size)]
    if second is not None:
        numbers.append(first.size + np.arange(second.size))
    pairs, rows = [], []
    for asked in {0, len(graphs) - 1}:
        other = len(graphs) - 1 - asked
        a, b, rest = found_pairs(graphs[other], graphs[asked].vectors, threshold, asked == other)
        pairs.append((numbers[asked][a], numbers[other][b]))
        rows.append((asked, other, rest))
        tally.dense[numbers[asked][rest]] = True
    tally.add_pairs(*(np.concatenate(ends) for ends in zip(*pairs)))
    for asked, other, rest in rows:
        for at, near in link_rows(graphs[other], graphs[asked].vectors[rest], threshold):
            tally.add_rows(numbers[asked][rest[at : at + len(near)]], numbers[other], near)
    ids = np.concatenate([graph.ids for graph in graphs])
    nodes, root = roots(*(np.concatenate(ends) for ends in tally.ends))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[nodes]), pa.array(tally.links[nodes].astype(np.int64)), pa.array(ids[root])],
        ["node", "links", "root"],
    )


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
    least_shards: int = LEAST_SHARDS,
) -> DataFrame:
    """(key, n_links, component, kept) of every row, by cosine at ``threshold`` or more.

    ``n_links`` counts the other rows linked directly, ``component`` is the smallest key
    reachable, and ``kept`` whether that is the row's own. Equal vectors are one node of
    the graphs with a weight, so copies cost nothing. Vectors that are null, empty or zero,
    or hold null or non-finite components, link with nothing, nor do vectors of different
    lengths. A repeated key is a row each time; null keys never name a component. An
    empty table gives an empty one.

    A task holds the graphs of two shards, of about ``SHARD_BYTES`` of vectors each, and hands on a row
    for each linked node, never pairs. It holds at most half a beam of links for a node;
    denser ones are counted and connected from blocks of whole rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(key).alias("key"), F.col(vector).alias("vector"),
        F.xxhash64(vector).alias("high"), F.xxhash64(F.lit(1), F.col(vector)).alias("low"),
        usable(vector).alias("usable"),
    )
    grouped = rows.where("usable").groupBy("high", "low").agg(
        F.count(F.lit(1)).alias("weight"), F.min("key").alias("first"), F.first("vector").alias("vector")
    )
    nodes = settle(
        grouped.withColumns({"node": F.monotonically_increasing_id(), "length": F.size("vector")}), "nodes"
    )
    cells = nodes.agg(F.sum("length")).first()[0] or 0
    shards = max(least_shards, -(-cells * 8 // SHARD_BYTES))
    dealt = nodes.select(
        "node", "weight", "vector", "length", F.pmod(F.xxhash64("high", "low"), F.lit(shards)).cast("int").alias("shard")
    )

    def compile_shard(table: pa.Table) -> pa.Table:
        graph = hnsw.build(
            table["node"].to_numpy(), table["weight"].to_numpy(), unit_rows(table["vector"]),
            seed=table["shard"][0].as_py(),
        )
        one = [table.slice(0, 1)[c].combine_chunks() for c in ("length", "shard")]
        return pa.Table.from_arrays([*one, pa.array([graph.dump()], pa.binary())], ["length", "shard", "graph"])

    graphs = settle(
        dealt.repartitionByRange(shards, "shard").groupBy("length", "shard").applyInArrow(
            compile_shard, "length int, shard int, graph binary"
        ),
        "graphs",
    )
    # Every graph goes to the tasks of its pairs, and no two pairs share a key.
    other = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    sides = graphs.withColumn("other", other).select(
        "length", F.least("shard", "other").alias("a"), F.greatest("shard", "other").alias("b"), "shard", "graph"
    )
    schema = "node long, links long, root long"

    def match(table: pa.Table) -> pa.Table:
        # The shards of one pair, or one of them where the other has no vector of this length.
        held = [hnsw.Graph.load(graph) for graph in table.sort_by("shard")["graph"].to_pylist()]
        alone = table["a"][0].as_py() == table["b"][0].as_py()
        if len(held) == 1 and not alone:
            return pa.table({name: pa.array([], pa.int64()) for name in ("node", "links", "root")})
        return pa.Table.from_batches([matched(held[0], None if alone else held[1], threshold)])

    found = settle(sides.groupBy("length", "a", "b").applyInArrow(match, schema), "matches")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found, "node", "root")
    named = settle(
        nodes.select("node", "high", "low", "weight", "first").join(linked, "node", "left").join(labels, "node", "left")
        .withColumn("label", F.coalesce("component", "node")),
        "named",
    )
    smallest = named.groupBy("label").agg(F.min("first").alias("component"))
    per_node = settle(
        named.drop("component").join(smallest, "label").select(
            "high", "low", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component"
        ),
        "per-node",
    )
    # A vector that a third of all rows share: the join is split by adaptive execution.
    every = rows.select("key", "high", "low", "usable").join(per_node, ["high", "low"], "left")
    component = F.when(F.col("usable"), F.coalesce("component", "key")).otherwise(F.col("key"))
    return every.select(
        F.col("key").alias(key), F.when(F.col("usable"), F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component"), F.col("key").eqNullSafe(component).alias("kept"),
    )
