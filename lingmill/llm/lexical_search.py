"""Ranked lexical search: the best documents of every item, by dual-tree search.

A document is a point with one coordinate a term of the items, an item the weights of its
terms; their score is the inner product. Runs of neighbouring documents, and of
neighbouring items, form the nodes of two trees, which hold the largest value of every
coordinate. The product of two nodes bounds the score of any pair below them, so a pair of nodes is
left out, with all it holds, if that bound is below the weakest kth score among its items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingmill.llm.common import slices
from lingmill.session import settle

TOP = 50
# Items of one reading of the documents, bytes of their texts, and items of one pair of trees.
BLOCK_ITEMS = 4096
BLOCK_BYTES = 1 << 20
TREE_ITEMS = 256
# Coordinates of the documents that a task holds at once.
CELLS = 1 << 21
# Documents whose strongest coordinates are sought at once.
NEAR_ROWS = 64
# Documents and items of a node, from the top; documents of one batch share the uppermost node.
DOC_RUNS = (1 << 30, 64, 8, 1)
ITEM_RUNS = (64, 16, 4, 1)
# First rounds of the last ranking, so that no task sees the finds of all tasks.
SALTS = 256
# Text bytes that are split at once.
PIECE = 1 << 20
INSIDE = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
LETTERS = bytes(b if b in INSIDE else 0x20 for b in range(256)).lower()


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """A text's terms, lower-cased A-Z, in lists of about a piece of the text each."""
    start, spelled = 0, (text or b"").translate(LETTERS)
    while start < len(spelled):
        end = spelled.find(b" ", start + PIECE)
        end = len(spelled) if end < 0 else end
        yield spelled[start:end].split()
        start = end


def document_vectors(docs: DataFrame, key: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(key, n, codes, counts): per document with a term, how many terms it has, and the
    numbers and occurrences (little-endian integers) of those in the vocabulary."""
    schema = T.StructType([
        T.StructField("key", docs.schema[key].dataType), T.StructField("n", T.LongType()),
        T.StructField("codes", T.BinaryType()), T.StructField("counts", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text="text"):
            rows, sizes, codes, counts = [], [], [], []
            for at, one in enumerate(batch.column("text")):
                n, held = 0, Counter()
                for part in terms(one.as_py()):
                    n += len(part)
                    held.update(filter(vocabulary.__contains__, part))
                if n:
                    rows.append(at)
                    sizes.append(n)
                    codes.append(np.array([vocabulary[t] for t in held], "<i4").tobytes())
                    counts.append(np.array(list(held.values()), "<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()),
                    pa.array(codes, pa.binary()), pa.array(counts, pa.binary()),
                ],
                schema.names,
            )

    return docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text")).mapInArrow(run, schema)


def corpus_counts(vectors: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(N, L, df): documents, terms of all documents, documents that hold each vocabulary term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(size + 2, dtype=np.int64)
        for batch in batches:
            for codes in batch.column("codes"):
                totals[np.frombuffer(codes.as_buffer(), "<i4")] += 1
            totals[size] += batch.num_rows
            totals[size + 1] += batch.column("n").to_numpy().sum()
        held = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(totals[held])], ["place", "total"])

    summed = vectors.select("n", "codes").mapInArrow(run, "place long, total long").groupBy("place").agg(F.sum("total").alias("total"))
    totals = np.zeros(size + 2, dtype=np.int64)
    # At most as many rows as the vocabulary of one block.
    for place, total in summed.collect():
        totals[place] = total
    return int(totals[size]), int(totals[size + 1]), totals[:size]


def similar_order(sets: list[frozenset], weights: np.ndarray) -> list[int]:
    """Numbers of the sets, those that share heavy members near each other, by halving."""
    todo, out = [list(range(len(sets)))], []
    while todo:
        group = todo.pop()
        if len(group) <= ITEM_RUNS[-2]:
            out += group
            continue

        def shared(one: int, other: int) -> int:
            return int(sum(weights[t] for t in sets[one] & sets[other]))

        first = group[0]
        other = min(group, key=lambda i: (shared(first, i), i))
        lean = sorted(group, key=lambda i: (shared(other, i) - shared(first, i), i))
        todo += [lean[len(lean) // 2 :], lean[: len(lean) // 2]]
    return out


def maxima(rows: np.ndarray, run: int) -> np.ndarray:
    """The largest value of every coordinate in each run of rows."""
    return rows if run == 1 else np.maximum.reduceat(rows, np.arange(0, len(rows), run), axis=0)


class Items:
    """The tree over some items, and their best documents so far."""

    def __init__(self, sets: list[frozenset], weights: np.ndarray, size: int, top: int):
        self.top = top
        order = similar_order(sets, weights)
        self.numbers = np.array(order)
        used = sorted(frozenset().union(*sets))
        self.columns = np.full(size, -1, dtype=np.int64)
        self.columns[used] = np.arange(len(used))
        most = max((int(sum(weights[t] for t in s)) for s in sets), default=0)
        # Scores are whole numbers: sums of doubles are exact below 2**53.
        self.kind = np.float64 if most * 1_000_000 < 1 << 53 else np.int64
        rows = np.zeros((len(sets), len(used)), dtype=self.kind)
        for place, i in enumerate(order):
            members = sorted(sets[i])
            rows[place, self.columns[members]] = weights[members]
        self.levels = [maxima(rows, run).T.copy() for run in ITEM_RUNS]
        self.clear()

    def clear(self) -> None:
        count = len(self.numbers)
        self.weakest = np.ones(count, dtype=self.kind)  # a score above 0 counts
        self.held = [[] for _ in range(count)]

    def bars(self, level: int) -> np.ndarray:
        """The weakest kth score among the items of every node."""
        return np.minimum.reduceat(self.weakest, np.arange(0, len(self.weakest), ITEM_RUNS[level]))

    def offer(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        """Documents (null flag, id) that reach an item's kth score."""
        parts = self.held[item]
        parts.append((scores, docs))
        if sum(len(s) for s, _ in parts) > 4 * self.top:
            self.trim(item)

    def trim(self, item: int) -> None:
        scores, docs = (np.concatenate(x) for x in zip(*self.held[item]))
        best = np.lexsort((docs[:, 1], docs[:, 0], -scores))[: self.top]
        self.held[item] = [(scores[best], docs[best])]
        if len(best) == self.top:
            self.weakest[item] = max(scores[best[-1]], 1)

    def near(self, points: np.ndarray) -> np.ndarray:
        """An order of documents in which those of the same strongest coordinates are neighbours."""
        weights = self.levels[0].max(axis=1)
        strongest, where = np.empty(len(points), self.kind), np.empty(len(points), np.int64)
        # Some rows at a time: the products of all are as large as the points.
        for start in range(0, len(points), NEAR_ROWS):
            products = points[start : start + NEAR_ROWS] * weights
            strongest[start : start + NEAR_ROWS] = products.max(axis=1)
            where[start : start + NEAR_ROWS] = products.argmax(axis=1)
        return np.lexsort((strongest, where))

    def search(self, points: np.ndarray, docs: np.ndarray) -> None:
        """Offer every document of a batch that may be among an item's best."""
        order = self.near(points)
        points, docs = points[order], docs[order]
        nodes = [maxima(points, run) for run in DOC_RUNS]
        self.visit(nodes, docs, 0, 0, len(nodes[0]), np.arange(self.levels[0].shape[1]))

    # Not a function inside search(): one that calls itself is a cycle, which keeps a batch until Python looks for cycles.
    def visit(self, nodes: list[np.ndarray], docs: np.ndarray, level: int, begin: int, end: int, asked: np.ndarray) -> None:
        """Compare nodes begin to end of a level with the item nodes asked for."""
        bounds = nodes[level][begin:end] @ self.levels[level][:, asked]
        reach = bounds >= self.bars(level)[asked]
        if level == len(DOC_RUNS) - 1:
            for column in np.flatnonzero(reach.any(axis=0)).tolist():
                at = np.flatnonzero(reach[:, column])
                self.offer(int(asked[column]), bounds[at, column], docs[begin + at])
            return
        fan = DOC_RUNS[level] // DOC_RUNS[level + 1] if level else len(nodes[1])
        fan_items = ITEM_RUNS[level] // ITEM_RUNS[level + 1]
        # Strong nodes first: they raise the bar for the others.
        for node in np.argsort(-bounds.max(axis=1), kind="stable").tolist():
            # The bars may be higher by now.
            open_nodes = asked[reach[node] & (bounds[node] >= self.bars(level)[asked])]
            if not len(open_nodes):
                continue
            below = (open_nodes[:, None] * fan_items + np.arange(fan_items)).ravel()
            below = below[below < self.levels[level + 1].shape[1]]
            first = (begin + node) * fan
            self.visit(nodes, docs, level + 1, first, min(first + fan, len(nodes[level + 1])), below)

    def best(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for item in range(len(self.numbers)):
            if self.held[item]:
                self.trim(item)
                yield int(self.numbers[item]), *self.held[item][0]


def search_tasks(vectors: DataFrame, items: Items, ids: pa.Array, first: int, total: int, terms_total: int) -> DataFrame:
    """(item, item_id, doc_id, score): each task's best documents of every item."""
    key_type = vectors.schema["key"].dataType
    schema = T.StructType([
        T.StructField("item", T.LongType()), T.StructField("item_id", T.LongType()),
        T.StructField("doc_id", key_type), T.StructField("score", T.LongType()),
    ])
    arrow_key = pa.int64() if isinstance(key_type, T.LongType) else pa.int32()
    batch_docs = max(CELLS // max(items.levels[-1].shape[0], 1), 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items.clear()
        for batch in slices(batches, rows=batch_docs):
            sizes = batch.column("n").to_pylist()
            codes = [np.frombuffer(x.as_buffer(), "<i4") for x in batch.column("codes")]
            counts = [np.frombuffer(x.as_buffer(), "<i8") for x in batch.column("counts")]
            row = np.repeat(np.arange(len(sizes)), [len(c) for c in codes])
            column = items.columns[np.concatenate(codes)]
            # Plain integers: the product may pass 64 bits.
            m = np.array([50 + 50 * n * total // terms_total for n in sizes], dtype=np.int64)
            tf = np.concatenate(counts)
            value = 1_000_000_000 * tf // (1000 * tf + 20 * m[row])
            inside = column >= 0
            row, column, value = row[inside], column[inside], value[inside]
            used, row = np.unique(row, return_inverse=True)
            if not len(used):
                continue
            points = np.zeros((len(used), items.levels[-1].shape[0]), dtype=items.kind)
            points[row, column] = value
            keys = batch.column("key").take(pa.array(used))
            docs = np.stack([
                keys.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
                keys.cast(pa.int64()).fill_null(0).to_numpy(),
            ], axis=1)
            items.search(points, docs)
        for item, scores, docs in items.best():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(scores), first + item)), ids.take(pa.array(np.full(len(scores), item))),
                    pa.array(docs[:, 1], mask=docs[:, 0] == 1).cast(arrow_key), pa.array(scores.astype(np.int64)),
                ],
                schema.names,
            )

    return vectors.mapInArrow(run, schema)


def ranked(found: DataFrame, top: int) -> DataFrame:
    """(item_id, rank, doc_id, score): the best of all tasks, in two rounds."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= top)
    last = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return last.select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    top: int = TOP,
) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``top`` highest-scoring documents of every item.

    Terms are runs of digits, letters and non-ASCII characters, A-Z lower-cased. A
    document scores the sum of w * ((10**9 tf) div (1000 tf + 20 m)) over the item's distinct
    terms; w = floor(1000 ln((2N + 2) / (2df + 1))) and m = 50 + 50 n N div L. Only
    scores above 0 count; equal ones go by ascending key, null last. Null and empty texts
    have no terms; documents that repeat a key are ranked each, equal rows of ``items``
    once; items may have null ids. Other columns are ignored. No documents, or no items, give
    no rows. Keys are integers.

    Items are taken in blocks of bounded number and size, whose documents' counts are
    stored; every block reads the documents once. A task keeps ``top`` documents an item.
    """
    spark = docs.sparkSession
    asked = settle(
        items.select(F.col(item).cast("long").alias("item_id"), F.col(item_text).cast("binary").alias("text")).distinct(), "items"
    )
    measured = asked.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(-(-measured["rows"] // BLOCK_ITEMS), -(-(measured["bytes"] or 0) // BLOCK_BYTES), 1)
    number, found = 0, []
    for block in range(blocks):
        here = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text")
        # A block of items: bounded by BLOCK_ITEMS and BLOCK_BYTES, or one long text.
        rows = [(r.item_id, Counter(t for part in terms(r.text) for t in part)) for r in here.collect()]
        vocabulary = {t: at for at, t in enumerate(sorted({t for _, counted in rows for t in counted}))}
        if not vocabulary:
            continue
        vectors = settle(document_vectors(docs, key, text, vocabulary), "vectors")
        total, terms_total, holding = corpus_counts(vectors, len(vocabulary))
        if not total:
            continue
        weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(df) + 1))) for df in holding], dtype=np.int64)
        for at in range(0, len(rows), TREE_ITEMS):
            some = rows[at : at + TREE_ITEMS]
            sets = [frozenset(vocabulary[t] for t in counted) for _, counted in some]
            if not any(sets):
                continue
            tree = Items(sets, weights, len(vocabulary), top)
            ids = pa.array([i for i, _ in some], pa.int64())
            found.append(search_tasks(vectors, tree, ids, number, total, terms_total))
            number += len(some)
    schema = T.StructType([
        T.StructField("item_id", T.LongType()), T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", docs.schema[key].dataType), T.StructField("score", T.LongType()),
    ])
    if not found:
        return spark.createDataFrame([], schema)
    return ranked(reduce(DataFrame.unionAll, found), top)
