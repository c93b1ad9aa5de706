"""Vectors against the centres, or pivots, of their groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingmill.session import settle

# Centres that tasks hold at a time; more are met block by block, a block holding whole groups.
BLOCK_BYTES = 256 * 1024 * 1024
# Rows whose distances to all centres are held at a time.
TILE_ROWS = 1_024

Known = dict[object, tuple[np.ndarray, np.ndarray]]
Work = Callable[[Iterator[pa.RecordBatch], Known], Iterator[pa.RecordBatch]]


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equally long vectors as a float64 matrix."""
    rows = len(column)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(rows, -1)


def nearest(vectors: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the centre with the smallest Euclidean distance, first on ties, and its square."""
    halves = 0.5 * (centers * centers).sum(axis=1)
    found = np.empty(len(vectors), dtype=np.int64)
    gaps = np.empty(len(vectors))
    for at in range(0, len(vectors), TILE_ROWS):
        rows = slice(at, at + TILE_ROWS)
        found[rows] = np.argmin(halves[None, :] - vectors[rows] @ centers.T, axis=1)
        gaps[rows] = ((vectors[rows] - centers[found[rows]]) ** 2).sum(axis=1)
    return found, gaps


def by_group(batch: pa.RecordBatch, group: str, known: Known) -> Iterator[tuple[object, np.ndarray]]:
    """(group, row numbers) for the groups of a batch that have centres."""
    coded = pc.dictionary_encode(batch.column(group))
    codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    ends = np.searchsorted(codes[order], np.arange(len(coded.dictionary) + 1))
    for code, name in enumerate(coded.dictionary.to_pylist()):
        if name in known:
            yield name, order[ends[code] : ends[code + 1]]


def against_centers(
    df: DataFrame, centers: DataFrame, group: str, work: Work, schema: T.StructType, label: str, block_bytes: int
) -> DataFrame:
    """What ``work`` makes of the rows and the centres of their groups, written to a table.

    The centres' total size is measured; groups are dealt into blocks of about
    ``block_bytes`` of centres, usually one. A block is sent to the executors, meets the
    rows of its groups where they are, and is taken back once the result is written.
    """
    cells = centers.agg(F.sum(F.size("center")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-cells * 8 // block_bytes))
    out = []
    for number in range(blocks):
        here = F.pmod(F.xxhash64(group), F.lit(blocks)) == number
        own, rows = (centers.where(here), df.where(here)) if blocks > 1 else (centers, df)
        table = own.select(group, "label", "center").sort(group, "label").toArrow()
        known: Known = {}
        for name in table[group].unique().to_pylist():
            part = table.filter(pc.equal(table[group], name))
            known[name] = (part["label"].to_numpy(), matrix(part["center"]))
        shared = df.sparkSession.sparkContext.broadcast(known)
        out.append(settle(rows.mapInArrow(lambda batches, shared=shared: work(batches, shared.value), schema), label))
        shared.unpersist()
    return reduce(DataFrame.unionAll, out)
