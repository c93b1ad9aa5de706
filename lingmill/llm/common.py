"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingmill.session import new_table_path

# Texts that leave a Python worker in one Arrow batch.
SLICE_ROWS = 512
# Text bytes that vectorised code looks at together.
SLICE_BYTES = 1 << 22


def slices(
    batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS, text: str | None = None, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches small enough that results stay small too.

    With ``text``, that column of a batch has at most ``size`` bytes, or one row.
    """
    for batch in batches:
        if text is None:
            for start in range(0, batch.num_rows, rows):
                yield batch.slice(start, rows)
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = int(np.searchsorted(ends, before + size, side="right"))
            end = min(max(end, start + 1), start + rows)
            yield batch.slice(start, end - start)
            start = end


def texts_of(column: pa.Array) -> list[str]:
    """A string column as a list; null becomes the empty text."""
    return [text or "" for text in column.to_pylist()]


def settle_compressed(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``session.settle`` with a denser codec, for tables nearly as large as the input."""
    path = new_table_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unchanged(df: DataFrame, *columns: str) -> list[str]:
    """Columns of ``df`` other than the named ones."""
    return [c for c in df.columns if c not in columns]


def bucket(columns: Sequence[str], buckets: int):
    """A bucket number in [0, buckets) from a hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")
