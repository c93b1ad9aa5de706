"""Continuous forms of the narrow steps.

Filters, parsing and model calls look at one row at a time, so they run
unchanged on a stream of files; the stream's checkpoint replaces hand-kept
offsets. Sampling, deduplication and quantiles need whole groups and stay batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_new_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1_000) -> DataFrame:
    """Parquet files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_available(
    stream: DataFrame, output: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda d: d
) -> StreamingQuery:
    """Process what has arrived since the last run into Parquet, exactly once, then stop."""
    return (
        transform(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(output)
    )
