"""Writers. All of them are plain Spark writes, committed by task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingmill.operators import sampling
from lingmill.session import settle


def publish(df: DataFrame, path: str) -> None:
    """Replace the dataset at ``path``."""
    df.write.mode("overwrite").parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_chunks(
    df: DataFrame, path: str, order_by: Sequence[str], size: int, digits: int = 6, shift: int = 0
) -> None:
    """One directory per ``size`` consecutive rows, named by the first row's index.

    Rows are numbered by their order alone, and written once, by ranges of their numbers: each
    task writes its own chunks, in order; one that spans two tasks gets a file from each.
    Choose ``size`` so that a chunk is worth a file.
    """
    chunked = sampling.with_chunks(df, order_by, size, digits, shift, "_index")
    ranged = chunked.repartitionByRange("_index").sortWithinPartitions("_index").drop("_index")
    ranged.write.mode("overwrite").partitionBy("chunk_id").parquet(path)


def write_per_source_file(df: DataFrame, path: str, file_column: str = "source_file") -> None:
    """One output directory per input file, named after it.

    ``df`` must carry the input's name, such as ``_metadata.file_name``. Rows of
    one file stay in as many tasks as they were read in.
    """
    df.write.mode("overwrite").partitionBy(file_column).parquet(path)


def stored_rows(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """What is stored at ``path``, or no rows if nothing is yet."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as problem:
        # Anything else, such as a denied read, must not pass for "nothing stored".
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def resume_into(
    df: DataFrame, path: str, key: Sequence[str], work: Callable[[DataFrame], DataFrame], commits: int = 4
) -> DataFrame:
    """Run ``work`` on the rows whose key is not yet stored at ``path``; append; return all.

    The open rows are dealt by key hash into ``commits`` parts, each appended by itself.
    Completed appends survive a failed run, so a second run continues from there: at
    most one part's work is done again.
    """
    spark = df.sparkSession
    sample = work(df.limit(0))
    open_rows = sampling.not_done(df, stored_rows(spark, path, sample), key)
    part = F.pmod(F.xxhash64(*key), F.lit(commits)).cast("int")
    dealt = settle(open_rows.withColumn("__part", part), "open-rows", ["__part"])
    for number in range(commits):
        own = dealt.where(F.col("__part") == number).drop("__part")
        work(own).write.mode("append").parquet(path)
    return spark.read.schema(sample.schema).parquet(path)


def append_round(df: DataFrame, path: str, round_number: int) -> None:
    """Store one judge round as its own partition, replacing only that round."""
    df.drop("round").write.mode("overwrite").parquet(f"{path}/round={round_number}")
