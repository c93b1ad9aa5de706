"""Readers. Schemas are given, never inferred, so reading starts no extra job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingmill.functions import text


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet dataset by path, with an explicit schema if given."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_glob(
    spark: SparkSession,
    root: str,
    pattern: str = "*.parquet",
    schema: T.StructType | None = None,
    exclude: str | None = None,
) -> DataFrame:
    """Parquet files below ``root`` whose name matches ``pattern``.

    ``exclude`` leaves out files with that text in their path.
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(root)
    if exclude is not None:
        df = df.where(~F.col("_metadata.file_path").contains(exclude))
    return df


def read_languages(
    spark: SparkSession,
    path: str,
    languages: Sequence[str] | None = None,
    column: str = "language_code",
    schema: T.StructType | None = None,
) -> DataFrame:
    """A table partitioned by language; a list of codes prunes its directories."""
    df = read_table(spark, path, schema)
    return df if languages is None else df.where(F.col(column).isin(list(languages)))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All JSON-lines files of a path or glob as one frame."""
    return spark.read.schema(schema).json(path)


def value_from_path(pattern: str, group: int = 1) -> Column:
    """Part of the source file's path, for columns encoded in file names."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, group)


def shard_manifest(last_shards: DataFrame, url_format: str, language: str = "lang", last: str = "last") -> DataFrame:
    """(language, last shard) rows as one row per shard: ``language, shard, name, url``.

    ``url_format`` takes the language and the four-digit shard name.
    """
    shards = last_shards.select(
        language, F.explode(F.sequence(F.lit(0).cast("long"), F.col(last).cast("long"))).alias("shard")
    )
    named = shards.withColumn("name", text.zero_padded(F.col("shard"), 4))
    return named.withColumn("url", F.format_string(url_format, language, "name"))


def read_rounds(spark: SparkSession, path: str) -> DataFrame:
    """All stored rounds with their ``round`` number."""
    return spark.read.parquet(path).withColumn("round", F.col("round").cast("int"))
