"""A corpus pipeline: quality, near and substring duplicates, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingmill.llm import byte_bpe, decontamination, line_quality, repeats, simhash
from lingmill.session import settle
from suite.registry import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are good, as the labels of quality mark them."""
    model = line_quality.learn(docs, table(spark, sf_dir, "labels"))
    scored = line_quality.with_score(docs.select(COLUMNS), model)
    return scored.where(F.col("score") >= line_quality.THRESHOLD).select(COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each SimHash group, once; null ids come last.

    Groups are those of ``simhash.near_duplicates`` as ``op9_simhash`` calls it: three-word
    shingles, fingerprints at most two bits apart.
    """
    tied = docs.select(COLUMNS).withColumn("__tie", F.xxhash64("text"))
    found = simhash.near_duplicates(tied, keep=("__tie",))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__tie")
    # Structs of null ids compare as equal, and the join's exchange serves dropDuplicates.
    winners = settle(found.groupBy("group").agg(F.min(row).alias("__row")).select("__row"), "kept")
    kept = tied.withColumn("__row", row).join(winners, "__row", "left_semi")
    return kept.dropDuplicates(["__row"]).select(COLUMNS)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages; untouched texts stay as they are."""
    found = repeats.remove_repeats(docs.select(COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    emptied = (F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_words"))
    return found.where(~emptied).withColumn("text", text).withColumn(
        "n_chars", F.length("text").cast("long")
    ).select(COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark; rows of one id are judged by their own texts."""
    tied = docs.select(COLUMNS).withColumn("__tie", F.xxhash64("text"))
    found = decontamination.contaminated(tied, table(spark, sf_dir, "benchmark"), keep=("__tie",))
    # Structs of null ids compare as equal.
    leaked = settle(found.select(F.struct("doc_id", "__tie").alias("__row")).distinct(), "leaked")
    return tied.withColumn("__row", F.struct("doc_id", "__tie")).join(leaked, "__row", "left_anti").select(COLUMNS)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids, with digests of the ids and of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", keep_good_lines),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("substring dedup", remove_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode_bytes),
]

# SQL cannot express the first stage's model; a test compares run() with plain Python, given that model's scores.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), "stage")
    return docs
