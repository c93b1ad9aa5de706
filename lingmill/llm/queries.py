"""Registered queries of the corpus operators, with equivalent SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingmill.llm import (
    byte_bpe,
    decontamination,
    lexical_search,
    line_quality,
    near_vectors,
    pii,
    prefix_trie,
    repeats,
    sharding,
    simhash,
    token_counts,
    token_files,
    toxicity,
)
from lingmill.llm.oracles import ORACLES  # noqa: F401  (read by the entry)
from lingmill.session import new_table_path
from suite.registry import table

SHARDS = 24
END_ID = 1


def op1_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Two readers of the text would decode it twice; the shuffle needs neither.
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32")
    )
    sharded = sharding.shuffle_into_shards(rows, SHARDS)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contaminated(docs, items)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_toxicity(docs, chain).drop("text")
    return scored.withColumn("toxic", F.col("p_toxic") >= toxicity.THRESHOLD)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_table_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    token_files.write(docs, out, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return token_files.read(spark, out).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op6_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("component", "component_id")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.with_token_count(docs, pieces).select("doc_id", "n_tokens")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = line_quality.learn(docs, table(spark, sf_dir, "labels"))
    return line_quality.with_score(docs, model).select(
        "doc_id", line_quality.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= line_quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op12_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_prefixes(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_hypergeometric_shards,
        op2_decontamination,
        op3_repeats,
        op4_toxicity,
        op5_token_files,
        op6_hnsw,
        op7_byte_bpe,
        op8_token_counts,
        op9_simhash,
        op10_line_quality,
        op11_contextual_pii,
        op12_dual_tree_search,
        op13_prefix_trie,
    )
}
