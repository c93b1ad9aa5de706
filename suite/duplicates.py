"""Exact and near duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lingmill.operators import dedup, stats
from suite.registry import query, table

# The test vectors have no pair above the default threshold.
THRESHOLD = 0.3

SQL_KEPT = f"""kept AS (SELECT a.vec_id, a.label, a.embedding FROM embeddings a WHERE NOT EXISTS (
  SELECT 1 FROM embeddings b WHERE b.label = a.label AND b.vec_id < a.vec_id
  AND list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > {THRESHOLD}))"""


@query("""SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY text
ORDER BY lang, doc_id) AS place FROM documents) WHERE place = 1""")
def exact_duplicates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return dedup.drop_exact_duplicates(docs, ["text"], ["lang", "doc_id"]).select("doc_id", "lang")


@query(f"WITH {SQL_KEPT} SELECT vec_id, label FROM kept")
def near_duplicates(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    kept = dedup.drop_near_duplicates(vectors, "vec_id", "label", "embedding", ["vec_id"], THRESHOLD)
    return kept.select("vec_id", "label")


@query(f"""WITH {SQL_KEPT}, k AS (SELECT label, count(*) AS n_kept FROM kept GROUP BY label)
SELECT label, round(n_kept / count(*), 6) AS kept_share FROM embeddings JOIN k USING (label)
GROUP BY label, n_kept""")
def near_duplicate_rates(spark, sf_dir):
    """Share of rows kept per group."""
    vectors = table(spark, sf_dir, "embeddings")
    removed = dedup.near_duplicate_keys(vectors, "vec_id", "label", "embedding", ["vec_id"], THRESHOLD)
    marked = vectors.select("vec_id", "label").join(removed.withColumn("gone", F.lit(True)), "vec_id", "left")
    share = F.avg(F.col("gone").isNull().cast("double"))
    return marked.groupBy("label").agg(F.round(share, 6).alias("kept_share"))


@query(f"""WITH e AS (SELECT v.vec_id, v.label, v.embedding, CASE WHEN v.vec_id % 11 > 0 THEN d.text END AS prompt
   FROM embeddings v JOIN documents d ON d.doc_id = v.vec_id),
k AS (SELECT * FROM e a WHERE NOT EXISTS (SELECT 1 FROM e b WHERE b.label = a.label AND b.vec_id < a.vec_id
   AND list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > {THRESHOLD})),
f AS (SELECT *, row_number() OVER (PARTITION BY prompt ORDER BY label, vec_id) AS place FROM k)
SELECT vec_id, label, prompt FROM f WHERE place = 1 AND prompt IS NOT NULL""")
def prompt_deduplication(spark, sf_dir):
    """Near duplicates within a label, equal prompts across labels, then nulls."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    prompt = F.when(F.pmod("vec_id", F.lit(11)) > 0, F.col("text"))
    rows = table(spark, sf_dir, "embeddings").join(docs, "vec_id").select("vec_id", "label", "embedding", prompt.alias("prompt"))
    out = dedup.dedup_prompts(rows, "vec_id", "label", "prompt", "embedding", THRESHOLD)
    return out.select("vec_id", "label", "prompt")


@query(f"WITH {SQL_KEPT} SELECT round(count(*) / (SELECT count(*) FROM embeddings), 6) AS rate FROM kept")
def near_duplicate_rate(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    removed = dedup.near_duplicate_keys(vectors, "vec_id", "label", "embedding", ["vec_id"], THRESHOLD)
    marked = vectors.select("vec_id").join(removed.withColumn("gone", F.lit(True)), "vec_id", "left")
    return stats.rate(marked, F.col("gone").isNull()).select(F.round("rate", 6).alias("rate"))
