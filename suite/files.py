"""Sinks and sources: each query writes to the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lingmill import schemas
from lingmill.operators import inference
from lingmill.session import new_table_path
from lingmill.sources import readers, writers
from suite import fixtures as fx
from suite.registry import query, table


@query("""WITH c AS (SELECT lang, max(len(string_split(text, chr(10)))) // 10 AS last FROM documents GROUP BY lang)
SELECT lang, unnest(range(last + 1)) AS shard, lpad(unnest(range(last + 1))::VARCHAR, 4, '0') AS name,
  'http://example.org/' || lang || '/' || lpad(unnest(range(last + 1))::VARCHAR, 4, '0') || '.parquet' AS url FROM c""")
def shard_manifest(spark, sf_dir):
    """Shards per language; the last one comes from the longest text."""
    last = table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.floor(F.max(F.size(F.split("text", "\n", -1))) / 10).alias("last")
    )
    return readers.shard_manifest(last, "http://example.org/%s/%s.parquet")


@query("""SELECT lpad((i - i % 200)::VARCHAR, 6, '0') AS chunk_id, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) GROUP BY 1""")
def chunk_files(spark, sf_dir):
    """Chunked output read back by its directory names."""
    path = new_table_path(spark, "chunks")
    writers.write_chunks(table(spark, sf_dir, "documents"), path, ["doc_id"], 200)
    stored = readers.read_table(spark, path).withColumn(
        "chunk_id", readers.value_from_path(r"chunk_id=(\d+)")
    )
    return stored.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )


@query(f"WITH {fx.SQL_REPLIES} SELECT source, count(*) AS n, count(parse_error) AS n_errors FROM parsed GROUP BY source")
def per_file_outputs(spark, sf_dir):
    """Inputs in one directory a source; the pass over them keeps that layout."""
    given, out = new_table_path(spark, "replies"), new_table_path(spark, "scored")
    fx.marked_replies(spark, sf_dir).withColumn("part", F.col("source")).write.partitionBy("part").parquet(given)
    rows = readers.read_glob(spark, given).withColumn(
        "source_file", readers.value_from_path(r"part=([^/]+)/")
    )
    writers.write_per_source_file(inference.parse_generated(rows), out)
    stored = readers.read_table(spark, out)
    return stored.groupBy(F.col("source_file").alias("source")).agg(
        F.count(F.lit(1)).alias("n"), F.count("parse_error").alias("n_errors")
    )


@query("SELECT lang, count(*) AS n FROM documents WHERE lang NOT IN ('de') GROUP BY lang")
def excluded_paths(spark, sf_dir):
    """Files whose path contains a word are not read."""
    path = new_table_path(spark, "by-language")
    table(spark, sf_dir, "documents").withColumn("part", F.col("lang")).write.partitionBy("part").parquet(path)
    stored = readers.read_glob(spark, path, exclude="part=de")
    return stored.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang AS language_code, count(*) AS n, sum(n_chars)::BIGINT AS n_chars FROM documents WHERE lang IN ('fr', 'es') GROUP BY lang")
def language_partitions(spark, sf_dir):
    """A table partitioned by language, read for two of them."""
    path = new_table_path(spark, "languages")
    docs = table(spark, sf_dir, "documents").withColumnRenamed("lang", "language_code")
    docs.repartition("language_code", F.pmod("doc_id", F.lit(8))).write.partitionBy("language_code").parquet(path)
    stored = readers.read_languages(spark, path, ["fr", "es"])
    return stored.groupBy("language_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars")
    )


@query("SELECT conv_id, turn, role, text FROM conversations")
def json_turns(spark, sf_dir):
    """Whole conversations, a line per turn, written as JSON lines and read with their schema."""
    path = new_table_path(spark, "json")
    turns = table(spark, sf_dir, "conversations")
    writers.write_json_lines(turns, path)
    return readers.read_json_lines(spark, path, turns.schema)


@query(f"WITH {fx.SQL_CHATS} SELECT conversation_id::VARCHAR AS conversation_id, language, first_text, toxic FROM chats")
def json_lines(spark, sf_dir):
    """First exchanges, nested, written as JSON lines and read with their schema."""
    path = new_table_path(spark, "json")
    writers.write_json_lines(fx.chats(spark, sf_dir), path)
    chats = readers.read_json_lines(spark, path, schemas.CHATS)
    return chats.select(
        "conversation_id", "language",
        F.col("conversation")[0]["content"].alias("first_text"),
        F.col("openai_moderation")[0]["categories"]["toxic"].alias("toxic"),
    )


@query("SELECT doc_id, r::INT AS round, doc_id % 5 = r AS last_hit FROM documents, (VALUES (1), (2), (3)) AS t(r)")
def stored_rounds(spark, sf_dir):
    """Three rounds stored one by one; a repeated round replaces itself."""
    path = new_table_path(spark, "rounds")
    docs = table(spark, sf_dir, "documents").select("doc_id")
    for number in (1, 2, 3, 2):
        rows = docs.select("doc_id", F.lit(number).alias("round"), (F.pmod("doc_id", F.lit(5)) == number).alias("last_hit"))
        writers.append_round(rows, path, number)
    return readers.read_rounds(spark, path)


@query("SELECT doc_id, text AS content FROM documents")
def resumed_calls(spark, sf_dir):
    """Half the rows answered, the rest on a second run; each row is answered once."""
    path = new_table_path(spark, "answers")
    prompts = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("prompt"))

    def work(rows):
        return inference.run_calls(rows, ["doc_id"], inference.echo)

    writers.resume_into(prompts.where(F.pmod("doc_id", F.lit(2)) == 0), path, ["doc_id"], work)
    stored = writers.resume_into(prompts, path, ["doc_id"], work)
    return stored.select("doc_id", "result.content")


@query("SELECT doc_id, lang FROM documents")
def published_table(spark, sf_dir):
    """A final table replaced as a whole."""
    path = new_table_path(spark, "published")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    writers.publish(docs.limit(0), path)
    writers.publish(docs, path)
    return readers.read_table(spark, path, docs.schema)
