"""Sampling, shuffling, slicing and replication."""

from __future__ import annotations

from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import draws
from lingmill.operators import ballots, inference, sampling
from suite import fixtures as fx
from suite.registry import query, table


def _sql_sample(n: int) -> str:
    return f"""SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang
ORDER BY {fx.sql_hash('doc_id', '7')}, doc_id) AS place FROM documents) WHERE place <= {n}"""


@query(_sql_sample(100))
def sample_per_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sampling.sample_per_group(docs, ["lang"], ["doc_id"], 100, 7)


@query(_sql_sample(250))
def large_sample_per_language(spark, sf_dir):
    """Above the direct limit: counts per hash prefix cut the candidates first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sampling.sample_per_group(docs, ["lang"], ["doc_id"], 250, 7)


@query("""SELECT doc_id, lpad((i - i % 500)::VARCHAR, 6, '0') AS chunk_id, lpad((i - i % 500 + 217000)::VARCHAR,
7, '0') AS shifted FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)""")
def row_chunks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    chunked = sampling.with_chunks(docs, ["doc_id"], 500)
    shifted = F.lpad((F.col("chunk_id").cast("long") + 217_000).cast("string"), 7, "0")
    return chunked.withColumn("shifted", shifted)


@query(f"""SELECT doc_id, row_number() OVER (ORDER BY {fx.sql_hash('doc_id', '42')}, doc_id) - 1 AS position
FROM documents""")
def shuffled_positions(spark, sf_dir):
    """Every document's place in a full shuffle."""
    order = draws.order_hash([F.col("doc_id")], 42)
    docs = table(spark, sf_dir, "documents").select("doc_id", order.alias("h"))
    return sampling.with_row_index(docs, ["h", "doc_id"], "position").drop("h")


@query(f"SELECT doc_id, text FROM documents ORDER BY {fx.sql_hash('doc_id', '3')}, doc_id LIMIT 1")
def random_peek(spark, sf_dir):
    return sampling.peek(table(spark, sf_dir, "documents"), ["doc_id"], 3).select("doc_id", "text")


_QUESTIONS = "[" + ", ".join(f"'{c}'" for c in fixed.QUESTION_CATEGORIES) + "]"
_COMMANDS = "[" + ", ".join(f"'{c}'" for c in fixed.COMMAND_CATEGORIES) + "]"


@query(f"""WITH t AS (SELECT doc_id, CASE WHEN {fx.sql_draw('doc_id', 'type-0', 2)} = 1 THEN 'command'
   ELSE 'question' END AS prompt_type, {fx.sql_draw('doc_id', 'category-0', 7)} + 1 AS c FROM documents)
SELECT doc_id, prompt_type, CASE prompt_type WHEN 'question' THEN {_QUESTIONS}[c] ELSE {_COMMANDS}[c] END
   AS prompt_category FROM t""")
def prompt_type_draws(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    typed = docs.withColumn("prompt_type", sampling.draw_prompt_type(["doc_id"]))
    return typed.withColumn(
        "prompt_category", sampling.draw_prompt_category(F.col("prompt_type"), ["doc_id"])
    )


@query(f"""WITH m AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS block, event_type AS model FROM events)
SELECT block, model, chr((64 + row_number() OVER (PARTITION BY block ORDER BY
   {fx.sql_hash('block, model', '5')}))::INT) AS letter FROM m""")
def shuffled_letters(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    models = events.groupBy(F.to_date("ts").cast("string").alias("block")).agg(
        F.collect_set("event_type").alias("models")
    )
    lettered = ballots.lettered_models(F.col("models"), [F.col("block")], 5)
    return models.select("block", F.explode(lettered).alias("x")).select("block", "x.model", "x.letter")


@query("""SELECT lang, unnest(range(1, 51))::INT AS repeat_id FROM (SELECT DISTINCT lang FROM documents)""")
def replicated_requests(spark, sf_dir):
    return sampling.replicate(table(spark, sf_dir, "documents").select("lang").distinct())


# Seed prompts are configuration: two short lists that travel with the plan.
JAPANESE_SEEDS = [f"種プロンプト{i}" for i in range(1, 81)]
ENGLISH_SEEDS = [f"Seed prompt {i}" for i in range(1, 61)]


def _sql_shots(alias: str, prefix: str, pool: int, n: int, tag: str) -> str:
    return f"""{alias} AS (SELECT language, repeat_id, string_agg(place || '. ' || s, chr(10) ORDER BY place)
   AS {alias}_shots FROM (SELECT language, repeat_id, s, row_number() OVER (PARTITION BY language, repeat_id
   ORDER BY {fx.sql_hash('language, repeat_id, s', tag)}) AS place FROM r,
   (SELECT '{prefix}' || unnest(range(1, {pool + 1})) AS s)) WHERE place <= {n} GROUP BY ALL)"""


@query(f"""WITH r AS (SELECT language, unnest(range(1, 4))::INT AS repeat_id FROM
   (SELECT DISTINCT {fx.SQL_NAME} AS language FROM documents)),
{_sql_shots('ja', '種プロンプト', 80, 50, 'ja-0')}, {_sql_shots('en', 'Seed prompt ', 60, 25, 'en-0')}
SELECT language, repeat_id, ja_shots, en_shots, language || ' - 150 prompts' AS prompt
FROM ja JOIN en USING (language, repeat_id)""")
def few_shot_requests(spark, sf_dir):
    names = table(spark, sf_dir, "documents").select(
        fx.declared_name(F.col("lang")).alias("language")
    ).distinct()
    requests = inference.prompt_list_requests(names, JAPANESE_SEEDS, ENGLISH_SEEDS, times=3)
    return requests.select(
        "language", "repeat_id",
        F.col("shots")[1]["content"].alias("ja_shots"), F.col("shots")[3]["content"].alias("en_shots"),
        "prompt",
    )


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def rows_not_done(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sampling.not_done(docs, table(spark, sf_dir, "labels"), ["doc_id"])
