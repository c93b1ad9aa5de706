"""Keyed model calls with stand-in models."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import draws
from lingmill.operators import inference, stats
from lingmill.plans import grounded
from lingmill.session import new_table_path, settle
from lingmill.streaming import incremental
from suite import draws as draw_queries
from suite import fixtures as fx
from suite.registry import query, table

FAILED = fx.sql_draw("doc_id", "0", 10) + " < 1"


def _prompts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("prompt"))


@query(f"""SELECT doc_id, CASE WHEN {FAILED} THEN NULL ELSE text END AS content,
CASE WHEN {FAILED} THEN NULL ELSE 'stop' END AS finish_reason, CASE WHEN {FAILED} THEN 'no answer' END AS error
FROM documents""")
def keyed_calls(spark, sf_dir):
    """An echo that fails for a tenth of the keys; failures are values."""
    results = inference.run_calls(_prompts(spark, sf_dir), ["doc_id"], inference.failing_echo(), partitions=8)
    return results.select("doc_id", "result.content", "result.finish_reason", "result.error")


@query(f"""SELECT doc_id, source, length(text) AS n FROM documents WHERE NOT ({FAILED})""")
def results_joined_back(spark, sf_dir):
    """Inputs with their results, flattened, failures dropped."""
    results = inference.run_calls(_prompts(spark, sf_dir), ["doc_id"], inference.failing_echo())
    joined = inference.join_back(table(spark, sf_dir, "documents").select("doc_id", "source"), results, ["doc_id"])
    flat = inference.flatten_results(joined, ["doc_id", "source"])
    return flat.select("doc_id", "source", F.length("content").cast("long").alias("n"))


@query(f"""SELECT doc_id, CASE WHEN {FAILED} AND {fx.sql_draw('doc_id', '1', 10)} < 1 THEN NULL ELSE text END
AS content FROM documents""")
def retried_calls(spark, sf_dir):
    """Failed rows get a second attempt."""
    calls = [inference.failing_echo(0), inference.failing_echo(1)]
    results = inference.run_with_retry(_prompts(spark, sf_dir), ["doc_id"], calls)
    return results.select("doc_id", "result.content")


@query(f"""SELECT doc_id, CASE WHEN {FAILED} THEN NULL ELSE text END AS content FROM documents""")
def streamed_calls(spark, sf_dir):
    """Calls on files as they arrive: the stream stops between two arrivals and goes on from its checkpoint."""
    prompts, folder = _prompts(spark, sf_dir), new_table_path(spark, "stream")
    for arrival in range(2):
        own = prompts.where(draws.draw_below([F.col("doc_id")], "arrival", 2) == arrival)
        own.write.mode("append").parquet(f"{folder}/in")
        stream = incremental.read_new_files(spark, f"{folder}/in", prompts.schema)
        incremental.run_available(
            stream, f"{folder}/out", f"{folder}/offsets",
            lambda rows: inference.run_calls(rows, ["doc_id"], inference.failing_echo()),
        ).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("doc_id", "result.content")


def _named(prefix):
    def call(row):
        return {"content": prefix + row["prompt"], "finish_reason": "stop"}

    return call


@query("""SELECT doc_id, m AS model, CASE WHEN contains(m, 'gpt') THEN 'hosted: ' ELSE 'local: ' END || source
AS content FROM documents, (VALUES ('gpt-4'), ('gpt-35'), ('qwen')) AS t(m)""")
def routed_calls(spark, sf_dir):
    """Every prompt to three models, routed by name, gathered as a map."""
    models = F.explode(F.array(*[F.lit(m) for m in ("gpt-4", "gpt-35", "qwen")]))
    asked = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("prompt"), models.alias("model"))
    results = inference.run_routed(asked, ["doc_id", "model"], "model", _named("hosted: "), _named("local: "))
    maps = inference.answer_map(results, ["doc_id"], "model")
    return maps.select("doc_id", F.explode("llm_responses").alias("model", "a")).select("doc_id", "model", "a.content")


@query(f"""WITH r AS (SELECT language, unnest(range(1, 51))::INT AS repeat_id FROM
  (SELECT DISTINCT {fx.SQL_NAME} AS language FROM documents))
SELECT language, repeat_id, '1. ' || language || ' - 150 prompts' AS gen_prompts FROM r
WHERE NOT ({fx.sql_draw('language, repeat_id', 'fail', 10)} < 1)""")
def requested_prompt_lists(spark, sf_dir):
    """Fifty requests per language, no retry, failures dropped."""
    def call(row):
        digest = hashlib.md5(f"{row['language']}|{row['repeat_id']}|fail".encode()).hexdigest()
        if int(digest[:8], 16) % 10 < 1:
            raise RuntimeError("busy")
        return {"content": "1. " + row["prompt"], "finish_reason": "stop"}

    names = table(spark, sf_dir, "documents").select(fx.declared_name(F.col("lang")).alias("language")).distinct()
    requests = inference.prompt_list_requests(
        names, draw_queries.JAPANESE_SEEDS, draw_queries.ENGLISH_SEEDS
    )
    results = inference.run_with_retry(
        requests, ["language", "repeat_id"], [call], inputs=("system", "shots", "prompt")
    )
    flat = inference.flatten_results(results, ["language", "repeat_id"])
    return flat.select("language", "repeat_id", F.col("content").alias("gen_prompts"))


def _judge(row):
    """Ranks responses in the order in which they are lettered, the last two tied."""
    letters = [x["letter"] for x in row["model_id_list"]]
    ranking = ">".join(letters[:-1]) + "=" + letters[-1] if len(letters) > 1 else letters[0]
    return {"content": "<<<RANKING>>>\n" + ranking, "finish_reason": "stop"}


@query(f"""WITH {fx.SQL_BALLOTS}, r AS (SELECT block, unnest(range(1, 6))::INT AS round FROM
  (SELECT DISTINCT block FROM models)),
l AS (SELECT r.block, r.round, row_number() OVER (PARTITION BY r.block, r.round
  ORDER BY {fx.sql_hash('r.block, r.round, m.model', '0')}) AS i, m.model FROM r JOIN models m USING (block))
SELECT block, round, string_agg(model, ',' ORDER BY i) AS lettered, '<<<RANKING>>>' || chr(10) ||
  string_agg(chr((64 + i)::INT), '>' ORDER BY i)[:-3] || '=' || chr((64 + max(i))::INT) AS eval_response
FROM l GROUP BY block, round""")
def judge_rounds(spark, sf_dir):
    """Five rounds of judging, gathered per prompt in round order."""
    chats = fx.judged_chats(spark, sf_dir)
    requests = inference.judge_requests(chats, ["conversation_id"])
    results = inference.run_calls(
        requests, ["conversation_id", "round"], _judge, inputs=("system", "prompt", "model_id_list")
    )
    evals = inference.gather_rounds(requests, results, ["conversation_id"], "judge")
    rows = evals.select(F.col("conversation_id").alias("block"), F.posexplode("model_evals").alias("i", "e"))
    models = F.array_join(F.transform("e.model_id_list", lambda x: x["model"]), ",")
    return rows.select(
        "block", (F.col("i") + 1).alias("round"), models.alias("lettered"), "e.eval_response"
    )


def _score(row):
    scores = ", ".join(f'"{n}": {len(row["prompt"]) % 10 + 1}' for n in fixed.SCORE_FIELDS)
    return {"content": "{" + scores + ",}", "finish_reason": "stop"}


@query(f"""WITH {fx.SQL_REPLIES} SELECT doc_id, parse_error AS error, CASE WHEN parse_error IS NULL THEN
  (length('<<PROMPT>>' || chr(10) || chr(10) || prompt || chr(10) || chr(10) || '<<RESPONSE>>' || chr(10) || chr(10)
   || response) % 10 + 1)::INT END AS fluency FROM parsed""")
def scored_replies(spark, sf_dir):
    """Parse, guard, score once per parsed row, and read the score."""
    scored = inference.score_generated(fx.marked_replies(spark, sf_dir), ["doc_id"], _score)
    scores = inference.score_fields(F.col("filter_response.content"))
    return scored.select("doc_id", "filter_response.error", scores["fluency"].alias("fluency"))


@query(f"""SELECT doc_id, CASE WHEN {FAILED} THEN NULL ELSE '<INPUT>' || chr(10) || source || chr(10) || chr(10) ||
  '<OUTPUT>' || chr(10) || text END AS gen_input_outputs, CASE WHEN {FAILED} THEN NULL ELSE 'stop' END AS finish_reason
FROM documents""")
def revised_pairs(spark, sf_dir):
    """Input/target pairs sent for revision."""
    pairs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("inputs"), F.col("text").alias("targets"), F.col("lang").alias("language")
    )
    out = grounded.revise_pairs(pairs, ["doc_id"], inference.failing_echo())
    return out.select("doc_id", "gen_input_outputs", "finish_reason")


@query(f"""SELECT lang, round(sum(length(text) * 40 / 1000000.0), 3) AS dollars FROM documents
WHERE NOT ({FAILED}) GROUP BY lang""")
def echoed_call_costs(spark, sf_dir):
    """Dollars per language from the usage the calls report."""
    results = settle(inference.run_calls(_prompts(spark, sf_dir), ["doc_id"], inference.failing_echo()), "calls")
    joined = inference.join_back(table(spark, sf_dir, "documents").select("doc_id", "lang"), results, ["doc_id"])
    return stats.total_cost(joined, F.col("result.prompt_tokens"), F.col("result.completion_tokens"), ["lang"])
