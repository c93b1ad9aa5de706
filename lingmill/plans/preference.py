"""Judged answers to preference pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import messages
from lingmill.operators import inference, ranking, sampling
from lingmill.session import new_table_path, settle
from lingmill.sources import writers
from lingmill.sources.journal import COMMITS, Journal


def prompts_to_judge(
    prompts: DataFrame, key: str = "conversation_id", n: int = fixed.PROMPTS_TO_JUDGE_PER_LANGUAGE, seed: int = 0
) -> DataFrame:
    """A fixed number of prompts per language."""
    return sampling.sample_per_group(prompts, ["language"], [key], n, seed)


def collect_answers(
    prompts: DataFrame,
    models: list[str],
    hosted: inference.Call,
    local: inference.Call,
    key: str = "conversation_id",
    journal: Journal | None = None,
    **options,
) -> DataFrame:
    """Every model's answer to every prompt, as the ``llm_responses`` map.

    Answers are stored part by part in the journal; given it again, a second run asks for the rest only. Where ``prompts`` has that map already, models whose answer it holds are not asked again.
    """
    first = messages.first_message(F.col("conversation"))
    resumed = "llm_responses" in prompts.columns
    known = F.col("llm_responses") if resumed else F.lit(None)
    asked = prompts.select(
        key,
        first.alias("prompt"),
        known.alias("_known"),
        F.explode(F.array(*[F.lit(m) for m in models])).alias("model"),
    )
    if resumed:
        asked = asked.where(F.try_element_at("_known", F.col("model"))["content"].isNull())
    # Calls are written before anything is exchanged, so that no lost executor repeats them.
    results = inference.run_routed(
        asked.drop("_known"), [key, "model"], "model", hosted, local,
        journal or Journal.fresh(prompts.sparkSession, "answer-calls"), inputs=("prompt",), **options,
    )
    answers = settle(inference.answer_map(results, [key], "model"), "answers")
    if not resumed:
        return prompts.join(answers, key)
    joined = prompts.join(answers.withColumnRenamed("llm_responses", "_new"), key, "left")
    others = F.map_filter("llm_responses", lambda model, _: ~F.array_contains(F.map_keys("_new"), model))
    merged = (
        F.when(F.col("_new").isNull(), F.col("llm_responses"))
        .when(F.col("llm_responses").isNull(), F.col("_new"))
        .otherwise(F.map_concat(others, "_new"))
    )
    return joined.withColumn("llm_responses", merged).drop("_new")


def judge_answers(
    answered: DataFrame,
    judge: inference.Call,
    judge_name: str,
    key: str = "conversation_id",
    rounds: int = fixed.JUDGE_ROUNDS,
    seed: int = 0,
    path: str | None = None,
    commits: int = COMMITS,
    **options,
) -> DataFrame:
    """Rows with all answers present plus their ``model_evals``.

    Each round is stored by itself below ``path``, in ``commits`` appends. Given the same path, a
    second run asks for what is not stored yet only.
    """
    spark = answered.sparkSession
    requests = settle(inference.judge_requests(answered, [key], rounds, seed=seed), "judge-requests")
    path = path or new_table_path(spark, "judgements")

    def work(rows: DataFrame) -> DataFrame:
        inputs = ("system", "prompt", "model_id_list")
        return inference.run_calls(rows, [key, "round"], judge, inputs=inputs, **options).drop("round")

    for number in range(1, rounds + 1):
        own = requests.where(F.col("round") == number)
        writers.resume_into(own, f"{path}/round={number}", [key], work, commits)
    evals = inference.gather_rounds(requests, spark.read.parquet(path), [key], judge_name)
    return answered.join(evals, key)


def preference_pairs(
    judged: DataFrame, models: tuple[str, str], key: str = "conversation_id", seed: int = 0
) -> dict[str, DataFrame]:
    """All five pair sets; ``models`` is the fixed pair. Ranking is computed once and stored."""
    needed = ["conversation", "llm_responses", "borda_ranking", "kendall_w"]
    ranked = ranking.rank_judged(judged, prefixes=()).select(key, *needed)
    return ranking.preference_sets(settle(ranked, "ranked"), [key], models, seed)
