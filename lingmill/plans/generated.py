"""Requested prompt lists to prompts, answers and training rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill.functions import messages
from lingmill.operators import dedup, detect, filters, inference, prompt_lists
from lingmill.session import settle
from lingmill.sources.journal import Journal


def request_prompt_lists(
    languages: DataFrame,
    calls: Sequence[inference.Call],
    japanese_seeds: Sequence[str],
    english_seeds: Sequence[str],
    times: int = 1,
    seed: int = 0,
    journal: Journal | None = None,
    **options,
) -> DataFrame:
    """``language, gen_prompts, finish_reason`` of all requests that succeeded.

    One pass per call; the later ones retry what failed. Each is an entry of the journal.
    """
    requests = inference.prompt_list_requests(languages, japanese_seeds, english_seeds, times, seed)
    results = inference.run_with_retry(
        requests, ["language", "repeat_id"], calls, inputs=("system", "shots", "prompt"), journal=journal, **options
    )
    return inference.flatten_results(results, ["language", "repeat_id"]).withColumnRenamed(
        "content", "gen_prompts"
    )


def parse_prompts(
    lists: DataFrame,
    key: Sequence[str],
    load_detector: Callable[[], detect.Detector],
    embed: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Numbered lists as one prompt a row, wrong languages out, optionally deduplicated.

    The prompt's key is the list's key and the item's position, as text.
    """
    rows = prompt_lists.explode_prompt_lists(
        lists, [*key, "language", "finish_reason"], position="position"
    )
    rows = rows.withColumn("position", F.coalesce("position", F.lit(-1)))
    rows = rows.withColumn("prompt_id", F.concat_ws("_", *key, "position"))
    # The order of lists and items, which that of the ids as text is not.
    order = [*(c for c in key if c != "language"), "position"]
    rows = rows.select("prompt_id", "language", "finish_reason", "prompt_list", *order)
    found = detect.with_detection(
        rows, F.col("prompt_list"), load_detector, "lang_detected", errors_as_null=False
    )
    kept = filters.drop_wrong_language(found).drop("lang_detected")
    if embed is None:
        return kept.drop(*order)
    embedded = settle(kept.withColumn("_vector", embed(F.col("prompt_list"))), "embedded-prompts")
    return dedup.dedup_prompts(
        embedded, "prompt_id", "language", "prompt_list", "_vector", order_by=order
    ).drop("_vector", *order)


def training_rows(answered: DataFrame, load_detector: Callable[[], detect.Detector]) -> DataFrame:
    """Finished, non-leaking answers as ``conversations``.

    ``answered`` has ``language, prompt_list`` and the result struct ``responses``.
    """
    df = answered.withColumn("_answer", F.col("responses.content"))
    df = detect.with_detection(
        df, F.col("_answer"), load_detector, "lang_detected", errors_as_null=False
    )
    df = filters.drop_undetected(df, "lang_detected")
    df = filters.drop_english_leaks(filters.keep_finished(df, "responses"))
    return df.select(
        messages.human_gpt_turns(F.col("prompt_list"), F.col("_answer")).alias("conversations")
    )
