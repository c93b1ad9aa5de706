"""Chat logs to curated prompts, and answered prompts to training rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import messages
from lingmill.operators import dedup, detect, filters, sampling, tokens
from lingmill.session import settle


def clean_chats(
    chats: DataFrame,
    words: Sequence[str] = tuple(fixed.BLOCKED_SUBSTRINGS),
    first_role: str | None = None,
) -> DataFrame:
    """Moderation, language-name, keyword and length filters: one narrow stage."""
    prompt = messages.first_message(F.col("conversation"), first_role)
    df = filters.drop_flagged(chats)
    df = filters.drop_languages(df)
    df = filters.drop_blocked(df, prompt, words)
    return filters.drop_short(df, prompt)


def curate_prompts(
    chats: DataFrame,
    load_detector: Callable[[], detect.Detector],
    key: str = "conversation_id",
    load_encoder: Callable[[], tokens.Encoder] | None = None,
    per_language: int = fixed.PROMPTS_PER_LANGUAGE,
    vector: str | None = None,
    embed: Callable[[Column], Column] | None = None,
    threshold: float = fixed.NEAR_DUPLICATE_DOT,
    confidence: float = fixed.DETECTION_CONFIDENCE,
    seed: int = 0,
    deduplicate: bool = True,
) -> DataFrame:
    """Filter, check language and length, sample per language, drop near duplicates.

    Vectors come from column ``vector`` or are made by ``embed`` from the prompt; one of
    them is needed unless ``deduplicate`` is false.
    What the detector, tokenizer and embedder have made is written out before the
    steps that read it more than once, so each of them sees a row once.
    """
    if deduplicate and vector is None and embed is None:
        raise ValueError("near duplicates need a vector column or an embedder")
    prompt = messages.first_message(F.col("conversation"))
    df = detect.with_detection(clean_chats(chats), prompt, load_detector)
    df = filters.drop_undetected(df, "lang_detect_result")
    names = filters.language_names(chats.sparkSession)
    df = filters.keep_agreeing(df, names, confidence=confidence)
    count = tokens.token_count(messages.first_exchange(F.col("conversation")), load_encoder)
    df = df.withColumn("first_exchange_len_tokens", count)
    df = settle(filters.drop_long(df, F.col("first_exchange_len_tokens")), "clean-chats")
    df = sampling.sample_per_group(df, ["language"], [key], per_language, seed)
    if not deduplicate:
        return df
    if vector is None:
        vector = "_vector"
        df = df.withColumn(vector, embed(prompt))
    df = settle(df, "sampled-chats")
    out = dedup.drop_near_duplicates(df, key, "language", vector, [key], threshold)
    return out.drop("_vector")


def chat_training_rows(answered: DataFrame) -> DataFrame:
    """Answered chats as ``conversation_id, conversations, language, lang_detect_result, response``."""
    prompt = messages.first_message(F.col("conversation"))
    turns = messages.human_gpt_turns(prompt, F.col("response.content"))
    return answered.withColumn("conversations", turns).select(
        "conversation_id", "conversations", "language", "lang_detect_result", "response"
    )
