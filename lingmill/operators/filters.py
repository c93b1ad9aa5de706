"""Row filters. Cheap string filters come first so that detectors and
tokenizers, which Catalyst cannot reorder, see as few rows as possible."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import messages, text


def drop_flagged(df: DataFrame, moderation: str = "openai_moderation") -> DataFrame:
    """Drop rows whose first moderation record has any true category."""
    return df.where(~messages.flagged(F.col(moderation)))


def drop_languages(
    df: DataFrame, language: str = "language", names: Sequence[str] = tuple(fixed.UNUSABLE_LANGUAGES)
) -> DataFrame:
    """Drop listed language names or codes; a missing name is kept."""
    return df.where(F.col(language).isNull() | ~F.col(language).isin(list(names)))


def keep_languages(df: DataFrame, language: str, names: Sequence[str]) -> DataFrame:
    """Keep listed language names or codes only (prunes partitions)."""
    return df.where(F.col(language).isin(list(names)))


def requested_languages(df: DataFrame, language: str = "language") -> DataFrame:
    """The languages, by name, that prompt lists are asked for; each once."""
    return keep_languages(df.select(language), language, fixed.REQUESTED_LANGUAGES).distinct()


def drop_blocked(
    df: DataFrame, prompt: Column, words: Sequence[str] = tuple(fixed.BLOCKED_SUBSTRINGS)
) -> DataFrame:
    """Drop rows whose prompt contains any blocked substring, ignoring case."""
    return df.where(~text.contains_any(prompt, words))


def drop_short(df: DataFrame, prompt: Column, longer_than: int = 1) -> DataFrame:
    """Keep prompts longer than ``longer_than`` characters once stripped."""
    return df.where(F.length(text.strip(prompt)) > longer_than)


def drop_undetected(df: DataFrame, detection: str) -> DataFrame:
    return df.where(F.col(detection).isNotNull())


def drop_long(df: DataFrame, tokens: Column, limit: int = fixed.MAX_FIRST_EXCHANGE_TOKENS) -> DataFrame:
    """Keep rows of fewer than ``limit`` tokens."""
    return df.where(tokens < limit)


def keep_finished(df: DataFrame, answer: str) -> DataFrame:
    """Keep answers that ended by themselves (``finish_reason = 'stop'``)."""
    return df.where(F.col(answer)["finish_reason"] == "stop")


def drop_incomplete_rows(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any column."""
    return df.na.drop("any")


def language_names(spark: SparkSession) -> DataFrame:
    """The fixed name-to-code table: ``language``, ``code``.

    A local relation, so its size is known and joins with it broadcast.
    """
    pairs = fixed.LANGUAGE_NAME_TO_CODE
    return spark.createDataFrame(
        pa.table({"language": list(pairs.keys()), "code": list(pairs.values())})
    )


def judge_agreement(
    df: DataFrame,
    names: DataFrame,
    language: str = "language",
    detection: str = "lang_detect_result",
    confidence: float = fixed.DETECTION_CONFIDENCE,
) -> DataFrame:
    """Add ``agreement``: kept, low_score, mismatch or unmapped.

    A declared name that ``names`` lacks matters only when the score passes.
    ``names`` has one row per language name; Spark broadcasts it by its known size.
    """
    lookup = names.select(F.col("language").alias(language), F.col("code").alias("_code"))
    status = (
        F.when(~(F.col(detection)["score"] > confidence), "low_score")
        .when(F.col("_code").isNull(), "unmapped")
        .when(F.col(detection)["lang"] == F.col("_code"), "kept")
        .otherwise("mismatch")
    )
    return (
        df.join(lookup, language, "left")
        .withColumn("agreement", status)
        .drop("_code")
    )


def keep_agreeing(df: DataFrame, names: DataFrame, **columns) -> DataFrame:
    """Rows whose confident detection equals the declared language."""
    return judge_agreement(df, names, **columns).where("agreement = 'kept'").drop("agreement")


def unmapped_languages(df: DataFrame, names: DataFrame, **columns) -> DataFrame:
    """Quarantine: confidently detected rows whose declared name has no code."""
    return judge_agreement(df, names, **columns).where("agreement = 'unmapped'").drop("agreement")


def drop_english_leaks(
    df: DataFrame,
    language: str = "language",
    detection: str = "lang_detected",
    confidence: float = fixed.DETECTION_CONFIDENCE,
) -> DataFrame:
    """Drop confident English where another language was declared.

    Kept: any declared name containing "English", any other detection, and a
    score strictly below the cut.
    """
    found = F.col(detection)
    return df.where(
        F.col(language).contains("English")
        | (found["lang"] != "en")
        | (found["score"] < confidence)
    )


def drop_wrong_language(
    df: DataFrame,
    language: str = "language",
    prompt: str = "prompt_list",
    detection: str = "lang_detected",
    confidence: float = fixed.DETECTION_CONFIDENCE,
) -> DataFrame:
    """Drop confident English or Japanese prompts declared as something else.

    The cut is exclusive. Rows with no prompt stay; detection is read once.
    """
    found = F.col(detection)

    def leaked(code: str, declared: Sequence[str]) -> Column:
        sure = (found["lang"] == code) & (found["score"] > confidence)
        outside = F.coalesce(~F.col(language).isin(list(declared)), F.lit(True))
        return F.coalesce(F.col(prompt).isNotNull() & sure, F.lit(False)) & outside

    wrong = leaked("en", fixed.ENGLISH_NAMES) | leaked("ja", fixed.JAPANESE_NAMES)
    return df.where(~wrong)
