"""Embedded article chunks to generated and scored prompt/response pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.operators import articles, inference
from lingmill.session import settle
from lingmill.sources.journal import Journal


def select_articles(
    chunks: DataFrame,
    texts: DataFrame,
    per_cluster: int,
    k: int = fixed.CLUSTERS_PER_LANGUAGE,
    languages: Sequence[str] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Long articles clustered per language, sampled per cluster, with their texts."""
    titles = settle(articles.title_clusters(chunks, k, seed=seed), "titles")
    return articles.sampled_articles(titles, texts, per_cluster, languages, seed)


def generate_pairs(
    selected: DataFrame,
    names: DataFrame,
    call: inference.Call,
    kind: str = "article_pair_by_category",
    key: Sequence[str] = ("language_code", "title"),
    seed: int = 0,
    journal: Journal | None = None,
    **options,
) -> DataFrame:
    """Articles with ``generated_prompt_response``, stored part by part in the journal.

    Articles whose language has no name cannot be asked about; ``unnamed_articles`` holds them.
    """
    inputs = articles.generation_inputs(selected, names, key, seed).where("language_name is not null")
    requests = inference.article_requests(inputs, kind)
    return inference.run_stored(
        requests,
        key,
        call,
        journal,
        inputs=("system", "prompt"),
        result="generated_prompt_response",
        entry="pairs",
        carry=inputs.columns,
        **options,
    )


def unnamed_articles(selected: DataFrame, names: DataFrame) -> DataFrame:
    """The articles that ``generate_pairs`` sets aside for want of a language name."""
    named = names.where("language_name is not null").select("language_code")
    excluded = F.coalesce(F.col("language_code").isin(fixed.EXCLUDED_LANGUAGE_CODES), F.lit(False))
    return selected.where(~excluded).join(named, "language_code", "left_anti")


def revise_pairs(
    pairs: DataFrame, key: Sequence[str], call: inference.Call, journal: Journal | None = None, **options
) -> DataFrame:
    """Input/target pairs with ``gen_input_outputs`` and ``finish_reason``; nulls on failure.

    Answers are stored part by part in the journal.
    """
    requests = inference.revision_requests(pairs)
    results = inference.run_stored(
        requests,
        key,
        call,
        journal,
        entry="revisions",
        inputs=("system", "prompt", "max_tokens"),
        carry=pairs.columns,
        **options,
    )
    return results.selectExpr(
        *pairs.columns,
        "result.content as gen_input_outputs",
        "result.finish_reason as finish_reason",
    )
