"""Long articles, cluster-stratified titles and the articles behind them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import text
from lingmill.operators import clusters, sampling
from lingmill.session import settle


def long_articles(chunks: DataFrame, chunk_id: str = "_id", groups: Sequence[str] = ("lang",)) -> DataFrame:
    """Stems with more than one chunk: ``groups, id_stem, n_chunks``."""
    return (
        chunks.groupBy(*groups, text.id_stem(F.col(chunk_id)).alias("id_stem"))
        .agg(F.count(F.lit(1)).alias("n_chunks"))
        .where(F.col("n_chunks") > 1)
    )


def first_chunks(
    chunks: DataFrame, chunk_id: str = "_id", groups: Sequence[str] = ("lang",)
) -> DataFrame:
    """Chunk 0 of every long article, with its ``id_stem``."""
    heads = chunks.where(text.id_tail(F.col(chunk_id)) == "0").withColumn(
        "id_stem", text.id_stem(F.col(chunk_id))
    )
    # The long side carries no text or vectors.
    stems = long_articles(chunks, chunk_id, groups).select(*groups, "id_stem")
    return heads.join(stems, [*groups, "id_stem"], "left_semi")


def title_clusters(
    chunks: DataFrame,
    k: int = fixed.CLUSTERS_PER_LANGUAGE,
    language: str = "lang",
    vector: str = "emb",
    batches: int = 5,
    seed: int = 0,
) -> DataFrame:
    """``language, title, label, url`` of all long articles, every language at once."""
    # Stored once: the fit and the labels read it several times, the chunks are far larger.
    heads = settle(
        first_chunks(chunks, "_id", [language]).select("_id", "title", "url", language, vector), "article-heads"
    )
    centroids = clusters.fit_clusters(heads, "_id", language, vector, k, batches, seed)
    return clusters.label_rows(heads, centroids, "_id", language, vector).select(
        language, "title", "label", "url"
    )


def sampled_titles(
    titles: DataFrame, per_cluster: int, language: str = "lang", seed: int = 0
) -> DataFrame:
    """Up to ``per_cluster`` titles of every cluster: ``language, title``."""
    drawn = sampling.sample_per_group(
        titles, [language, "label"], [language, "label", "title", "url"], per_cluster, seed
    )
    return drawn.select(language, "title").distinct()


def articles_by_title(
    articles: DataFrame, titles: DataFrame, language: str = "language_code"
) -> DataFrame:
    """Articles whose (language, title) was drawn; repeated titles change nothing."""
    return articles.join(titles.select(language, "title"), [language, "title"], "left_semi")


def sampled_articles(
    titles: DataFrame,
    articles: DataFrame,
    per_cluster: int,
    languages: Sequence[str] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Articles of drawn titles, for all languages or a list of codes."""
    if languages is not None:
        titles = titles.where(F.col("lang").isin(list(languages)))
        articles = articles.where(F.col("language_code").isin(list(languages)))
    drawn = sampled_titles(titles, per_cluster, "lang", seed)
    # Written first, so that the join knows how few titles meet the articles' texts.
    titles = settle(drawn.withColumnRenamed("lang", "language_code"), "drawn-titles")
    return articles_by_title(articles, titles)


def article_sets(titles: DataFrame, articles: DataFrame, seed: int = 0) -> dict[str, DataFrame]:
    """One article a cluster in every language, and ten in those of ``fixed.POPULAR_LANGUAGE_CODES``."""
    return {
        "every": sampled_articles(titles, articles, 1, seed=seed),
        "popular": sampled_articles(titles, articles, 10, fixed.POPULAR_LANGUAGE_CODES, seed),
    }


def generation_inputs(
    articles: DataFrame,
    names: DataFrame,
    key: Sequence[str] = ("language_code", "title"),
    seed: int = 0,
) -> DataFrame:
    """Articles with ``language_name``, ``prompt_type`` and ``prompt_category``.

    ``names`` maps ``language_code`` to ``language_name``. Codes it lacks come
    out with a null name, for the caller to set aside.
    """
    # Written first: with its true size a small table is broadcast, and articles stay in place.
    names = settle(names.select("language_code", "language_name"), "language-names")
    typed = (
        articles.where(~F.col("language_code").isin(fixed.EXCLUDED_LANGUAGE_CODES))
        .join(names, "language_code", "left")
        .withColumn("prompt_type", sampling.draw_prompt_type(key, seed))
    )
    return typed.withColumn(
        "prompt_category", sampling.draw_prompt_category(F.col("prompt_type"), key, seed)
    )
