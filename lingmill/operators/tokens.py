"""Token counting, truncation and embedding with pluggable models.

Model-backed columns are declared nondeterministic: Spark then evaluates them
once, where they stand, instead of again in every filter that uses the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import text

Encoder = Callable[[str], list]
Decoder = Callable[[list], str]


def token_count(value: Column, load_encoder: Callable[[], Encoder] | None = None) -> Column:
    """Tokens in a text: SQL words by default, or an encoder loaded once per task."""
    if load_encoder is None:
        return text.word_count(value)

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_encoder()
        for batch in batches:
            yield batch.map(lambda x: None if x is None else len(encode(x)))

    return count.asNondeterministic()(value)


def truncate(
    value: Column,
    limit: int = fixed.ARTICLE_TOKEN_LIMIT,
    load_codec: Callable[[], tuple[Encoder, Decoder]] | None = None,
) -> Column:
    """The first ``limit`` tokens of a text."""
    if load_codec is None:
        return text.truncate_words(value, limit)

    @F.pandas_udf("string")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode, decode = load_codec()
        for batch in batches:
            yield batch.map(lambda x: None if x is None else decode(encode(x)[:limit]))

    return cut.asNondeterministic()(value)


def embed(value: Column, load_model: Callable[[], Callable[[list[str]], list]], batch_rows: int = 12) -> Column:
    """Dense vectors from a model loaded once per task; null text embeds as ``nan``."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for batch in batches:
            vectors: list = []
            for i in range(0, len(batch), batch_rows):
                vectors.extend(model(batch.iloc[i : i + batch_rows].tolist()))
            yield pd.Series(vectors, index=batch.index)

    return run.asNondeterministic()(text.as_text(value))
