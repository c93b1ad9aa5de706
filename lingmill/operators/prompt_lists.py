"""Numbered prompt lists from generation requests, as one prompt a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingmill.functions import text


def explode_prompt_lists(
    df: DataFrame,
    keep: Sequence[str] = ("language", "finish_reason"),
    generated: str = "gen_prompts",
    name: str = "prompt_list",
    position: str | None = None,
) -> DataFrame:
    """One row per list item, stripped; a list without items gives one null row."""
    items = text.numbered_items(F.col(generated))
    at, item = position or "_at", "_item"
    rows = df.select(*keep, F.posexplode_outer(items).alias(at, item))
    out = rows.withColumn(name, text.strip(F.col(item))).drop(item)
    return out if position else out.drop(at)
