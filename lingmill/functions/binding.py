"""Computing a value once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    Plain reuse of a Column inside lambdas would repeat its work for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters and projections will not recompute.

    The optimizer pushes filters below a plain projection by repeating its
    expressions; it does not do so below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
