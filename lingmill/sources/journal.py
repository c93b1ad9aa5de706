"""A journal of costly answers, which a run that failed is resumed from."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lingmill.session import new_table_path
from lingmill.sources import writers

# Appends of one entry: at most so large a share of the answers is lost with a run.
COMMITS = 8


@dataclass(frozen=True)
class Journal:
    """Answers below ``path``, one folder an entry, written in ``commits`` appends by key hash.

    An append is a Spark write of its own: it is there as a whole, or not at all. Rows whose
    key an entry holds are not asked again, whatever became of the run that wrote it.
    Keys are not null. Answers are kept as they came, failures included.
    """

    path: str
    commits: int = COMMITS

    @classmethod
    def fresh(cls, spark: SparkSession, label: str) -> Journal:
        """A journal in the shared folder that only this run knows, written in one go."""
        return cls(new_table_path(spark, label), 1)

    def answers(self, df: DataFrame, key: Sequence[str], work: Callable[[DataFrame], DataFrame], entry: str) -> DataFrame:
        """What ``work`` makes of all rows of ``df``, from the entry where it holds them."""
        stored = writers.resume_into(df, f"{self.path}/{entry}", key, work, self.commits)
        # A journal may hold answers to rows that are not asked about this time.
        return stored.join(df.select(*key), list(key), "left_semi") if self.commits > 1 else stored
