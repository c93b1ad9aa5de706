"""The registry itself, and a spread of its queries against their SQL at the smallest scale.

``python -m suite.check`` compares all of them.
"""

import pytest

import __spark_entry__ as entry
from suite import check
from suite.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SPREAD = [
    "prompt_language_shares",
    "language_agreement",
    "length_histogram",
    "large_sample_per_language",
    "row_chunks",
    "near_duplicates",
    "ballot_status",
    "long_ballots",
    "best_and_worst_models",
    "numbered_list_items",
    "marked_replies",
    "cluster_labels",
    "scored_replies",
    "stored_rounds",
    "fitted_clusters",
    "packed_sequences",
    "learned_language_detection",
    "streamed_calls",
]


@pytest.fixture(scope="module")
def con():
    return check.open_tables(SF)


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", SPREAD)
def test_query_equals_its_sql(spark, con, name):
    verdict = check.compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert verdict.startswith("ok"), verdict


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["language", "n", "share"]
