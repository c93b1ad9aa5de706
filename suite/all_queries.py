"""Imports every module that registers queries."""

from suite import (  # noqa: F401
    articles,
    calls,
    curation,
    draws,
    duplicates,
    files,
    preferences,
    summaries,
    texts,
    training,
)
