"""Language detection: a pluggable detector, and a default one learned from
labelled text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill import schemas
from lingmill.functions import text

Detector = Callable[[Sequence[str]], list]

PROFILE_CELLS = 1 << 12
# Texts, and characters of them, that are counted together.
SLICE_TEXTS = 256
SLICE_CHARS = 1 << 21
# --- fixed values: multipliers of the three-character hash
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def with_detection(
    df: DataFrame,
    value: Column,
    load_detector: Callable[[], Detector],
    name: str = "lang_detect_result",
    errors_as_null: bool = True,
) -> DataFrame:
    """Add ``struct<lang, score>``, null where nothing was detected.

    Newlines become spaces first.

    ``load_detector`` runs once per task and returns a function from a batch of
    texts to one ``(lang, score)`` or None for each. With ``errors_as_null`` a
    text that makes it raise gets null; otherwise the error fails the job.
    """

    def one(detector: Detector, item: str):
        try:
            return detector([item])[0]
        except Exception:
            if errors_as_null:
                return None
            raise

    @F.pandas_udf(schemas.DETECTION)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        detector = load_detector()
        for batch in batches:
            given = batch.notna()
            found = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            texts = batch[given].tolist()
            if texts:
                try:
                    results = detector(texts)
                except Exception:
                    results = [one(detector, item) for item in texts]
                for at, result in zip(batch.index[given], results):
                    found[at] = result
            yield pd.DataFrame(
                {
                    "lang": [None if r is None else r[0] for r in found],
                    "score": [None if r is None else float(r[1]) for r in found],
                }
            )

    # Declared nondeterministic so that later filters on the result are not pushed
    # below it, which would run the detector a second time.
    found = run.asNondeterministic()(text.newlines_to_spaces(value))
    return (
        df.withColumn("_found", found)
        .withColumn(name, F.when(F.col("_found.lang").isNotNull(), F.col("_found")))
        .drop("_found")
    )


def _slices(texts: Sequence[str]) -> Iterator[list[str]]:
    """The texts in lists that are short enough to look at together."""
    held, size = [], 0
    for item in texts:
        held.append(item)
        size += len(item)
        if len(held) == SLICE_TEXTS or size >= SLICE_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _cell_counts(texts: list[str]) -> np.ndarray:
    """How often each hash cell occurs among all three-character runs of each whole text."""
    spelled = [f" {item.lower()} ".ljust(3, "\0") for item in texts]
    points = np.frombuffer("".join(spelled).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    mixed = points[:-2] * _MIX[0]
    mixed += points[1:-1] * _MIX[1]
    mixed += points[2:] * _MIX[2]
    # The top 12 bits are the best mixed ones and number the 4,096 cells.
    mixed >>= 20
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in spelled])
    # Runs across two texts are none.
    inside = owner[:-2] == owner[2:]
    cells = owner[:-2][inside] * PROFILE_CELLS + mixed[inside]
    return np.bincount(cells, minlength=len(texts) * PROFILE_CELLS).reshape(len(texts), PROFILE_CELLS)


def learn_profiles(df: DataFrame, value: str, language: str) -> DataFrame:
    """``lang, cell, n``: how often each hash cell occurs per language.

    Tasks count whole texts into one small table per language, so at most
    (languages x cells) rows a task are shuffled, whatever the text volume.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, items in batch.dropna().groupby("lang")["text"]:
                own = totals.setdefault(lang, np.zeros(PROFILE_CELLS, dtype=np.int64))
                for held in _slices(items.tolist()):
                    own += _cell_counts(held).sum(axis=0)
        for lang, own in totals.items():
            used = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "cell": used, "n": own[used]})

    pairs = df.select(F.col(language).alias("lang"), F.col(value).alias("text"))
    return (
        pairs.mapInPandas(count, "lang string, cell long, n long")
        .groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
    )


def profile_detector(profiles: DataFrame) -> Callable[[], Detector]:
    """A detector loader from learned profiles.

    The profiles come to the driver: at most 4,096 counts per language. The score
    is the posterior of the best language, tempered by text length so that short
    texts are less certain.
    """
    counts = profiles.toPandas().pivot(index="lang", columns="cell", values="n")
    counts = counts.reindex(columns=range(PROFILE_CELLS)).fillna(0.0).sort_index()
    languages = counts.index.tolist()
    smoothed = counts.to_numpy() + 0.5
    logs = np.log(smoothed / smoothed.sum(axis=1, keepdims=True)).T.copy()

    def load() -> Detector:
        def detector(texts: Sequence[str]) -> list:
            out: list = []
            for held in _slices(texts):
                seen = _cell_counts(held)
                # All texts of a slice against all languages at once.
                total = seen.astype(np.float64) @ logs / np.sqrt(seen.sum(axis=1, keepdims=True))
                weights = np.exp(total - total.max(axis=1, keepdims=True))
                best = weights.argmax(axis=1)
                scores = weights[np.arange(len(held)), best] / weights.sum(axis=1)
                out += [
                    (languages[k], score) if item.strip() else None for item, k, score in zip(held, best.tolist(), scores.tolist())
                ]
            return out

        return detector

    return load
