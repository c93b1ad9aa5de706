"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models; each sees the words of
the text and the probabilities of the categories before it. A later model is trained on
out-of-fold predictions of the earlier ones, so it learns to use them as good as they
will be on unseen texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingmill.llm.common import slices, texts_of, unchanged
from lingmill.session import settle

# Labelled documents of either label that a fit uses, drawn by hash: the fit's bound.
FIT_ROWS = 3_000
FEATURES = 400
FOLDS = 3
STEPS = 150
MEMO_WORDS = 500_000
PREFIX = 4
THRESHOLD = 0.5

# Words that tell a toxic document's category. Toxic documents with none are "other".
CATEGORIES = {
    "insult": ("idiot", "moron", "stupid", "loser", "clown"),
    "contempt": ("scum", "trash", "worthless", "pathetic", "disgusting"),
}

WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[int]:
    """Feature numbers of a lower-case word: itself, and its beginning."""
    found = [zlib.crc32(word.encode())]
    if len(word) > PREFIX:
        found.append(zlib.crc32(f"^{word[:PREFIX]}".encode()))
    return found


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(inputs: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Weights, the last a constant, of a ridge-penalised logistic regression."""
    inputs = np.column_stack([inputs, np.ones(len(inputs))])
    weights = np.zeros(inputs.shape[1])
    moment = [np.zeros_like(weights), np.zeros_like(weights)]
    for step in range(1, STEPS + 1):
        gradient = inputs.T @ (truth - sigmoid(inputs @ weights)) / len(truth) - 1e-4 * weights
        moment[0] = 0.9 * moment[0] + 0.1 * gradient
        moment[1] = 0.99 * moment[1] + 0.01 * gradient**2
        change = moment[0] / (1 - 0.9**step) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-8)
        weights = weights + 0.2 * (1 - step / (STEPS + 1)) * change
    return weights


def predict(weights: np.ndarray, inputs: np.ndarray) -> np.ndarray:
    return sigmoid(inputs @ weights[:-1] + weights[-1])


@dataclass
class Chain:
    features: np.ndarray  # sorted feature numbers
    names: list[str]
    weights: list[np.ndarray]

    def score(self, present: np.ndarray) -> np.ndarray:
        """Probabilities, a column per category, from 0/1 features."""
        out = np.empty((len(present), 0))
        for weights in self.weights:
            out = np.column_stack([out, predict(weights, np.column_stack([present, out]))])
        return out


def select_features(seen: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """The features whose presence says most about the label, by signed root of likelihood."""
    if not seen:
        return np.empty(0, dtype=np.int64)
    flat = np.concatenate(seen)
    owner = np.repeat(toxic, [len(s) for s in seen])
    found, where = np.unique(flat, return_inverse=True)
    yes = np.bincount(where, weights=owner, minlength=len(found))
    no = np.bincount(where, minlength=len(found)) - yes
    yes_share, no_share = (yes + 0.5) / (toxic.sum() + 1), (no + 0.5) / ((1 - toxic).sum() + 1)
    gain = np.abs(np.log(yes_share / no_share)) * np.abs(yes_share - no_share)
    gain[yes + no < 3] = 0
    best = np.argsort(-gain, kind="stable")[:FEATURES]
    return np.sort(found[best[gain[best] > 0]])


def fit(seen: list[np.ndarray], truth: np.ndarray, names: Sequence[str]) -> Chain:
    """A chain over the columns of ``truth``; the last column is the label itself."""
    features = select_features(seen, truth[:, -1])
    present = np.zeros((len(seen), len(features)))
    for row, numbers in enumerate(seen):
        present[row, np.isin(features, numbers)] = 1
    fold = np.arange(len(seen)) % FOLDS
    earlier = np.empty((len(seen), 0))
    models = []
    for column in truth.T.astype(float):
        inputs = np.column_stack([present, earlier])
        outside = np.empty(len(seen))
        for k in range(FOLDS):
            rest = fold != k
            outside[~rest] = predict(logistic(inputs[rest], column[rest]), inputs[~rest]) if rest.any() else 0.5
        models.append(logistic(inputs, column) if len(seen) else np.zeros(inputs.shape[1] + 1))
        earlier = np.column_stack([earlier, outside])
    return Chain(features, list(names), models)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    categories: Mapping[str, Sequence[str]] = CATEGORIES,
    rows: int = FIT_ROWS,
) -> Chain:
    """Fit on at most ``rows`` labelled documents of either label, drawn by hash.

    The chain is the categories, then ``other``, then the label itself. Rows without a
    key or label are not learned from; of rows that share a key, however many, the least
    text and the least label are. Without rows every probability is one half.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(
        F.min(F.col(label).cast("int")).alias("__label")
    )
    draws = [
        known.where(F.col("__label") == value).orderBy(F.xxhash64(key, F.lit("toxic")), key).limit(rows)
        for value in (0, 1)
    ]
    drawn = settle(draws[0].union(draws[1]), "fit-rows")
    chosen = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(
        drawn, F.col("__key") == F.col(key)
    ).groupBy("__key", "__label").agg(F.min("__text").alias("__text"))
    words = {name: frozenset(members) for name, members in categories.items()}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            out = []
            for one, mark in zip(texts_of(batch.column("__text")), batch.column("__label").to_pylist()):
                found = set(WORD.findall(one.lower()))
                kinds = [int(mark and not members.isdisjoint(found)) for members in words.values()]
                numbers = np.unique([n for w in found for n in features_of(w)]).astype("<i8")
                out.append((numbers.tobytes(), [*kinds, int(mark and not any(kinds)), mark]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__key"), pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.list_(pa.int32()))],
                ["key", "features", "truth"],
            )

    schema = T.StructType([
        T.StructField("key", chosen.schema["__key"].dataType),
        T.StructField("features", T.BinaryType()), T.StructField("truth", T.ArrayType(T.IntegerType())),
    ])
    measured = chosen.mapInArrow(measure, schema).toPandas().sort_values(["key", "features"], kind="stable")
    names = [*categories, "other", label]
    truth = np.array(measured["truth"].tolist(), dtype=np.int64).reshape(-1, len(names))
    return fit([np.frombuffer(x, "<i8") for x in measured["features"]], truth, names)


def with_toxicity(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """``docs`` with a column ``p_<category>`` for each link of the chain.

    The whole text counts. Null and empty texts have no words and get the chain's base
    rates. Columns of these names are replaced. Rows are independent; one scan, no shuffle.
    """
    added = [f"p_{name}" for name in chain.names]
    names = unchanged(docs, *added)
    schema = T.StructType([*(docs.schema[c] for c in names), *(T.StructField(c, T.DoubleType()) for c in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = {int(number): i for i, number in enumerate(chain.features)}
        memo: dict[str, tuple[int, ...]] = {}
        for batch in slices(batches):
            present = np.zeros((batch.num_rows, len(column)))
            for row, one in enumerate(texts_of(batch.column(text))):
                for word in set(WORD.findall(one.lower())):
                    hit = memo.get(word)
                    if hit is None:
                        if len(memo) >= MEMO_WORDS:
                            memo.clear()
                        hit = memo[word] = tuple(column[n] for n in features_of(word) if n in column)
                    for place in hit:
                        present[row, place] = 1
            scores = chain.score(present)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *(pa.array(scores[:, k]) for k in range(len(added)))], [*names, *added]
            )

    return docs.mapInArrow(run, schema)
