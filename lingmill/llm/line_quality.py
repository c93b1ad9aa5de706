"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Its evidence is its own features and those of the lines
before and after it; neighbouring labels are coupled. A document's score is the
length-weighted mean of its lines' probabilities of being good, calibrated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingmill.llm.common import slices, texts_of, unchanged
from lingmill.session import settle

# Labelled documents that a fit uses, drawn by hash. The bound of the fit's memory.
FIT_ROWS = 4_000
# Lines of a training chain; longer documents are several chains.
CHAIN_LINES = 64
STEPS = 200
SCORE_ROWS = 2_048
THRESHOLD = 0.7

KINDS = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c",
    b".", b",;:", b"!?", b"|", b"#$%&*^~+=@_", b"<>{}[]()/\\", b"'\"`-", bytes(range(128, 256)),
)


def kind_table() -> np.ndarray:
    """The kind of each byte value; the last kind holds the rest."""
    table = np.full(256, len(KINDS), dtype=np.int64)
    for number, members in enumerate(KINDS):
        table[np.frombuffer(members, np.uint8)] = number
    return table


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features per line, bytes per line, lines per text); an empty text has one empty line."""
    counts = np.array([text.count("\n") + 1 for text in texts], dtype=np.int64)
    data = np.frombuffer(("\n".join(texts) + "\n").encode(), np.uint8)
    ends = np.flatnonzero(data == 10)
    sizes = np.diff(np.concatenate([[-1], ends]))
    lines = len(ends)
    width = len(KINDS) + 1
    place = np.repeat(np.arange(lines) * width, sizes) + kind_table()[data]
    kinds = np.bincount(place, minlength=lines * width).reshape(lines, width).astype(np.float64)
    kinds[:, -1] -= 1  # the line's end
    length = sizes - 1.0
    safe = np.maximum(length, 1)
    words = kinds[:, 3] + 1
    letters = kinds[:, 0] + kinds[:, 1] + kinds[:, -2]
    last = data[np.maximum(ends - 1, 0)]
    repeated, distinct = np.empty(lines), np.empty(lines)
    at = 0
    for text in texts:
        seen: set[str] = set()
        for line in text.split("\n"):
            repeated[at] = line in seen
            seen.add(line)
            found = line.split()
            distinct[at] = (len(set(found)) + 1) / (len(found) + 1)
            at += 1
    ended = (length > 0) & np.isin(last, np.frombuffer(b".!?", np.uint8))
    features = np.column_stack([
        kinds / safe[:, None], kinds[:, 1] / np.maximum(letters, 1), letters / words,
        np.log1p(length), np.log1p(words), kinds[:, 4] / words, kinds[:, 6] / words,
        kinds[:, 8] / words, kinds[:, 7] / words, repeated, distinct, ended, length == 0,
    ])
    return features, length, counts


def with_neighbours(features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after it, and a constant;
    zeros beyond a document's ends."""
    firsts = np.cumsum(counts) - counts
    before = np.zeros_like(features)
    before[1:] = features[:-1]
    before[firsts] = 0
    after = np.zeros_like(features)
    after[:-1] = features[1:]
    after[firsts + counts - 1] = 0
    return np.column_stack([features, before, after, np.ones(len(features))])


def marginals(
    evidence: np.ndarray, counts: np.ndarray, couple: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many chains at once.

    ``evidence`` is the log odds of good by line. Returns the probability of good by
    line, and the expected number of label pairs (2 x 2) over all chains.
    """
    firsts = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    sorted_counts, sorted_firsts = counts[order], firsts[order]
    longest = int(counts.max(initial=0))
    # Chains that have a line t are a prefix of the sorted ones.
    active = np.searchsorted(-sorted_counts, -np.arange(longest + 1), side="left")
    local = np.column_stack([1 / (1 + np.exp(np.clip(evidence, -40, 40))), 1 / (1 + np.exp(np.clip(-evidence, -40, 40)))])
    step = np.exp(couple)
    forward = np.empty_like(local)
    backward = np.ones_like(local)
    for t in range(longest):
        here = sorted_firsts[: active[t]] + t
        mass = local[here] if t == 0 else (forward[here - 1] @ step) * local[here]
        forward[here] = mass / mass.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        here = sorted_firsts[: active[t + 1]] + t
        mass = (backward[here + 1] * local[here + 1]) @ step.T
        backward[here] = mass / mass.sum(axis=1, keepdims=True)
    both = forward * backward
    good = both[:, 1] / both.sum(axis=1)
    inner = np.ones(len(evidence), dtype=bool)
    inner[firsts + counts - 1] = False
    here = np.flatnonzero(inner)
    right = local[here + 1] * backward[here + 1]
    joint = forward[here][:, :, None] * step[None] * right[:, None, :]
    pairs = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return good, pairs


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    couple: np.ndarray
    slope: float
    offset: float

    def score(self, texts: list[str]) -> np.ndarray:
        features, length, counts = line_features(texts)
        inputs = with_neighbours((features - self.mean) / self.scale, counts)
        good, _ = marginals(inputs @ self.weights, counts, self.couple)
        odds = self.slope * document_odds(good, length, counts) + self.offset
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def document_odds(good: np.ndarray, length: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log odds of the length-weighted mean; a line's end counts as one byte."""
    firsts = np.cumsum(counts) - counts
    weight = length + 1
    share = np.add.reduceat(good * weight, firsts) / np.add.reduceat(weight, firsts)
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return np.log(share / (1 - share))


def fit(features: np.ndarray, length: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Model:
    """Maximum conditional likelihood, every line of a document carrying its label.

    Both labels weigh the same. Without two labels to learn from, every score is the
    share of label 1 (one half without rows).
    """
    width = 3 * features.shape[1] + 1
    base = float(labels.mean()) if len(labels) else 0.5
    flat = Model(
        np.zeros(features.shape[1]), np.ones(features.shape[1]), np.zeros(width), np.zeros((2, 2)),
        0.0, float(np.log((base + 1e-6) / (1 - base + 1e-6))),
    )
    if len(set(labels.tolist())) < 2:
        return flat
    mean = features.mean(axis=0)
    scale = np.maximum(features.std(axis=0), 1e-3)
    inputs = with_neighbours((features - mean) / scale, counts)
    # Long documents become several chains of the same label.
    pieces = -(-counts // CHAIN_LINES)
    chains = np.full(pieces.sum(), CHAIN_LINES)
    chains[np.cumsum(pieces) - 1] = counts - (pieces - 1) * CHAIN_LINES
    truth = np.repeat(labels, counts).astype(np.float64)
    share = truth.mean()
    by_line = np.where(truth == 1, 0.5 / share, 0.5 / (1 - share))
    # A document counts once however many lines it has, up to the square root.
    by_line = by_line / np.sqrt(np.repeat(counts, counts))
    by_line /= by_line.mean()
    chain_first = np.cumsum(chains) - chains
    chain_truth = truth[chain_first].astype(int)
    wanted = np.zeros((2, 2))
    np.add.at(wanted, (chain_truth, chain_truth), chains - 1)
    weights, couple = np.zeros(width), np.zeros((2, 2))
    moment = [np.zeros(width + 4), np.zeros(width + 4)]
    lines = len(truth)
    for step in range(1, STEPS + 1):
        good, pairs = marginals(inputs @ weights, chains, couple)
        slope = inputs.T @ ((truth - good) * by_line) / lines - 1e-4 * weights
        turn = (wanted - pairs).ravel() / lines - 1e-2 * couple.ravel()
        gradient = np.concatenate([slope, turn])
        moment[0] = 0.9 * moment[0] + 0.1 * gradient
        moment[1] = 0.99 * moment[1] + 0.01 * gradient**2
        change = moment[0] / (1 - 0.9**step) / (np.sqrt(moment[1] / (1 - 0.99**step)) + 1e-8)
        rate = 0.1 * (1 - step / (STEPS + 1))
        weights = weights + rate * change[:width]
        couple = couple + rate * change[width:].reshape(2, 2)
    model = Model(mean, scale, weights, couple, 1.0, 0.0)
    good, _ = marginals(inputs @ weights, counts, couple)
    model.slope, model.offset = calibrate(document_odds(good, length, counts), labels)
    return model


def calibrate(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve, by damped Newton steps."""
    inputs = np.column_stack([odds, np.ones(len(odds))])
    found = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(inputs @ found, -40, 40)))
        gradient = inputs.T @ (labels - p) - 1e-2 * found
        curve = (inputs * (p * (1 - p))[:, None]).T @ inputs + 1e-1 * np.eye(2)
        found = found + np.clip(np.linalg.solve(curve, gradient), -0.5, 0.5)
    return max(float(found[0]), 1e-3), float(found[1])


def held_out(key: str) -> Column:
    """Rows never learned from: CRC-32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
    label: str = "quality", rows: int = FIT_ROWS,
) -> Model:
    """Fit on at most ``rows`` labelled documents that are not held out, drawn by hash.

    Line features are computed where the texts are; only they reach the driver. Rows
    without a label or key are not learned from; of rows that share a key, however many,
    the least text and the least label are.
    """
    drawn = settle(
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
        .groupBy(key).agg(F.min(F.col(label).cast("int")).alias("__label"))
        .orderBy(F.xxhash64(key, F.lit("fit")), key).limit(rows),
        "fit-rows",
    )
    texts = docs.select(key, docs[text].alias("__text")).join(drawn, key)
    chosen = texts.groupBy(key, "__label").agg(F.min("__text").alias("__text")).select("__text", "__label")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            for one, mark in zip(texts_of(batch.column("__text")), batch.column("__label").to_pylist()):
                features, length, _ = line_features([one])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([mark], pa.int32()), pa.array([features.astype("<f4").tobytes()]), pa.array([length.astype("<f8").tobytes()])],
                    ["label", "features", "length"],
                )

    measured = chosen.mapInArrow(measure, "label int, features binary, length binary").toPandas()
    # Rows arrive in any order; the sum of a fit must not depend on it.
    measured = measured.sort_values(["label", "length", "features"], kind="stable")
    length = [np.frombuffer(x, "<f8") for x in measured["length"]]
    counts = np.array([len(x) for x in length], dtype=np.int64)
    width = line_features([""])[0].shape[1]
    features = np.frombuffer(b"".join(measured["features"]), "<f4").reshape(-1, width).astype(np.float64)
    return fit(features, np.concatenate([*length, np.empty(0)]), counts, measured["label"].to_numpy())


def with_score(
    docs: DataFrame, model: Model, text: str = "text", score: str = "score"
) -> DataFrame:
    """``docs`` with the quality of every whole text, in one scan without a shuffle.

    Only the text is looked at. A null or empty text is one empty line. A column of the
    score's name is replaced.
    """
    names = unchanged(docs, score)
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SCORE_ROWS, text):
            found = model.score(texts_of(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found)], [*names, score])

    return docs.mapInArrow(run, schema)
