"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lingmill.llm.common import slices, texts_of

# Test items of one pass, and bytes of their texts: bounds what is sent to the executors. Larger sets
# take more passes.
ITEMS_AT_ONCE = 20_000
BYTES_AT_ONCE = 1 << 24
SEED_WORDS = 3
# Share of an item's n-grams, rarest first, that serve as seeds.
SEED_SHARE = 0.75
MISMATCH = -0.5
GAP = -0.5
THRESHOLD = 0.5
MEMO_ALIGNMENTS = 100_000

WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: (score, start, end) with [start, end) in the passage.

    An equal word scores 1, an unequal one and a gap of one word cost a half. Word 0
    stands for any word that no item has, and equals nothing.
    """
    size = len(passage)
    drop = -GAP * np.arange(1, size + 1)
    above, origin = np.zeros(size + 1), np.arange(size + 1)
    best = (0.0, 0, 0)
    for word in item:
        diagonal = above[:-1] + np.where((passage == word) & (word != 0), 1.0, MISMATCH)
        up = above[1:] + GAP
        here = np.maximum(np.maximum(diagonal, up), 0.0)
        start = np.where(here == 0, np.arange(1, size + 1), np.where(here == diagonal, origin[:-1], origin[1:]))
        lifted = here + drop
        run = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == run, np.arange(size), 0))
        here = run - drop
        start = np.where(here > 0, start[source], np.arange(1, size + 1))
        top = int(here.argmax()) if size else 0
        if size and here[top] > best[0]:
            best = (float(here[top]), int(start[top]), top + 1)
        above = np.concatenate([[0.0], np.maximum(here, 0.0)])
        origin = np.concatenate([[0], start])
    return best


class Items:
    """Test items as word numbers, with their seeds; numbers start at 1."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        words = [words_of(text) for text in texts]
        self.number = {w: n for n, w in enumerate(sorted({w for found in words for w in found}), 1)}
        self.items = [np.array([self.number[w] for w in found], dtype=np.int64) for found in words]
        self.seeds = np.empty(0, dtype=np.int64)
        self.owner = self.offset = self.seeds

    def keys(self, numbers: np.ndarray, width: int) -> np.ndarray:
        """One integer per window of ``width`` words.

        Beyond two million words integers wrap, and different windows may be equal: the
        alignment that follows a seed settles that.
        """
        base = np.int64(len(self.number) + 1)
        count = max(len(numbers) - width + 1, 0)
        key = np.zeros(count, dtype=np.int64)
        for k in range(width):
            key = key * base + numbers[k : k + count]
        return key

    def choose_seeds(self, frequency: np.ndarray) -> None:
        """Per item, the n-grams whose words are least expected to meet by chance.

        ``frequency`` counts the corpus's words by number. A passage that leaked into many
        documents makes its own n-grams common, so n-grams are ranked by their words and
        not by their own counts. Items shorter than an n-gram have no seed.
        """
        surprise = -np.log((frequency + 1.0) / (frequency.sum() + len(frequency)))
        keys, owners, offsets = [], [], []
        for owner, item in enumerate(self.items):
            if len(item) < SEED_WORDS:
                continue
            rarity = sum(surprise[item[k : len(item) - SEED_WORDS + 1 + k]] for k in range(SEED_WORDS))
            order = np.argsort(-rarity, kind="stable")
            chosen = order[: max(1, int(np.ceil(len(order) * SEED_SHARE)))]
            keys.append(self.keys(item, SEED_WORDS)[chosen])
            owners.append(np.full(len(chosen), owner))
            offsets.append(chosen)
        if keys:
            key = np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            self.seeds, self.owner, self.offset = key[order], np.concatenate(owners)[order], np.concatenate(offsets)[order]


def seed_hits(items: Items, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(item, place in the text where the item would begin) of every seed in a text."""
    key = items.keys(numbers, SEED_WORDS)
    first = np.searchsorted(items.seeds, key, side="left")
    many = np.searchsorted(items.seeds, key, side="right") - first
    at = np.flatnonzero(many)
    if not len(at):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    counts = many[at]
    entry = np.repeat(first[at], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return items.owner[entry], np.repeat(at, counts) - items.offset[entry]


def windows(items: Items, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(item, start, end): stretches of a text to align, overlapping ones joined.

    A stretch begins half an item before the item would, and ends half an item after.
    """
    owner, begin = seed_hits(items, numbers)
    order = np.lexsort((begin, owner))
    last = None
    for item, at in zip(owner[order].tolist(), begin[order].tolist()):
        size = len(items.items[item])
        start, end = max(0, at - size // 2), min(len(numbers), at + size + size // 2)
        if last and last[0] == item and start <= last[2]:
            last = (item, last[1], max(last[2], end))
        else:
            if last:
                yield last
            last = (item, start, end)
    if last:
        yield last


def count_words(docs: DataFrame, items: Items, text: str) -> np.ndarray:
    """How often each word of the items occurs in all documents, by number.

    Every task hands on one row per word it saw, which is bounded by the items' words.
    """
    number = items.number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(number) + 1, dtype=np.int64)
        for batch in slices(batches):
            found = [number.get(w, 0) for t in texts_of(batch.column("__text")) for w in words_of(t)]
            total += np.bincount(np.array(found, dtype=np.int64), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["word", "n"])

    counted = docs.select(F.col(text).alias("__text")).mapInArrow(run, "word long, n long")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(len(number) + 1)
    total[rows["word"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy()
    return total


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(key, item, score, start, end, kept columns) of every passage that aligns with a test item.

    The score is that of the best local alignment over the number of the item's words: 1 for
    a copy, 1/2 and more counts. ``start`` and ``end`` are word numbers in the whole
    text. Each document and item is one row, for its best passage (the first of equals).
    Null and empty texts and items of fewer than three words match nothing; repeated
    rows give repeated results; an empty table on either side gives no rows. Kept
    columns of the names above are left out.

    A passage is found if it holds one of the rarest three quarters of an item's 3-grams unchanged,
    as nearly all do that score enough.

    The benchmark is sent to the executors in passes of about 20,000 items or 16 MB, and each
    pass is two scans of the corpus without a shuffle of texts.
    """
    keep = [c for c in keep if c not in (key, item, "score", "start", "end")]
    named = benchmark.select(F.col(item).alias("__item"), F.col(item_text).alias("__text")).where("__text is not null")
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField(item, benchmark.schema[item].dataType),
        T.StructField("score", T.DoubleType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        *(docs.schema[c] for c in keep),
    ])
    size = named.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("__text")).alias("bytes")).first()
    passes = max(1, -(-size["rows"] // ITEMS_AT_ONCE), -(-(size["bytes"] or 0) // BYTES_AT_ONCE))
    dealt = named.withColumn("__pass", F.pmod(F.xxhash64("__item", "__text"), F.lit(passes)))
    found = []
    for number in range(passes):
        rows = dealt.where(F.col("__pass") == number).toPandas().sort_values(["__item", "__text"], kind="stable")
        items = Items(rows["__item"].tolist(), rows["__text"].tolist())
        items.choose_seeds(count_words(docs, items, text))
        found.append(_aligned(docs, items, key, text, schema, threshold, keep))
    return reduce(DataFrame.union, found)


def _aligned(
    docs: DataFrame, items: Items, key: str, text: str, schema: T.StructType, threshold: float, keep: Sequence[str]
) -> DataFrame:
    source = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), *keep)
    item_type = to_arrow_type(schema.fields[1].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.number
        memo: dict[tuple[int, bytes], tuple[float, int, int]] = {}

        def aligned(which: int, passage: np.ndarray) -> tuple[float, int, int]:
            place = (which, passage.tobytes())
            if place not in memo:
                if len(memo) >= MEMO_ALIGNMENTS:
                    memo.clear()
                memo[place] = align(items.items[which], passage)
            return memo[place]

        for batch in slices(batches):
            rows, ids, scores, starts, ends = [], [], [], [], []
            for row, one in enumerate(texts_of(batch.column("__text"))):
                numbers = np.array([known.get(w, 0) for w in words_of(one)], dtype=np.int64)
                best: dict[int, tuple[float, int, int]] = {}
                for which, start, end in windows(items, numbers):
                    score, a, b = aligned(which, numbers[start:end])
                    score /= len(items.items[which])
                    if score >= threshold and score > best.get(which, (0.0,))[0]:
                        best[which] = (score, start + a, start + b)
                for which, (score, a, b) in sorted(best.items()):
                    rows.append(row)
                    ids.append(items.ids[which])
                    scores.append(score)
                    starts.append(a)
                    ends.append(b)
            places = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("__key").take(places), pa.array(ids, item_type),
                    pa.array(scores, pa.float64()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()),
                    *(batch.column(c).take(places) for c in keep),
                ],
                schema.names,
            )

    return source.mapInArrow(run, schema)
