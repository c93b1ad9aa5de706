"""Training-set preparation: split, loss mask, schema check and packing."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping, Sequence
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingmill import fixed
from lingmill.functions import draws, messages
from lingmill.operators import sampling
from lingmill.session import settle


def is_validation(key: Sequence[str], seed: int | str = 0, percent: int = fixed.VALIDATION_PERCENT) -> Column:
    """Whether a row belongs to the validation split, decided by its key alone."""
    return draws.draw_below([F.col(k) for k in key], f"split-{seed}", 100) < percent


def split(df: DataFrame, key: Sequence[str], seed: int | str = 0) -> tuple[DataFrame, DataFrame]:
    """(training, validation) rows."""
    held_out = is_validation(key, seed)
    return df.where(~held_out), df.where(held_out)


def with_loss_mask(df: DataFrame, conversations: str = "conversations", reply_from: str = "gpt") -> DataFrame:
    """Mark each turn with whether loss is taken on it."""
    return df.withColumn(conversations, messages.trained_messages(F.col(conversations), reply_from))


def mask_turns(turns: DataFrame, role: str = "role", reply_from: str = "assistant", name: str = "train") -> DataFrame:
    """The loss mask on whole conversations kept as one row a turn; no shuffle."""
    return turns.withColumn(name, F.coalesce(F.col(role) == reply_from, F.lit(False)))


def turn_problems(
    turns: DataFrame,
    key: str,
    role: str = "role",
    content: str = "text",
    senders: Sequence[str] = ("user", "assistant", "system"),
    reply_from: str = "assistant",
) -> DataFrame:
    """``key, problem`` over every turn of a conversation, with the wording of ``with_problems``.

    Flags are combined before the shuffle: an endless chat costs a row a map task. A key
    whose only row has neither role nor text, as an outer join leaves it, is empty.
    """
    known = F.coalesce(F.col(role).isin(list(senders)), F.lit(False))
    there = F.col(role).isNotNull() | F.col(content).isNotNull()
    flags = turns.groupBy(key).agg(
        F.bool_or(there).alias("any"),
        F.bool_or(there & ~known).alias("unknown"),
        F.bool_or(there & F.col(content).isNull()).alias("missing"),
        F.bool_or(F.coalesce(F.col(role) == reply_from, F.lit(False))).alias("replied"),
    )
    problem = (
        F.when(~F.col("any"), "empty").when(F.col("unknown"), "unknown sender")
        .when(F.col("missing"), "missing text").when(~F.col("replied"), "no reply")
    )
    return flags.select(key, problem.alias("problem"))


def with_problems(
    df: DataFrame,
    conversations: str = "conversations",
    senders: Sequence[str] = ("human", "gpt", "system"),
) -> DataFrame:
    """Add ``problem``: why a conversation cannot be trained on, or null."""
    turns = F.col(conversations)
    known = F.forall(turns, lambda m: F.coalesce(m["from"].isin(list(senders)), F.lit(False)))
    filled = F.forall(turns, lambda m: m["value"].isNotNull())
    replied = F.exists(turns, lambda m: F.coalesce(m["from"] == "gpt", F.lit(False)))
    return df.withColumn(
        "problem",
        F.when(turns.isNull() | (F.size(turns) == 0), "empty")
        .when(~known, "unknown sender")
        .when(~filled, "missing text")
        .when(~replied, "no reply"),
    )


def pack_lengths(counts: Mapping[int, int], capacity: int) -> list[tuple[int, int, int]]:
    """How rows of each length go into bins, best fit first, without looking at any row.

    ``counts`` holds the number of rows per length, from 1 to ``capacity``. The result has
    (rows, rows a bin, first bin) in the order of the rows, longest first: the next
    ``rows`` of them fill bins from ``first bin`` on, so many a bin. A row goes to the bin with the least
    space that still takes it, the first of equal ones. Bins of equal space are moved together,
    so the work follows the number of different lengths, not of rows.
    """
    spaces: list[int] = []
    open_bins: dict[int, list[tuple[int, int]]] = {}

    def leave(space: int, first: int, many: int) -> None:
        if space and many:
            if space not in open_bins:
                insort(spaces, space)
                open_bins[space] = []
            heappush(open_bins[space], (first, many))

    plan, used = [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, many = heappop(open_bins[space])
                if not open_bins[space]:
                    del open_bins[space], spaces[at]
            else:
                space, first = capacity, used
                many = -(-left // (capacity // length))
                used += many
            each = space // length
            full = min(left // each, many)
            rest = min(left - full * each, each - 1) if full < many else 0
            if full:
                plan.append((full * each, each, first))
                leave(space - each * length, first, full)
            if rest:
                plan.append((rest, rest, first + full))
                leave(space - rest * length, first + full, 1)
            done = full + (1 if rest else 0)
            leave(space, first + done, many - done)
            left -= full * each + rest
    return plan


def pack(df: DataFrame, key: str, tokens: str, capacity: int = fixed.PACK_LENGTHS[0], seed: int | str = 0) -> DataFrame:
    """``key, tokens, bin``: rows assigned to sequences of ``capacity`` tokens.

    No two bins would fit into one. Rows are counted by length, at most ``capacity`` lengths; these counts
    are packed (``pack_lengths``), and rows of one length take the places planned for
    it in the order of a hash of their keys. A row longer than the capacity gets a bin of its
    own; one of no tokens, or of an unknown number, takes the place of one token.
    """
    size = F.least(F.greatest(F.coalesce(F.col("_tokens"), F.lit(0)), F.lit(1)), F.lit(capacity))
    lengths = df.select(key, F.col(tokens).cast("long").alias("_tokens")).select(key, "_tokens", (-size).alias("_size"))
    # Stored, so that what the lengths are taken from is read once.
    rows = settle(lengths, "lengths")
    counts = {-r["_size"]: r["n"] for r in rows.groupBy("_size").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    plan = np.array(pack_lengths(counts, capacity), dtype=np.int64).reshape(-1, 3)
    starts = np.cumsum(plan[:, 0]) - plan[:, 0]
    ordered = sampling.numbered(
        rows.withColumn("_hash", draws.order_hash([F.col(key)], f"pack-{seed}")), ["_size", "_hash", key], "_index"
    )
    schema = T.StructType([df.schema[key], T.StructField(tokens, T.LongType()), T.StructField("bin", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = batch.column("_index").to_numpy()
            step = np.searchsorted(starts, index, side="right") - 1
            bins = plan[step, 2] + (index - starts[step]) // plan[step, 1]
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("_tokens"), pa.array(bins)], schema.names)

    return ordered.select(key, "_tokens", "_index").mapInArrow(place, schema)
