import time
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lingmill.operators import trainset
from lingmill.sources import nesting


def naive(lengths, capacity):
    """Best fit, one length after the other."""
    free, bins = [], []
    for n in lengths:
        rooms = [(room, b) for b, room in enumerate(free) if room >= n]
        b = min(rooms)[1] if rooms else len(free)
        if not rooms:
            free.append(capacity)
        free[b] -= n
        bins.append(b)
    return bins


def planned(lengths, capacity):
    plan = trainset.pack_lengths(Counter(lengths), capacity)
    return [first + i // each for rows, each, first in plan for i in range(rows)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60), st.integers(30, 40))
def test_packing_counts_equals_packing_rows(lengths, capacity):
    lengths = sorted(lengths, reverse=True)
    assert planned(lengths, capacity) == naive(lengths, capacity)


def test_ten_million_lengths_are_packed_by_their_counts():
    rng = np.random.default_rng(1)
    lengths, counts = np.unique(np.minimum(rng.geometric(1 / 900, 10_000_000), 8192), return_counts=True)
    before = time.monotonic()
    plan = np.array(trainset.pack_lengths(dict(zip(lengths.tolist(), counts.tolist())), 8192))
    assert time.monotonic() - before < 20
    assert plan[:, 0].sum() == 10_000_000
    used = np.zeros(int((plan[:, 2] + -(-plan[:, 0] // plan[:, 1])).max()), dtype=np.int64)
    sizes = np.repeat(lengths[::-1], counts[::-1])
    bins = np.repeat(plan[:, 2], plan[:, 0]) + (np.arange(10_000_000) - np.repeat(np.cumsum(plan[:, 0]) - plan[:, 0], plan[:, 0])) // np.repeat(plan[:, 1], plan[:, 0])
    np.add.at(used, bins, sizes)
    assert used.max() <= 8192 and np.sort(used)[:2].sum() > 8192
    assert used.sum() / (8192 * len(used)) > 0.99


def test_packing_keeps_rows_and_capacity(spark):
    size = F.when(F.col("id") < 1000, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(900)))
    df = spark.range(3000).select("id", F.when(F.col("id") % 500 > 0, size).alias("n"))
    packed = trainset.pack(df, "id", "n", 800).collect()
    assert Counter((r.id, r.n) for r in packed) == Counter((r.id, r.n) for r in df.collect())
    bins = {}
    for r in packed:
        bins.setdefault(r.bin, []).append(max(r.n or 0, 1))
    assert all(sum(ns) <= 800 or len(ns) == 1 for ns in bins.values())
    assert sum(sorted(sum(ns) for ns in bins.values())[:2]) > 800
    again = trainset.pack(df.repartition(9), "id", "n", 800).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, packed), key=repr)
    assert trainset.pack(df.limit(0), "id", "n", 800).count() == 0


def test_split_is_disjoint_and_about_one_percent(spark):
    train, held_out = trainset.split(spark.range(20000), ["id"])
    assert train.count() + held_out.count() == 20000
    assert 120 < held_out.count() < 280
    assert train.join(held_out, "id").count() == 0


def test_mask_and_problems(spark):
    turns = "i int, conversations array<struct<from:string,value:string>>"
    rows = [
        (1, [("human", "q"), ("gpt", "a")]),
        (2, []),
        (3, [("human", "q")]),
        (4, [("robot", "q"), ("gpt", "a")]),
        (5, [("human", None), ("gpt", "a")]),
        (6, None),
    ]
    df = spark.createDataFrame(rows, turns)
    got = {r.i: r.problem for r in trainset.with_problems(df).collect()}
    assert got == {1: None, 2: "empty", 3: "no reply", 4: "unknown sender", 5: "missing text", 6: "empty"}
    masked = trainset.with_loss_mask(df).where("i = 1").first().conversations
    assert [(m["from"], m["train"]) for m in masked] == [("human", False), ("gpt", True)]


def test_every_turn_of_a_long_chat_counts(spark):
    endless = [("long", t, "user", "x") for t in range(3000)] + [("long", 3000, "assistant", "y")]
    rows = endless + [
        ("mute", 0, "user", "x"), ("odd", 0, "user", "x"), ("odd", 9, "robot", "x"), ("gap", 0, "assistant", None),
        ("none", None, None, None),
    ]
    turns = spark.createDataFrame(rows, "chat string, turn int, role string, text string").repartition(6)
    got = {r["chat"]: r["problem"] for r in trainset.turn_problems(turns, "chat").collect()}
    assert got == {"long": None, "mute": "no reply", "odd": "unknown sender", "gap": "missing text", "none": "empty"}
    masked = trainset.mask_turns(turns)
    assert [r["turn"] for r in masked.where("train and chat = 'long'").collect()] == [3000]
    first = nesting.first_by_role(turns, "chat", "turn", "assistant")
    assert {r["chat"]: r["first_message"] for r in first.collect()} == {
        "long": "y", "mute": None, "odd": None, "gap": None, "none": None
    }
