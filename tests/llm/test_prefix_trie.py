"""The trie of shared openings against one made of plain dictionaries."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lingmill.llm import prefix_trie

TURN = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    """{(depth, sequence): columns}, straight from the definition."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            by_conv[conv].append((turn is not None, turn or 0, tie, (role, text)))
    turns = {c: [t[-1] for t in sorted(v)] for c, v in by_conv.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    out = []
    for seq, convs in members.items():
        below = [s for s in members if s[: len(seq)] == seq]
        parents = {s[:-1] for s in members if s}
        ends = sorted(c for c in convs if rebuilt[c] == seq)
        out.append((
            min(convs), len(seq), min(members[seq[:-1]]) if seq else None, len(convs),
            sum(1 for s in members if s and s[:-1] == seq), sum(1 for s in below if s not in parents),
            sum((len(members[s]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) for s in below if s),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(spark, rows, container):
    df = spark.createDataFrame(rows, TURN).selectExpr("*", "'clash' AS head", "1 AS n_convs", "2 AS id")
    made = prefix_trie.shared_prefixes(df, container)
    assert made.columns == prefix_trie.COLUMNS
    return sorted((tuple(r) for r in made.collect()), key=repr)


ODD = [
    (0, 0, "system", "be kind"), (0, 1, "user", "hello there"), (0, 2, "assistant", "hi"), (0, 3, "user", "bye"),
    (1, 0, "system", "be kind"), (1, 1, "user", "hello there"), (1, None, None, None), (1, 1, "user", "hello there"),
    (2, 0, "user", ""), (2, 0, "user", None), (2, 5, "user", "  \t "), (3, 0, None, "x y z w"),
    (20, 7, "user", "one"), (21, 0, "user", "a"), (21, 1, "user", "b"), (22, 0, "user", "a"), (23, 0, "user", "a"),
    (39, 1, "user", "late"), (45, 1, "user", "no base"), (46, 0, "user", "no base"), (None, 0, "user", "nobody"),
    (None, 1, "user", "nobody"), (60, 0, "a", "bc"), (61, 0, "ab", "c"), (62, 0, "user", "long " * 20_000),
]


@pytest.mark.parametrize("container", [1, 2, 512])
def test_odd_conversations(spark, container):
    assert found(spark, ODD, container) == brute_force(ODD)


@pytest.mark.parametrize("container", [1, 7])
def test_random_conversations(spark, container):
    rng = np.random.default_rng(5)
    rows = []
    for conv in range(150):
        # A third of all conversations are the same; the rest choose among few turns.
        few = conv % 3 == 0
        for turn in range(4 if few else int(rng.integers(1, 7))):
            rows.append((conv, turn, "user", f"t {turn}" if few else f"w {int(rng.integers(0, 2))} x"))
    rows += [(200, t, "user", f"step {t}") for t in range(300)] + [(220, t, "user", f"step {t}") for t in range(290)]
    assert found(spark, rows, container) == brute_force(rows)


def test_no_conversation(spark):
    assert found(spark, [], 2) == []
    assert found(spark, [(None, 0, "user", "x")], 2) == []


def test_ids_of_a_large_group_are_joined_in_pieces(spark, monkeypatch):
    members = spark.createDataFrame([("k", i) for i in range(9000)] + [("j", 5), ("j", -1)], "key string, conv_id long")
    made = {r.key: r.ends_sha256 for r in prefix_trie.id_digests(members.repartition(7)).collect()}
    assert made["k"] == hashlib.sha256(",".join(map(str, range(9000))).encode()).hexdigest()
    assert made["j"] == hashlib.sha256(b"-1,5").hexdigest()


def test_an_oversized_container_bursts_until_all_fit(spark):
    convs = spark.createDataFrame([(i, [(f"{i % 4:032d}", 1), (f"{i:032d}", 1)]) for i in range(40)], "conv_id long, turns array<struct<id: string, words: int>>")
    contained, bursts = prefix_trie.burst(prefix_trie.sequences(convs), 5)
    assert contained.groupBy("head").count().agg({"count": "max"}).first()[0] <= 5
    assert len(bursts) == 2
