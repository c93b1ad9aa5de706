"""SimHash near-duplicates through an inverted index over byte positions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingmill.llm.common import bucket, slices
from lingmill.llm.components import components, forest
from lingmill.session import settle

BYTES = 8
# Rows of the index that one task sorts.
BUCKET_ROWS = 200_000
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words.

    A-Z are lower-cased and words end at ASCII white space. A text of fewer words than
    a shingle is one shingle. A bit is 1 if more than half of the shingles' XXH64 have it.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    last = min(words, len(found)) - 1
    total = len(found) - last
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, SHINGLES_AT_ONCE):
        to = min(total, at + SHINGLES_AT_ONCE)
        spans = zip(starts[at:to].tolist(), ends[at + last : to + last].tolist())
        hashes = np.array([digest(joined[s:e], seed) for s, e in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def with_fingerprint(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, keep: Sequence[str] = ()
) -> DataFrame:
    """(key, kept columns, fingerprint long) of every row; the long has the fingerprint's 64 bits."""
    names = [key, *keep]
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(t, words) for t in batch.column("__text").to_pylist()]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(signed)], [*names, "fingerprint"]
            )

    return docs.select(*names, docs[text].alias("__text")).mapInArrow(run, schema)


def differences(width: int, distance: int) -> list[int]:
    """All non-zero masks of ``width`` bits with at most ``distance`` ones."""
    return [
        sum(1 << bit for bit in bits)
        for ones in range(1, distance + 1)
        for bits in combinations(range(width), ones)
    ]


def linked_pairs(
    lists: np.ndarray, prints: np.ndarray, combos: list[tuple[int, ...]], distance: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs at ``distance`` or fewer bits within the posting lists of a bucket.

    Members of a list differ in the bytes outside its combination only, so a member's
    partners are found by looking up its other bytes with each allowed difference:
    work follows the members of a list, not their pairs. The shared bytes of each pair
    are then tallied, and pairs short of the minimum or too many bits apart are dropped.
    A pair that shares more bytes than needed counts in the first of its lists only.
    """
    none = np.empty(0, dtype=np.uint64)
    order = np.lexsort((prints, lists))
    lists, prints = lists[order], prints[order]
    together = np.zeros(len(lists), dtype=bool)
    together[1:] = lists[1:] == lists[:-1]
    together[:-1] |= together[1:]
    lists, prints = lists[together], prints[together]
    if not len(lists):
        return none, none
    number = np.cumsum(np.concatenate([[0], lists[1:] != lists[:-1]])).astype(np.uint64)
    combo = (lists >> np.uint64(8 * (BYTES - distance))).astype(np.int64)
    rest_of = [[p for p in range(BYTES) if p not in c] for c in combos]
    free = np.array(rest_of, dtype=np.uint64)[combo] * np.uint64(8)
    width = np.uint64(8 * distance)
    rest = np.zeros(len(prints), dtype=np.uint64)
    for j in range(distance):
        rest |= ((prints >> free[:, j]) & np.uint64(255)) << np.uint64(8 * j)
    code = (number << width) | rest
    order = np.argsort(code, kind="stable")
    code, prints, combo, rest = code[order], prints[order], combo[order], rest[order]
    number = number[order]
    left, right = [], []
    for mask in differences(8 * distance, distance):
        other = rest ^ np.uint64(mask)
        wanted = (number << width) | other
        at = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
        hit = np.flatnonzero((code[at] == wanted) & (other > rest))
        left.append(hit)
        right.append(at[hit])
    i, j = np.concatenate(left), np.concatenate(right)
    a, b = prints[i], prints[j]
    apart = a ^ b
    equal = apart.view(np.uint8).reshape(-1, BYTES) == 0
    tally = equal.sum(axis=1)
    enough = (tally >= BYTES - distance) & (np.bitwise_count(apart) <= distance)
    # Little-endian bytes: column p of ``equal`` is byte position p of the fingerprint.
    ranked = np.cumsum(equal, axis=1)
    chosen = equal & (ranked <= BYTES - distance)
    as_number = (chosen * (1 << np.arange(BYTES))).sum(axis=1)
    own = np.array([sum(1 << p for p in c) for c in combos])[combo[i]]
    keep = enough & (as_number == own)
    return a[keep], b[keep]


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``distance`` or fewer bits apart.

    Such fingerprints agree in at least 8 - distance of their bytes, by position.
    The index therefore has a posting list for each combination of so many positions
    and their bytes: two fingerprints meet in a list exactly if they reach that count.
    A list has at most 256 ** distance members, whatever the input. Lists are dealt
    to tasks by hash; a task hands on a spanning forest of the links in its lists.
    """
    combos = list(combinations(range(BYTES), BYTES - distance))
    spark = prints.sparkSession
    distinct = settle(prints.select("fingerprint").where("fingerprint is not null").distinct(), "prints")
    postings = distinct.count() * len(combos)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-postings // BUCKET_ROWS))

    def byte(p: int) -> F.Column:
        return F.shiftrightunsigned("fingerprint", 8 * p).bitwiseAND(F.lit(255))

    def posting(number: int, combo: tuple[int, ...]) -> F.Column:
        value = F.lit(number << (8 * len(combo))).cast("long")
        for k, p in enumerate(combo):
            value = value.bitwiseOR(F.shiftleft(byte(p), 8 * k))
        return value

    index = distinct.select(
        "fingerprint", F.explode(F.array(*[posting(n, c) for n, c in enumerate(combos)])).alias("list")
    ).withColumn("bucket", bucket(["list"], buckets))

    def compare(table: pa.Table) -> pa.Table:
        a, b = linked_pairs(
            table["list"].to_numpy().view(np.uint64), table["fingerprint"].to_numpy().view(np.uint64),
            combos, distance,
        )
        kept = forest(a, b)
        return pa.table({"a": a[kept].view(np.int64), "b": b[kept].view(np.int64)})

    return index.groupBy("bucket").applyInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 3,
    distance: int = 2,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(key, kept columns, fingerprint, group, component) of every row.

    ``group`` is one fingerprint of those linked to the row's, ``component`` the smallest
    key among the group's rows. Equal fingerprints are one node of the graph, so groups of
    copies cost nothing beyond their count; null and empty texts have fingerprint zero
    and are linked like any other. A repeated key is a row each time; a component is null
    only if all its keys are. An empty table gives an empty one. Kept columns of the names above
    are left out.
    """
    keep = [c for c in keep if c not in (key, "fingerprint", "group", "component")]
    printed = settle(with_fingerprint(docs, key, text, words, keep), "fingerprints")
    labels = components(links(printed, distance), "a", "b")
    smallest = printed.groupBy("fingerprint").agg(F.min(key).alias("first"))
    named = settle(
        smallest.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
            "fingerprint", "first", F.coalesce("component", "fingerprint").alias("group")
        ),
        "named",
    )
    per_group = named.groupBy("group").agg(F.min("first").alias("component"))
    groups = settle(named.join(per_group, "group").select("fingerprint", "group", "component"), "groups")
    # A fingerprint shared by a third of all rows: the join is split by adaptive execution.
    return printed.join(groups, "fingerprint").select(key, *keep, "fingerprint", "group", "component")
