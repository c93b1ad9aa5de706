"""Personal data by bootstrapped contextual extraction.

1. Four fixed patterns find the seeds: e-mail and network addresses, card and phone numbers.
2. Every identifier-like string, seed or not, is an instance; the words beside it are its
   lexical patterns. Distinct (pattern, instance) pairs are the edges of a graph.
3. Round by round, a pattern is trusted for a kind if nearly all its instances are known to
   be of that kind; an instance that looks like the kind and stands in trusted
   patterns becomes known, and so vouches for further patterns.
4. Where a known instance stands, the text holds a span of its kind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingmill.llm.common import slices, texts_of
from lingmill.session import settle

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
# A pattern's share of known instances, by the lower end of a Wilson interval of so many deviations.
TRUST = 0.5
DEVIATIONS = 3.0
# Belief in an instance, out of all patterns it stands in.
BELIEF = 0.8
# Belief that one pattern may give at most.
SUREST = 0.95
# Code points beside an instance that are read for words, and of an instance at most.
BESIDE = 64
LONGEST = 64

EMAIL_END = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match begins at the first digit of a run: later digits of it would fail in the same way.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
WORD = re.compile(r"[^\W\d_]+")
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "+")

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """Leftmost matches of an address; a match begins where the run of letters before its @ does."""
    found, last = [], 0
    for match in EMAIL_END.finditer(text):
        start = match.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < match.start():
            found.append((start, match.end()))
            last = match.end()
    return found


def small(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or "0") <= 255


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def digits_of(text: str) -> str:
    return NOT_DIGIT.sub("", text)


def is_card(text: str) -> bool:
    digits = digits_of(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> dict[str, list[Span]]:
    """The spans of the four fixed patterns; a match that fails its check is passed over whole."""
    return {
        "email": emails(text) if "@" in text else [],
        "ip": [m.span() for m in IP.finditer(text) if all(map(small, m.groups()))],
        "card": [m.span() for m in CARD.finditer(text) if is_card(m.group())],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15] if "+" in text else [],
    }


def looks_like(value: str) -> list[str]:
    """The kinds an instance may be of, though it is no seed."""
    digits = digits_of(value)
    parts = re.split(r"[.:-]", value)
    checks = {
        "email": bool(re.fullmatch(r"[^\s@]+@[^\s@]+", value)),
        "ip": len(parts) >= 4 and bool(digits) and all(re.fullmatch(r"[0-9A-Fa-f]{0,4}", p) for p in parts),
        "card": 12 <= len(digits) <= 19 and not re.search(r"[A-Za-z@]", value),
        "phone": 6 <= len(digits) <= 15 and not re.search(r"[A-Za-z@]", value),
    }
    return [kind for kind in KINDS if checks[kind]]


def other_instances(text: str, taken: list[Span]) -> list[Span]:
    """Strings with a digit or @ that meet no seed: tokens, and tokens one space apart joined."""
    taken = sorted(taken)
    found: list[Span] = []
    nearest = 0
    for match in TOKEN.finditer(text):
        start, end = match.span()
        while nearest < len(taken) and taken[nearest][1] <= start:
            nearest += 1
        if nearest < len(taken) and taken[nearest][0] < end:
            continue
        token = match.group()
        start += len(token) - len(token.lstrip(EDGES))
        end -= len(token) - len(token.rstrip(EDGES))
        if end - start > LONGEST or end <= start:
            continue
        if found and start - found[-1][1] == 1 and text[start - 1] == " " and end - found[-1][0] <= LONGEST:
            found[-1] = (found[-1][0], end)
        else:
            found.append((start, end))
    return [s for s in found if looks_like(text[s[0] : s[1]])]


def words_beside(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a place: the word before it, the two before, and those on both sides."""
    ahead = [m for m in WORD.finditer(text, max(start - BESIDE, 0), start)]
    if ahead and ahead[0].start() == start - BESIDE and text[start - BESIDE - 1 : start - BESIDE].isalpha():
        del ahead[0]  # begins further left
    behind = WORD.search(text, end, end + BESIDE)
    if behind and behind.end() == end + BESIDE and text[end + BESIDE : end + BESIDE + 1].isalpha():
        behind = None
    left = [m.group().lower() for m in ahead[-2:]]
    patterns = [f"{left[-1]} *"] if left else []
    if len(left) == 2:
        patterns.append(f"{left[0]} {left[1]} *")
    if left and behind:
        patterns.append(f"{left[-1]} * {behind.group().lower()}")
    return patterns


def named(value: str) -> str:
    """An instance's name in the graph; a long one's is its digest."""
    return value if len(value) <= LONGEST else hashlib.sha256(value.encode()).hexdigest()


def written(spans: list[tuple[str, int, int]]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in order)


PLACES = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("value", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType())),
    T.StructField("patterns", T.ArrayType(T.StringType())),
]))
ARROW_PLACES = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()),
    ("kinds", pa.list_(pa.string())), ("patterns", pa.list_(pa.string())),
]))


def with_places(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, __tie, n_<kind>.., base_sha256, base, __places) of every row: seeds in writing, and
    all instances, with kind null if they are no seed."""
    schema = T.StructType([
        docs.schema[key], T.StructField("__tie", T.LongType()), *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
        T.StructField("base_sha256", T.StringType()), T.StructField("base", T.StringType()), T.StructField("__places", PLACES),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text="__text"):
            counts, digests, bases, places = [], [], [], []
            for one in texts_of(batch.column("__text")):
                base = base_spans(one)
                spans = [(kind, *span) for kind in KINDS for span in base[kind]]
                counts.append([len(base[kind]) for kind in KINDS])
                bases.append(written(spans))
                digests.append(hashlib.sha256(bases[-1].encode()).hexdigest())
                loose = other_instances(one, [s[1:] for s in spans])
                places.append([
                    {
                        "kind": kind, "start": s, "end": e, "value": named(one[s:e]),
                        "kinds": [] if kind else looks_like(one[s:e]), "patterns": words_beside(one, s, e),
                    }
                    for kind, s, e in [*spans, *((None, s, e) for s, e in loose)]
                ])
            numbers = np.array(counts, dtype=np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key), batch.column("__tie"), *(pa.array(numbers[:, k]) for k in range(len(KINDS))),
                    pa.array(digests, pa.string()), pa.array(bases, pa.string()), pa.array(places, ARROW_PLACES),
                ],
                schema.names,
            )

    rows = docs.select(key, F.col(text).alias("__text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__tie"))
    return rows.mapInArrow(run, schema)


def lower_bound(hits: Column, total: Column) -> Column:
    """The lower end of the Wilson interval of a share."""
    z2 = DEVIATIONS**2
    share = hits / total
    spread = DEVIATIONS * F.sqrt(share * (1 - share) / total + z2 / (4 * total * total))
    return (share + z2 / (2 * total) - spread) / (1 + z2 / total)


def known_instances(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(value, kind, round): the seeds, and the instances found from round 1 on.

    ``edges`` are distinct (pattern, value, kinds), kinds being those the value looks like.
    Each round counts, per pattern and kind, its instances known so far. A pattern is
    trusted if the lower bound of their share is above ``TRUST``, and above half the
    way from the kind's share among all edges to 1: a pattern that stands beside anything
    tells nothing. Belief in an instance is 1 - the product of (1 - share) over its
    trusted patterns; at ``BELIEF`` it is known, as the kind believed most.
    """
    known = settle(seeds.withColumn("round", F.lit(0)), "known")
    size = edges.count()
    per_pattern = settle(edges.groupBy("pattern").agg(F.count("*").alias("total")), "patterns")
    for number in range(1, rounds + 1):
        held = edges.join(known.select("value", "kind"), "value")
        shares = {r["kind"]: r["n"] / size for r in held.groupBy("kind").agg(F.count("*").alias("n")).collect()}  # a row a kind
        if not shares:
            break
        usual = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("kind")]
        counted = held.groupBy("pattern", "kind").agg(F.count("*").alias("hits")).join(per_pattern, "pattern")
        trusted = settle(
            counted.where(lower_bound(F.col("hits"), F.col("total")) > F.greatest(F.lit(TRUST), (usual + 1) / 2))
            .select("pattern", "kind", (F.col("hits") / F.col("total")).alias("share")),
            "trusted",
        )
        doubt = F.log(F.greatest(1 - F.col("share"), F.lit(1 - SUREST)))
        believed = (
            edges.where(F.size("kinds") > 0).join(trusted, "pattern").where(F.array_contains("kinds", F.col("kind")))
            .groupBy("value", "kind").agg((1 - F.exp(F.sum(doubt))).alias("belief"))
            .where(F.round("belief", 9) >= BELIEF)
        )
        rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
        best = believed.groupBy("value").agg(F.max(F.struct(F.round("belief", 9), -rank, "kind"))["kind"].alias("kind"))
        fresh = settle(best.join(known, "value", "left_anti").withColumn("round", F.lit(number)).select("value", "kind", "round"), "known")
        if fresh.isEmpty():
            break
        known = known.unionByName(fresh)
    return known


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found) of every row.

    The n_ columns and base_sha256 are of the spans of the fixed patterns, per kind leftmost and
    not overlapping; ``spans`` lists these and the ``n_found`` that the method adds, as
    kind:start:end in code points, by kind, then start. An added span meets no base span.

    Null and empty texts hold nothing. Rows that share a key are each judged by their
    own text; rows equal in both repeat their result; keys may be null. Other columns
    are ignored. Texts are read once and not exchanged: what is stored is proportional
    to the identifier-like strings. Copies of a text count once, since edges are distinct.
    """
    placed = settle(with_places(docs, key, text), "places")
    place = placed.select(key, "__tie", F.explode("__places").alias("__place")).select(
        key, "__tie", *(F.col("__place")[c].alias(c) for c in ("kind", "start", "end", "value", "kinds", "patterns"))
    )
    kinds = F.array(*map(F.lit, KINDS))
    seeds = place.where("kind is not null").groupBy("value").agg(
        F.min(F.array_position(kinds, F.col("kind"))).cast("int").alias("first")
    ).select("value", F.element_at(kinds, F.col("first")).alias("kind"))
    edges = place.select("value", "kinds", F.explode("patterns").alias("pattern")).groupBy("pattern", "value").agg(
        F.max("kinds").alias("kinds")
    )
    known = known_instances(settle(edges, "edges"), seeds, rounds)
    loose = place.where("kind is null").select(key, "__tie", "value", "start", "end")
    spans = loose.join(known.select("value", "kind"), "value").groupBy(key, "__tie").agg(
        F.collect_set(F.struct(F.array_position(kinds, F.col("kind")).alias("order"), "start", "end", "kind")).alias("__found")
    ).select(F.col(key).alias("__key"), F.col("__tie").alias("__its"), "__found")
    rows = placed.drop("__places").join(spans, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__tie") == F.col("__its")), "left")

    def ranked(span: Column) -> Column:
        part = F.split(span, ":")
        return F.struct(
            F.array_position(kinds, part[0]).alias("order"), part[1].cast("int").alias("start"),
            part[2].cast("int").alias("end"), part[0].alias("kind"),
        )

    # Places are listed again only where something was found.
    both = F.array_sort(F.concat(F.transform(F.filter(F.split("base", ","), lambda s: s != ""), ranked), F.col("__found")))
    listed = F.array_join(F.transform(both, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rows.select(
        key, *(f"n_{kind}" for kind in KINDS), "base_sha256",
        F.when(F.col("__found").isNull(), F.col("base")).otherwise(listed).alias("spans"),
        F.coalesce(F.size("__found"), F.lit(0)).cast("long").alias("n_found"),
    )
