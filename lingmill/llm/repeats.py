"""Removal of repeated passages, located with sharded Aho-Corasick automata.

1. Every window of words is represented by the phrase inside it whose hash is least, so
   equal windows have equal phrases. All documents are read once for the places of their
   representatives; hashes met at two places, other than in copies of one whole text, recur.
2. Places of recurring hashes go back to their texts. The phrases there are the confirmed ones;
   they are sharded with the texts that hold them: a task compiles those of a bounded
   slice of texts into one automaton.
3. The slice's texts stream through it, which locates every occurrence by its words. The
   windows whose representative is located are compared by 128 bits of BLAKE2, and all but
   the first of equal ones go. Later copies of a whole text of a window or more go as they are.

A hash only says where to look: texts that merely share one cost a comparison.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingmill.llm.common import settle_compressed, slices, texts_of
from lingmill.session import settle

WINDOW = 20
PHRASE = 6
# Text bytes whose phrases make one automaton; bounds a task's memory.
SHARD_BYTES = 1 << 21
# Windows a task compares among themselves before it hands them on.
BUFFER_WINDOWS = 150_000
# Text bytes of which words are hashed together.
HASH_BYTES = 1 << 20
# Bits of each distance in a packed place; distances are at most WINDOW - PHRASE.
BITS = 4

SPACES = b" \t\n\x0b\x0c\r"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the entropy of 64-bit hashes over all bits."""
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


BYTE_VALUES = np.random.default_rng(0).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUES[np.frombuffer(SPACES, np.uint8)] = 0


@dataclass
class Words:
    """The words of several texts: byte spans, the text each is in, and a hash."""

    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    firsts: np.ndarray  # number of the first word of each text
    hashes: np.ndarray


def read_words(texts: list[bytes]) -> Words:
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    is_space = np.zeros(256, dtype=np.int8)
    is_space[np.frombuffer(SPACES, np.uint8)] = 1
    edge = np.diff(np.concatenate([[1], is_space[raw], [1]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    text_starts = np.cumsum([0] + [len(text) + 1 for text in texts])
    firsts = np.searchsorted(starts, text_starts)
    owner = np.repeat(np.arange(len(texts)), np.diff(firsts))
    hashes = np.empty(0, dtype=np.uint64)
    if len(starts):
        spans = np.diff(np.concatenate([starts, [len(raw)]]))
        place = np.arange(starts[0], len(raw)) - np.repeat(starts, spans)
        powers = np.ones(int(spans.max()), dtype=np.uint64)
        powers[1:] = FACTOR
        powers = np.multiply.accumulate(powers)
        values = BYTE_VALUES[raw[starts[0] :]] * powers[place]
        hashes = mixed(np.add.reduceat(values, starts - starts[0]))
    return Words(starts, ends, owner, firsts, hashes)


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` words."""
    count = max(len(hashes) - width + 1, 0)
    out = np.zeros(count, dtype=np.uint64)
    for k in range(width):
        out = out * FACTOR + hashes[k : k + count]
    return mixed(out)


def representatives(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(windows, phrases): numbers of the first words of every window within one text, and
    of its representative, the phrase of least hash (the first of equals)."""
    grams = rolled(words.hashes, PHRASE)
    count = max(len(words.starts) - WINDOW + 1, 0)
    best = grams[:count].copy()
    chosen = np.arange(count)
    for k in range(1, WINDOW - PHRASE + 1):
        less = grams[k : k + count] < best
        best[less] = grams[k : k + count][less]
        chosen[less] = np.flatnonzero(less) + k
    inside = np.flatnonzero(words.owner[:count] == words.owner[WINDOW - 1 :]) if count else np.arange(0)
    return inside, chosen[inside]


def pieces(data: bytes) -> Iterator[bytes]:
    """Parts of about ``HASH_BYTES`` that end where a word does."""
    start = 0
    while start < len(data):
        end = start + HASH_BYTES
        while end < len(data) and data[end] not in SPACES:
            end += 1
        yield data[start:end]
        start = end


def stretches(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(number of the first word, bytes) of runs of words of bounded size. Neighbours share all
    but one word of a window, so that each window lies in exactly one of them."""
    if len(data) <= HASH_BYTES:
        yield 0, data
        return
    number, shared = 0, []
    for piece in pieces(data):
        words = shared + piece.split()
        yield number, b" ".join(words)
        shared = words[-(WINDOW - 1) :]
        number += len(words) - len(shared)


def identity(text: Column) -> dict[str, Column]:
    """Two halves of 128 bits of a text's SHA-256, by which equal texts are known; never null."""
    digest = F.sha2(text, 256)
    return {
        f"t{half + 1}": F.coalesce(F.conv(F.substring(digest, 16 * half + 1, 16), 16, -10).cast("long"), F.lit(0))
        for half in range(2)
    }


def representative_places(source: DataFrame) -> DataFrame:
    """(hash, t1, place) of every representative: the hash, its text, and its place, which packs
    the number of its first word, the distance from the first window that it represents,
    and how many further windows it represents. Half of a text's identity will do
    here: places say where to look, and texts that share it look in a few places too many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text="text", size=HASH_BYTES):
            texts = [text.encode() for text in texts_of(batch.column("text"))]
            parts = [(row, number, part) for row, text in enumerate(texts) for number, part in stretches(text)]
            # All short texts together, a long one stretch by stretch.
            together = [parts] if sum(len(part) for _, _, part in parts) <= 2 * HASH_BYTES else [[one] for one in parts]
            for some in together:
                rows, numbers, held = zip(*some)
                words = read_words(list(held))
                inside, phrases = representatives(words)
                fresh = np.ones(len(inside), dtype=bool)
                # Windows of one representative are neighbours.
                fresh[1:] = phrases[1:] != phrases[:-1]
                heads = np.flatnonzero(fresh)
                tails = np.append(heads[1:], len(inside))[: len(heads)] - 1
                at, first, last = phrases[heads], inside[heads], inside[tails]
                owner = words.owner[at]
                number = at - words.firsts[owner] + np.array(numbers, dtype=np.int64)[owner]
                place = (number << 2 * BITS) | (at - first << BITS) | (last - first)
                row = pa.array(np.array(rows, dtype=np.int64)[owner])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rolled(words.hashes, PHRASE)[at].view(np.int64)), batch.column("t1").take(row), pa.array(place)],
                    ["hash", "t1", "place"],
                )

    return source.select("text", "t1").mapInArrow(run, "hash long, t1 long, place long")


class Automaton:
    """The phrases of one shard, each word spelled with a fixed number of letters.

    A letter is one of 64, so that a state has few ways on; words of no phrase are spelled
    with a letter that no phrase has.
    """

    def __init__(self, phrases: set[tuple[bytes, ...]]):
        words = sorted({w for phrase in phrases for w in phrase})
        self.letters = 1
        while 64**self.letters < len(words):
            self.letters += 1
        self.spelled = {
            w: "".join(chr(0x100 + (n >> 6 * k & 63)) for k in reversed(range(self.letters)))
            for n, w in enumerate(words)
        }
        self.other = chr(0xFF) * self.letters
        self.matches = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for phrase in phrases:
            self.matches.add_word("".join(map(self.spelled.__getitem__, phrase)), 1)
        self.matches.make_automaton()

    def locate(self, words: list[bytes]) -> np.ndarray:
        """Whether a phrase begins at each word."""
        text = "".join(map(self.spelled.get, words, repeat(self.other)))
        ends = (end + 1 for end, _ in self.matches.iter(text))
        begun = np.zeros(len(words), dtype=bool)
        begun[[end // self.letters - PHRASE for end in ends if end % self.letters == 0]] = True
        return begun


def digests(words: list[bytes], windows: list[int]) -> bytes:
    """16 bytes for each of the windows that begin at the given words."""
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[windows].tolist(), ends[np.array(windows) + WINDOW - 1].tolist())
    return b"".join([hashlib.blake2b(joined[s:e], digest_size=16).digest() for s, e in spans])


WINDOW_SCHEMA = T.StructType([
    *(T.StructField(c, T.LongType()) for c in ("nil", "order", "t1", "place", "high", "low")),
    T.StructField("later", T.BinaryType()),
])


def compared(rows: np.ndarray) -> pa.RecordBatch:
    """Windows as rows: the first of equal ones each, and the places of the later ones, a
    row by text. So however often a window occurs, a task exchanges it once.

    ``rows`` has the columns of ``WINDOW_SCHEMA`` but the last. A text is known by the
    smallest key that it has, and half of its identity.
    """
    nil, order, text, place, high, low = rows.T
    rows = rows[np.lexsort((text, place, order, nil, low, high))]
    rows = rows[np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])]
    fresh = np.concatenate([[True], (rows[1:, 4:] != rows[:-1, 4:]).any(axis=1)])
    lead = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    at = [0, 1, 3]
    first = (rows[:, at] == rows[lead][:, at]).all(axis=1)
    # Windows of one text stay together, which the exchange's compression likes.
    a, b = (part[np.lexsort((part[:, 3], part[:, 2], part[:, 1], part[:, 0]))] for part in (rows[first], rows[~first]))
    change = np.flatnonzero(np.concatenate([[True], (b[1:, :3] != b[:-1, :3]).any(axis=1)])) if len(b) else np.empty(0, np.int64)
    packed = [x.astype("<i8").tobytes() for x in np.split(b[:, 3], change[1:])] if len(b) else []
    later = b[change].copy()
    # Packed places are ranked with nothing: they are dealt out by their texts.
    later[:, 4], later[:, 5] = later[:, 2], later[:, 1]
    columns = np.concatenate([a, later]).T
    return pa.RecordBatch.from_arrays(
        [*(pa.array(np.ascontiguousarray(c)) for c in columns), pa.array([None] * len(a) + packed, pa.binary())], WINDOW_SCHEMA.names
    )


def located_windows(rows: DataFrame, key: str, text: str) -> DataFrame:
    """The windows whose representative the automata locate. ``rows`` have a text's identity
    (__t1, __t2), its smallest key (__nil, __order), and ``__places``, the packed places of its confirmed
    representatives. Of the rows of one text, those of the smallest key count, and once."""

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(identity, number of the first word, words, places, first windows, further windows)
        of every stretch that holds a confirmed representative."""
        before = None
        for batch in slices(batches, text=text, size=SHARD_BYTES):
            names = zip(*(batch.column(c).to_pylist() for c in ("__nil", "__order", "__t1", "__t2")))
            for own, (nil, order, t1, t2), one, places in zip(
                batch.column(key).to_pylist(), names, batch.column(text), batch.column("__places")
            ):
                # Rows of a text follow each other.
                if (own is None) != bool(nil) or (own or 0) != order or (t1, t2) == before:
                    continue
                before = (t1, t2)
                packed = np.sort(places.values.to_numpy())
                number, back, more = packed >> 2 * BITS, packed >> BITS & (1 << BITS) - 1, packed & (1 << BITS) - 1
                for begin, part in stretches((one.as_py() or "").encode()):
                    words = part.split()
                    first = number - back - begin
                    here = (first >= 0) & (first + more + WINDOW <= len(words))
                    if here.any():
                        yield (nil, order, t1), begin, words, number[here] - begin, first[here], more[here]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        held, size = [], 0
        for part in parts_of(batches):
            held.append(part)
            size += sum(map(len, part[2]))
            if size >= SHARD_BYTES:
                yield held
                held, size = [], 0
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for shard in shards(batches):
            automaton = Automaton({tuple(words[k : k + PHRASE]) for _, _, words, at, _, _ in shard for k in at.tolist()})
            for name, begin, words, at, first, more in shard:
                found = automaton.locate(words)[at]
                windows = np.unique(np.concatenate([np.arange(f, f + m + 1) for f, m in zip(first[found].tolist(), more[found].tolist())]))
                out = np.empty((len(windows), 6), dtype=np.int64)
                out[:, :3] = name
                out[:, 3] = windows + begin
                out[:, 4:] = np.frombuffer(digests(words, windows.tolist()), "<i8").reshape(-1, 2)
                held.append(out)
                size += len(out)
                if size >= BUFFER_WINDOWS:
                    yield compared(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield compared(np.concatenate(held))

    return rows.mapInArrow(run, WINDOW_SCHEMA)


def cut(text: bytes, places: np.ndarray, whole: bool) -> tuple[int, int, bytes]:
    """(words, words removed, the rest): a text without its windows at the given places."""
    total = sum(len(piece.split()) for piece in pieces(text))
    if whole and total >= WINDOW:
        return total, total, b""
    if not len(places):
        return total, 0, b" ".join(w for piece in pieces(text) for w in piece.split())
    ahead = np.zeros(total + 1, dtype=np.int32)
    at = np.unique(places)
    ahead[at] += 1
    ahead[at + WINDOW] -= 1
    stay = np.cumsum(ahead[:-1], dtype=np.int32) == 0
    kept, number = [], 0
    for piece in pieces(text):
        words = piece.split()
        kept += [words[k] for k in np.flatnonzero(stay[number : number + len(words)]).tolist()]
        number += len(words)
    return total, total - int(stay.sum()), b" ".join(kept)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_removed, and ``kept``: the text without repeated passages.

    Words end at ASCII white space. A word goes if a window of 20 words covers it whose
    words also begin earlier: in a smaller key, or earlier in the same document. Windows
    are those of the input. ``kept`` is the remaining words joined by one space. Null
    and empty texts have no words. The key is an integer; null keys come last, and
    rows that share a key count as one document: windows at the same place are neither's
    earlier one. Repeated rows give repeated results, an empty table none. Columns of
    ``docs`` named n_words, n_removed or kept are replaced; it may not have the names __t1, __t2,
    __nil, __order, __places, __packed, __first and __whole.

    Rows are exchanged once, by their texts: to meet the places of confirmed phrases, and again
    what is removed from them. All work follows the size of the texts; a hot phrase or window is a partial
    aggregate or a join that adaptive execution splits.
    """
    whole_text = F.coalesce(F.col(text), F.lit(""))
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept")]
    nil = F.when(F.col(key).isNull(), 1).otherwise(0).cast("long")
    order = F.coalesce(F.col(key).cast("long"), F.lit(0))
    source = docs.select(whole_text.alias("text"), nil.alias("nil"), order.alias("order"), *(c.alias(n) for n, c in identity(whole_text).items()))
    at = F.struct("nil", "order")
    known_texts = settle(source.groupBy("t1", "t2").agg(F.min(at).alias("at"), F.max(at).alias("last")), "texts")
    places = settle_compressed(representative_places(source), "places")
    # Copies of one text have the same places; what occurs at one place only does not recur.
    spot = F.xxhash64("t1", "place")
    recurring = settle(
        places.groupBy("hash").agg(F.min(spot).alias("one"), F.max(spot).alias("other")).where("one <> other").select("hash"), "recurring"
    )
    confirmed = places.join(recurring, "hash").groupBy("t1").agg(F.collect_set("place").alias("places"))
    spread = settle(confirmed.join(known_texts, "t1").select("t1", "t2", "at.*", "places"), "confirmed")
    # Both joins below exchange the same rows by the same columns: Spark does so once.
    rows = docs.select(*names, *(c.alias(f"__{n}") for n, c in identity(whole_text).items()))
    texts = rows.join(spread.withColumnsRenamed({c: f"__{c}" for c in spread.columns}), ["__t1", "__t2"])
    packed = F.col("later").isNotNull()
    among = Window.partitionBy("high", "low", packed).orderBy("nil", "order", "place")
    later = located_windows(texts, key, text).withColumn("rank", F.rank().over(among)).where(packed | (F.col("rank") > 1))
    place = F.when(F.col("later").isNull(), F.col("place"))
    windows = later.groupBy("t1", "nil", "order").agg(F.collect_set(place).alias("__places"), F.collect_set("later").alias("__packed"))
    # A text loses its windows, and its later copies all words.
    removed = known_texts.select("t1", "t2", "at.*", "at", "last").join(windows, ["t1", "nil", "order"], "left").where(
        "__places is not null or at <> last"
    ).select(F.col("t1").alias("__t1"), F.col("t2").alias("__t2"), "__places", "__packed", F.col("at").alias("__first"))
    tied = rows.join(removed, ["__t1", "__t2"], "left")
    copied = F.struct(nil.alias("nil"), order.alias("order")) > F.col("__first")
    schema = T.StructType([
        *(docs.schema[c] for c in names), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text=text):
            rows = []
            gone = zip(*(batch.column(c) for c in ("__places", "__packed", "__whole")))
            for one, (at, packed, whole) in zip(texts_of(batch.column(text)), gone):
                held = np.empty(0, dtype=np.int64)
                if at.is_valid:
                    held = np.concatenate([at.values.to_numpy(), np.frombuffer(b"".join(packed.as_py()), "<i8")])
                rows.append(cut(one.encode(), held, bool(whole.as_py())))
            totals, counts, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names), pa.array(totals, pa.int64()), pa.array(counts, pa.int64()),
                    pa.array([k.decode() for k in kept], pa.string()),
                ],
                schema.names,
            )

    return tied.select(*names, "__places", "__packed", copied.alias("__whole")).mapInArrow(run, schema)
