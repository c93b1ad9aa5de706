"""Byte-level BPE by backtracking over longest matches.

A token sequence is the merge result of its bytes exactly when every pair of
neighbours is the merge result of its own bytes. So a piece is encoded by taking the
longest vocabulary entry at each place, and stepping back to a shorter one whenever
it does not fit the token before it. Each place is given up at most once, which
bounds the steps by the length of the piece.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterable, Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lingmill.llm.common import slices, texts_of, unchanged

# Entries kept by each memo of a task; a full memo starts anew.
MEMO_ENTRIES = 400_000
# Pieces of one text that are held at a time.
PIECES_AT_ONCE = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(data: bytes, ranks: dict[bytes, int], until: int = 1) -> list[bytes]:
    """Plain merging: join the neighbours of lowest rank, leftmost first, while any join
    and there are more than ``until``."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > until:
        best = min(
            ((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks),
            default=None,
        )
        if best is None:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Encoder:
    """Encodes pieces of bytes with one rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.width = max(map(len, ranks), default=0)
        self.starts = ahocorasick.Automaton()
        for token in ranks:
            self.starts.add_word(token.decode("latin-1"), len(token))
        self.longest_memo: dict[str, bytes] = {}
        self.last_merge_memo: dict[bytes, tuple[bytes, bytes, bool] | None] = {}
        self.fits_memo: dict[tuple[bytes, bytes], bool] = {}
        self.shorter_memo: dict[bytes, bytes] = {}

    def longest(self, text: str, at: int) -> bytes:
        """The longest token at this place of a piece, given as Latin-1; empty if none."""
        near = text[at : at + self.width]
        # As far as some token goes on: one of the trie's nodes, so the memo is bounded.
        start = near[: self.starts.longest_prefix(near)]
        known = self.longest_memo.get(start)
        if known is None:
            known = start.encode("latin-1")
            if known not in self.ranks:
                known = self.shorter(known)
            self.longest_memo[start] = known
        return known

    def last_merge(self, token: bytes) -> tuple[bytes, bytes, bool] | None:
        """The two tokens that merge last on the way to this one, none for a byte, and whether
        ranks only rise on that way; None if merging its bytes does not end in it."""
        if token not in self.last_merge_memo:
            known = (b"", b"", True)
            if len(token) > 1:
                parts = merged(token, self.ranks, until=2)
                known = None
                if len(parts) == 2:
                    rising = all(
                        len(part) == 1 or (self.ranks[part] < self.ranks[token] and self.last_merge(part)[2])
                        for part in parts
                    )
                    known = (*parts, rising)
            self.last_merge_memo[token] = known
        return self.last_merge_memo[token]

    def stay_apart(self, left: bytes, right: bytes) -> bool:
        """Whether no merge crosses the border when the bytes of two merge results, both
        with rising ranks, are merged together.

        Their merges are undone from the last one back. Before each, the tokens then at the
        border were neighbours, and joined instead if that had the lower rank, or the
        same rank further left.
        """
        ranks = self.ranks
        # Rank and side of the merge undone last.
        next_merge = (math.inf, 0)
        while True:
            joint = ranks.get(left + right)
            if joint is not None and (joint, 0) < next_merge:
                return False
            of_left = (ranks[left], 0) if len(left) > 1 else (-1, 0)
            of_right = (ranks[right], 1) if len(right) > 1 else (-1, 0)
            if of_left > of_right:
                next_merge, left = of_left, self.last_merge(left)[1]
            elif of_right > of_left:
                next_merge, right = of_right, self.last_merge(right)[0]
            else:
                return True

    def fits(self, left: bytes, right: bytes) -> bool:
        """Whether merging ``left + right`` ends in just these two tokens
        (in ``right`` alone if ``left`` is empty); ``left`` is a merge result."""
        key = (left, right)
        known = self.fits_memo.get(key)
        if known is None:
            if len(self.fits_memo) >= MEMO_ENTRIES:
                self.fits_memo.clear()
            known = self.last_merge(right) is not None
            if known and left:
                if self.last_merge(left)[2] and self.last_merge(right)[2]:
                    known = self.stay_apart(left, right)
                else:
                    known = merged(left + right, self.ranks) == [left, right]
            self.fits_memo[key] = known
        return known

    def shorter(self, token: bytes) -> bytes:
        """The longest token that starts this one and is shorter; empty if none."""
        known = self.shorter_memo.get(token)
        if known is None:
            known = b""
            for end in range(len(token) - 1, 0, -1):
                if token[:end] in self.ranks:
                    known = token[:end]
                    break
            self.shorter_memo[token] = known
        return known

    def encode(self, piece: bytes) -> list[int]:
        if not piece:
            return []
        if piece in self.ranks:
            return [self.ranks[piece]]
        text, size = piece.decode("latin-1"), len(piece)
        out: list[bytes] = []
        closed = bytearray(size + 1)
        at, token = 0, self.longest(text, 0)
        while at < size:
            last = out[-1] if out else b""
            while token and (closed[at + len(token)] or not self.fits(last, token)):
                token = self.shorter(token)
            if token:
                out.append(token)
                at += len(token)
                token = self.longest(text, at)
            else:
                if not out:
                    raise ValueError("the vocabulary cannot spell these bytes")
                closed[at] = 1
                token = out.pop()
                at -= len(token)
        return [self.ranks[token] for token in out]


class PieceCodes(dict):
    """Memo of a piece's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        code = np.array(self.encoder.encode(piece.encode()), dtype="<u4").tobytes()
        self[piece] = code
        return code


def encode_text(text: str, pattern, codes: PieceCodes) -> bytes:
    if len(text) <= PIECES_AT_ONCE:
        return b"".join(map(codes.__getitem__, pattern.findall(text)))
    found = (match.group() for match in pattern.finditer(text))
    parts = []
    while some := list(islice(found, PIECES_AT_ONCE)):
        parts.append(b"".join(map(codes.__getitem__, some)))
    return b"".join(parts)


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    keep: Iterable[str] = ("doc_id",),
    ids: str = "ids",
) -> DataFrame:
    """The ``keep`` columns and every whole text as token ids.

    ``ids`` is binary: little-endian unsigned 32-bit integers, as the tiktoken library
    would give for the text without special tokens; each match of ``pattern`` is
    encoded by itself. A null or empty text has no ids. Rows are independent: repeated
    rows and keys, and null keys, come through as they are; a kept column of the ids'
    name is replaced. One scan, no shuffle.
    """
    keep = [c for c in keep if c != ids]
    source = docs.select(*keep, docs[text].alias("__text"))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(ids, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = PieceCodes(Encoder(read_ranks(ranks_path)))
        compiled = regex.compile(pattern)
        for batch in slices(batches, text="__text"):
            encoded = [encode_text(t, compiled, codes) for t in texts_of(batch.column("__text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(encoded, pa.binary())], [*keep, ids]
            )

    return source.mapInArrow(run, schema)


def decode(
    encoded: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """Adds the bytes that the ids stand for, in place of a column of that name; null ids give null."""
    names = unchanged(encoded, decoded)
    schema = T.StructType([*(encoded.schema[c] for c in names), T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(ranks_path)
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        for batch in slices(batches):
            out = [
                None
                if code is None
                else b"".join(map(tokens.__getitem__, np.frombuffer(code, "<u4").tolist()))
                for code in batch.column(ids).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(out, pa.binary())], [*names, decoded]
            )

    return encoded.mapInArrow(run, schema)
