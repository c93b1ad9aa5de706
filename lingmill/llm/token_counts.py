"""Token counts of a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton enumerates all pieces that end at each place of a word, and a
Viterbi pass carries the best score and its number of pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lingmill.llm.common import slices, texts_of, unchanged

# The marker put before each word; the penalty of an unknown character below the worst score.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
MEMO_WORDS = 1_000_000
WORDS_AT_ONCE = 200_000

# White space by Unicode's property.
BREAKS = re.compile("[\t-\r \x85\xa0  -     　]+")
# What str.split() takes for white space beyond that.
SEPARATORS = re.compile("[\x1c-\x1f]")


def read_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece file, without control, unknown and byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


class WordCounts(dict):
    """Memo of the number of tokens of a word."""

    def __init__(self, pieces: Sequence[tuple[str, float]], byte_fallback: bool):
        super().__init__()
        if any(score > 0 for _, score in pieces):
            raise ValueError("scores are log probabilities and must not be positive")
        self.byte_fallback = byte_fallback
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        self.matches = ahocorasick.Automaton()
        for piece, score in pieces:
            self.matches.add_word(piece, (len(piece), score))
        if pieces:
            self.matches.make_automaton()
        self.any = bool(pieces)

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        marked = word if word.startswith(SPACE) else SPACE + word
        if SPACE in word:
            count = sum(self.viterbi(part) for part in re.findall(f"{SPACE}[^{SPACE}]*", marked))
        else:
            count = self.viterbi(marked)
        self[word] = count
        return count

    def viterbi(self, word: str) -> int:
        """Tokens on the best path through ``word``.

        Of equal scores the path whose last piece starts first wins; an unknown character
        is considered only where no piece of one character ends, and last. A run of unknown
        characters is one token, or one for each byte with ``byte_fallback``.
        """
        size = len(word)
        best = [0.0] * (size + 1)
        count = [0] * (size + 1)
        open_run = [False] * (size + 1)
        done = 0

        def unknown(end: int, candidate: float | None) -> None:
            score = best[end - 1] + self.unknown
            if candidate is None or score > candidate:
                best[end] = score
                if self.byte_fallback:
                    count[end] = count[end - 1] + len(word[end - 1].encode())
                else:
                    count[end] = count[end - 1] + (not open_run[end - 1])
                open_run[end] = True

        found, single = None, False
        for last, (length, score) in self.matches.iter(word) if self.any else ():
            end = last + 1
            while done + 1 < end:  # places that no piece ends at, or that are complete
                done += 1
                if not single:
                    unknown(done, found)
                found, single = None, False
            score += best[end - length]
            if found is None or score > found:
                best[end] = found = score
                count[end] = count[end - length] + 1
                open_run[end] = False
            single = single or length == 1
        while done < size:
            done += 1
            if not single:
                unknown(done, found)
            found, single = None, False
        return count[size]


def count_text(text: str, counts: WordCounts) -> int:
    total = 0
    if len(text) <= WORDS_AT_ONCE * 5:
        spans = [text]
    else:
        # A break every so often, so that a very long text is not held as words at once.
        spans, at = [], 0
        while at < len(text):
            cut = BREAKS.search(text, at + WORDS_AT_ONCE * 5)
            end = cut.end() if cut else len(text)
            spans.append(text[at:end])
            at = end
    for span in spans:
        words = [w for w in BREAKS.split(span) if w] if SEPARATORS.search(span) else span.split()
        total += sum(map(counts.__getitem__, words))
    return total


def with_token_count(
    docs: DataFrame,
    pieces: Sequence[tuple[str, float]],
    text: str = "text",
    count: str = "n_tokens",
    byte_fallback: bool = True,
) -> DataFrame:
    """``docs`` with the number of unigram tokens of every whole text.

    Words end at white space and get a marker in front; each is segmented by itself, with
    the tie rules of the tokenizers library's unigram model. Null and empty texts have
    none. A column of the count's name is replaced. Rows are independent; one scan, no shuffle. The
    vocabulary travels with the job.
    """
    names = unchanged(docs, count)
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField(count, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = WordCounts(pieces, byte_fallback)
        for batch in slices(batches):
            found = [count_text(t, counts) for t in texts_of(batch.column(text))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(found, pa.int64())], [*names, count]
            )

    return docs.mapInArrow(run, schema)
