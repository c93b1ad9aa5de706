"""Text functions with the exact edge-case behaviour the datasets depend on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lingmill import fixed

# --- fixed values: characters that str.strip() removes, and the list-item trim set
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LIST_ITEM_TRIM = " .-。"


def strip(text: Column) -> Column:
    """Trim all Unicode whitespace; SQL ``trim`` would remove spaces only."""
    return F.btrim(text, F.lit(WHITESPACE))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Whether the lowercased text contains any word as a plain substring."""
    low = F.lower(text)
    hit = F.lit(False)
    for word in words:
        hit = hit | low.contains(word)
    return hit


def newlines_to_spaces(text: Column) -> Column:
    return F.translate(text, "\n", " ")


def numbered_items(text: Column) -> Column:
    """Items of a numbered list, by absolute line number.

    Line i (from 0, blank lines counted) is an item if it starts with ``i + 1``;
    that prefix is cut and list punctuation trimmed. Blank items go. A preamble
    line therefore shifts all later numbers out of place, by design.
    """

    def item(line: Column, i: Column) -> Column:
        number = (i + 1).cast("string")
        rest = line.substr(F.length(number) + 1, F.length(line))
        return F.when(line.startswith(number), F.btrim(rest, F.lit(LIST_ITEM_TRIM)))

    items = F.transform(F.split(text, "\n", -1), item)
    return F.filter(items, lambda x: x.isNotNull() & (F.length(strip(x)) > 0))


def render_numbered(items: Column) -> Column:
    """``1. first`` and so on, one item a line."""
    lines = F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x))
    return F.array_join(lines, "\n")


def id_stem(chunk_id: Column) -> Column:
    """All but the last ``_`` part; empty when there is no ``_``."""
    tail = F.length(F.substring_index(chunk_id, "_", -1))
    return chunk_id.substr(F.lit(1), F.length(chunk_id) - tail - 1)


def id_tail(chunk_id: Column) -> Column:
    """The last ``_`` part (the whole id when there is no ``_``)."""
    return F.substring_index(chunk_id, "_", -1)


def _after_prompt_marker(reply: Column) -> Column:
    """Text after the first prompt marker; null without one."""
    start = F.instr(reply, fixed.PROMPT_MARKER)
    rest = reply.substr(start + len(fixed.PROMPT_MARKER), F.length(reply))
    return F.when(start > 0, rest)


def _marked_parts(reply: Column) -> tuple[Column, Column]:
    """Raw prompt and response: split at the last response marker with text after it.

    A marker that ends the text is part of the response of the one before it. Both
    parts need at least one character; otherwise both are null. Plain substring
    functions do this in one scan, where a greedy pattern would backtrack.
    """
    marker = fixed.RESPONSE_MARKER
    rest = _after_prompt_marker(reply)
    ending = F.when(rest.endswith(marker), F.lit(marker)).otherwise("")
    body = rest.substr(F.lit(1), F.length(rest) - F.length(ending))
    tail = F.substring_index(body, marker, -1)
    head_length = F.length(body) - F.length(tail) - len(marker)
    usable = body.contains(marker) & (head_length > 0)
    return (
        F.when(usable, body.substr(F.lit(1), head_length)),
        F.when(usable, F.concat(tail, ending)),
    )


def marked_prompt(reply: Column) -> Column:
    """Text between the prompt marker and the last usable response marker, stripped."""
    return strip(_marked_parts(reply)[0])


def marked_response(reply: Column) -> Column:
    """Text after the last response marker that has text after it, stripped."""
    return strip(_marked_parts(reply)[1])


def zero_padded(number: Column, digits: int = 6) -> Column:
    """Zero-padded text; longer numbers stay whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0"))


def as_text(value: Column) -> Column:
    """Any value as text, a missing one as the word ``nan``."""
    return F.coalesce(value.cast("string"), F.lit("nan"))


def letter(i: Column) -> Column:
    """A, B, C, … for 0, 1, 2, …"""
    return F.char(F.lit(65) + i)


def word_count(text: Column) -> Column:
    """Default token counter: runs of word characters and single punctuation marks."""
    return F.regexp_count(text, F.lit(r"\w+|[^\w\s]"))


def truncate_words(text: Column, limit: int) -> Column:
    """Default truncation: the first ``limit`` whitespace-separated tokens.

    Text within the limit is returned unchanged.
    """
    tokens = F.split(text, r"\s+")
    # A text of fewer characters than the limit needs no splitting.
    return F.when((F.length(text) < limit) | (F.size(tokens) <= limit), text).otherwise(
        F.array_join(F.slice(tokens, 1, limit), " ")
    )


def revision_budget(input_tokens: Column, output_tokens: Column) -> Column:
    """Completion budget of a revision call."""
    wanted = (F.lit(fixed.REVISION_TOKEN_FACTOR) * (input_tokens + output_tokens)).cast("int")
    return F.least(F.lit(fixed.REVISION_TOKEN_CAP), wanted)
