"""Seeded draws that depend on a row's key only, never on its partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_hash(keys: Sequence[Column], seed: int | str = 0) -> Column:
    """32 hexadecimal digits that order rows at random but repeatably.

    Equal to ``md5(concat_ws('|', key..., seed))`` in any SQL engine.
    """
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed))))


def draw_below(keys: Sequence[Column], seed: int | str, limit: int) -> Column:
    """A whole number in [0, limit), uniform over keys."""
    head = F.conv(F.substring(order_hash(keys, seed), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(limit).cast("long"))


def uniform(keys: Sequence[Column], seed: int | str) -> Column:
    """A number between 0 and 1, neither of them, uniform over keys."""
    head = F.conv(F.substring(order_hash(keys, seed), 1, 13), 16, 10).cast("double")
    return (head + 0.5) / float(1 << 52)


def pick(options: Sequence[str], keys: Sequence[Column], seed: int | str) -> Column:
    """One of ``options``, chosen by the key."""
    choice = draw_below(keys, seed, len(options)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(o) for o in options]), choice)


def coin(keys: Sequence[Column], seed: int | str) -> Column:
    """True for half of all keys."""
    return draw_below(keys, seed, 2) == 1
