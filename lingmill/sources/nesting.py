"""Turn tables (one row a message) to nested chats."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def leading_messages(
    turns: DataFrame,
    key: str,
    order_by: str,
    content: str = "text",
    role: str = "role",
    n: int = 2,
    name: str = "conversation",
) -> DataFrame:
    """``key, conversation``: the first ``n`` messages of each chat as an array.

    For operators on the first exchange. Those that look at every message work on turn
    rows instead (``first_by_role``, ``trainset.mask_turns``, ``trainset.turn_problems``).
    Later messages are cut by a rank filter that Spark also applies before the shuffle, so
    one endless chat costs ``n`` rows a map task.
    """
    place = Window.partitionBy(key).orderBy(order_by)
    leading = turns.select(
        key, F.col(content).alias("content"), F.col(role).alias("role"),
        F.row_number().over(place).alias("_place"),
    ).where(F.col("_place") <= n)
    ordered = F.array_sort(F.collect_list(F.struct("_place", "content", "role")))
    messages = F.transform(
        ordered, lambda m: F.struct(m["content"].alias("content"), m["role"].alias("role"))
    )
    return leading.groupBy(key).agg(messages.alias(name))


def first_by_role(
    turns: DataFrame, key: str, order_by: str, wanted: str, content: str = "text", role: str = "role",
    name: str = "first_message",
) -> DataFrame:
    """``key, name``: each chat's first message by ``wanted``, wherever it stands; null if none.

    A minimum per key, combined before the shuffle: an endless chat costs a row a map task.
    """
    place = F.when(F.col(role) == wanted, F.col(order_by))
    return turns.groupBy(key).agg(F.min_by(content, place).alias(name))
