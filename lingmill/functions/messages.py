"""Functions over nested chats: ``array<struct<content, role>>`` and answer maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lingmill import fixed


def first_message(conversation: Column, first_role: str | None = None) -> Column:
    """Content of message 0, or of the first message by ``first_role``."""
    if first_role is None:
        return F.get(conversation, F.lit(0))["content"]
    return F.get(F.filter(conversation, lambda m: m["role"] == first_role), F.lit(0))["content"]


def first_exchange(conversation: Column) -> Column:
    """The first two messages joined by a space."""
    return F.array_join(F.transform(F.slice(conversation, 1, 2), lambda m: m["content"]), " ")


def flagged(moderation: Column) -> Column:
    """Whether any category of the first moderation record is true."""
    categories = F.map_values(F.get(moderation, F.lit(0))["categories"])
    return F.coalesce(F.exists(categories, lambda v: F.coalesce(v, F.lit(False))), F.lit(False))


def human_gpt_turns(prompt: Column, answer: Column) -> Column:
    """A two-turn training conversation."""
    return F.array(
        F.struct(F.lit("human").alias("from"), prompt.alias("value")),
        F.struct(F.lit("gpt").alias("from"), answer.alias("value")),
    )


def user_assistant_turns(prompt: Column, answer: Column) -> Column:
    """A two-message conversation for a preference pair."""
    return F.array(
        F.struct(prompt.alias("content"), F.lit("user").alias("role")),
        F.struct(answer.alias("content"), F.lit("assistant").alias("role")),
    )


def every_answer_present(answers: Column) -> Column:
    return F.forall(F.map_values(answers), lambda a: a["content"].isNotNull())


def every_answer_finished(answers: Column) -> Column:
    return F.forall(
        F.map_values(answers), lambda a: F.coalesce(a["finish_reason"] == "stop", F.lit(False))
    )


def model_names(answers: Column) -> Column:
    """Model names in sorted order."""
    return F.sort_array(F.map_keys(answers))


def put_answer(answers: Column, model: str, content: Column, finish_reason: Column) -> Column:
    """Add or replace one model's answer, but never a good one."""
    new = F.create_map(
        F.lit(model),
        F.struct(content.alias("content"), finish_reason.alias("finish_reason")),
    )
    had_one = F.coalesce(F.element_at(answers, model)["content"].isNotNull(), F.lit(False))
    others = F.map_filter(answers, lambda k, v: k != model)
    return F.when(had_one, answers).when(answers.isNull(), new).otherwise(F.map_concat(others, new))


def positional_answer(response: Column) -> Column:
    """``[content, finish_reason]`` as a named struct."""
    return F.struct(
        F.get(response, F.lit(0)).alias("content"),
        F.get(response, F.lit(1)).alias("finish_reason"),
    )


def routed_to_hosted(model: Column) -> Column:
    """Whether calls for this model go to the hosted service."""
    return model.contains(fixed.HOSTED_MODEL_SUBSTRING)


def call_cost(prompt_tokens: Column, completion_tokens: Column) -> Column:
    """Dollars for one call, unrounded."""
    return (
        completion_tokens * F.lit(fixed.COMPLETION_DOLLARS_PER_MILLION)
        + prompt_tokens * F.lit(fixed.PROMPT_DOLLARS_PER_MILLION)
    ) / F.lit(1_000_000)


def trained_messages(conversations: Column, reply_from: str = "gpt") -> Column:
    """The turns with a flag saying whether loss is taken on each: replies only."""
    return F.transform(
        conversations,
        lambda m: F.struct(
            m["from"].alias("from"),
            m["value"].alias("value"),
            (m["from"] == reply_from).alias("train"),
        ),
    )
