"""Judge ballots: rendering requests and parsing the replies, within each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import text
from lingmill.functions.binding import let, with_once
from lingmill.operators import sampling


def lettered_models(models: Column, key: list[Column], seed: int | str = 0) -> Column:
    """Models in a drawn order as ``array<struct<letter, model>>``."""
    return F.transform(
        sampling.shuffled(models, key, seed),
        lambda m, i: F.struct(text.letter(i).alias("letter"), m.alias("model")),
    )


def letter_order(count: Column, key: list[Column], seed: int | str = 0) -> Column:
    """The first ``count`` letters in a drawn order, for the judge's instructions."""
    letters = F.transform(F.sequence(F.lit(0), count - 1), text.letter)
    return F.array_join(sampling.shuffled(letters, key, f"order-{seed}"), ", ")


def ballot_request(prompt: Column, answers: Column, lettered: Column) -> Column:
    """The prompt followed by every labelled response."""
    head, tail = fixed.RESPONSE_HEADER.split("{letter}")
    responses = F.transform(
        lettered,
        lambda x: F.concat(
            F.lit("\n\n" + head), x["letter"], F.lit(tail + "\n"),
            F.element_at(answers, x["model"])["content"],
        ),
    )
    return F.concat(F.lit(fixed.PROMPT_HEADER + "\n"), prompt, F.array_join(responses, ""))


def parse_ballot(response: Column, lettered: Column) -> Column:
    """A judge's reply as ``struct<status, levels: array<array<struct<letter, model>>>>``.

    The ranking is what follows the last ranking marker. Status is one of

    - ok
    - no_reply: the call gave nothing
    - no_marker: no ranking in the reply
    - repeated: an id occurs twice, compared before stripping
    - unknown: an id, once stripped, is not exactly one of the letters

    The first problem from the left decides between the last two. ``levels`` is
    null unless the status is ok.
    """

    def matches(one_id: Column) -> Column:
        return F.filter(lettered, lambda x: x["letter"] == text.strip(one_id))

    def judged(parts: Column) -> Column:
        ranking = text.strip(F.element_at(parts, -1))
        ids = F.transform(F.split(ranking, ">", -1), lambda level: F.split(level, "=", -1))
        return let(ids, lambda levels: let(F.flatten(levels), lambda flat: result(parts, levels, flat)))

    def result(parts: Column, levels: Column, flat: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(flat))
        never = F.lit(2**31 - 1)
        repeat = F.filter(at, lambda i: F.array_position(flat, F.element_at(flat, i)) < i)
        stranger = F.filter(at, lambda i: F.size(matches(F.element_at(flat, i))) != 1)
        first_repeat = F.coalesce(F.array_min(repeat), never)
        first_stranger = F.coalesce(F.array_min(stranger), never)
        status = (
            F.when(response.isNull(), "no_reply")
            .when(F.size(parts) < 2, "no_marker")
            .when(F.size(repeat) + F.size(stranger) == 0, "ok")
            .when(first_repeat <= first_stranger, "repeated")
            .otherwise("unknown")
        )
        named = F.transform(
            levels, lambda level: F.transform(level, lambda one_id: F.get(matches(one_id), F.lit(0)))
        )
        return let(
            status,
            lambda s: F.struct(s.alias("status"), F.when(s == "ok", named).alias("levels")),
        )

    # A missing reply still has to come out as a struct.
    reply = F.coalesce(response, F.lit(""))
    return let(F.split(reply, fixed.RANKING_MARKER, -1), judged)


def with_ballots(
    df: DataFrame, evals: str = "model_evals", name: str = "ballots"
) -> DataFrame:
    """Add every round's parse, in round order: ``array<struct<status, levels>>``."""
    parsed = F.transform(
        F.col(evals), lambda e: parse_ballot(e["eval_response"], e["model_id_list"])
    )
    return with_once(df, name, parsed)


def valid_levels(ballots: Column) -> Column:
    """Levels of the valid ballots, in round order."""
    return F.transform(
        F.filter(ballots, lambda b: b["status"] == "ok"), lambda b: b["levels"]
    )


def unknown_ballots(df: DataFrame, key: str, ballots: str = "ballots") -> DataFrame:
    """Quarantine: (key, round) of ballots that name an id nobody has."""
    exploded = df.select(key, F.posexplode(ballots).alias("round", "ballot"))
    return exploded.where(F.col("ballot.status") == "unknown").select(key, "round")


def long_ballots(
    df: DataFrame, key: str, ballots: str = "ballots"
) -> DataFrame:
    """Valid ballots as rows: ``key, round, level, letter, model``.

    ``round`` counts all rounds from 0, ``level`` the ranking's levels from 0.
    """
    rounds = df.select(key, F.posexplode(ballots).alias("round", "ballot"))
    levels = rounds.where(F.col("ballot.status") == "ok").select(
        key, "round", F.posexplode("ballot.levels").alias("level", "members")
    )
    return levels.select(key, "round", "level", F.explode("members").alias("m")).select(
        key, "round", "level", "m.letter", "m.model"
    )
