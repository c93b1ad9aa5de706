"""Prompt templates: text with ``{slots}`` that are filled from columns.

The wording is configuration. ``DEFAULT_TEMPLATES`` can be replaced by any table
or mapping with the same slots; only the output markers named in ``fixed`` must
stay, because the parsers look for them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lingmill import fixed

_PAIR_FORMAT = f"{fixed.PROMPT_MARKER}\n<the prompt>\n\n{fixed.RESPONSE_MARKER}\n<the response>"
_SCORES = ", ".join(f'"{name}": 10' for name in fixed.SCORE_FIELDS)

DEFAULT_TEMPLATES: dict[str, str] = {
    # article -> one prompt and its response
    "article_pair": (
        "Read the {language} article below. Invent a {prompt_type} in {language} that someone "
        "could put to an assistant about its subject without having read it, then answer it in "
        "{language}, relying on the article for facts.\n\nReply in this form:\n\n" + _PAIR_FORMAT
    ),
    # the same, steered towards a kind of task
    "article_pair_by_category": (
        "Read the {language} article below. Invent a {prompt_type} in {language} that asks an "
        "assistant to {category} something about its subject, understandable without the "
        "article, then answer it in {language}, relying on the article for facts.\n\n"
        "Reply in this form:\n\n" + _PAIR_FORMAT
    ),
    # article -> up to five questions with answers
    "article_questions": (
        "Read the {language} article below. Write at most 5 questions in {language} that only "
        "this article answers, each with its answer, without mentioning the article. If it "
        f'holds too little, reply "{fixed.NO_INFORMATION_MARKER}".\n\nReply in this form:\n\n'
        "<<QUESTION 1>>\n<a question>\n\n<<ANSWER 1>>\n<its answer>"
    ),
    "article_body": "{title}\n\n{text}",
    # rewrite an input and its output
    "revise_pair": (
        "Rewrite the input and output below as a natural, helpful and brief exchange between a "
        "user and an assistant in fluent {language}.\n\nReply in this form:\n\n"
        f"{fixed.REVISED_INPUT_HEADER}\n<the input>\n\n{fixed.REVISED_OUTPUT_HEADER}\n<the output>"
    ),
    "revise_body": "<INPUT>\n{inputs}\n\n<OUTPUT>\n{targets}",
    # rank lettered responses
    "rank_responses": (
        "Compare the responses to the prompt. Discuss them briefly in the order {order}, then "
        "rank all of them from best to worst: '>' between unequal and '=' between equal ones, "
        "for example 'B>A=C'. Judge relevance, truth, accuracy, fluency and detail.\n\n"
        f"Reply in this form:\n\n{fixed.EXPLANATION_HEADER}\n<short discussion>\n\n"
        f"{fixed.RANKING_MARKER}\n<the ranking>"
    ),
    # score a prompt and its response
    "score_pair": (
        "Score the {language} {prompt_type} and its response from 1 to 10 on each of these, "
        "strictly, and reply with JSON only:\n\n{{" + _SCORES + "}}"
    ),
    "score_body": (
        f"{fixed.PROMPT_MARKER}\n\n{{prompt}}\n\n{fixed.RESPONSE_MARKER}\n\n{{response}}"
    ),
    # few-shot request for a numbered list of prompts
    "prompt_list": (
        "You are given a language and a number. Write that many varied prompts that people could "
        "send to an assistant in that language, not translated from other languages and not "
        "repeating one another.\n\nReply in this form:\n\n1. FIRST PROMPT\n2. SECOND PROMPT"
    ),
    "prompt_list_request": "{language} - {count} prompts",
}

_SLOT = re.compile(r"\{\{|\}\}|\{(\w+)\}")


def fill(template: str, slots: Mapping[str, Column]) -> Column:
    """The template as a string column; ``{{`` and ``}}`` stand for braces."""
    parts: list[Column] = []
    at = 0
    for found in _SLOT.finditer(template):
        parts.append(F.lit(template[at : found.start()]))
        if found.group(1):
            parts.append(slots[found.group(1)].cast("string"))
        else:
            parts.append(F.lit(found.group(0)[0]))
        at = found.end()
    parts.append(F.lit(template[at:]))
    return F.concat(*parts)


def render(
    name: str, templates: Mapping[str, str] | None = None, **slots: Column
) -> Column:
    """One of the named templates, filled."""
    return fill((templates or DEFAULT_TEMPLATES)[name], slots)
