"""Explicit schemas of the input and output tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()

MESSAGE = _struct(("content", S), ("role", S))
TURN = _struct(("from", S), ("value", S))
DETECTION = _struct(("lang", S), ("score", D))
ANSWER = _struct(("content", S), ("finish_reason", S))
MODERATION = _struct(("categories", T.MapType(S, T.BooleanType())))
LETTERED_MODEL = _struct(("letter", S), ("model", S))
JUDGEMENT = _struct(
    ("model_id_list", T.ArrayType(LETTERED_MODEL)),
    ("eval_response", S),
    ("eval_finish_reason", S),
    ("eval_model_name", S),
)
# Result of one model call: content and finish_reason, or bad_request, or error.
CALL_RESULT = _struct(
    ("content", S),
    ("finish_reason", S),
    ("bad_request", S),
    ("error", S),
    ("prompt_tokens", L),
    ("completion_tokens", L),
)

CHATS = _struct(
    ("conversation_id", S),
    ("conversation", T.ArrayType(MESSAGE)),
    ("language", S),
    ("openai_moderation", T.ArrayType(MODERATION)),
)
JUDGED_CHATS = T.StructType(
    CHATS.fields
    + _struct(
        ("llm_responses", T.MapType(S, ANSWER)),
        ("model_evals", T.ArrayType(JUDGEMENT)),
    ).fields
)
