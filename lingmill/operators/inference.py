"""Keyed batch calls of an external model, with resume, retry and routing.

The model is a plain function from a row to a result; the job around it is
Spark's: partitions are the workers, keys identify results, failures are values
in the result and never fail the job.
"""

from __future__ import annotations

import hashlib
import random
import time
from collections import deque
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lingmill import fixed, schemas
from lingmill.functions import messages, templates, text
from lingmill.operators import ballots, sampling
from lingmill.sources.journal import Journal

Call = Callable[[Mapping], Mapping]

# By how much of its length a paced wait may be longer.
JITTER = 0.2

# Rows and bytes of the inputs that a task has as Python rows at once, a single larger row apart.
PART_ROWS = 1024
PART_BYTES = 1 << 20
# Calls handed to each worker before the oldest answers are waited for.
CALLS_AHEAD = 8

_FIELDS = [f.name for f in schemas.CALL_RESULT.fields]
_RESULT_TYPE = pa.struct(
    [
        (f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.string())
        for f in schemas.CALL_RESULT.fields
    ]
)


class RejectedRequest(Exception):
    """Raised by a call when the service refuses the request; its text is kept."""


def echo(row: Mapping) -> dict:
    """Default stand-in for a model: repeats the prompt."""
    prompt = row["prompt"]
    return {
        "content": prompt,
        "finish_reason": "stop",
        "prompt_tokens": len(prompt),
        "completion_tokens": len(prompt),
    }


def failing_echo(seed: int = 0, tenths: int = 1) -> Call:
    """An echo that fails for about ``tenths`` in ten keys, chosen by hash."""

    def call(row: Mapping) -> dict:
        digest = hashlib.md5(f"{row['key']}|{seed}".encode()).hexdigest()
        if int(digest[:8], 16) % 10 < tenths:
            raise RuntimeError("no answer")
        return echo(row)

    return call


def attempt(call: Call, row: Mapping, retries: int = 0, backoff: float = 1.0) -> dict:
    """One call as a complete result record.

    A call that fails is tried again up to ``retries`` times, after about ``backoff`` seconds,
    then twice as many, and so on, each time between half and one and a half of that,
    so that callers turned away together do not come back together. A refused
    request is not tried again.
    """
    for number in range(retries + 1):
        try:
            got = dict(call(row) or {})
        except RejectedRequest as refused:
            got = {"bad_request": str(refused)}
        except Exception as failed:
            got = {"error": str(failed)}
            if number < retries:
                time.sleep(backoff * 2**number * random.uniform(0.5, 1.5))
                continue
        break
    return {name: got.get(name) for name in _FIELDS}


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in order, halved until a part is small or one row."""
    if batch.num_rows <= 1 or (batch.num_rows <= PART_ROWS and batch.nbytes <= PART_BYTES):
        yield batch
        return
    half = batch.num_rows // 2
    yield from _parts(batch.slice(0, half))
    yield from _parts(batch.slice(half))


def run_calls(
    df: DataFrame,
    key: Sequence[str],
    call: Call,
    inputs: Sequence[str] = ("prompt",),
    workers: int = 4,
    per_second: float | None = None,
    partitions: int | None = None,
    result: str = "result",
    carry: Sequence[str] = (),
    retries: int = 0,
    backoff: float = 1.0,
) -> DataFrame:
    """``key, carry, result`` for every row; ``call`` sees ``inputs`` and ``key``.

    Columns in ``carry`` pass through, which saves a join when the inputs are
    wanted next to their results.

    Each task keeps ``workers`` calls in flight, and hands on answers part by part of an Arrow batch, so that
    its memory is that of the batch and a few parts. ``partitions`` spreads rows evenly first, by
    key. ``per_second`` bounds the calls that the whole job starts in a second, however
    many executors it has: rows are spread over ``partitions`` tasks, by default one a core, and each
    starts its share, every call after a wait of its own length. ``retries`` of a failed call (``attempt``) are
    not paced, and hold one of the ``workers``. The output is recomputed if read twice: write it, or ``settle`` it, first.
    """
    kept = list(dict.fromkeys([*key, *carry]))
    seen = list(dict.fromkeys([*key, *inputs]))
    narrow = df.select(*dict.fromkeys([*kept, *inputs]))
    wait = 0.0
    if per_second:
        # Never more tasks than shares, so their sum is the limit.
        partitions = partitions or max(1, df.sparkSession.sparkContext.defaultParallelism)
        wait = partitions / per_second
    if partitions:
        narrow = sampling.scatter(narrow, key, partitions)
    schema = T.StructType(
        [narrow.schema[k] for k in kept] + [T.StructField(result, schemas.CALL_RESULT)]
    )

    def one(row: dict) -> dict:
        if "key" not in row:
            parts = [str(row[k]) for k in key]
            row = {**row, "key": "|".join(parts)}
        return attempt(call, row, retries, backoff)

    def submit(pool: ThreadPoolExecutor, part: pa.RecordBatch) -> list[Future]:
        pending = []
        for row in part.select(seen).to_pylist():
            if wait:
                time.sleep(wait * random.uniform(1.0, 1.0 + JITTER))
            pending.append(pool.submit(one, row))
        return pending

    def answered(part: pa.RecordBatch, pending: list[Future]) -> pa.RecordBatch:
        results = pa.array([p.result() for p in pending], type=_RESULT_TYPE)
        # Columns that pass through stay Arrow arrays, untouched.
        return pa.RecordBatch.from_arrays([*(part.column(name) for name in kept), results], [*kept, result])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = CALLS_AHEAD * workers
        with ThreadPoolExecutor(max_workers=workers) as pool:
            for batch in batches:
                # Only some parts of a batch are held as Python rows and answers. The oldest one
                # is waited for when enough later calls are there to keep the workers busy.
                waiting, calls = deque(), 0
                for part in _parts(batch):
                    waiting.append((part, submit(pool, part)))
                    calls += part.num_rows
                    while calls - waiting[0][0].num_rows >= ahead:
                        calls -= waiting[0][0].num_rows
                        yield answered(*waiting.popleft())
                while waiting:
                    yield answered(*waiting.popleft())
                # The next batch is read without this one in memory.
                batch = part = None

    return narrow.mapInArrow(run, schema)


def join_back(df: DataFrame, results: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inputs with their results, matched by key."""
    return df.join(results, list(key), "left")


def failed(result: str = "result") -> Column:
    return F.col(result).isNull() | F.col(result)["content"].isNull()


def fill_failures(first: DataFrame, second: DataFrame, key: Sequence[str], result: str = "result") -> DataFrame:
    """Results where rows that failed take the second attempt."""
    again = second.select(*key, F.col(result).alias("_again"))
    joined = first.join(again, list(key), "left")
    return joined.withColumn(
        result, F.when(failed(result), F.coalesce("_again", result)).otherwise(F.col(result))
    ).drop("_again")


def run_stored(
    df: DataFrame,
    key: Sequence[str],
    call: Call,
    journal: Journal | None = None,
    result: str = "result",
    entry: str = "calls",
    **options,
) -> DataFrame:
    """``run_calls`` through a journal: answers are stored part by part, and read from there.

    Given the journal of a run that did not end, only what is not stored yet is asked.
    """
    journal = journal or Journal.fresh(df.sparkSession, entry)
    return journal.answers(df, key, lambda rows: run_calls(rows, key, call, result=result, **options), entry)


def run_with_retry(
    df: DataFrame, key: Sequence[str], calls: Sequence[Call], result: str = "result", journal: Journal | None = None, **options
) -> DataFrame:
    """One pass per call in ``calls``; each later pass sees only failed rows.

    Every pass is an entry of the journal, so no call is repeated when results are read.
    """
    journal = journal or Journal.fresh(df.sparkSession, "calls")
    done = run_stored(df, key, calls[0], journal, result, "pass-1", **options)
    for number, call in enumerate(calls[1:], 2):
        open_rows = df.join(done.where(failed(result)).select(*key), list(key), "left_semi")
        again = run_stored(open_rows, key, call, journal, result, f"pass-{number}", **options)
        done = fill_failures(done, again, key, result)
    return done


def run_routed(
    df: DataFrame, key: Sequence[str], model: str, hosted: Call, local: Call, journal: Journal | None = None, **options
) -> DataFrame:
    """Calls of models with "gpt" in their name go to one function, others to another.

    The input is read once; rows without a model are left out. With a journal, answers are stored in it.
    """
    inputs = (*options.pop("inputs", ("prompt",)), model)

    def call(row: Mapping) -> Mapping:
        return hosted(row) if fixed.HOSTED_MODEL_SUBSTRING in row[model] else local(row)

    asked = df.where(F.col(model).isNotNull())
    if journal is None:
        return run_calls(asked, key, call, inputs=inputs, **options)
    return run_stored(asked, key, call, journal, inputs=inputs, **options)


def answer_map(results: DataFrame, key: Sequence[str], model: str, result: str = "result") -> DataFrame:
    """``key, llm_responses``: each key's results as ``map<model, struct<content, finish_reason>>``.

    A key has one row per model.
    """
    answer = F.struct(
        F.col(result)["content"].alias("content"),
        F.col(result)["finish_reason"].alias("finish_reason"),
    )
    pairs = F.collect_list(F.struct(F.col(model), answer))
    return results.groupBy(*key).agg(F.map_from_entries(pairs).alias("llm_responses"))


# --- the particular request kinds -----------------------------------------------


def judge_requests(
    df: DataFrame,
    key: Sequence[str],
    rounds: int = fixed.JUDGE_ROUNDS,
    conversation: str = "conversation",
    answers: str = "llm_responses",
    seed: int | str = 0,
    template: Mapping[str, str] | None = None,
) -> DataFrame:
    """One judging request per row and round: ``key, round, model_id_list, system, prompt``.

    Every round letters the models in a new order.
    """
    each = sampling.replicate(
        df.where(messages.every_answer_present(F.col(answers))), rounds, "round"
    )
    at = [*[F.col(k) for k in key], F.col("round")]
    lettered = each.withColumn(
        "model_id_list",
        ballots.lettered_models(messages.model_names(F.col(answers)), at, seed),
    )
    order = ballots.letter_order(F.size("model_id_list"), at, seed)
    return lettered.select(
        *key,
        "round",
        "model_id_list",
        templates.render("rank_responses", template, order=order).alias("system"),
        ballots.ballot_request(
            messages.first_message(F.col(conversation)), F.col(answers), F.col("model_id_list")
        ).alias("prompt"),
    )


def gather_rounds(
    requests: DataFrame, results: DataFrame, key: Sequence[str], judge: str, result: str = "result"
) -> DataFrame:
    """``key, model_evals``: the rounds of each key in order (a handful per key)."""
    joined = requests.select(*key, "round", "model_id_list").join(results, [*key, "round"], "left")
    one = F.struct(
        F.col("round"),
        F.col("model_id_list"),
        F.col(result)["content"].alias("eval_response"),
        F.col(result)["finish_reason"].alias("eval_finish_reason"),
        F.lit(judge).alias("eval_model_name"),
    )
    ordered = F.array_sort(F.collect_list(one))
    evals = F.transform(
        ordered,
        lambda e: F.struct(
            *[e[f.name].alias(f.name) for f in schemas.JUDGEMENT.fields]
        ),
    )
    return joined.groupBy(*key).agg(evals.alias("model_evals"))


def prompt_list_requests(
    languages: DataFrame,
    japanese_seeds: Sequence[str],
    english_seeds: Sequence[str],
    times: int = fixed.REQUESTS_PER_LANGUAGE,
    seed: int | str = 0,
    template: Mapping[str, str] | None = None,
) -> DataFrame:
    """Few-shot requests: ``language, repeat_id, system, shots, prompt``.

    Each request draws its own examples from the two seed lists, which are
    configuration and travel with the plan.
    """
    each = sampling.replicate(languages.select("language"), times)
    at = [F.col("language"), F.col("repeat_id")]

    def shots(items: Sequence[str], n: int, tag: str) -> Column:
        pool = F.array(*[F.lit(s) for s in items])
        return text.render_numbered(sampling.sample_items(pool, n, at, f"{tag}-{seed}"))

    def request(language: Column, count: int) -> Column:
        return templates.render(
            "prompt_list_request", template, language=language, count=F.lit(count)
        )

    def turn(role: str, content: Column) -> Column:
        return F.struct(content.alias("content"), F.lit(role).alias("role"))

    return each.select(
        "language",
        "repeat_id",
        templates.render("prompt_list", template).alias("system"),
        F.array(
            turn("user", request(F.lit("Japanese"), fixed.JAPANESE_SEEDS)),
            turn("assistant", shots(japanese_seeds, fixed.JAPANESE_SEEDS, "ja")),
            turn("user", request(F.lit("English"), fixed.ENGLISH_SEEDS)),
            turn("assistant", shots(english_seeds, fixed.ENGLISH_SEEDS, "en")),
        ).alias("shots"),
        request(F.col("language"), fixed.PROMPTS_REQUESTED).alias("prompt"),
    )


def article_requests(
    inputs: DataFrame,
    kind: str = "article_pair_by_category",
    limit: int = fixed.ARTICLE_TOKEN_LIMIT,
    body: Column | None = None,
    template: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``system`` and ``prompt`` for one of the three article templates."""
    cut = body if body is not None else text.truncate_words(F.col("text"), limit)
    slots = {"language": F.col("language_name")}
    if kind != "article_questions":
        slots["prompt_type"] = F.col("prompt_type")
    if kind == "article_pair_by_category":
        slots["category"] = F.col("prompt_category")
    return inputs.withColumn("system", templates.render(kind, template, **slots)).withColumn(
        "prompt", templates.render("article_body", template, title=F.col("title"), text=cut)
    )


def revision_requests(pairs: DataFrame, template: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``system``, ``prompt`` and the completion budget ``max_tokens``."""
    count = text.word_count
    return (
        pairs.withColumn("system", templates.render("revise_pair", template, language=F.col("language")))
        .withColumn(
            "prompt",
            templates.render(
                "revise_body", template, inputs=F.col("inputs"), targets=F.col("targets")
            ),
        )
        .withColumn("max_tokens", text.revision_budget(count(F.col("inputs")), count(F.col("targets"))))
    )


def parse_generated(df: DataFrame, reply: str = "generated_prompt_response") -> DataFrame:
    """Add ``prompt``, ``response`` and ``parse_error`` (null when both parts are there)."""
    content = F.col(reply)["content"]
    parsed = df.withColumn("prompt", text.marked_prompt(content)).withColumn(
        "response", text.marked_response(content)
    )
    error = F.when(content.isNull(), fixed.NULL_REPLY_ERROR).when(
        F.col("prompt").isNull() | F.col("response").isNull(), fixed.UNPARSED_REPLY_ERROR
    )
    return parsed.withColumn("parse_error", error)


def score_generated(
    df: DataFrame,
    key: Sequence[str],
    call: Call,
    reply: str = "generated_prompt_response",
    template: Mapping[str, str] | None = None,
    journal: Journal | None = None,
    **options,
) -> DataFrame:
    """Add ``filter_response``: the score call's result, or the parse error.

    Rows that did not parse are never sent. One call per row. With a journal, results are
    stored in it.
    """
    requests = (
        parse_generated(df, reply)
        .withColumn(
            "_system",
            templates.render(
                "score_pair", template, language=F.col("language_name"), prompt_type=F.col("prompt_type")
            ),
        )
        .withColumn(
            "_body",
            templates.render("score_body", template, prompt=F.col("prompt"), response=F.col("response")),
        )
    )

    def guarded(row: Mapping) -> Mapping:
        if row["parse_error"] is not None:
            return {"error": row["parse_error"]}
        return call({**row, "system": row["_system"], "prompt": row["_body"]})

    work = dict(inputs=("_system", "_body", "parse_error"), result="filter_response", carry=df.columns, **options)
    if journal is None:
        return run_calls(requests, key, guarded, **work)
    return run_stored(requests, key, guarded, journal, entry="scores", **work)


def score_fields(content: Column) -> Column:
    """Judge scores as a struct of integers; a trailing comma is forgiven."""
    tidy = F.regexp_replace(content, r",\s*\}", "}")
    return F.from_json(tidy, ", ".join(f"{name} int" for name in fixed.SCORE_FIELDS))


def flatten_results(results: DataFrame, keep: Sequence[str], result: str = "result") -> DataFrame:
    """Successful results as columns ``content`` and ``finish_reason``."""
    return results.where(~failed(result)).select(
        *keep, F.col(result)["content"].alias("content"), F.col(result)["finish_reason"].alias("finish_reason")
    )
