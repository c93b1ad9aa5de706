import hashlib
import sys
import threading
import time
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lingmill.operators import detect, filters, inference, tokens
from lingmill.plans import generated, grounded, preference
from lingmill.sources import writers
from lingmill.sources.journal import Journal
from tests.conftest import plan_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def prompts(spark, n=200, parts=5):
    return spark.range(n).select("id", F.concat(F.lit("p"), "id").alias("prompt")).repartition(parts)


def test_failures_are_values(spark):
    def call(row):
        if row["id"] % 3 == 0:
            raise ValueError("boom")
        if row["id"] % 3 == 1:
            raise inference.RejectedRequest("inner")
        return {"content": row["prompt"] + row["key"], "finish_reason": "stop"}

    rows = inference.run_calls(prompts(spark, 30), ["id"], call).collect()
    assert len(rows) == 30
    for r in rows:
        want = [(None, None, "boom"), (None, "inner", None), (f"p{r.id}{r.id}", None, None)][r.id % 3]
        assert (r.result.content, r.result.bad_request, r.result.error) == want


def test_carried_columns_are_untouched(spark):
    big = 2**60 + 1
    df = spark.createDataFrame([(big, "a", None, [1, None]), (2, "b", big, None)], "id long, prompt string, n long, xs array<int>")
    rows = inference.run_calls(df, ["id"], inference.echo, carry=df.columns, partitions=3).orderBy("id").collect()
    assert [(r.id, r.prompt, r.n, r.xs, r.result.content) for r in rows] == [(2, "b", big, None, "b"), (big, "a", None, [1, None], "a")]


def test_retry_sees_only_failed_rows(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()

    def first(row):
        if row["id"] % 4 == 0:
            raise RuntimeError("busy")
        return {"content": "first", "finish_reason": "stop"}

    def second(row):
        (log / str(row["id"])).touch()
        if row["id"] % 8 == 0:
            raise RuntimeError("still busy")
        return {"content": "second", "finish_reason": "stop"}

    rows = inference.run_with_retry(prompts(spark, 40), ["id"], [first, second]).collect()
    assert {r.id: r.result.content for r in rows} == {
        i: None if i % 8 == 0 else "second" if i % 4 == 0 else "first" for i in range(40)
    }
    assert {r.result.error for r in rows if r.id % 8 == 0} == {"still busy"}
    assert {int(p.name) for p in log.iterdir()} == set(range(0, 40, 4))


def test_resume_calls_each_row_once(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()

    def call(row):
        path = log / str(row["id"])
        assert not path.exists()
        path.touch()
        return inference.echo(row)

    def work(rows):
        return inference.run_calls(rows, ["id"], call)

    out = str(tmp_path / "out")
    writers.resume_into(prompts(spark, 50).where("id < 20"), out, ["id"], work)
    stored = writers.resume_into(prompts(spark, 50), out, ["id"], work)
    rows = stored.collect()
    assert sorted(r.id for r in rows) == list(range(50))
    assert all(r.result.content == f"p{r.id}" for r in rows)


def test_routing_and_answer_map(spark):
    def named(name):
        return lambda row: {"content": name, "finish_reason": "stop"}

    asked = spark.createDataFrame([(1, "p", "gpt-4"), (1, "p", "qwen"), (2, "p", "qwen")], "id int, prompt string, model string")
    results = inference.run_routed(asked, ["id", "model"], "model", named("hosted"), named("local"))
    maps = {r.id: {k: v.content for k, v in r.llm_responses.items()} for r in inference.answer_map(results, ["id"], "model").collect()}
    assert maps == {1: {"gpt-4": "hosted", "qwen": "local"}, 2: {"qwen": "local"}}


def test_scores_are_read_despite_a_trailing_comma(spark):
    texts = ['{"fluency": 3,\n}', '{"fluency": 4}', "no json", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.f for r in df.select("i", inference.score_fields(F.col("t"))["fluency"].alias("f")).orderBy("i").collect()]
    assert got == [3, 4, None, None]


def test_unparsed_replies_are_never_sent(spark):
    def call(row):
        assert "<<RESPONSE>>" in row["prompt"] and "French" in row["system"]
        return {"content": "{}", "finish_reason": "stop"}

    rows = [
        (1, ("<<PROMPT>>p<<RESPONSE>>r", "stop"), "French", "question"),
        (2, ("nothing", "stop"), "French", "question"),
        (3, (None, None), "French", "command"),
        (4, None, "French", "command"),
    ]
    df = spark.createDataFrame(rows, "id int, generated_prompt_response struct<content:string,finish_reason:string>, language_name string, prompt_type string")
    got = {r.id: (r.filter_response.content, r.filter_response.error) for r in inference.score_generated(df, ["id"], call).collect()}
    assert got == {
        1: ("{}", None), 2: (None, "Failed prompt/response parse"),
        3: (None, "Null prompt response"), 4: (None, "Null prompt response"),
    }


def by_first_letter():
    codes = {"e": "en", "f": "fr", "j": "ja"}

    def run(texts):
        for t in texts:
            if t.startswith("!"):
                raise ValueError(t)
        return [(codes[t[0]], 0.9) if t and t[0] in codes else None for t in texts]

    return run


def test_detection_nulls_and_errors(spark):
    texts = ["english", "!bad", "", None, "f\nr", "zzz"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    found = detect.with_detection(df, F.col("t"), by_first_letter)
    got = {r.i: r.lang_detect_result and r.lang_detect_result.lang for r in found.collect()}
    assert got == {0: "en", 1: None, 2: None, 3: None, 4: "fr", 5: None}
    with pytest.raises(Exception, match="!bad"):
        detect.with_detection(df, F.col("t"), by_first_letter, errors_as_null=False).collect()


def test_detector_and_tokenizer_run_once_under_filters(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("English", "e")], "language string, t string").write.parquet(path)
    df = detect.with_detection(spark.read.parquet(path), F.col("t"), by_first_letter)
    df = filters.keep_agreeing(filters.drop_undetected(df, "lang_detect_result"), filters.language_names(spark))
    df = df.withColumn("n", tokens.token_count(F.col("t"), lambda: lambda s: s.split())).where("n < 9").where("n > 0")
    plan = plan_of(df)
    assert plan.count("ArrowEvalPython") == 2
    assert [r.n for r in df.collect()] == [1]


def test_learned_detector_beats_a_floor(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    loader = detect.profile_detector(detect.learn_profiles(docs, "text", "lang"))
    found = detect.with_detection(docs, F.col("text"), loader)
    rate = found.agg(F.avg((F.col("lang_detect_result.lang") == F.col("lang")).cast("double")).alias("r")).first().r
    assert rate > 0.95


def test_plugged_tokenizer_truncates(spark):
    def codec():
        return lambda s: list(s), lambda ids: "".join(ids)

    df = spark.createDataFrame([("abcdef",), (None,)], "t string")
    got = [r.c for r in df.select(tokens.truncate(F.col("t"), 3, codec).alias("c")).collect()]
    assert got == ["abc", None]
    vectors = df.select(tokens.embed(F.col("t"), lambda: lambda items: [[float(len(t))] for t in items]).alias("v"))
    assert [r.v for r in vectors.collect()] == [[6.0], [3.0]]


def test_prompt_lists_to_training_rows(spark):
    def lists(row):
        if row["language"] == "Thai":
            raise RuntimeError("never works")
        head = row["language"][0].lower()
        return {"content": f"1. {head} one\n2. English two\n3. jjj", "finish_reason": "stop"}

    names = spark.createDataFrame([("French",), ("English",), ("Thai",)], "language string")
    seeds = [f"s{i}" for i in range(60)]
    got = generated.request_prompt_lists(names, [lists, lists], seeds, seeds, times=2)
    assert sorted(r.language for r in got.collect()) == ["English", "English", "French", "French"]
    parsed = generated.parse_prompts(got, ["language", "repeat_id"], by_first_letter)
    kept = {(r.language, r.prompt_list) for r in parsed.collect()}
    assert ("French", "f one") in kept and ("English", "English two") in kept
    assert not any(p == "jjj" for _, p in kept)
    embedded = generated.parse_prompts(
        got, ["language", "repeat_id"], by_first_letter,
        embed=lambda c: tokens.embed(c, lambda: lambda items: [[1.0, 0.0] if "one" in t else [0.0, 1.0] for t in items]),
    )
    assert sorted((r.language, r.prompt_list) for r in embedded.collect()) == [("English", "English two"), ("English", "e one"), ("French", "f one")]
    answered = embedded.withColumn("responses", F.struct(F.lit("fine").alias("content"), F.lit("stop").alias("finish_reason")))
    assert generated.training_rows(answered, by_first_letter).count() == 3


def test_generation_and_revision_keep_their_inputs(spark):
    articles = spark.createDataFrame([("T", "word " * 5000, "fr"), ("U", "x", "be-x-old"), ("V", "x", "zz")], "title string, text string, language_code string")
    names = spark.createDataFrame([("fr", "French")], "language_code string, language_name string")

    def call(row):
        assert row["prompt"].startswith("T\n\nword") and len(row["prompt"].split()) == 4097
        return {"content": row["system"], "finish_reason": "stop"}

    for kind in ("article_pair", "article_pair_by_category", "article_questions"):
        rows = grounded.generate_pairs(articles, names, call, kind).collect()
        assert [r.title for r in rows] == ["T"]
        assert "French" in rows[0].generated_prompt_response.content
        assert rows[0].text == "word " * 5000
    pairs = spark.createDataFrame([(1, "in", "out", "Thai")], "id int, inputs string, targets string, language string")
    got = grounded.revise_pairs(pairs, ["id"], inference.echo).first()
    assert got.gen_input_outputs == "<INPUT>\nin\n\n<OUTPUT>\nout" and got.finish_reason == "stop"


def test_a_failed_run_repeats_at_most_one_part(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    out = str(tmp_path / "out")
    parts = []

    def work(rows):
        def call(row):
            (log / f"{row['id']}-{len(parts)}").touch()
            return inference.echo(row)

        if rows.schema and rows.count():
            parts.append(1)
            if len(parts) == 3:
                raise RuntimeError("lost")
        return inference.run_calls(rows, ["id"], call)

    with pytest.raises(RuntimeError, match="lost"):
        writers.resume_into(prompts(spark, 80), out, ["id"], work, commits=4)
    before = {int(p.name.split("-")[0]) for p in log.iterdir()}
    assert 0 < len(before) < 80
    stored = writers.resume_into(prompts(spark, 80), out, ["id"], work, commits=4).collect()
    assert sorted(r.id for r in stored) == list(range(80))
    assert len(list(log.iterdir())) == 80


def test_models_with_an_answer_are_not_asked_again(spark):
    answer = "struct<content:string,finish_reason:string>"
    rows = [
        (1, [("hello", "user")], {"gpt-4": ("kept", "stop"), "qwen": (None, None)}),
        (2, [("bye", "user")], None),
        (3, [("done", "user")], {"gpt-4": ("x", "stop"), "qwen": ("y", "stop"), "old": ("z", "stop")}),
    ]
    df = spark.createDataFrame(
        rows, f"conversation_id int, conversation array<struct<content:string,role:string>>, llm_responses map<string,{answer}>"
    )

    def named(name):
        return lambda row: {"content": f"{name} {row['prompt']}", "finish_reason": "stop"}

    got = preference.collect_answers(df, ["gpt-4", "qwen"], named("hosted"), named("local")).collect()
    assert {r.conversation_id: {k: v.content for k, v in r.llm_responses.items()} for r in got} == {
        1: {"gpt-4": "kept", "qwen": "local hello"},
        2: {"gpt-4": "hosted bye", "qwen": "local bye"},
        3: {"gpt-4": "x", "qwen": "y", "old": "z"},
    }


def test_stored_judge_rounds_are_not_judged_again(spark, tmp_path):
    path = str(tmp_path / "rounds")
    answer = "struct<content:string,finish_reason:string>"
    df = spark.createDataFrame(
        [(i, [("q", "user")], {"a": ("x", "stop"), "b": ("y", "stop")}) for i in range(6)],
        f"conversation_id int, conversation array<struct<content:string,role:string>>, llm_responses map<string,{answer}>",
    )

    def first(row):
        return {"content": "first", "finish_reason": "stop"}

    def second(row):
        return {"content": "second", "finish_reason": "stop"}

    preference.judge_answers(df, first, "judge", rounds=2, path=path).collect()
    got = preference.judge_answers(df, second, "judge", rounds=3, path=path).collect()
    assert len(got) == 6
    assert all([e.eval_response for e in r.model_evals] == ["first", "first", "second"] for r in got)


def logged(log, stop, name):
    """A model that notes what it is asked, and takes its whole process down where told to."""
    def call(row):
        if row["key"] in stop:
            raise SystemExit("lost")
        (log / f"{name}-{hashlib.md5(row['key'].encode()).hexdigest()}-{uuid.uuid4().hex}").touch()
        return {"content": "1. x" if name == "lists" else "<<PROMPT>> a <<RESPONSE>> b", "finish_reason": "stop"}

    return call


def answered_plan(spark):
    df = spark.createDataFrame([(i, [(f"q{i}", "user")]) for i in range(30)], "conversation_id int, conversation array<struct<content:string,role:string>>")
    asked = df.select("conversation_id", F.explode(F.array(F.lit("gpt"), F.lit("b"))).alias("model"))
    return asked, ["conversation_id", "model"], lambda call, journal: preference.collect_answers(df, ["gpt", "b"], call, call, journal=journal)


def lists_plan(spark):
    names = spark.createDataFrame([(n,) for n in ("French", "Thai", "Greek")], "language string")
    seeds = [f"s{i}" for i in range(60)]
    asked = names.withColumn("repeat_id", F.explode(F.sequence(F.lit(1), F.lit(20))))
    return asked, ["language", "repeat_id"], lambda call, journal: generated.request_prompt_lists(names, [call], seeds, seeds, times=20, journal=journal)


def pairs_plan(spark):
    rows = spark.createDataFrame([(f"T{i}", "text", "fr") for i in range(60)], "title string, text string, language_code string")
    names = spark.createDataFrame([("fr", "French")], "language_code string, language_name string")
    return rows, ["language_code", "title"], lambda call, journal: grounded.generate_pairs(rows, names, call, journal=journal)


def revisions_plan(spark):
    rows = spark.createDataFrame([(i, "in", "out", "Thai") for i in range(60)], "id int, inputs string, targets string, language string")
    return rows, ["id"], lambda call, journal: grounded.revise_pairs(rows, ["id"], call, journal=journal)


def scores_plan(spark):
    reply = F.struct(F.lit("<<PROMPT>> a <<RESPONSE>> b").alias("content"), F.lit("stop").alias("finish_reason"))
    rows = spark.range(60).select("id", F.lit("Thai").alias("language_name"), F.lit("question").alias("prompt_type"), reply.alias("generated_prompt_response"))
    return rows, ["id"], lambda call, journal: inference.score_generated(rows, ["id"], call, journal=journal)


def judge_plan(spark):
    answer = "struct<content:string,finish_reason:string>"
    df = spark.createDataFrame(
        [(i, [("q", "user")], {"a": ("x", "stop"), "b": ("y", "stop")}) for i in range(60)],
        f"conversation_id int, conversation array<struct<content:string,role:string>>, llm_responses map<string,{answer}>",
    )
    return df.withColumn("round", F.lit(1)), ["conversation_id"], lambda call, journal: preference.judge_answers(
        df, call, "judge", rounds=1, path=journal.path, commits=journal.commits
    )


@pytest.mark.parametrize("plan", [answered_plan, lists_plan, pairs_plan, revisions_plan, scores_plan, judge_plan])
def test_a_lost_third_part_leaves_the_first_two(spark, tmp_path, plan):
    log = tmp_path / "log"
    log.mkdir()
    asked, key, run = plan(spark)
    journal = Journal(str(tmp_path / "journal"), 4)
    named = [F.concat_ws("|", *key, *(["round"] if plan is judge_plan else [])).alias("name"), F.pmod(F.xxhash64(*key), F.lit(4)).alias("part")]
    part_of = {r.name: r.part for r in asked.select(*named).collect()}
    assert set(part_of.values()) == {0, 1, 2, 3} and len(part_of) == 60
    kind = plan.__name__.split("_")[0]
    stop = {name for name, part in part_of.items() if part == 2}
    with pytest.raises(Exception, match="SystemExit|exited|Job aborted|Python worker"):
        run(logged(log, stop, kind), journal).collect()
    seen = Counter(p.name.split("-")[1] for p in log.iterdir())
    early = {hashlib.md5(n.encode()).hexdigest() for n, part in part_of.items() if part < 2}
    assert early <= set(seen) and not {hashlib.md5(n.encode()).hexdigest() for n, part in part_of.items() if part == 3} & set(seen)
    rows = run(logged(log, set(), kind), journal).collect()
    assert len(rows) == (30 if plan is answered_plan else 60)
    after = Counter(p.name.split("-")[1] for p in log.iterdir())
    assert set(after) == {hashlib.md5(n.encode()).hexdigest() for n in part_of}
    assert all(after[name] == seen[name] for name in early)


def test_the_rate_is_that_of_the_whole_job(spark, tmp_path):
    def call(row):
        (tmp_path / f"{time.time():.6f}-{row['id']}").touch()
        return inference.echo(row)

    assert len(inference.run_calls(prompts(spark, 60), ["id"], call, per_second=20, partitions=4).collect()) == 60
    times = sorted(float(p.name.split("-")[0]) for p in tmp_path.iterdir())
    assert len(times) == 60 and times[-1] - times[0] > 60 / 20 * 0.7
    # In any second at most the limit, but for the calls that tasks begin together.
    assert max(sum(t <= u < t + 1 for u in times) for t in times) <= 20 + 4
    alone = inference.run_calls(prompts(spark, 8), ["id"], inference.echo, per_second=1000)
    assert alone.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_failed_calls_back_off_and_try_again():
    seen = []

    def call(row):
        seen.append(time.monotonic())
        if len(seen) < 4:
            raise RuntimeError("busy")
        return {"content": "there"}

    assert inference.attempt(call, {}, retries=3, backoff=0.02)["content"] == "there"
    gaps = np.diff(seen)
    assert all(0.01 * 2**n <= g for n, g in enumerate(gaps)) and len(gaps) == 3
    assert inference.attempt(lambda row: 1 / 0, {}, retries=1, backoff=0.001)["error"] == "division by zero"
    seen.clear()

    def refused(row):
        seen.append(0)
        raise inference.RejectedRequest("no")

    assert inference.attempt(refused, {}, retries=5)["bad_request"] == "no" and len(seen) == 1


def in_one_task(spark, monkeypatch, batch, **options):
    """What a task of ``run_calls`` hands on for one Arrow batch, part by part."""
    tasks = []
    df = spark.createDataFrame([], "id long, prompt string")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: tasks.append(run) or self)
    inference.run_calls(df, ["id"], **options)
    return tasks[0](iter([batch]))


@pytest.mark.parametrize("size", [0, 3000])
def test_answers_leave_a_task_part_by_part(spark, monkeypatch, size):
    asked = []

    def call(row):
        asked.append(row["id"])
        return inference.echo(row)

    batch = pa.RecordBatch.from_pydict({"id": list(range(5000)), "prompt": [f"{i:{size}}" for i in range(5000)]})
    parts = in_one_task(spark, monkeypatch, batch, call=call)
    first = next(parts)
    assert len(asked) < 2500
    parts = [first, *parts]
    assert all(p.num_rows <= inference.PART_ROWS and p.nbytes <= 2 * inference.PART_BYTES for p in parts)
    rows = [row for p in parts for row in p.to_pylist()]
    assert [(r["id"], r["result"]["content"]) for r in rows] == list(zip(*batch.to_pydict().values()))
    assert sorted(asked) == list(range(5000))


def test_parts_of_one_row_keep_all_workers_busy(spark, monkeypatch):
    together = threading.Barrier(4)

    def call(row):
        together.wait(20)
        return {"content": str(len(row["prompt"]))}

    batch = pa.RecordBatch.from_pydict({"id": list(range(8)), "prompt": ["x" * (2 * inference.PART_BYTES)] * 8})
    parts = list(in_one_task(spark, monkeypatch, batch, call=call, workers=4))
    assert [p.num_rows for p in parts] == [1] * 8
    assert all(p.column("result")[0]["content"].as_py() == str(2 * inference.PART_BYTES) for p in parts)
