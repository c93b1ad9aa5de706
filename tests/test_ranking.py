import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lingmill import schemas
from lingmill.operators import ballots, inference, ranking
from lingmill.plans import preference
from tests.conftest import plan_of

IDS = [("A", "m1"), ("B", "m2"), ("C", "m3")]
BALLOT = "i int, r string, ids array<struct<letter:string,model:string>>"


def parse(spark, reply, ids=IDS):
    df = spark.createDataFrame([(0, reply, ids)], BALLOT)
    got = df.select(ballots.parse_ballot(F.col("r"), F.col("ids")).alias("b")).first().b
    return got.status, None if got.levels is None else [[m.model for m in level] for level in got.levels]


@pytest.mark.parametrize(
    "reply, want",
    [
        ("x<<<RANKING>>>\nB>A=C\n", ("ok", [["m2"], ["m1", "m3"]])),
        ("<<<RANKING>>>Z<<<RANKING>>> B > A = C ", ("ok", [["m2"], ["m1", "m3"]])),
        ("<<<RANKING>>>C", ("ok", [["m3"]])),
        ("B>A", ("no_marker", None)),
        (None, ("no_reply", None)),
        ("<<<RANKING>>>A>B>A", ("repeated", None)),
        ("<<<RANKING>>>A>Q", ("unknown", None)),
        ("<<<RANKING>>>", ("unknown", None)),
        ("<<<RANKING>>>A>", ("unknown", None)),
        ("<<<RANKING>>>A>A>Q", ("repeated", None)),
        ("<<<RANKING>>>A>Q>A", ("unknown", None)),
        # Compared before stripping, so these two are different ids for one model.
        ("<<<RANKING>>>A>B> A", ("ok", [["m1"], ["m2"], ["m1"]])),
    ],
)
def test_ballot_parsing(spark, reply, want):
    assert parse(spark, reply) == want


def test_ambiguous_letters_are_unknown(spark):
    assert parse(spark, "<<<RANKING>>>A", [("A", "m1"), ("A", "m2")])[0] == "unknown"


def random_ballot(rng, models, partial=False):
    order = models[:]
    rng.shuffle(order)
    if partial:
        order = order[:-1]
    levels = [[order[0]]]
    for m in order[1:]:
        if rng.random() < 0.3:
            levels[-1].append(m)
        else:
            levels.append([m])
    return levels


def ranks_of(levels, models):
    out, place = {}, 1
    for level in levels:
        for m in level:
            out[m] = float(place)
        place += len(level)
    return [out.get(m, math.nan) for m in models]


def points_of(levels):
    n = sum(len(level) for level in levels)
    out, top = {}, n
    for level in levels:
        share = sum(top - i for i in range(len(level))) / len(level)
        top -= len(level)
        out.update({m: share for m in level})
    return out


def w_of(ranks):
    r = np.array(ranks).T
    n, k = r.shape
    t = r.sum(axis=1)
    w = 12 * ((t - t.mean()) ** 2).sum() / (k**2 * (n**3 - n))
    return w, k * (n - 1) * w


def judged(spark, cases):
    """cases: key -> list of five level lists, or of reply strings."""
    rows = []
    for key, rounds in cases.items():
        models = sorted({m for levels in rounds for level in levels for m in level})
        letters = {m: chr(65 + i) for i, m in enumerate(models)}
        evals = []
        for levels in rounds:
            reply = "<<<RANKING>>>" + ">".join("=".join(letters[m] for m in level) for level in levels)
            evals.append(([(letters[m], m) for m in models], reply, "stop", "judge"))
        answers = {m: (f"{key} by {m}", "stop") for m in models}
        rows.append((key, [(f"prompt {key}", "user")], "en", None, answers, evals))
    return spark.createDataFrame(rows, schemas.JUDGED_CHATS)


def test_scores_equal_plain_python(spark):
    rng = random.Random(5)
    models = [f"m{i}" for i in range(7)]
    cases = {f"k{i}": [random_ballot(rng, models) for _ in range(5)] for i in range(12)}
    cases["partial"] = [random_ballot(rng, models) for _ in range(4)] + [random_ballot(rng, models, True)]
    got = {r.conversation_id: r for r in ranking.rank_judged(judged(spark, cases)).collect()}
    assert got.keys() == cases.keys()
    for key, rounds in cases.items():
        row = got[key]
        ranks = [ranks_of(levels, models) for levels in rounds]
        for mine, want in zip(row.rankings, ranks):
            assert np.array_equal(mine.normalized_ranking, want, equal_nan=True)
        for suffix, limit in (("", 5), ("2", 2), ("3", 3), ("4", 4), ("5", 5)):
            w, chi = w_of(ranks[:limit])
            assert row[f"kendall_w{suffix}"] == pytest.approx(w, nan_ok=True, abs=1e-12)
            assert row[f"chi_square{suffix}"] == pytest.approx(chi, nan_ok=True, abs=1e-9)
        want = {}
        for levels in rounds:
            for m, p in points_of(levels).items():
                want[m] = want.get(m, 0) + p
        assert row.borda_ranking == pytest.approx(want)
    assert math.isnan(got["partial"].kendall_w)


def test_untied_complete_ballots_have_w_between_0_and_1_and_full_points(spark):
    models = ["a", "b", "c", "d"]
    rng = random.Random(1)
    cases = {}
    for i in range(20):
        cases[f"k{i}"] = [[[m] for m in rng.sample(models, 4)] for _ in range(5)]
    cases["agree"] = [[[m] for m in models]] * 5
    rows = ranking.rank_judged(judged(spark, cases)).collect()
    for r in rows:
        assert -1e-12 <= r.kendall_w <= 1 + 1e-12
        assert sum(r.borda_ranking.values()) == 5 * 4 * 5 / 2
    assert [r.kendall_w for r in rows if r.conversation_id == "agree"] == [pytest.approx(1)]


def test_rows_need_five_valid_ballots_and_finished_answers(spark):
    base = [[["a"], ["b"]]] * 5
    df = judged(spark, {"good": base, "four": base[:4], "six": base + base[:1]})
    cut = F.transform_values(
        "llm_responses", lambda k, v: F.struct(v["content"].alias("content"), F.lit("length").alias("finish_reason"))
    )
    both = df.unionByName(
        df.where("conversation_id = 'good'").withColumn("conversation_id", F.lit("cut")).withColumn("llm_responses", cut)
    )
    assert [r.conversation_id for r in ranking.rank_judged(both).collect()] == ["good"]


def test_ranking_is_narrow_and_parses_once(spark, tmp_path):
    path = str(tmp_path / "judged")
    judged(spark, {"k": [[["a"], ["b"]]] * 5}).write.parquet(path)
    ranked = ranking.rank_judged(spark.read.parquet(path))
    plan = plan_of(ranked.where(~F.isnan("kendall_w")).where("kendall_w > 0.1"))
    assert "Exchange" not in plan
    lines = [line for line in plan.splitlines() if "<<<RANKING>>>" in line]
    assert len(lines) == 1


def test_a_single_model_has_no_agreement(spark):
    row = ranking.rank_judged(judged(spark, {"k": [[["only"]]] * 5})).first()
    assert math.isnan(row.kendall_w) and math.isnan(row.chi_square2)
    assert row.borda_ranking == {"only": 5.0}


def test_a_model_named_twice_counts_last(spark):
    ids = [("A", "a"), ("B", "b"), ("C", "c")]
    evals = [(ids, "<<<RANKING>>>A>B> A=C", "stop", "judge")] * 5
    answers = {m: ("x", "stop") for m in "abc"}
    df = spark.createDataFrame([("k", [("p", "user")], "en", None, answers, evals)], schemas.JUDGED_CHATS)
    row = ranking.rank_judged(df).first()
    assert row.rankings[0].normalized_ranking == [3.0, 2.0, 3.0]
    assert row.borda_ranking == {"b": 15.0, "a": 7.5, "c": 7.5}


def test_best_and_worst_come_from_one_order(spark):
    rows = [(i, {"a": 5.0, "b": 5.0, "c": 5.0}) for i in range(60)] + [(99, {"a": 1.0, "b": 7.0, "c": 7.0})]
    df = spark.createDataFrame(rows, "k int, borda map<string,double>")
    ends = df.select("k", ranking.best_and_worst(F.col("borda"), [F.col("k")]).alias("e")).collect()
    tied = [(r.e.best, r.e.worst) for r in ends if r.k != 99]
    assert all(b != w for b, w in tied)
    assert {b for b, _ in tied} == {w for _, w in tied} == {"a", "b", "c"}
    last = [r.e for r in ends if r.k == 99][0]
    assert last.worst == "a" and last.best in "bc"


def test_prefixes_count_valid_ballots(spark):
    rows = [("k", r, m, float(x)) for r, ranks in {1: "12", 4: "21", 7: "12"}.items() for m, x in zip("ab", ranks)]
    df = spark.createDataFrame(rows, "key string, round int, model string, rank double")
    first = ranking.first_ballots(df, "key", "round", 2)
    assert {r["round"] for r in first.collect()} == {1, 4}
    assert ranking.kendall_w_long(first, "key", "round", "model", "rank").first().kendall_w == 0


def test_long_windows(spark):
    rows = [("k", 1, m, lv) for m, lv in zip("abcde", [0, 1, 1, 2, 3])]
    df = spark.createDataFrame(rows, "key string, round int, model string, level int")
    ranked = ranking.competition_rank(df, ["key", "round"], "level")
    assert [r["rank"] for r in ranked.orderBy("model").collect()] == [1, 2, 2, 4, 5]
    points = ranking.fractional_points(df, ["key", "round"], "level")
    assert [r.points for r in points.orderBy("model").collect()] == [5.0, 3.5, 3.5, 2.0, 1.0]


def test_preference_sets_and_nan(spark):
    rng = random.Random(8)
    models = ["gpt-4", "gpt-35", "other"]
    cases = {f"k{i}": [random_ballot(rng, models) for _ in range(5)] for i in range(9)}
    cases["nan"] = [random_ballot(rng, models)] * 4 + [random_ballot(rng, models, True)]
    sets = preference.preference_pairs(judged(spark, cases), ("gpt-4", "gpt-35"))
    sizes = {name: df.count() for name, df in sets.items()}
    assert sizes["full_borda"] == sizes["full_naive"] == 10
    w = [w_of([ranks_of(b, sorted(models)) for b in cases[f"k{i}"]])[0] for i in range(9)]
    for name, q in (("tophalf_borda", 0.5), ("top25_borda", 0.75), ("top75_borda", 0.25)):
        assert sizes[name] == sum(x >= np.quantile(w, q) - 1e-12 for x in w)
    row = sets["full_naive"].orderBy("prompt").first()
    assert [m.role for m in row.chosen] == ["user", "assistant"]
    assert row.chosen[1].content.endswith(models[0]) and row.rejected[1].content.endswith(models[1])


def test_render_then_parse_round_trip(spark):
    models = {m: (f"text {m}", "stop") for m in ("a", "b", "c", "d")}
    df = spark.createDataFrame([("k", [("hello", "user")], models)], "conversation_id string, conversation array<struct<content:string,role:string>>, llm_responses map<string,struct<content:string,finish_reason:string>>")
    requests = inference.judge_requests(df, ["conversation_id"]).collect()
    assert [r["round"] for r in requests] == [1, 2, 3, 4, 5]
    assert len({tuple(x.model for x in r.model_id_list) for r in requests}) > 1
    for r in requests:
        assert [x.letter for x in r.model_id_list] == list("ABCD")
        blocks = r.prompt.split("\n\n")
        assert blocks[0] == "<<<PROMPT>>>\nhello"
        assert blocks[1:] == [f"<<<RESPONSE {x.letter}>>>\ntext {x.model}" for x in r.model_id_list]
        reply = "<<<EXPLANATION>>>\n..\n\n<<<RANKING>>>\nD>A=B>C"
        by = {x.letter: x.model for x in r.model_id_list}
        status, levels = parse(spark, reply, [(x.letter, x.model) for x in r.model_id_list])
        assert status == "ok" and levels == [[by["D"]], [by["A"], by["B"]], [by["C"]]]


def test_whole_judging_job(spark):
    prompts = spark.createDataFrame([(f"c{i}", [(f"q{i}", "user")], "en") for i in range(6)], "conversation_id string, conversation array<struct<content:string,role:string>>, language string")

    def answer(row):
        return {"content": f"{row['prompt']}?", "finish_reason": "stop"}

    def judge(row):
        order = sorted(row["model_id_list"], key=lambda x: x["model"])
        return {"content": "<<<RANKING>>>" + ">".join(x["letter"] for x in order), "finish_reason": "stop"}

    answered = preference.collect_answers(prompts, ["gpt-x", "a", "b"], answer, answer)
    ranked = ranking.rank_judged(preference.judge_answers(answered, judge, "j"))
    rows = ranked.collect()
    assert len(rows) == 6 and all(r.kendall_w == pytest.approx(1) for r in rows)
    assert all(r.borda_ranking == {"a": 15.0, "b": 10.0, "gpt-x": 5.0} for r in rows)
    assert all(e.eval_model_name == "j" for r in rows for e in r.model_evals)
