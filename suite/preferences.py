"""Ballots, agreement, Borda counts and preference pairs.

Days stand for prompts, event types for models and users modulo five for judges.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lingmill.functions import messages
from lingmill.operators import ballots, inference, ranking, stats
from lingmill.session import settle
from suite import fixtures as fx
from suite.registry import query

B, P = fx.SQL_BALLOTS, fx.SQL_PARTIAL_BALLOTS


def _block(df, *columns):
    return df.select(F.col("conversation_id").alias("block"), *columns)


def _ranked(spark, sf_dir, partial=False):
    return ranking.rank_judged(fx.judged_chats(spark, sf_dir, partial))


@query(f"WITH {B} SELECT block FROM finished")
def finished_answer_sets(spark, sf_dir):
    chats = fx.judged_chats(spark, sf_dir)
    return _block(chats.where(messages.every_answer_finished(F.col("llm_responses"))))


@query(f"""WITH {B} SELECT block FROM answers GROUP BY block
HAVING count(*) FILTER (WHERE finish_reason = 'length') = 0""")
def complete_answer_sets(spark, sf_dir):
    """Answers of unfinished models are nulled; only complete sets stay."""
    chats = fx.judged_chats(spark, sf_dir).withColumn(
        "llm_responses",
        F.transform_values(
            "llm_responses",
            lambda k, v: F.struct(
                F.when(v["finish_reason"] == "stop", v["content"]).alias("content"),
                v["finish_reason"].alias("finish_reason"),
            ),
        ),
    )
    return _block(chats.where(messages.every_answer_present(F.col("llm_responses"))))


@query(f"""WITH {B} SELECT block, count(*) AS n_models, string_agg(model, ',' ORDER BY model) AS names
FROM models GROUP BY block""")
def sorted_model_names(spark, sf_dir):
    names = messages.model_names(F.col("llm_responses"))
    return _block(
        fx.judged_chats(spark, sf_dir),
        F.size(F.map_keys("llm_responses")).cast("long").alias("n_models"),
        F.array_join(names, ",").alias("names"),
    )


@query(f"""WITH {B} SELECT block, round::INT AS round, CASE spoil WHEN 0 THEN 'no_reply' WHEN 1 THEN 'no_marker'
WHEN 2 THEN 'repeated' WHEN 3 THEN 'unknown' ELSE 'ok' END AS status FROM spot""")
def ballot_status(spark, sf_dir):
    chats = ballots.with_ballots(fx.judged_chats(spark, sf_dir, spoiled=True))
    return _block(chats, F.posexplode("ballots").alias("round", "b")).select(
        "block", "round", F.col("b.status").alias("status")
    )


@query(f"WITH {B} SELECT block, round::INT AS round FROM spot WHERE spoil = 3")
def unknown_ballots(spark, sf_dir):
    chats = ballots.with_ballots(fx.judged_chats(spark, sf_dir, spoiled=True))
    return ballots.unknown_ballots(chats, "conversation_id").withColumnRenamed("conversation_id", "block")


@query(f"""WITH {P} SELECT block, round::INT AS round, level::INT AS level, letter, model FROM long
WHERE spoil NOT IN (0, 1, 2, 3)""")
def long_ballots(spark, sf_dir):
    chats = ballots.with_ballots(fx.judged_chats(spark, sf_dir, partial=True, spoiled=True))
    rows = ballots.long_ballots(chats, "conversation_id")
    return rows.withColumnRenamed("conversation_id", "block")


@query(f"""WITH {B}, v AS (SELECT block, count(*) FILTER (WHERE spoil > 3) AS n_valid FROM spot GROUP BY block)
SELECT n_valid, count(*) AS n FROM v GROUP BY n_valid""")
def valid_ballot_counts(spark, sf_dir):
    chats = ballots.with_ballots(fx.judged_chats(spark, sf_dir, spoiled=True))
    valid = F.size(ballots.valid_levels(F.col("ballots"))).cast("long")
    return stats.value_counts(chats.select(valid.alias("n_valid")), "n_valid")


@query(f"""WITH {P} SELECT s.block, s.round::INT AS round, m.model, l.place::DOUBLE AS rank
FROM spot s JOIN judged USING (block) JOIN models m USING (block)
LEFT JOIN long l ON l.block = s.block AND l.judge = s.judge AND l.model = m.model""")
def normalized_rankings(spark, sf_dir):
    """Ranks per judge and model; unranked models (NaN) are shown as null."""
    ranked = _block(_ranked(spark, sf_dir, True), "llm_responses", F.posexplode("rankings").alias("round", "r"))
    pairs = F.arrays_zip(
        messages.model_names(F.col("llm_responses")).alias("model"),
        F.col("r.normalized_ranking").alias("rank"),
    )
    rows = ranked.select("block", "round", F.explode(pairs).alias("p")).select("block", "round", "p.*")
    return rows.withColumn("rank", F.when(~F.isnan("rank"), F.col("rank")))


def _long(spark, sf_dir, partial=False):
    cells = fx.ballot_cells(spark, sf_dir, partial)
    return cells.withColumn("level", -F.col("score"))


@query(f"WITH {P} SELECT block, judge, model, place::INT AS rank FROM long")
def competition_ranks(spark, sf_dir):
    rows = ranking.competition_rank(_long(spark, sf_dir, True), ["block", "judge"], "level")
    return rows.select("block", "judge", "model", "rank")


@query(f"WITH {P} SELECT block, judge, model, (n - (place - 1) - (tied - 1) / 2.0)::DOUBLE AS points FROM long")
def fractional_borda_points(spark, sf_dir):
    rows = ranking.fractional_points(_long(spark, sf_dir, True), ["block", "judge"], "level")
    return rows.select("block", "judge", "model", F.col("points").cast("double").alias("points"))


@query(f"""WITH {B} SELECT block, round(w, 6) AS kendall_w, round(5 * (n - 1) * w, 6) AS chi_square
FROM agreement""")
def kendall_agreement(spark, sf_dir):
    return _block(
        _ranked(spark, sf_dir),
        _defined("kendall_w"),
        _defined("chi_square"),
    )


@query(f"WITH {P} SELECT block, w IS NULL AS undefined, round(w, 6) AS kendall_w FROM agreement")
def kendall_with_partial_ballots(spark, sf_dir):
    """One unranked model makes W NaN, shown as ``undefined`` and null."""
    w = F.col("kendall_w")
    return _block(
        _ranked(spark, sf_dir, True),
        F.isnan(w).alias("undefined"),
        F.when(~F.isnan(w), F.round(w, 6)).alias("kendall_w"),
    )


def _sql_prefix(limit: int) -> str:
    return f"""p{limit} AS (SELECT block, round(CASE WHEN min(k) = {limit} AND count(*) = any_value(m.n) AND count(*) > 1
   THEN 12.0 * (sum(t * t) - sum(t) * sum(t) * 1.0 / count(*))
   / nullif({limit * limit} * (count(*) * count(*) * count(*) - count(*)), 0) END, 6) AS kendall_w{limit} FROM
   (SELECT block, model, sum(place) AS t, count(*) AS k FROM long JOIN judged USING (block) WHERE round < {limit}
    GROUP BY ALL) JOIN (SELECT block, count(*) AS n FROM models GROUP BY block) m USING (block) GROUP BY block)"""


def _defined(column):
    """NaN shown as null."""
    return F.when(~F.isnan(column), F.round(column, 6)).alias(column)


@query(f"""WITH {B}, {', '.join(_sql_prefix(k) for k in (2, 3, 4, 5))}
SELECT block, kendall_w2, kendall_w3, kendall_w4, kendall_w5 FROM p2 JOIN p3 USING (block)
JOIN p4 USING (block) JOIN p5 USING (block)""")
def kendall_prefixes(spark, sf_dir):
    names = [f"kendall_w{k}" for k in (2, 3, 4, 5)]
    return _block(_ranked(spark, sf_dir), *[_defined(n) for n in names])


@query(f"""WITH {B}, f AS (SELECT *, dense_rank() OVER (PARTITION BY block ORDER BY judge) AS p FROM long),
t AS (SELECT block, model, sum(place) AS t, count(*) AS k FROM f WHERE p <= 3 GROUP BY ALL)
SELECT block, CASE WHEN count(*) > 1 THEN round(12.0 * (sum(t * t) - sum(t) * sum(t) * 1.0 / count(*))
  / nullif(max(k) * max(k) * (count(*) * count(*) * count(*) - count(*)), 0), 6) END AS kendall_w FROM t GROUP BY block""")
def kendall_from_long_ballots(spark, sf_dir):
    """The grouped form on the first three judges of every block."""
    ranks = ranking.competition_rank(_long(spark, sf_dir), ["block", "judge"], "level")
    first = ranking.first_ballots(ranks, "block", "judge", 3)
    w = ranking.kendall_w_long(first, "block", "judge", "model", "rank")
    return w.select("block", _defined("kendall_w"))


@query(f"WITH {B} SELECT block, model, borda FROM borda")
def borda_totals(spark, sf_dir):
    rows = ranking.borda_rows(_ranked(spark, sf_dir), "conversation_id")
    return rows.withColumnRenamed("conversation_id", "block")


@query(f"""WITH {P} SELECT block, model, sum(n - (place - 1) - (tied - 1) / 2.0)::DOUBLE AS borda
FROM long GROUP BY ALL""")
def borda_from_long_ballots(spark, sf_dir):
    points = ranking.fractional_points(_long(spark, sf_dir, True), ["block", "judge"], "level")
    return ranking.borda_long(points, "block", "model", "points")


@query(f"""WITH {B} SELECT block, max(borda) AS max_borda, min(borda) AS min_borda,
max(borda) - min(borda) AS borda_diff FROM borda GROUP BY block""")
def borda_spread(spark, sf_dir):
    rows = ranking.with_borda_spread(_ranked(spark, sf_dir))
    return _block(rows, "max_borda", "min_borda", "borda_diff")


@query(f"WITH {B} SELECT model, round(avg(borda), 6) AS mean_borda FROM borda GROUP BY model")
def mean_borda(spark, sf_dir):
    rows = ranking.mean_borda(ranking.borda_rows(_ranked(spark, sf_dir), "conversation_id"))
    return rows.withColumn("mean_borda", F.round("mean_borda", 6))


@query(f"""WITH {B}, e AS (SELECT model, min(borda) AS lo0, max(borda) AS hi0 FROM borda GROUP BY model),
r AS (SELECT model, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
      CASE WHEN lo0 = hi0 THEN 1.0 ELSE hi0 - lo0 END / 10 AS width FROM e),
b AS (SELECT model, {fx.sql_bin('borda', 'lo', 'width', 10)} AS bin, count(*) AS n
      FROM borda JOIN r USING (model) GROUP BY ALL)
SELECT model, bin, round(lo + bin * width, 6) AS bin_start, coalesce(n, 0) AS n
FROM r CROSS JOIN (SELECT unnest(range(10)) AS bin) LEFT JOIN b USING (model, bin)""")
def borda_histograms(spark, sf_dir):
    rows = ranking.borda_rows(_ranked(spark, sf_dir), "conversation_id")
    bins = stats.grouped_histogram(rows, "model", F.col("borda"), 10)
    return bins.withColumn("bin_start", F.round("bin_start", 6))


SQL_ENDS = f"""ends AS (SELECT block, arg_max(model, (borda, h)) AS best, arg_min(model, (borda, h)) AS worst
  FROM (SELECT *, {fx.sql_hash('block, model', '9')} AS h FROM borda) GROUP BY block)"""


@query(f"WITH {B}, {SQL_ENDS} SELECT block, best, worst FROM ends")
def best_and_worst_models(spark, sf_dir):
    ends = ranking.best_and_worst(F.col("borda_ranking"), [F.col("conversation_id")], 9)
    return _block(_ranked(spark, sf_dir), ends.alias("e")).select("block", "e.best", "e.worst")


@query(f"""WITH {B}, {SQL_ENDS} SELECT 'best' AS place, best AS model, count(*) AS n FROM ends GROUP BY best
UNION ALL SELECT 'worst', worst, count(*) FROM ends GROUP BY worst""")
def times_best_or_worst(spark, sf_dir):
    ranked = _ranked(spark, sf_dir)
    sides = [
        ranking.times_ranked(ranked, ["conversation_id"], end, seed=9).withColumn("place", F.lit(end))
        for end in ("best", "worst")
    ]
    return sides[0].unionByName(sides[1])


@query(f"""WITH {P} SELECT round(quantile_cont(w, 0.25), 6) AS q25, round(quantile_cont(w, 0.5), 6) AS q50,
round(quantile_cont(w, 0.75), 6) AS q75 FROM agreement""")
def agreement_quantiles(spark, sf_dir):
    """Median and quartiles of W, NaN skipped."""
    ranked = _ranked(spark, sf_dir, True)
    cuts = stats.exact_quantiles(ranked, F.col("kendall_w"), {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return cuts.select(*[F.round(c, 6).alias(c) for c in cuts.columns])


@query(f"""WITH {P} SELECT block, round(w, 6) AS kendall_w FROM agreement
WHERE w >= (SELECT quantile_cont(w, 0.5) FROM agreement) - 1e-12""")
def most_agreed_half(spark, sf_dir):
    kept = ranking.keep_agreed(_ranked(spark, sf_dir, True), 0.5)
    return _block(kept, F.round("kendall_w", 6).alias("kendall_w"))


@query(f"""WITH {B} SELECT 'language ' || (dayofweek(block::DATE) + 1) AS language, round(avg(w), 6) AS mean,
count(w) AS n FROM agreement GROUP BY 1""")
def agreement_per_language(spark, sf_dir):
    rows = stats.mean_and_size(_ranked(spark, sf_dir), "language", F.col("kendall_w"))
    return rows.withColumn("mean", F.round("mean", 6))


@query(f"""WITH {B}, {', '.join(_sql_prefix(k).replace('round(CASE', '(CASE').replace(' END, 6) AS', ' END) AS')
    for k in (2, 3, 4, 5))},
pairs AS (SELECT 'kendall_w2' AS prefix, kendall_w2 AS w, kendall_w5 AS f FROM p2 JOIN p5 USING (block)
UNION ALL SELECT 'kendall_w3', kendall_w3, kendall_w5 FROM p3 JOIN p5 USING (block)
UNION ALL SELECT 'kendall_w4', kendall_w4, kendall_w5 FROM p4 JOIN p5 USING (block))
SELECT prefix, round(corr(w, f), 6) AS r FROM pairs WHERE w IS NOT NULL AND f IS NOT NULL GROUP BY prefix""")
def prefix_agreement(spark, sf_dir):
    return ranking.prefix_agreement(_ranked(spark, sf_dir)).withColumn("r", F.round("r", 6))


@query(f"""WITH {B} SELECT block, max(borda) - min(borda) AS borda_diff, round(any_value(w), 6) AS kendall_w
FROM borda JOIN agreement USING (block) GROUP BY block""")
def agreement_against_spread(spark, sf_dir):
    rows = ranking.with_borda_spread(_ranked(spark, sf_dir))
    return _block(rows, "borda_diff", _defined("kendall_w"))


def _sql_set(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS pair_set, 'prompt of ' || block AS prompt, 'answer of ' || best || ' on ' || block
 AS chosen, 'answer of ' || worst || ' on ' || block AS rejected FROM {source}"""


@query(f"""WITH {B}, {SQL_ENDS.replace("'9'", "'0'")},
cut AS (SELECT quantile_cont(w, 0.5) - 1e-12 AS half, quantile_cont(w, 0.75) - 1e-12 AS top25,
        quantile_cont(w, 0.25) - 1e-12 AS top75 FROM agreement),
e AS (SELECT * FROM ends JOIN agreement USING (block) CROSS JOIN cut)
{_sql_set('full_borda', 'e')} UNION ALL {_sql_set('tophalf_borda', '(SELECT * FROM e WHERE w >= half)')}
UNION ALL {_sql_set('full_naive', "(SELECT block, 'click' AS best, 'error' AS worst FROM e)")}
UNION ALL {_sql_set('top25_borda', '(SELECT * FROM e WHERE w >= top25)')}
UNION ALL {_sql_set('top75_borda', '(SELECT * FROM e WHERE w >= top75)')}""")
def preference_sets(spark, sf_dir):
    """All five pair sets; the fixed pair is click over error."""
    ranked = settle(
        _ranked(spark, sf_dir).select(
            "conversation_id", "conversation", "llm_responses", "borda_ranking", "kendall_w"
        ),
        "ranked",
    )
    sets = ranking.preference_sets(ranked, ["conversation_id"], ("click", "error"))
    out = None
    for name, rows in sets.items():
        flat = rows.select(
            F.lit(name).alias("pair_set"),
            "prompt",
            F.col("chosen")[1]["content"].alias("chosen"),
            F.col("rejected")[1]["content"].alias("rejected"),
        )
        out = flat if out is None else out.unionByName(flat)
    return out


@query(f"""WITH {B}, r AS (SELECT block, unnest(range(1, 6))::INT AS round FROM
  (SELECT DISTINCT block FROM models)),
l AS (SELECT r.block, r.round, m.model, chr((64 + row_number() OVER (PARTITION BY r.block, r.round
  ORDER BY {fx.sql_hash('r.block, r.round, m.model', '0')}))::INT) AS letter FROM r JOIN models m USING (block))
SELECT block, round, string_agg(letter || ':' || model, ',' ORDER BY letter) AS lettered,
 '<<<PROMPT>>>' || chr(10) || 'prompt of ' || block || string_agg(chr(10) || chr(10) || '<<<RESPONSE ' || letter
   || '>>>' || chr(10) || content, '' ORDER BY letter) AS prompt
FROM l JOIN answers USING (block, model) GROUP BY block, round""")
def judge_requests(spark, sf_dir):
    requests = inference.judge_requests(fx.judged_chats(spark, sf_dir), ["conversation_id"])
    pairs = F.transform("model_id_list", lambda x: F.concat(x["letter"], F.lit(":"), x["model"]))
    return _block(requests, "round", F.array_join(pairs, ",").alias("lettered"), "prompt")


@query(f"""WITH {B}, l AS (SELECT block, chr((64 + unnest(range(1, count(*) + 1)))::INT) AS letter FROM models GROUP BY block)
SELECT block, string_agg(letter, ', ' ORDER BY {fx.sql_hash('block, letter', 'order-0')}, letter) AS letter_order FROM l GROUP BY block""")
def judge_letter_orders(spark, sf_dir):
    """The letters in the order drawn for each block."""
    chats = fx.judged_chats(spark, sf_dir)
    order = ballots.letter_order(F.size("llm_responses"), [F.col("conversation_id")])
    return _block(chats, order.alias("letter_order"))
