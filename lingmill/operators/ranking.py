"""Agreement and scores from ballots, and the preference pairs made of them.

A row of the judged table holds its few ballots, so ranks, Kendall's W and
Borda counts are computed inside the row: no shuffle, whatever the table's size.
The window forms do the same for ballots that are already one row per item.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import draws, messages
from lingmill.functions.binding import let, with_once
from lingmill.operators import ballots as ballot_ops
from lingmill.session import settle
from lingmill.operators import stats


def _sizes_before(levels: Column, i: Column) -> Column:
    """Number of items on the levels before level ``i`` (from 0)."""
    return F.aggregate(F.slice(levels, 1, i), F.lit(0), lambda n, level: n + F.size(level))


def ballot_size(levels: Column) -> Column:
    return F.size(F.flatten(levels))


def normalized_ranking(levels: Column, models: Column) -> Column:
    """Competition rank (1, 2, 2, 4) per model of ``models``; NaN where unranked.

    A model that a ballot names twice counts where it is named last.
    """
    ranked = F.flatten(
        F.transform(
            levels,
            lambda level, i: F.transform(
                level,
                lambda m: F.struct(
                    m["model"].alias("model"),
                    (_sizes_before(levels, i) + 1).cast("double").alias("rank"),
                ),
            ),
        )
    )
    def rank_of(entries: Column, model: Column) -> Column:
        own = F.filter(entries, lambda e: e["model"] == model)
        return F.get(own, F.size(own) - 1)["rank"]

    return let(
        ranked,
        lambda entries: F.transform(
            models, lambda m: F.coalesce(rank_of(entries, m), F.lit(float("nan")))
        ),
    )


def borda_points(levels: Column) -> Column:
    """``array<struct<model, points>>`` for one ballot.

    n points for first place down to 1 for last, where n is the ballot's own
    size; models on one level share the mean of their places' points. A model
    named twice gets the points of its last place.
    """
    n = ballot_size(levels)
    entries = F.flatten(
        F.transform(
            levels,
            lambda level, i: F.transform(
                level,
                lambda m: F.struct(
                    m["model"].alias("model"),
                    (n - _sizes_before(levels, i) - (F.size(level) - 1) / 2).alias("points"),
                ),
            ),
        )
    )

    def is_last(all_entries: Column, entry: Column, i: Column) -> Column:
        later = F.slice(all_entries, i + 2, n)
        return ~F.exists(later, lambda other: other["model"] == entry["model"])

    return let(entries, lambda every: F.filter(every, lambda e, i: is_last(every, e, i)))


def _w_from(spread: Column, judges: Column, items: Column) -> Column:
    """W from the squared spread of rank sums; undefined for a single item."""
    cubes = items * items * items - items
    return F.when(items > 1, F.lit(12.0) * spread / (judges * judges * cubes)).otherwise(
        F.lit(float("nan"))
    )


def kendall_w(ranks: Column) -> Column:
    """``struct<w, chi_square>`` of ``array<array<double>>``: judges of items.

    No correction for ties; one NaN rank, or a single item, makes the result NaN.
    """
    totals = F.aggregate(
        ranks,
        F.array_repeat(F.lit(0.0), F.size(F.get(ranks, F.lit(0)))),
        lambda sums, one: F.zip_with(sums, one, lambda a, b: a + b),
    )

    def result(total: Column) -> Column:
        n = F.size(total).cast("double")
        k = F.size(ranks).cast("double")
        # Rank sums are whole numbers, so this form of the spread is exact.
        first = F.aggregate(total, F.lit(0.0), lambda s, t: s + t)
        second = F.aggregate(total, F.lit(0.0), lambda s, t: s + t * t)
        w = _w_from(second - first * first / n, k, n)
        return F.struct(w.alias("w"), (k * (n - 1) * w).alias("chi_square"))

    return let(totals, result)


def tally(points: Column) -> Column:
    """Borda points of several ballots summed per model, as a map."""

    def total(flat: Column) -> Column:
        models = F.array_distinct(F.transform(flat, lambda p: p["model"]))
        return F.transform(
            models,
            lambda m: F.struct(
                m.alias("model"),
                F.aggregate(
                    F.filter(flat, lambda p: p["model"] == m),
                    F.lit(0.0),
                    lambda s, p: s + p["points"],
                ).alias("points"),
            ),
        )

    return F.map_from_entries(let(F.flatten(points), total))


def rank_judged(
    df: DataFrame,
    evals: str = "model_evals",
    answers: str = "llm_responses",
    rounds: int = fixed.JUDGE_ROUNDS,
    prefixes: Sequence[int] = (2, 3, 4, 5),
) -> DataFrame:
    """Keep rows with finished answers and exactly ``rounds`` valid ballots; add

    ``rankings`` (``array<struct<ranking, normalized_ranking>>``, one a ballot),
    ``kendall_w``, ``chi_square``, the same for the first 2, 3, … ballots, and
    ``borda_ranking`` (``map<model, points>``). A narrow plan.
    """
    models = messages.model_names(F.col(answers))
    finished = df.where(messages.every_answer_finished(F.col(answers)))
    ballots = F.transform(
        evals, lambda e: ballot_ops.parse_ballot(e["eval_response"], e["model_id_list"])
    )
    parsed = with_once(finished, "_levels", let(ballots, ballot_ops.valid_levels))
    complete = parsed.where(F.size("_levels") == rounds)

    limits = F.array(*[F.lit(k) for k in (rounds, *prefixes)])

    def scores(rankings: Column, ranks: Column) -> Column:
        return F.struct(
            rankings.alias("rankings"),
            F.transform(limits, lambda k: kendall_w(F.slice(ranks, 1, k))).alias("agreement"),
            tally(F.transform("_levels", borda_points)).alias("borda_ranking"),
        )

    rankings = F.transform(
        "_levels",
        lambda levels: F.struct(
            levels.alias("ranking"), normalized_ranking(levels, models).alias("normalized_ranking")
        ),
    )
    scored = with_once(
        complete,
        "_scores",
        let(
            rankings,
            lambda r: let(
                F.transform(r, lambda one: one["normalized_ranking"]), lambda ranks: scores(r, ranks)
            ),
        ),
    )
    columns = [F.col("_scores.rankings").alias("rankings")]
    for i, suffix in enumerate(["", *[str(k) for k in prefixes]]):
        agreement = F.col("_scores.agreement")[i]
        columns.append(agreement["w"].alias(f"kendall_w{suffix}"))
        columns.append(agreement["chi_square"].alias(f"chi_square{suffix}"))
    return scored.select(*df.columns, *columns, F.col("_scores.borda_ranking").alias("borda_ranking"))


# --- the same for long ballots: one row per (key, round, item) ------------------


def competition_rank(df: DataFrame, ballot: Sequence[str], level: str, name: str = "rank") -> DataFrame:
    """Rank with gaps after ties within each ballot."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(*ballot).orderBy(level)))


def fractional_points(
    df: DataFrame, ballot: Sequence[str], level: str, name: str = "points"
) -> DataFrame:
    """Tie-averaged Borda points within each ballot."""
    whole = Window.partitionBy(*ballot)
    rank = F.rank().over(whole.orderBy(level))
    size = F.count(F.lit(1)).over(whole)
    tied = F.count(F.lit(1)).over(Window.partitionBy(*ballot, level))
    return df.withColumn(name, size - (rank - 1) - (tied - 1) / 2)


def first_ballots(df: DataFrame, key: str, round_column: str, limit: int) -> DataFrame:
    """Rows of each key's first ``limit`` ballots among those present."""
    place = F.dense_rank().over(Window.partitionBy(key).orderBy(round_column))
    return df.withColumn("_place", place).where(F.col("_place") <= limit).drop("_place")


def kendall_w_long(df: DataFrame, key: str, round_column: str, item: str, rank: str) -> DataFrame:
    """Kendall's W per key from complete long ballots; NaN ranks give NaN."""
    totals = df.groupBy(key, item).agg(
        F.sum(rank).alias("_t"), F.count(F.lit(1)).alias("_k")
    )
    per_key = totals.groupBy(key).agg(
        F.count(F.lit(1)).cast("double").alias("_n"),
        F.max("_k").cast("double").alias("_k"),
        F.var_pop("_t").alias("_var"),
    )
    n = F.col("_n")
    spread = F.col("_var") * n
    w = _w_from(spread, F.col("_k"), n)
    return per_key.select(
        key, w.alias("kendall_w"), (F.col("_k") * (n - 1) * w).alias("chi_square")
    )


def borda_long(df: DataFrame, key: str, model: str, points: str) -> DataFrame:
    """Borda total per key and model."""
    return df.groupBy(key, model).agg(F.sum(points).alias("borda"))


# --- summaries of ranked rows ---------------------------------------------------


def borda_rows(df: DataFrame, key: str, borda: str = "borda_ranking") -> DataFrame:
    """The Borda map as rows: ``key, model, borda``."""
    return df.select(key, F.explode(borda).alias("model", "borda"))


def with_borda_spread(df: DataFrame, borda: str = "borda_ranking") -> DataFrame:
    """Add ``max_borda``, ``min_borda`` and ``borda_diff``."""
    points = F.map_values(borda)
    return (
        df.withColumn("max_borda", F.array_max(points))
        .withColumn("min_borda", F.array_min(points))
        .withColumn("borda_diff", F.col("max_borda") - F.col("min_borda"))
    )


def mean_borda(long: DataFrame, model: str = "model", borda: str = "borda") -> DataFrame:
    """Mean points per model over the rows that have it, lowest first."""
    return long.groupBy(model).agg(F.avg(borda).alias("mean_borda")).orderBy("mean_borda", model)


def best_and_worst(borda: Column, key: Sequence[Column], seed: int | str = 0) -> Column:
    """``struct<best, worst>``: both ends of one order, ties drawn by key and model."""
    placed = F.transform(
        F.map_entries(borda),
        lambda e: F.struct(
            e["value"].alias("points"),
            draws.order_hash([*key, e["key"]], seed).alias("draw"),
            e["key"].alias("model"),
        ),
    )
    return F.struct(
        F.array_max(placed)["model"].alias("best"), F.array_min(placed)["model"].alias("worst")
    )


def times_ranked(
    df: DataFrame, key: Sequence[str], end: str, borda: str = "borda_ranking", seed: int | str = 0
) -> DataFrame:
    """How often each model came out ``best`` or ``worst``."""
    chosen = best_and_worst(F.col(borda), [F.col(k) for k in key], seed)[end]
    return stats.value_counts(df.select(chosen.alias("model")), "model")


def prefix_agreement(
    df: DataFrame, full: str = "kendall_w5", prefixes: Sequence[str] = ("kendall_w2", "kendall_w3", "kendall_w4")
) -> DataFrame:
    """Correlation of W on the first few ballots with W on all: ``prefix, r``."""
    ready = df.where(~F.isnan(full))
    exploded = ready.select(
        F.col(full).alias("_full"),
        F.explode(
            F.array(*[F.struct(F.lit(p).alias("prefix"), F.col(p).alias("w")) for p in prefixes])
        ).alias("p"),
    )
    return (
        exploded.where(~F.isnan("p.w"))
        .groupBy("p.prefix")
        .agg(F.corr("p.w", "_full").alias("r"))
    )


# --- preference pairs -----------------------------------------------------------


def _pair(df: DataFrame, chosen: Column, rejected: Column, prompt: Column, answers: str) -> DataFrame:
    def turns(model: Column) -> Column:
        return messages.user_assistant_turns(prompt, F.element_at(F.col(answers), model)["content"])

    return (
        df.withColumn("prompt", prompt)
        .withColumn("chosen", turns(chosen))
        .withColumn("rejected", turns(rejected))
    )


def best_worst_pairs(
    df: DataFrame,
    key: Sequence[str],
    conversation: str = "conversation",
    answers: str = "llm_responses",
    borda: str = "borda_ranking",
    seed: int | str = 0,
) -> DataFrame:
    """Add ``prompt``, ``chosen`` and ``rejected`` from the Borda best and worst."""
    ends = best_and_worst(F.col(borda), [F.col(k) for k in key], seed)
    out = _pair(
        df.withColumn("_ends", ends),
        F.col("_ends.best"),
        F.col("_ends.worst"),
        messages.first_message(F.col(conversation)),
        answers,
    )
    return out.drop("_ends")


def fixed_pairs(
    df: DataFrame,
    chosen_model: str,
    rejected_model: str,
    conversation: str = "conversation",
    answers: str = "llm_responses",
) -> DataFrame:
    """Add ``prompt``, ``chosen`` and ``rejected`` from two named models."""
    prompt = messages.first_message(F.col(conversation))
    return _pair(df, F.lit(chosen_model), F.lit(rejected_model), prompt, answers)


def keep_agreed(df: DataFrame, q: float, w: str = "kendall_w") -> DataFrame:
    """Rows whose W is at least the ``q`` quantile of all non-NaN W."""
    # Written first: the cut and its rows would each rank everything.
    return agreed_subsets(settle(df, "agreement"), {"cut": q}, w)["cut"]


def agreed_subsets(
    df: DataFrame, quantiles: Mapping[str, float], w: str = "kendall_w"
) -> dict[str, DataFrame]:
    """For each quantile, the rows whose W reaches it; all cuts come from one pass."""
    cuts = stats.exact_quantiles(df, F.col(w), quantiles).first()
    return {name: df.where(~F.isnan(w) & (F.col(w) >= F.lit(cuts[name]))) for name in quantiles}


def preference_sets(
    df: DataFrame, key: Sequence[str], models: tuple[str, str], seed: int | str = 0
) -> dict[str, DataFrame]:
    """The five pair sets of one ranked table: columns prompt, chosen, rejected.

    ``models`` are the (chosen, rejected) names of the fixed pair. ``df`` is read
    several times: store it first.
    """
    cuts = {"tophalf_borda": 0.5, "top25_borda": 0.75, "top75_borda": 0.25}
    pairs = {
        "full_borda": best_worst_pairs(df, key, seed=seed),
        "full_naive": fixed_pairs(df, *models),
    }
    for name, rows in agreed_subsets(df, cuts).items():
        pairs[name] = best_worst_pairs(rows, key, seed=seed)
    return {name: rows.select("prompt", "chosen", "rejected") for name, rows in pairs.items()}
