"""Counts, shares, histograms and quantiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lingmill.operators import stats
from suite import fixtures as fx
from suite.registry import query, table


@query("SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def language_counts(spark, sf_dir):
    return stats.value_counts(table(spark, sf_dir, "documents"), "lang")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 40")
def top_values(spark, sf_dir):
    return stats.top_values(table(spark, sf_dir, "events"), "user_id", 40)


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 40 OFFSET 20")
def value_counts_slice(spark, sf_dir):
    return stats.value_counts_slice(table(spark, sf_dir, "events"), "user_id", 20, 60)


@query(f"""WITH {fx.SQL_DETECTED} SELECT lang, count(*) FILTER (WHERE score > 0.8) AS n_above,
count(*) FILTER (WHERE score < 0.8) AS n_below FROM detected GROUP BY lang""")
def confidence_counts(spark, sf_dir):
    docs = fx.with_stub_detection(table(spark, sf_dir, "documents"))
    return stats.confidence_counts(docs, "lang", F.col("lang_detect_result.score"))


@query("""SELECT source, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM documents GROUP BY source""")
def source_shares(spark, sf_dir):
    counts = stats.add_share(stats.value_counts(table(spark, sf_dir, "documents"), "source"))
    return counts.withColumn("share", F.round("share", 6))


@query(f"""WITH {fx.SQL_DETECTED}
SELECT round(avg(CASE WHEN score > 0.8 THEN 1.0 ELSE 0.0 END), 6) AS rate FROM detected""")
def confident_rate(spark, sf_dir):
    docs = fx.with_stub_detection(table(spark, sf_dir, "documents"))
    rate = stats.rate(docs, F.col("lang_detect_result.score") > 0.8)
    return rate.select(F.round("rate", 6).alias("rate"))


@query(f"""WITH e AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM documents),
b AS (SELECT {fx.sql_bin('n_chars', 'lo', '(hi - lo) / 100', 100)} AS bin, count(*) AS n
      FROM documents, e GROUP BY 1)
SELECT g.bin, round(lo + g.bin * ((hi - lo) / 100), 4) AS bin_start, coalesce(n, 0) AS n
FROM (SELECT unnest(range(100)) AS bin) g CROSS JOIN e LEFT JOIN b ON b.bin = g.bin""")
def length_histogram(spark, sf_dir):
    bins = stats.histogram(table(spark, sf_dir, "documents"), F.col("n_chars"), 100)
    return bins.withColumn("bin_start", F.round("bin_start", 4))


@query(f"""WITH e AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1),
b AS (SELECT event_type, {fx.sql_bin('value', 'lo', '(hi - lo) / 10', 10)} AS bin, count(*) AS n
      FROM events JOIN e USING (event_type) GROUP BY ALL)
SELECT event_type, bin, round(lo + bin * ((hi - lo) / 10), 4) AS bin_start, coalesce(n, 0) AS n
FROM e CROSS JOIN (SELECT unnest(range(10)) AS bin) LEFT JOIN b USING (event_type, bin)""")
def histogram_per_group(spark, sf_dir):
    bins = stats.grouped_histogram(table(spark, sf_dir, "events"), "event_type", F.col("value"), 10)
    return bins.withColumn("bin_start", F.round("bin_start", 4))


@query("SELECT count(DISTINCT lang) AS n_distinct FROM documents")
def distinct_languages(spark, sf_dir):
    return stats.distinct_values(table(spark, sf_dir, "documents"), "lang")


def _sql_rollup(floor: int) -> str:
    return f"""WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
u AS (SELECT lang, n FROM c UNION ALL SELECT 'Other', sum(n)::BIGINT FROM c WHERE n < {floor})
SELECT lang, n FROM u WHERE n > {floor}"""


@query(_sql_rollup(130))
def tail_rollup(spark, sf_dir):
    counts = stats.value_counts(table(spark, sf_dir, "documents"), "lang")
    return stats.tail_rollup(counts, "lang", floor=130)


@query(_sql_rollup(500))
def tail_rollup_default(spark, sf_dir):
    return stats.tail_rollup(stats.value_counts(table(spark, sf_dir, "documents"), "lang"), "lang")


@query("""SELECT round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
round(quantile_cont(value, 0.75), 6) AS q75 FROM events""")
def value_quantiles(spark, sf_dir):
    cuts = stats.exact_quantiles(
        table(spark, sf_dir, "events"), F.col("value"), {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    )
    return cuts.select(*[F.round(c, 6).alias(c) for c in cuts.columns])


@query("""SELECT lang, round(avg(n_chars), 6) AS mean, count(n_chars) AS n FROM documents GROUP BY lang""")
def mean_length_per_language(spark, sf_dir):
    rows = stats.mean_and_size(table(spark, sf_dir, "documents"), "lang", F.col("n_chars").cast("double"))
    return rows.withColumn("mean", F.round("mean", 6))


@query("""SELECT source, round(sum((length(text) * 30 + length(source) * 10) / 1000000.0), 3) AS dollars
FROM documents GROUP BY source""")
def call_costs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return stats.total_cost(docs, F.length("source"), F.length("text"), ["source"])
