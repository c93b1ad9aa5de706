"""Long articles, clusters, sampled titles and generation inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.operators import articles, clusters, inference
from suite import fixtures as fx
from suite.kmeans import sql_kmeans
from suite.registry import query, table


@query(f"""WITH {fx.SQL_CHUNKS} SELECT lang, id_stem, count(*) AS n_chunks FROM stems
GROUP BY lang, id_stem HAVING count(*) > 1""")
def long_articles(spark, sf_dir):
    return articles.long_articles(fx.chunks(spark, sf_dir))


@query(f"""WITH {fx.SQL_CHUNKS}, l AS (SELECT lang, id_stem FROM stems GROUP BY ALL HAVING count(*) > 1)
SELECT lang, _id, title, url FROM stems SEMI JOIN l USING (lang, id_stem) WHERE _id LIKE '%\\_0' ESCAPE '\\'""")
def first_chunks_of_long_articles(spark, sf_dir):
    return articles.first_chunks(fx.chunks(spark, sf_dir)).select("lang", "_id", "title", "url")


SQL_CENTERS = """dims AS (SELECT label, vec_id % 3 AS c, unnest(embedding) AS x,
   generate_subscripts(embedding, 1) AS d FROM embeddings),
means AS (SELECT label, c, d, avg(x::DOUBLE) AS x FROM dims GROUP BY ALL),
centers AS (SELECT label, c, list(x ORDER BY d) AS center FROM means WHERE label <> 7 GROUP BY label, c)"""


def _centers(spark, sf_dir):
    """Three means per label, none for label 7."""
    vectors = table(spark, sf_dir, "embeddings").where("label <> 7")
    dims = vectors.select(
        F.col("label").alias("grp"), F.pmod("vec_id", F.lit(3)).alias("label"), F.posexplode("embedding").alias("d", "x")
    )
    means = dims.groupBy("grp", "label", "d").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("d", "x")))
    return means.groupBy("grp", "label").agg(F.transform(ordered, lambda s: s["x"]).alias("center"))


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("grp"), "embedding")


SQL_NEAREST = f"""WITH {SQL_CENTERS}, near AS (SELECT vec_id, e.label AS grp, arg_min(c,
   list_distance(embedding::DOUBLE[], center)) AS cluster FROM embeddings e JOIN centers USING (label) GROUP BY ALL)"""


@query(f"""{SQL_NEAREST} SELECT vec_id, grp, cluster FROM near UNION ALL
SELECT vec_id, label, row_number() OVER (ORDER BY label, vec_id) - 1 FROM embeddings WHERE label = 7""")
def cluster_labels(spark, sf_dir):
    """Nearest centroid per row; rows of a group without centroids are numbered."""
    labelled = clusters.label_rows(_vectors(spark, sf_dir), _centers(spark, sf_dir), "vec_id", "grp", "embedding")
    return labelled.select("vec_id", "grp", F.col("label").alias("cluster"))


@query(f"{SQL_NEAREST} SELECT vec_id, grp, cluster FROM near")
def cluster_labels_in_chunks(spark, sf_dir):
    """The same assignment when centroids go to the executors in several blocks."""
    labelled = clusters.assign_clusters(
        _vectors(spark, sf_dir), _centers(spark, sf_dir), "vec_id", "grp", "embedding", block_bytes=6_000
    )
    return labelled.select("vec_id", "grp", F.col("label").alias("cluster"))


@query(f"""WITH r AS (SELECT vec_id AS key, label AS grp, embedding::DOUBLE[] AS v FROM embeddings),
{sql_kmeans(5, 3)},
fit AS (SELECT r.grp, arg_min(label, list_distance(v, center)) AS label, min(list_distance(v, center)) AS gap
   FROM r JOIN centers USING (grp) GROUP BY key, r.grp)
SELECT grp, label, count(*) AS n, round(sum(gap * gap), 3) AS inertia FROM fit GROUP BY ALL""")
def fitted_clusters(spark, sf_dir):
    """Mini-batch k-means per label: cluster sizes and inertia."""
    vectors = _vectors(spark, sf_dir)
    centroids = clusters.fit_clusters(vectors, "vec_id", "grp", "embedding", k=5, batches=3)
    labelled = clusters.assign_clusters(vectors, centroids, "vec_id", "grp", "embedding")
    return labelled.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("gap"), 3).alias("inertia"))


@query(f"""WITH {fx.SQL_CHUNKS}, l AS (SELECT lang, id_stem FROM stems GROUP BY ALL HAVING count(*) > 1),
heads AS (SELECT s.lang, s._id, s.title, s.url, embedding::DOUBLE[] AS v FROM stems s SEMI JOIN l USING (lang, id_stem)
   JOIN embeddings e ON e.vec_id::VARCHAR = split_part(s._id, '_', 2) WHERE s._id LIKE '%\\_0' ESCAPE '\\'),
r AS (SELECT _id AS key, lang AS grp, v FROM heads),
{sql_kmeans(8, 2)},
own AS (SELECT h._id, arg_min(label, list_distance(v, center)) AS label FROM heads h JOIN centers c ON c.grp = h.lang GROUP BY h._id),
alone AS (SELECT _id, row_number() OVER (ORDER BY lang, _id) - 1 AS label FROM heads h
   WHERE lang NOT IN (SELECT grp FROM centers))
SELECT lang, title, label, url FROM heads JOIN (SELECT * FROM own UNION ALL SELECT * FROM alone) USING (_id)""")
def clustered_titles(spark, sf_dir):
    """Long articles with vectors, clustered per language in one job."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("_v"), F.col("embedding").alias("emb"))
    own = fx.chunks(spark, sf_dir).withColumn("_v", F.element_at(F.split("_id", "_"), 2))
    return articles.title_clusters(own.join(vectors, "_v").drop("_v"), k=8, batches=2)


SQL_TITLES = f"""titles AS (SELECT lang, source, doc_id, split_part(text, chr(10), 1) AS title FROM documents),
drawn AS (SELECT DISTINCT lang, title FROM (SELECT *, row_number() OVER (PARTITION BY lang, source
   ORDER BY {fx.sql_hash('lang, source, title, doc_id')}, lang, source, title, doc_id) AS place FROM titles)
   WHERE place <= 2)"""


def _titles(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "lang",
        F.col("source").alias("label"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("doc_id").alias("url"),
    )


@query(f"WITH {SQL_TITLES} SELECT lang, title FROM drawn")
def titles_sampled_per_cluster(spark, sf_dir):
    return articles.sampled_titles(_titles(spark, sf_dir), 2)


@query(f"""WITH {SQL_TITLES} SELECT doc_id, lang AS language_code FROM titles SEMI JOIN drawn USING (lang, title)
WHERE lang IN ('de', 'es', 'fr')""")
def articles_of_sampled_titles(spark, sf_dir):
    """Drawn titles' articles, for a list of languages."""
    texts = table(spark, sf_dir, "documents").select(
        "doc_id", F.substring_index("text", "\n", 1).alias("title"), F.col("lang").alias("language_code")
    )
    out = articles.sampled_articles(_titles(spark, sf_dir), texts, 2, ["de", "es", "fr"])
    return out.select("doc_id", "language_code")


def _sql_articles(per_cluster: int, languages: str) -> str:
    drawn = SQL_TITLES.replace("place <= 2", f"place <= {per_cluster}")
    return f"SELECT doc_id, lang AS language_code FROM (WITH {drawn} SELECT * FROM titles SEMI JOIN drawn USING (lang, title)) WHERE {languages}"


POPULAR = ", ".join(f"'{c}'" for c in fixed.POPULAR_LANGUAGE_CODES)


@query(f"""SELECT 'every' AS article_set, * FROM ({_sql_articles(1, 'true')}) UNION ALL
SELECT 'popular', * FROM ({_sql_articles(10, f'lang IN ({POPULAR})')})""")
def article_sets(spark, sf_dir):
    """One title a cluster in every language, ten in the popular ones."""
    texts = table(spark, sf_dir, "documents").select(
        "doc_id", F.substring_index("text", "\n", 1).alias("title"), F.col("lang").alias("language_code")
    )
    sets = articles.article_sets(_titles(spark, sf_dir), texts)
    every, popular = (rows.select(F.lit(name).alias("article_set"), "doc_id", "language_code") for name, rows in sets.items())
    return every.unionByName(popular)


def _names(spark):
    """A name table that lacks Spanish."""
    rows = [(code, name) for code, name in fx.CODE_NAMES.items() if code != "es"]
    return spark.createDataFrame(rows, "language_code string, language_name string")


SQL_INPUTS = f"""i AS (SELECT doc_id, text, source AS title, CASE WHEN lang <> 'es' THEN {fx.SQL_NAME} END AS language_name,
   CASE WHEN {fx.sql_draw('doc_id', 'type-0', 2)} = 1 THEN 'command' ELSE 'question' END AS prompt_type FROM documents)"""


def _inputs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("title"), "text", F.col("lang").alias("language_code")
    )
    return articles.generation_inputs(docs, _names(spark), ["doc_id"])


@query(f"WITH {SQL_INPUTS} SELECT doc_id, language_name, prompt_type FROM i")
def generation_inputs(spark, sf_dir):
    return _inputs(spark, sf_dir).select("doc_id", "language_name", "prompt_type")


@query(rf"""WITH {SQL_INPUTS}, w AS (SELECT *, regexp_split_to_array(text, '\s+') AS words FROM i)
SELECT doc_id, title || chr(10) || chr(10) || CASE WHEN len(words) <= 4096 THEN text
  ELSE array_to_string(words[1:4096], ' ') END AS prompt,
  contains(language_name, 'e') AS names_language FROM w""")
def article_requests(spark, sf_dir):
    """Requests for one article template, with the article truncated."""
    requests = inference.article_requests(_inputs(spark, sf_dir), "article_pair_by_category")
    named = F.when(F.col("language_name").isNotNull(), F.col("system").contains(F.concat(F.lit("the "), "language_name")))
    return requests.select("doc_id", "prompt", (named & F.col("language_name").contains("e")).alias("names_language"))
