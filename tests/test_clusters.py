import numpy as np
from pyspark.sql import functions as F

from lingmill.operators import articles, clusters, sampling

SCHEMA = "k long, g string, v array<float>"


def blobs(spark, per_blob=60):
    """Two languages with three far-apart blobs each, and one language of two rows."""
    rng = np.random.default_rng(4)
    rows, key = [], 0
    for g in ("aa", "bb"):
        for c in range(3):
            for _ in range(per_blob):
                v = rng.normal(scale=0.1, size=6)
                v[c] += 10
                rows.append((key, g, [float(x) for x in v]))
                key += 1
    rows += [(9001, "tiny", [0.0] * 6), (9000, "tiny", [1.0] * 6)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def inertia(df, centroids):
    gaps = clusters.assign_clusters(df, centroids, "k", "g", "v").groupBy("g").agg(F.sum("gap").alias("i"))
    return {r.g: r.i for r in gaps.collect()}


def random_start(df, k, seed):
    drawn = sampling.sample_per_group(df, ["g"], ["k"], k, f"random-{seed}", rank="_place")
    return drawn.select("g", (F.col("_place") - 1).cast("long").alias("label"), F.col("v").cast("array<double>").alias("center"))


def test_fit_uses_every_row_once_and_improves(spark):
    df = blobs(spark)
    fitted = clusters.fit_clusters(df, "k", "g", "v", k=8, batches=4)
    weights = {r.g: r.w for r in fitted.groupBy("g").agg(F.sum("weight").alias("w")).collect()}
    assert weights == {"aa": 180.0, "bb": 180.0}
    assert fitted.count() == 16
    start = inertia(df, random_start(df.where("g <> 'tiny'"), 8, 0))
    assert all(i < start[g] for g, i in inertia(df, fitted).items())


def test_fit_is_repeatable(spark):
    def rounded(df):
        return sorted((r.g, r.label, tuple(round(x, 9) for x in r.center)) for r in df.collect())

    one = clusters.fit_clusters(blobs(spark), "k", "g", "v", k=3, batches=2)
    two = clusters.fit_clusters(blobs(spark).repartition(2), "k", "g", "v", k=3, batches=2)
    assert rounded(one) == rounded(two)


def test_labels_are_nearest_and_small_groups_stand_alone(spark):
    df = blobs(spark)
    fitted = clusters.fit_clusters(df, "k", "g", "v", k=8, batches=4)
    labelled = clusters.label_rows(df, fitted, "k", "g", "v").collect()
    vectors = {r.k: np.array(r.v) for r in df.collect()}
    assert sorted(r.k for r in labelled) == sorted(vectors)
    centers = {}
    for r in fitted.collect():
        centers.setdefault(r.g, {})[r.label] = np.array(r.center)
    for r in labelled:
        if r.g == "tiny":
            assert r.label == r.k - 9000
        else:
            gaps = {label: ((vectors[r.k] - c) ** 2).sum() for label, c in centers[r.g].items()}
            assert gaps[r.label] <= min(gaps.values()) + 1e-9


def test_blocks_of_centres_change_nothing(spark):
    df = blobs(spark)
    fitted = clusters.fit_clusters(df, "k", "g", "v", k=5, batches=1)
    one = clusters.assign_clusters(df, fitted, "k", "g", "v")
    more = clusters.assign_clusters(df, fitted, "k", "g", "v", block_bytes=200)
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in more.collect()}
    assert one.columns == more.columns == ["k", "g", "label", "gap"]


def test_seeding_is_no_worse_than_a_random_start_on_any_label(spark):
    """Many blobs of unequal size: a random start misses small ones, k-means|| does not."""
    rng = np.random.default_rng(11)
    rows = []
    for g in "abcd":
        for blob, size in enumerate([300, 120, 60, 30, 12, 6]):
            center = rng.normal(scale=8, size=5)
            rows += [(len(rows) + i, g, [float(x) for x in center + rng.normal(scale=0.3, size=5)]) for i in range(size)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    seeded = inertia(df, clusters.initial_centroids(df, "k", "g", "v", 8, 0))
    for seed in range(3):
        drawn = inertia(df, random_start(df, 8, seed))
        assert all(seeded[g] <= drawn[g] for g in "abcd")


def test_sums_add_up_in_the_task(spark):
    df = blobs(spark)
    centers = random_start(df.where("g <> 'tiny'"), 4, 1)
    sums = {(r.g, r.label): (np.array(r.total), r.n) for r in clusters.sums_per_center(df, centers, "g", "v").collect()}
    wanted = {}
    vectors = {r.k: np.array(r.v) for r in df.collect()}
    for r in clusters.assign_clusters(df, centers, "k", "g", "v").collect():
        total, n = wanted.get((r.g, r.label), (0, 0))
        wanted[r.g, r.label] = (total + vectors[r.k], n + 1)
    assert sums.keys() == wanted.keys()
    assert all(np.allclose(sums[c][0], wanted[c][0]) and sums[c][1] == wanted[c][1] for c in sums)


def test_at_most_one_row_a_centre_leaves_a_task(spark):
    df = blobs(spark, 400).coalesce(2)
    centers = random_start(df.where("g <> 'tiny'"), 3, 1)
    sums = clusters.sums_per_center(df, centers, "g", "v")
    written = [p for p in sums._jdf.inputFiles()]
    assert spark.read.parquet(*written).count() <= 2 * 2 * 3


def test_starved_centres_move_to_rows_of_the_batch(spark):
    rows = blobs(spark).where("g = 'aa'")
    center = spark.createDataFrame(
        [("aa", 0, [10.0, 0.0, 0.0, 0.0, 0.0, 0.0], 100.0), ("aa", 1, [0.0, 10.0, 0.0, 0.0, 0.0, 0.0], 20.0), ("aa", 2, [99.0] * 6, 0.0), ("bb", 0, [1.0] * 6, 5.0)],
        "g string, label long, center array<double>, weight double",
    )
    moved = {(r.g, r.label): (r.center, r.weight) for r in clusters.replace_starved(rows, center, "k", "g", "v", "t").collect()}
    vectors = {tuple(np.float64(np.float32(x)) for x in r.v) for r in rows.collect()}
    assert tuple(moved["aa", 2][0]) in vectors and moved["aa", 2][1] == 20.0
    assert moved["aa", 0] == ([10.0, 0.0, 0.0, 0.0, 0.0, 0.0], 100.0) and moved["bb", 0][1] == 5.0
    few = rows.limit(1)
    assert {tuple(r.center) for r in clusters.replace_starved(few, center, "k", "g", "v", "t").collect()} >= {(99.0,) * 6}


def test_fewer_different_vectors_than_centres(spark):
    df = spark.createDataFrame([(i, "a", [float(i % 3), 0.0]) for i in range(60)], SCHEMA)
    fitted = clusters.fit_clusters(df, "k", "g", "v", k=5, batches=2)
    assert sorted(tuple(np.round(r.center, 9)) for r in fitted.collect()) == [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)]
    assert clusters.label_rows(df, fitted, "k", "g", "v").groupBy("label").count().count() == 3


def test_from_chunks_to_articles(spark):
    chunks = [("en_1_0", "T1", "u1", [0.0, 1.0], "en"), ("en_1_1", "T1", "u1", [0.0, 1.0], "en"),
              ("en_2_0", "T2", "u2", [1.0, 0.0], "en"), ("en_3_1", "T3", "u3", [1.0, 0.0], "en"),
              ("en_3_2", "T3", "u3", [1.0, 0.0], "en"), ("fr_1_0", "T1", "u4", [1.0, 0.0], "fr"),
              ("en_4_0", "T4", "u5", [0.0, 1.0], "en"), ("en_4_7", "T4", "u5", [0.0, 1.0], "en")]
    df = spark.createDataFrame(chunks, "_id string, title string, url string, emb array<float>, lang string")
    assert {r.id_stem for r in articles.long_articles(df).collect()} == {"en_1", "en_3", "en_4"}
    heads = articles.first_chunks(df)
    # Article 3 is long but has no chunk 0; the French one is short in its own language.
    assert {r._id for r in heads.collect()} == {"en_1_0", "en_4_0"}
    titles = articles.title_clusters(df, k=1)
    assert {(r.title, r.label) for r in titles.collect()} == {("T1", 0), ("T4", 0)}
    texts = spark.createDataFrame([("T1", "a", "en"), ("T1", "b", "en"), ("T1", "c", "fr"), ("T9", "d", "en")], "title string, text string, language_code string")
    got = articles.sampled_articles(titles, texts, per_cluster=5)
    assert {r.text for r in got.collect()} == {"a", "b"}
    assert articles.sampled_articles(titles, texts, 5, ["fr"]).count() == 0
    assert articles.sampled_titles(titles, 1).count() == 1


def test_rows_without_a_vector(spark):
    df = blobs(spark).unionByName(spark.createDataFrame([(7000, "aa", None), (7001, "tiny", None)], SCHEMA))
    fitted = clusters.fit_clusters(df, "k", "g", "v", k=3, batches=2)
    labels = {r.k: r.label for r in clusters.label_rows(df, fitted, "k", "g", "v").collect()}
    assert len(labels) == df.count()
    assert (labels[7000], labels[7001]) == (-1, -2)
