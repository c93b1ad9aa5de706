from pyspark.sql import functions as F

from lingmill.operators import filters
from tests.conftest import plan_of

DETECTED = "i int, language string, prompt_list string, lang_detected struct<lang:string,score:double>"


def ids(df):
    return sorted(r.i for r in df.select("i").collect())


def test_agreement_boundary_and_quarantine(spark):
    rows = [
        (1, "English", ("en", 0.81)),
        (2, "English", ("en", 0.8)),
        (3, "English", ("fr", 0.9)),
        (4, "Elvish", ("en", 0.9)),
        (5, "Elvish", ("en", 0.5)),
        (6, "Scots", ("gd", 0.9)),
    ]
    df = spark.createDataFrame(rows, "i int, language string, lang_detect_result struct<lang:string,score:double>")
    names = filters.language_names(spark)
    got = {r.i: r.agreement for r in filters.judge_agreement(df, names).collect()}
    assert got == {1: "kept", 2: "low_score", 3: "mismatch", 4: "unmapped", 5: "low_score", 6: "kept"}
    assert ids(filters.keep_agreeing(df, names)) == [1, 6]
    assert ids(filters.unmapped_languages(df, names)) == [4]


def test_name_table_is_broadcast_by_its_own_size(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.range(10).selectExpr(
        "id", "'English' language", "struct('en' lang, 0.9D score) lang_detect_result"
    ).write.parquet(path)
    plan = plan_of(filters.keep_agreeing(spark.read.parquet(path), filters.language_names(spark)))
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_english_leaks(spark):
    rows = [
        (1, "French", "p", ("en", 0.8)),
        (2, "French", "p", ("en", 0.79)),
        (3, "French", "p", ("fr", 0.99)),
        (4, "Simple English", "p", ("en", 1.0)),
        (5, "French", "p", ("en", 0.95)),
    ]
    assert ids(filters.drop_english_leaks(spark.createDataFrame(rows, DETECTED))) == [2, 3, 4]


def test_wrong_language(spark):
    rows = [
        (1, "French", "p", ("en", 0.81)),
        (2, "French", "p", ("en", 0.8)),
        (3, "English", "p", ("en", 0.9)),
        (4, "New English", "p", ("en", 0.9)),
        (5, "French", "p", ("ja", 0.9)),
        (6, "Japanese", "p", ("ja", 0.9)),
        (7, "French", None, ("en", 0.9)),
        (8, None, "p", ("en", 0.9)),
        (9, "French", "p", None),
    ]
    df = spark.createDataFrame(rows, DETECTED)
    assert ids(filters.drop_wrong_language(df)) == [2, 3, 6, 7, 9]


def test_length_languages_and_nulls(spark):
    df = spark.createDataFrame([(1, " a "), (2, "ab"), (3, None), (4, "xx")], "i int, t string")
    assert ids(filters.drop_short(df, F.col("t"))) == [2, 4]
    assert ids(filters.drop_languages(df, "t")) == [1, 2, 3]
    assert ids(filters.drop_incomplete_rows(df)) == [1, 2, 4]
