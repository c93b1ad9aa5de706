import os
import uuid
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lingmill import schemas
from lingmill.plans import curation
from lingmill.session import new_table_path, settle, shared_dir
from lingmill.sources import nesting, readers, writers
from lingmill.streaming import incremental
from lingmill.operators import inference
from tests.conftest import plan_of


def test_settled_tables_live_in_the_shared_folder(spark):
    df = settle(spark.range(10).withColumn("b", F.col("id") % 2), "t", ["b"])
    assert df.schema.names == ["id", "b"] and df.count() == 10
    assert shared_dir(spark) in plan_of(df).replace("file:", "") or "InMemoryFileIndex" in plan_of(df)
    assert new_table_path(spark, "x") != new_table_path(spark, "x")


def test_chunks_on_disk(spark, tmp_path):
    path = str(tmp_path / "c")
    writers.write_chunks(spark.range(1100).repartition(6), path, ["id"], 500)
    assert sorted(d for d in os.listdir(path) if d.startswith("chunk")) == ["chunk_id=000000", "chunk_id=000500", "chunk_id=001000"]
    stored = spark.read.parquet(path + "/chunk_id=000500")
    assert sorted(r.id for r in stored.collect()) == list(range(500, 1000))


def test_glob_exclusion_and_values_from_paths(spark, tmp_path):
    for name in ("title_en_500", "title_fr_500", "title_selected_500"):
        spark.range(2).write.parquet(str(tmp_path / f"{name}.parquet"))
    df = readers.read_glob(spark, str(tmp_path), exclude="selected")
    langs = df.select(readers.value_from_path(r"title_(\w+)_500").alias("l")).distinct().collect()
    assert {r.l for r in langs} == {"en", "fr"}


def test_language_reads_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "l")
    rows = [("en", 1), ("fr", 2), ("de", 3)]
    spark.createDataFrame(rows, "language_code string, n int").write.partitionBy("language_code").parquet(path)
    df = readers.read_languages(spark, path, ["fr"])
    assert "(language_code#" in plan_of(df).split("PartitionFilters:")[1] and [r.n for r in df.collect()] == [2]
    assert readers.read_languages(spark, path).count() == 3


def test_shard_manifest(spark):
    last = spark.createDataFrame([("af", 2), ("ab", 0)], "lang string, last int")
    rows = readers.shard_manifest(last, "x/%s/%s.parquet").collect()
    assert sorted(r.url for r in rows) == ["x/ab/0000.parquet", "x/af/0000.parquet", "x/af/0001.parquet", "x/af/0002.parquet"]


def test_rounds_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "r")
    for number, value in ((1, 1), (2, 2), (2, 3)):
        writers.append_round(spark.range(3).withColumn("round", F.lit(number)).withColumn("v", F.lit(value)), path, number)
    assert sorted((r["round"], r.v) for r in readers.read_rounds(spark, path).collect()) == [(1, 1)] * 3 + [(2, 3)] * 3


@pytest.mark.parametrize("parts", [1, 6])
def test_leading_messages(spark, parts):
    turns = [(c, t, "user" if t % 2 else "system", f"{c}:{t}") for c in range(5) for t in range(c, c + 1 + 20 * (c == 3))]
    df = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string").repartition(parts)
    got = {r.conv_id: [m.content for m in r.conversation] for r in nesting.leading_messages(df, "conv_id", "turn").collect()}
    assert got == {0: ["0:0"], 1: ["1:1"], 2: ["2:2"], 3: ["3:3", "3:4"], 4: ["4:4"]}


CHAT_ROWS = [
    ("1", [("hello there", "user")], "English", [({"x": False},)]),
    ("2", [("my name is", "user")], "English", [({"x": False},)]),
    ("3", [("bad thing", "user")], "English", [({"x": True},)]),
    ("4", [("  h ", "user")], "English", [({"x": False},)]),
    ("5", [("hello", "user")], "Klingon", [({"x": False},)]),
    ("6", [("bonjour", "user"), ("oui", "assistant")], "French", [({"x": False},)]),
]


def test_whole_curation(spark):
    chats = spark.createDataFrame(CHAT_ROWS, schemas.CHATS)

    def detector():
        return lambda texts: [("fr" if t.startswith("bon") else "en", 0.99) for t in texts]

    assert {r.conversation_id for r in curation.clean_chats(chats).collect()} == {"1", "6"}
    got = curation.curate_prompts(
        chats.unionByName(spark.createDataFrame([("7", [("hello there", "user")], "English", None)], schemas.CHATS)),
        detector,
        embed=lambda prompt: F.when(prompt.contains("hello"), F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0))),
    )
    assert sorted((r.conversation_id, r.first_exchange_len_tokens) for r in got.collect()) == [("1", 2), ("6", 2)]


def test_a_stream_that_fails_goes_on_from_its_offsets(spark, tmp_path):
    given, out, mark, log = (str(tmp_path / n) for n in ("in", "out", "mark", "log"))
    Path(log).mkdir()
    prompts = spark.range(40).select("id", F.concat(F.lit("p"), "id").alias("prompt"))
    for part in range(4):
        prompts.where(F.col("id") % 4 == part).coalesce(1).write.mode("append").parquet(given)

    def run(limit):
        def call(row):
            if len(list(Path(log).iterdir())) >= limit:
                raise SystemExit("lost")
            Path(log, f"{row['id']}-{uuid.uuid4().hex}").touch()
            return inference.echo(row)

        rows = incremental.read_new_files(spark, given, prompts.schema, 1)
        incremental.run_available(rows, out, mark, lambda d: inference.run_calls(d, ["id"], call, workers=1)).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(25)  # in the third file
    kept = {r.id for r in spark.read.parquet(out).collect()}
    assert len(kept) == 20
    run(1000)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(40))
    asked = Counter(int(p.name.split("-")[0]) for p in Path(log).iterdir())
    assert all(asked[i] == 1 for i in kept) and set(asked) == set(range(40))


def test_filters_and_calls_on_a_stream(spark, tmp_path):
    given, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def run():
        stream = curation.clean_chats(incremental.read_new_files(spark, given, schemas.CHATS, 1))
        rows = stream.select("conversation_id", F.col("conversation")[0]["content"].alias("prompt"))
        query = incremental.run_available(
            inference.run_calls(rows, ["conversation_id"], inference.echo), out, mark
        )
        query.awaitTermination()
        return {r.conversation_id: r.result.content for r in spark.read.parquet(out).collect()}

    df = spark.createDataFrame(CHAT_ROWS, schemas.CHATS)
    df.where("conversation_id < 4").coalesce(1).write.parquet(given)
    assert run() == {"1": "hello there"}
    df.where("conversation_id >= 4").coalesce(1).write.mode("append").parquet(given)
    assert run() == {"1": "hello there", "6": "bonjour"}
    assert spark.read.parquet(out).count() == 2
