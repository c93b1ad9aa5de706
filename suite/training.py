"""Training-set preparation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import messages, text
from lingmill.operators import sampling, tokens, trainset
from lingmill.sources import nesting
from suite import fixtures as fx
from suite.registry import query, table


@query(f"""SELECT doc_id, {fx.sql_draw('doc_id', 'split-0', 100)} < 1 AS held_out FROM documents""")
def validation_split(spark, sf_dir):
    train, held_out = trainset.split(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"])
    return train.withColumn("held_out", F.lit(False)).unionByName(held_out.withColumn("held_out", F.lit(True)))


@query("""SELECT conv_id AS conversation_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS place,
role = 'assistant' AS train, text AS value FROM conversations""")
def loss_mask(spark, sf_dir):
    """Every turn of every conversation."""
    turns = trainset.mask_turns(table(spark, sf_dir, "conversations"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    return turns.select(
        F.col("conv_id").alias("conversation_id"), place.cast("int").alias("place"), "train", F.col("text").alias("value")
    )


@query("""SELECT conv_id AS conversation_id, CASE WHEN NOT bool_and(role IN ('user', 'assistant', 'system'))
  THEN 'unknown sender' WHEN bool_or(text IS NULL) THEN 'missing text' WHEN NOT bool_or(role = 'assistant')
  THEN 'no reply' END AS problem FROM conversations GROUP BY conv_id""")
def conversation_problems(spark, sf_dir):
    """Judged over all turns."""
    found = trainset.turn_problems(table(spark, sf_dir, "conversations"), "conv_id")
    return found.withColumnRenamed("conv_id", "conversation_id")


@query("""SELECT conv_id, first_role, CASE WHEN coalesce(first_role, '') <> 'assistant' AND coalesce(second_role, '')
  <> 'assistant' THEN 'no reply' END AS problem FROM (SELECT conv_id, max(CASE WHEN place = 1 THEN role END) AS first_role,
  max(CASE WHEN place = 2 THEN role END) AS second_role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id
  ORDER BY turn) AS place FROM conversations) GROUP BY conv_id)""")
def first_exchange_problems(spark, sf_dir):
    """The same check on nested first exchanges."""
    heads = nesting.leading_messages(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    sender = {"user": "human", "assistant": "gpt", "system": "system"}
    turns = F.transform(
        "conversation",
        lambda m: F.struct(
            F.create_map(*[F.lit(x) for pair in sender.items() for x in pair])[m["role"]].alias("from"),
            m["content"].alias("value"),
        ),
    )
    judged = trainset.with_problems(heads.withColumn("conversations", turns))
    return judged.select("conv_id", F.col("conversation")[0]["role"].alias("first_role"), "problem")


SQL_TOKENS = r"docs AS (SELECT doc_id, len(regexp_extract_all(text, '\w+|[^\w\s]'))::BIGINT AS tokens FROM documents)"
CAPACITY = fixed.PACK_LENGTHS[0]
# Best fit, one row after the other: the space left in each bin is carried along.
SQL_PACKED = f"""{SQL_TOKENS},
rows AS MATERIALIZED (SELECT doc_id, tokens, least(greatest(tokens, 1), {CAPACITY}) AS size,
   row_number() OVER (ORDER BY least(greatest(tokens, 1), {CAPACITY}) DESC, {fx.sql_hash('doc_id', 'pack-0')}, doc_id) AS n FROM docs),
packing(n, free, bin) AS (SELECT 0::BIGINT, []::BIGINT[], 0::BIGINT UNION ALL
   SELECT n, CASE WHEN best IS NULL THEN list_append(free, {CAPACITY} - size)
     ELSE list_concat(free[:bin], [best - size], free[bin + 2:]) END, bin
   FROM (SELECT n, size, free, best, CASE WHEN best IS NULL THEN len(free) ELSE list_position(free, best) - 1 END AS bin
     FROM (SELECT r.n, r.size, p.free, list_min(list_filter(p.free, lambda x: x >= r.size)) AS best
       FROM packing p JOIN rows r ON r.n = p.n + 1))),
bins AS (SELECT doc_id, tokens, bin FROM rows JOIN packing USING (n))"""


def _packed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.word_count(F.col("text")).alias("tokens"))
    return trainset.pack(docs, "doc_id", "tokens", CAPACITY)


@query(f"WITH RECURSIVE {SQL_PACKED} SELECT doc_id, tokens, bin FROM bins")
def packed_sequences(spark, sf_dir):
    """Documents packed into 8,192-token sequences."""
    return _packed(spark, sf_dir)


@query(f"WITH RECURSIVE {SQL_PACKED} SELECT bin, count(*) AS n_rows, sum(tokens)::BIGINT AS n_tokens FROM bins GROUP BY bin")
def packed_rows(spark, sf_dir):
    """Rows and tokens of every bin."""
    return _packed(spark, sf_dir).groupBy("bin").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("tokens").alias("n_tokens"))


@query(f"""WITH {SQL_TOKENS} SELECT count(*) AS n_rows, sum(tokens)::BIGINT AS n_tokens, 0::BIGINT AS n_overfull,
false AS mergeable FROM docs""")
def packed_bins(spark, sf_dir):
    """What packing promises: no bin of several rows overflows, no two bins fit into one."""
    bins = _packed(spark, sf_dir).groupBy("bin").agg(
        F.sum("tokens").alias("tokens"), F.sum(F.greatest("tokens", F.lit(1))).alias("used"), F.count(F.lit(1)).alias("n")
    )
    # If any two bins fit into one, the two emptiest do.
    emptiest = bins.orderBy("used", "bin").limit(2).agg(F.sum("used").alias("least"), F.count(F.lit(1)).alias("two"))
    totals = bins.agg(
        F.sum("n").alias("n_rows"),
        F.sum("tokens").alias("n_tokens"),
        F.count_if((F.col("used") > CAPACITY) & (F.col("n") > 1)).alias("n_overfull"),
    )
    mergeable = (F.col("two") == 2) & (F.col("least") <= CAPACITY)
    return totals.join(emptiest).select("n_rows", "n_tokens", "n_overfull", mergeable.alias("mergeable"))


@query("""SELECT conv_id, turn, role = 'assistant' AS train, length(text) AS n FROM conversations""")
def turn_loss_mask(spark, sf_dir):
    """The mask on whole conversations kept as one row a turn."""
    turns = table(spark, sf_dir, "conversations")
    # Each row holds one turn; nothing is gathered.
    one = F.array(F.struct(F.col("role").alias("from"), F.col("text").alias("value")))
    masked = turns.withColumn("m", messages.trained_messages(one, "assistant")[0])
    return masked.select("conv_id", "turn", "m.train", F.length("m.value").cast("long").alias("n"))


@query("""SELECT doc_id, length(text)::DOUBLE AS n_chars, (length(text) - length(replace(text, 'e', '')))::DOUBLE AS n_e
FROM documents""")
def embedded_texts(spark, sf_dir):
    """A stand-in model that embeds a text as two counts."""

    def load():
        return lambda items: [[float(len(t)), float(t.count("e"))] for t in items]

    vectors = table(spark, sf_dir, "documents").select("doc_id", tokens.embed(F.col("text"), load).alias("v"))
    return vectors.select("doc_id", F.col("v")[0].cast("double").alias("n_chars"), F.col("v")[1].cast("double").alias("n_e"))


@query("""SELECT doc_id, source, n_chars FROM documents""")
def scattered_rows(spark, sf_dir):
    """Rows spread over partitions by key; none is lost or repeated."""
    return sampling.scatter(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), ["doc_id"], 8)
