"""Inputs the queries derive from the test tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import draws, text
from lingmill.sources import nesting
from suite.registry import table

# Language codes of the documents table and their names.
CODE_NAMES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}

SQL_WHITESPACE = "'" + text.WHITESPACE + "'"


def sql_draw(keys: str, seed: str, limit: int) -> str:
    """``draws.draw_below`` as SQL."""
    return f"(('0x' || substr(md5(concat_ws('|', {keys}, '{seed}')), 1, 8))::BIGINT % {limit})"


def sql_hash(keys: str, seed: str = "0") -> str:
    """``draws.order_hash`` as SQL."""
    return f"md5(concat_ws('|', {keys}, '{seed}'))"


def sql_uniform(keys: str, seed: str) -> str:
    """``draws.uniform`` as SQL."""
    return f"((('0x' || substr(md5(concat_ws('|', {keys}, '{seed}')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)"


def sql_bin(x: str, lo: str, width: str, bins: int) -> str:
    """Equal-width bin number as SQL, exact at the edges."""
    guess = f"least(floor(({x} - {lo}) / ({width})), {bins - 1})"
    return (
        f"({guess} - ({x} < {lo} + {guess} * ({width}))::INT"
        f" + ({x} >= {lo} + ({guess} + 1) * ({width}) AND {guess} < {bins - 1})::INT)::BIGINT"
    )


SQL_NAME = "CASE lang " + " ".join(
    f"WHEN '{code}' THEN '{name}'" for code, name in CODE_NAMES.items()
) + " END"


def declared_name(code: Column) -> Column:
    out = F
    for wanted, name in CODE_NAMES.items():
        out = out.when(code == wanted, name)
    return out


# --- chats: the first two messages of each conversation ---------------------------


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversation_id, conversation, language (declared name), openai_moderation."""
    heads = nesting.leading_messages(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), "lang")
    toxic = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("conv_id"), "toxic")
    categories = F.create_map(
        F.lit("toxic"), F.coalesce(F.col("toxic") == 1, F.lit(False)), F.lit("other"), F.lit(False)
    )
    return (
        heads.join(docs, "conv_id", "left")
        .join(toxic, "conv_id", "left")
        .select(
            F.col("conv_id").alias("conversation_id"),
            "conversation",
            declared_name(F.col("lang")).alias("language"),
            F.array(F.struct(categories.alias("categories"))).alias("openai_moderation"),
        )
    )


SQL_CHATS = f"""
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place
          FROM conversations),
heads AS (SELECT conv_id, max(CASE WHEN place = 1 THEN text END) AS first_text,
                 max(CASE WHEN place = 2 THEN text END) AS second_text,
                 max(CASE WHEN place = 1 THEN role END) AS first_role
          FROM turns GROUP BY conv_id),
chats AS (SELECT h.conv_id AS conversation_id, first_text, second_text, first_role,
                 concat_ws(' ', first_text, second_text) AS exchange,
                 {SQL_NAME} AS language, coalesce(l.toxic = 1, false) AS toxic
          FROM heads h LEFT JOIN documents d ON d.doc_id = h.conv_id
          LEFT JOIN labels l ON l.doc_id = h.conv_id)
"""

# --- detections: the true language, hidden for some rows, with a drawn score -----------


def with_stub_detection(docs: DataFrame, name: str = "lang_detect_result") -> DataFrame:
    """Adds a declared language and a detection to documents, from hashes of doc_id."""
    key = [F.col("doc_id")]
    wrong = draws.draw_below(key, "wrong", 10)
    declared = (
        F.when(draws.draw_below(key, "declared", 20) == 0, "Atlantean")
        .when(draws.draw_below(key, "declared", 20) == 1, "unknown")
        .otherwise(declared_name(F.col("lang")))
    )
    found = F.when(wrong < 2, "en").when(wrong == 2, "ja").otherwise(F.col("lang"))
    score = draws.draw_below(key, "score", 11) / 10
    detection = F.when(
        draws.draw_below(key, "none", 25) > 0,
        F.struct(found.alias("lang"), score.alias("score")),
    )
    return docs.withColumn("language", declared).withColumn(name, detection)


SQL_DETECTED = f"""
drawn AS (SELECT *, {sql_draw('doc_id', 'wrong', 10)} AS wrong,
                 {sql_draw('doc_id', 'declared', 20)} AS dec,
                 {sql_draw('doc_id', 'none', 25)} AS none_draw,
                 {sql_draw('doc_id', 'score', 11)} / 10 AS drawn_score FROM documents),
detected AS (SELECT doc_id, text, lang, source, n_chars,
      CASE dec WHEN 0 THEN 'Atlantean' WHEN 1 THEN 'unknown' ELSE {SQL_NAME} END AS language,
      CASE WHEN none_draw > 0 THEN CASE WHEN wrong < 2 THEN 'en' WHEN wrong = 2 THEN 'ja'
           ELSE lang END END AS found,
      CASE WHEN none_draw > 0 THEN drawn_score END AS score FROM drawn)
"""

# --- ballots: days are prompts, event types are models, users mod 5 are judges -----------


def ballot_cells(spark: SparkSession, sf_dir: str, partial: bool = False) -> DataFrame:
    """block, judge, model, score: higher is better, equal scores tie."""
    events = table(spark, sf_dir, "events")
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    cells = events.groupBy(
        F.to_date("ts").cast("string").alias("block"),
        F.pmod("user_id", F.lit(5)).cast("int").alias("judge"),
        F.col("event_type").alias("model"),
    ).agg(F.floor((cents + 5000) / 10000).cast("long").alias("score"))
    if partial:
        cells = cells.where(
            ~((F.pmod(F.substring("block", 9, 2).cast("int"), F.lit(10)) == F.col("judge"))
              & (F.col("model") == "view"))
        )
    return cells


def _sql_cells(partial: bool) -> str:
    dropped = (
        "WHERE NOT (substr(block, 9, 2)::INT % 10 = judge AND model = 'view')" if partial else ""
    )
    return f"""
allcells AS (SELECT strftime(ts, '%Y-%m-%d') AS block, (user_id % 5)::INT AS judge,
                    event_type AS model,
                    floor((sum(round(value * 100)::BIGINT) + 5000) / 10000)::BIGINT AS score
             FROM events GROUP BY ALL),
cells AS (SELECT * FROM allcells {dropped}),
models AS (SELECT DISTINCT block, model FROM allcells),
letters AS (SELECT c.block, c.judge, m.model,
       chr((64 + row_number() OVER (PARTITION BY c.block, c.judge
            ORDER BY {sql_hash("c.block, c.judge, m.model", "letters")}))::INT) AS letter
       FROM (SELECT DISTINCT block, judge FROM allcells) c JOIN models m USING (block)),
spot AS (SELECT block, judge, {sql_draw("block, judge", "spoil", 10)} AS spoil,
         row_number() OVER (PARTITION BY block ORDER BY judge) - 1 AS round
         FROM (SELECT DISTINCT block, judge FROM allcells)),
long AS (SELECT c.block, c.judge, s.round, s.spoil, l.letter, c.model, c.score,
        dense_rank() OVER (PARTITION BY c.block, c.judge ORDER BY c.score DESC) - 1 AS level,
        rank() OVER (PARTITION BY c.block, c.judge ORDER BY c.score DESC) AS place,
        count(*) OVER (PARTITION BY c.block, c.judge, c.score) AS tied,
        count(*) OVER (PARTITION BY c.block, c.judge) AS n
        FROM cells c JOIN letters l USING (block, judge, model) JOIN spot s USING (block, judge)),
answers AS (SELECT block, model, 'answer of ' || model || ' on ' || block AS content,
        CASE WHEN {sql_draw("block, model", "finish", 20)} = 0 THEN 'length' ELSE 'stop' END
            AS finish_reason FROM models),
finished AS (SELECT block FROM answers GROUP BY block
             HAVING bool_and(finish_reason = 'stop')),
judged AS (SELECT block FROM finished JOIN spot USING (block) GROUP BY block
           HAVING count(*) = 5),
totals AS (SELECT block, model, sum(place) AS t, count(*) AS k
           FROM long JOIN judged USING (block) GROUP BY ALL),
agreement AS (SELECT t.block, CASE WHEN min(t.k) < 5 OR count(*) < any_value(m.n) THEN NULL
                ELSE 12.0 * (sum(t * t) - sum(t) * sum(t) * 1.0 / count(*))
                     / (25 * (count(*) * count(*) * count(*) - count(*))) END AS w,
                count(*) AS n
              FROM totals t JOIN (SELECT block, count(*) AS n FROM models GROUP BY block) m
              USING (block) GROUP BY t.block),
borda AS (SELECT block, model, sum(n - (place - 1) - (tied - 1) / 2.0)::DOUBLE AS borda
          FROM long JOIN judged USING (block) GROUP BY ALL)
"""


SQL_BALLOTS = _sql_cells(False)
SQL_PARTIAL_BALLOTS = _sql_cells(True)


def judged_chats(
    spark: SparkSession, sf_dir: str, partial: bool = False, spoiled: bool = False
) -> DataFrame:
    """conversation_id (the block), conversation, language, llm_responses, model_evals.

    Each block has at most five judges and one answer per event type. ``spoiled``
    makes some replies missing, unmarked, repeating an id or naming an unknown one.
    """
    cells = ballot_cells(spark, sf_dir)
    kept = ballot_cells(spark, sf_dir, partial)
    finish = F.when(
        draws.draw_below([F.col("block"), F.col("model")], "finish", 20) == 0, "length"
    ).otherwise("stop")
    content = F.concat(F.lit("answer of "), "model", F.lit(" on "), "block")
    answers = (
        cells.select("block", "model", content.alias("content"), finish.alias("finish_reason"))
        .distinct()
        .groupBy("block")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("model", F.struct("content", "finish_reason")))
            ).alias("llm_responses")
        )
    )
    models = F.array_sort(
        F.transform(
            F.map_keys("llm_responses"),
            lambda m: F.struct(
                draws.order_hash([F.col("block"), F.col("judge"), m], "letters").alias("h"),
                m.alias("model"),
            ),
        )
    )
    lettered = F.transform(
        models,
        lambda m, i: F.struct(text.letter(i).alias("letter"), m["model"].alias("model")),
    )
    scores = kept.groupBy("block", "judge").agg(
        F.collect_list(F.struct("score", "model")).alias("scores")
    )
    each = (
        cells.select("block", "judge").distinct().join(scores, ["block", "judge"], "left")
        .join(answers, "block")
        .withColumn("model_id_list", lettered)
    )
    levels = F.sort_array(F.array_distinct(F.transform("scores", lambda s: s["score"])), asc=False)

    def letter_of(model: Column) -> Column:
        return F.filter("model_id_list", lambda x: x["model"] == model)[0]["letter"]

    ranking = F.array_join(
        F.transform(
            levels,
            lambda score: F.array_join(
                F.array_sort(
                    F.transform(
                        F.filter("scores", lambda s: s["score"] == score),
                        lambda s: letter_of(s["model"]),
                    )
                ),
                "=",
            ),
        ),
        ">",
    )
    reply = F.concat(
        F.lit(f"Notes first.\n\n{fixed.RANKING_MARKER}\nZ>Y\n\n{fixed.RANKING_MARKER}\n"),
        ranking, F.lit("\n"),
    )
    if spoiled:
        spoil = draws.draw_below([F.col("block"), F.col("judge")], "spoil", 10)
        reply = (
            F.when(spoil == 0, F.lit(None).cast("string"))
            .when(spoil == 1, F.concat(F.lit("No ranking here: "), ranking))
            .when(spoil == 2, F.concat(reply.substr(F.lit(1), F.length(reply) - 1),
                                       F.lit(">"), F.substring(ranking, 1, 1)))
            .when(spoil == 3, F.concat(reply, F.lit(" > ?")))
            .otherwise(reply)
        )
    evals = F.array_sort(
        F.collect_list(
            F.struct(
                "judge",
                F.col("model_id_list"),
                reply.alias("eval_response"),
                F.lit("stop").alias("eval_finish_reason"),
                F.lit("judge").alias("eval_model_name"),
            )
        )
    )
    rounds = each.groupBy("block").agg(evals.alias("_evals"))
    return rounds.join(answers, "block").select(
        F.col("block").alias("conversation_id"),
        F.array(
            F.struct(F.concat(F.lit("prompt of "), "block").alias("content"), F.lit("user").alias("role"))
        ).alias("conversation"),
        F.concat(F.lit("language "), F.dayofweek(F.to_date("block")).cast("string")).alias("language"),
        "llm_responses",
        F.transform(
            "_evals",
            lambda e: F.struct(
                e["model_id_list"].alias("model_id_list"),
                e["eval_response"].alias("eval_response"),
                e["eval_finish_reason"].alias("eval_finish_reason"),
                e["eval_model_name"].alias("eval_model_name"),
            ),
        ).alias("model_evals"),
    )


# --- texts derived from documents ------------------------------------------------------


def prompt_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' lines as numbered lists; every third list starts with a blank line."""
    docs = table(spark, sf_dir, "documents")
    lines = F.split("text", "\n", -1)
    numbered = F.array_join(
        F.transform(lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n"
    )
    shifted = F.when(F.pmod("doc_id", F.lit(3)) == 0, "\n").otherwise("")
    return docs.select(
        "doc_id",
        declared_name(F.col("lang")).alias("language"),
        F.lit("stop").alias("finish_reason"),
        F.concat(shifted, numbered).alias("gen_prompts"),
    )


SQL_PROMPT_LISTS = f"""
lists AS (SELECT doc_id, {SQL_NAME} AS language,
    CASE WHEN doc_id % 3 = 0 THEN chr(10) ELSE '' END ||
    array_to_string(list_transform(string_split(text, chr(10)),
        lambda x, i: i::VARCHAR || '. ' || x), chr(10)) AS gen_prompts FROM documents),
lines AS (SELECT doc_id, language, unnest(string_split(gen_prompts, chr(10))) AS line,
                 generate_subscripts(string_split(gen_prompts, chr(10)), 1) AS place FROM lists),
cut AS (SELECT doc_id, language, place,
               trim(substr(line, length(place::VARCHAR) + 1), ' .-。') AS item
        FROM lines WHERE starts_with(line, place::VARCHAR)),
items AS (SELECT doc_id, language, trim(item, {SQL_WHITESPACE}) AS item,
                 row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS position
          FROM cut WHERE length(trim(item, {SQL_WHITESPACE})) > 0)
"""


def marked_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated pairs: first line as prompt, rest as response, some malformed."""
    docs = table(spark, sf_dir, "documents")
    first = F.substring_index("text", "\n", 1)
    rest = F.col("text").substr(F.length(first) + 2, F.length("text"))
    kind = draws.draw_below([F.col("doc_id")], "reply", 6)
    whole = F.concat(F.lit("Sure.\n<<PROMPT>>\n"), first, F.lit("\n\n<<RESPONSE>>\n"), rest)
    content = (
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, F.col("text"))
        .when(kind == 2, F.concat(whole, F.lit("\n<<RESPONSE>> again "), first))
        .when(kind == 3, F.concat(whole, F.lit("<<RESPONSE>>")))
        .otherwise(whole)
    )
    reply = F.struct(content.alias("content"), F.lit("stop").alias("finish_reason"))
    return docs.select(
        "doc_id",
        declared_name(F.col("lang")).alias("language_name"),
        F.when(F.pmod("doc_id", F.lit(2)) == 0, "question").otherwise("command").alias("prompt_type"),
        reply.alias("generated_prompt_response"),
        F.col("source"),
    )


SQL_REPLIES = f"""
parts AS (SELECT doc_id, text, source, {SQL_NAME} AS language_name,
    CASE WHEN doc_id % 2 = 0 THEN 'question' ELSE 'command' END AS prompt_type,
    split_part(text, chr(10), 1) AS first,
    substr(text, length(split_part(text, chr(10), 1)) + 2) AS rest,
    {sql_draw('doc_id', 'reply', 6)} AS kind FROM documents),
whole AS (SELECT *, 'Sure.' || chr(10) || '<<PROMPT>>' || chr(10) || first || chr(10) || chr(10)
    || '<<RESPONSE>>' || chr(10) || rest AS body FROM parts),
replies AS (SELECT doc_id, source, language_name, prompt_type, CASE kind WHEN 0 THEN NULL WHEN 1 THEN text
    WHEN 2 THEN body || chr(10) || '<<RESPONSE>> again ' || first
    WHEN 3 THEN body || '<<RESPONSE>>' ELSE body END AS content FROM whole),
split AS (SELECT *, regexp_extract(content, '<<PROMPT>>((?s:.)+)<<RESPONSE>>((?s:.)+)', 1) AS p,
                 regexp_extract(content, '<<PROMPT>>((?s:.)+)<<RESPONSE>>((?s:.)+)', 2) AS r
          FROM replies),
parsed AS (SELECT doc_id, source, language_name, prompt_type, content,
      CASE WHEN p <> '' THEN trim(p, {SQL_WHITESPACE}) END AS prompt,
      CASE WHEN p <> '' THEN trim(r, {SQL_WHITESPACE}) END AS response,
      CASE WHEN content IS NULL THEN 'Null prompt response'
           WHEN p IS NULL OR p = '' THEN 'Failed prompt/response parse' END AS parse_error
      FROM split)
"""


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a document as an embedded-article chunk without its vector."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "lang", "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("k", "line")
    ).select(
        "lang",
        F.concat_ws("_", "lang", F.col("doc_id"), F.col("k")).alias("_id"),
        F.concat(F.lit("Title "), F.col("doc_id")).alias("title"),
        F.concat(F.lit("http://example.org/"), F.col("doc_id")).alias("url"),
    )


SQL_CHUNKS = """
chunks AS (SELECT lang, doc_id, lang || '_' || doc_id || '_' || (unnest(range(len(
    string_split(text, chr(10)))))) AS _id, 'Title ' || doc_id AS title,
    'http://example.org/' || doc_id AS url FROM documents),
stems AS (SELECT *, regexp_replace(_id, '_[^_]*$', '') AS id_stem FROM chunks)
"""
