"""Lists, marked replies, ids, trimming and token counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lingmill.functions import messages, text
from lingmill.operators import inference, prompt_lists, tokens
from suite import fixtures as fx
from suite.registry import query, table


@query(f"""WITH {fx.SQL_PROMPT_LISTS} SELECT l.doc_id, l.language, i.position, i.item AS prompt_list
FROM lists l LEFT JOIN items i USING (doc_id)""")
def numbered_list_items(spark, sf_dir):
    """One row per list item; lists without items give a null row."""
    rows = prompt_lists.explode_prompt_lists(
        fx.prompt_lists(spark, sf_dir), ["doc_id", "language"], position="position"
    )
    return rows.withColumn("position", F.col("position").cast("long"))


@query("""SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)),
  lambda x, i: i || '. ' || x), chr(10)) AS rendered FROM documents""")
def rendered_lists(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.render_numbered(F.split("text", "\n", -1)).alias("rendered")
    )


@query("""SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, n AS n_items FROM documents
JOIN (SELECT doc_id, count(*) FILTER (WHERE trim(line, ' .-。') <> '' AND
   length(trim(trim(line, ' .-。'), chr(9) || chr(13) || ' ')) > 0) AS n
   FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id)
USING (doc_id)""")
def list_round_trip(spark, sf_dir):
    """Rendering lines and parsing them again finds every line that is not blank."""
    lines = F.split("text", "\n", -1)
    items = text.numbered_items(text.render_numbered(lines))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.size(items).cast("long").alias("n_items"),
    )


@query("""WITH u AS (SELECT url, CASE WHEN page_id % 3 = 0 THEN page_id::VARCHAR ELSE 'p_' || page_id || '_'
  || (page_id % 4) END AS _id FROM pages)
SELECT _id, CASE WHEN contains(_id, '_') THEN regexp_replace(_id, '_[^_]*$', '') ELSE '' END AS stem,
  string_split(_id, '_')[-1] AS tail FROM u""")
def chunk_id_parts(spark, sf_dir):
    page = F.col("page_id").cast("string")
    chunk = F.when(F.pmod("page_id", F.lit(3)) == 0, page).otherwise(
        F.concat(F.lit("p_"), page, F.lit("_"), F.pmod("page_id", F.lit(4)).cast("string"))
    )
    ids = table(spark, sf_dir, "pages").select(chunk.alias("_id"))
    return ids.select(
        "_id", text.id_stem(F.col("_id")).alias("stem"), text.id_tail(F.col("_id")).alias("tail")
    )


@query(f"WITH {fx.SQL_REPLIES} SELECT doc_id, prompt, response FROM parsed")
def marked_replies(spark, sf_dir):
    content = F.col("generated_prompt_response.content")
    return fx.marked_replies(spark, sf_dir).select(
        "doc_id",
        text.marked_prompt(content).alias("prompt"),
        text.marked_response(content).alias("response"),
    )


@query(f"WITH {fx.SQL_REPLIES} SELECT doc_id, parse_error FROM parsed")
def reply_parse_errors(spark, sf_dir):
    return inference.parse_generated(fx.marked_replies(spark, sf_dir)).select("doc_id", "parse_error")


@query(f"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
p AS (SELECT doc_id, chr(8195) || ' .-' || line || '。. ' || chr(13) AS line FROM lines)
SELECT doc_id, string_agg(DISTINCT md5(trim(line, {fx.SQL_WHITESPACE}) || '|' || trim(line, ' .-。')), ''
  ORDER BY md5(trim(line, {fx.SQL_WHITESPACE}) || '|' || trim(line, ' .-。'))) AS trimmed
FROM p GROUP BY doc_id""")
def trimmed_lines(spark, sf_dir):
    """Unicode strip and character-set trim of every padded line, as digests."""
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.transform(F.split("text", "\n", -1), lambda x: F.concat(F.lit("\u2003 .-"), x, F.lit("。. \r"))).alias("lines")
    )
    both = F.transform(
        "lines",
        lambda x: F.md5(F.concat(text.strip(x), F.lit("|"), F.btrim(x, F.lit(text.LIST_ITEM_TRIM)))),
    )
    return lines.select("doc_id", F.array_join(F.array_sort(F.array_distinct(both)), "").alias("trimmed"))


@query(r"""SELECT doc_id, len(regexp_extract_all(text, '\w+|[^\w\s]'))::INT AS n_tokens FROM documents""")
def token_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tokens.token_count(F.col("text")).alias("n_tokens"))


@query(r"""WITH t AS (SELECT doc_id, text, regexp_split_to_array(text, '\s+') AS words FROM documents)
SELECT doc_id, CASE WHEN len(words) <= 4096 THEN text ELSE array_to_string(words[1:4096], ' ') END AS cut,
  CASE WHEN len(words) <= 20 THEN text ELSE array_to_string(words[1:20], ' ') END AS short_cut FROM t""")
def truncated_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", tokens.truncate(F.col("text")).alias("cut"), tokens.truncate(F.col("text"), 20).alias("short_cut")
    )


@query(r"""SELECT doc_id, least(4095, (2.0 * (len(regexp_extract_all(source, '\w+|[^\w\s]'))
  + len(regexp_extract_all(text, '\w+|[^\w\s]'))))::INT) AS max_tokens,
  '<INPUT>' || chr(10) || source || chr(10) || chr(10) || '<OUTPUT>' || chr(10) || text AS prompt FROM documents""")
def revision_requests(spark, sf_dir):
    pairs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("inputs"), F.col("text").alias("targets"), F.col("lang").alias("language")
    )
    return inference.revision_requests(pairs).select("doc_id", "max_tokens", "prompt")


@query("""WITH m AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS old, text, doc_id % 2 AS had
  FROM documents)
SELECT doc_id, CASE WHEN had = 1 AND old IS NOT NULL THEN old ELSE text END AS a,
  CASE WHEN doc_id % 5 > 0 THEN 'kept' END AS b FROM m""")
def answer_map_updates(spark, sf_dir):
    """A new answer fills a missing or failed one and never replaces a good one."""
    def answer(content):
        return F.struct(content.alias("content"), F.lit("stop").alias("finish_reason"))

    other = F.create_map(F.lit("b"), answer(F.lit("kept")))
    old = F.create_map(F.lit("a"), answer(F.when(F.pmod("doc_id", F.lit(3)) > 0, F.col("source"))))
    with_other = F.when(F.pmod("doc_id", F.lit(5)) > 0, other)
    before = F.when(F.pmod("doc_id", F.lit(2)) == 1, F.when(with_other.isNull(), old).otherwise(F.map_concat(old, other))).otherwise(with_other)
    docs = table(spark, sf_dir, "documents").withColumn("llm_responses", before)
    after = messages.put_answer(F.col("llm_responses"), "a", F.col("text"), F.lit("stop"))
    return docs.select(
        "doc_id", F.element_at(after, "a")["content"].alias("a"), F.element_at(after, "b")["content"].alias("b")
    )
