"""Filters, detection and the curation job."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from lingmill import fixed
from lingmill.functions import draws, messages, text
from lingmill.operators import detect, filters, stats, tokens
from lingmill.plans import curation, generated
from lingmill.sources import nesting
from suite import fixtures as fx
from suite.registry import query, table

BLOCK_WORDS = ["eau", "the t", "schl", "ción", "gpt"]


def _sql_blocked(column: str) -> str:
    return " OR ".join(f"contains(lower({column}), '{w}')" for w in BLOCK_WORDS)


SQL_WORDS = r"len(regexp_extract_all({0}, '\w+|[^\w\s]'))"


@query(f"""WITH {fx.SQL_CHATS},
users AS (SELECT c.conv_id, arg_min(c.text, c.turn) AS prompt FROM conversations c
          WHERE role = 'user' GROUP BY c.conv_id),
kept AS (SELECT language FROM chats JOIN users ON conv_id = conversation_id
         WHERE NOT ({_sql_blocked('prompt')}) AND length(trim(prompt, {fx.SQL_WHITESPACE})) > 1
           AND {SQL_WORDS.format('exchange')} < 512)
SELECT language, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM kept WHERE language IS NOT NULL GROUP BY language""")
def prompt_language_shares(spark, sf_dir):
    """Flagship: chats filtered by keyword, length and tokens, counted per language."""
    turns = table(spark, sf_dir, "conversations")
    users = turns.where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("prompt"))
    chats = fx.chats(spark, sf_dir).join(
        users.withColumnRenamed("conv_id", "conversation_id"), "conversation_id"
    )
    kept = filters.drop_short(filters.drop_blocked(chats, F.col("prompt"), BLOCK_WORDS), F.col("prompt"))
    exchange = messages.first_exchange(F.col("conversation"))
    kept = filters.drop_long(kept, tokens.token_count(exchange))
    counted = stats.add_share(stats.value_counts(kept, "language"))
    return counted.withColumn("share", F.round("share", 6))


@query(f"""WITH {fx.SQL_CHATS} SELECT conversation_id FROM chats WHERE NOT toxic""")
def moderation_filter(spark, sf_dir):
    return filters.drop_flagged(fx.chats(spark, sf_dir)).select("conversation_id")


@query(f"""WITH {fx.SQL_DETECTED}
SELECT doc_id, language FROM detected
WHERE language NOT IN ('unknown', 'Klingon', 'xx', 'zp', 'zzp')""")
def language_name_filter(spark, sf_dir):
    docs = fx.with_stub_detection(table(spark, sf_dir, "documents"))
    return filters.drop_languages(docs).select("doc_id", "language")


@query(f"""SELECT doc_id FROM documents WHERE NOT ({_sql_blocked('text')})""")
def keyword_blocklist(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return filters.drop_blocked(docs, F.col("text"), BLOCK_WORDS).select("doc_id")


@query("SELECT doc_id FROM documents WHERE NOT (" + " OR ".join(
    f"contains(lower(text), '{w}')" for w in fixed.BLOCKED_SUBSTRINGS) + ")")
def keyword_blocklist_default(spark, sf_dir):
    return filters.drop_blocked(table(spark, sf_dir, "documents"), F.col("text")).select("doc_id")


@query(f"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
words AS (SELECT doc_id, ' ' || chr(9) || chr(160) || substr(line, 1, length(line) % 3) || chr(8195) AS w
          FROM lines)
SELECT doc_id, count(*) AS n FROM words WHERE length(trim(w, {fx.SQL_WHITESPACE})) > 1 GROUP BY doc_id""")
def minimum_length(spark, sf_dir):
    """Padded line heads of 0 to 2 characters: only those longer than 1 once stripped stay."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))
    head = F.col("line").substr(F.lit(1), F.length("line") % 3)
    padded = lines.withColumn("w", F.concat(F.lit(" \t\xa0"), head, F.lit("\u2003")))
    return filters.drop_short(padded, F.col("w")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


_SQL_NAMES = "(VALUES " + ", ".join(
    "('" + name.replace("'", "''") + f"', '{code}')" for name, code in fixed.LANGUAGE_NAME_TO_CODE.items()
) + ") AS names(name, code)"

_SQL_AGREEMENT = f"""WITH {fx.SQL_DETECTED},
judged AS (SELECT doc_id, language, CASE WHEN NOT score > 0.8 THEN 'low_score' WHEN code IS NULL THEN 'unmapped'
   WHEN found = code THEN 'kept' ELSE 'mismatch' END AS agreement
   FROM detected LEFT JOIN {_SQL_NAMES} ON name = language WHERE found IS NOT NULL) """


@query(_SQL_AGREEMENT + "SELECT doc_id, agreement FROM judged")
def language_agreement(spark, sf_dir):
    docs = fx.with_stub_detection(table(spark, sf_dir, "documents"))
    found = filters.drop_undetected(docs, "lang_detect_result")
    return filters.judge_agreement(found, filters.language_names(spark)).select("doc_id", "agreement")


@query(_SQL_AGREEMENT + "SELECT doc_id, language FROM judged WHERE agreement = 'unmapped'")
def language_quarantine(spark, sf_dir):
    docs = fx.with_stub_detection(table(spark, sf_dir, "documents"))
    found = filters.drop_undetected(docs, "lang_detect_result")
    return filters.unmapped_languages(found, filters.language_names(spark)).select("doc_id", "language")


@query(f"""WITH {fx.SQL_CHATS}
SELECT conversation_id, {SQL_WORDS.format('exchange')}::INT AS n_tokens FROM chats
WHERE {SQL_WORDS.format('exchange')} < 512""")
def token_length_cut(spark, sf_dir):
    exchange = messages.first_exchange(F.col("conversation"))
    chats = fx.chats(spark, sf_dir).withColumn("n_tokens", tokens.token_count(exchange))
    return filters.drop_long(chats, F.col("n_tokens")).select("conversation_id", "n_tokens")


@query("""SELECT conv_id AS conversation_id, arg_min(text, turn) AS first_message,
  arg_min(text, turn) FILTER (role = 'user') AS first_user_message FROM conversations GROUP BY conv_id""")
def first_messages(spark, sf_dir):
    """Message 0, and the first by a user wherever it stands."""
    turns = table(spark, sf_dir, "conversations")
    heads = nesting.leading_messages(turns, "conv_id", "turn", n=1)
    users = nesting.first_by_role(turns, "conv_id", "turn", "user", name="first_user_message")
    return heads.join(users, "conv_id").select(
        F.col("conv_id").alias("conversation_id"),
        messages.first_message(F.col("conversation")).alias("first_message"), "first_user_message",
    )


@query(f"""WITH d AS (SELECT doc_id, text, {fx.sql_draw('doc_id', 'finish', 4)} AS f FROM documents)
SELECT doc_id, text AS content, 'stop' AS finish_reason FROM d WHERE f > 0""")
def finished_answers(spark, sf_dir):
    """Positional answers as structs, finished ones kept."""
    reason = F.when(draws.draw_below([F.col("doc_id")], "finish", 4) > 0, "stop").otherwise("length")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array("text", reason).alias("pair"))
    named = docs.withColumn("response", messages.positional_answer(F.col("pair")))
    return filters.keep_finished(named, "response").select("doc_id", "response.*")


@query(f"""WITH {fx.SQL_DETECTED}
SELECT doc_id FROM detected WHERE found IS NOT NULL AND
  (contains(language, 'English') OR found <> 'en' OR score < 0.8)""")
def english_leak_filter(spark, sf_dir):
    docs = fx.with_stub_detection(table(spark, sf_dir, "documents"), "lang_detected")
    found = filters.drop_undetected(docs, "lang_detected")
    return filters.drop_english_leaks(found).select("doc_id")


@query(f"""WITH {fx.SQL_DETECTED},
p AS (SELECT *, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS prompt FROM detected)
SELECT doc_id FROM p WHERE NOT coalesce(prompt IS NOT NULL AND score > 0.8 AND (
   (found = 'en' AND language NOT IN ('Old English', 'Simple English', 'English'))
   OR (found = 'ja' AND language NOT IN ('Japanese'))), false)""")
def wrong_language_filter(spark, sf_dir):
    docs = fx.with_stub_detection(table(spark, sf_dir, "documents"), "lang_detected")
    prompt = F.when(F.pmod("doc_id", F.lit(7)) != 0, F.col("text"))
    return filters.drop_wrong_language(docs.withColumn("prompt_list", prompt)).select("doc_id")


@query("""SELECT lang, count(*) AS n, sum(CASE WHEN lang = 'es' THEN 1 ELSE 0 END)::BIGINT AS n_selected
FROM documents WHERE lang NOT IN ('be-x-old', 'fr') GROUP BY lang""")
def language_code_lists(spark, sf_dir):
    """Exclusion list, then the nine selected codes counted."""
    docs = filters.drop_languages(
        table(spark, sf_dir, "documents"), "lang", [*fixed.EXCLUDED_LANGUAGE_CODES, "fr"]
    )
    selected = F.col("lang").isin(fixed.SELECTED_LANGUAGE_CODES)
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(selected).alias("n_selected")
    )


@query("SELECT doc_id, lang FROM documents WHERE lang IN (" + ", ".join(
    f"'{c}'" for c in fixed.SELECTED_LANGUAGE_CODES) + ")")
def selected_language_codes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return filters.keep_languages(docs, "lang", fixed.SELECTED_LANGUAGE_CODES)


@query(f"SELECT DISTINCT {fx.SQL_NAME} AS language FROM documents WHERE {fx.SQL_NAME} IN (" + ", ".join(
    f"'{name}'" for name in fixed.REQUESTED_LANGUAGES) + ")")
def requested_languages(spark, sf_dir):
    """The languages of the documents that prompt lists are asked for."""
    named = table(spark, sf_dir, "documents").select(fx.declared_name(F.col("lang")).alias("language"))
    return filters.requested_languages(named)


@query("""SELECT doc_id, quality, toxic FROM documents JOIN labels USING (doc_id)
WHERE quality IS NOT NULL AND toxic IS NOT NULL""")
def drop_null_rows(spark, sf_dir):
    labelled = table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return filters.drop_incomplete_rows(labelled).select("doc_id", "quality", "toxic")


@query(f"""WITH {fx.SQL_CHATS}
SELECT conversation_id, language, 'human' AS from_1, first_text AS value_1, 'gpt' AS from_2,
       second_text AS value_2 FROM chats WHERE second_text IS NOT NULL""")
def chat_training_rows(spark, sf_dir):
    chats = fx.chats(spark, sf_dir)
    answer = F.get("conversation", F.lit(1))["content"]
    answered = chats.where(answer.isNotNull()).select(
        "*",
        F.lit(None).cast("struct<lang:string,score:double>").alias("lang_detect_result"),
        F.struct(answer.alias("content"), F.lit("stop").alias("finish_reason")).alias("response"),
    )
    rows = curation.chat_training_rows(answered)
    first, second = F.col("conversations")[0], F.col("conversations")[1]
    return rows.select(
        "conversation_id",
        "language",
        first["from"].alias("from_1"),
        first["value"].alias("value_1"),
        second["from"].alias("from_2"),
        second["value"].alias("value_2"),
    )


def hash_detector():
    """A stand-in detector whose answer SQL can repeat: everything from the text's MD5."""

    def run(texts):
        out = []
        for item in texts:
            digest = hashlib.md5(item.encode()).hexdigest()
            code = ["en", "en", "fr", "de", "es"][int(digest[:8], 16) % 5]
            out.append((code, int(digest[8:10], 16) % 11 / 10))
        return out

    return run


SQL_DETECTOR = """CASE ('0x' || substr(md5({0}), 1, 8))::BIGINT % 5 WHEN 2 THEN 'fr' WHEN 3 THEN 'de'
   WHEN 4 THEN 'es' ELSE 'en' END AS found, ('0x' || substr(md5({0}), 9, 2))::BIGINT % 11 / 10 AS score"""


@query(f"""WITH {fx.SQL_CHATS},
clean AS (SELECT * FROM chats WHERE NOT toxic AND (language IS NULL OR language NOT IN
   ('unknown', 'Klingon', 'xx', 'zp', 'zzp')) AND NOT ({' OR '.join(
       f"contains(lower(first_text), '{w}')" for w in fixed.BLOCKED_SUBSTRINGS)})
   AND length(trim(first_text, {fx.SQL_WHITESPACE})) > 1),
found AS (SELECT *, {SQL_DETECTOR.format("replace(first_text, chr(10), ' ')")} FROM clean),
kept AS (SELECT conversation_id, language, {SQL_WORDS.format('exchange')}::INT AS n_tokens, e.embedding AS v
   FROM found JOIN embeddings e ON vec_id = conversation_id JOIN {_SQL_NAMES} ON name = language
   WHERE score > 0.2 AND found = code AND {SQL_WORDS.format('exchange')} < 512),
drawn AS (SELECT *, row_number() OVER (PARTITION BY language ORDER BY {fx.sql_hash('conversation_id')},
   conversation_id) AS place FROM kept),
sampled AS (SELECT * FROM drawn WHERE place <= 25000)
SELECT conversation_id, language, n_tokens FROM sampled a WHERE NOT EXISTS (SELECT 1 FROM sampled b
   WHERE b.language = a.language AND b.conversation_id < a.conversation_id AND
   list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[]) > 0.25)""")
def curated_prompts(spark, sf_dir):
    """The whole curation job with a stand-in detector and precomputed vectors."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("conversation_id"), "embedding"
    )
    chats = fx.chats(spark, sf_dir).join(vectors, "conversation_id")
    # The stand-in's scores are even, so the default cut would leave almost nothing.
    out = curation.curate_prompts(
        chats, hash_detector, vector="embedding", threshold=0.25, confidence=0.2
    )
    return out.select("conversation_id", "language", F.col("first_exchange_len_tokens").alias("n_tokens"))


@query(f"""WITH {fx.SQL_PROMPT_LISTS},
rows AS (SELECT l.doc_id, l.language, i.item, i.position FROM lists l LEFT JOIN items i USING (doc_id)),
found AS (SELECT *, {SQL_DETECTOR.format("replace(item, chr(10), ' ')")} FROM rows)
SELECT doc_id || '_' || coalesce(position, -1) AS prompt_id, language, item AS prompt_list FROM found
WHERE NOT coalesce(item IS NOT NULL AND found = 'en' AND score > 0.8
   AND language NOT IN ('Old English', 'Simple English', 'English'), false)""")
def parsed_prompts(spark, sf_dir):
    """Prompt lists to prompts with the wrong-language filter."""
    rows = generated.parse_prompts(fx.prompt_lists(spark, sf_dir), ["doc_id"], hash_detector)
    return rows.select("prompt_id", "language", "prompt_list")


@query(f"""WITH found AS (SELECT doc_id, source, {fx.SQL_NAME} AS language, text, {fx.sql_draw('doc_id', 'finish', 4)}
   AS f, {SQL_DETECTOR.format("replace(text, chr(10), ' ')")} FROM documents)
SELECT source AS human, text AS gpt FROM found WHERE f > 0 AND
  (contains(language, 'English') OR found <> 'en' OR score < 0.8)""")
def answer_training_rows(spark, sf_dir):
    """Answered prompts to training conversations."""
    reason = F.when(draws.draw_below([F.col("doc_id")], "finish", 4) > 0, "stop").otherwise("length")
    docs = table(spark, sf_dir, "documents")
    answered = docs.select(
        F.col("source").alias("prompt_list"),
        fx.declared_name(F.col("lang")).alias("language"),
        F.struct(F.col("text").alias("content"), reason.alias("finish_reason")).alias("responses"),
    )
    rows = generated.training_rows(answered, hash_detector)
    return rows.select(
        F.col("conversations")[0]["value"].alias("human"), F.col("conversations")[1]["value"].alias("gpt")
    )


def _sql_cells(rows: str, text_sql: str) -> str:
    """Hash cells of the three-character runs of each text, as ``detect`` numbers them."""
    a, b, c = detect._MIX.tolist()
    return f"""(SELECT doc_id, lang, unnest(list_transform(range(1, len(p) - 1),
   lambda i: ((p[i] * {a} + p[i + 1] * {b} + p[i + 2] * {c}) % 4294967296) // 1048576)) AS cell
   FROM (SELECT doc_id, lang, list_transform(string_split(' ' || lower({text_sql}) || ' ', ''), lambda x: unicode(x)::BIGINT) AS p
   FROM documents WHERE {rows}))"""


HELD_OUT = fx.sql_draw("doc_id", "detection", 5) + " = 0"


@query(f"""WITH learned AS (SELECT lang, cell, count(*) AS n FROM {_sql_cells(f'NOT ({HELD_OUT})', 'text')} GROUP BY ALL),
every AS (SELECT lang, cell, coalesce(n, 0) + 0.5 AS n FROM (SELECT lang, unnest(range(4096)) AS cell
   FROM (SELECT DISTINCT lang FROM learned)) LEFT JOIN learned USING (lang, cell)),
logs AS (SELECT lang, cell, ln(n / sum(n) OVER (PARTITION BY lang)) AS x FROM every),
runs AS (SELECT doc_id, lang, cell, count(*) AS n FROM {_sql_cells(HELD_OUT, "replace(text, chr(10), ' ')")} GROUP BY ALL),
totals AS (SELECT doc_id, r.lang, l.lang AS other, sum(n * x) / sqrt(sum(n)) AS total FROM runs r JOIN logs l USING (cell) GROUP BY ALL),
best AS (SELECT doc_id, lang, arg_max(other, total) AS detected, max(total) AS top FROM totals GROUP BY ALL)
SELECT doc_id, b.lang, detected, round(1 / sum(exp(total - top)), 4) AS score FROM best b JOIN totals USING (doc_id) GROUP BY ALL""")
def learned_language_detection(spark, sf_dir):
    """Detector learned from four fifths of the labelled documents, applied to the others."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = draws.draw_below([F.col("doc_id")], "detection", 5) == 0
    loader = detect.profile_detector(detect.learn_profiles(docs.where(~held_out), "text", "lang"))
    found = detect.with_detection(docs.where(held_out), F.col("text"), loader)
    return found.select(
        "doc_id", "lang", F.col("lang_detect_result.lang").alias("detected"),
        F.round("lang_detect_result.score", 4).alias("score"),
    )


@query(f"""WITH {fx.SQL_DETECTED},
c AS (SELECT language, count(*) FILTER (WHERE score > 0.8) AS n_above,
   count(*) FILTER (WHERE score < 0.8) AS n_below FROM detected GROUP BY language)
SELECT language, n_above, n_below, round(n_above / sum(n_above) OVER (), 6) AS share_above,
   round(n_below / sum(n_below) OVER (), 6) AS share_below FROM c""")
def language_audit(spark, sf_dir):
    docs = fx.with_stub_detection(table(spark, sf_dir, "documents"))
    audit = stats.audit_languages(docs, "language", F.col("lang_detect_result.score"))
    return audit.select(
        "language", "n_above", "n_below",
        F.round("share_above", 6).alias("share_above"), F.round("share_below", 6).alias("share_below"),
    )


@query("""SELECT conv_id, max(CASE WHEN place = 1 THEN role END) AS role_1,
   max(CASE WHEN place = 2 THEN role END) AS role_2, count(*) AS kept
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM conversations)
WHERE place <= 2 GROUP BY conv_id""")
def leading_messages(spark, sf_dir):
    heads = nesting.leading_messages(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    return heads.select(
        "conv_id",
        F.get("conversation", F.lit(0))["role"].alias("role_1"),
        F.get("conversation", F.lit(1))["role"].alias("role_2"),
        F.size("conversation").cast("long").alias("kept"),
    )


@query("""SELECT doc_id, replace(text, chr(10), ' ') AS flat, coalesce(CASE WHEN doc_id % 5 > 0
   THEN source END, 'nan') AS shown FROM documents""")
def flattened_text(spark, sf_dir):
    source = F.when(F.pmod("doc_id", F.lit(5)) > 0, F.col("source"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.newlines_to_spaces(F.col("text")).alias("flat"), text.as_text(source).alias("shown")
    )
