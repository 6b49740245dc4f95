"""How the shared test tables are read as the engine's inputs, in Spark and in SQL.

The tables hold invented prose, so the clinical lexicon hardly occurs; the queries use a
lexicon of syllables that do.  Every binding reads its tables whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.labels import (
    Lexicon,
    Tier,
    lexicon_level,
    render_answer,
)
from corpusloom.functions.pii import PATTERN_RECOGNIZERS, Recognizer, name_list
from corpusloom.functions.text import WHITESPACE_CHARS
from corpusloom.operators.labeling import add_answer, label_by_lexicon
from corpusloom.operators.evaluation import prediction_table
from corpusloom.operators.requests import classify_outcomes

MAX_WORDS = ("onesen", "therin", "keit")
DEFERRED_WORDS = ("que", "hein", "ción")
LEXICON = Lexicon((Tier("max", 0.8, MAX_WORDS), Tier("deferred", 0.8, DEFERRED_WORDS)))
OTHER_MAX_WORDS = ("onesen", "ment")
OTHER_DEFERRED_WORDS = ("que", "ung")
OTHER_LEXICON = Lexicon(
    (Tier("max", 0.8, OTHER_MAX_WORDS), Tier("deferred", 0.8, OTHER_DEFERRED_WORDS))
)

PERSON_PAIR = Recognizer("PERSON", "[A-Z][a-z]{2,14} [A-Z][a-z]{2,14}", 0.85)
PERSON_WEAK = Recognizer("PERSON", "[ÉÈ][a-z]{4,14}", 0.6)
LOCATIONS = name_list("LOCATION", ["émentenen", "éoutre"], 0.85)
GROUPS = name_list("NRP", ["ónción"], 0.5)
RECOGNIZERS = (*PATTERN_RECOGNIZERS, PERSON_PAIR, PERSON_WEAK, LOCATIONS, GROUPS)
ALLOWLIST = (*K.PERSON_ALLOWLIST, "apache", "general public")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


# --- Spark bindings -----------------------------------------------------------------------


def sft_like(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as (id, instruction, raw_response, source, language)."""
    at = F.position(F.lit("\n"), F.col("text"))
    rest = F.when(at > 0, F.substring(F.col("text"), at + 1, F.length("text"))).otherwise("")
    return documents(spark, folder).select(
        F.col("doc_id").alias("id"),
        F.substring_index("text", "\n", 1).alias("instruction"),
        rest.alias("raw_response"),
        "source",
        F.col("lang").alias("language"),
    )


def sft_labelled(
    spark: SparkSession, folder: str, rows: DataFrame | None = None
) -> DataFrame:
    """``sft_like`` with level, confidence and structured answer."""
    rows = sft_like(spark, folder) if rows is None else rows
    return add_answer(label_by_lexicon(rows, lexicon=LEXICON))


def level_only(spark: SparkSession, folder: str) -> DataFrame:
    """(id, urgency_level) of ``sft_labelled``, without the cost of the answers."""
    return label_by_lexicon(sft_like(spark, folder), lexicon=LEXICON).select(
        "id", "urgency_level", "source", "language"
    )


def mixed_text(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, web pages and their text without tags as (id, source, instruction, raw_response)."""
    at = F.position(F.lit("\n"), F.col("text"))
    docs = documents(spark, folder).select(
        F.col("doc_id").alias("id"),
        F.lit("documents").alias("source"),
        F.substring_index("text", "\n", 1).alias("instruction"),
        F.when(at > 0, F.substring(F.col("text"), at + 1, F.length("text")))
        .otherwise("")
        .alias("raw_response"),
    )
    pages = table(spark, folder, "pages").select(
        F.col("page_id").alias("id"),
        F.lit("pages").alias("source"),
        F.col("url").alias("instruction"),
        F.col("html").alias("raw_response"),
    )
    page_text = pages.withColumn("source", F.lit("page_text")).withColumn(
        "raw_response", F.regexp_replace("raw_response", "[<>&]", " ")
    )
    return docs.unionByName(pages).unionByName(page_text)


def mcq_like(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as multiple-choice rows; the key cycles through valid and invalid positions."""
    key = F.col("p_size") % 7
    letters = F.array(*[F.lit(x) for x in [" A", "b", "C ", "d", "E", "A,B", ""]])
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("question"),
        F.col("p_brand").alias("answer_a"),
        F.col("p_type").alias("answer_b"),
        F.col("p_name").alias("answer_c"),
        F.col("p_size").cast("string").alias("answer_d"),
        F.lit("").alias("answer_e"),
        key.cast("bigint").alias("key_index"),
        F.get(letters, key).alias("key_letter"),
        F.when(F.col("p_retailprice") > 1000, F.concat(F.lit("Brand "), "p_brand"))
        .otherwise("")
        .alias("clinical_case"),
    )


def turns_as_qa(spark: SparkSession, folder: str) -> DataFrame:
    """User turns with the assistant turn that follows."""
    turns = table(spark, folder, "conversations")
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("Question")
    )
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("Answer")
    )
    return asked.join(answered, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), "conv_id", "turn", "Question", "Answer"
    )


def generation(level: Column) -> Column:
    """A model's text: the structured answer, or the bare text when there is no body."""
    return F.when(F.col("raw_response") == "", F.col("instruction")).otherwise(
        render_answer(level, F.col("raw_response"))
    )


def truth(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> DataFrame:
    """Documents with a human label, as (id, urgency_level, instruction, …)."""
    rows = sft_like(spark, folder) if rows is None else rows
    labels = table(spark, folder, "labels")
    level = (
        F.when(F.col("toxic") == 1, "max").when(F.col("quality") == 0, "deferred")
        .otherwise("moderate")
    )
    return rows.join(
        labels.select(F.col("doc_id").alias("id"), level.alias("urgency_level")), "id"
    )


MODELS = {"base": LEXICON, "tuned": OTHER_LEXICON}


def generations(rows: DataFrame, models: tuple[str, ...] = ("base",)) -> DataFrame:
    """(id, model, generated_response) for the rows: what each model would have written."""
    text = F.concat_ws(" ", "instruction", "raw_response")
    made = [
        F.struct(
            F.lit(name).alias("model"),
            generation(lexicon_level(text, MODELS[name])["level"]).alias("generated_response"),
        )
        for name in models
    ]
    return rows.select("id", F.inline(F.array(*made)))


def predictions(
    spark: SparkSession, folder: str, models: tuple[str, ...] = ("base", "tuned")
) -> DataFrame:
    """Predictions of the models over the rows with a human label."""
    known = truth(spark, folder)
    return prediction_table(known, generations(known, models))


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as request outcomes in two phases."""
    kind = F.col("event_type")
    raw = table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.when(F.col("user_id") % 2 == 0, "sequential").otherwise("concurrent").alias("phase"),
        F.col("value").alias("latency_ms"),
        F.when(kind == "error", F.lit(None)).when(kind == "signup", 503).otherwise(200).cast("int")
        .alias("status_code"),
        F.col("props").alias("body"),
        F.when(kind == "error", F.concat(F.lit("timeout "), "props")).alias("exception"),
        F.when(kind == "view", "max").when(kind == "click", "moderate").alias("urgency_level"),
    )
    return classify_outcomes(raw)


# --- the same in SQL ----------------------------------------------------------------------


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


WS = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def sql_strip(x: str) -> str:
    return f"trim({x}, {q(WHITESPACE_CHARS)})"


def sql_words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{WS}]+'))"


def sql_any(x: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), {q(w)})" for w in words) + ")"


def sql_level(x: str, top: tuple[str, ...] = MAX_WORDS, low: tuple[str, ...] = DEFERRED_WORDS) -> str:
    return (
        f"CASE WHEN {sql_any(x, top)} THEN 'max' WHEN {sql_any(x, low)} THEN 'deferred' "
        "ELSE 'moderate' END"
    )


def sql_answer(level: str, body: str) -> str:
    label = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in K.LEVEL_LABELS.items())
    advice = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in K.LEVEL_ADVICE.items())
    text = sql_strip(body)
    return (
        f"(CASE {level} {label} ELSE {q(K.LEVEL_LABELS['moderate'])} END || "
        f"{q(chr(10) * 2 + K.BODY_MARKER)} || "
        f"CASE WHEN length({text}) > 500 THEN substr({text}, 1, 497) || '...' ELSE {text} END || "
        f"{q(K.ADVICE_MARKER)} || "
        f"CASE {level} {advice} ELSE {q(K.LEVEL_ADVICE['moderate'])} END)"
    )


def sql_parse(x: str) -> str:
    head = f"substr({x}, 1, 150)"
    return (
        f"CASE WHEN regexp_matches({head}, '(?i)MAXIMALE|urgence[{WS}]+max(?:[^\\pL\\pN_]|$)') "
        "THEN 'max' "
        f"WHEN regexp_matches({head}, '(?i)MOD[ÉE]R[ÉE]E|urgence[{WS}]+mod') THEN 'moderate' "
        f"WHEN regexp_matches({head}, '(?i)DIFF[ÉE]R[ÉE]E|deferred') THEN 'deferred' END"
    )


def sql_format_ok(x: str) -> str:
    pieces = f"string_split({x}, '.')"
    long = f"list_filter({pieces}, lambda p: length({sql_strip('p')}) > 10)"
    return f"(({sql_parse(x)}) IS NOT NULL AND len({long}) >= 3)"


def sql_body(x: str) -> str:
    """The text between the markers of a structured answer."""
    first, second = q(K.BODY_MARKER), q(K.ADVICE_MARKER)
    after = f"substr({x}, strpos({x}, {first}) + {len(K.BODY_MARKER)})"
    return (
        f"CASE WHEN strpos({x}, {first}) = 0 THEN {x} "
        f"WHEN strpos({after}, {second}) = 0 THEN {after} "
        f"ELSE substr({after}, 1, strpos({after}, {second}) - 1) END"
    )


def sql_key(seed: int, row_id: str) -> str:
    return f"md5(concat_ws('|', '{seed}', {row_id}::VARCHAR))"


SFT_SQL = """sft AS (
  SELECT doc_id AS id, split_part(text, chr(10), 1) AS instruction,
         CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1)
              ELSE '' END AS raw_response,
         source, lang AS language
  FROM documents)"""

LEVELLED_SQL = f"""{SFT_SQL},
levelled AS (
  SELECT *, {sql_level("instruction || ' ' || raw_response")} AS urgency_level FROM sft)"""

LABELLED_SQL = f"""{LEVELLED_SQL},
labelled AS (
  SELECT *, CASE WHEN urgency_level = 'moderate' THEN 0.7::DOUBLE ELSE 0.8::DOUBLE END AS confidence,
         {sql_answer("urgency_level", "raw_response")} AS response
  FROM levelled)"""

MIXED_SQL = """mixed AS (
  SELECT doc_id AS id, 'documents' AS source, split_part(text, chr(10), 1) AS instruction,
         CASE WHEN contains(text, chr(10)) THEN substr(text, strpos(text, chr(10)) + 1)
              ELSE '' END AS raw_response
  FROM documents
  UNION ALL
  SELECT page_id, 'pages', url, html FROM pages
  UNION ALL
  SELECT page_id, 'page_text', url, regexp_replace(html, '[<>&]', ' ', 'g')
  FROM pages)"""

MCQ_SQL = """mcq AS (
  SELECT p_partkey AS id, p_name AS question, p_brand AS answer_a, p_type AS answer_b,
         p_name AS answer_c, p_size::VARCHAR AS answer_d, '' AS answer_e,
         p_size % 7 AS key_index,
         [' A', 'b', 'C ', 'd', 'E', 'A,B', ''][p_size % 7 + 1] AS key_letter,
         CASE WHEN p_retailprice > 1000 THEN 'Brand ' || p_brand ELSE '' END AS clinical_case
  FROM part)"""

QA_SQL = """qa AS (
  SELECT u.conv_id || '-' || u.turn AS id, u.conv_id, u.turn, u.text AS question,
         a.text AS answer
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

TRUTH_SQL = f"""{SFT_SQL},
truth AS (
  SELECT sft.*, CASE WHEN toxic = 1 THEN 'max' WHEN quality = 0 THEN 'deferred'
                     ELSE 'moderate' END AS urgency_level
  FROM sft JOIN labels ON labels.doc_id = sft.id)"""


def sql_generation(level: str) -> str:
    return (
        f"CASE WHEN raw_response = '' THEN instruction "
        f"ELSE {sql_answer(level, 'raw_response')} END"
    )


_TEXT = "instruction || ' ' || raw_response"
PREDICTIONS_SQL = f"""{TRUTH_SQL},
voted AS (
  SELECT *, {sql_level(_TEXT)} AS level_base,
         {sql_level(_TEXT, OTHER_MAX_WORDS, OTHER_DEFERRED_WORDS)} AS level_tuned
  FROM truth),
generated AS (
  SELECT id, urgency_level AS reference_urgency, 'base' AS model,
         {sql_generation("level_base")} AS generated_response FROM voted
  UNION ALL
  SELECT id, urgency_level, 'tuned', {sql_generation("level_tuned")} FROM voted),
preds AS (
  SELECT *, {sql_parse("generated_response")} AS predicted_urgency,
         {sql_format_ok("generated_response")} AS format_ok
  FROM generated)"""

REQUESTS_SQL = """requests AS (
  SELECT event_id AS id,
         CASE WHEN user_id % 2 = 0 THEN 'sequential' ELSE 'concurrent' END AS phase,
         value AS latency_ms,
         CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 503 ELSE 200 END AS status_code,
         CASE event_type WHEN 'error' THEN substr('timeout ' || props, 1, 120)
                         WHEN 'signup' THEN 'HTTP 503: ' || substr(props, 1, 120) END AS error,
         CASE event_type WHEN 'view' THEN 'max' WHEN 'click' THEN 'moderate' END AS urgency_level
  FROM events)"""


def sql_pattern(recognizer: Recognizer) -> str:
    return q(recognizer.pattern)


def sql_dropped(entity: str, score: float, text: str) -> str:
    """Whether a hit is a false PERSON."""
    if entity != "PERSON":
        return "FALSE"
    if score < K.PERSON_MIN_SCORE:
        return "TRUE"
    terms = "|".join(re.escape(t).replace(r"\ ", " ").replace(r"\-", "-") for t in ALLOWLIST)
    return f"regexp_matches(lower({text}), {q(terms)})"


def sql_entities(rows: str, row_id: str, column: str, filtered: bool = True) -> str:
    """A SELECT of (id, column, type, start, end, score, text) over one text column."""
    parts = []
    for r in RECOGNIZERS:
        keep = f"WHERE NOT ({sql_dropped(r.entity, r.score, 'hit')})" if filtered else ""
        parts.append(f"""
  SELECT id, {q(column)} AS "column", {q(r.entity)} AS type, (before + inside)::INTEGER AS "start",
         (before + inside + length(hit))::INTEGER AS "end", {r.score}::DOUBLE AS score, hit AS text
  FROM (
    SELECT id, hits[i] AS hit,
           coalesce(list_sum(list_transform(pieces[1:i], lambda x: length(x))), 0) AS before,
           coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) AS inside
    FROM (SELECT id, hits, pieces, unnest(range(1, len(hits) + 1)) AS i
          FROM (SELECT {row_id} AS id, regexp_extract_all({column}, {sql_pattern(r)}) AS hits,
                       string_split_regex({column}, {sql_pattern(r)}) AS pieces FROM {rows})))
  {keep}""")
    return "\n  UNION ALL".join(parts)


def sql_mask(text: str) -> str:
    """A text with every kept hit replaced by its type."""
    out = text
    for r in RECOGNIZERS:
        if r.entity == "PERSON":
            if r.score < K.PERSON_MIN_SCORE:
                continue
            drop = sql_dropped(r.entity, r.score, "hits[i]")
            out = f"""(SELECT list_aggregate(list_transform(range(1, len(pieces) + 1), lambda i:
                pieces[i] || CASE WHEN i > len(hits) THEN '' WHEN {drop} THEN hits[i]
                ELSE '<PERSON>' END), 'string_agg', '')
              FROM (SELECT string_split_regex(src, {sql_pattern(r)}) AS pieces,
                           regexp_extract_all(src, {sql_pattern(r)}) AS hits
                    FROM (SELECT {out} AS src)))"""
        else:
            out = f"regexp_replace({out}, {sql_pattern(r)}, '<{r.entity}>', 'g')"
    return out
