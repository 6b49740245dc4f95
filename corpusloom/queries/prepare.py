"""Queries: normalising, filtering, labelling, text parsing, deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions import labels as L
from corpusloom.functions.text import fingerprint
from corpusloom.operators import dedup, labeling, normalize, quality
from corpusloom.queries import bindings as B
from corpusloom.queries.bindings import q


def normalize_mcq_index(spark, folder):
    rows = B.mcq_like(spark, folder).withColumnRenamed("key_index", "correct_answers")
    return normalize.mcq_by_index(rows)


MCQ_INDEX_SQL = f"""
SELECT id, {q(K.PREFIX_QUESTION)} || question AS instruction,
       {q(K.PREFIX_CORRECT_ANSWER)} || answer || '.' AS raw_response,
       {q(K.SOURCE_MCQ_INDEX)} AS source, 'fr' AS language
FROM (SELECT *, CASE WHEN key_index BETWEEN 0 AND 4
        THEN [answer_a, answer_b, answer_c, answer_d, answer_e][key_index + 1] END AS answer
      FROM mcq)
WHERE question <> '' AND answer <> ''"""


def normalize_qa(spark, folder):
    return normalize.qa_pairs(B.turns_as_qa(spark, folder))


QA_PAIRS_SQL = f"""
SELECT id, question AS instruction, answer AS raw_response, {q(K.SOURCE_QA)} AS source,
       'en' AS language
FROM qa WHERE question <> '' AND answer <> ''"""


def normalize_mcq_letter(spark, folder):
    rows = B.mcq_like(spark, folder).withColumnRenamed("key_letter", "correct_answers")
    return normalize.mcq_by_letter(rows)


MCQ_LETTER_SQL = f"""
SELECT id, {q(K.PREFIX_EXAM_QUESTION)} || CASE WHEN clinical_case <> ''
         THEN clinical_case || chr(10) || question ELSE question END AS instruction,
       {q(K.PREFIX_CORRECT_ANSWER)} || answer || '.' AS raw_response,
       {q(K.SOURCE_MCQ_LETTER)} AS source, 'fr' AS language
FROM (SELECT *, CASE lower({B.sql_strip("key_letter")})
        WHEN 'a' THEN answer_a WHEN 'b' THEN answer_b WHEN 'c' THEN answer_c
        WHEN 'd' THEN answer_d WHEN 'e' THEN answer_e END AS answer
      FROM mcq)
WHERE question <> '' AND answer <> ''"""


def _open_rows(spark, folder):
    # Short answers count as missing, so both answer columns are used.
    short = F.length("Answer") < 800
    return B.turns_as_qa(spark, folder).select(
        "id",
        F.col("Question").alias("question"),
        F.when(short, "").otherwise(F.col("Answer")).alias("answer"),
        F.when(short, F.col("Answer")).alias("correct_answer"),
    )


def normalize_open_qa(spark, folder):
    return normalize.open_qa(_open_rows(spark, folder))


OPEN_QA_SQL = f"""
SELECT id, {q(K.PREFIX_EXAM_QUESTION)} || question AS instruction, answer AS raw_response,
       {q(K.SOURCE_OPEN_QA)} AS source, 'fr' AS language
FROM qa WHERE question <> '' AND answer <> ''"""


def union_sources(spark, folder):
    """All four shapes concatenated; ids become strings so that they fit one column."""
    mcq, qa = B.mcq_like(spark, folder), B.turns_as_qa(spark, folder)
    mcq = mcq.withColumn("id", F.col("id").cast("string"))
    return normalize.union_sources(
        {
            K.SOURCE_MCQ_INDEX: mcq.withColumnRenamed("key_index", "correct_answers"),
            K.SOURCE_QA: qa,
            K.SOURCE_MCQ_LETTER: mcq.withColumnRenamed("key_letter", "correct_answers"),
            K.SOURCE_OPEN_QA: _open_rows(spark, folder),
        }
    )


UNION_SQL = f"""
WITH {B.MCQ_SQL}, {B.QA_SQL},
one AS ({MCQ_INDEX_SQL}), two AS ({QA_PAIRS_SQL}), three AS ({MCQ_LETTER_SQL}),
four AS ({OPEN_QA_SQL})
SELECT id::VARCHAR AS id, instruction, raw_response, source, language FROM one
UNION ALL SELECT * FROM two
UNION ALL SELECT id::VARCHAR, instruction, raw_response, source, language FROM three
UNION ALL SELECT * FROM four"""


def quality_filter(spark, folder):
    return quality.quality_filter(B.mixed_text(spark, folder)).select(
        "id", "source", "instruction", "raw_response"
    )


SQL_REASON = f"""CASE
  WHEN {B.sql_strip("instruction")} = '' THEN 'blank_instruction'
  WHEN {B.sql_words("raw_response")} < 20 THEN 'short_response'
  WHEN regexp_matches(instruction || ' ' || raw_response, '(?i)<[^>]+>|&[a-z]+;') THEN 'html'
  WHEN regexp_matches(instruction || ' ' || raw_response, '(?i)https?://|www\\.') THEN 'url'
  END"""


def quality_reasons(spark, folder):
    rows = B.mixed_text(spark, folder).withColumn("split", F.lit("train"))
    return quality.quality_reasons(rows, ["source", "split"])


REASONS_SQL = f"""
WITH {B.MIXED_SQL}, checked AS (SELECT source, {SQL_REASON} AS reason FROM mixed)
SELECT source, 'train' AS split, count(*) AS n_rows, count(*) FILTER (reason IS NULL) AS n_valid,
       {", ".join(f"count(*) FILTER (reason = '{r}') AS n_{r}" for r in quality.REASONS)}
FROM checked GROUP BY source"""


def request_gate(spark, folder):
    turns = B.table(spark, folder, "conversations").where(F.col("role") == "user")
    return quality.request_gate(turns, "text", 50, 300).select(
        "conv_id", "turn", F.length("text").alias("n_chars"), "accepted"
    )


def lexicon_label(spark, folder):
    return labeling.label_by_lexicon(B.sft_like(spark, folder), lexicon=B.LEXICON).select(
        "id", "urgency_level", "confidence"
    )


def lexicon_label_clinical(spark, folder):
    """The built-in clinical lexicon over the same texts."""
    labelled = labeling.label_by_lexicon(B.sft_like(spark, folder))
    return labelled.groupBy("language", "urgency_level", "confidence").agg(
        F.count(F.lit(1)).alias("n")
    )


def _clinical_sql() -> str:
    def any_of(words):
        distinct = dict.fromkeys(w.lower() for w in words)
        return " OR ".join(f"contains(t, {q(w)})" for w in distinct)

    return f"""
WITH {B.SFT_SQL},
low AS (SELECT language, lower(instruction || ' ' || raw_response) AS t FROM sft),
voted AS (
  SELECT language, CASE WHEN {any_of(K.MAX_KEYWORDS)} THEN 'max'
                        WHEN {any_of(K.DEFERRED_KEYWORDS)} THEN 'deferred'
                        ELSE 'moderate' END AS urgency_level
  FROM low)
SELECT language, urgency_level,
       CASE WHEN urgency_level = 'moderate' THEN 0.7::DOUBLE ELSE 0.8::DOUBLE END AS confidence,
       count(*) AS n
FROM voted GROUP BY language, urgency_level"""


def render_response(spark, folder):
    return B.sft_labelled(spark, folder).select("id", "urgency_level", "response")


def extract_body(spark, folder):
    """Bodies of structured answers, and of raw texts, which have no markers."""
    labelled = B.sft_labelled(spark, folder)
    return labelled.select(
        "id",
        L.answer_body(F.col("response")).alias("body"),
        L.answer_body(F.col("raw_response")).alias("raw_body"),
    )


def label_encode(spark, folder):
    rows = B.level_only(spark, folder).select("id", "urgency_level")
    return labeling.encode_labels(rows, "urgency_level")


def parse_label(spark, folder):
    """Levels read back from answers that are clean, lower-cased, or preceded by text."""
    labelled = B.sft_labelled(spark, folder)
    return labelled.select(
        "id",
        L.parse_level(F.col("response")).alias("from_answer"),
        L.parse_level(F.lower("response")).alias("from_lower"),
        L.parse_level(F.concat_ws(" ", "instruction", "response")).alias("from_prefixed"),
    )


# A generation with a placeholder, replacement characters and an invented next turn.
_BEFORE = "<LOCATION> "
_AFTER = "\ufffd\ufffd forcanbeconverted\n User \n"


def clean_generation(spark, folder):
    dirty = F.concat(F.lit(_BEFORE), "response", F.lit(_AFTER), "instruction")
    rows = B.sft_labelled(spark, folder).select("id", dirty.alias("dirty"))
    clean = L.strip_artifacts(F.col("dirty"))
    return rows.select(
        "id", clean.alias("no_artifacts"), L.strip_placeholders(clean).alias("clean")
    )


def _sql_clean() -> str:
    junk = "|".join(K.JUNK_TOKENS)
    pattern = rf"(?is)(?:{junk}|\x{{FFFD}}+|\n[{B.WS}]*(?:user|assistant)[{B.WS}]*\n.*)"
    once = B.sql_strip(f"regexp_replace(dirty, {q(pattern)}, '', 'g')")
    twice = B.sql_strip(f"regexp_replace(no_artifacts, {q(K.PLACEHOLDER_PATTERN)}, '', 'g')")
    return f"""
WITH {B.LABELLED_SQL},
dirt AS (SELECT id, {q(_BEFORE)} || response || {q(_AFTER)} || instruction AS dirty FROM labelled),
half AS (SELECT id, {once} AS no_artifacts FROM dirt)
SELECT id, no_artifacts, {twice} AS clean FROM half"""


def format_compliance(spark, folder):
    """Format check of the structured answers and of the raw texts, and the export check."""
    labelled = B.sft_labelled(spark, folder)
    return labelled.select(
        "id",
        L.follows_format(F.col("response")).alias("answer_ok"),
        L.follows_format(F.col("raw_response")).alias("raw_ok"),
        F.contains(F.upper(F.col("response")), F.lit(K.EXPORT_TOKEN)).alias("has_token"),
    )


def dedup_pair(spark, folder):
    rows = B.sft_like(spark, folder)
    return dedup.dedup_pair(rows, "id", ["instruction", "raw_response"])


DEDUP_PAIR_SQL = f"""
WITH {B.SFT_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY md5(instruction || raw_response) ORDER BY id) AS r
  FROM sft)
SELECT id, instruction, raw_response, source, language FROM ranked WHERE r = 1"""


def dedup_key(spark, folder):
    return dedup.dedup_key(B.sft_like(spark, folder), "instruction")


def dedup_report(spark, folder):
    rows = B.sft_like(spark, folder)
    return dedup.dedup_report(
        rows,
        {
            "pair": fingerprint(F.col("instruction"), F.col("raw_response")),
            "instruction": fingerprint(F.col("instruction")),
        },
    )


QUERIES = {
    "normalize_mcq_index": (normalize_mcq_index, f"WITH {B.MCQ_SQL} {MCQ_INDEX_SQL}"),
    "normalize_qa": (normalize_qa, f"WITH {B.QA_SQL} {QA_PAIRS_SQL}"),
    "normalize_mcq_letter": (normalize_mcq_letter, f"WITH {B.MCQ_SQL} {MCQ_LETTER_SQL}"),
    "normalize_open_qa": (normalize_open_qa, f"WITH {B.QA_SQL} {OPEN_QA_SQL}"),
    "union_sources": (union_sources, UNION_SQL),
    "quality_filter": (
        quality_filter,
        f"""WITH {B.MIXED_SQL}
        SELECT id, source, instruction, raw_response FROM mixed WHERE ({SQL_REASON}) IS NULL""",
    ),
    "quality_reasons": (quality_reasons, REASONS_SQL),
    "request_gate": (
        request_gate,
        """SELECT conv_id, turn, length(text)::INTEGER AS n_chars,
                  length(text) BETWEEN 50 AND 300 AS accepted
           FROM conversations WHERE role = 'user'""",
    ),
    "lexicon_label": (
        lexicon_label,
        f"WITH {B.LABELLED_SQL} SELECT id, urgency_level, confidence FROM labelled",
    ),
    "lexicon_label_clinical": (lexicon_label_clinical, _clinical_sql()),
    "render_response": (
        render_response,
        f"WITH {B.LABELLED_SQL} SELECT id, urgency_level, response FROM labelled",
    ),
    "extract_body": (
        extract_body,
        f"""WITH {B.LABELLED_SQL} SELECT id, {B.sql_body("response")} AS body,
            {B.sql_body("raw_response")} AS raw_body FROM labelled""",
    ),
    "label_encode": (
        label_encode,
        f"""WITH {B.LEVELLED_SQL} SELECT id, urgency_level,
            (dense_rank() OVER (ORDER BY urgency_level) - 1)::INTEGER AS label_id FROM levelled""",
    ),
    "parse_label": (
        parse_label,
        f"""WITH {B.LABELLED_SQL} SELECT id, {B.sql_parse("response")} AS from_answer,
            {B.sql_parse("lower(response)")} AS from_lower,
            {B.sql_parse("(instruction || ' ' || response)")} AS from_prefixed FROM labelled""",
    ),
    "clean_generation": (clean_generation, _sql_clean()),
    "format_compliance": (
        format_compliance,
        f"""WITH {B.LABELLED_SQL} SELECT id, {B.sql_format_ok("response")} AS answer_ok,
            {B.sql_format_ok("raw_response")} AS raw_ok,
            contains(upper(response), 'URGENCE') AS has_token FROM labelled""",
    ),
    "dedup_pair": (dedup_pair, DEDUP_PAIR_SQL),
    "dedup_key": (
        dedup_key,
        f"""WITH {B.SFT_SQL}, ranked AS (
              SELECT *, row_number() OVER (PARTITION BY md5(instruction) ORDER BY id) AS r FROM sft)
            SELECT id, instruction, raw_response, source, language FROM ranked WHERE r = 1""",
    ),
    "dedup_report": (
        dedup_report,
        f"""WITH {B.SFT_SQL}, k AS (
              SELECT 'pair' AS key, md5(instruction || raw_response) AS h FROM sft
              UNION ALL SELECT 'instruction', md5(instruction) FROM sft)
            SELECT key, count(*) AS n_before, count(DISTINCT h) AS n_after,
                   count(*) - count(DISTINCT h) AS n_removed FROM k GROUP BY key""",
    ),
}
