"""Queries: statistics, training formats, evaluation, request logs, catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.chat import prompt_text
from corpusloom.functions.labels import lexicon_level, render_answer
from corpusloom.operators import chat, evaluation, pairs, quality, requests, sampling, stats
from corpusloom.plans.build import build_training_table
from corpusloom.session import new_folder
from corpusloom.queries import bindings as B
from corpusloom.queries import select as S
from corpusloom.queries.bindings import q
from corpusloom.sources.catalog import TableEntry, catalog_overview as overview, register_views
from corpusloom.sources.stages import dataset_card as card
from corpusloom.streaming.triage import accepted, finish_responses, triage

SYSTEM = K.system_prompt()


# --- statistics -----------------------------------------------------------------------------


def _split_text(spark, folder):
    """Documents with a random split; ids and texts only."""
    return sampling.random_split(B.sft_like(spark, folder))


def split_stats(spark, folder):
    return stats.split_stats(_split_text(spark, folder), ["instruction", "raw_response"])


def split_dist(spark, folder):
    rows = sampling.stratified_split(B.level_only(spark, folder))
    return stats.split_dist(rows, ["urgency_level", "source", "language"])


DIST_SQL = f"""{S.LEVEL_SPLIT_SQL},
listed AS (
  SELECT split, 'urgency_level' AS column_name, urgency_level AS value FROM splitted
  UNION ALL SELECT split, 'source', source FROM splitted
  UNION ALL SELECT split, 'language', language FROM splitted)
SELECT split, column_name, value, count(*) AS n,
       count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY split, column_name) * 100 AS pct
FROM listed GROUP BY split, column_name, value"""


def value_counts(spark, folder):
    return stats.value_counts(B.level_only(spark, folder), ["urgency_level", "source", "language"])


VALUE_COUNTS_SQL = f"""
WITH {B.LEVELLED_SQL}, listed AS (
  SELECT 'urgency_level' AS column_name, urgency_level AS value FROM levelled
  UNION ALL SELECT 'source', source FROM levelled
  UNION ALL SELECT 'language', language FROM levelled)
SELECT column_name, value, count(*) AS n FROM listed GROUP BY ALL"""


def length_profile(spark, folder):
    """Lengths of the whole rendered conversation, per language."""
    rows = B.sft_like(spark, folder)
    text = F.concat(prompt_text(F.col("instruction"), SYSTEM), "raw_response")
    return stats.length_profile(
        stats.with_token_length(rows, text), limit=512, by=["language"]
    )


_PROMPT = q(
    f"{K.TURN_START}system\n{SYSTEM}{K.TURN_END}\n{K.TURN_START}user\n"
)
_ANSWER = q(f"{K.TURN_END}\n{K.TURN_START}assistant\n")
_END = q(f"{K.TURN_END}\n")

LENGTH_SQL = f"""
WITH {B.SFT_SQL}, lengths AS (
  SELECT language, {B.sql_words(f"({_PROMPT} || instruction || {_ANSWER} || raw_response)")} AS n
  FROM sft),
profile AS (
  SELECT language, {", ".join(f"floor(quantile_cont(n, {p / 100}))::BIGINT AS p{p}"
                              for p in stats.PERCENTILES)},
         max(n) AS max_len, sum(n)::DOUBLE / count(*) AS mean_len,
         count(*) FILTER (n > 512) AS n_truncated,
         round((count(*) FILTER (n > 512))::DOUBLE / count(*) * 100, 2) AS pct_truncated
  FROM lengths GROUP BY language)
SELECT *, CASE WHEN p95 <= 512 THEN 512 WHEN p95 <= 1024 THEN 1024 ELSE 2048 END AS advised_length
FROM profile"""


def dataset_card(spark, folder):
    rows = sampling.random_split(B.sft_like(spark, folder).select("id", "language", "source"))
    return card(rows, extra={"licence": "mit", "task": "text-generation"})


# --- training formats ---------------------------------------------------------------------------


def chat_format(spark, folder):
    return chat.chat_format(B.sft_labelled(spark, folder))


def chat_format_pairs(spark, folder):
    return chat.chat_format_pairs(pairs.synthetic_pairs(B.sft_labelled(spark, folder)))


def chat_format_legacy(spark, folder):
    return chat.chat_format_legacy(B.sft_labelled(spark, folder))


def chat_format_pairs_legacy(spark, folder):
    return chat.chat_format_pairs_legacy(pairs.synthetic_pairs(B.sft_labelled(spark, folder)))


def inference_prompt(spark, folder):
    return chat.inference_prompts(B.turns_as_qa(spark, folder), text="Question")


def chat_render_conversation(spark, folder):
    return chat.render_conversations(B.table(spark, folder, "conversations"))


def chat_render_turns(spark, folder):
    return chat.render_turns(B.table(spark, folder, "conversations"))


_OLD_PROMPT = q(f"{K.TURN_START}system\n{SYSTEM}\n{K.TURN_END}\n{K.TURN_START}user\n")
_OLD_ANSWER = q(f"\n{K.TURN_END}\n{K.TURN_START}assistant\n")
_OLD_END = q(K.TURN_END)


# --- evaluation ---------------------------------------------------------------------------------------


def prediction_table(spark, folder):
    return B.predictions(spark, folder).select(
        "id", "model", "reference_urgency", "predicted_urgency", "format_ok"
    )


def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(B.predictions(spark, folder), ["model"])


CONFUSION_SQL = f"""
WITH {B.PREDICTIONS_SQL}, names AS (SELECT unnest(['max', 'moderate', 'deferred']) AS name)
SELECT m.model, r.name AS reference, p.name AS predicted, count(preds.id) AS n
FROM (SELECT DISTINCT model FROM preds) m JOIN names r ON TRUE JOIN names p ON TRUE
LEFT JOIN preds ON preds.model = m.model AND reference_urgency = r.name
               AND predicted_urgency = p.name
GROUP BY ALL"""

PER_CLASS_CTE = f"""{B.PREDICTIONS_SQL},
names AS (SELECT unnest(['max', 'moderate', 'deferred']) AS name),
counted AS (
  SELECT model, name,
         (count(*) FILTER (reference_urgency = name AND predicted_urgency = name))::DOUBLE AS hit,
         (count(*) FILTER (reference_urgency = name AND predicted_urgency IS NOT NULL))::DOUBLE AS act,
         (count(*) FILTER (predicted_urgency = name))::DOUBLE AS pre
  FROM preds JOIN names ON TRUE GROUP BY ALL),
classes AS (
  SELECT model, name, act,
         CASE WHEN pre > 0 THEN hit / pre ELSE 0 END AS precision,
         CASE WHEN act > 0 THEN hit / act ELSE 0 END AS recall,
         CASE WHEN act + pre > 0 THEN 2 * hit / (act + pre) ELSE 0 END AS f1,
         CASE WHEN 4 * act + pre > 0 THEN 5 * hit / (4 * act + pre) ELSE 0 END AS f2
  FROM counted)"""
METRICS_CTE = f"""{PER_CLASS_CTE},
overall AS (
  SELECT model, count(*) AS n_evaluated,
         count(*) FILTER (predicted_urgency IS NULL) AS n_unparseable,
         round((count(*) FILTER (predicted_urgency = reference_urgency))::DOUBLE
               / greatest(count(predicted_urgency), 1), 4) AS accuracy,
         round((count(*) FILTER (format_ok))::DOUBLE / count(*), 4) AS format_compliance,
         round(sum({B.sql_words("generated_response")})::DOUBLE / count(*), 1) AS response_length_mean
  FROM preds GROUP BY model),
averaged AS (
  SELECT model, round(sum(f1) / 3, 4) AS f1_macro, round(sum(recall) / 3, 4) AS recall_macro,
         round(max(recall) FILTER (name = 'max'), 4) AS recall_max,
         round(sum(f2) / 3, 4) AS f2_macro
  FROM classes GROUP BY model),
metrics AS (
  SELECT model, accuracy, f1_macro, recall_macro, recall_max, f2_macro, format_compliance,
         response_length_mean, n_unparseable, n_evaluated
  FROM overall JOIN averaged USING (model))"""


def eval_metrics(spark, folder):
    return evaluation.evaluate(B.predictions(spark, folder), ["model"])


def eval_per_class(spark, folder):
    return evaluation.per_class_metrics(B.predictions(spark, folder), ["model"])


def eval_summary(spark, folder):
    return evaluation.evaluate(B.predictions(spark, folder), ["model"]).select(
        "model", "format_compliance", "response_length_mean", "n_unparseable", "n_evaluated"
    )


def threshold_check(spark, folder):
    metrics = evaluation.evaluate(B.predictions(spark, folder), ["model"])
    return evaluation.threshold_check(metrics, by=["model"])


THRESHOLD_SQL = f"""
WITH {METRICS_CTE}, listed AS (
  {" UNION ALL ".join(
      f"SELECT model, '{name}' AS criterion, {name} AS value, {limit}::DOUBLE AS threshold FROM metrics"
      for name, limit in K.METRIC_THRESHOLDS.items())})
SELECT *, value >= threshold AS passed FROM listed"""


def thresholds_passed(spark, folder):
    return evaluation.count_passed(threshold_check(spark, folder), ["model"])


def eval_compare(spark, folder):
    metrics = evaluation.evaluate(B.predictions(spark, folder), ["model"])
    return evaluation.compare_models(metrics, "base", "tuned")


def _compare_sql() -> str:
    parts = []
    for name in evaluation.METRICS:
        limit = K.METRIC_THRESHOLDS.get(name)
        threshold = f"{limit}::DOUBLE" if limit is not None else "NULL::DOUBLE"
        parts.append(
            f"SELECT '{name}' AS metric, max({name}) FILTER (model = 'base') AS base, "
            f"max({name}) FILTER (model = 'tuned') AS candidate, {threshold} AS threshold FROM metrics"
        )
    return f"""WITH {METRICS_CTE}, listed AS ({" UNION ALL ".join(parts)})
SELECT metric, base, candidate, round(candidate - base, 4) AS delta, threshold,
       base >= threshold AS base_passed, candidate >= threshold AS candidate_passed FROM listed"""


def eval_verdict(spark, folder):
    metrics = evaluation.evaluate(B.predictions(spark, folder), ["model"])
    return evaluation.model_verdict(metrics, "base", "tuned")


VERDICT_SQL = f"""
WITH {METRICS_CTE}, sides AS (
  SELECT max(accuracy) FILTER (model = 'base') AS base_accuracy,
         max(accuracy) FILTER (model = 'tuned') AS candidate_accuracy FROM metrics)
SELECT *, CASE WHEN base_accuracy >= 0.7 THEN 'ready' WHEN base_accuracy >= 0.6 THEN 'acceptable'
               ELSE 'insufficient' END AS base_verdict,
       CASE WHEN candidate_accuracy::DOUBLE - base_accuracy >= -0.03 AND candidate_accuracy >= 0.65
              THEN 'validated'
            WHEN candidate_accuracy::DOUBLE - base_accuracy < -0.05 THEN 'regression'
            ELSE 'mixed' END AS candidate_verdict
FROM sides"""


def paired_responses(spark, folder, n=20):
    labelled = B.sft_labelled(spark, folder)
    pair_rows = pairs.synthetic_pairs(labelled).select("id", "prompt", "chosen")
    made = B.generations(labelled, ("base", "tuned"))
    return evaluation.paired_responses(
        pair_rows, made.where(F.col("model") == "base"), made.where(F.col("model") == "tuned"), n=n
    )


def paired_responses_150(spark, folder):
    return paired_responses(spark, folder, 150)


PAIRED_SQL = f"""
WITH {B.LABELLED_SQL}, voted AS (
  SELECT *, {B.sql_level("instruction || ' ' || raw_response")} AS level_base,
         {B.sql_level("instruction || ' ' || raw_response", B.OTHER_MAX_WORDS, B.OTHER_DEFERRED_WORDS)}
           AS level_tuned, row_number() OVER (ORDER BY {S.KEY}) AS r
  FROM labelled)
SELECT id, instruction AS prompt, {B.sql_generation("level_base")} AS first_response,
       {B.sql_generation("level_tuned")} AS second_response, response AS chosen_reference
FROM voted WHERE r <= 20"""


# --- request logs ---------------------------------------------------------------------------------------


def request_outcomes(spark, folder):
    return B.request_log(spark, folder)


def latency_stats(spark, folder):
    return requests.latency_stats(B.request_log(spark, folder))


LATENCY_SQL = f"""
WITH {B.REQUESTS_SQL},
base AS (
  SELECT phase, count(*) AS n_total, count(error) AS n_errors, count(*) - count(error) AS n_ok,
         round(min(latency_ms) FILTER (error IS NULL), 1) AS min_ms,
         round(max(latency_ms) FILTER (error IS NULL), 1) AS max_ms,
         round(avg(latency_ms) FILTER (error IS NULL), 1) AS mean_ms,
         round(quantile_cont(latency_ms, 0.5) FILTER (error IS NULL), 1) AS median_ms
  FROM requests GROUP BY phase),
ranked AS (
  SELECT phase, latency_ms, row_number() OVER (PARTITION BY phase ORDER BY latency_ms) - 1 AS r,
         count(*) OVER (PARTITION BY phase) AS n
  FROM requests WHERE error IS NULL),
picked AS (
  SELECT phase,
         round(max(latency_ms) FILTER (r = least(floor(0.95::DOUBLE * n)::BIGINT, n - 1)), 1) AS p95_ms,
         round(max(latency_ms) FILTER (r = least(floor(0.99::DOUBLE * n)::BIGINT, n - 1)), 1) AS p99_ms
  FROM ranked GROUP BY phase)
SELECT * FROM base LEFT JOIN picked USING (phase)"""


def error_rate(spark, folder):
    return requests.error_rate(B.request_log(spark, folder))


def sla_gate(spark, folder):
    return requests.sla_gate(requests.latency_stats(B.request_log(spark, folder)), limit_ms=80.0)


def level_counts(spark, folder):
    return requests.level_counts(B.request_log(spark, folder), ["phase"])


def stream_triage(spark, folder):
    """The post-processing of the streaming job over the stored turns."""
    asked = B.turns_as_qa(spark, folder).select(
        "conv_id", "turn", F.col("Question").alias("symptoms"), F.col("Answer").alias("reply")
    )
    level = lexicon_level(F.col("reply"), B.LEXICON)["level"]
    made = F.when(F.length("reply") < 400, F.concat(F.lit("<PERSON> "), "reply")).otherwise(
        F.concat(F.lit("<PERSON> "), render_answer(level, F.col("reply")))
    )
    scored = accepted(asked).withColumn("generated_response", made).drop("reply")
    return finish_responses(scored, "model")


def triage_scored(spark, folder):
    """The whole triage path, with a scorer that answers with the size of its prompt."""

    def factory():
        return lambda prompts: [f"<PERSON> {len(p)}" for p in prompts]

    asked = B.turns_as_qa(spark, folder).select("conv_id", "turn", F.col("Question").alias("symptoms"))
    return triage(asked, factory, "model").drop("latency_ms", "score_error", "generated_response")


_REPLY = f"""CASE WHEN length(answer) < 400 THEN '<PERSON> ' || answer
              ELSE '<PERSON> ' || {B.sql_answer(f"({B.sql_level('answer')})", "answer")} END"""
_SIZE = f"'<PERSON> ' || length({_PROMPT} || question || {_ANSWER} || {q(K.EMPTY_THINKING)})"


def _triage_sql(made: str = _REPLY) -> str:
    labels = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in K.LEVEL_LABELS.items())
    return f"""
WITH {B.QA_SQL}, made AS (
  SELECT conv_id, turn, question AS symptoms, {made} AS made
  FROM qa WHERE length(question) BETWEEN 10 AND 2000),
clean AS (SELECT conv_id, turn, symptoms,
                 {B.sql_strip(f"regexp_replace(made, {q(K.PLACEHOLDER_PATTERN)}, '', 'g')")} AS raw_response
          FROM made),
levelled AS (SELECT *, {B.sql_parse("raw_response")} AS urgency_level FROM clean)
SELECT *, CASE urgency_level {labels} ELSE {q(K.UNKNOWN_LEVEL_LABEL)} END AS urgency_label,
       {q(K.DISCLAIMER)} AS disclaimer, 'model' AS model
FROM levelled"""


# --- catalog -----------------------------------------------------------------------------------------

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _views(spark, folder):
    catalog = {name: TableEntry({"train": f"{folder}/{name}.parquet"}) for name in TABLES}
    return register_views(spark, catalog)[0]


def catalog_overview(spark, folder):
    return overview(spark, _views(spark, folder))


def _overview_sql() -> str:
    kinds = (
        "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
        "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'FLOAT[]' THEN 'array<float>' "
        "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' "
        "ELSE lower(column_type) END"
    )
    parts = []
    for name in TABLES:
        parts.append(f"SELECT '{name}' AS table_name, 'rows' AS kind, '*' AS key, count(*) AS n FROM {name}")
        parts.append(
            f"SELECT '{name}', 'column', column_name || ':' || {kinds}, row_number() OVER () "
            f"FROM (DESCRIBE {name})"
        )
    parts.append("SELECT 'documents', 'source', source, count(*) FROM documents GROUP BY source")
    return " UNION ALL ".join(parts)


def sql_group_count(spark, folder):
    _views(spark, folder)
    return spark.sql("SELECT source, COUNT(*) AS n FROM documents GROUP BY source")


def sql_filter_limit(spark, folder):
    _views(spark, folder)
    return spark.sql(
        "SELECT doc_id, source, text FROM documents WHERE lang = 'fr' ORDER BY doc_id LIMIT 10"
    )


# --- the whole preparation ---------------------------------------------------------------------------


def flagship(spark, folder):
    """Quality filter, lexicon label and class counts in one pass over the documents."""
    rows = quality.quality_filter(B.sft_like(spark, folder))
    level = lexicon_level(F.concat_ws(" ", "instruction", "raw_response"), B.LEXICON)["level"]
    return (
        rows.select("language", level.alias("urgency_level"))
        .groupBy("language", "urgency_level")
        .agg(F.count(F.lit(1)).alias("n"))
    )


_VALID = f"""({B.sql_strip("instruction")} <> '' AND {B.sql_words("raw_response")} >= 20
  AND NOT regexp_matches(instruction || ' ' || raw_response, '(?i)<[^>]+>|&[a-z]+;')
  AND NOT regexp_matches(instruction || ' ' || raw_response, '(?i)https?://|www\\.'))"""


def build_dataset(spark, folder):
    """Normalised rows to final splits: filter, label, dedup, balance, mask, dedup, split."""
    final = build_training_table(
        B.sft_like(spark, folder),
        lexicon=B.LEXICON, target=900, recognizers=B.RECOGNIZERS, allowlist=B.ALLOWLIST, root=new_folder(spark),
    )
    return final.select("id", *K.SFT_COLUMNS, "split")


def _build_sql() -> str:
    final = S._sql_language_split("unique_rows", "f").replace("language", "urgency_level")
    return f"""
WITH {B.LABELLED_SQL},
good AS (SELECT * FROM labelled WHERE {_VALID}),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (
             PARTITION BY md5(instruction || response) ORDER BY id) AS place FROM good) WHERE place = 1),
balanced AS (SELECT * FROM (SELECT *, row_number() OVER (
             PARTITION BY urgency_level ORDER BY {S.KEY}) AS rk FROM firsts) WHERE rk <= 300),
masked AS (SELECT id, {B.sql_mask("balanced.instruction")} AS instruction,
                  {B.sql_mask("balanced.response")} AS response, source, language, urgency_level,
                  confidence FROM balanced),
unique_rows AS (SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (
             PARTITION BY md5(instruction) ORDER BY id) AS place FROM masked) WHERE place = 1),
{final.strip()}
SELECT id, instruction, response, source, language, urgency_level, confidence, split FROM f_splitted"""


QUERIES = {
    "flagship": (
        flagship,
        f"""WITH {B.LEVELLED_SQL} SELECT language, urgency_level, count(*) AS n FROM levelled
            WHERE {_VALID} GROUP BY ALL""",
    ),
    "split_stats": (
        split_stats,
        f"""{S.RANDOM_SPLIT_SQL} SELECT split, count(*) AS n_rows,
              sum({B.sql_words("instruction")})::DOUBLE / count(*) AS avg_instruction_words,
              sum({B.sql_words("raw_response")})::DOUBLE / count(*) AS avg_raw_response_words
            FROM splitted GROUP BY split""",
    ),
    "split_dist": (split_dist, DIST_SQL),
    "value_counts": (value_counts, VALUE_COUNTS_SQL),
    "length_profile": (length_profile, LENGTH_SQL),
    "dataset_card": (
        dataset_card,
        f"""{S.RANDOM_SPLIT_SQL} SELECT split, count(*) AS n_rows,
              string_agg(DISTINCT language, ',' ORDER BY language) AS languages,
              string_agg(DISTINCT source, ',' ORDER BY source) AS sources,
              'mit' AS licence, 'text-generation' AS task
            FROM splitted GROUP BY split""",
    ),
    "chat_format": (
        chat_format,
        f"""WITH {B.LABELLED_SQL} SELECT id, {_PROMPT} || instruction || {_ANSWER} AS prompt,
              response || {_END} AS completion,
              {_PROMPT} || instruction || {_ANSWER} || response || {_END} AS text, urgency_level
            FROM labelled""",
    ),
    "chat_format_pairs": (
        chat_format_pairs,
        f"""WITH {B.LABELLED_SQL}, made AS ({S.SYNTHETIC_SQL.format(rows="labelled")})
            SELECT id, {_PROMPT} || prompt || {_ANSWER} AS prompt, chosen || {_END} AS chosen,
                   rejected || {_END} AS rejected FROM made""",
    ),
    "chat_format_legacy": (
        chat_format_legacy,
        f"""WITH {B.LABELLED_SQL}
            SELECT id, {_OLD_PROMPT} || instruction || {_OLD_ANSWER} || response || {_OLD_END} AS text
            FROM labelled""",
    ),
    "chat_format_pairs_legacy": (
        chat_format_pairs_legacy,
        f"""WITH {B.LABELLED_SQL}, made AS ({S.SYNTHETIC_SQL.format(rows="labelled")})
            SELECT id, {_OLD_PROMPT} || prompt || {_OLD_ANSWER} AS prompt,
                   chosen || {_OLD_END} AS chosen, rejected || {_OLD_END} AS rejected FROM made""",
    ),
    "inference_prompt": (
        inference_prompt,
        f"""WITH {B.QA_SQL} SELECT id, {_PROMPT} || question || {_ANSWER}
              || {q(K.EMPTY_THINKING)} AS prompt FROM qa""",
    ),
    "chat_render_conversation": (
        chat_render_conversation,
        f"""SELECT conv_id, count(*) AS n_turns,
              string_agg({q(K.TURN_START)} || role || chr(10) || text || {_END}, ''
                         ORDER BY turn) AS text
            FROM conversations GROUP BY conv_id""",
    ),
    "chat_render_turns": (
        chat_render_turns,
        f"""SELECT conv_id, turn, {q(K.TURN_START)} || role || chr(10) || text || {_END} AS line
            FROM conversations""",
    ),
    "prediction_table": (
        prediction_table,
        f"""WITH {B.PREDICTIONS_SQL}
            SELECT id, model, reference_urgency, predicted_urgency, format_ok FROM preds""",
    ),
    "confusion_matrix": (confusion_matrix, CONFUSION_SQL),
    "eval_metrics": (eval_metrics, f"WITH {METRICS_CTE} SELECT * FROM metrics"),
    "eval_per_class": (
        eval_per_class,
        f"""WITH {PER_CLASS_CTE} SELECT model, name AS label, round(precision, 4) AS precision,
              round(recall, 4) AS recall, round(f1, 4) AS f1, round(f2, 4) AS f2,
              act::BIGINT AS support FROM classes""",
    ),
    "eval_summary": (
        eval_summary,
        f"""WITH {METRICS_CTE} SELECT model, format_compliance, response_length_mean, n_unparseable,
              n_evaluated FROM metrics""",
    ),
    "threshold_check": (threshold_check, THRESHOLD_SQL),
    "thresholds_passed": (
        thresholds_passed,
        f"""WITH checks AS ({THRESHOLD_SQL}) SELECT model, count(*) FILTER (passed) AS n_passed,
              count(*) AS n_criteria FROM checks GROUP BY model""",
    ),
    "eval_compare": (eval_compare, _compare_sql()),
    "eval_verdict": (eval_verdict, VERDICT_SQL),
    "paired_responses": (paired_responses, PAIRED_SQL),
    "paired_responses_150": (paired_responses_150, PAIRED_SQL.replace("r <= 20", "r <= 150")),
    "request_outcomes": (
        request_outcomes, f"WITH {B.REQUESTS_SQL} SELECT * FROM requests",
    ),
    "latency_stats": (latency_stats, LATENCY_SQL),
    "error_rate": (
        error_rate,
        f"""WITH {B.REQUESTS_SQL} SELECT phase, count(*) AS n_total, count(error) AS n_errors
            FROM requests GROUP BY phase""",
    ),
    "sla_gate": (
        sla_gate,
        f"""WITH stats AS ({LATENCY_SQL}), one AS (
              SELECT max(p95_ms) FILTER (phase = 'sequential') AS p95_ms FROM stats)
            SELECT p95_ms, 80.0::DOUBLE AS limit_ms, coalesce(p95_ms <= 80, FALSE) AS passed FROM one""",
    ),
    "level_counts": (
        level_counts,
        f"""WITH {B.REQUESTS_SQL} SELECT phase, urgency_level, count(*) AS n FROM requests
            WHERE error IS NULL GROUP BY ALL""",
    ),
    "stream_triage": (stream_triage, _triage_sql()),
    "triage_scored": (triage_scored, _triage_sql(_SIZE)),
    "catalog_overview": (catalog_overview, _overview_sql()),
    "sql_group_count": (
        sql_group_count, "SELECT source, count(*) AS n FROM documents GROUP BY source",
    ),
    "sql_filter_limit": (
        sql_filter_limit,
        "SELECT doc_id, source, text FROM documents WHERE lang = 'fr' ORDER BY doc_id LIMIT 10",
    ),
    "build_dataset": (build_dataset, _build_sql()),
}
