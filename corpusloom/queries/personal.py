"""Queries: personal data."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.pii import detect
from corpusloom.operators import name_table, pii
from corpusloom.queries import bindings as B
from corpusloom.sources.catalog import TableEntry, register_views, run_query
from corpusloom.sources.sql_functions import register_functions

COLUMNS = ["instruction", "raw_response"]


def _anonymized(spark, folder, keep_original=False):
    return pii.anonymize(
        B.sft_like(spark, folder), COLUMNS, recognizers=B.RECOGNIZERS, allowlist=B.ALLOWLIST,
        keep_original=keep_original,
    )


def _turns(spark, folder):
    """Conversations as a second dataset, one text column."""
    turns = B.table(spark, folder, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), "text", F.lit("en").alias("language")
    )
    return pii.anonymize(turns, ["text"], recognizers=B.RECOGNIZERS, allowlist=B.ALLOWLIST)


def pii_entities(spark, folder):
    """Every span in every document, before the filter on persons."""
    found = B.documents(spark, folder).select(
        F.col("doc_id").alias("id"),
        detect(F.col("text"), F.col("lang"), B.RECOGNIZERS).alias("entities"),
    )
    return pii.entity_table(found)


def sql_functions(spark, folder):
    """Ad-hoc SQL that calls the registered functions on a registered view."""
    register_functions(spark, B.LEXICON, B.RECOGNIZERS)
    register_views(spark, {"all_documents": TableEntry({"train": f"{folder}/documents.parquet"})})
    return run_query(
        spark,
        """SELECT doc_id AS id, word_count(d.text) AS n_words, lexicon_level(d.text) AS level,
                  s.type, s.start, s.end, s.text AS found
           FROM all_documents d, LATERAL pii_spans(d.text, d.lang) s""")


def pii_allowlist(spark, folder):
    return pii.allowlist_filter(pii_entities(spark, folder), allowlist=B.ALLOWLIST)


def pii_mask(spark, folder):
    return _anonymized(spark, folder).select("id", *COLUMNS, "source", "language")


def pii_stats(spark, folder):
    return pii.pii_totals(_anonymized(spark, folder))


def pii_type_counts(spark, folder):
    return pii.pii_type_counts(_anonymized(spark, folder))


def pii_report(spark, folder):
    return pii.pii_report({"sft": _anonymized(spark, folder), "turns": _turns(spark, folder)})


def pii_review(spark, folder):
    return pii.review_queue(pii.entity_table(_anonymized(spark, folder)))


def pii_examples(spark, folder):
    return pii.masking_examples(_anonymized(spark, folder, keep_original=True), COLUMNS)


_DOCS = "(SELECT doc_id, text FROM documents)"
FOUND_SQL = f"""found AS (
  {B.sql_entities("sft", "id", "instruction")}
  UNION ALL {B.sql_entities("sft", "id", "raw_response")})"""
TURNS_SQL = f"""turns AS (
  SELECT conv_id || '-' || turn AS id, text FROM conversations),
turn_found AS ({B.sql_entities("turns", "id", "text")})"""

PIECES = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def pii_name_table(spark, folder):
    """Occurrences of up to 100 000 names, drawn by their hash from the pairs of words of the texts."""
    docs = B.documents(spark, folder).select("doc_id", "text")
    pieces = F.regexp_extract_all("text", F.lit(PIECES), F.lit(0))
    split = docs.select(pieces.alias("p"))
    runs = split.select(F.explode(F.arrays_zip(
        F.col("p").alias("a"), F.slice("p", 2, 1 << 30).alias("b"), F.slice("p", 3, 1 << 30).alias("c"))).alias("run"))
    pairs = runs.where(F.col("run.b") == " ").where(F.col("run.c").isNotNull())
    names = pairs.select(F.lower(F.concat_ws(" ", "run.a", "run.c")).alias("name")).distinct()
    names = names.withColumn("place", F.md5("name")).where(F.col("place") < "7").orderBy("place").limit(100_000)
    found = name_table.find_names(docs, names, row_id="doc_id")
    return found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_names"), F.min("start").cast("long").alias("first_start"),
        F.sum("start").alias("sum_start"), F.sum("end").alias("sum_end"))


QUERIES = {
    "pii_entities": (
        pii_entities,
        f"""SELECT id, type, "start", "end", score, text
            FROM ({B.sql_entities(_DOCS, "doc_id", "text", filtered=False)})""",
    ),
    "sql_functions": (
        sql_functions,
        f"""SELECT id, {B.sql_words("d.text")} AS n_words, {B.sql_level("d.text")} AS level,
                   e.type, e."start", e."end", e.text AS found
            FROM ({B.sql_entities(_DOCS, "doc_id", "text", filtered=False)}) e JOIN documents d ON e.id = d.doc_id""",
    ),
    "pii_allowlist": (
        pii_allowlist,
        f"""SELECT id, type, "start", "end", score, text
            FROM ({B.sql_entities(_DOCS, "doc_id", "text")})""",
    ),
    "pii_mask": (
        pii_mask,
        f"""WITH {B.SFT_SQL}
            SELECT id, {B.sql_mask("sft.instruction")} AS instruction,
                   {B.sql_mask("sft.raw_response")} AS raw_response, source, language FROM sft""",
    ),
    "pii_stats": (
        pii_stats,
        f"""WITH {B.SFT_SQL}, {FOUND_SQL}
            SELECT (SELECT count(*) FROM sft) AS n_rows,
                   (SELECT count(DISTINCT id) FROM found) AS n_rows_with_pii,
                   (SELECT count(*) FROM found) AS n_entities""",
    ),
    "pii_type_counts": (
        pii_type_counts,
        f"WITH {B.SFT_SQL}, {FOUND_SQL} SELECT type, count(*) AS n FROM found GROUP BY type",
    ),
    "pii_report": (
        pii_report,
        f"""WITH {B.SFT_SQL}, {FOUND_SQL}, {TURNS_SQL},
            types AS (SELECT type FROM found UNION ALL SELECT type FROM turn_found)
            SELECT type, count(*) AS n, count(*)::DOUBLE
                   / ((SELECT count(*) FROM sft) + (SELECT count(*) FROM turns)) * 100 AS pct
            FROM types GROUP BY type""",
    ),
    "pii_review": (
        pii_review,
        f"""WITH {B.SFT_SQL}, {FOUND_SQL}
            SELECT * FROM found WHERE score < {K.REVIEW_BELOW_SCORE}
            ORDER BY id, "column", "start" LIMIT {K.REVIEW_ROWS}""",
    ),
    "pii_examples": (
        pii_examples,
        f"""WITH {B.SFT_SQL}, {FOUND_SQL},
            first_rows AS (SELECT id, count(*)::INTEGER AS n_entities FROM found GROUP BY id
                           ORDER BY id LIMIT {K.EXAMPLE_ROWS})
            SELECT id, {", ".join(f'''substr({c}, 1, {K.EXAMPLE_CHARS}) AS original_{c},
                   substr({B.sql_mask("sft." + c)}, 1, {K.EXAMPLE_CHARS}) AS anonymized_{c}'''
                   for c in COLUMNS)}, n_entities
            FROM sft JOIN first_rows USING (id)""",
    ),
    "pii_name_table": (
        pii_name_table,
        """
WITH split AS (
  SELECT doc_id, regexp_extract_all(text, '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+') AS p FROM documents WHERE text IS NOT NULL
), pieces AS (
  SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM split
), placed AS (
  SELECT doc_id, k, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM pieces
), runs AS (
  SELECT a.doc_id, a.upto - length(a.piece) AS start, c.upto AS "end", b.piece AS gap,
         lower(a.piece || ' ' || c.piece) AS name
  FROM placed a JOIN placed b ON a.doc_id = b.doc_id AND b.k = a.k + 1 JOIN placed c ON a.doc_id = c.doc_id AND c.k = a.k + 2
  WHERE regexp_full_match(a.piece, '[\\p{L}\\p{N}]+') AND regexp_full_match(b.piece, '[ \\-''’.]{1,2}')
), names AS (
  SELECT DISTINCT name FROM runs WHERE gap = ' ' AND md5(name) < '7' ORDER BY md5(name) LIMIT 100000
)
SELECT doc_id, count(*) AS n_names, min(start)::BIGINT AS first_start, sum(start)::BIGINT AS sum_start,
       sum("end")::BIGINT AS sum_end
FROM runs JOIN names USING (name) GROUP BY doc_id""",
    ),
}
