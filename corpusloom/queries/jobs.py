"""Queries for loading, stages, models, rates and strata: the operators around the tables."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from corpusloom.operators import evaluation, labeling, sampling, sketches, stats, term_table
from corpusloom.operators.labeling import label_with
from corpusloom.operators.scoring import score_table
from corpusloom.queries import bindings as B
from corpusloom.queries.select import KEY, SPLIT_SQL
from corpusloom.session import new_folder
from corpusloom.sources import arrow_shards
from corpusloom.sources.catalog import TableEntry, load_all, load_table
from corpusloom.sources.footers import footer_profile
from corpusloom.sources.stages import read_splits, run_stage, write_splits
from corpusloom.sources.versions import Stage, StageStore


def load_outcomes(spark, folder):
    """Outcome and rows of sources of which one is missing and one lacks a split."""
    path = "{}/{}.parquet".format
    tables, outcome = load_all(spark, {
        "documents": TableEntry({"train": path(folder, "documents")}),
        "turns": TableEntry({"train": [path(folder, "conversations"), path(folder, "gone")]}),
        "half": TableEntry({"train": path(folder, "labels"), "val": path(folder, "gone")}),
        "lost": TableEntry({"train": path(folder, "gone")}),
    })
    counts = [t.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("name", F.lit(n)) for n, t in sorted(tables.items())]
    sizes = counts[0]
    for more in counts[1:]:
        sizes = sizes.unionByName(more)
    return outcome.select("name", "ok").join(sizes, "name", "left")


def arrow_shards_round_trip(spark, folder):
    """Documents written as Arrow shards and read through the catalog, with a path that is not there."""
    path = new_folder(spark)
    rows = B.documents(spark, folder).select("doc_id", "text", "lang", "n_chars")
    arrow_shards.register(spark)
    rows.repartition(5, "doc_id").write.format(arrow_shards.FORMAT).mode("overwrite").save(path)
    shards = [f"{path}/data-{k:05d}-of-00005.arrow" for k in range(5)] + [f"{path}/data-00005-of-00006.arrow"]
    table = load_table(spark, {"documents": TableEntry({"train": shards}, format=arrow_shards.FORMAT)}, "documents")
    return table.select("doc_id", F.md5("text").alias("text_md5"), "lang", "n_chars", "split")


def stage_reuse(spark, folder):
    """A stage that is built, found complete, and built again on demand."""
    path, rows = new_folder(spark), B.documents(spark, folder).select("doc_id", "source")

    def never():
        raise AssertionError("a complete stage must not be built")

    run_stage(spark, path, lambda: rows)
    run_stage(spark, path, never)
    return run_stage(spark, path, lambda: rows.withColumn("run", F.lit(2)), overwrite=True)


def stage_versions(spark, folder):
    """Three stages, brought up to date twice and after a change of one: what each holds and how often it was built."""
    root, built = new_folder(spark), []

    def store(shortest):
        return StageStore(spark, root, {
            "kept": Stage(
                lambda rows: rows.where(F.length("text") >= shortest).select("doc_id", "lang", "source"),
                [f"{folder}/documents.parquet"], {"shortest": shortest}),
            "marked": Stage(lambda rows: rows.select("doc_id", "toxic"), [f"{folder}/labels.parquet"]),
            "joined": Stage(
                lambda kept, marked: kept.join(marked, "doc_id").groupBy("lang", "toxic").agg(F.count(F.lit(1)).alias("n")),
                ["kept", "marked"]),
        })

    for shortest in (0, 0, 200):
        stages = store(shortest)
        joined = stages.ensure("joined")
        built += stages.built
    times = spark.createDataFrame([(name, built.count(name)) for name in sorted(set(built))], "stage string, n_built long")
    rows = joined.select(F.lit("joined").alias("stage"), "lang", "toxic", "n")
    for name in ("kept", "marked"):
        none = F.lit(None)
        rows = rows.unionByName(stages.read(name).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("stage"), none.cast("string").alias("lang"), none.cast("long").alias("toxic"), "n"))
    return rows.withColumn("toxic", F.col("toxic").cast("long")).join(times, "stage")


def split_round_trip(spark, folder):
    """A table stored by split and read back."""
    path = new_folder(spark)
    write_splits(B.documents(spark, folder).select("doc_id", "n_chars", F.col("lang").alias("split")), path)
    parts = [t.withColumn("split", F.lit(name)) for name, t in sorted(read_splits(spark, path).items())]
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole


def label_by_model(spark, folder):
    """Labels of a classifier that is not a lexicon."""

    def classify(text):
        level = F.when(F.length(text) > 2000, "max").when(F.length(text) > 800, "moderate").otherwise("deferred")
        return F.struct(level.alias("level"), F.lit(0.5).alias("confidence"))

    return label_with(B.documents(spark, folder).select("doc_id", "text"), classify, F.col("text")).drop("text")


def score_documents(spark, folder):
    """A model run over all texts in batches."""

    def factory():
        return lambda texts: [f"{len(t)} characters" for t in texts]

    scored = score_table(B.documents(spark, folder).select("doc_id", "text"), "text", factory)
    return scored.select("doc_id", "generated_response", "score_error")


def token_lengths(spark, folder):
    """Lengths of whole texts in tokens of a public tokenizer, and their profile per language."""
    import public_tokenizers

    rows = B.documents(spark, folder).select("lang", "text")
    counted = stats.with_token_length(
        rows, F.col("text"), tokenizer_factory=token_counter(public_tokenizers.path("byte_bpe_50k.json")))
    return stats.length_profile(counted, limit=1024, by=["lang"])


def token_counter(path):
    """A factory of functions from a batch of texts to their token counts, for a tokenizer file; null counts 0."""

    def factory():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker a core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        return lambda texts: [len(e) for e in tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]

    return factory


def throughput(spark, folder):
    runs = B.table(spark, folder, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_evaluated"), F.sum("l_linenumber").cast("double").alias("duration_s"))
    return evaluation.throughput(runs)


def profile_columns(spark, folder):
    rows = B.documents(spark, folder).select("doc_id", "text", "n_chars", F.col("lang").alias("split"))
    return stats.profile_columns(rows)


def _orders(spark, folder):
    return B.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("urgency_level"))


def footers(spark, folder):
    """Rows and nulls of every column of three tables, from their files' footers."""
    return footer_profile(spark, {n: f"{folder}/{n}.parquet" for n in ("orders", "documents", "labels")}).drop("type")


def sample_many_strata(spark, folder):
    return sampling.sample_per_group(_orders(spark, folder), F.col("urgency_level"), 2)


def split_many_strata(spark, folder):
    """The form for any number of strata."""
    return sampling.stratified_split(_orders(spark, folder), few=False)


def label_encode_many(spark, folder):
    """A class per customer, found and undone by a table of codes."""
    rows = _orders(spark, folder)
    codes = labeling.label_codes(rows, "urgency_level")
    coded = labeling.encode_with(rows, "urgency_level", codes)
    named = codes.withColumnRenamed("urgency_level", "decoded")
    return labeling.decode_with(coded, "label_id", named)


def lexicon_table(spark, folder):
    """In how many documents each word of the conversations and the benchmark occurs, anywhere in the text."""
    texts = B.table(spark, folder, "conversations").select("text").unionAll(B.table(spark, folder, "benchmark").select("text"))
    terms = texts.select(F.explode(F.split("text", "[ \n]")).alias("term")).where("length(term) >= 4").distinct()
    found = term_table.term_hits(B.documents(spark, folder).select("doc_id", "text"), F.col("text"), terms)
    return found.select(F.inline("hits")).groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"))


def length_sketch(spark, folder):
    """Lengths sketched per language and source, stored, merged per language, and held against the exact ranks."""
    path = new_folder(spark)
    rows = B.documents(spark, folder).select("lang", "source", F.length("text").alias("n"))
    sketches.sketch_lengths(rows, "n", ["lang", "source"]).write.parquet(path)
    whole = sketches.merge_sketches(spark.read.parquet(path), ["lang"])
    errors = sketches.rank_errors(rows, "n", ["lang"], sketches.sketch_quantiles(whole, ["lang"]))
    within = F.col("error") <= 2 * sketches.rank_error()
    return errors.select("lang", F.col("n").alias("n_rows"), "low", "high", "share", within.alias("within"))


_STRATA = "levelled AS (SELECT o_orderkey AS id, o_custkey::VARCHAR AS urgency_level FROM orders)"

QUERIES = {
    "load_outcomes": (
        load_outcomes,
        """SELECT 'documents' AS name, true AS ok, count(*) AS n_rows FROM documents
           UNION ALL SELECT 'turns', true, count(*) FROM conversations
           UNION ALL SELECT 'half', false, NULL UNION ALL SELECT 'lost', false, NULL""",
    ),
    "arrow_shards": (
        arrow_shards_round_trip,
        "SELECT doc_id, md5(text) AS text_md5, lang, n_chars, 'train' AS split FROM documents",
    ),
    "stage_reuse": (stage_reuse, "SELECT doc_id, source, 2 AS run FROM documents"),
    "stage_versions": (
        stage_versions,
        """WITH kept AS (SELECT doc_id, lang FROM documents WHERE length(text) >= 200)
           SELECT 'joined' AS stage, lang, toxic::BIGINT AS toxic, count(*) AS n, 2::BIGINT AS n_built
           FROM kept JOIN labels USING (doc_id) GROUP BY lang, toxic
           UNION ALL SELECT 'kept', NULL, NULL, count(*), 2 FROM kept
           UNION ALL SELECT 'marked', NULL, NULL, count(*), 1 FROM labels""",
    ),
    "split_round_trip": (split_round_trip, "SELECT doc_id, n_chars, lang AS split FROM documents"),
    "label_by_model": (
        label_by_model,
        """SELECT doc_id, CASE WHEN length(text) > 2000 THEN 'max' WHEN length(text) > 800 THEN 'moderate'
                  ELSE 'deferred' END AS urgency_level, 0.5::DOUBLE AS confidence FROM documents""",
    ),
    "score_documents": (
        score_documents,
        """SELECT doc_id, length(text) || ' characters' AS generated_response, NULL::VARCHAR AS score_error
           FROM documents""",
    ),
    "token_lengths": (token_lengths, None),
    "footers": (
        footers,
        " UNION ALL ".join(
            f"""SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS n_rows,
                       count(*) - count({column}) AS n_null FROM {table}"""
            for table, columns in [
                ("orders", "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority"),
                ("documents", "doc_id text lang source n_chars"), ("labels", "doc_id quality toxic")]
            for column in columns.split()),
    ),
    "throughput": (
        throughput,
        """SELECT *, CASE WHEN duration_s > 0 THEN round(n_evaluated / duration_s * 60, 1) ELSE 0.0 END
                  AS examples_per_min
           FROM (SELECT l_returnflag, count(*) AS n_evaluated, sum(l_linenumber)::DOUBLE AS duration_s
                 FROM lineitem GROUP BY 1)""",
    ),
    "profile_columns": (
        profile_columns,
        """SELECT lang AS split, 'doc_id' AS column_name, 'bigint' AS type, count(*) AS n_rows,
                  count(*) - count(doc_id) AS n_null FROM documents GROUP BY 1
           UNION ALL SELECT lang, 'text', 'string', count(*), count(*) - count(text) FROM documents GROUP BY 1
           UNION ALL SELECT lang, 'n_chars', 'bigint', count(*), count(*) - count(n_chars) FROM documents GROUP BY 1""",
    ),
    "sample_many_strata": (
        sample_many_strata,
        f"""WITH {_STRATA}, ranked AS (
              SELECT *, row_number() OVER (PARTITION BY urgency_level ORDER BY {KEY}) AS r FROM levelled)
            SELECT id, urgency_level FROM ranked WHERE r <= 2""",
    ),
    "lexicon_table": (
        lexicon_table,
        """WITH words AS (SELECT text FROM conversations UNION ALL SELECT text FROM benchmark),
           terms AS (SELECT DISTINCT term FROM (SELECT unnest(string_split_regex(text, '[ \n]')) AS term FROM words)
                     WHERE length(term) >= 4)
           SELECT term, count(*) AS n_docs FROM terms JOIN documents ON contains(text, term) GROUP BY term""",
    ),
    "length_sketch": (
        length_sketch,
        """SELECT lang, n_rows, low, high, share, true AS within
           FROM (SELECT lang, count(text) AS n_rows, min(length(text)) AS low, max(length(text)) AS high
                 FROM documents GROUP BY lang HAVING count(text) > 0),
                (SELECT unnest([0.5, 0.75, 0.9, 0.95, 0.99]::DOUBLE[]) AS share)""",
    ),
    "label_encode_many": (
        label_encode_many,
        f"""WITH {_STRATA} SELECT id, urgency_level, urgency_level AS decoded,
              (dense_rank() OVER (ORDER BY urgency_level) - 1)::INTEGER AS label_id FROM levelled""",
    ),
    "split_many_strata": (
        split_many_strata, SPLIT_SQL.format(rows=f"WITH {_STRATA}") + " SELECT id, urgency_level, split FROM splitted",
    ),
}
