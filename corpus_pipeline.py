"""The corpus pipeline: five stages over ``documents``, each stored as Parquet and read again.

Language ID drops texts without a language; the n-gram join keeps one document of each group;
decontamination drops documents that quote the benchmark; mixing repeats or drops documents by the
rates of their domains; token output writes the rest as Arrow files and reads them back.  Every
stage but the last returns the columns of ``documents``.

Every stage lets its session send rows to Python by ``BATCH_BYTES`` at a time, unless the session
itself says how many.  Spark's own bound of 10 000 rows lets a batch grow with the texts, and an
executor keeps much of what its largest batches took until it ends.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, language, mixing, ngram_join, tokens
from corpusloom.llm.common import fresh, new_folder, stored, table
from corpusloom.llm.queries import default_tokenizer

# A text in which no language holds this share of the words is rejected.
MIN_SCORE = 0.3
# The last stage runs in workers and executors that four stages have used before it.
REMEMBERED = 100_000
BATCH_BYTES = "4m"


def by_bytes(stage: Callable) -> Callable:
    """A stage in whose session batches of rows for Python are bounded in bytes; a bound that was set stays."""

    @functools.wraps(stage)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound = "spark.sql.execution.arrow.maxBytesPerBatch"
        if spark.conf.get(bound, None) is None:
            spark.conf.set(bound, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return staged


@by_bytes
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.train(docs)
    found_lang, score = fresh("lang_pred", docs), fresh("score", docs)
    found = language.predict(docs, model, (found_lang, score))
    sure = (F.col(found_lang) != language.UNKNOWN) & (F.col(score) >= MIN_SCORE)
    return found.where(sure).select(*docs.columns)


@by_bytes
def ngram_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_per_class(docs)


@by_bytes
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@by_bytes
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", mixing.domain_of_labels().alias("domain"))
    return mixing.mix(docs, labels)


@by_bytes
def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    tokens.write_tokens(docs, folder, default_tokenizer(), remembered=REMEMBERED)
    return tokens.read_documents(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language_id", language_id),
    ("ngram_dedup", ngram_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

# Learned models and token files are beyond SQL; the tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
