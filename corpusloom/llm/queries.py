"""The registered queries of this package; each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    align,
    bpe,
    decontaminate,
    language,
    licenses,
    lines,
    mixing,
    ngram_join,
    pages,
    signatures,
    tokens,
    toxicity,
    vectors,
)
from corpusloom.llm.common import held_out, new_folder, table


def default_tokenizer() -> str:
    """The tokenizer file of the queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    joined = F.concat_ws(",", "items")
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(joined, 256).alias("items_sha256"), "contaminated")


def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.train(docs)
    done = language.predict(docs.select("doc_id", "text"), model)
    return done.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op5_token_output(spark: SparkSession, folder: str) -> DataFrame:
    out = new_folder(spark, "tokens")
    tokens.write_tokens(table(spark, folder, "documents"), out, default_tokenizer())
    read = tokens.read_documents(spark, out)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "shard_start")


def op6_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_classes(table(spark, folder, "documents"))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licences(table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = lines.dedup_lines(docs)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", mixing.domain_of_labels().alias("domain"))
    rated = mixing.with_rates(table(spark, folder, "documents").select("doc_id", "text"), labels)
    return rated.select("doc_id", "n_tokens", "domain", "probability", "rate", "copies")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return signatures.search(signatures.build_index(docs), docs, table(spark, folder, "benchmark"))


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(ids, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    files = default_tokenizer(), public_tokenizers.path("piece_bpe_32k.model")
    found = align.align(table(spark, folder, "documents"), *files)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    counted = align.count_links(found.withColumn("groups_sha256", digest).drop("groups"))
    return counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_language_id": op4_language_id,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op5_token_output": op5_token_output,
    "op6_ngram_join": op6_ngram_join,
    "op7_license_scan": op7_license_scan,
    "op8_line_dedup": op8_line_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_alignment": op13_alignment,
}
