"""Extra columns with clashing names, and repeated rows, through operators and stages."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import decontaminate, language, licenses, mixing, ngram_join, tokens, toxicity
from corpusloom.llm.common import fresh, sampled
from corpusloom.llm.lines import dedup_lines
from corpusloom.llm.queries import default_tokenizer

CLASHES = ["_id", "_mark", "_pieces", "_digest", "_copy", "_done", "_keys", "_place", "_rank", "_n", "spans", "copies", "mark",
           "score", "lang_pred", "n_lines", "n_dropped", "kept_text", "matches", "items", "n_words", "rate", "domain", "count"]
PASSAGE = " ".join(f"bench{k}" for k in range(13))
WORDS = {"en": "the and of with house tree", "de": "der und von mit haus baum"}


def prose(lang, seed, n=40):
    return " ".join(random.Random(seed).choices(WORDS[lang].split(), k=n))


@pytest.fixture
def clashing(spark):
    """Documents with a column of every name that an operator uses inside, holding the id as text."""
    rows = [(k, prose("en" if k % 2 else "de", k), "en" if k % 2 else "de", "s", k) for k in range(40)]
    rows += [(100, rows[0][1] + " " + PASSAGE, "de", "s", 1), (101, rows[1][1], "en", "s", 1), (101, rows[1][1], "en", "s", 1),
             (102, None, None, None, None), (None, "the house", "en", "s", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return table.select("*", *[F.col("doc_id").cast("string").alias(c) for c in CLASHES])


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([("b", PASSAGE)], "item_id string, text string")


def intact(df, columns=CLASHES):
    """The ids of ``df``, whose extra columns must all hold the id still."""
    rows = df.select("doc_id", *columns).collect()
    assert all(r[c] == (None if r["doc_id"] is None else str(r["doc_id"])) for r in rows for c in columns)
    return sorted((r["doc_id"] for r in rows), key=repr)


def test_fresh_names(spark):
    table = spark.range(1).select(F.lit(1).alias("A"), F.lit(1).alias("a_1"))
    assert fresh("a", table) == "a_2" and fresh("b", table) == "b"


@pytest.mark.parametrize("remove", ["documents", "spans"])
def test_decontaminate(clashing, benchmark, remove):
    kept = decontaminate.decontaminate(clashing, benchmark, remove)
    assert kept.columns == clashing.columns
    ids = intact(kept)
    assert (100 in ids) == (remove == "spans") and len(ids) == clashing.count() - (remove == "documents")
    assert kept.where(F.col("text").contains("bench5")).count() == 0


def test_one_per_class(clashing):
    kept = ngram_join.one_per_class(clashing)
    assert kept.columns == clashing.columns
    ids = intact(kept)
    assert 101 not in ids and 102 in ids and None in ids


def test_mix(spark, clashing):
    labels = spark.createDataFrame([(k, "good" if k % 2 else "poor") for k in range(40)], "doc_id long, domain string")
    mixed = mixing.mix(clashing, labels, {"good": 1.0, "poor": 2.0})
    assert mixed.columns == clashing.columns
    assert set(intact(mixed)) <= {r["doc_id"] for r in clashing.select("doc_id").collect()}


def test_results_replace_input_columns(spark, clashing):
    """A result takes the place of an input column of its name, and may have another name."""
    model = language.train(clashing)
    found = language.predict(clashing, model)
    others = [c for c in CLASHES if c not in ("lang_pred", "score")]
    assert sorted(found.columns) == sorted(clashing.columns) and found.schema["score"].dataType.typeName() == "double"
    intact(found, others)
    named = language.predict(clashing, model, ("is", "sure"))
    assert named.columns == [*clashing.columns, "is", "sure"]
    intact(named)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    judged = toxicity.train(clashing, labels)
    intact(toxicity.score(clashing, judged), [c for c in CLASHES if c != "score"])
    intact(toxicity.score(clashing, judged, "toxic"))
    intact(licenses.scan(clashing), [c for c in CLASHES if c != "matches"])
    results = ("kept_text", "n_lines", "n_dropped")
    intact(dedup_lines(clashing), [c for c in CLASHES if c not in results])


def test_lines_by_join(spark, clashing, tmp_path):
    from corpusloom.llm.lines import LineIndex

    table = clashing.withColumn("text", F.concat_ws("\n", F.lit("shared"), "text"))
    index = LineIndex(spark, str(tmp_path / "lines"), min_docs=10).insert(table)
    whole, joined = index.apply(table), index.apply(table, broadcast_keys=0)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, joined.select(whole.columns).collect()))


def test_tokens(spark, clashing, tmp_path):
    tokens.write_tokens(clashing, str(tmp_path / "t"), default_tokenizer())
    found = tokens.read_documents(spark, str(tmp_path / "t"))
    assert found.count() == clashing.count()


def test_stages_keep_columns(spark, clashing, benchmark, tmp_path):
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = [(k, k % 2, 0) for k in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, str(tmp_path))
        assert done.columns == clashing.columns, name
        assert intact(done), name
        docs = done
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_sample_of_repeated_rows(spark):
    """600 copies of one row and 300 other ids: 300 ids of either language, or all there are, once each."""
    ids = spark.range(600).select(F.lit(7).cast("long").alias("doc_id")).union(spark.range(100, 400).toDF("doc_id"))
    rows = ids.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "b").otherwise("a"))
    assert sampled(rows, 400, "lang").count() == 301 == sampled(rows, 400, "lang").distinct().count()
    by_lang = {r["lang"]: r["count"] for r in sampled(rows, 50, "lang").groupBy("lang").count().collect()}
    assert by_lang == {"a": 50, "b": 50}
    assert sampled(rows.select("doc_id"), 120).distinct().count() == 120


def test_language_learns_from_distinct_ids(spark, monkeypatch):
    rows = [(7, prose("en", 7), "en")] * 600 + [(k, prose("de" if k % 2 else "en", k), "de" if k % 2 else "en") for k in range(100, 400)]
    learnt = []
    monkeypatch.setattr(language, "fit", lambda pairs: learnt.extend(pairs))
    language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    expected = {(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 5}
    assert len(learnt) == len({i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5}) and set(learnt) == expected
