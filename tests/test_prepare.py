"""Normalisation, quality rules and deduplication."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.text import fingerprint
from corpusloom.operators import dedup, normalize, quality

MCQ = "id int, question string, answer_a string, answer_b string, answer_c string, answer_d string, answer_e string"


def test_mcq_by_index(rows, values):
    data = [(i, q, "A", "B", "C", "D", e, k) for i, q, e, k in [
        (1, "q", "E", 0), (2, "q", "E", 4), (3, "q", "E", 5), (4, "q", "E", -1), (5, "q", "E", None),
        (6, "", "E", 0), (7, None, "E", 0), (8, "q", "", 4), (9, "q", None, 4),
    ]]
    got = normalize.mcq_by_index(rows(data, MCQ + ", correct_answers bigint"))
    assert values(got) == [
        (1, "Question médicale : q", "Réponse correcte : A.", K.SOURCE_MCQ_INDEX, "fr"),
        (2, "Question médicale : q", "Réponse correcte : E.", K.SOURCE_MCQ_INDEX, "fr"),
    ]


def test_mcq_by_letter(rows, values):
    data = [(i, q, "A", "B", "C", "D", "E", k, c) for i, q, k, c in [
        (1, "q", "A", ""), (2, "q", " b ", "case"), (3, "q", "A,B", ""), (4, "q", "", ""),
        (5, "q", None, ""), (6, "", "A", ""), (7, "q", " ", ""), (8, "q", "f", ""), (9, "q", "e", None),
    ]]
    got = normalize.mcq_by_letter(rows(data, MCQ + ", correct_answers string, clinical_case string"))
    assert values(got, "id", "instruction", "raw_response") == [
        (1, "Question médicale (examen) : q", "Réponse correcte : A."),
        (2, "Question médicale (examen) : case\nq", "Réponse correcte : B."),
        (9, "Question médicale (examen) : q", "Réponse correcte : E."),
    ]


def test_qa_and_open_qa(rows, values):
    qa = rows([(1, "t", "q", "a"), (2, "t", "", "a"), (3, "t", "q", None)],
              "id int, qtype string, Question string, Answer string")
    assert values(normalize.qa_pairs(qa)) == [(1, "q", "a", K.SOURCE_QA, "en")]
    both = rows([(1, "q", "a", "c"), (2, "q", "", "c"), (3, "q", None, None), (4, "", "a", "c")],
                "id int, question string, answer string, correct_answer string")
    assert values(normalize.open_qa(both), "id", "raw_response") == [(1, "a"), (2, "c")]
    assert values(normalize.open_qa(both.drop("correct_answer")), "id", "raw_response") == [(1, "a")]


def test_union_skips_what_is_missing(rows, values):
    qa = rows([(1, "q", "a")], "id int, Question string, Answer string")
    got = normalize.union_sources({K.SOURCE_QA: qa, "unknown": qa})
    assert values(got, "id", "source") == [(1, K.SOURCE_QA)]
    with pytest.raises(ValueError):
        normalize.union_sources({})


def is_valid(instruction, response):
    if not instruction or not instruction.strip() or not response or len(response.split()) < 20:
        return False
    text = instruction + " " + response
    return not (re.search(r"<[^>]+>|&[a-z]+;", text, re.I) or re.search(r"https?://|www\.", text, re.I))


WORDS = "w " * 20
QUALITY = [
    ("i", "w " * 19), ("i", WORDS), ("  ", WORDS), (None, WORDS), ("i", None), ("", WORDS),
    ("i", "w " * 20), ("i", "w\x1c" * 20), ("i", WORDS + "<b>"), ("i", WORDS + "<>"), ("i", WORDS + "<<>"),
    ("i", WORDS + "&amp;"), ("i", WORDS + "&AMP;"), ("i", WORDS + "&#39;"), ("i", WORDS + "HTTP://x"),
    ("i", WORDS + "WWW.x"), ("a < b", WORDS + "c > d"), ("i", WORDS + "< \n >"), ("i", WORDS + "a <"),
]


def test_quality_filter(rows, values):
    df = rows([(n, i, r) for n, (i, r) in enumerate(QUALITY)], "id int, instruction string, raw_response string")
    kept = sorted(r[0] for r in values(quality.quality_filter(df), "id"))
    assert kept == [n for n, (i, r) in enumerate(QUALITY) if is_valid(i, r)]
    counts = quality.quality_reasons(df.withColumn("source", F.lit("s")), ["source"]).first().asDict()
    assert counts["n_rows"] == len(QUALITY) and counts["n_valid"] == len(kept)
    assert sum(counts[f"n_{r}"] for r in quality.REASONS) == len(QUALITY) - len(kept)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="<>&;ab \n", max_size=12), min_size=50, max_size=80))
def test_markup_rule_is_the_plain_pattern(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", quality.has_markup(F.col("t"))).collect()
    assert all(hit == bool(re.search(r"<[^>]+>|&[a-z]+;", t, re.I)) for t, hit in got)


def test_web_addresses(spark):
    texts = ["http://x", "HTTPS://x", "httpſ://x", "ftp://x", "://", "www.x", "wWw.", "ww.x", "www x", "http:/", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", quality.has_url(F.col("t"))).collect()
    assert all(hit == bool(re.search(r"https?://|www\.", t, re.I)) for t, hit in got)


def test_request_gate(rows, values):
    df = rows([(n, "x" * n) for n in (9, 10, 2000, 2001)] + [(0, None)], "id int, symptoms string")
    assert values(quality.request_gate(df), "id", "accepted") == [
        (0, False), (10, True), (2000, True), (2001, False), (9, False),
    ]


def test_dedup_pair_keeps_the_first_and_is_idempotent(rows, values):
    df = rows([(3, "ab", "c"), (1, "a", "bc"), (2, "a", "b"), (4, "a", "b")], "id int, instruction string, response string")
    once = dedup.dedup_pair(df)
    assert values(once, "id") == [(1,), (2,)]
    assert values(dedup.dedup_pair(once)) == values(once)


def test_dedup_keeps_the_first_under_skew(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    got = {r.k: r.id for r in dedup.dedup_key(df.repartition(16), "k").collect()}
    assert got["hot"] == 0 and len(got) == 1 + sum(1 for i in range(20_000) if i % 3)
    plan = dedup.dedup_key(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_dedup_by_priority(rows, values):
    def answer(level):
        return f"{K.LEVEL_LABELS[level]}\n\n..."

    df = rows(
        [(1, "p", answer("deferred")), (2, "p", answer("max")), (3, "p", answer("moderate")),
         (4, "q", "unreadable"), (5, "q", answer("moderate")), (6, "r", "unreadable"), (7, "r", answer("deferred"))],
        "id int, prompt string, chosen string",
    )
    kept = dict(values(dedup.dedup_by_priority(df), "prompt", "id"))
    assert kept["p"] == 2 and kept["q"] == 5 and kept["r"] in (6, 7)
    assert dict(values(dedup.dedup_by_priority(df.repartition(7)), "prompt", "id")) == kept


def test_dedup_report(rows, values):
    df = rows([(1, "a"), (2, "a"), (3, "b")], "id int, k string")
    assert values(dedup.dedup_report(df, {"k": fingerprint(F.col("k"))})) == [("k", 3, 2, 1)]
