"""Personal data: spans, overlaps, the person filter, masking and reports."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import pii as P
from corpusloom.operators import pii

PERSON = P.Recognizer("PERSON", "[A-Z][a-z]+ [A-Z][a-z]+", 0.85)
WEAK = P.Recognizer("PERSON", "Mr [a-z]+", 0.84)
PLACE = P.name_list("LOCATION", ["Lyon", "Lyon Sud"], 0.5, ("fr",))
ALL = (*P.PATTERN_RECOGNIZERS, PERSON, WEAK, PLACE)

TEXTS = [
    (1, "mail a.b@mail2.example.com or +1 (743) 555-3824", "en"),
    (2, "nothing to see", "en"),
    (3, "   ", "en"),
    (4, None, "en"),
    (5, "Jean Dupont le 12 mars 2024 et 2024-03-12, 01/02/24", "fr"),
    (6, "Howard Downing and Crohn Disease, Mr smith", "en"),
    (7, "Lyon Sud", "fr"),
    (8, "Lyon", "en"),
    (9, "06 12 34 56 78 (743) 555-3824 May 3, 2021", "fr"),
    (10, "é𝒳 x@y.fr", "fr"),
]
SCHEMA = "id int, text string, language string"


@pytest.fixture(scope="module")
def masked(spark):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    return pii.anonymize(df, ["text"], recognizers=ALL, keep_original=True).cache()


def test_spans_point_into_the_text(spark):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    found = df.select("id", P.detect(F.col("text"), F.col("language"), ALL).alias("entities"))
    texts = {i: t for i, t, _ in TEXTS}
    spans = pii.entity_table(found).collect()
    assert {r.id for r in spans} == {1, 5, 6, 7, 9, 10}
    assert all(texts[r.id][r.start : r.end] == r.text for r in spans)
    assert {(r.id, r.type) for r in spans} >= {
        (1, "EMAIL_ADDRESS"), (1, "PHONE_NUMBER"), (5, "PERSON"), (5, "DATE_TIME"), (7, "PERSON"), (9, "PHONE_NUMBER"),
    }
    assert sum(r.type == "DATE_TIME" for r in spans if r.id == 5) == 3
    assert sum(r.id == 9 for r in spans) == 3


def test_masking(masked, values):
    got = dict(values(masked, "id", "text"))
    assert got[1] == "mail <EMAIL_ADDRESS> or <PHONE_NUMBER>"
    assert got[2] == "nothing to see"
    assert got[3] == "   " and got[4] is None
    assert got[5] == "<PERSON> le <DATE_TIME> et <DATE_TIME>, <DATE_TIME>"
    # "down" is allow-listed and contained in "Downing"; 0.84 is below the person threshold.
    assert got[6] == "Howard Downing and Crohn Disease, Mr smith"
    assert got[7] == "<PERSON>"  # the higher score wins the overlap
    assert got[8] == "Lyon"  # a French-only name
    assert got[10] == "é𝒳 <EMAIL_ADDRESS>"


def test_masking_is_idempotent(masked, values):
    again = pii.anonymize(masked.select("id", "text", "language"), ["text"], recognizers=ALL)
    assert values(again, "id", "text") == values(masked, "id", "text")
    assert pii.entity_table(again).count() == 0


def test_resolve_overlaps_against_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        spans = []
        for _ in range(rng.randint(0, 12)):
            start = rng.randint(0, 30)
            spans.append((rng.choice("AB"), start, start + rng.randint(1, 8), rng.choice([0.4, 0.85, 1.0])))
        want = []
        for s in sorted(spans, key=lambda s: (-s[3], -(s[2] - s[1]), s[1], s[0])):
            if all(s[2] <= k[1] or s[1] >= k[2] for k in want):
                want.append(s)
        assert P.resolve_overlaps(spans) == sorted(want, key=lambda s: s[1])


def test_person_filter(rows, values):
    data = [("PERSON", 0.84, "Zed Zed"), ("PERSON", 0.85, "Zed Zed"), ("PERSON", 0.99, "Crohn"),
            ("PERSON", 0.99, "Howard Downing"), ("LOCATION", 0.1, "Crohn"), ("PERSON", 0.99, "Holiday Inn")]
    df = rows(data, "type string, score double, text string")
    assert values(pii.allowlist_filter(df)) == [("LOCATION", 0.1, "Crohn"), ("PERSON", 0.85, "Zed Zed")]
    assert len(values(pii.allowlist_filter(df, 0.0, []))) == 6


def test_labels_of_the_answer_are_never_masked(spark, values):
    shout = P.Recognizer("PERSON", "URGENCE [A-ZÉ]+", 0.9)
    df = spark.createDataFrame([(1, "URGENCE MODÉRÉE", "fr")], SCHEMA)
    assert values(pii.anonymize(df, ["text"], recognizers=[shout]), "text") == [("URGENCE MODÉRÉE",)]


def test_statistics(masked, values):
    assert values(pii.pii_totals(masked)) == [(10, 5, 11)]
    counts = dict(values(pii.pii_type_counts(masked)))
    assert counts == {"EMAIL_ADDRESS": 2, "PHONE_NUMBER": 3, "PERSON": 2, "DATE_TIME": 4}
    report = {r.type: (r.n, r.pct) for r in pii.pii_report({"a": masked, "b": masked}).collect()}
    assert report["DATE_TIME"] == (8, pytest.approx(40.0))


def test_share_may_exceed_100(spark):
    df = spark.createDataFrame([(1, "a@b.fr c@d.fr e@f.fr", "fr")], SCHEMA)
    report = pii.pii_report({"a": pii.anonymize(df, ["text"])}).collect()
    assert [(r.n, r.pct) for r in report] == [(3, 300.0)]


def test_review_and_examples(masked, values):
    entities = pii.entity_table(masked)
    review = pii.review_queue(entities).collect()
    assert review and all(r.score < 0.7 and r.type != "PERSON" for r in review)
    assert len(pii.review_queue(entities, limit=2).collect()) == 2
    assert pii.review_queue(entities, limit=None).count() == len(review)
    shown = pii.masking_examples(masked, ["text"], limit=2, chars=6).collect()
    assert [(r.id, r.original_text, r.anonymized_text) for r in shown] == [(1, "mail a", "mail <"), (5, "Jean D", "<PERSO")]


def test_plugged_model(spark, values):
    def factory():
        def model(texts, languages):
            return [[("PERSON", 0, 4, 0.9)] if lang == "fr" else [] for _, lang in zip(texts, languages)]

        return model

    df = spark.createDataFrame([(1, "Zoé! a@b.fr", "fr"), (2, "Zoé!", "en"), (3, None, "fr")], SCHEMA)
    got = pii.anonymize(df, ["text"], model_factory=factory)
    assert values(got, "id", "text") == [(1, "<PERSON> <EMAIL_ADDRESS>"), (2, "Zoé!"), (3, None)]


def test_several_columns(spark, values):
    df = spark.createDataFrame([(1, "a@b.fr", "x", "c@d.fr", "fr")], "id int, p string, c string, r string, language string")
    got = pii.anonymize(df, ["p", "c", "r"])
    assert values(got, "p", "c", "r") == [("<EMAIL_ADDRESS>", "x", "<EMAIL_ADDRESS>")]
    assert values(pii.entity_table(got), "column", "text") == [("p", "a@b.fr"), ("r", "c@d.fr")]


def test_detection_runs_once(spark):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    plan = pii.entity_table(pii.anonymize(df, ["text"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("[find(") == 1


def test_default_lists_match_whole_words_only(spark):
    df = spark.createDataFrame(
        [(1, "She moved to Paris with a French doctor, a Parisian nicety; Nice! Frenchman", "en")],
        "id bigint, text string, language string",
    )
    masked = pii.anonymize(df, ["text"], recognizers=P.DEFAULT_RECOGNIZERS).first()
    assert masked["text"] == "She moved to <LOCATION> with a <NRP> doctor, a Parisian nicety; <LOCATION>! Frenchman"
    assert [e["text"] for e in masked["entities"]] == ["Paris", "French", "Nice"]


def test_types_without_a_recogniser_are_refused(spark):
    df = spark.createDataFrame([(1, "x", "en")], "id bigint, text string, language string")
    pii.anonymize(df, ["text"], recognizers=P.DEFAULT_RECOGNIZERS, types=["LOCATION", "NRP", "EMAIL_ADDRESS"])
    with pytest.raises(ValueError, match="PERSON"):
        pii.anonymize(df, ["text"], recognizers=P.DEFAULT_RECOGNIZERS, types=["PERSON"])


def test_masking_counts_code_points(spark):
    df = spark.createDataFrame([(1, "é日😀 a@b.org 😀 c@d.org", "en")], "id bigint, text string, language string")
    assert pii.anonymize(df, ["text"]).first()["text"] == "é日😀 <EMAIL_ADDRESS> 😀 <EMAIL_ADDRESS>"
