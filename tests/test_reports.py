"""Feedback jobs and reports."""

from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.labels import render_answer
from corpusloom.operators import evaluation, pii
from corpusloom.plans import feedback, reports


def labelled(spark):
    level = F.when(F.col("id") % 2 == 0, "max").otherwise("deferred")
    df = spark.range(20).select(
        "id", F.concat(F.lit("question "), "id").alias("instruction"), level.alias("urgency_level"),
        F.lit("fr").alias("language"),
    )
    return df.withColumn("response", render_answer(F.col("urgency_level"), F.lit("body")))


def always(answer, calls=None):
    def factory():
        return lambda prompts: [answer] * len(prompts)

    return factory


def test_mining_stores_generations_once(spark, tmp_path, values):
    train = labelled(spark)
    answer = "URGENCE MAXIMALE. abcdefghijk. abcdefghijk. �"
    got = feedback.mine_hard_negatives(spark, train, always(answer), str(tmp_path), clean=True)
    assert [r.id for r in got.orderBy("id").collect()] == list(range(1, 20, 2))
    assert {r.rejected for r in got.collect()} == {answer[:-2]}
    # The stored stages win over another model.
    again = feedback.mine_hard_negatives(spark, train, always("?"), str(tmp_path))
    assert values(again, "id") == values(got, "id")


def test_reports(spark, tmp_path, rows):
    held_out = labelled(spark)
    answers = {"base": "URGENCE MAXIMALE. abcdefghijk. abcdefghijk", "tuned": "nothing"}
    predictions = feedback.predict(
        spark, held_out, {n: always(a) for n, a in answers.items()}, str(tmp_path), rows=10
    )
    assert predictions.count() == 20
    one = reports.evaluation_report(predictions.where("model = 'base'"), examples=4)
    assert "## Confusion matrix" in one and "| reference | max | moderate | deferred |" in one
    both = reports.comparison_report(
        predictions, "base", "tuned",
        evaluation.paired_responses(
            held_out.select("id", F.col("instruction").alias("prompt"), F.col("response").alias("chosen")),
            predictions.where("model = 'base'"), predictions.where("model = 'tuned'"), n=3,
        ),
    )
    assert "regression" in both and "## Answers" in both

    log = rows([("sequential", 10.0, None, "max"), ("concurrent", 20.0, "e", None)],
               "phase string, latency_ms double, error string, urgency_level string")
    assert "| 10 | 5000 | True |" in reports.latency_report(log)

    texts = rows([(1, "a@b.fr", "fr"), (2, "+33 6 12 34 56 78", "fr")], "id bigint, text string, language string")
    masked = pii.anonymize(texts, ["text"], keep_original=True)
    text = reports.privacy_report(masked, masked, ["text"])
    assert "| EMAIL_ADDRESS | 2 | 50 |" in text and "## First doubtful hits" in text
    assert K.REVIEW_ROWS == 20
