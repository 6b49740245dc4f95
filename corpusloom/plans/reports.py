"""Markdown reports assembled from small result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.operators import evaluation, pii, requests
from corpusloom.sources.report import report

# Characters shown of instructions, generations, and answers being compared.
INSTRUCTION_CHARS, GENERATED_CHARS, COMPARED_CHARS, CHOSEN_CHARS = 300, 500, 600, 400


def _examples(predictions: DataFrame, n: int) -> DataFrame:
    shown = evaluation.good_bad_examples(predictions, n)
    return shown.select(
        "is_correct", "reference_urgency", "predicted_urgency",
        F.left("instruction", F.lit(INSTRUCTION_CHARS)).alias("instruction"),
        F.left("generated_response", F.lit(GENERATED_CHARS)).alias("generated_response"),
    ).orderBy(F.col("is_correct").desc(), "instruction")


def evaluation_report(predictions: DataFrame, title: str = "Evaluation", examples: int = 10) -> str:
    """Metrics, confusion matrix, thresholds, verdict and examples of one model."""
    metrics = evaluation.evaluate(predictions)
    matrix = (
        evaluation.confusion_matrix(predictions)
        .groupBy("reference").pivot("predicted", list(K.LEVELS)).agg(F.sum("n"))
        .orderBy(F.array_position(F.array(*[F.lit(x) for x in K.LEVELS]), F.col("reference")))
    )
    checks = evaluation.threshold_check(metrics)
    return report(
        title,
        {
            "Metrics": metrics,
            "Classes": evaluation.per_class_metrics(predictions),
            "Confusion matrix": matrix,
            "Thresholds": checks,
            "Criteria met": evaluation.count_passed(checks),
            "Verdict": metrics.select(
                "accuracy", evaluation.single_verdict(F.col("accuracy")).alias("verdict")
            ),
            "Examples": _examples(predictions, examples),
        },
    )


def comparison_report(
    predictions: DataFrame, base: str, candidate: str, paired: DataFrame | None = None
) -> str:
    """Two models side by side: metrics, differences, verdict, and sampled answers."""
    metrics = evaluation.evaluate(predictions, ["model"])
    checks = evaluation.threshold_check(metrics, by=["model"])
    sections = {
        "Metrics": metrics,
        "Differences": evaluation.compare_models(metrics, base, candidate),
        "Criteria met": evaluation.count_passed(checks, ["model"]),
        "Verdict": evaluation.model_verdict(metrics, base, candidate),
    }
    if paired is not None:
        sections["Answers"] = paired.select(
            "prompt",
            F.left("first_response", F.lit(COMPARED_CHARS)).alias(base),
            F.left("second_response", F.lit(COMPARED_CHARS)).alias(candidate),
            F.left("chosen_reference", F.lit(CHOSEN_CHARS)).alias("reference"),
        )
    return report(f"{base} and {candidate}", sections)


def latency_report(log: DataFrame, limit_ms: float = K.SLA_P95_MS) -> str:
    """Latency per phase, errors, the service level and the levels answered."""
    stats = requests.latency_stats(log)
    return report(
        "Latency",
        {
            "Service level": requests.sla_gate(stats, limit_ms=limit_ms),
            "Phases": stats,
            "Errors": requests.error_rate(log),
            "Levels": requests.level_counts(log.where(F.col("phase") == "sequential")),
        },
    )


def privacy_report(sft: DataFrame, pairs: DataFrame, columns: list[str]) -> str:
    """What was masked in both datasets, examples of the first, and doubtful hits.

    Expects the output of ``anonymize``, the first with ``keep_original``.
    """
    doubtful = [
        pii.review_queue(pii.entity_table(df), limit=None).select(
            F.lit(name).alias("dataset"), F.col("id").cast("string"), "column", "type", "text", "score"
        )
        for name, df in (("sft", sft), ("pairs", pairs))
    ]
    queue = doubtful[0].unionByName(doubtful[1])
    totals = pii.pii_totals(sft).withColumn("dataset", F.lit("sft")).unionByName(
        pii.pii_totals(pairs).withColumn("dataset", F.lit("pairs"))
    )
    return report(
        "Personal data",
        {
            "Totals": totals,
            "Types": pii.pii_report({"sft": sft, "pairs": pairs}),
            "Examples": pii.masking_examples(sft, columns),
            "Doubtful hits": queue.agg(F.count(F.lit(1)).alias("n")),
            "First doubtful hits": queue.orderBy(F.col("dataset").desc(), "id").limit(K.REVIEW_ROWS),
        },
    )
