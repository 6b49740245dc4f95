"""Scoring predictions against the truth.

All metrics derive from a handful of conditional counts, so a table of predictions of any
size is read once, by one aggregation without grouping or by model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.labels import follows_format, parse_level
from corpusloom.functions.text import word_count
from corpusloom.operators.sampling import cap_sample, sample_per_group

REF, PRED = "reference_urgency", "predicted_urgency"


def prediction_table(
    truth: DataFrame,
    generations: DataFrame,
    row_id: str = "id",
    label: str = "urgency_level",
    generated: str = "generated_response",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Join generations to the truth by id and read level and format from the text.

    A row without a generation counts as an empty one.
    """
    keep = [c for c in ("instruction", *carry) if c in truth.columns]
    other = [c for c in generations.columns if c not in (row_id, generated)]
    text = F.coalesce(F.col(generated), F.lit(""))
    return (
        truth.select(row_id, *keep, F.col(label).alias(REF))
        .join(generations.select(row_id, generated, *other), row_id, "left")
        .withColumn(generated, text)
        .withColumn(PRED, parse_level(F.col(generated)))
        .withColumn("format_ok", follows_format(F.col(generated)))
    )


def confusion_matrix(
    df: DataFrame, by: Sequence[str] = (), labels: Sequence[str] = tuple(K.LEVELS)
) -> DataFrame:
    """``(by…, reference, predicted, n)`` for every pair of labels, zeros included."""
    cells = {(a, b): f"{a}|{b}" for a in labels for b in labels}
    counted = df.groupBy(*by).agg(
        *[
            F.count_if((F.col(REF) == a) & (F.col(PRED) == b)).alias(name)
            for (a, b), name in cells.items()
        ]
    )
    listed = [
        F.struct(F.lit(a).alias("reference"), F.lit(b).alias("predicted"), F.col(name).alias("n"))
        for (a, b), name in cells.items()
    ]
    return counted.select(*by, F.inline(F.array(*listed)))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _fbeta(hits: Column, actual: Column, predicted: Column, beta: float) -> Column:
    weight = beta * beta
    return _ratio((1 + weight) * hits, weight * actual + predicted)


def _mean(values: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, values) / len(values)


def _label_counts(labels: Sequence[str]) -> list[Column]:
    parsed = F.col(PRED).isNotNull()
    counts = []
    for i, label in enumerate(labels):
        counts += [
            F.count_if((F.col(REF) == label) & (F.col(PRED) == label)).alias(f"_hit{i}"),
            F.count_if((F.col(REF) == label) & parsed).alias(f"_act{i}"),
            F.count_if(F.col(PRED) == label).alias(f"_pre{i}"),
        ]
    return counts


def per_class_metrics(
    df: DataFrame, by: Sequence[str] = (), labels: Sequence[str] = tuple(K.LEVELS)
) -> DataFrame:
    """Precision, recall, F1, F2 and support of every label on the parsed rows."""
    counted = df.groupBy(*by).agg(*_label_counts(labels))
    listed = []
    for i, label in enumerate(labels):
        hit, actual, predicted = F.col(f"_hit{i}"), F.col(f"_act{i}"), F.col(f"_pre{i}")
        listed.append(
            F.struct(
                F.lit(label).alias("label"),
                F.round(_ratio(hit, predicted), 4).alias("precision"),
                F.round(_ratio(hit, actual), 4).alias("recall"),
                F.round(_fbeta(hit, actual, predicted, 1), 4).alias("f1"),
                F.round(_fbeta(hit, actual, predicted, 2), 4).alias("f2"),
                actual.alias("support"),
            )
        )
    return counted.select(*by, F.inline(F.array(*listed)))


def evaluate(
    df: DataFrame,
    by: Sequence[str] = (),
    labels: Sequence[str] = tuple(K.LEVELS),
    key_label: str = "max",
    generated: str = "generated_response",
) -> DataFrame:
    """All metrics in one row per group.

    Class metrics are over parsed rows and averaged over all labels, absent ones counting
    zero; format compliance, length and the row counts are over all rows.
    """
    n = F.count(F.lit(1))
    counted = df.groupBy(*by).agg(
        *_label_counts(labels),
        F.count_if(F.col(REF) == F.col(PRED)).alias("_right"),
        F.count_if(F.col(PRED).isNotNull()).alias("_parsed"),
        F.count_if(F.col("format_ok")).alias("_formatted"),
        F.sum(word_count(F.col(generated))).alias("_words"),
        n.alias("n_evaluated"),
    )
    hit = [F.col(f"_hit{i}") for i in range(len(labels))]
    actual = [F.col(f"_act{i}") for i in range(len(labels))]
    predicted = [F.col(f"_pre{i}") for i in range(len(labels))]
    recalls = [_ratio(h, a) for h, a in zip(hit, actual, strict=True)]
    triples = list(zip(hit, actual, predicted, strict=True))
    total = F.col("n_evaluated")
    return counted.select(
        *by,
        F.round(_ratio(F.col("_right"), F.col("_parsed")), 4).alias("accuracy"),
        F.round(_mean([_fbeta(h, a, p, 1) for h, a, p in triples]), 4).alias("f1_macro"),
        F.round(_mean(recalls), 4).alias("recall_macro"),
        F.round(recalls[list(labels).index(key_label)], 4).alias(f"recall_{key_label}"),
        F.round(_mean([_fbeta(h, a, p, 2) for h, a, p in triples]), 4).alias("f2_macro"),
        F.round(_ratio(F.col("_formatted"), total), 4).alias("format_compliance"),
        F.round(_ratio(F.coalesce("_words", F.lit(0)), total), 1).alias("response_length_mean"),
        (total - F.col("_parsed")).alias("n_unparseable"),
        "n_evaluated",
    )


METRICS = [
    "accuracy", "f1_macro", "recall_macro", "recall_max", "f2_macro", "format_compliance",
]


def threshold_check(
    metrics: DataFrame,
    thresholds: Mapping[str, float] = K.METRIC_THRESHOLDS,
    by: Sequence[str] = (),
) -> DataFrame:
    """``(by…, criterion, value, threshold, passed)``; a metric that is missing counts 0."""
    listed = []
    for name, threshold in thresholds.items():
        value = F.coalesce(F.col(name), F.lit(0.0)) if name in metrics.columns else F.lit(0.0)
        listed.append(
            F.struct(
                F.lit(name).alias("criterion"),
                value.cast("double").alias("value"),
                F.lit(float(threshold)).alias("threshold"),
                (value >= threshold).alias("passed"),
            )
        )
    return metrics.select(*by, F.inline(F.array(*listed)))


def count_passed(checks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many criteria hold."""
    return checks.groupBy(*by).agg(
        F.count_if("passed").alias("n_passed"), F.count(F.lit(1)).alias("n_criteria")
    )


def compare_models(
    metrics: DataFrame,
    base: str,
    candidate: str,
    model: str = "model",
    names: Sequence[str] = tuple(METRICS),
    thresholds: Mapping[str, float] = K.METRIC_THRESHOLDS,
) -> DataFrame:
    """Both models' value, the difference and the verdict per metric.

    Takes the output of ``evaluate(by=[model])``, one row per model.
    """
    listed = F.array(
        *[
            F.struct(
                F.lit(n).alias("metric"),
                F.col(n).alias("value"),
                F.lit(thresholds.get(n)).cast("double").alias("threshold"),
            )
            for n in names
        ]
    )

    def side(which: str) -> Column:
        return F.max(F.when(F.col(model) == which, F.col("value")))

    return (
        metrics.where(F.col(model).isin(base, candidate))
        .select(model, F.inline(listed))
        .groupBy("metric", "threshold")
        .agg(side(base).alias("base"), side(candidate).alias("candidate"))
        .select(
            "metric",
            "base",
            "candidate",
            F.round(F.col("candidate") - F.col("base"), 4).alias("delta"),
            "threshold",
            (F.col("base") >= F.col("threshold")).alias("base_passed"),
            (F.col("candidate") >= F.col("threshold")).alias("candidate_passed"),
        )
    )


def single_verdict(accuracy: Column) -> Column:
    """Advice for one model by its accuracy."""
    return (
        F.when(accuracy >= 0.70, "ready").when(accuracy >= 0.60, "acceptable")
        .otherwise("insufficient")
    )


def comparison_verdict(base: Column, candidate: Column) -> Column:
    """Advice for a candidate by its accuracy and the change from the base."""
    delta = candidate - base
    return (
        F.when((delta >= -0.03) & (candidate >= 0.65), "validated")
        .when(delta < -0.05, "regression")
        .otherwise("mixed")
    )


def model_verdict(metrics: DataFrame, base: str, candidate: str, model: str = "model") -> DataFrame:
    """One row with both accuracies and both kinds of advice."""

    def side(which: str) -> Column:
        return F.max(F.when(F.col(model) == which, F.col("accuracy")))

    return metrics.agg(
        side(base).alias("base_accuracy"), side(candidate).alias("candidate_accuracy")
    ).select(
        "base_accuracy",
        "candidate_accuracy",
        single_verdict(F.col("base_accuracy")).alias("base_verdict"),
        comparison_verdict(F.col("base_accuracy"), F.col("candidate_accuracy")).alias(
            "candidate_verdict"
        ),
    )


def good_bad_examples(
    df: DataFrame, n: int = 10, row_id: str = "id", seed: int = K.SEED
) -> DataFrame:
    """``n // 2`` right and ``n // 2`` wrong predictions; unparsed counts as wrong."""
    right = F.coalesce(F.col(PRED) == F.col(REF), F.lit(False))
    flagged = df.withColumn("is_correct", right)
    return sample_per_group(flagged, F.col("is_correct"), n // 2, row_id, seed)


def paired_responses(
    pairs: DataFrame,
    first: DataFrame,
    second: DataFrame,
    n: int = 10,
    row_id: str = "id",
    generated: str = "generated_response",
    seed: int = K.SEED,
) -> DataFrame:
    """Two models' texts next to the reference answer for ``n`` sampled prompts."""
    sample = cap_sample(pairs, n, row_id, seed).select(
        row_id, "prompt", F.col("chosen").alias("chosen_reference")
    )

    def texts(generations: DataFrame, name: str) -> DataFrame:
        return generations.select(row_id, F.col(generated).alias(name))

    return (
        sample.join(texts(first, "first_response"), row_id)
        .join(texts(second, "second_response"), row_id)
        .select(row_id, "prompt", "first_response", "second_response", "chosen_reference")
    )


def throughput(df: DataFrame, rows: str = "n_evaluated", seconds: str = "duration_s") -> DataFrame:
    """Add examples per minute; 0 when no time passed."""
    rate = F.round(F.col(rows) / F.col(seconds) * 60, 1)
    return df.withColumn(
        "examples_per_min", F.when(F.col(seconds) > 0, rate).otherwise(F.lit(0.0))
    )
