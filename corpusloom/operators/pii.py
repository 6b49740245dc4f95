"""Anonymisation of tables and the reports about it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.pii import (
    PATTERN_RECOGNIZERS,
    SPANS,
    Recognizer,
    SpanModel,
    detect,
    drop_false_persons,
    is_false_person,
    mask,
    uncovered_types,
)
from corpusloom.operators.name_table import merge_spans, name_spans


def anonymize(
    df: DataFrame,
    columns: Sequence[str],
    language: str = "language",
    recognizers: Sequence[Recognizer] = PATTERN_RECOGNIZERS,
    model_factory: Callable[[], SpanModel] | None = None,
    min_person_score: float = K.PERSON_MIN_SCORE,
    allowlist: Sequence[str] = tuple(K.PERSON_ALLOWLIST),
    keep_original: bool = False,
    types: Sequence[str] | None = None,
    names: DataFrame | None = None,
    row_id: str = "id",
) -> DataFrame:
    """Mask several columns in one map-only pass and add what was found as ``entities``.

    ``names`` is a table with a column ``name`` of persons to mask, of any size; their spans are
    found by a join (see ``name_table``) and meet the rows by the unique ``row_id``.

    ``types`` names entity types that must be covered: without a model, one that no recogniser
    finds is refused.

    ``entities`` is an array over all columns, each element with its ``column``.  With
    ``keep_original`` the input columns survive as ``original_<column>``.
    """
    lost = [] if model_factory else uncovered_types(set(types or ()) - ({"PERSON"} if names is not None else set()), recognizers)
    if lost:
        raise ValueError(f"no recogniser for the entity types {lost}")
    rows, found = df, {}
    for c in columns:
        own = detect(F.col(c), F.col(language), recognizers, model_factory)
        if names is not None:
            key, listed = f"_id_{c}", f"_names_{c}"
            persons = name_spans(df, names, c, row_id).select(F.col(row_id).alias(key), F.col("spans").alias(listed))
            rows = rows.join(persons, F.col(row_id) == F.col(key), "left").drop(key)
            own = merge_spans(own, F.coalesce(F.col(listed), F.array().cast(SPANS)))
        found[c] = drop_false_persons(own, min_person_score, allowlist)
    spans = rows.withColumns({f"_spans_{c}": s for c, s in found.items()}).drop(*[f"_names_{c}" for c in columns])
    if keep_original:
        spans = spans.withColumns({f"original_{c}": F.col(c) for c in columns})
    masked = spans.withColumns({c: mask(F.col(c), F.col(f"_spans_{c}")) for c in columns})

    def tagged(name: str):
        return F.transform(
            F.col(f"_spans_{name}"),
            lambda s: F.struct(
                F.lit(name).alias("column"),
                s["type"].alias("type"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                s["score"].alias("score"),
                s["text"].alias("text"),
            ),
        )

    return masked.withColumn("entities", F.concat(*[tagged(c) for c in columns])).drop(
        *[f"_spans_{c}" for c in columns]
    )


def entity_table(df: DataFrame, row_id: str = "id", entities: str = "entities") -> DataFrame:
    """One row per entity.

    The outer form with a filter on its output: for the plain form Catalyst would infer a
    filter on the array, push it to the scan, and so run the detection twice.
    """
    return df.select(F.col(row_id), F.inline_outer(entities)).where(F.col("type").isNotNull())


def allowlist_filter(
    entities: DataFrame,
    min_score: float = K.PERSON_MIN_SCORE,
    allowlist: Sequence[str] = tuple(K.PERSON_ALLOWLIST),
) -> DataFrame:
    """Drop false PERSON hits from an entity table."""
    return entities.where(
        ~is_false_person(F.col("type"), F.col("score"), F.col("text"), min_score, allowlist)
    )


def pii_totals(df: DataFrame, entities: str = "entities") -> DataFrame:
    """Rows, rows with an entity, and entities, in one aggregation."""
    n = F.size(F.col(entities))
    return df.select(n.alias("n")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("n") > 0).alias("n_rows_with_pii"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_entities"),
    )


def pii_type_counts(df: DataFrame, entities: str = "entities") -> DataFrame:
    """Entities per type."""
    return (
        df.select(F.explode_outer(F.col(entities)["type"]).alias("type"))
        .where(F.col("type").isNotNull())
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def pii_report(datasets: dict[str, DataFrame], entities: str = "entities") -> DataFrame:
    """Entity counts of several anonymised tables merged, with ``n / rows * 100``.

    The percentage is entities per hundred rows, so it may exceed 100.  One aggregation over
    the rows: each row contributes its entity types and one marker that counts the row.
    """
    marker = F.lit("")
    stacked = None
    for df in datasets.values():
        part = df.select(
            F.explode(F.concat(F.array(marker), F.col(entities)["type"])).alias("type")
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    counts = stacked.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    # A handful of types: a window over all of them is a window over a handful of rows.
    rows = F.max(F.when(F.col("type") == marker, F.col("n"))).over(Window.partitionBy(F.lit(0)))
    return (
        counts.select("type", "n", (F.col("n") / rows * 100).alias("pct"))
        .where(F.col("type") != marker)
        .orderBy(F.col("n").desc(), "type")
    )


def review_queue(
    entities: DataFrame,
    row_id: str = "id",
    below: float = K.REVIEW_BELOW_SCORE,
    limit: int | None = K.REVIEW_ROWS,
) -> DataFrame:
    """Uncertain entities for manual review, in row order; all of them without a limit."""
    doubtful = entities.where(F.col("score") < below)
    if limit is None:
        return doubtful
    return doubtful.orderBy(row_id, "column", "start").limit(limit)


def masking_examples(
    df: DataFrame,
    columns: Sequence[str],
    row_id: str = "id",
    limit: int = K.EXAMPLE_ROWS,
    chars: int = K.EXAMPLE_CHARS,
) -> DataFrame:
    """The first rows with an entity, before and after, cut for display.

    Expects ``anonymize(..., keep_original=True)``.
    """
    shown = []
    for c in columns:
        shown.append(F.left(F.col(f"original_{c}"), F.lit(chars)).alias(f"original_{c}"))
        shown.append(F.left(F.col(c), F.lit(chars)).alias(f"anonymized_{c}"))
    return (
        df.where(F.size("entities") > 0)
        .select(row_id, *shown, F.size("entities").alias("n_entities"))
        .orderBy(row_id)
        .limit(limit)
    )
