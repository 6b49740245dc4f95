"""Labelling tables, rendering answers, and encoding labels as integers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.labels import CLINICAL_LEXICON, Lexicon, lexicon_level, render_answer
from corpusloom.operators.ranking import BROADCAST_STRATA, numbered, salted_join


def label_with(df: DataFrame, classify: Callable[[Column], Column], text: Column) -> DataFrame:
    """Add ``urgency_level`` and ``confidence`` from any classifier.

    ``classify`` maps the text column to ``struct(level, confidence)``: a native expression,
    or a pandas UDF around a model.
    """
    return (
        df.withColumn("_label", classify(text))
        .withColumn("urgency_level", F.col("_label.level"))
        .withColumn("confidence", F.col("_label.confidence"))
        .drop("_label")
    )


def label_by_lexicon(
    df: DataFrame,
    text_columns: Sequence[str] = ("instruction", "raw_response"),
    lexicon: Lexicon = CLINICAL_LEXICON,
) -> DataFrame:
    """Label by keyword over the text columns joined with a space."""
    text = F.concat_ws(" ", *text_columns)
    return label_with(df, lambda c: lexicon_level(c, lexicon), text)


def add_answer(
    df: DataFrame, level: str = "urgency_level", body: str = "raw_response", name: str = "response"
) -> DataFrame:
    """Add the structured answer for a level and a body."""
    return df.withColumn(name, render_answer(F.col(level), F.col(body)))


def label_names(df: DataFrame, label: str) -> list[str]:
    """The distinct labels in name order: the vocabulary of a class label, for few labels."""
    distinct = df.select(label).where(F.col(label).isNotNull()).distinct()
    return sorted(r[0] for r in distinct.toLocalIterator())


def label_codes(df: DataFrame, label: str, name: str = "label_id") -> DataFrame:
    """``(label, name)``: the distinct labels and their integer class, 0..k-1 in name order.

    Any number of labels: they are ordered in ranges, and none reaches the driver or a plan.
    """
    distinct = df.select(label).where(F.col(label).isNotNull()).distinct()
    placed = numbered(distinct, [F.col(label)], name)
    return placed.withColumn(name, (F.col(name) - 1).cast("int"))


def encode_with(df: DataFrame, label: str, codes: DataFrame) -> DataFrame:
    """Add the classes of a table of codes; null for labels it does not have.

    A label of most rows is spread over tasks when there are too many labels to broadcast.
    """
    added = [c for c in codes.columns if c != label]
    df = df.drop(*added)
    few = codes.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA
    return salted_join(df, codes, label, few).select(*df.columns, *added)


def decode_with(df: DataFrame, label_id: str, codes: DataFrame) -> DataFrame:
    """Add the labels of a table of codes, whose class column is ``label_id``; null for other classes."""
    return encode_with(df, label_id, codes)


def encode_labels(
    df: DataFrame, label: str, names: Sequence[str] | None = None, name: str = "label_id"
) -> DataFrame:
    """Add the integer class of a label, 0..k-1 in name order; null for other labels.

    Without ``names`` the labels are those of the column, however many.
    """
    if names is None:
        return encode_with(df, label, label_codes(df, label, name))
    position = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(label))
    return df.withColumn(name, F.when(position > 0, (position - 1).cast("int")))


def decode_labels(df: DataFrame, label_id: str, names: Sequence[str], name: str) -> DataFrame:
    """Add the label of an integer class, given the names in class order."""
    return df.withColumn(
        name, F.get(F.array(*[F.lit(n) for n in names]), F.col(label_id).cast("int"))
    )
