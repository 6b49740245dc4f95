"""Source normalisation: four question-and-answer shapes into one.

Every function is ``DataFrame -> DataFrame`` with the output columns
``(id, instruction, raw_response, source, language)`` and drops the rows that have no
question or no usable answer.  All are map-only projections.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.text import is_empty, strip

OPTIONS = ["a", "b", "c", "d", "e"]
NORMALIZED_COLUMNS = ["instruction", "raw_response", "source", "language"]


def _shape(
    df: DataFrame, row_id: str, instruction: Column, answer: Column, source: str, language: str
) -> DataFrame:
    return df.select(
        F.col(row_id).alias("id"),
        instruction.alias("instruction"),
        answer.alias("raw_response"),
        F.lit(source).alias("source"),
        F.lit(language).alias("language"),
    )


def _correct_answer(answer: Column) -> Column:
    return F.concat(F.lit(K.PREFIX_CORRECT_ANSWER), answer, F.lit("."))


def _options() -> Column:
    return F.array(*[F.col(f"answer_{letter}") for letter in OPTIONS])


def mcq_by_index(
    df: DataFrame, row_id: str = "id", source: str = K.SOURCE_MCQ_INDEX, language: str = "fr"
) -> DataFrame:
    """Multiple choice with a 0-based integer key in ``correct_answers``."""
    position = F.col("correct_answers")
    answer = F.when(
        position.between(0, len(OPTIONS) - 1), F.get(_options(), position.cast("int"))
    )
    kept = df.withColumn("_answer", answer).where(
        ~is_empty(F.col("question")) & ~is_empty(F.col("_answer"))
    )
    return _shape(
        kept, row_id, F.concat(F.lit(K.PREFIX_QUESTION), "question"),
        _correct_answer(F.col("_answer")), source, language,
    )


def qa_pairs(
    df: DataFrame, row_id: str = "id", source: str = K.SOURCE_QA, language: str = "en"
) -> DataFrame:
    """Question and answer taken as they are."""
    kept = df.where(~is_empty(F.col("Question")) & ~is_empty(F.col("Answer")))
    return _shape(kept, row_id, F.col("Question"), F.col("Answer"), source, language)


def mcq_by_letter(
    df: DataFrame, row_id: str = "id", source: str = K.SOURCE_MCQ_LETTER, language: str = "fr"
) -> DataFrame:
    """Multiple choice with a letter key and an optional case text before the question.

    Keys that name several letters match no option, so their rows are dropped.
    """
    letter = F.lower(strip(F.col("correct_answers")))
    position = F.array_position(F.array(*[F.lit(x) for x in OPTIONS]), letter)
    answer = F.when(position > 0, F.get(_options(), (position - 1).cast("int")))
    kept = df.withColumn("_answer", answer).where(
        ~is_empty(F.col("question")) & ~is_empty(F.col("_answer"))
    )
    case = F.col("clinical_case")
    question = F.when(is_empty(case), F.col("question")).otherwise(
        F.concat(case, F.lit("\n"), F.col("question"))
    )
    return _shape(
        kept, row_id, F.concat(F.lit(K.PREFIX_EXAM_QUESTION), question),
        _correct_answer(F.col("_answer")), source, language,
    )


def open_qa(
    df: DataFrame, row_id: str = "id", source: str = K.SOURCE_OPEN_QA, language: str = "fr"
) -> DataFrame:
    """Open question; the answer is in ``answer`` or, when that is empty, ``correct_answer``."""
    present = [F.nullif(F.col(c), F.lit("")) for c in ("answer", "correct_answer") if c in df.columns]
    kept = df.withColumn("_answer", F.coalesce(*present)).where(
        ~is_empty(F.col("question")) & F.col("_answer").isNotNull()
    )
    return _shape(
        kept, row_id, F.concat(F.lit(K.PREFIX_EXAM_QUESTION), "question"), F.col("_answer"),
        source, language,
    )


Normalizer = Callable[[DataFrame], DataFrame]

# Which shape each known source has; extend or replace it to add sources.
SOURCES: dict[str, Normalizer] = {
    K.SOURCE_MCQ_INDEX: mcq_by_index,
    K.SOURCE_QA: qa_pairs,
    K.SOURCE_MCQ_LETTER: mcq_by_letter,
    K.SOURCE_OPEN_QA: open_qa,
}


def union_sources(
    raw: Mapping[str, DataFrame], normalizers: Mapping[str, Normalizer] = SOURCES
) -> DataFrame:
    """Normalise each raw table by its source name and concatenate the results.

    Sources without a normaliser entry and entries without a table are skipped.
    """
    parts: Sequence[DataFrame] = [
        raw[name].transform(normalize) for name, normalize in normalizers.items() if name in raw
    ]
    if not parts:
        raise ValueError("no source could be loaded")
    return reduce(DataFrame.unionByName, parts)
