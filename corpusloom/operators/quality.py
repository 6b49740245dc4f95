"""Row quality rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.text import has_words, is_blank

# Equivalent to the tag half of the fixed pattern, written so that text with many "<" and no
# ">" is scanned once instead of once per "<".
_LINEAR_HTML = K.HTML_PATTERN.replace("<[^>]+>", "<[^<>]+>|<[^<>]*<>")



def has_markup(text: Column) -> Column:
    """Whether a text has an HTML tag or entity; text without ``<`` and ``&`` skips the pattern."""
    possible = F.contains(text, F.lit("<")) | F.contains(text, F.lit("&"))
    return possible & text.rlike(_LINEAR_HTML)


def has_url(text: Column) -> Column:
    """Whether a text has a web address; text without ``://`` and ``.`` skips the pattern."""
    possible = F.contains(text, F.lit("://")) | F.contains(text, F.lit("."))
    return possible & text.rlike(K.URL_PATTERN)


REASONS = ["blank_instruction", "short_response", "html", "url"]


def rejection_reason(
    instruction: Column, response: Column, min_words: int = K.MIN_RESPONSE_WORDS
) -> Column:
    """The first rule a row breaks, or null when it passes.

    The cheap rules come first; a row that fails one is not scanned for markup.
    """
    combined = F.concat(instruction, F.lit(" "), response)
    return (
        F.when(is_blank(instruction), F.lit("blank_instruction"))
        .when(~F.coalesce(has_words(response, min_words), F.lit(False)), F.lit("short_response"))
        .when(has_markup(combined), F.lit("html"))
        .when(has_url(combined), F.lit("url"))
    )


def quality_filter(
    df: DataFrame,
    instruction: str = "instruction",
    response: str = "raw_response",
    min_words: int = K.MIN_RESPONSE_WORDS,
) -> DataFrame:
    """Keep the rows that pass every rule."""
    return df.where(rejection_reason(F.col(instruction), F.col(response), min_words).isNull())


def quality_reasons(
    df: DataFrame,
    by: list[str],
    instruction: str = "instruction",
    response: str = "raw_response",
    min_words: int = K.MIN_RESPONSE_WORDS,
) -> DataFrame:
    """Rows in, rows kept and rows lost per first broken rule, per group."""
    reason = rejection_reason(F.col(instruction), F.col(response), min_words)
    return (
        df.select(*by, reason.alias("_reason"))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("_reason").isNull()).alias("n_valid"),
            *[F.count_if(F.col("_reason") == r).alias(f"n_{r}") for r in REASONS],
        )
    )


def request_gate(
    df: DataFrame,
    text: str = "symptoms",
    shortest: int = K.REQUEST_MIN_CHARS,
    longest: int = K.REQUEST_MAX_CHARS,
) -> DataFrame:
    """Add ``accepted``: whether the request text has an allowed number of characters."""
    size = F.length(F.col(text))
    return df.withColumn("accepted", F.coalesce(size.between(shortest, longest), F.lit(False)))
