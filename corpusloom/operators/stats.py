"""Distributions, split statistics and length profiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.functions.batches import slices
from corpusloom.functions.text import word_count
from corpusloom.operators.sampling import sample_per_group

PERCENTILES = [50, 75, 90, 95, 99]
# Bytes of texts given to a tokenizer at once.
CALL_BYTES = 1 << 18


def split_stats(df: DataFrame, text_columns: Sequence[str], split: str = "split") -> DataFrame:
    """Rows and mean words per text column, per split."""
    words = df.select(split, *[word_count(F.col(c)).alias(c) for c in text_columns])
    return words.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            (F.sum(F.coalesce(F.col(c), F.lit(0))) / F.count(F.lit(1))).alias(f"avg_{c}_words")
            for c in text_columns
        ],
    )


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by…, column_name, value, n)`` for several columns in one pass over the rows."""
    listed = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(*by, F.inline(listed))
        .groupBy(*by, "column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def split_dist(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """Distributions per split with each value's share of its split in percent."""
    counts = value_counts(df, columns, [split])
    totals = df.groupBy(split).agg(F.count(F.lit(1)).alias("_total"))
    return counts.join(totals.withColumnRenamed(split, "_split"), F.col(split).eqNullSafe(F.col("_split"))).select(
        *counts.columns, (F.col("n") / F.col("_total") * 100).alias("pct")
    )


def profile_columns(df: DataFrame, split: str = "split") -> DataFrame:
    """``(split, column_name, type, n_rows, n_null)`` of every column of each split."""
    others = [c for c in df.columns if c != split]
    counts = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in others]
    )
    listed = [
        F.struct(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("type"),
                 F.col("n_rows"), F.col(f"_null_{c}").alias("n_null"))
        for c in others
    ]
    return counts.select(split, F.inline(F.array(*listed)))


def profile_source(
    df: DataFrame, row_id: str, split: str = "split", examples: int = 2, seed: int = K.SEED
) -> DataFrame:
    """Seeded example rows of each split, next to the row count of the split."""
    sizes = df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))
    picked = sample_per_group(df, F.col(split), examples, row_id, seed)
    # ``picked`` has ``examples`` rows per split and ``sizes`` one.
    return picked.join(sizes, split)


def with_token_length(
    df: DataFrame,
    text: Column,
    name: str = "n_tokens",
    tokenizer_factory: Callable[[], Callable[[list[str]], list[int]]] | None = None,
) -> DataFrame:
    """Add the length of a text in tokens; whitespace words without a tokenizer.

    ``tokenizer_factory`` is called once per Python worker and returns a function from a
    batch of texts to their token counts.  Its batches have about ``CALL_BYTES``, since the tokens
    of a text may take a hundred times its bytes.
    """
    if tokenizer_factory is None:
        return df.withColumn(name, word_count(text).cast("bigint"))

    @F.arrow_udf("bigint")
    def count_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = tokenizer_factory()
        for texts in batches:
            for piece in slices(texts, CALL_BYTES):
                yield pa.array(np.asarray(count(piece.to_pylist()), np.int64))

    return df.withColumn(name, count_tokens(text))


def length_profile(
    df: DataFrame, length: str = "n_tokens", limit: int = 1024, by: Sequence[str] = ()
) -> DataFrame:
    """Percentiles (interpolated, then truncated), maximum, mean, and rows over the limit.

    Rows are first counted per length, so what meets in one task is the number of distinct
    lengths, not of rows; the result is exact.
    """
    # No filter on the length: it would be pushed down and evaluate the length twice.
    counts = df.groupBy(*by, F.col(length).cast("bigint").alias("_len")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    shares = F.array(*[F.lit(p / 100) for p in PERCENTILES])
    known = F.sum(F.when(F.col("_len").isNotNull(), F.col("_n")))
    over = F.sum(F.when(F.col("_len") > limit, F.col("_n")).otherwise(0))
    profile = counts.groupBy(*by).agg(
        F.percentile("_len", shares, F.col("_n")).alias("_p"),
        F.max("_len").alias("max_len"),
        (F.sum(F.col("_len") * F.col("_n")) / known).alias("mean_len"),
        F.coalesce(over, F.lit(0)).alias("n_truncated"),
        F.round(over / known * 100, 2).alias("pct_truncated"),
    )
    p95 = F.col("p95")
    *steps, last = K.LENGTH_STEPS
    advice = None
    for step in steps:
        fits = p95 <= step
        advice = F.when(fits, step) if advice is None else advice.when(fits, step)
    return profile.select(
        *by,
        *[
            F.floor(F.get("_p", F.lit(i))).cast("bigint").alias(f"p{p}")
            for i, p in enumerate(PERCENTILES)
        ],
        "max_len",
        "mean_len",
        "n_truncated",
        "pct_truncated",
    ).withColumn("advised_length", advice.otherwise(last))
