"""Length and latency statistics that merge: stored sketches per group instead of the whole log.

Each group of rows becomes one row of a few kilobytes: its count, minimum and maximum, all exact,
and a KLL sketch of the values.  Groups are merged by aggregating those rows, so a report over a
year of daily sketches never reads the log again.  A quantile's rank is off by more than
``rank_error(k)`` in one case of a hundred at most; ``length_profile`` is the exact form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K_DEFAULT = 800
SHARES = (0.5, 0.75, 0.9, 0.95, 0.99)


def rank_error(k: int = K_DEFAULT) -> float:
    """Bound of the error of one rank, as a share of all rows, at 99 % confidence (published fit for KLL)."""
    return 2.296 / k**0.9021


def sketch_lengths(df: DataFrame, length: str, by: Sequence[str], k: int = K_DEFAULT) -> DataFrame:
    """``(by…, n, low, high, sketch)`` of a column of whole numbers; nulls are not counted."""
    value = F.col(length).cast("bigint")
    return df.select(*by, value.alias("_value")).groupBy(*by).agg(
        F.count("_value").alias("n"),
        F.min("_value").alias("low"),
        F.max("_value").alias("high"),
        F.kll_sketch_agg_bigint("_value", k).alias("sketch"),
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str], k: int = K_DEFAULT) -> DataFrame:
    """The same table for coarser groups; merging tables one by one or all at once is the same."""
    return sketches.where("n > 0").groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_bigint("sketch", k).alias("sketch"),
    )


def sketch_quantiles(sketches: DataFrame, by: Sequence[str], shares: Sequence[float] = SHARES) -> DataFrame:
    """``(by…, n, low, high, share, quantile)``, one row per group and share."""
    listed = [
        F.struct(F.lit(share).alias("share"),
                 F.kll_sketch_get_quantile_bigint("sketch", F.lit(share)).alias("quantile"))
        for share in shares
    ]
    return sketches.where("n > 0").select(*by, "n", "low", "high", F.inline(F.array(*listed)))


def rank_errors(df: DataFrame, length: str, by: Sequence[str], quantiles: DataFrame) -> DataFrame:
    """``quantiles`` with ``error``: how far the share lies outside the ranks its value has among the rows.

    Rows are counted per value first, so the join meets distinct values, not rows.
    """
    value = F.col(length).cast("bigint")
    counts = df.select(*by, value.alias("_value")).where("_value IS NOT NULL").groupBy(*by, "_value").agg(
        F.count(F.lit(1)).alias("_rows"))
    named = counts.withColumnsRenamed({c: f"_of_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    held = quantiles.join(named, same).groupBy(*quantiles.columns).agg(
        F.sum(F.when(F.col("_value") < F.col("quantile"), F.col("_rows")).otherwise(0)).alias("_below"),
        F.sum(F.when(F.col("_value") <= F.col("quantile"), F.col("_rows")).otherwise(0)).alias("_up_to"),
    )
    outside = F.greatest(
        F.lit(0.0), F.col("_below") / F.col("n") - F.col("share"), F.col("share") - F.col("_up_to") / F.col("n"))
    return held.select(*quantiles.columns, outside.alias("error"))
