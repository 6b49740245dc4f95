"""Validation gates.  Each is one aggregation that yields a few rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import constants as K
from corpusloom.functions.text import fingerprint

BLOCK, WARN = "block", "warn"


def _falsy(df: DataFrame, column: str) -> Column:
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        empty = value == ""
    elif isinstance(kind, T.NumericType):
        empty = value == 0
    elif isinstance(kind, T.BooleanType):
        empty = ~value
    else:
        empty = F.lit(False)
    return F.coalesce(empty, F.lit(True))


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """Expected columns a table does not have."""
    return sorted(set(expected) - set(df.columns))


def null_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, n_empty)``: null, empty string, zero and false all count as empty."""
    counted = df.agg(*[F.count_if(_falsy(df, c)).alias(c) for c in columns])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_empty"))
                    for c in columns
                ]
            )
        )
    )


def leakage_check(
    df: DataFrame, key: str, split: str = "split", splits: Sequence[str] = ("train", "val", "test")
) -> DataFrame:
    """``(left_split, right_split, n_shared)``: distinct key values in both splits.

    One aggregation by fingerprint answers all pairs; copies of a value collapse before the
    shuffle.
    """
    seen = df.groupBy(fingerprint(F.col(key)).alias("k")).agg(
        *[F.max(F.col(split) == s).alias(s) for s in splits]
    )
    pairs = list(combinations(splits, 2))
    shared = seen.agg(*[F.count_if(F.col(a) & F.col(b)).alias(f"{a}|{b}") for a, b in pairs])
    return shared.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("left_split"),
                        F.lit(b).alias("right_split"),
                        F.col(f"{a}|{b}").alias("n_shared"),
                    )
                    for a, b in pairs
                ]
            )
        )
    )


def leaking_rows(df: DataFrame, key: str, split: str = "split", in_split: str = "train",
                 from_split: str = "test") -> DataFrame:
    """The rows of one split whose key value also occurs in another."""
    mark = fingerprint(F.col(key))
    other = df.where(F.col(split) == from_split).select(mark.alias("_k")).distinct()
    return (
        df.where(F.col(split) == in_split)
        .withColumn("_k", mark)
        .join(other, "_k", "left_semi")
        .drop("_k")
    )


def class_gap(
    df: DataFrame, label: str, by: Sequence[str] = (), limit: float = K.MAX_CLASS_GAP_PCT
) -> DataFrame:
    """Largest minus smallest class share in percent, over the classes present."""
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    gap = F.max("n") / total * 100 - F.min("n") / total * 100
    return counts.groupBy(*by).agg(gap.alias("gap_pct"), (gap <= limit).alias("passed"))


def split_size_gate(
    df: DataFrame, split: str = "split", minimum: Mapping[str, int] = K.MIN_SPLIT_ROWS
) -> DataFrame:
    """``(split, n, minimum, passed)`` for every required split; an absent one has 0 rows."""
    counted = df.agg(*[F.count_if(F.col(split) == s).alias(s) for s in minimum])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(s).alias("split"),
                        F.col(s).alias("n"),
                        F.lit(m).cast("bigint").alias("minimum"),
                        (F.col(s) >= m).alias("passed"),
                    )
                    for s, m in minimum.items()
                ]
            )
        )
    )


def identical_pairs(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pairs in all and pairs whose two answers are equal."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(F.col("chosen").eqNullSafe(F.col("rejected"))).alias("n_identical"),
    )


def export_check(df: DataFrame, text: str, token: str = K.EXPORT_TOKEN) -> DataFrame:
    """Rows in all and rows whose text names the token in any case."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.contains(F.upper(F.col(text)), F.lit(token))).alias("n_with_token"),
    )


def gate_row(df: DataFrame, gate: str, severity: str, passed: Column, detail: Column) -> DataFrame:
    """A gate result in the common shape ``(gate, severity, passed, detail)``."""
    return df.select(
        F.lit(gate).alias("gate"),
        F.lit(severity).alias("severity"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        detail.cast("string").alias("detail"),
    )


def gate_rollup(gates: Sequence[DataFrame]) -> DataFrame:
    """All gate rows and a final ``overall`` row that only blocking failures turn false.

    A gate has a row per split or column, so all rows of all gates fit in one aggregate;
    gathering them evaluates each gate once.
    """
    gathered = reduce(DataFrame.unionByName, gates).agg(
        F.collect_list(F.struct("gate", "severity", "passed", "detail")).alias("rows")
    )
    failed = F.size(
        F.filter("rows", lambda r: (r["severity"] == BLOCK) & ~r["passed"])
    )
    overall = F.struct(
        F.lit("overall").alias("gate"),
        F.lit(BLOCK).alias("severity"),
        (failed == 0).alias("passed"),
        failed.cast("string").alias("detail"),
    )
    everything = F.concat(F.col("rows"), F.array(overall))
    return gathered.select(F.inline(everything))
