"""Statistics over a log of requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import constants as K
from corpusloom.operators.ranking import ValueCut, value_cuts


def classify_outcomes(df: DataFrame) -> DataFrame:
    """Turn raw outcomes into ``(…, status_code, urgency_level, error)``.

    Input columns: ``status_code`` (null when the call raised), ``body``, ``exception`` and
    ``urgency_level`` as answered.  Only a 200 keeps its level.
    """
    raised, ok = F.col("exception").isNotNull(), F.col("status_code") == 200
    failure = F.concat(
        F.lit("HTTP "), F.col("status_code").cast("string"), F.lit(": "),
        F.substring("body", 1, K.ERROR_CHARS),
    )
    return (
        df.withColumn(
            "error",
            F.when(raised, F.substring("exception", 1, K.ERROR_CHARS)).when(~ok, failure),
        )
        .withColumn("urgency_level", F.when(ok & ~raised, F.col("urgency_level")))
        .withColumn("status_code", F.when(raised, F.lit(0)).otherwise(F.col("status_code")))
        .drop("body", "exception")
    )


def _index(fraction: float):
    def rank(n: Column) -> Column:
        return F.least(F.floor(F.lit(fraction) * n), n - 1)

    return rank


CUTS = (
    ValueCut("low_middle", 0.50, lambda n: F.floor((n - 1) / 2)),
    ValueCut("high_middle", 0.50, lambda n: F.floor(n / 2)),
    ValueCut("p95", 0.95, _index(0.95)),
    ValueCut("p99", 0.99, _index(0.99)),
)


def error_rate(df: DataFrame, phase: str = "phase") -> DataFrame:
    """Requests and failed requests per phase."""
    return df.groupBy(phase).agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(F.col("error").isNotNull()).alias("n_errors")
    )


def latency_stats(
    df: DataFrame, phase: str = "phase", latency: str = "latency_ms", accuracy: int = 10_000
) -> DataFrame:
    """Latency statistics of the successful requests per phase, to one decimal.

    Percentiles are values at a rank (``int(p * n)`` from 0), the median is the midpoint;
    a phase without success has a count of 0 and nothing else.
    """
    ok = F.col("error").isNull()
    value = F.when(ok, F.col(latency))
    base = df.groupBy(phase).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(~ok).alias("n_errors"),
        F.count_if(ok).alias("n_ok"),
        F.round(F.min(value), 1).alias("min_ms"),
        F.round(F.max(value), 1).alias("max_ms"),
        F.round(F.avg(value), 1).alias("mean_ms"),
    )
    exact = value_cuts(df.where(ok), F.col(phase), F.col(latency), CUTS, accuracy)

    def at(cut: str) -> Column:
        return F.max(F.when(F.col("cut") == cut, F.col("value")))

    cuts = exact.groupBy("stratum").agg(
        F.round((at("low_middle") + at("high_middle")) / 2, 1).alias("median_ms"),
        F.round(at("p95"), 1).alias("p95_ms"),
        F.round(at("p99"), 1).alias("p99_ms"),
    )
    # Both sides have one row per phase.
    joined = base.join(cuts, F.col(phase).cast("string") == F.col("stratum"), "left")
    return joined.select(
        phase, "n_total", "n_errors", "n_ok", "min_ms", "max_ms", "mean_ms", "median_ms",
        "p95_ms", "p99_ms",
    )


def sla_gate(
    stats: DataFrame,
    sequential: str = "sequential",
    limit_ms: float = K.SLA_P95_MS,
    phase: str = "phase",
) -> DataFrame:
    """Whether the 95th percentile of the sequential phase holds; no data fails."""
    p95 = F.max(F.when(F.col(phase) == sequential, F.col("p95_ms")))
    return stats.agg(p95.alias("p95_ms")).select(
        "p95_ms",
        F.lit(float(limit_ms)).alias("limit_ms"),
        F.coalesce(F.col("p95_ms") <= limit_ms, F.lit(False)).alias("passed"),
    )


def level_counts(
    df: DataFrame, by: Sequence[str] = (), level: str = "urgency_level"
) -> DataFrame:
    """Successful requests per level, unreadable ones (null) included, most urgent first."""
    order = F.array_position(F.array(*[F.lit(x) for x in K.LEVELS]), F.col(level))
    return (
        df.where(F.col("error").isNull())
        .groupBy(*by, level)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(*by, F.when(order > 0, order).otherwise(len(K.LEVELS) + 1))
    )
