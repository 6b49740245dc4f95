"""Stage outputs: stored tables that are built once and reused."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.catalog import path_exists


def run_stage(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    overwrite: bool = False,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Return the stored output of a stage, building it only when it is not complete.

    ``build`` is not even called when the output exists.  ``_SUCCESS`` marks completeness,
    so a stage that died half-way is built again.  An output that is built again is replaced when
    the new one is complete, not before.  For stages that follow changes of their inputs see
    ``versions``.
    """
    place = path.rstrip("/")
    if overwrite or not path_exists(spark, f"{place}/_SUCCESS"):
        draft = f"{place}.{uuid.uuid4().hex}"
        writer = build().write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(draft)
        _put(spark, draft, place)
    return spark.read.parquet(path)


def _put(spark: SparkSession, draft: str, place: str) -> None:
    """Put a complete folder in the place of another."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs  # noqa: SLF001
    target = hadoop.Path(place)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    system.delete(target, True)
    if not system.rename(hadoop.Path(draft), target):
        raise OSError(f"{draft} is complete but could not be moved to {place}")


def write_splits(df: DataFrame, path: str, split: str = "split", overwrite: bool = False) -> None:
    """Store a table with one directory per split, so that readers prune by split."""
    df.write.mode("overwrite" if overwrite else "errorifexists").partitionBy(split).parquet(path)


def read_splits(spark: SparkSession, path: str, split: str = "split") -> dict[str, DataFrame]:
    """The stored splits by name; each frame reads its own directory only."""
    table = spark.read.parquet(path)
    names = [r[0] for r in table.select(split).distinct().toLocalIterator()]
    return {name: table.where(F.col(split) == name).drop(split) for name in sorted(names)}


def dataset_card(
    df: DataFrame,
    split: str = "split",
    language: str = "language",
    source: str = "source",
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per split: rows, languages and sources, plus fixed texts such as a licence."""

    def listing(column: str):
        return F.array_join(F.array_sort(F.collect_set(F.col(column).cast("string"))), ",")

    combos = df.groupBy(split, language, source).agg(F.count(F.lit(1)).alias("n"))
    return combos.groupBy(F.col(split).cast("string").alias(split)).agg(
        F.sum("n").alias("n_rows"), listing(language).alias("languages"), listing(source).alias("sources"),
    ).select("*", *[F.lit(text).alias(name) for name, text in (extra or {}).items()])


def export_dataset(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    split: str = "split",
    extra: Mapping[str, str] | None = None,
) -> str | None:
    """Write every split and the card; the text of a failure instead of raising, None if all is done.

    The card is secondary: when only it fails, the data is there and the text says so.
    """
    try:
        df.write.mode("overwrite").partitionBy(split).format(format).save(f"{path}/data")
    except Exception as failure:  # noqa: BLE001 - one failed export must not stop the others
        return f"data: {failure}"
    try:
        dataset_card(df, split, extra=extra).write.mode("overwrite").json(f"{path}/card")
    except Exception as failure:  # noqa: BLE001
        return f"card: {failure}"
    return None
